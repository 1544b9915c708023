"""Phrases of a dictionary found in texts, as whole words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.functions.text import canonical_key
from siltline.operators.joins import group_join


def tokens(c: str | Column) -> Column:
    """Words of letters and digits, lower case, without accents; none for a null or a text without one."""
    plain = F.trim(F.regexp_replace(canonical_key(c), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.coalesce(F.split(plain, " "), F.array().cast("array<string>")))


def _run(first: Column, count: Column) -> Column:
    return F.array_join(F.slice("_tokens", first, count), " ")


def match_phrases(df: DataFrame, column: str, dictionary: DataFrame, phrase: str, label: str, out: str, default: str | None = None) -> DataFrame:
    """``df`` with ``out``: the label of the phrase of ``dictionary`` that ``column`` holds, or ``default``.

    Phrases match as whole words, without regard to case, accents and punctuation. Of several phrases in a value the one with most
    words counts, then the one that begins first; of several labels of a phrase the smallest. Phrases without a word or label match
    nothing. The dictionary may be of any size: each distinct value is cut once into its runs of as many words as some
    phrase has, and these meet the phrases in an equality join. Labels come back to the rows through a join that leaves the
    rows of frequent values in place.
    """
    words = dictionary.select(tokens(phrase).alias("_tokens"), F.col(label).alias("_label")).where((F.size("_tokens") > 0) & F.col(label).isNotNull())
    words = words.groupBy(F.array_join("_tokens", " ").alias("_phrase"), F.size("_tokens").alias("_size")).agg(F.min("_label").alias("_label"))
    sizes = [r[0] for r in words.select("_size").distinct().orderBy("_size").collect()]  # lengths of phrases in words: a few small numbers
    values = df.groupBy(F.col(f"`{column}`").alias("_value")).agg(F.count("*").alias("_rows"))
    n = F.size("_tokens")
    lengths = F.filter(F.array(*[F.lit(k) for k in sizes]).cast("array<int>"), lambda k: k <= n)
    runs = F.flatten(F.transform(lengths, lambda k: F.transform(
        F.sequence(F.lit(1), n - k + 1), lambda i: F.struct(k.alias("size"), i.alias("place"), _run(i, k).alias("text")))))
    cut = values.where("_value is not null").select("_value", tokens("_value").alias("_tokens")).select("_value", F.explode(runs).alias("_run"))
    hits = cut.join(words.select("_phrase", "_label"), F.col("_run.text") == F.col("_phrase"))
    best = hits.groupBy("_value").agg(F.max_by("_label", F.struct(F.col("_run.size"), -F.col("_run.place"))).alias("_label"))
    side = values.join(best, "_value", "left").select(
        F.col("_value").alias(column), F.coalesce("_label", F.lit(default).cast("string")).alias(out), "_rows")
    return group_join(df, side, [column], "_rows", null_safe=True)
