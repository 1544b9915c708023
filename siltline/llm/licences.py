"""Licence notices, found by a trained paragraph classifier and confirmed by templates. DataFrame functions only."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltline.llm.common import Scratch

#: Usual wording of notices by licence family.
TEMPLATES = {
    "agpl": ["licensed under the gnu affero general public license version 3", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"],
    "apache": ["licensed under the apache license version 2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www.apache.org licenses license 2.0", "released under the apache license 2.0"],
    "bsd": ["licensed under the bsd 3 clause license", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "use of this source code is governed by a bsd style license"],
    "cc-by": ["this work is licensed under a creative commons attribution 4.0 international license", "licensed under cc by 4.0"],
    "cc-by-nc": ["licensed under cc by nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"],
    "cc0": ["released under cc0 1.0 universal public domain dedication", "to the extent possible under law the author has waived all copyright and related rights to this work"],
    "gpl": ["this work is licensed under the gnu general public license version 3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "licensed under the gpl version 2"],
    "lgpl": ["licensed under the gnu lesser general public license version 2.1", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"],
    "mit": ["released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "licensed under the mit license"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2.0", "licensed under the mozilla public license version 2.0"],
    "proprietary": ["all rights reserved", "proprietary and confidential unauthorized copying of this file via any medium is strictly prohibited"],
}
#: Wording around notices in training rows, and near misses that are none.
AROUND = ["{}", "copyright 2024 the authors {}", "{} see the license file for details", "this project is {}", "{} by its contributors", "note {}"]
NEAR_MISSES = ["the driver must carry a license and a permit", "he works under a general manager", "a public work of art in the city", "the university of california at berkeley",
               "terms and conditions apply to this offer", "the software is free to try for thirty days", "she studied at mit in the nineties", "an apache helicopter", "creative work in the commons",
               "version 2.0 of the report", "the foundation published the results", "permission to enter was granted", "attribution of the painting is unclear", "copy the file to this folder", "rights of the public"]
#: What the ordinary paragraphs of the corpus weigh together, in rows, at most; half of all rows calibrate.
ORDINARY = 2000
#: Steps of a probability.
FINE = 1_000_000
#: A prediction is confirmed by a template of the family that shares this part of its word pairs.
SHARED = 0.6
NONE, UNKNOWN = "none", "unknown"
#: Lines over which a wrapped notice is looked for, at most.
WRAPPED = 4


def _needed() -> list[str]:
    """Words of which every text that a template confirms has one: without them too few of its pairs are left."""
    out = set()
    for template in (t for ts in TEMPLATES.values() for t in ts):
        words = template.split()
        pairs = {(a, b) for a, b in zip(words, words[1:], strict=False)}
        total = len(pairs)
        for word in sorted(set(words), key=lambda w: (w not in out, -len(w), w)):
            if len(pairs) < SHARED * total - 1e-9:
                break
            pairs = {p for p in pairs if word not in p}
            out.add(word)
    return sorted(out)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?![\p{L}\p{N}])", " "), " "), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))


def _grams(words: Column) -> Column:
    return F.concat(words, F.filter(_pairs(words), lambda p: p.isNotNull()))


def _literal_pairs(template: str) -> Column:
    words = template.split()
    return F.array(*(F.lit(f"{a} {b}") for a, b in zip(words, words[1:], strict=False)))


def _every() -> list[list[str]]:
    """The word pairs of all templates."""
    words = [t.split() for f in sorted(TEMPLATES) for t in TEMPLATES[f]]
    return [[f"{a} {b}" for a, b in zip(w, w[1:], strict=False)] for w in words]


def _shared(templates: Column, grams: Column) -> Column:
    """The largest part of a template's word pairs that a line has."""
    return F.array_max(F.transform(templates, lambda t: F.size(F.array_intersect(t, grams)) / F.size(t)))


def _bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is worked out once for each row: the optimiser does not put what a generator made into later expressions, as it
    does with a plain column, which would then be worked out again for every template."""
    return df.select("*", F.explode(F.array(F.struct(value.alias(name)))).alias("_one")).select(*df.columns, f"_one.{name}")


def _confirmed(df: DataFrame) -> DataFrame:
    """Rows whose ``grams`` share enough of some template. What they have of the pairs of all templates comes first; only where
    that is enough for the shortest template it is compared with each."""
    every = _every()
    pairs = F.array(*map(F.lit, dict.fromkeys(p for t in every for p in t)))
    least = min(len(set(t)) for t in every) * SHARED - 1e-9
    some = _bound(df, "hit", F.array_intersect(pairs, "grams")).where(F.size("hit") >= least)
    return some.where(_shared(F.array(*(F.array(*map(F.lit, t)) for t in every)), F.col("hit")) >= SHARED).drop("hit")


def _paragraphs(docs: DataFrame) -> DataFrame:
    """Lines of every text that have a word, with their place."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    return docs.select("doc_id", "mark", F.posexplode(lines).alias("place", "line")).where(F.length(F.trim("line")) > 0)


def _wrapped(docs: DataFrame) -> DataFrame:
    """Runs of 2 to WRAPPED lines that share enough of a template, with ``place`` of the first line, ``n_lines`` and
    ``grams``. A line without a word ends a run. The longest run from each line is tried first: shorter ones share less."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    hint = "(?<![a-z0-9])(?:" + "|".join(w.replace(".", "\\.") for w in _needed()) + ")"  # where a word may begin
    worded = lambda x: x.rlike(r"[\p{L}\p{N}]")
    kept = lambda rows: _confirmed(_bound(_bound(rows, "words", _words(F.array_join("run", " "))), "grams", _grams(F.col("words"))).drop("words"))
    texts = docs.where(F.lower("text").rlike(hint) & F.col("text").contains("\n")).select("doc_id", "mark", lines.alias("lines"))
    texts = _bound(_bound(texts, "some", F.transform("lines", lambda x: F.lower(x).rlike(hint))), "worded", F.transform("lines", worded))
    starts = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("place"), F.slice("lines", i + 1, WRAPPED).alias("run"))),
                      lambda x: (F.size(x["run"]) > 1) & F.get("worded", x["place"]) & F.get("worded", x["place"] + 1)
                      & F.exists(F.slice("some", x["place"] + 1, WRAPPED), lambda y: y))
    longest = kept(texts.select("doc_id", "mark", F.explode(starts).alias("x")).select("doc_id", "mark", "x.place", "x.run"))
    sizes = F.explode(F.filter(F.sequence(F.lit(2), F.lit(WRAPPED)), lambda n: n <= F.size("run")))
    shorter = longest.select("doc_id", "mark", "place", "run", sizes.alias("n_lines")).withColumn("run", F.slice("run", F.lit(1), F.col("n_lines")))
    return kept(shorter.where(F.forall("run", worded))).select("doc_id", "mark", "place", "n_lines", "grams")


def _apart(found: str) -> Column:
    """Of notices that overlap one stays: a single line before a run of lines, then the likeliest, the shortest and the first."""
    order = F.transform(F.array_sort(F.transform(found, lambda x: F.struct(
        (x["n_lines"] > 1).alias("run"), (-x["p"]).alias("q"), x["n_lines"].alias("n_lines"), x["place"].alias("place"), x["family"].alias("family")))),
        lambda x: F.struct(x["place"], x["n_lines"], x["family"], (-x["q"]).alias("p")))
    none = F.array().cast("array<struct<place:int,n_lines:int,family:string,p:double>>")
    meets = lambda a, b: (a["place"] < b["place"] + b["n_lines"]) & (b["place"] < a["place"] + a["n_lines"])
    return F.aggregate(order, none, lambda kept, x: F.when(F.exists(kept, lambda y: meets(x, y)), kept).otherwise(F.concat(kept, F.array(x)).cast("array<struct<place:int,n_lines:int,family:string,p:double>>")))


def _made(spark: SparkSession) -> DataFrame:
    """Rows (label, words, learns): templates in several surroundings and with words left out, and near misses."""
    rows = [(family, around.format(t)) for family, ts in sorted(TEMPLATES.items()) for t in ts for around in AROUND]
    rows += [(NONE, around.format(t)) for t in NEAR_MISSES for around in AROUND]
    made = spark.createDataFrame(rows, "label string, line string").select("label", _words(F.col("line")).alias("words"))
    copies = made.select("label", "words", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("copy"))
    kept = F.filter("words", lambda w: (F.col("copy") == 0) | (F.pmod(F.xxhash64(w, F.col("copy"), F.size("words")), F.lit(10)) > 0))
    return copies.select("label", kept.alias("words")).select("label", "words", _learns().alias("learns"))


def _learns() -> Column:
    """A row belongs to the half that learns or to the half that calibrates by its words."""
    return F.pmod(F.xxhash64("words"), F.lit(2)) == 0


def _vocabulary(made: DataFrame) -> list[str]:
    """Words and pairs of the made rows, which bound their number, and a mark for each size of a line."""
    known = made.select(F.explode(_grams(F.col("words"))).alias("gram")).distinct().collect()
    return sorted(r[0] for r in known) + [f"#{k}" for k in range(1, 33)]


def _featured(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``rows`` with ``features``: which of the vocabulary are among ``grams``, and the size of the line as a power of two."""
    size = F.concat(F.lit("#"), F.length(F.bin(F.size("grams"))).cast("string"))
    return CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features", binary=True).transform(rows.withColumn("grams", F.concat("grams", F.array(size)))).drop("grams")


def _places() -> Column:
    """The places in the vocabulary of what a row has of it."""
    return F.unwrap_udt("features")["indices"]


def _as_places(templates: list[str], place: dict[str, int]) -> Column:
    """The word pairs of templates by their place in the vocabulary."""
    words = [t.split() for t in templates]
    return F.array(*(F.array(*(F.lit(place[f"{a} {b}"]) for a, b in zip(w, w[1:], strict=False))) for w in words))


def train(lines: DataFrame, made: DataFrame, vocabulary: list[str], scratch: Scratch) -> tuple[LogisticRegressionModel, list[str], float]:
    """The classifier, its families and the least probability at which it is believed.

    Learns from the made rows and from half of all lines of the corpus, ``lines(features, learns)``, notices by the rule of the templates
    left out. Lines of equal features are one row that weighs as many; together they weigh no more than ``ORDINARY`` rows, as
    they would outweigh the notices else. The limit is such that of the lines of the other half that are no notice at most one in a thousand
    would pass, and one half at least.
    """
    every = _as_places([t for f in sorted(TEMPLATES) for t in TEMPLATES[f]], {w: i for i, w in enumerate(vocabulary)})
    kinds = scratch.save(lines.groupBy("features", "learns").agg(F.count("*").alias("n")))
    ordinary = kinds.where(_shared(every, _places()) < SHARED)
    learned = ordinary.where("learns").agg(F.sum("n")).first()[0] or 0
    families = [NONE, *sorted(TEMPLATES)]
    index = F.array_position(F.array(*map(F.lit, families)), F.col("label")).cast("double") - 1
    shown = _featured(made.withColumn("grams", _grams(F.col("words"))), vocabulary).select(index.alias("index"), "features", "learns", F.lit(1).cast("long").alias("n"), F.lit(1.0).alias("weight"))
    weight = F.col("n") * F.lit(min(1.0, ORDINARY / 2 / max(1, learned)))
    rows = shown.unionByName(ordinary.select(F.lit(0.0).alias("index"), "features", "learns", "n", weight.alias("weight")))
    model = LogisticRegression(labelCol="index", weightCol="weight", elasticNetParam=0.5, regParam=0.002, maxIter=30, family="multinomial").fit(rows.where("learns"))
    others = model.transform(rows.where("not learns and index = 0")).select("n", _best("probability")[1].alias("p"))
    total = others.agg(F.sum("n")).first()[0] or 0
    steps = others.where("p >= 0.5").groupBy(F.round(F.col("p") * FINE).alias("step")).agg(F.sum("n").alias("n"))  # half of FINE rows at most
    above = F.sum("n").over(Window.orderBy(F.desc("step")))
    last = steps.withColumn("above", above).where(F.col("above") * 1000 > total).agg(F.max("step")).first()[0]
    scratch.drop(kinds)
    return model, families, 0.5 if last is None else min(1.0, (last + 1) / FINE)


def _best(probability: str) -> tuple[Column, Column]:
    """Index and probability of the likeliest family other than none."""
    p = F.slice(vector_to_array(F.col(probability)), 2, 1 << 20)
    top = F.array_max(p)
    return F.array_position(p, top), F.round(top, 6)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_paragraphs, licences, notices, unknown``.

    Paragraphs are lines. ``notices`` lists ``(place, family, probability)`` of the lines that the classifier takes for a
    notice and a template of that family confirms, ``licences`` their families, and ``unknown`` counts the lines that it
    takes for a notice and no template confirms. A notice that is wrapped is found in a run of up to ``WRAPPED`` lines
    without an empty one between, and has the place of the first. Null and wordless texts have no paragraph; repeated rows give equal
    rows; an empty table gives no rows; other columns are not read.

    Texts are cut into words once: what a line has of the vocabulary is written, and the classifier learns from it, is calibrated
    by it and judges it.
    """
    scratch = Scratch(docs.sparkSession, "licences")
    marked = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    made = scratch.save(_made(docs.sparkSession))
    vocabulary = _vocabulary(made)
    worded = _bound(_paragraphs(marked), "words", _words(F.col("line"))).withColumn("learns", _learns())
    lines = _bound(worded, "grams", _grams(F.col("words"))).select("doc_id", "mark", "place", F.lit(1).alias("n_lines"), "learns", "grams")
    runs = _wrapped(marked).withColumn("learns", F.lit(None).cast("boolean"))
    every = scratch.save(_featured(lines.unionByName(runs), vocabulary))
    model, families, limit = train(every.where("n_lines = 1").select("features", "learns"), made, vocabulary, scratch)
    place, probability = _best("probability")
    scored = model.transform(every).select("doc_id", "mark", "place", "n_lines", "features", place.alias("k"), probability.alias("p")).where(F.col("p") >= limit)
    at = {w: i for i, w in enumerate(vocabulary)}
    templates = F.create_map(*(x for i, f in enumerate(families[1:], 1) for x in (F.lit(i), _as_places(TEMPLATES[f], at))))
    shared = _shared(templates[F.col("k").cast("int")], _places())
    name = F.element_at(F.array(*map(F.lit, families[1:])), F.col("k").cast("int"))
    judged = scored.select("doc_id", "mark", "place", "n_lines", "p", F.when(shared >= SHARED, name).otherwise(F.lit(UNKNOWN)).alias("family"))
    notice = F.struct("place", "n_lines", "family", "p")
    known = F.col("family") != UNKNOWN
    grouped = judged.distinct().groupBy("doc_id", "mark").agg(
        F.collect_list(F.when(known, notice)).alias("every"), F.collect_list(F.when(~known & (F.col("n_lines") == 1), F.col("place"))).alias("open"))
    apart = grouped.select("doc_id", "mark", "open", _apart("every").alias("kept"))
    inside = lambda at: F.exists("kept", lambda x: (at >= x["place"]) & (at < x["place"] + x["n_lines"]))
    found = scratch.save(apart.select(
        F.col("doc_id").alias("own_id"), F.col("mark").alias("own_mark"),
        F.array_sort(F.transform("kept", lambda x: F.struct(x["place"].alias("place"), x["family"].alias("family"), x["p"].alias("probability")))).alias("notices"),
        F.size(F.filter("open", lambda at: ~inside(at))).cast("long").alias("unknown")))
    scratch.drop(every)
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.length(F.trim(x)) > 0))
    rows = marked.select("doc_id", "mark", n.cast("long").alias("n_paragraphs"))
    joined = rows.join(found, rows.doc_id.eqNullSafe(found.own_id) & (rows.mark == found.own_mark), "left")
    none = F.array().cast("array<struct<place:int,family:string,probability:double>>")
    return joined.select("doc_id", "n_paragraphs", F.array_sort(F.array_distinct(F.coalesce(F.col("notices.family"), F.array().cast("array<string>")))).alias("licences"),
                         F.coalesce("notices", none).alias("notices"), F.coalesce("unknown", F.lit(0)).cast("long").alias("unknown"))
