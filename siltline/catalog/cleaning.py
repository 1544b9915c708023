"""Casts, keys, labels, row rules and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltline.catalog.base import Inputs, nullable_number, query
from siltline.catalog.derived import RAW_ORDERS
from siltline.functions import casts, dates, keys, labels, numbers, text
from siltline.operators import dedup, near_keys, phrases, validate

RAW = f"with raw as ({RAW_ORDERS})"


@query("c1_safe_cast_date", f"{RAW} select order_id, cast(try_cast(day_text as date) as string) as day from raw")
def safe_cast_date(t: Inputs):
    return t.derive(RAW_ORDERS).select("order_id", casts.to_date_or_null("day_text").alias("day"))


@query(
    "c2_safe_cast_decimal",
    f"{RAW} select order_id, cast(try_cast(amount_text as decimal(18,4)) as double) as amount from raw",
)
def safe_cast_decimal(t: Inputs):
    return t.derive(RAW_ORDERS).select("order_id", casts.to_decimal_or_null("amount_text", 18, 4).alias("amount"))


# Whole numbers as text, in the forms 14, 14.0 and 14.7, with some that are no numbers or do not fit.
NUMBER_TEXT = """
select l_orderkey, l_linenumber,
  case when l_returnflag = 'R' then concat(cast(cast(l_quantity as int) as string), '.7')
       when l_returnflag = 'A' and l_linestatus = 'F' then concat(cast(cast(l_quantity as int) as string), '.0')
       when l_discount = 0.05 then 'NaN'
       when l_discount = 0.06 then '99999999999'
       when l_discount = 0.07 then 'none'
       else cast(cast(l_quantity as int) as string) end as number_text
from {lineitem}
"""


@query(
    "c3_safe_cast_int",
    f"""
    select l_orderkey, l_linenumber, cast(case when isnan(d) then null else try_cast(trunc(d) as int) end as double) as number
    from (select l_orderkey, l_linenumber, try_cast(number_text as double) as d from ({NUMBER_TEXT}) as x) as y
    """,
)
def safe_cast_int(t: Inputs):
    number = nullable_number(casts.to_int_or_null("number_text"))
    return t.derive(NUMBER_TEXT).select("l_orderkey", "l_linenumber", number.alias("number"))


@query(
    "c4_trim_columns",
    f"{RAW} select order_id, regexp_replace(label_text, '^\\s+|\\s+$', '', 'g') as label_text, regexp_replace(day_text, '^\\s+|\\s+$', '', 'g') as day_text from raw",
)
def trim_columns(t: Inputs):
    return text.strip_columns(t.derive(RAW_ORDERS), ["label_text", "day_text"]).select("order_id", "label_text", "day_text")


# Place-like names in several spellings.
SPELLINGS = """
select p_partkey,
  case when p_type = 'PROMO' then concat('  ', upper(p_name), ' ')
       when p_type = 'LARGE' then replace(replace(p_name, 'i', 'í'), ' ', '_')
       when p_type = 'SMALL' then replace(upper(p_name), 'E', 'É')
       when p_type = 'MEDIUM' then 'PBA'
       when p_type = 'ECONOMY' then 'España'
       else replace(p_name, ' ', '   ') end as spelling
from {part}
"""


@query("c5_normal_key", f"select p_partkey, lower(trim(spelling)) as k from ({SPELLINGS}) as s")
def normal_key(t: Inputs):
    return t.derive(SPELLINGS).select("p_partkey", text.normal_key("spelling").alias("k"))


@query(
    "c6_canonical_key",
    f"""
    select p_partkey, case k when 'pba' then 'buenos aires' when 'espania' then 'espana' else k end as k from (
      select p_partkey, trim(regexp_replace(translate(lower(spelling), 'áéíóúñ_', 'aeioun '), '\\s+', ' ', 'g')) as k
      from ({SPELLINGS}) as s) as c
    """,
)
def canonical_key(t: Inputs):
    aliases = {"pba": "buenos aires", "espania": "espana"}
    return t.derive(SPELLINGS).select("p_partkey", text.canonical_key("spelling", aliases).alias("k"))


# Names of parts as they are misspelled, and kinds cut short.
MISSPELLED = """
select case when l_returnflag = 'A' and l_linestatus = 'F' then replace(p_name, 'i', '')
  when l_returnflag = 'A' then concat(substr(p_name, 2), substr(p_brand, 7))
  when l_returnflag = 'R' and l_linestatus = 'F' then concat(substr(p_name, 1, 3), 'x', substr(p_name, 4))
  when l_returnflag = 'R' then replace(p_name, 'e', 'aa')
  when l_linestatus = 'F' then substr(split_part(p_name, ' ', 2), 2)
  else concat(substr(p_type, 1, 2), cast(l_linenumber as string)) end as spelling
from {lineitem} join {part} on l_partkey = p_partkey
"""
KNOWN = """
select p_name as name from {part} union all select split_part(p_name, ' ', 2) as name from {part} union all select substr(p_type, 1, 3) as name from {part}
union all select cast(null as string) as name from {part}
"""


@query(
    "c6_near_keys",
    f"""
    with a as (select distinct spelling as key from ({MISSPELLED}) as m where spelling is not null), b as (select distinct name from ({KNOWN}) as k where name is not null)
    select key, name as match, cast(levenshtein(key, name) as int) as distance from a, b where levenshtein(key, name) <= 2
    qualify row_number() over (partition by key order by levenshtein(key, name), encode(name)) = 1
    """,
)
def nearest_spelling(t: Inputs):
    return near_keys.near_keys(t.derive(MISSPELLED), "spelling", t.derive(KNOWN), "name")


@query(
    "c7_ratio",
    "select l_orderkey, l_linenumber, l_partkey, l_quantity / nullif(l_discount, 0) as q from {lineitem}",
)
def ratio(t: Inputs):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", numbers.ratio("l_quantity", "l_discount").alias("q"))


@query("c8_default", f"{RAW} select order_id, coalesce(try_cast(amount_text as double), 0) as amount from raw")
def default(t: Inputs):
    return t.derive(RAW_ORDERS).select("order_id", numbers.or_default(casts.to_double_or_null("amount_text"), 0.0).alias("amount"))


@query(
    "c9_surrogate_key",
    f"{RAW} select order_id, md5(concat(order_id, '-', coalesce(label_text, '{keys.NULL_TOKEN}'), '-', coalesce(day_text, '{keys.NULL_TOKEN}'))) as k from raw",
)
def surrogate_key(t: Inputs):
    return t.derive(RAW_ORDERS).select("order_id", keys.surrogate_key("order_id", "label_text", "day_text").alias("k"))


@query(
    "c10_labels",
    """
    select p_partkey, case when p_type in ('PROMO', 'ECONOMY') then 'cheap' when p_type in ('LARGE') then 'big' else 'Other' end as category,
      case p_type when 'PROMO' then 'Promotion' when 'SMALL' then 'Little' else p_type end as name,
      case when contains(p_name, 'red') or contains(p_name, 'ring') then 'marked' else 'plain' end as mark,
      coalesce(region_name, 'nowhere') as shelf
    from {part} left join (select r_name as region_name, concat('Brand#', cast(r_regionkey as string)) as b from {region}) as m on p_brand = b
    """,
)
def category_labels(t: Inputs):
    shelf = t.region.select(F.concat(F.lit("Brand#"), F.col("r_regionkey").cast("string")).alias("b"), "r_name")
    placed = labels.label_from_table(t.part, "p_brand", shelf, "b", "r_name", "shelf", "nowhere")
    return placed.select(
        "p_partkey",
        labels.label_of("p_type", {"cheap": ["PROMO", "ECONOMY"], "big": ["LARGE"]}, "Other").alias("category"),
        labels.renamed_value("p_type", {"PROMO": "Promotion", "SMALL": "Little"}).alias("name"),
        labels.label_by_keyword("p_name", {"marked": ["red", "ring"]}, "plain").alias("mark"),
        "shelf",
    )


# Texts that name parts: spelled in capitals with other words, glued to other letters, after a shorter name, or only by kind.
PHRASE_TEXTS = """
select l_orderkey, l_linenumber,
  case when l_returnflag = 'A' and l_linestatus = 'F' then concat(upper(p_name), '-based kit!')
       when l_returnflag = 'R' then concat('my', p_name, 's')
       when l_returnflag = 'N' and l_linestatus = 'F' then concat('Used ', split_part(p_name, ' ', 2), ', ', p_name, ' (', p_brand, ')')
       when l_returnflag = 'A' then null
       else concat('  ', split_part(p_name, ' ', 2), '?') end as note
from {lineitem} join {part} on l_partkey = p_partkey
"""
# Names of two words and the kinds in them; several labels for each.
PHRASES = """
select p_name as phrase, p_brand as label from {part}
union all select split_part(p_name, ' ', 2) as phrase, concat('any of ', p_type) as label from {part}
union all select ' KIT ' as phrase, concat('kit ', p_type) as label from {part}
union all select cast(null as string) as phrase, p_type as label from {part}
"""


@query(
    "c10_phrases",
    f"""
    with dictionary as (select trim(lower(phrase)) as phrase, min(label) as label from ({PHRASES}) as p where phrase is not null group by 1),
    vals as (select distinct note, concat(' ', trim(regexp_replace(lower(note), '[^a-z0-9]+', ' ', 'g')), ' ') as padded from ({PHRASE_TEXTS}) as n where note is not null),
    hits as (select note, label, len(string_split(phrase, ' ')) as words, strpos(padded, concat(' ', phrase, ' ')) as place
      from vals join dictionary on contains(padded, concat(' ', phrase, ' '))),
    best as (select note, label from hits qualify row_number() over (partition by note order by words desc, place, label) = 1)
    select l_orderkey, l_linenumber, n.note, coalesce(label, 'none') as label from ({PHRASE_TEXTS}) as n left join best on best.note = n.note
    """,
)
def phrase_labels(t: Inputs):
    return phrases.match_phrases(t.derive(PHRASE_TEXTS), "note", t.derive(PHRASES), "phrase", "label", "label", "none")


@query(
    "c11_year_quarter",
    "select o_orderkey, concat(cast(year(o_orderdate) as string), '-Q', cast(quarter(o_orderdate) as string)) as year_quarter from {orders}",
)
def year_quarter(t: Inputs):
    return t.orders.select("o_orderkey", dates.year_quarter("o_orderdate").alias("year_quarter"))


@query(
    "c12_date_parts",
    """
    select o_orderkey, cast(year(o_orderdate) as int) as year, cast(quarter(o_orderdate) as int) as quarter, cast(month(o_orderdate) as int) as month,
      cast(week(o_orderdate) as int) as week, cast(day(o_orderdate) as int) as day
    from {orders}
    """,
)
def date_parts(t: Inputs):
    parts = dates.calendar_columns("o_orderdate")
    chosen = [parts[n].alias(n) for n in ("year", "quarter", "month", "week")]
    return t.orders.select("o_orderkey", *chosen, F.dayofmonth("o_orderdate").alias("day"))


TYPED = f"""
with typed as (
  select order_id, try_cast(day_text as date) as day, try_cast(amount_text as decimal(18,4)) as amount, label_text,
         cast(year(try_cast(day_text as date)) as int) as year
  from ({RAW_ORDERS}) as raw)
"""
TYPED_COLUMNS = "order_id, cast(day as string) as day, cast(amount as double) as amount, label_text, cast(year as double) as year"


def typed_orders(t: Inputs):
    typed = t.derive(RAW_ORDERS).select(
        "order_id",
        casts.to_date_or_null("day_text").alias("day"),
        casts.to_decimal_or_null("amount_text", 18, 4).alias("amount"),
        "label_text",
    )
    return dates.with_year_month(typed, "day", month=False)


def _rule_query(name, rule, where):
    @query(name, f"{TYPED} select {TYPED_COLUMNS} from typed where {where}")
    def run(t: Inputs):
        return validate.keep_valid(typed_orders(t), [rule()]).withColumn("year", nullable_number("year"))

    return run


_rule_query("d1_required", lambda: validate.required("amount"), "amount is not null")
_rule_query("d2_not_blank", lambda: validate.not_blank("label_text"), "label_text is not null and trim(label_text) <> ''")
_rule_query("d3_positive", lambda: validate.positive("amount"), "amount > 0")
_rule_query("d4_non_negative_or_null", lambda: validate.non_negative_or_null("amount"), "amount is null or amount >= 0")
_rule_query("d5_range", lambda: validate.in_range("year", 1996, 1999), "year between 1996 and 1999")


@query(
    "d6_model_filters",
    f"{TYPED} select {TYPED_COLUMNS} from typed where label_text = '4-NOT SPECIFIED' and day is not null and month(day) = 1",
)
def model_filters(t: Inputs):
    keep = (F.col("label_text") == "4-NOT SPECIFIED") & F.col("day").isNotNull() & (F.month("day") == 1)
    return typed_orders(t).where(keep).withColumn("year", nullable_number("year"))


def order_rules():
    return [
        validate.required("day"), validate.not_blank("label_text"), validate.positive("amount"),
        validate.in_range("year", 1996, 1999),
    ]


BROKEN = """
  select order_id, amount, list_filter([
    case when day is null then 'day_missing' end,
    case when label_text is null or trim(label_text) = '' then 'label_text_blank' end,
    case when coalesce(amount <= 0, true) then 'amount_not_positive' end,
    case when coalesce(year not between 1996 and 1999, true) then 'year_out_of_range' end], lambda x: x is not null) as reasons
  from typed
"""


@query(
    "d7_reject_routing",
    f"""{TYPED}, marked as ({BROKEN})
    select order_id, cast(amount as double) as amount, coalesce(array_to_string(reasons, ','), '') as reasons,
           case when len(reasons) = 0 then 'valid' else 'rejected' end as route
    from marked""",
)
def reject_routing(t: Inputs):
    valid, rejected = validate.route(typed_orders(t), order_rules())
    kept = valid.select("order_id", "amount", F.lit("").alias("reasons"), F.lit("valid").alias("route"))
    lost = rejected.select("order_id", "amount", F.concat_ws(",", validate.REASONS).alias("reasons"), F.lit("rejected").alias("route"))
    return kept.unionByName(lost)


@query(
    "d7_reject_counts",
    f"""{TYPED}, marked as ({BROKEN})
    select reason, count(*) as n from (select unnest(reasons) as reason from marked) as u group by reason""",
)
def reject_counts(t: Inputs):
    return validate.reject_counts(typed_orders(t), order_rules())


@query(
    "e1_exact_dedup",
    "select distinct l_partkey, l_suppkey, l_quantity, l_returnflag from {lineitem}",
)
def exact_dedup(t: Inputs):
    return dedup.exact(t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_returnflag"))


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _survivor_sql(direction):
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from (
      select *, row_number() over (partition by l_orderkey, l_linenumber order by {order}) as rn from {{lineitem}}) as r
    where rn = 1
    """


@query("e2_first_per_key", _survivor_sql("asc"))
def first_per_key(t: Inputs):
    first = dedup.first_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("e3_latest_per_key", _survivor_sql("desc"))
def latest_per_key(t: Inputs):
    last = dedup.latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return last.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("e4_distinct_projection", "select distinct lower(trim(p_type)) as kind, p_brand from {part}")
def distinct_projection(t: Inputs):
    return dedup.distinct_values(t.part, [text.normal_key("p_type").alias("kind"), "p_brand"])
