"""The worked example end to end: silver tables, staging views, star schema, suite and questions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from siltline.catalog.base import Inputs, nullable_number, query
from siltline.catalog.derived import CERTS_RAW, INDICATOR_VALUES, MATRIX_CELLS, WEATHER_RAW
from siltline.catalog.ingest import indicator_payloads
from siltline.catalog.shapes import NATIONAL, wide_matrix
from siltline.functions.keys import NULL_TOKEN
from siltline.functions.text import normal_key
from siltline.plans import gold, questions, silver, staging, suite
from siltline.session import settle
from siltline.sources import landing, payload, raw_csv
from siltline.sources.schemas import RAW_COLUMNS

# ---------------------------------------------------------------- silver, as SQL

EXPORTS = f"""
exports as (
  select y as year, province, country, cast(v as double) as fob_usd from ({MATRIX_CELLS}) as c where v > 0 and y between 1990 and 2030)
"""
NATIONAL_BLOCK = f"select y, '{NATIONAL}', country, cast(sum(v) as double) from ({MATRIX_CELLS}) as c group by y, country"
CERTS = f"""
certs as (
  select distinct try_cast(fecha as date) as fecha, trim(oficina_cf) as oficina_cf, trim(provincia) as provincia,
    try_cast(trunc(try_cast(provincia_id as double)) as int) as provincia_id, trim(pais_destino) as pais_destino,
    try_cast(trunc(try_cast(pais_destino_id as double)) as int) as pais_destino_id,
    trim(pais_destino_id_iso_3166_1) as pais_destino_id_iso_3166_1, trim(continente) as continente,
    trim(mercaderia_certificada) as mercaderia_certificada, trim(transporte) as transporte, try_cast(tn as decimal(18,4)) as tn
  from ({CERTS_RAW}) as raw
  where try_cast(fecha as date) is not null and trim(pais_destino) <> '' and (tn is null or try_cast(tn as decimal(18,4)) >= 0))
"""
READINGS = f"""
select cast(d as string) as date, province, cast(try_cast(latitude as decimal(8,5)) as double) as latitude,
  cast(try_cast(longitude as decimal(8,5)) as double) as longitude, cast(try_cast(temp_max_c as decimal(6,2)) as double) as temp_max_c,
  cast(try_cast(temp_min_c as decimal(6,2)) as double) as temp_min_c, cast(try_cast(precipitation_mm as decimal(8,2)) as double) as precipitation_mm,
  cast(try_cast(wind_speed_max_kmh as decimal(6,2)) as double) as wind_speed_max_kmh,
  cast(try_cast(evapotranspiration_mm as decimal(8,2)) as double) as evapotranspiration_mm,
  cast(year(d) as int) as year, cast(month(d) as int) as month
from (select *, try_cast(date as date) as d, row_number() over (partition by try_cast(date as date), province order by event_id) as rn
      from ({WEATHER_RAW}) as raw where try_cast(date as date) is not null and province is not null) as r
where rn = 1
"""
INDICATORS = f"""
indicators as (
  select country, country_code, indicator, indicator_code, year, cast(amount as double) as value
  from ({INDICATOR_VALUES}) as v where indicator_code <> '5-LOW' and amount > 0)
"""


def readings_columns(df):
    return df.select(*RAW_COLUMNS["weather_daily_readings"], "year", "month")


# ---------------------------------------------------------------- silver

@query("m1_indec_exports", f"with {EXPORTS} select year, province, country, fob_usd from exports union all {NATIONAL_BLOCK}")
def indec_exports(t: Inputs):
    bronze, target = t.folder("m1_bronze"), t.folder("m1_silver")
    landing.land(wide_matrix(t), bronze, "indec", date(2024, 1, 1))
    return silver.refresh(t.spark, "indec_exports", bronze, target)


@query(
    "m1_latest_landing",
    f"""
    select y as year, province, country, cast(case when y >= 1998 then v * 2 else v end as double) as fob_usd
    from ({MATRIX_CELLS}) as c where v > 0
    """,
)
def latest_landing(t: Inputs):
    """Two landings; the second revises the years from 1998 on."""
    bronze = t.folder("m1_landings")
    matrix = settle(wide_matrix(t), "m1_matrix")
    landing.land(matrix, bronze, "indec", date(2024, 1, 1))
    revised = matrix.where(F.year(F.col("indice_tiempo").cast("date")) >= 1998)
    cells = [c for c in matrix.columns if c != "indice_tiempo"]
    twice = {c: (F.col(f"`{c}`").cast("decimal(18,2)") * 2).cast("string") for c in cells}
    landing.land(revised.withColumns(twice), bronze, "indec", date(2024, 2, 1))
    raw = raw_csv.read_raw_csv(t.spark, bronze, position=True)
    dated = raw.withColumn("landing", F.regexp_extract(raw_csv.FILE, "(year=[^/]+/month=[^/]+)/", 1)).drop(*raw_csv.POSITION)
    return silver.indec_exports(dated, exclude_prefixes=[NATIONAL], landing="landing")


@query(
    "m1_refresh_newest_landing",
    f"""
    select y as year, province, country, cast(case when y >= 1998 then v * 2 else v end as double) as fob_usd
    from ({MATRIX_CELLS}) as c where v > 0
    """,
)
def refresh_newest_landing(t: Inputs):
    """The job over two landings with headers in different orders; the second revises the years from 1998 on."""
    bronze, target = t.folder("m1_newest"), t.folder("m1_newest_silver")
    matrix = settle(wide_matrix(t), "m1_matrix")
    landing.land(matrix, bronze, "indec", date(2024, 1, 1))
    cells = [c for c in matrix.columns if c != "indice_tiempo"]
    twice = [(F.col(f"`{c}`").cast("decimal(18,2)") * 2).cast("string").alias(c) for c in reversed(cells)]
    revised = matrix.where(F.year(F.col("indice_tiempo").cast("date")) >= 1998).select(*twice, "indice_tiempo")
    landing.land(revised, bronze, "indec", date(2024, 2, 1))
    return silver.refresh(t.spark, "indec_exports", bronze, target, exclude_prefixes=[NATIONAL], newest_landing=True)


# What is left after the revision: cells of Salta are zero, those of Mendoza blank, Cordoba isn't delivered again, all of 2000
# is zero, the rest is doubled.
REVISED = f"""
select y as year, province, country, cast(case when y >= 1998 then v * 2 else v end as double) as fob_usd
from ({MATRIX_CELLS}) as c where v > 0 and (y < 1998 or y <> 2000 and province not in ('salta', 'mendoza', 'cordoba'))
"""


@query("m1_revised_to_nothing", REVISED)
def revised_to_nothing(t: Inputs):
    """The second landing takes cells back; the year of which nothing is left is emptied in the stored table."""
    bronze, target = t.folder("m1_revised"), t.folder("m1_revised_silver")
    matrix = settle(wide_matrix(t), "m1_matrix")
    landing.land(matrix, bronze, "indec", date(2024, 1, 1))
    silver.refresh(t.spark, "indec_exports", bronze, target, exclude_prefixes=[NATIONAL], whole_years=True)
    year, cells = F.year(F.col("indice_tiempo").cast("date")), []
    for c in matrix.columns:
        if c == "indice_tiempo":
            cells.append(F.col(c))
        elif not c.startswith("cordoba"):
            twice = (F.col(f"`{c}`").cast("decimal(18,2)") * 2).cast("string")
            cells.append((F.when(year == 2000, "0").otherwise("0" if c.startswith("salta") else "  " if c.startswith("mendoza") else twice)).alias(c))
    landing.land(matrix.where(year >= 1998).select(*cells), bronze, "indec", date(2024, 2, 1))
    return silver.refresh(t.spark, "indec_exports", bronze, target, exclude_prefixes=[NATIONAL], whole_years=True)


@query(
    "m2_senasa_certs",
    f"""with {CERTS} select cast(fecha as string) as fecha, oficina_cf, provincia, cast(provincia_id as double) as provincia_id, pais_destino, cast(pais_destino_id as double) as pais_destino_id,
      pais_destino_id_iso_3166_1, continente, mercaderia_certificada, transporte, cast(tn as double) as tn,
      cast(year(fecha) as int) as year, cast(month(fecha) as int) as month from certs""",
)
def senasa_certs(t: Inputs):
    bronze, target = t.folder("m2_bronze"), t.folder("m2_silver")
    landing.land(t.derive(CERTS_RAW), bronze, "senasa", date(2024, 1, 1))
    stored = silver.refresh(t.spark, "senasa_certs", bronze, target)
    return stored.withColumns({c: nullable_number(c) for c in ("provincia_id", "pais_destino_id")})


@query("m3_weather_daily_readings", READINGS)
def weather_daily_readings(t: Inputs):
    """The landing is written in event order, and the first reading of a day is found by file position."""
    bronze, target = t.folder("m3_bronze"), t.folder("m3_silver")
    raw = t.derive(WEATHER_RAW).orderBy("event_id").drop("event_id")
    landing.land(raw, bronze, "weather", date(2024, 1, 1))
    return readings_columns(silver.refresh(t.spark, "weather_daily_readings", bronze, target))


@query("m4_worldbank_indicators", f"with {INDICATORS} select country, country_code, indicator, indicator_code, year, value from indicators")
def worldbank_indicators(t: Inputs):
    """Two landings of the same payloads, the later with other values: the earlier stays."""
    bronze, target = t.folder("m4_bronze"), t.folder("m4_silver")
    rows = payload.flatten_records(indicator_payloads(t), "body", "indicator", "indicator_code")
    landing.land(rows, bronze, "worldbank", date(2024, 1, 1))
    later = rows.withColumn("value", F.concat(F.lit("1"), "value"))
    landing.land(later, bronze, "worldbank", date(2024, 2, 1))
    return silver.refresh(t.spark, "worldbank_indicators", bronze, target)


# ---------------------------------------------------------------- silver frames for the layers above

def certs_frame(t: Inputs):
    return silver.senasa_certs(t.derive(CERTS_RAW))


def exports_frame(t: Inputs):
    day = F.concat(F.col("y").cast("string"), F.lit("-01-01"))
    cells = t.derive(MATRIX_CELLS).select(day.alias("indice_tiempo"), "province", "country", F.col("v").cast("string").alias("raw_value"))
    return silver.exports_from_long(cells)


def indicators_frame(t: Inputs):
    rows = payload.flatten_records(indicator_payloads(t), "body", "indicator", "indicator_code")
    return silver.worldbank_indicators(rows, ["country", "value"])


def readings_frame(t: Inputs):
    raw = t.derive(WEATHER_RAW)
    return silver.weather_daily_readings(raw, [F.col("event_id").asc()])


# ---------------------------------------------------------------- staging

STG_EXPORTS = f"{EXPORTS}, stg_exports as (select year, lower(trim(province)) as province, lower(trim(country)) as country, fob_usd from exports)"
STG_CERTS = f"""{CERTS}, stg_certs as (
  select cast(year(fecha) as int) as year, lower(provincia) as province, lower(pais_destino) as country,
    pais_destino_id_iso_3166_1 as country_iso2, lower(mercaderia_certificada) as commodity, cast(tn as double) as total_tn from certs)
"""


@query("m5_stg_indec_exports", f"with {STG_EXPORTS} select * from stg_exports")
def stg_indec_exports(t: Inputs):
    return staging.stg_indec_exports(exports_frame(t))


@query("m5_stg_senasa_certs", f"with {STG_CERTS} select * from stg_certs")
def stg_senasa_certs(t: Inputs):
    return staging.stg_senasa_certs(certs_frame(t))


@query(
    "m5_stg_worldbank_prices",
    f"with {INDICATORS} select indicator_code, indicator as indicator_name, year, value as indicator_value from indicators where country_code = 'ARG'",
)
def stg_worldbank_prices(t: Inputs):
    return staging.stg_worldbank_prices(indicators_frame(t))


@query(
    "m5_stg_weather_readings",
    f"select date, lower(trim(province)) as province, temp_max_c, temp_min_c, precipitation_mm from ({READINGS}) as w",
)
def stg_weather_readings(t: Inputs):
    return staging.stg_weather_readings(readings_frame(t))


# ---------------------------------------------------------------- gold, as SQL


def spread_sql(rows: str, totals: str, more: str = "") -> str:
    """Rows with the weight of their group by a window, and the group's value."""
    return f"""
weighed as (
  select year, province, country, commodity{more}, sum(total_tn) as total_tn, sum(sum(total_tn)) over (partition by year, province, country) as group_tn
  from {rows} where year is not null and province is not null and country is not null group by year, province, country, commodity{more}),
worth as (select year, province, country, sum(fob_usd) as total from {totals} group by 1, 2, 3),
enriched as (
  select year, province, country, commodity{more}, total_tn, total_tn / nullif(group_tn, 0) * coalesce(total, 0) as fob_usd, coalesce(total, 0) as total_fob_usd
  from weighed left join worth using (year, province, country))
"""


ENRICHED = f"{STG_CERTS}, {STG_EXPORTS}, {spread_sql('stg_certs', 'stg_exports')}"
PRODUCTS = """
products as (
  select md5(commodity) as product_key, commodity,
    case when commodity in ('soja') then 'Oilseeds' when commodity in ('trigo', 'maíz') then 'Grains' when commodity = 'carne bovina' then 'Livestock'
         when commodity = 'limón' then 'Citrus' else 'Other' end as product_category,
    case commodity when 'soja' then 'Soybean' when 'trigo' then 'Wheat' when 'maíz' then 'Corn' when 'carne bovina' then 'Beef'
         when 'limón' then 'Lemon' else commodity end as commodity_english
  from (select distinct commodity from stg_certs where commodity is not null) as c)
"""
PROVINCES = """
provinces as (
  select md5(province) as province_key, province, province in ('buenos aires', 'córdoba', 'santa fe') as is_pampa_region,
    case province when 'buenos aires' then 'wheat' when 'córdoba' then 'soybean' when 'santa fe' then 'soybean' when 'mendoza' then 'grape' else 'tobacco' end as main_crop
  from (select distinct province from stg_certs where province is not null) as p)
"""
# The second run sees the continents in Spanish for one of them and misses the destinations of another.
CONTINENT = "case when continente = 'AMERICA' then 'américa' else lower(continente) end"
DESTINATIONS = f"""
first_run as (select distinct pais_destino_id_iso_3166_1 as country_iso2, lower(pais_destino) as country, lower(continente) as continent
  from certs where pais_destino_id_iso_3166_1 is not null),
second_run as (select distinct pais_destino_id_iso_3166_1 as country_iso2, lower(pais_destino) as country, {CONTINENT} as continent
  from certs where pais_destino_id_iso_3166_1 is not null and continente <> 'AFRICA'),
snap as (
  select country_iso2, country, continent, '2024-01-01 00:00:00' as dbt_valid_from,
    case when continent = 'america' then '2024-02-01 00:00:00' end as dbt_valid_to,
    case when continent = 'america' then '2024-02-01 00:00:00' else '2024-01-01 00:00:00' end as dbt_updated_at from first_run
  union all
  select country_iso2, country, continent, '2024-02-01 00:00:00', cast(null as string), '2024-02-01 00:00:00' from second_run where continent = 'américa'),
destinations as (select md5(country_iso2) as destination_key, country_iso2, country, continent from snap where dbt_valid_to is null)
"""
KEY = f"coalesce({{}}, '{NULL_TOKEN}')"
FACT = f"""{ENRICHED}, {PRODUCTS}, {PROVINCES}, {DESTINATIONS},
fact as (
  select md5(concat(cast(year as string), '-', {KEY.format('e.province')}, '-', {KEY.format('e.country')}, '-', {KEY.format('e.commodity')})) as export_key,
    concat(cast(year as string), '-01-01') as date_key, destination_key, product_key, province_key, year, total_tn, fob_usd, total_fob_usd
  from enriched e left join destinations on e.country = destinations.country
  left join products on e.commodity = products.commodity left join provinces on e.province = provinces.province)
"""


# ---------------------------------------------------------------- gold

class Mart:
    """Silver tables written once and the models above them."""

    def __init__(self, t: Inputs):
        self.t = t
        self.certs = settle(certs_frame(t), "certs")
        self.exports = settle(exports_frame(t), "exports")
        self.stg_certs = staging.stg_senasa_certs(self.certs)
        self.stg_exports = staging.stg_indec_exports(self.exports)
        self.products = gold.dim_product(self.stg_certs)
        self.provinces = gold.dim_province(self.stg_certs)
        self.dates = gold.dim_date(t.spark)

    def enriched(self):
        return gold.int_exports_enriched(
            staging.stg_senasa_certs(self.certs, measure=staging.EXACT), staging.stg_indec_exports(self.exports, measure=staging.EXACT))

    def history(self):
        first = settle(gold.snap_destination(self.certs, datetime(2024, 1, 1)), "snap")
        renamed = F.when(F.col("continente") == "AMERICA", "América").otherwise(F.col("continente"))
        later = self.certs.where(F.col("continente") != "AFRICA").withColumn("continente", renamed)
        return gold.snap_destination(later, datetime(2024, 2, 1), first)

    def destinations(self):
        return gold.dim_destination(self.history())

    def fact(self):
        return gold.fct_exports(self.enriched(), self.dates, self.destinations(), self.products, self.provinces)


@query("m6_int_exports_enriched", f"with {ENRICHED} select * from enriched")
def int_exports_enriched(t: Inputs):
    certs = staging.stg_senasa_certs(certs_frame(t), measure=staging.EXACT)
    return gold.int_exports_enriched(certs, staging.stg_indec_exports(exports_frame(t), measure=staging.EXACT))


@query(
    "m6_enriched_canonical",
    f"""with {STG_CERTS}, {EXPORTS},
    canon_certs as (select year, replace(province, 'ó', 'o') as province, replace(country, '_', ' ') as country, commodity, total_tn from stg_certs),
    canon_exports as (select year, replace(province, '_', ' ') as province, replace(country, '_', ' ') as country, fob_usd from exports),
    {spread_sql('canon_certs', 'canon_exports')} select * from enriched""",
)
def enriched_canonical(t: Inputs):
    """With canonical place keys the two sources meet in all provinces, not only in those spelled alike."""
    certs = staging.stg_senasa_certs(certs_frame(t), staging.place_key, staging.EXACT)
    exports = staging.stg_indec_exports(exports_frame(t), staging.place_key, staging.EXACT)
    return gold.int_exports_enriched(certs, exports)


@query("m7_dim_product", f"with {STG_CERTS}, {PRODUCTS} select * from products")
def dim_product(t: Inputs):
    return gold.dim_product(staging.stg_senasa_certs(certs_frame(t)))


@query(
    "m7_dim_product_keywords",
    f"""with {STG_CERTS}, {PRODUCTS}
    select product_key, commodity, case when commodity = 'grano de maní partido' then 'Oilseeds' else product_category end as product_category, commodity_english from products""",
)
def dim_product_keywords(t: Inputs):
    return gold.dim_product(staging.stg_senasa_certs(certs_frame(t)), keyword_match=True)


@query("m7_dim_province", f"with {STG_CERTS}, {PROVINCES} select * from provinces")
def dim_province(t: Inputs):
    return gold.dim_province(staging.stg_senasa_certs(certs_frame(t)))


@query("m8_snap_destination", f"with {CERTS}, {DESTINATIONS} select * from snap")
def snap_destination(t: Inputs):
    return Mart(t).history()


@query("m8_dim_destination", f"with {CERTS}, {DESTINATIONS} select * from destinations")
def dim_destination(t: Inputs):
    return Mart(t).destinations()


@query(
    "m9_dim_date",
    f"""with {STG_CERTS}, days as (select cast(d as date) as d from range(date '1993-01-01', date '2031-01-01', interval 1 day) as r(d)),
    issued as (select fecha, count(*) as n from certs group by 1)
    select cast(d as string) as date_key, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
      cast(week(d) as int) as week, concat(cast(year(d) as string), '-Q', cast(quarter(d) as string)) as year_quarter, coalesce(n, 0) as certificates
    from days left join issued on fecha = d
    """,
)
def dim_date(t: Inputs):
    """All days of the dimension, with the certificates issued on each."""
    issued = certs_frame(t).groupBy(F.col("fecha").alias("date_key")).agg(F.count("*").alias("certificates"))
    return gold.dim_date(t.spark).join(issued, "date_key", "left").fillna(0, ["certificates"])


@query("m10_fct_exports", f"with {FACT} select * from fact")
def fct_exports(t: Inputs):
    return Mart(t).fact()


def _expected_suite():
    """What the suite finds: the raw certificates have no missing product, but readings and codes have gaps."""
    rows = [(table, c, "not_null") for table, columns in suite.FILLED.items() for c in columns]
    rows += [(table, c, "unique") for table, columns in suite.UNIQUE.items() for c in columns]
    rows += [("dim_date", "quarter", "accepted_values"), ("dim_product", "product_category", "accepted_values")]
    rows += [("fct_exports", c, "relationships") for c in suite.PARENTS]
    values = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in rows)
    return f"""
    with {FACT}, expected as (select * from (values {values}) as v(table_name, "column", test)),
    found as (
      select 'fct_exports' as table_name, 'total_tn' as "column", 'not_null' as test, count(*) as failures from fact where total_tn is null
      union all select 'fct_exports', 'export_key', 'unique', count(*) from (select export_key from fact group by 1 having count(*) > 1) as u
      union all select 'dim_destination', 'continent', 'not_null', count(*) from destinations where continent is null)
    select e.table_name, e."column", e.test, cast(coalesce(failures, 0) as bigint) as failures,
      case when coalesce(failures, 0) = 0 then 'pass' else 'fail' end as status
    from expected e left join found f on e.table_name = f.table_name and e."column" = f."column" and e.test = f.test
    """


@query("m11_quality_suite", _expected_suite())
def quality_suite(t: Inputs):
    mart = Mart(t)
    destinations = settle(mart.destinations(), "dim_destination")
    fact = settle(gold.fct_exports(mart.enriched(), mart.dates, destinations, mart.products, mart.provinces), "fct_exports")
    indicators = settle(indicators_frame(t), "indicators")
    readings = settle(readings_frame(t), "readings")
    return suite.check_tables({
        "indec_exports": mart.exports,
        "senasa_certs": mart.certs,
        "worldbank_indicators": indicators,
        "weather_daily_readings": readings,
        "stg_indec_exports": mart.stg_exports,
        "stg_senasa_certs": mart.stg_certs,
        "stg_worldbank_prices": staging.stg_worldbank_prices(indicators),
        "stg_weather_readings": staging.stg_weather_readings(readings),
        "dim_date": mart.dates,
        "dim_product": mart.products,
        "dim_province": mart.provinces,
        "dim_destination": destinations,
        "fct_exports": fact,
    })


# ---------------------------------------------------------------- questions

@query(
    "k1_value_by_quarter",
    f"""with {STG_EXPORTS}, {CERTS},
    quarterly as (select cast(year(fecha) as int) as year, cast(quarter(fecha) as int) as quarter, lower(provincia) as province,
      lower(pais_destino) as country, lower(mercaderia_certificada) as commodity, cast(tn as double) as total_tn from certs),
    {spread_sql('quarterly', 'stg_exports', ', quarter')}
    select year, quarter, commodity, round(sum(fob_usd), 2) as fob_usd, sum(total_tn) as total_tn from enriched group by 1, 2, 3
    """,
)
def value_by_quarter(t: Inputs):
    certs = certs_frame(t).select(
        "year", F.quarter("fecha").alias("quarter"), normal_key("provincia").alias("province"),
        normal_key("pais_destino").alias("country"), normal_key("mercaderia_certificada").alias("commodity"),
        F.col("tn").alias("total_tn"),
    )
    values = questions.value_by_quarter(certs, staging.stg_indec_exports(exports_frame(t), measure=staging.EXACT))
    return values.withColumn("fob_usd", F.round("fob_usd", 2))


@query(
    "k2_volume_vs_indicator",
    f"""with {FACT}, {INDICATORS},
    volume as (select commodity, year, sum(total_tn) as tn from fact join products on fact.product_key = products.product_key group by 1, 2)
    select commodity, indicator_code, round(corr(tn, value), 6) as correlation, count(*) as n
    from volume join indicators on volume.year = indicators.year where country_code = 'ARG' group by 1, 2
    """,
)
def volume_vs_indicator(t: Inputs):
    mart = Mart(t)
    prices = staging.stg_worldbank_prices(indicators_frame(t))
    found = questions.volume_vs_indicator(mart.fact(), mart.products, prices)
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    "k3_leading_provinces",
    f"""with {FACT}, ranked as (
      select product_key, province_key, sum(fob_usd) as fob_usd,
        cast(rank() over (partition by product_key order by sum(fob_usd) desc nulls last) as int) as rank
      from fact group by 1, 2)
    select commodity, province, round(fob_usd, 2) as fob_usd, rank
    from ranked join products on ranked.product_key = products.product_key join provinces on ranked.province_key = provinces.province_key where rank <= 2
    """,
)
def leading_provinces(t: Inputs):
    mart = Mart(t)
    found = questions.leading_provinces(mart.fact(), mart.products, mart.provinces, k=2)
    return found.withColumn("fob_usd", F.round("fob_usd", 2))


@query(
    "k4_share_by_year",
    f"""with {FACT},
    yearly as (select year, destination_key, sum(fob_usd) as fob_usd from fact group by 1, 2),
    shares as (select year, destination_key, fob_usd / nullif(sum(fob_usd) over (partition by year), 0) as share from yearly)
    select country, year, round(share, 6) as share, round(share - lag(share) over (partition by shares.destination_key order by year), 6) as share_change
    from shares join destinations on shares.destination_key = destinations.destination_key
    """,
)
def share_by_year(t: Inputs):
    mart = Mart(t)
    found = questions.share_by_year(mart.fact(), mart.destinations())
    return found.withColumns({c: F.round(c, 6) for c in ("share", "share_change")})
