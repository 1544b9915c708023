from datetime import datetime

import pytest

from siltline.plans import gold, questions, staging, suite
from siltline.plans.constants import PRODUCT_CATEGORIES, PRODUCT_NAMES, STATIONS
from tests.conftest import tuples

CERTS = (
    "fecha date, provincia string, pais_destino string, pais_destino_id_iso_3166_1 string, continente string, "
    "mercaderia_certificada string, tn decimal(18,4), year int, month int"
)


@pytest.fixture(scope="module")
def silver(frame):
    from datetime import date
    from decimal import Decimal as D

    certs = frame(
        CERTS,
        (date(2020, 1, 5), " Córdoba ", "CHINA", "CN", "Asia", "Soja", D("30"), 2020, 1),
        (date(2020, 5, 5), "Córdoba", "China", "CN", "Asia", "Trigo", D("10"), 2020, 5),
        (date(2021, 5, 5), "Salta", "China", "CN", "Asia", "Grano de Maní Partido", D("8"), 2021, 5),
        (date(2021, 6, 5), "Salta", "Chile", None, None, "Soja", None, 2021, 6),
        (date(2021, 7, 5), "Salta", "Macao", "MO", "Asia", "soja", D("5"), 2021, 7),
    )
    exports = frame("year int, province string, country string, fob_usd decimal(18,4)", (2020, "córdoba", "china", D("400")), (2021, "salta", "macao", D("9")), (2021, "salta", "peru", D("7")))
    return certs, exports


def test_star(spark, silver):
    certs, exports = staging.stg_senasa_certs(silver[0]), staging.stg_indec_exports(silver[1])
    enriched = gold.int_exports_enriched(certs, exports)
    assert tuples(enriched, "year", "country", "commodity", "total_tn", "fob_usd", "total_fob_usd") == [
        (2020, "china", "soja", 30.0, 300.0, 400.0), (2020, "china", "trigo", 10.0, 100.0, 400.0),
        (2021, "chile", "soja", None, None, 0.0), (2021, "china", "grano de maní partido", 8.0, 0.0, 0.0),
        (2021, "macao", "soja", 5.0, 9.0, 9.0)]
    product, province, dates = gold.dim_product(certs), gold.dim_province(certs), gold.dim_date(spark)
    assert tuples(product, "commodity", "product_category", "commodity_english") == [
        ("grano de maní partido", "Other", "grano de maní partido"), ("soja", "Oilseeds", "Soybean"), ("trigo", "Grains", "Wheat")]
    assert ("grano de maní partido", "Oilseeds") in tuples(gold.dim_product(certs, keyword_match=True), "commodity", "product_category")
    assert tuples(province, "province", "is_pampa_region", "main_crop") == [("córdoba", True, "soybean"), ("salta", False, "tobacco")]
    destination = gold.dim_destination(gold.snap_destination(silver[0], datetime(2024, 1, 1)))
    assert tuples(destination, "country_iso2", "country", "continent") == [("CN", "china", "asia"), ("MO", "macao", "asia")]
    fact = gold.fct_exports(enriched, dates, destination, product, province)
    assert fact.count() == 5 and fact.where("date_key is null").count() == 0 and fact.where("destination_key is null").count() == 1
    results = suite.check_tables({"dim_date": dates, "dim_product": product, "dim_province": province, "dim_destination": destination, "fct_exports": fact})
    assert tuples(results.where("status = 'fail'"), "table_name", "column", "failures") == [("fct_exports", "total_tn", 1)]
    leaders = questions.leading_provinces(fact, product, province, k=1)
    assert ("soja", "córdoba", 300.0, 1) in tuples(leaders)
    shares = questions.share_by_year(fact, destination)
    assert ("macao", 2021, 1.0, None) in tuples(shares)


def test_two_codes_of_one_name_fan_out(spark, silver, frame):
    certs, exports = staging.stg_senasa_certs(silver[0]), staging.stg_indec_exports(silver[1])
    destination = frame("destination_key string, country_iso2 string, country string, continent string", ("1", "CN", "china", "asia"), ("2", "HK", "china", "asia"))
    parts = gold.dim_date(spark), destination, gold.dim_product(certs), gold.dim_province(certs)
    enriched = gold.int_exports_enriched(certs, exports)
    assert gold.fct_exports(enriched, *parts).count() == 8
    assert gold.fct_exports(enriched, *parts, destination_duplicates="first").count() == 5


def test_place_keys_join_the_sources(silver, frame):
    certs = staging.stg_senasa_certs(silver[0], staging.place_key)
    exports = staging.stg_indec_exports(frame("year int, province string, country string, fob_usd double", (2020, "cordoba", "china", 4.0)), staging.place_key)
    assert (2020, "cordoba", "soja", 3.0) in tuples(gold.int_exports_enriched(certs, exports), "year", "province", "commodity", "fob_usd")


def test_fixed_values():
    assert {k: len(v) for k, v in PRODUCT_CATEGORIES.items()} == {"Oilseeds": 5, "Grains": 7, "Livestock": 6, "Citrus": 4, "Fruits": 6}
    assert len(PRODUCT_NAMES) == 23 and len(STATIONS) == 7
    kinds = [c.kind for c in suite.export_suite().checks]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values"), kinds.count("relationships")) == (48, 7, 2, 3)


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_sums_are_exact_in_any_order(spark, frame, partitions):
    from datetime import date
    from decimal import Decimal as D

    certs = frame(CERTS, *((date(2020, 1, 1 + i), "Salta", "Peru", "PE", "America", ("soja", "trigo")[i % 2], D("0.1"), 2020, 1) for i in range(6)))
    exports = frame("year int, province string, country string, fob_usd decimal(18,4)", *[(2020, "salta", "peru", D("0.1"))] * 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        enriched = gold.int_exports_enriched(staging.stg_senasa_certs(certs.repartition(3), measure=staging.EXACT), staging.stg_indec_exports(exports, measure=staging.EXACT))
        assert tuples(enriched, "commodity", "total_tn", "fob_usd", "total_fob_usd") == [("soja", 0.3, 0.15, 0.3), ("trigo", 0.3, 0.15, 0.3)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
