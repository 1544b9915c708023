"""The analytical questions the star schema is there for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.operators.allocate import apportion, share_of_total, sum_by
from siltline.operators.analytics import change_by_period, correlation_by, top_ranked
from siltline.operators.joins import fits_broadcast
from siltline.plans.gold import PLACE_YEAR
from siltline.session import settle


def value_by_quarter(certs: DataFrame, exports: DataFrame) -> DataFrame:
    """Value per product and quarter. ``certs``: year, quarter, province, country, commodity, total_tn;
    ``exports``: year, province, country, fob_usd. The annual value is spread over products and quarters."""
    detail = settle(sum_by(certs, [*PLACE_YEAR, "quarter", "commodity"], {"total_tn": "total_tn"}), "detail")
    spread = apportion(detail, exports, PLACE_YEAR, "total_tn", "fob_usd", "fob_usd", "total_fob_usd")
    return sum_by(spread, ["year", "quarter", "commodity"], {"fob_usd": "fob_usd", "total_tn": "total_tn"})


def volume_vs_indicator(fact: DataFrame, product: DataFrame, indicators: DataFrame) -> DataFrame:
    """Correlation of each product's yearly tonnes with each indicator. A year is a coarse key: the indicators are measured
    and, if they are few, broadcast, so that the yearly tonnes stay where they are and sums combine in the map tasks."""
    yearly = sum_by(fact, ["product_key", "year"], {"total_tn": "total_tn"})
    volume = yearly.join(product.select("product_key", "commodity"), "product_key")
    known = settle(indicators.select("indicator_code", "year", "indicator_value"), "indicators")
    paired = volume.join(F.broadcast(known) if fits_broadcast(known) else known, "year")
    return correlation_by(paired, ["commodity", "indicator_code"], "total_tn", "indicator_value")


def leading_provinces(fact: DataFrame, product: DataFrame, province: DataFrame, k: int = 3) -> DataFrame:
    """The provinces with the highest value of each product."""
    volume = sum_by(fact, ["product_key", "province_key"], {"fob_usd": "fob_usd"})
    best = top_ranked(volume, ["product_key"], [F.col("fob_usd").desc_nulls_last()], k)
    named = best.join(product.select("product_key", "commodity"), "product_key")
    return named.join(province.select("province_key", "province"), "province_key").select(
        "commodity", "province", "fob_usd", "rank"
    )


def share_by_year(fact: DataFrame, destination: DataFrame) -> DataFrame:
    """Each destination's share of the year's value and its change against the year before."""
    yearly = settle(sum_by(fact, ["year", "destination_key"], {"fob_usd": "fob_usd"}), "yearly")
    shares = share_of_total(yearly, ["year"], "fob_usd", "share", "year_total")
    moved = change_by_period(shares, ["destination_key"], "year", "share", "share_change")
    return moved.join(destination.select("destination_key", "country"), "destination_key").select(
        "country", "year", "share", "share_change"
    )
