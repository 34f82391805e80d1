"""Most clicked products of each area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import area_level, joined_text, labelled_id, ownership_label, with_task_id
from clickloom.functions.columns import AREA_LEVELS, OTHER_AREA_LEVEL
from clickloom.operators.ranking import top_per_group

# Fixed value: products kept per area.
TOP_PRODUCTS = 3


def _product_clicks(actions: DataFrame) -> DataFrame:
    clicked = actions.where(F.col("click_product_id").isNotNull())
    return clicked.select("city_id", F.col("click_product_id").alias("product_id"))


def area_clicks(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Product clicks with the name and area of their city."""
    return _product_clicks(actions).join(cities, "city_id").select("city_id", "city_name", "area", "product_id")


def area_product_counts(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per area and product, with the list of cities they came from.

    Clicks are counted per city and product first, over the two ids alone; names, areas and
    the city list are attached to those counts, which are at most cities x products.
    """
    per_city = _product_clicks(actions).groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("clicks"))
    return (
        per_city.join(cities, "city_id")
        .groupBy("area", "product_id")
        .agg(
            F.sum("clicks").alias("click_count"),
            joined_text(F.collect_set(labelled_id(F.col("city_id"), F.col("city_name")))).alias("city_infos"),
        )
    )


def area_product_full(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Counts with product name and ownership; products without information drop out."""
    info = products.select(
        "product_id", "product_name", ownership_label(F.col("extend_info")).alias("product_status")
    )
    return counts.join(info, "product_id").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status"
    )


def area_top3_product(
    full: DataFrame,
    task_id: str,
    levels: Mapping[str, Sequence[str]] = AREA_LEVELS,
    other_level: str = OTHER_AREA_LEVEL,
    limit: int = TOP_PRODUCTS,
) -> DataFrame:
    """The most clicked products of each area, with the level of the area."""
    top = top_per_group(full, ["area"], [F.desc("click_count"), F.asc("product_id")], limit)
    return with_task_id(
        top.select(
            "area",
            area_level(F.col("area"), levels, other_level).alias("area_level"),
            "product_id",
            "city_infos",
            "click_count",
            "product_name",
            "product_status",
        ),
        task_id,
    )
