"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The level of each area, and the level of any other area.
AREA_LEVELS = {
    "A Level": ["华北", "华东"],
    "B Level": ["华南", "华中"],
    "C Level": ["西北", "西南"],
}
OTHER_AREA_LEVEL = "D Level"

# Ownership labels by the product status in the extra information.
SELF_STATUS = "0"
SELF_LABEL = "Self"
THIRD_PARTY_LABEL = "Third Party"

# Fixed value: time pattern of the action log; hours need not be padded.
ACTION_TIME_PATTERN = "yyyy-MM-dd H:m:s"


def blank_to_null(column: Column) -> Column:
    """NULL for empty or all-space text, else the trimmed text."""
    return F.nullif(F.trim(column), F.lit(""))


def clean_id(column: Column) -> Column:
    """A log id as bigint; blank, unreadable and the "absent" mark -1 become NULL."""
    number = F.nullif(F.trim(column.cast("string")), F.lit("")).try_cast("bigint")
    return F.nullif(number, F.lit(-1).cast("bigint"))


def clean_time(column: Column) -> Column:
    """URL-encoded time text as a timestamp; unreadable text becomes NULL."""
    return F.try_to_timestamp(F.try_url_decode(F.trim(column)), F.lit(ACTION_TIME_PATTERN))


def half_up_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator of two counts, rounded half up to 2 digits.

    Integer arithmetic up to the last step, so that every engine gives the same
    double. A zero denominator gives NULL.
    """
    base = F.nullif(denominator.cast("bigint"), F.lit(0).cast("bigint"))
    hundredths = F.call_function("div", numerator.cast("bigint") * 200 + base, base * 2)
    return hundredths.cast("double") / F.lit(100.0)


def joined_text(items: Column, separator: str = ",") -> Column:
    """The distinct items of an array, sorted, as one text."""
    return F.array_join(F.array_sort(F.array_distinct(items)), separator)


def labelled_id(identifier: Column, name: Column) -> Column:
    """``id:name`` text."""
    return F.concat_ws(":", identifier.cast("string"), name)


def ownership_label(extend_info: Column) -> Column:
    """Who sells a product, from the (possibly URL-encoded) JSON with its status."""
    text = F.coalesce(F.try_url_decode(extend_info), extend_info)
    status = F.get_json_object(text, "$.product_status")
    return F.when(status == SELF_STATUS, SELF_LABEL).otherwise(THIRD_PARTY_LABEL)


def area_level(
    area: Column,
    levels: Mapping[str, Sequence[str]] = AREA_LEVELS,
    other: str = OTHER_AREA_LEVEL,
) -> Column:
    """The level whose list of areas has this area."""
    label = None
    for level, areas in levels.items():
        matches = area.isin(list(areas))
        label = F.when(matches, level) if label is None else label.when(matches, level)
    return F.lit(other) if label is None else label.otherwise(other)
