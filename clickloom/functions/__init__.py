"""Column expressions shared by the jobs; built-in functions only."""

from clickloom.functions.columns import (
    area_level,
    blank_to_null,
    clean_id,
    clean_time,
    half_up_ratio,
    joined_text,
    labelled_id,
    ownership_label,
)
from clickloom.functions.results import text_result, with_task_id

__all__ = [
    "area_level",
    "blank_to_null",
    "clean_id",
    "clean_time",
    "half_up_ratio",
    "joined_text",
    "labelled_id",
    "ownership_label",
    "text_result",
    "with_task_id",
]
