"""Expressions over skill lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hireflow.functions.text import clean, strip


def list_from_json(col: Column) -> Column:
    """Elements of a JSON list given as text; NULL when the text is no list."""
    return F.when(col.startswith("["), F.from_json(col, "array<string>"))


def list_to_csv(col: Column) -> Column:
    """A nested list becomes comma text, a scalar stays as it is."""
    return F.coalesce(F.array_join(list_from_json(col), ","), col)


def order_free_csv(col: Column) -> Column:
    """Trimmed and sorted, so that reordering the list does not change a hash over it."""
    items = F.coalesce(list_from_json(col), F.split(col, ","))
    return F.array_join(F.array_sort(F.transform(items, strip)), ",")


def sorted_items(col: Column) -> Column:
    """Comma text to a trimmed, ascending list."""
    return F.array_sort(F.transform(F.split(col, ","), clean))


def item_count(col: Column) -> Column:
    """Length of a list, 0 when it is missing."""
    return F.when(col.isNull(), F.lit(0)).otherwise(F.size(col)).cast("bigint")
