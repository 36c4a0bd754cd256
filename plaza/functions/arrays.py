"""Small helpers on maps and arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once. Inside a lambda Spark does not
    share common subexpressions; the variable of a ``transform`` does."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unnest(df: DataFrame, kept: Sequence[str | Column], items: Column, name: str, pos: str | None = None) -> DataFrame:
    """One row per element (elements are not null), optionally with its position.

    From an inner explode Spark infers ``size(items) > 0`` below it and works
    the items out a second time; from the outer form it does not.
    """
    if pos:
        out = df.select(*kept, F.posexplode_outer(items).alias(pos, name))
    else:
        out = df.select(*kept, F.explode_outer(items).alias(name))
    return out.filter(F.col(name).isNotNull())


def map_get(m: Column, key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(m, key), default)


def or_empty(items: Column, element: str = "int") -> Column:
    return F.coalesce(items, F.array().cast(f"array<{element}>"))
