"""Equi-joins of many rows with one row per key, safe when a single key holds most rows.

Adaptive execution splits a hot key only where both join inputs come straight from a shuffle. A
side that was aggregated by the join key does not, so the rows of every key are dealt over a fixed
number of ways here. A lookup row is copied to the ways its key uses, which are found by a distinct
that combines before its shuffle: a key with few rows costs few copies. Nothing is measured or
broadcast by force, and no job runs while the query is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WAYS = 64

_WAY = "_way"
_NOT_HASHABLE = (T.MapType, T.VariantType, T.StructType, T.ArrayType)


def way(rows: DataFrame, ways: int = WAYS) -> Column:
    """Where a row goes among the rows of its key: by its other plain columns, so that a repeated
    task sends it there again."""
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, _NOT_HASHABLE)]
    return F.pmod(F.xxhash64(*plain), F.lit(ways)).cast("int")


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner", ways: int = WAYS,
) -> DataFrame:
    """``rows.join(lookup, keys, how)`` for inner, left, left_semi and left_anti joins.

    ``lookup`` holds each key at most once. At most 1 / ``ways`` of a key's rows meet in one task.
    """
    at = _WAY
    while at in rows.columns or at in lookup.columns:
        at = f"_{at}"
    dealt = rows.withColumn(at, way(rows, ways))
    used = dealt.select(*keys, at).distinct()
    facts = [c for c in lookup.columns if c not in keys]
    copies = used.join(lookup, keys).select(*keys, at, *facts)
    return dealt.join(copies, [*keys, at], how).drop(at)
