"""Running values over ordered groups, without ever needing a whole group in one task.

A window puts each group into one task. That is the best plan while groups are small, and
hopeless when one scan holds a third of all rows. So one job looks at the columns of key and order:
rows fall into a fixed number of hash buckets, and the row of smallest hash in each is a uniform
sample. Its quantiles within the large groups are bounds, written into the plan as literals, that cut
these groups into slices. A value is the local one inside the slice combined with what the slices
before carry over, and only slices that have one before in their group get a carry: fewer rows than
bounds. Rows are shuffled once, for the local values. Nothing is written.

Bounds are values, so a lost task that is redone cuts at the same places.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_GROUP_ROWS = 5_000_000
SAMPLE_ROWS = 4096
MAX_SLICES = 256
_FAN = 16

# kinds of running value
ROW_NUMBER, SUM, PEAK, PEAK_BEFORE, PREVIOUS = "row_number", "sum", "peak", "peak_before", "previous"

def _unused(df: DataFrame, name: str) -> str:
    """``name``, or with more underscores where the caller has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[str, Column | None]],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add one column per entry of ``values``: name -> (kind, input column).

    ``order`` must be unique within a key. Sums are of whole numbers or decimals: a sum of floating
    numbers would depend on the route. ``df`` has to give the same rows whenever it is computed.
    """
    for name, (kind, col) in values.items():
        if kind == SUM and df.select(col.alias("v")).schema["v"].dataType.typeName() in (
                "float", "double"):
            raise ValueError(f"{name}: running sums need whole numbers or decimals")
    ins = {name: _unused(df, f"_in_{name}") for name, (_, col) in values.items() if col is not None}
    kinds = {name: kind for name, (kind, _) in values.items()}
    prepared = df.withColumns({ins[n]: values[n][1] for n in ins}) if ins else df
    slice_of = slice_number(df, keys, order, max_group_rows)
    if slice_of is None:
        result = prepared.withColumns(_local_values(kinds, ins, keys, order))
    else:
        result = _across_slices(prepared, keys, order, kinds, ins, slice_of)
    return result.select(*df.columns, *values)


# --- slices --------------------------------------------------------------------------------------

def _point(df: DataFrame, columns: list[str]) -> tuple[Column, T.StructType]:
    """Key and order as one value that can be compared, and its type."""
    point = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    return point, df.select(point.alias("p")).schema["p"].dataType


def _sample(df: DataFrame, keys: list[str], order: list[str]) -> tuple[int, list[tuple[str, str]]]:
    """All rows counted, and (key, point) of about SAMPLE_ROWS of them in order, as JSON.

    One job over the columns of key and order. The smallest hashes, at most SAMPLE_ROWS of them, are
    broadcast to find their rows.
    """
    columns = [*keys, *order]
    point, _ = _point(df, columns)
    narrow = df.select(
        F.xxhash64(*columns).alias("h"), point.alias("p"),
        F.struct(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keys)]).alias("k"))
    least = narrow.groupBy(F.pmod("h", F.lit(SAMPLE_ROWS)).alias("bucket")).agg(
        F.min("h").alias("h"), F.count(F.lit(1)).alias("n"))
    # Zone-less times keep all their digits; what a bound loses otherwise does no harm.
    exact = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    found = (
        narrow.join(F.broadcast(least), "h").dropDuplicates(["bucket"])
        .agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("p", "k"))).alias("s"))
        .select("total", F.transform("s", lambda r: F.struct(
            F.to_json(r["k"], exact).alias("k"), F.to_json(r["p"], exact).alias("p"))).alias("s"))
        .first())
    return found["total"] or 0, [(r["k"], r["p"]) for r in found["s"]]


def slice_number(
    df: DataFrame, keys: list[str], order: list[str], max_group_rows: int,
) -> Column | None:
    """Which slice of its group a row lies in; None while no group needs slices."""
    total, sample = _sample(df, keys, order)
    sizes = Counter(key for key, _ in sample)
    if total <= max_group_rows or not sizes:
        return None
    per_row = total / len(sample)
    large = {k: n for k, n in sizes.items() if n * per_row > max_group_rows}
    if not large:
        return None
    wanted = sum(math.ceil(2 * n * per_row / max_group_rows) for n in large.values())
    share = min(1.0, MAX_SLICES / wanted)
    points_of = defaultdict(list)
    for key, p in sample:
        points_of[key].append(p)
    bounds, left = [], MAX_SLICES
    for key, n in sorted(large.items(), key=lambda group: -group[1]):
        # The largest come first: by the sample, one left whole has at most 2 / MAX_SLICES of all rows.
        if left < 2:
            break
        points = points_of[key]
        slices = min(left, max(2, min(n, int(share * math.ceil(2 * n * per_row / max_group_rows)))))
        bounds += [points[n * i // slices] for i in range(1, slices)]
        left -= slices
    chosen = set(bounds)
    in_order = [p for _, p in sample if p in chosen]
    point, kind = _point(df, [*keys, *order])
    return _bracket(point, kind, in_order)


def _bracket(point: Column, kind: T.StructType, bounds: list[str]) -> Column:
    """How many of the bounds (JSON, in order) are not above the point: the coarse ones first."""
    def literal(some: list[str]) -> Column:
        return F.from_json(F.lit(f"[{','.join(some)}]"), T.ArrayType(kind))

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= point))

    if len(bounds) <= _FAN:
        return below(literal(bounds))
    coarse = below(literal(bounds[_FAN - 1::_FAN])) * _FAN
    return coarse + below(F.slice(literal(bounds), coarse + 1, _FAN))


# --- values --------------------------------------------------------------------------------------

def _local_values(
    kinds: dict[str, str], ins: dict[str, str], keys: list[str], order: list[str],
) -> dict[str, Column]:
    window = Window.partitionBy(*keys).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    build = {
        ROW_NUMBER: lambda _: F.row_number().over(window).cast("bigint"),
        SUM: lambda col: F.sum(col).over(so_far),
        PEAK: lambda col: F.max(col).over(so_far),
        PEAK_BEFORE: lambda col: F.max(col).over(earlier),
        PREVIOUS: lambda col: F.lag(col).over(window),
    }
    return {name: build[kind](ins.get(name)) for name, kind in kinds.items()}


def _across_slices(
    df: DataFrame, keys: list[str], order: list[str], kinds: dict[str, str], ins: dict[str, str],
    slice_of: Column,
) -> DataFrame:
    cut, turn = _unused(df, "_slice"), _unused(df, "_row")
    sliced = df.withColumn(cut, slice_of)
    local = sliced.withColumns({
        **_local_values(kinds, ins, [*keys, cut], order),
        turn: F.row_number().over(Window.partitionBy(*keys, cut).orderBy(*order))})

    summarise = {
        ROW_NUMBER: lambda _: F.count(F.lit(1)),
        SUM: F.sum,
        PEAK: F.max,
        PEAK_BEFORE: F.max,
        PREVIOUS: lambda col: F.max_by(col, F.struct(*order)),
    }
    own = {name: _unused(df, f"_own_{name}") for name in kinds}
    carry = {name: _unused(df, f"_carry_{name}") for name in kinds}
    named = {key: _unused(df, f"_key_{key}") for key in [*keys, cut]}
    per_slice = sliced.groupBy(*keys, cut).agg(
        *[summarise[kind](ins.get(name)).alias(own[name]) for name, kind in kinds.items()])
    across = Window.partitionBy(*keys).orderBy(cut)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    gather = {
        ROW_NUMBER: lambda col: F.sum(col).over(earlier),
        SUM: lambda col: F.sum(col).over(earlier),
        PEAK: lambda col: F.max(col).over(earlier),
        PEAK_BEFORE: lambda col: F.max(col).over(earlier),
        PREVIOUS: lambda col: F.lag(col).over(across),
    }
    # A slice with one before it in its group begins at a bound, so there are fewer than MAX_SLICES.
    carried = per_slice.withColumn(turn, F.row_number().over(across)).select(
        F.col(turn).alias(_unused(df, "_turn")),
        *[F.col(k).alias(alias) for k, alias in named.items()],
        *[gather[kind](own[name]).alias(carry[name]) for name, kind in kinds.items()],
    ).where(F.col(_unused(df, "_turn")) > 1)

    same_slice = F.lit(True)
    for key, alias in named.items():
        same_slice = same_slice & F.col(key).eqNullSafe(F.col(alias))
    combine = {
        ROW_NUMBER: lambda mine, before: mine + F.coalesce(before, F.lit(0)),
        SUM: lambda mine, before: F.when(mine.isNull(), before).otherwise(
            mine + F.coalesce(before, F.lit(0))
        ),
        PEAK: F.greatest,
        PEAK_BEFORE: F.greatest,
        # The first row of a slice that begins a group has nothing before it, and no carry.
        PREVIOUS: lambda mine, before: F.when(F.col(turn) == 1, before).otherwise(mine),
    }
    return local.join(F.broadcast(carried), same_slice, "left").withColumns(
        {name: combine[kind](F.col(name), F.col(carry[name])) for name, kind in kinds.items()}
    )
