"""Running computations over an order, without one task holding all rows.

A long run is cut into ranges of the order column.  Each range is worked on by its own
window, and what the ranges before it contribute comes from one small row per range.
Ranges are found in levels: a level cuts every range of the level above into at most
``FAN`` parts, so there is no highest number of them.  The table of range totals is cut
the same way, so no window over it holds more than ``FAN`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.operators.joins import lookup_join
from quipu.session import materialize

ROWS_PER_RANGE = 1_000_000
FAN = 1_024

#: How totals are added up within a window, and two of them to one.
COMBINE = {
    "max": (F.max, F.greatest),  # both skip nulls
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
}


def with_ranges(
    df: DataFrame, order: str, by: list[str] | None = None, rows_per_range: int = ROWS_PER_RANGE, fan: int = FAN
) -> tuple[DataFrame, list[str]]:
    """Add the range of ``order`` a row falls in, level by level; and the names of these columns.

    The edges are approximate quantiles, of the rows of one ``by`` where it is given, so the
    ranges are of like size; equal values share a range, and ``order`` is numeric.  Edges
    are one row per range of the level above, joined by its path.  Few rows get no range.
    """
    by = by or []
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.max("n")).first()[0] or 0
    place = F.col(order).cast("double")
    path: list[str] = []
    while rows > rows_per_range:
        parts = min(fan, -(-rows // rows_per_range))
        shares = [i / parts for i in range(1, parts)]
        keys = [*by, *path]
        edges = df.groupBy(*keys).agg(F.percentile_approx(place, shares, 20 * parts).alias("_edges"))
        level = f"_range_{len(path)}"
        if keys:
            joined = lookup_join(df, materialize(edges, "range-edges"), keys)
        else:
            joined = df.withColumn("_edges", F.lit(edges.first()["_edges"] or []).cast("array<double>"))
        df = _edges_up_to(joined, "_edges", place, parts, level).drop("_edges")
        path.append(level)
        rows = -(-rows // parts)
    return df, path


def _edges_up_to(df: DataFrame, edges: str, place: Column, parts: int, out: str) -> DataFrame:
    """Add how many of the ascending edges are at most ``place``, by halving; 0 for a null.

    A step of the halving is a column: generated code, where a function over arrays is interpreted.
    """
    df = df.withColumn(out, F.lit(0))
    for b in reversed(range(parts.bit_length())):
        further = F.col(out) + F.lit(1 << b)
        df = df.withColumn(out, F.when(F.get(edges, further - 1) <= place, further).otherwise(F.col(out)))
    return df


def before(totals: DataFrame, group: list[str], path: list[str], values: list[str], combine: str) -> DataFrame:
    """For each range of a group, what its earlier ranges come to; null where there are none.

    ``totals`` has one row per group and path; ranges of one range of the level above are
    summed in a window, and that range's own earlier ones by the same step one level up.
    """
    whole, pair = COMBINE[combine]
    *above, last = path
    earlier = Window.partitionBy(*group, *above).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    found = totals.select(*group, *path, *[whole(v).over(earlier).alias(v) for v in values])
    if not above:
        return found
    wider = totals.groupBy(*group, *above).agg(*[whole(v).alias(v) for v in values])
    carried = before(wider, group, above, values, combine)
    carried = carried.select(*group, *above, *[F.col(v).alias(f"_above_{v}") for v in values])
    joined = found.join(carried, [*group, *above])
    return joined.select(*group, *path, *[pair(F.col(v), F.col(f"_above_{v}")).alias(v) for v in values])


def placed(df: DataFrame, order: list[Column], sums: dict[str, str] | None = None, out: str = "place") -> DataFrame:
    """Add the number from 1 that a row has by ``order``, of columns of any type, and running sums.

    ``sums`` maps new to old columns; a sum holds the row's own value.  The rows are
    range-partitioned, sorted and written with their place in their partition; one row per
    partition then says how much stands before it.  ``order`` must tell the rows apart.
    """
    sums = sums or {}
    within = F.lit((1 << 33) - 1)  # monotonically_increasing_id keeps the row in the low 33 bits
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND(within) + 1})
    rows = materialize(rows, "placed")
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(old).alias(f"_all_{new}") for new, old in sums.items()])
    # One row per task that sorted.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    upto = {f"_upto_{c}": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in parts.columns if c != "_part"}
    starts = parts.withColumns(upto).select("_part", *upto)
    local = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({f"_sum_{new}": F.sum(old).over(local) for new, old in sums.items()})
    joined = summed.join(F.broadcast(starts), "_part")
    found = {out: F.col("_row") + F.col("_upto__rows"), **{new: F.col(f"_sum_{new}") + F.col(f"_upto__all_{new}") for new in sums}}
    return joined.select(*df.columns, *[value.alias(name) for name, value in found.items()])


def running_max_before(
    df: DataFrame,
    order: str,
    values: dict[str, str],
    by: list[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
    fan: int = FAN,
) -> DataFrame:
    """Add, per row, the highest earlier value: ``values`` maps new to old columns."""
    ranged, path = with_ranges(_grouped(df, by), order, None, rows_per_range, fan)
    key = ["_group", *path]
    earlier = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({new: F.max(old).over(earlier) for new, old in values.items()})
    if not path:
        return local.select(*df.columns, *values)
    tops = ranged.groupBy(*key).agg(*[F.max(old).alias(new) for new, old in values.items()])
    carried = before(tops, ["_group"], path, list(values), "max")
    carried = carried.select(*key, *[F.col(new).alias(f"_from_{new}") for new in values])
    joined = local.join(carried, key, "left")
    # greatest() skips nulls
    merged = {new: F.greatest(F.col(new), F.col(f"_from_{new}")) for new in values}
    return joined.withColumns(merged).select(*df.columns, *values)


def numbered(
    df: DataFrame,
    order: str,
    by: list[str] | None = None,
    out: str = "row_number",
    rows_per_range: int = ROWS_PER_RANGE,
    fan: int = FAN,
) -> DataFrame:
    """Add the row number from 1 within each group, by ascending ``order``."""
    ranged, path = with_ranges(_grouped(df, by), order, None, rows_per_range, fan)
    key = ["_group", *path]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(order)).cast("long")
    local = ranged.withColumn(out, place)
    if not path:
        return local.select(*df.columns, out)
    sizes = ranged.groupBy(*key).agg(F.count(F.lit(1)).alias("_start"))
    starts = before(sizes, ["_group"], path, ["_start"], "sum")
    joined = local.join(starts, key, "left")
    return joined.withColumn(out, F.col(out) + F.coalesce("_start", F.lit(0))).select(*df.columns, out)


def _grouped(df: DataFrame, by: list[str] | None) -> DataFrame:
    """Add the group as one text that is never null.

    Windows and joins then have the same plain key, so the rows are shuffled once; a
    very large group is spread over its ranges.
    """
    return df.withColumn("_group", F.to_json(F.struct(*by)) if by else F.lit(""))
