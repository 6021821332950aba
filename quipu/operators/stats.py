"""Association of features with the target, category values, scaling."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.operators.encode import Dictionary, distinct_values
from quipu.session import materialize

INLINE_BYTES = 4 * 1024 * 1024  # values in the document itself; longer ones are pages beside it
PAGE_VALUES = 16_384
ROWS_PER_VALUE = 5


def category_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct values of each column, one row per value."""
    return distinct_values(df, columns)


def inline_columns(dictionary: Dictionary, columns: list[str], limit: int = INLINE_BYTES) -> list[str]:
    """Those of the columns, smallest first, whose values together stay within ``limit`` bytes."""
    total, found = 0, []
    for c in sorted(columns, key=lambda c: (dictionary.sizes[c][1] or 0, c)):
        total += dictionary.sizes[c][1] or 0
        if total <= limit:
            found.append(c)
    return found


def category_map(dictionary: Dictionary, columns: list[str]) -> DataFrame:
    """The sorted values of each column as one array, for a description.

    An array is held by one task, so this is for columns of few values, see
    :func:`inline_columns`; the others are described by :func:`category_pages`.
    """
    rows = dictionary.rows.filter(F.col("column").isin(columns))
    return rows.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values"))


def category_pages(dictionary: Dictionary, columns: list[str], page_values: int = PAGE_VALUES) -> DataFrame:
    """``(column, page, values)``: the sorted values of each column, at most ``page_values`` in a row."""
    rows = dictionary.rows.filter(F.col("column").isin(columns))
    page = F.floor(F.col("code") / page_values).alias("page")
    return rows.groupBy("column", page).agg(F.sort_array(F.collect_list("value")).alias("values"))


def correlation_with_target(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """``(feature, correlation)``, ascending; Pearson's over the rows with both values.

    The features are stacked and aggregated per name, so the generated code does
    not grow with their number; only one small row per feature and task is
    shuffled.  Null where a column is constant: ``corr`` would divide by zero.
    """
    x, y = F.col("x"), F.col("_y")
    values = [F.col(c).cast("double").alias(c) for c in features]
    long = df.select(F.col(target).cast("double").alias("_y"), *values).unpivot("_y", features, "feature", "x")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    ratio = F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
    report = long.groupBy("feature").agg(ratio.alias("correlation"))
    return report.orderBy(F.col("correlation").asc_nulls_last(), "feature")


def bin_edges(df: DataFrame, columns: list[str], bins: int, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Inner edges of equal-frequency bins, from one aggregation for all columns."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def bin_number(column: str, edges: list[float]) -> Column:
    """How many edges lie below the value: ``bins - 1`` of them at most."""
    value = F.col(column).cast("double")
    below = [(value > F.lit(edge)).cast("int") for edge in edges]
    return F.when(value.isNotNull(), reduce(add, below, F.lit(0)))


def information_gain(
    df: DataFrame,
    features: list[str],
    target: str,
    numeric: list[str] | None = None,
    bins: int = 32,
    accuracy: int = 10_000,
) -> DataFrame:
    """``(feature, information_gain)`` in nats, ascending.

    Mutual information of the observed table of counts.  Columns in ``numeric``, by
    default those of a fractional type and whole numbers of fewer than
    ``ROWS_PER_VALUE`` rows a value (keys, amounts), are cut into bins of equal frequency
    first; a table of counts with hardly a row per cell tells nothing.  With ``n_xy`` rows per value and
    class, ``n_x`` per value and ``n_y`` per class, the gain is
    ``(sum n_xy ln n_xy - sum n_x ln n_x - sum n_y ln n_y + n ln n) / n``, so
    nothing has to be joined back to the counts.
    """
    if numeric is None:
        numeric = [c for c in features if isinstance(df.schema[c].dataType, T.FractionalType)]
        numeric += _thin(df, [c for c in features if isinstance(df.schema[c].dataType, T.IntegralType)])
    edges = bin_edges(df, numeric, bins, accuracy) if numeric else {}
    values = [
        (bin_number(c, edges[c]) if c in edges else F.col(c)).cast("string").alias(c) for c in features
    ]
    long = df.select(F.col(target).alias("_y"), *values).unpivot("_y", features, "feature", "value")
    cells = long.filter(F.col("value").isNotNull() & F.col("_y").isNotNull())
    # Both margins are summed from the counts, so the table itself is read once.
    cells = materialize(cells.groupBy("feature", "value", "_y").agg(F.count(F.lit(1)).alias("n")), "counts")

    def weighed(n: str) -> Column:
        return F.sum(F.col(n) * F.ln(F.col(n).cast("double")))

    by_value = (
        cells.groupBy("feature", "value")
        .agg(F.sum("n").alias("n_x"), weighed("n").alias("cells"))
        .groupBy("feature")
        .agg(F.sum("n_x").alias("n"), F.sum("cells").alias("cells"), weighed("n_x").alias("values"))
    )
    by_class = (
        cells.groupBy("feature", "_y").agg(F.sum("n").alias("n_y")).groupBy("feature").agg(weighed("n_y").alias("classes"))
    )
    total = F.col("n") * F.ln(F.col("n").cast("double"))
    gain = (F.col("cells") - F.col("values") - F.col("classes") + total) / F.col("n")
    # One row per feature on both sides.
    report = by_value.join(F.broadcast(by_class), "feature")
    report = report.select("feature", F.greatest(gain, F.lit(0.0)).alias("information_gain"))
    return report.orderBy("information_gain", "feature")


def _thin(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns with few rows per distinct value, counted approximately in one pass."""
    if not columns:
        return []
    found = df.agg(*[F.struct(F.count(c).alias("n"), F.approx_count_distinct(c, 0.02).alias("d")).alias(c) for c in columns]).first()
    return [c for c in columns if found[c]["n"] < ROWS_PER_VALUE * found[c]["d"]]


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, mean, std)`` with the population standard deviation."""
    one_row = df.agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns]
    )
    return one_row.unpivot([], columns, "column", "_s").select("column", "_s.mean", "_s.std")


def standardize(df: DataFrame, columns: list[str], stats: DataFrame | None = None) -> DataFrame:
    """``(value - mean) / std`` in place; a constant column is only centred.

    The statistics, one row per column, are read once and become constants of
    the plan.
    """
    rows = (scaler_stats(df, columns) if stats is None else stats).collect()
    found = {r["column"]: (r["mean"], r["std"]) for r in rows}

    def scaled(c: str) -> Column:
        mean, std = found[c]
        return (F.col(c) - F.lit(mean)) / F.lit(std if std else 1.0)

    return df.withColumns({c: scaled(c) for c in columns})
