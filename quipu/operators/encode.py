"""Value dictionaries and the codes they give to text columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.operators.clean import text_columns
from quipu.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, HOT_SHARE, JOINS_A_STEP, ROW_BYTES, apart, hot_keys, lookup_join
from quipu.session import local_frame, materialize

SCHEMA = "column string, value string, code bigint"
ONE_HOT_LEVELS = 10_000  # no table has more columns than that


@dataclass(frozen=True)
class Dictionary:
    """Rows ``(column, value, code)``, and how large each column's part is."""

    rows: DataFrame
    sizes: dict[str, tuple[int, int]]

    @property
    def columns(self) -> list[str]:
        return list(self.sizes)

    def small(self, columns: list[str]) -> set[str]:
        """Those of the columns, smallest first, whose parts may be broadcast together."""
        rows = total = 0
        found = set()
        for c in sorted(columns, key=lambda c: self.sizes[c][1] or 0):
            count, size = self.sizes[c]
            rows, total = rows + count, total + (size or 0) + ROW_BYTES * count
            if rows <= BROADCAST_ROWS and total <= BROADCAST_BYTES:
                found.add(c)
        return found

    def codes(self, column: str) -> DataFrame:
        """The value-to-code table of one column."""
        part = self.rows.filter(F.col("column") == column)
        return part.select(F.col("value").alias(column), F.col("code").alias("_code"))


def distinct_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column, value)`` of every distinct non-null value, in one scan.

    Repeated values collapse before the shuffle, so a very frequent value costs
    no more than a rare one.
    """
    columns = text_columns(df) if columns is None else columns
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], columns, "column", "value")
    return long.filter(F.col("value").isNotNull()).distinct()


def fit_dictionary(df: DataFrame, columns: list[str] | None = None) -> Dictionary:
    """Number the distinct values of each column from 0 in sorted order.

    The distinct values are range-partitioned and sorted, then written with
    their place in their partition.  A code is that place plus the number of
    values in the partitions before it, so no task ever holds a whole column.
    """
    columns = text_columns(df) if columns is None else columns
    if not columns:
        return Dictionary(local_frame(df.sparkSession, [], SCHEMA), {})
    within = (1 << 33) - 1  # monotonically_increasing_id keeps the row in the low 33 bits
    placed = (
        distinct_values(df, columns)
        .repartitionByRange("column", "value")
        .sortWithinPartitions("column", "value")
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit(within)))
    )
    placed = materialize(placed, "dictionary-values")
    parts = placed.groupBy("column", "part").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("place").alias("first"),
        F.sum(F.octet_length("value")).alias("bytes"),
    )
    # The table is sorted by column, so there are no more rows here than tasks and columns.
    sizes = {c: (0, 0) for c in columns}
    starts = []
    for r in parts.orderBy("column", "part").collect():
        before, size = sizes[r["column"]]
        starts.append((r["column"], r["part"], before - r["first"]))
        sizes[r["column"]] = (before + r["n"], size + r["bytes"])
    start_of = local_frame(df.sparkSession, starts, "column string, part int, start bigint")
    rows = placed.join(F.broadcast(start_of), ["column", "part"])
    rows = rows.select("column", "value", (F.col("place") + F.col("start")).alias("code"))
    return Dictionary(materialize(rows, "dictionary"), sizes)


def as_dictionary(rows: DataFrame) -> Dictionary:
    """A dictionary from rows that exist already."""
    parts = rows.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("bytes"))
    # One driver row per column of the table.
    sizes = {r["column"]: (r["n"], r["bytes"]) for r in parts.orderBy("column").collect()}
    return Dictionary(rows.select("column", "value", "code"), sizes)


def save_dictionary(dictionary: Dictionary, path: str, mode: str = "overwrite") -> None:
    dictionary.rows.write.mode(mode).partitionBy("column").parquet(path)


def load_dictionary(spark: SparkSession, path: str) -> Dictionary:
    return as_dictionary(spark.read.schema("value string, code bigint, column string").parquet(path))


def encode(
    df: DataFrame,
    dictionary: Dictionary,
    columns: list[str] | None = None,
    unseen: str = "error",
    small: set[str] | None = None,
) -> DataFrame:
    """Replace values by their codes; columns without a dictionary pass through.

    ``small`` names the columns whose dictionaries may be broadcast; by default their size decides.

    A null stays null.  A value outside the dictionary stops the job, or with
    ``unseen="null"`` becomes null, or with ``unseen="quarantine"`` also puts
    the column's name into the array column ``unseen``.
    """
    if unseen not in ("error", "null", "quarantine"):
        raise ValueError(f"unknown policy {unseen!r}")
    order = df.columns
    wanted = _covered(df, dictionary, columns)
    source = _as_text(df, wanted)
    out = apart(_with_codes(source, dictionary, {c: c for c in wanted}, small))

    def missed(c: str):
        return F.col(f"_code_{c}").isNull() & F.col(c).isNotNull()

    def code(c: str):
        if unseen != "error":
            return F.col(f"_code_{c}").alias(c)
        complaint = F.concat(F.lit(f"unseen value in column {c}: "), F.col(c))
        return F.when(missed(c), F.raise_error(complaint)).otherwise(F.col(f"_code_{c}")).alias(c)

    selected = [code(c) if c in wanted else F.col(c) for c in order]
    if unseen == "quarantine":
        names = [F.when(missed(c), F.lit(c)) for c in wanted]
        found = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
        selected.append(found.alias("unseen"))
    return out.select(*selected)


def _covered(df: DataFrame, dictionary: Dictionary, columns: list[str] | None) -> list[str]:
    present = set(df.columns)
    return [c for c in (columns or df.columns) if c in dictionary.sizes and c in present]


def _with_codes(df: DataFrame, dictionary: Dictionary, columns: dict[str, str], small: set[str] | None = None) -> DataFrame:
    """Add ``_code_<c>`` for each column ``c`` of the dictionary, whose values stand in ``columns[c]``.

    Small dictionaries are broadcast, and so are the frequent values of the others, some
    columns a step of generated code.  A row
    whose values are all resolved by then is not shuffled.  The values still open, of all
    columns together, go to the dictionary as pairs of column and value, and their codes go
    back to their rows by number: one exchange of the rows, however many columns there are.
    """
    small = dictionary.small(list(columns)) if small is None else small
    for i, c in enumerate([c for c in columns if c in small]):
        df = df if i % JOINS_A_STEP else apart(df)
        codes = dictionary.codes(c).select(F.col(c).alias(columns[c]), F.col("_code").alias(f"_code_{c}"))
        df = df.join(F.broadcast(codes), columns[c], "left")
    large = {c: at for c, at in columns.items() if c not in small}
    if not large:
        return df
    names = df.columns
    hot = _hot_codes(df, dictionary, large)
    for i, (c, at) in enumerate(large.items()):
        df = df if i % JOINS_A_STEP else apart(df)
        own = hot.where(F.col("column") == c).select(F.col("value").alias(f"_value_{c}"), F.col("code").alias(f"_code_{c}"), F.lit(True).alias(f"_hot_{c}"))
        df = df.join(F.broadcast(own), F.col(at) == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
    open_pairs = [
        F.when(F.col(f"_hot_{c}").isNull() & F.col(at).isNotNull(), F.struct(F.lit(c).alias("column"), F.col(at).alias("value"))) for c, at in large.items()
    ]
    marked = df.withColumn("_open", F.array_compact(F.array(*open_pairs))).drop(*[f"_hot_{c}" for c in large])
    # Written, so that a row keeps its number whoever reads it.
    marked = materialize(marked.withColumn("_number", F.monotonically_increasing_id()), "marked-rows")
    waiting = marked.where(F.size("_open") > 0)
    pairs = waiting.select("_number", F.explode("_open").alias("_p")).select("_number", "_p.*")
    answers = pairs.join(dictionary.rows.filter(F.col("column").isin(list(large))), ["column", "value"])
    by_row = answers.groupBy("_number").agg(*[F.max(F.when(F.col("column") == c, F.col("code"))).alias(f"_found_{c}") for c in large])
    back = waiting.join(by_row, "_number", "left")
    found = [F.coalesce(f"_code_{c}", f"_found_{c}").alias(f"_code_{c}") for c in large]
    shown = [*names, *[f"_code_{c}" for c in large]]
    return marked.where(F.size("_open") == 0).select(*shown).unionByName(back.select(*names, *found))


def _hot_codes(df: DataFrame, dictionary: Dictionary, columns: dict[str, str]) -> DataFrame:
    """``(column, value, code)`` of the frequent values, all columns counted in one pass; the code of an unknown one is null."""
    values = [F.col(at).alias(c) for c, at in columns.items()]
    long = df.select(*values).unpivot([], list(columns), "column", "value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    counts = materialize(counts.where("_n > 1 AND value IS NOT NULL"), "value-counts")
    # At most 1 / HOT_SHARE values of a column have that share.
    often = counts.where(F.col("_n") >= HOT_SHARE * df.count()).select("column", "value")
    known = dictionary.rows.join(F.broadcast(often), ["column", "value"], "left_semi")
    return materialize(often.join(F.broadcast(known), ["column", "value"], "left"), "hot-codes")


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    others = set(columns) - set(text_columns(df))
    return df.withColumns({c: F.col(c).cast("string") for c in others}) if others else df


def decode(df: DataFrame, dictionary: Dictionary, columns: list[str] | None = None) -> DataFrame:
    """Put the values back in place of their codes."""
    wanted = _covered(df, dictionary, columns)
    out, order = df, df.columns
    small = dictionary.small(wanted)
    for c in wanted:
        values = dictionary.codes(c).select(F.col("_code").alias(c), F.col(c).alias(f"_value_{c}"))
        hot = None if c in small else hot_keys(df, [c])
        out = lookup_join(out, values, [c], c in small, hot)
    return out.select(*[F.col(f"_value_{c}").alias(c) if c in wanted else F.col(c) for c in order])


def unseen_rows(df: DataFrame, dictionary: Dictionary, columns: list[str] | None = None) -> DataFrame:
    """The rows of ``df``, as they were, with at least one value outside the dictionary."""
    wanted = _covered(df, dictionary, columns)
    copies = df.withColumns({f"_text_{c}": F.col(c).cast("string") for c in wanted})
    out = _with_codes(copies, dictionary, {c: f"_text_{c}" for c in wanted})
    names = [F.when(F.col(f"_code_{c}").isNull() & F.col(c).isNotNull(), F.lit(c)) for c in wanted]
    found = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return out.withColumn("unseen", found).filter(F.size("unseen") > 0).select(*df.columns, "unseen")


def one_hot_sparse(df: DataFrame, dictionary: Dictionary, columns: list[str], out: str = "active", unseen: str = "error") -> DataFrame:
    """The indicators that are set, as ascending places, in place of the columns.

    The places number all levels but the lowest of each column, column after column,
    so this form takes any number of levels.  A null sets none.
    """
    coded = encode(df, dictionary, columns, unseen)
    start, places = 0, []
    for c in columns:
        places.append(F.when(F.col(c) > 0, F.col(c) - 1 + start))
        start += max(dictionary.sizes[c][0] - 1, 0)
    rest = [c for c in coded.columns if c not in columns]
    return coded.select(*rest, F.array_compact(F.array(*places)).alias(out))


def one_hot(df: DataFrame, dictionary: Dictionary, columns: list[str], unseen: str = "error") -> DataFrame:
    """Indicator columns for all levels but the lowest, in place of each column.

    The levels become column names, at most ``ONE_HOT_LEVELS`` of them;
    :func:`one_hot_sparse` is the form for any number.
    A null sets no indicator.  A value outside the dictionary stops the job, or with
    ``unseen="null"`` counts as a null.
    """
    if unseen not in ("error", "null"):
        raise ValueError(f"unknown policy {unseen!r}")
    count = sum(dictionary.sizes[c][0] for c in columns)
    if count > ONE_HOT_LEVELS:
        raise ValueError(f"{count} levels are too many for columns; use one_hot_sparse")
    kept = dictionary.rows.filter(F.col("column").isin(columns) & (F.col("code") > 0))
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in kept.orderBy("column", "code").collect():
        levels[row["column"]].append(row["value"])
    plain = [c for c in df.columns if c not in columns]
    lowest = {r["column"]: r["value"] for r in dictionary.rows.filter(F.col("column").isin(columns) & (F.col("code") == 0)).collect()}

    def text(c: str) -> Column:
        value = F.col(c).cast("string")
        if unseen == "null":
            return value
        known = [x for x in (lowest.get(c), *levels[c]) if x is not None]
        complaint = F.raise_error(F.concat(F.lit(f"unseen value in column {c}: "), value))
        return F.when(value.isNull() | value.isin(known), value).otherwise(complaint)

    flags = [F.coalesce(text(c) == F.lit(level), F.lit(False)).alias(f"{c}_{level}") for c in columns for level in levels[c]]
    return df.select(*plain, *flags)
