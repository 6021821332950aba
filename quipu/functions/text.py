"""Run names, fixed-point text, parameter tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two timestamp formats of run names.
DASHED = "yyyy/MM/dd-HH:mm:ss"
COMPACT = "yyyyMMdd_HHmmss"


def run_name(prefix: str, moment: Column, pattern: str = DASHED) -> Column:
    return F.concat(F.lit(prefix), F.date_format(moment, pattern))


def trial_name(number: Column) -> Column:
    return F.concat(F.lit("Trial: "), number.cast("string"))


def fixed4(value: Column) -> Column:
    return F.format_string("%.4f", value)


def plain_text(value: Column) -> Column:
    """A number as text without an exponent, as far as 0.0001 and 16 digits go."""
    text = value.cast("string")
    digits = F.rtrim(text.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    spelled = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    size = F.abs(value.cast("double"))
    return F.when(text.contains("E") & (size >= 1e-4) & (size < 1e16), spelled).otherwise(text)


def tags(**values: Column) -> Column:
    """Named values as a text map; a null stays a null value."""
    pairs = [item for name, value in values.items() for item in (F.lit(name), value.cast("string"))]
    return F.create_map(*pairs)


def with_tags(base: Column, **values: Column) -> Column:
    """Add tags to a map, replacing those of the same name."""
    added = tags(**values)
    kept = F.map_filter(base, lambda name, _: ~F.array_contains(F.map_keys(added), name))
    return F.map_concat(kept, added)


def is_family(name: Column, family: str) -> Column:
    return name.contains(family)
