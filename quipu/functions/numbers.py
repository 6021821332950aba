"""Small numeric expressions: bounds, improvement, seeded draws."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DEPTH = 30  # the deepest tree Spark ML grows


def improvement_percent(previous: Column, best: Column) -> Column:
    """How far ``best`` is from ``previous``, in percent of ``best``."""
    return F.abs(previous - best) / best * 100


def _parts(*keys: Column) -> list[Column]:
    """Each key with its length before it, so that no two keys spell the same text; ``-`` for a null."""
    texts = [k.cast("string") for k in keys]
    return [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]


def seeded_hash(seed: int, *keys: Column) -> Column:
    """A uniform hex text that depends on the seed and the key only."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *_parts(*keys)))


def uniform(seed: int, name: str, *keys: Column) -> Column:
    """A draw from [0, 1) per key; ``name`` separates draws of the same key."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(name), *_parts(*keys))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**32))


def draw_choice(u: Column, choices: list[str]) -> Column:
    options = F.array(*[F.lit(c) for c in choices])
    return F.element_at(options, (F.floor(u * len(choices)) + 1).cast("int"))


def draw_log_float(u: Column, low: float, high: float) -> Column:
    """Log-uniform on [low, high)."""
    return F.exp(F.lit(math.log(low)) + u * (math.log(high) - math.log(low)))


def draw_log_int(u: Column, low: int, high: int) -> Column:
    """Log-uniform integers from ``low`` to ``high``, both included."""
    edge_low, edge_high = math.log(low - 0.5), math.log(high + 0.5)
    value = F.round(F.exp(F.lit(edge_low) + u * (edge_high - edge_low))).cast("int")
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def draw_int(u: Column, low: int, high: int) -> Column:
    """Integers from ``low`` to ``high``, both included, each as likely."""
    return F.least(F.lit(high), low + F.floor(u * (high - low + 1))).cast("int")


def digamma(n: Column) -> Column:
    """The derivative of the log of the gamma function at a whole number from 1 on.

    The asymptotic series ten steps further up, where it is exact to a few units in the
    13th digit, less the ten reciprocals in between.
    """
    z = n + 10.0
    series = F.log(z) - 0.5 / z - 1 / (12 * z**2) + 1 / (120 * z**4) - 1 / (252 * z**6) + 1 / (240 * z**8)
    return series - reduce(add, [1 / (n + float(j)) for j in range(10)])
