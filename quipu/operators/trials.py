"""Search trials: draws, suggestions from earlier trials, running best, best trial, mean of folds."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.functions.numbers import MAX_DEPTH, draw_choice, draw_int, draw_log_float, draw_log_int, improvement_percent, uniform
from quipu.functions.text import plain_text
from quipu.operators.ordered import ROWS_PER_RANGE, running_max_before
from quipu.session import local_frame, materialize

# Model families, the ranges of their parameters, and the messages
# about a new best trial.
FAMILIES = ["SVC_linear", "SVC_poly", "SVC_rbf", "DecisionTreeClassifier", "RandomForest"]
SVC_C = (0.01, 100.0)
POLY_DEGREE = (2, 6)
TREE_DEPTH = (2, MAX_DEPTH)  # the engine grows no deeper trees
FOREST_DEPTH = (2, MAX_DEPTH)
FOREST_TREES = (2, 10)
INITIAL_MESSAGE = "Initial trial %s achieved value: %s"
IMPROVED_MESSAGE = "Trial %s achieved value: %s with % .4f%% improvement"


@dataclass(frozen=True)
class Param:
    """A parameter, what it is drawn like, and the families that have it."""

    name: str
    kind: str
    low: float
    high: float
    families: tuple[str, ...]

    def value(self, u: Column) -> Column:
        """The value at a place in [0, 1) of the range."""
        draw = {"log_float": draw_log_float, "log_int": draw_log_int, "int": draw_int}[self.kind]
        return draw(u, self.low, self.high)

    def place(self, value: Column) -> Column:
        """Where in the range a value lies, as a share of it."""
        if self.kind == "int":
            return (value - self.low + 0.5) / (self.high - self.low + 1)
        edge = 0.5 if self.kind == "log_int" else 0.0
        low, high = math.log(self.low - edge), math.log(self.high + edge)
        return (F.ln(value.cast("double")) - low) / (high - low)


SPACE = [
    Param("svc_c", "log_float", *SVC_C, ("SVC_linear", "SVC_poly", "SVC_rbf")),
    Param("svc_poly_degree", "int", *POLY_DEGREE, ("SVC_poly",)),
    Param("tree_max_depth", "log_int", *TREE_DEPTH, ("DecisionTreeClassifier",)),
    Param("rf_max_depth", "log_int", *FOREST_DEPTH, ("RandomForest",)),
    Param("rf_n_estimators", "log_int", *FOREST_TREES, ("RandomForest",)),
]

# Of the earlier trials this share counts as good, at most so many.  A suggestion is the best of so few
# candidates that the trials of a batch, which do not know of each other, differ.
GOOD_SHARE = 0.15
MOST_GOOD = 25
CANDIDATES = 4
# Each trial is a bump at its place; its width reaches to the neighbours, within these bounds.
NARROWEST = 0.1
WIDEST = 1.0


def draw_trials(df: DataFrame, trial: str, seed: int) -> DataFrame:
    """Add a family and its parameters to each trial number.

    Every draw depends on the seed, the trial and the parameter only, so trials
    can be drawn anywhere and in any number.  Parameters of the other families
    are null.
    """

    def u(name: str) -> Column:
        return uniform(seed, name, F.col(trial))

    drawn = df.withColumn("classifier", draw_choice(u("classifier"), FAMILIES))
    return drawn.withColumns({p.name: F.when(F.col("classifier").isin(*p.families), p.value(u(p.name))) for p in SPACE})


def suggest_trials(
    history: DataFrame, new: DataFrame, seed: int, trial: str = "trial", value: str = "value", study: list[str] | None = None
) -> DataFrame:
    """Add a family and its parameters to each trial of ``new``, learnt from the trials of ``history``.

    The earlier trials of a study are parted into the best share and the rest.  Of each part
    a density is estimated: shares of the families, and for every parameter a bump at each
    value and one over the whole range.  A family is drawn from the good density by how much
    likelier it is there; a parameter is the candidate, drawn from the good density, that is
    likeliest there as against the rest.  Trials of one call do not wait for each other.
    Without earlier trials the draws are those of the whole range.

    A value that is null or not a number ranks last.  ``new`` has the trial and the study.
    """
    study = study or []
    keys = [*study, trial]
    best_first = Window.partitionBy(*study).orderBy(F.desc_nulls_last(F.when(~F.isnan(value), F.col(value))), trial)
    count = F.count(F.lit(1)).over(Window.partitionBy(*study))
    good = F.least(F.ceil(count * GOOD_SHARE), F.lit(MOST_GOOD))
    ranked = history.withColumn("_good", F.row_number().over(best_first) <= good)
    ranked = materialize(ranked.select(*study, trial, "_good", "classifier", *[p.name for p in SPACE]), "earlier-trials")

    def u(name: str, *more: str) -> Column:
        return uniform(seed, name, *[F.col(c) for c in (*keys, *more)])

    named = _with_family(ranked, new.select(*keys), u, study, keys)
    drawn = _with_params(ranked, materialize(named, "suggested-families"), u, study, keys)
    return new.join(drawn, keys)


def _with_family(ranked: DataFrame, new: DataFrame, u, study: list[str], keys: list[str]) -> DataFrame:
    """A family per trial, drawn in proportion to its share among good trials by its share in the rest."""
    spark = new.sparkSession
    families = local_frame(spark, list(enumerate(FAMILIES)), "_place int, classifier string")
    seen = ranked.groupBy(*study, "classifier").agg(F.count_if("_good").alias("_in"), F.count_if(~F.col("_good")).alias("_out"))
    # One row per trial and family; both tables are as large as the search, not as the data.
    every = new.join(F.broadcast(families)).join(seen, [*study, "classifier"], "left")
    weight = F.pow(F.coalesce("_in", F.lit(0)) + 1.0, 2) / (F.coalesce("_in", F.lit(0)) + F.coalesce("_out", F.lit(0)) + 1.0)
    row = Window.partitionBy(*keys)
    summed = every.withColumn("_w", weight).withColumn("_upto", F.sum("_w").over(row.orderBy("_place"))).withColumn("_all", F.sum("_w").over(row))
    behind = summed.where(F.col("_upto") > u("classifier") * F.col("_all"))
    return behind.groupBy(*keys).agg(F.min_by("classifier", "_place").alias("classifier"))


def _with_params(ranked: DataFrame, named: DataFrame, u, study: list[str], keys: list[str]) -> DataFrame:
    """The parameters of each trial's family, all estimated in one pass over (parameter, place) rows."""
    places = [F.struct(F.lit(p.name).alias("param"), p.place(F.col(p.name)).alias("x")) for p in SPACE]
    seen = ranked.select(*study, "_good", F.explode(F.array(*places)).alias("_p")).select(*study, "_good", "_p.*").where("x IS NOT NULL")
    beside = Window.partitionBy(*study, "_good", "param").orderBy("x")
    left, right = F.coalesce(F.lag("x").over(beside), F.lit(0.0)), F.coalesce(F.lead("x").over(beside), F.lit(1.0))
    width = F.greatest(F.lit(NARROWEST), F.least(F.lit(WIDEST), F.greatest(F.col("x") - left, right - F.col("x"))))
    bumps = seen.withColumn("s", width).withColumn("n", F.row_number().over(beside))
    # A bump over the whole range keeps every place possible.
    whole = [(g, p.name) for g in (True, False) for p in SPACE]
    spark = named.sparkSession
    wide = local_frame(spark, whole, "_good boolean, param string").withColumns({"x": F.lit(0.5), "s": F.lit(WIDEST), "n": F.lit(0)})
    of_studies = named.select(*study).distinct().join(F.broadcast(wide)) if study else wide
    bumps = materialize(bumps.unionByName(of_studies), "bumps")
    sizes = bumps.groupBy(*study, "_good", "param").agg(F.count(F.lit(1)).alias("_size"))

    wanted = F.array(*[F.when(F.col("classifier").isin(*p.families), F.lit(p.name)) for p in SPACE])
    rows = named.select(*keys, F.explode(F.array_compact(wanted)).alias("param"))
    rows = rows.select(*keys, "param", F.explode(F.sequence(F.lit(1), F.lit(CANDIDATES))).alias("c"))
    rows = rows.join(F.broadcast(sizes.where("_good").drop("_good")), [*study, "param"])
    rows = rows.withColumn("n", F.floor(u("bump", "param", "c") * F.col("_size")).cast("int")).drop("_size")
    chosen = bumps.where("_good").select(*study, "param", "n", F.col("x").alias("_m"), F.col("s").alias("_s"))
    rows = rows.join(chosen, [*study, "param", "n"])
    normal = F.sqrt(-2 * F.ln(1 - u("far", "param", "c"))) * F.cos(2 * math.pi * u("turn", "param", "c"))
    bent = F.pmod(F.col("_m") + F.col("_s") * normal, F.lit(2.0))  # reflected at both ends of the range
    rows = rows.withColumn("y", F.least(F.when(bent > 1, 2 - bent).otherwise(bent), F.lit(1 - 1e-9)))

    bump = F.exp(-0.5 * F.pow((F.col("y") - F.col("x")) / F.col("s"), 2)) / F.col("s")
    met = rows.select(*keys, "param", "c", "y").join(bumps, [*study, "param"])
    dense = met.groupBy(*keys, "param", "c", "y").agg(
        (F.sum(F.when(F.col("_good"), bump)) / F.count_if("_good")).alias("l"),
        (F.sum(F.when(~F.col("_good"), bump)) / F.count_if(~F.col("_good"))).alias("g"),
    )
    best = dense.groupBy(*keys, "param").agg(F.max_by("y", F.struct(F.col("l") / F.col("g"), "c")).alias("y"))
    pivoted = best.groupBy(*keys).agg(*[F.max(F.when(F.col("param") == p.name, F.col("y"))).alias(p.name) for p in SPACE])
    return named.join(pivoted, keys).select(*keys, "classifier", *[F.when(F.col(p.name).isNotNull(), p.value(F.col(p.name))).alias(p.name) for p in SPACE])


def running_champion(
    df: DataFrame,
    trial: str = "trial",
    value: str = "value",
    study: list[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The trials that improve on all earlier ones of their study.

    A best value of 0 is not reported, and neither does it count as a champion:
    the next improvement is compared with the last value reported, and is the
    initial one if there is none.  A trial whose value is not a number is none.
    """
    columns = df.columns
    known = df.filter(~F.isnan(value))
    marked = known.withColumn("_nonzero", F.nullif(F.col(value), F.lit(0).cast(df.schema[value].dataType)))
    prior = running_max_before(
        marked, trial, {"_best": value, "previous": "_nonzero"}, study, rows_per_range
    )
    better = F.col("_best").isNull() | (F.col(value) > F.col("_best"))
    emitted = prior.filter(better & (F.col(value) != 0))
    percent = improvement_percent(F.col("previous"), F.col(value))
    initial = F.col("previous").isNull()
    told = [F.col(trial).cast("string"), plain_text(F.col(value))]
    first = F.format_string(INITIAL_MESSAGE, *told)
    later = F.format_string(IMPROVED_MESSAGE, *told, percent)
    return emitted.select(
        *columns,
        "previous",
        F.when(initial, F.lit("initial")).otherwise(F.lit("improved")).alias("kind"),
        percent.alias("improvement_percent"),
        F.when(initial, first).otherwise(later).alias("message"),
    )


def best_trial(
    df: DataFrame,
    trial: str = "trial",
    value: str = "value",
    study: list[str] | None = None,
) -> DataFrame:
    """The whole row of the highest value per study; the lowest trial number on a tie.

    Values that are null or not a number do not take part.
    """
    study = study or []
    rest = [c for c in df.columns if c not in study]
    # Larger structs win: compare the value, then the trial number from above.
    rank = F.struct(F.col(value), (-F.col(trial)).alias("_t"))
    scored = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    best = scored.groupBy(*study).agg(F.max_by(F.struct(*rest), rank).alias("_b"))
    return best.select(*study, "_b.*")


def mean_of_folds(scores: DataFrame, trial: str = "trial", value: str = "score") -> DataFrame:
    return scores.groupBy(trial).agg(F.avg(value).alias("mean_score"))
