"""The registered queries: each runs one operator over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.functions import numbers, paths, text
from quipu.operators import align, clean, encode, metrics, models, neighbours, registry, search, split, stats, trials, validate
from quipu.operators.joins import hot_key_join
from quipu.plans import etl, fixtures, score, train
from quipu.plans.fixtures import LINE_FEATURES, LINES
from quipu.schema import DESCRIBED_CATEGORIES, MARRIAGES, POSITIVE_LABEL
from quipu.session import materialize, new_path
from quipu.sources.delimited import read_csv, write_csv
from quipu.sources.dictionary import read_categories, read_entries, write_entries
from quipu.sources.documents import read_json_or_empty, signature, signature_fields, write_json
from quipu.sources.requests import CORRUPT, parse_requests
from quipu.sources.store import Store
from quipu.sources.tables import table
from quipu.streaming import score as streaming

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

SEED = 42
TEST_SIZE = 0.3
SEARCH_TRIALS, SEARCH_STARTUP, SEARCH_BATCH = 7, 5, 2
SEARCH_SEED = 719  # its first draws hold every family
ROWS_PER_FILE = 100_000
TREES = {"numTrees": 10, "maxDepth": 5}


def query(run: Query) -> Query:
    REGISTERED[run.__name__] = run
    return run


def _joined(column: str):
    return F.array_join(column, ",").alias(column)


# sources and sinks


@query
def csv_roundtrip(spark, folder):
    customers = table(spark, folder, "customer")
    path = new_path(spark, "customer-csv")
    write_csv(customers, path)
    return read_csv(spark, path, customers.schema)


@query
def data_dictionary(spark, folder):
    raw = fixtures.raw_marriages(spark, folder)
    encoded, dictionary = etl.encode_table(raw, MARRIAGES)
    newest = table(spark, folder, "orders").agg(F.max("o_orderdate").cast("string").alias("d")).first()["d"]
    moment = F.lit(newest).cast("timestamp")
    path = new_path(spark, "description")
    described = etl.describe(raw, encoded, dictionary, MARRIAGES, DESCRIBED_CATEGORIES, moment, new_path(spark, "values"))
    write_entries(registry.merge_entries(read_entries(spark, path), described, ["key"]), path)
    return read_entries(spark, path)


@query
def category_pages(spark, folder):
    """A description whose longer lists of values are pages beside it, read back as one table."""
    raw = fixtures.raw_marriages(spark, folder)
    encoded, dictionary = etl.encode_table(raw, MARRIAGES)
    path, moment = new_path(spark, "description"), F.current_timestamp()
    described = etl.describe(raw, encoded, dictionary, MARRIAGES, DESCRIBED_CATEGORIES, moment, new_path(spark, "values"), inline_bytes=100)
    write_entries(described, path)
    return read_categories(spark, path, etl.CATEGORIES)


@query
def model_roundtrip(spark, folder):
    lines = fixtures.expensive_lines(spark, folder)
    model = models.fit(lines, models.forest_classifier("expensive", **TREES), LINE_FEATURES)
    path = new_path(spark, "model")
    models.save_model(model, path)
    loaded = models.load_model(spark, path)
    both = models.predict(models.predict(lines, model, "before"), loaded, "after")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differing"),
    )


@query
def model_signature(spark, folder):
    lines = fixtures.expensive_lines(spark, folder)
    model = models.fit(lines, models.tree_classifier("expensive", 2), LINE_FEATURES)
    path = new_path(spark, "signature")
    described = signature(models.predict(lines, model), LINE_FEATURES, "prediction")
    write_json(described, path)
    return signature_fields(read_json_or_empty(spark, path, described.schema))


# projection, casts, checks


@query
def project_features(spark, folder):
    return clean.project(fixtures.raw_marriages(spark, folder), [*MARRIAGES.features, MARRIAGES.target])


@query
def cast_schema(spark, folder):
    return clean.cast_types(fixtures.raw_marriages(spark, folder), MARRIAGES.types())


@query
def bool_to_int(spark, folder):
    typed = clean.cast_types(fixtures.raw_marriages(spark, folder), MARRIAGES.types())
    return clean.bool_to_int(typed).select("row_id", "es_divorcio")


@query
def clean_table(spark, folder):
    return clean.clean(fixtures.raw_marriages(spark, folder), MARRIAGES)


@query
def features_target(spark, folder):
    return clean.features_only(fixtures.marriages(spark, folder), MARRIAGES.target)


@query
def target_column(spark, folder):
    return clean.target_only(fixtures.marriages(spark, folder), MARRIAGES.target)


@query
def validate_ranges(spark, folder):
    lines = table(spark, folder, "lineitem")
    checked = validate.check_ranges(lines, LINES)
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return checked.select(*keys, _joined("violations"))


@query
def validate_required(spark, folder):
    requests = fixtures.marriage_requests(spark, folder)
    checked = validate.check_required(parse_requests(requests, "body", MARRIAGES, ["row_id"]), MARRIAGES)
    return checked.select("row_id", _joined("missing"), F.col(CORRUPT).isNotNull().alias("corrupt"), "valid")


@query
def unseen_labels(spark, folder):
    """Customers of nations without a supplier in debt."""
    suppliers = table(spark, folder, "supplier").where("s_acctbal < 0")
    suppliers = suppliers.select(F.col("s_nationkey").cast("string").alias("nation"))
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    dictionary = encode.fit_dictionary(suppliers, ["nation"])
    return encode.unseen_rows(customers, dictionary).select("c_custkey", "nation", _joined("unseen"))


@query
def score_label(spark, folder):
    labels = table(spark, folder, "labels")
    return models.label_scores(labels, "toxic").select("doc_id", "int_output", "str_output")


@query
def assemble_features(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "value")
    vectors = models.assemble(events, ["value", "user_id"])
    parts = vector_to_array(models.VECTOR)
    return vectors.select("event_id", parts[0].alias("first"), parts[1].alias("second"))


# pairing and look-ups


@query
def alignment_check(spark, folder):
    return align.alignment(table(spark, folder, "documents"), table(spark, folder, "labels"), ["doc_id"])


@query
def concat_xy(spark, folder):
    labels = table(spark, folder, "labels")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    features = documents.join(labels.select("doc_id"), "doc_id", "left_semi")
    return align.concat_columns(features, labels.select("doc_id", "quality"), ["doc_id"])


@query
def label_dictionary(spark, folder):
    dictionary = encode.fit_dictionary(table(spark, folder, "part"))
    path = new_path(spark, "dictionary")
    encode.save_dictionary(dictionary, path)
    return encode.load_dictionary(spark, path).rows


@query
def encode_with_dictionary(spark, folder):
    parts = table(spark, folder, "part")
    path = new_path(spark, "dictionary")
    encode.save_dictionary(encode.fit_dictionary(parts, ["p_brand", "p_type"]), path)
    loaded = encode.load_dictionary(spark, path)
    return encode.encode(parts.select("p_partkey", "p_brand", "p_type", "p_name", "p_size"), loaded)


@query
def encode_all_strings(spark, folder):
    encoded, _ = etl.encode_table(fixtures.raw_marriages(spark, folder), MARRIAGES)
    return encoded


@query
def encode_large_dictionary(spark, folder):
    """The join for dictionaries too large to broadcast, on customers of orders."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    codes = encode.fit_dictionary(orders, ["customer"]).codes("customer")
    return hot_key_join(orders, codes, ["customer"]).withColumnRenamed("_code", "code")


@query
def encode_large_columns(spark, folder):
    """Four columns whose dictionaries count as too large to broadcast, two of them with a few very frequent values."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderdate").cast("string").alias("day"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderpriority")).alias("priority"),
    )
    return encode.encode(orders, encode.fit_dictionary(orders, ["customer", "day", "status", "priority"]), small=set())


@query
def decode_codes(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    dictionary = encode.fit_dictionary(parts)
    return encode.decode(encode.encode(parts, dictionary), dictionary)


@query
def one_hot_drop_first(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    return encode.one_hot(documents, encode.fit_dictionary(documents, ["lang"]), ["lang"])


# splits and samples


@query
def stratified_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return split.train_test_split(orders, ["o_orderkey"], SEED, TEST_SIZE, stratify="o_orderstatus")


@query
def random_split(spark, folder):
    events = table(spark, folder, "events").select("event_id")
    return split.train_test_split(events, ["event_id"], SEED, 0.25, rank_rows=1_000)


@query
def stratified_folds(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return split.stratified_folds(orders, ["o_orderkey"], SEED, 5, "o_orderpriority", rank_rows=1_000)


@query
def split_partition_check(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    parts = split.train_test_split(orders, ["o_orderkey"], SEED, TEST_SIZE, stratify="o_orderstatus")
    sides = {name: parts.filter(F.col("split") == name) for name in ("train", "test")}
    return align.partition_check(orders, sides, ["o_orderkey"])


@query
def paired_sample(spark, folder):
    raw = fixtures.raw_marriages(spark, folder)
    cleaned = clean.clean(raw, MARRIAGES)
    before, after = split.paired_sample(raw, cleaned, ["row_id"], 100, SEED)
    before = before.select(F.lit("raw").alias("side"), "row_id", F.col("es_divorcio").alias("target"))
    after = after.select(F.lit("clean").alias("side"), "row_id", F.col("es_divorcio").cast("string").alias("target"))
    return before.unionByName(after)


# aggregates


@query
def category_values(spark, folder):
    return stats.category_values(table(spark, folder, "documents"), ["lang", "source"])


@query
def correlation_with_target(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("is_f", (F.col("l_linestatus") == "F").cast("int"))
    report = stats.correlation_with_target(lines, [*LINE_FEATURES, "l_linenumber"], "is_f")
    return report.withColumn("correlation", F.round("correlation", 8))


@query
def information_gain(spark, folder):
    lines = table(spark, folder, "lineitem")
    report = stats.information_gain(lines, ["l_returnflag", "l_linenumber", "l_quantity"], "l_linestatus", numeric=[])
    return report.withColumn("information_gain", F.round("information_gain", 8))


@query
def information_gain_binned(spark, folder):
    lines = fixtures.expensive_lines(spark, folder)
    names = ["l_quantity", "l_discount"]
    report = stats.information_gain(lines, names, "expensive", numeric=names, bins=8, accuracy=1_000_000)
    return report.withColumn("information_gain", F.round("information_gain", 8))


@query
def information_gain_knn(spark, folder):
    """The report over the encoded table, all features as continuous, in ranges of a few thousand values."""
    encoded, _ = etl.encode_table(fixtures.raw_marriages(spark, folder), MARRIAGES)
    report = neighbours.information_gain_knn(encoded, MARRIAGES.features, MARRIAGES.target, ["row_id"], seed=SEED, rows_per_range=4_000)
    return report.withColumn("information_gain", F.round("information_gain", 8))


@query
def accuracy(spark, folder):
    return metrics.score(table(spark, folder, "labels"), "accuracy", "quality", "toxic")


@query
def f1_binary(spark, folder):
    return metrics.score(table(spark, folder, "labels"), "f1", "quality", "toxic")


@query
def cv_mean(spark, folder):
    orders = table(spark, folder, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return trials.mean_of_folds(orders.select(F.col("o_custkey").alias("trial"), cents.alias("score")))


@query
def scaler_stats(spark, folder):
    found = stats.scaler_stats(table(spark, folder, "lineitem"), LINE_FEATURES)
    return found.select("column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query
def standardize(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    scaled = stats.standardize(parts, ["p_size", "p_retailprice"])
    return scaled.select(
        "p_partkey", F.round("p_size", 6).alias("p_size"), F.round("p_retailprice", 6).alias("p_retailprice")
    )


# trials and registry


@query
def trial_grid(spark, folder):
    numbered = table(spark, folder, "orders").select(F.col("o_orderkey").alias("trial"))
    drawn = trials.draw_trials(numbered, "trial", SEED)
    return drawn.withColumn("svc_c", F.round("svc_c", 6))


def _order_trials(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("study"), F.col("o_orderkey").alias("trial"), F.col("o_totalprice").alias("value")
    )


@query
def running_champion(spark, folder):
    """All orders as one study, in ranges of a few thousand trials."""
    trial_rows = _order_trials(spark, folder).drop("study")
    improved = trials.running_champion(trial_rows, rows_per_range=2_000)
    return improved.withColumn("improvement_percent", F.round("improvement_percent", 8))


@query
def running_champion_per_study(spark, folder):
    improved = trials.running_champion(_order_trials(spark, folder), study=["study"], rows_per_range=2_000)
    return improved.select("study", "trial", "value", "previous", "kind")


@query
def best_trial(spark, folder):
    return trials.best_trial(_order_trials(spark, folder), study=["study"])


def _part_versions(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("name"),
        F.col("p_partkey").cast("int").alias("version"),
        F.when(F.col("p_type") == "ECONOMY", registry.NO_STAGE).otherwise(F.col("p_type")).alias("stage"),
        F.concat(F.lit("s3://models/"), "p_brand", F.lit("/"), F.col("p_partkey").cast("string")).alias("source"),
    )


@query
def latest_version(spark, folder):
    return registry.latest_version(_part_versions(spark, folder))


@query
def assign_version(spark, folder):
    """Orders become new versions of their priority, after the versions from parts."""
    existing = table(spark, folder, "part").select(
        F.concat(F.lit("1-"), F.upper("p_type")).alias("name"), F.col("p_size").alias("version")
    )
    existing = existing.unionByName(
        table(spark, folder, "part").select(F.lit("1-URGENT").alias("name"), F.col("p_size").alias("version"))
    )
    new = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("name"), F.col("o_orderkey").alias("seq"))
    return registry.assign_versions(new, existing, "seq", rows_per_range=2_000)


@query
def resolve_alias(spark, folder):
    orders = table(spark, folder, "orders")
    aliases = orders.select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("alias"),
        F.col("o_custkey").cast("string").alias("version"),
        F.col("o_orderdate").alias("promoted_at"),
    )
    address = F.concat(F.lit("s3://models/"), "o_orderpriority", F.lit("/"), F.col("o_custkey").cast("string"))
    versions = orders.select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_custkey").cast("string").alias("version"),
        address.alias("source"),
        F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("run_id"),
    ).distinct()
    return registry.resolve_alias(aliases, versions, "F")


@query
def insert_if_absent(spark, folder):
    """Nations of suppliers in debt, and those of customers under names that are not there."""
    debtors = table(spark, folder, "supplier").where("s_acctbal < 0")
    old = debtors.groupBy(F.col("s_nationkey").alias("name")).agg(F.min("s_suppkey").alias("id"))
    new = table(spark, folder, "customer").select(F.col("c_nationkey").alias("name"), F.col("c_custkey").alias("id"))
    return registry.insert_if_absent(old, new, ["name"])


@query
def dictionary_merge(spark, folder):
    old = table(spark, folder, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("value"))
    new = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("value"))
    return registry.merge_entries(old, new, ["key"])


@query
def champion_vs_challenger(spark, folder):
    labels = table(spark, folder, "labels").withColumn("always", F.lit(1))
    return registry.challenge(labels, "quality", "toxic", "always")


# scalar functions


@query
def parse_uri(spark, folder):
    documents = table(spark, folder, "documents")
    number = F.col("doc_id").cast("string")
    address = F.concat(F.lit("s3://"), "source", F.lit("/"), "lang", F.lit("/"), number, F.lit("/artifacts/model"))
    run = F.concat(F.lit("runs:/"), number, F.lit("/model"))
    return documents.select(
        "doc_id",
        paths.bucket(address, "s3://").alias("bucket"),
        paths.key(address, "s3://").alias("key"),
        paths.part(address, -3).alias("run_of_address"),
        paths.part(run, 2).alias("run_of_uri"),
    )


@query
def uri_scheme(spark, folder):
    pages = table(spark, folder, "pages")
    url = F.col("url")
    return pages.select(
        "page_id",
        paths.has_scheme(url, "https://").alias("secure"),
        paths.part(url, 3).alias("host"),
        paths.bucket(url, "http").alias("rest"),
    )


@query
def run_name(spark, folder):
    events = table(spark, folder, "events")
    return events.select(
        "event_id",
        text.run_name("ETL_run_", F.col("ts")).alias("dashed"),
        text.run_name("Challenger_", F.col("ts"), text.COMPACT).alias("compact"),
        text.trial_name(F.col("event_id")).alias("trial"),
    )


@query
def json_props(spark, folder):
    events = table(spark, folder, "events")
    parsed = F.from_json("props", "k bigint")
    again = F.to_json(F.struct(parsed["k"].alias("k"), F.col("event_type").alias("type")))
    return events.select("event_id", parsed["k"].alias("k"), again.alias("body"))


@query
def params_map(spark, folder):
    customers = table(spark, folder, "customer")
    base = text.tags(name=F.col("c_name"), segment=F.col("c_mktsegment"))
    added = text.with_tags(base, segment=F.lower("c_mktsegment"), nation=F.col("c_nationkey"))
    return customers.select("c_custkey", F.explode(added).alias("tag", "value"))


@query
def classifier_family(spark, folder):
    parts = table(spark, folder, "part")
    return parts.select("p_partkey", text.is_family(F.col("p_name"), "ring").alias("is_family"))


@query
def improvement(spark, folder):
    parts = table(spark, folder, "part")
    percent = numbers.improvement_percent(F.col("p_retailprice"), F.col("p_size").cast("double"))
    return parts.select("p_partkey", F.round(percent, 6).alias("percent"), text.fixed4(percent).alias("shown"))


# models


def _verdict(scored, label):
    """One row: all rows and positives, and whether the model beats the larger class."""
    positive = F.avg(F.col(label).cast("double"))
    found = scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        metrics.accuracy(label, "prediction").alias("_accuracy"),
        F.greatest(positive, 1 - positive).alias("_majority"),
    )
    return found.select("n_rows", "n_positive", (F.col("_accuracy") > F.col("_majority")).alias("beats_majority"))


def _sides(lines):
    """Order lines to learn from and to be scored on, dealt by a hash of their order."""
    held = F.substring(F.md5(F.col("l_orderkey").cast("string")), 1, 1) >= "b"
    return lines.where(~held), lines.where(held)


def _classify(spark, folder, estimator):
    seen, held = _sides(fixtures.expensive_lines(spark, folder, ["l_orderkey"]))
    return _verdict(models.predict(held, models.fit(seen, estimator, LINE_FEATURES)), "expensive")


@query
def forest_classify(spark, folder):
    """The production forest with its defaults."""
    return _classify(spark, folder, models.forest_classifier("expensive"))


@query
def forest_min_split(spark, folder):
    """Only the root holds as many rows as a node must have to be split, so every tree ends as its first split."""
    lines = table(spark, folder, "lineitem")
    lines = lines.select("l_quantity", (F.col("l_quantity") + 100 * F.col("l_discount") > 28).cast("int").alias("large"))
    forest = models.forest_classifier("large", numTrees=3, maxBins=64)
    model = models.fit(lines, forest, ["l_quantity"], min_samples_split=lines.count())
    nodes = models.tree_nodes(spark, model).groupBy("treeID").count().agg(F.max("count").alias("n_nodes"))
    called = models.predict(lines, model).groupBy("l_quantity").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("prediction").cast("int").alias("lowest"), F.max("prediction").cast("int").alias("highest")
    )
    return called.crossJoin(F.broadcast(nodes))


@query
def tree_classify(spark, folder):
    return _classify(spark, folder, models.tree_classifier("expensive", 5))


@query
def svm_classify(spark, folder):
    lines = stats.standardize(fixtures.expensive_lines(spark, folder, ["l_orderkey"]), LINE_FEATURES)
    seen, held = _sides(lines)
    model = models.fit(seen, models.linear_svm("expensive", 1.0, seen.count()), LINE_FEATURES)
    return _verdict(models.predict(held, model), "expensive").withColumn("converged", F.lit(models.converged(model)))


@query
def forest_regress(spark, folder):
    lines = table(spark, folder, "lineitem")
    net = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net")
    features = ["l_extendedprice", "l_discount", "l_tax"]
    seen, held = _sides(lines.select("l_orderkey", *features, net))
    scored = models.predict(held, models.fit(seen, models.forest_regressor("net"), features))
    error = F.avg(F.pow(F.col("prediction") - F.col("net"), F.lit(2.0)))
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), (error < F.var_pop("net") / 4).alias("beats_mean"))


def _encoded_sides(spark, folder):
    """Train and test rows of the encoded marriage table."""
    encoded, _ = etl.encode_table(fixtures.raw_marriages(spark, folder), MARRIAGES)
    encoded = materialize(encoded, "encoded")
    parts = split.train_test_split(encoded, ["row_id"], SEED, TEST_SIZE, stratify=MARRIAGES.target)
    parts = materialize(parts, "split", ["split"])
    return {name: parts.filter(F.col("split") == name).drop("split") for name in ("train", "test")}


def _folded(train_rows):
    return split.stratified_folds(train_rows, ["row_id"], SEED, 5, MARRIAGES.target)


@query
def cv_scores(spark, folder):
    """Five folds of each trial: their rows and positives, and whether the score follows from the kept predictions."""
    trial_rows = [
        {"trial": 0, "classifier": "DecisionTreeClassifier", "tree_max_depth": 3},
        {"trial": 1, "classifier": "RandomForest", "rf_max_depth": 4, "rf_n_estimators": 4},
        {"trial": 2, "classifier": "SVC_poly", "svc_c": 1.0, "svc_poly_degree": 2},
    ]
    folded = _folded(_encoded_sides(spark, folder)["train"])
    kept = new_path(spark, "fold-predictions")
    scores = search.cv_scores(folded, trial_rows, MARRIAGES.features, MARRIAGES.target, predictions=kept)
    return _recounted(spark, scores, kept).select("trial", "fold", "n_rows", "n_positive", "score_holds")


def _recounted(spark, scores, kept):
    """Scores beside what the kept predictions say: F1 is twice the hits by all that is or is called positive."""
    positive, called = F.col(MARRIAGES.target) > 0, F.col("prediction") > 0
    told = spark.read.parquet(f"{kept}/*").groupBy("trial", "fold").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(positive).alias("n_positive"),
        F.count_if(called).alias("n_called"),
        F.count_if(positive & called).alias("n_hits"),
    )
    f1 = F.coalesce(F.try_divide(2.0 * F.col("n_hits"), F.col("n_positive") + F.col("n_called")), F.lit(0.0))
    return scores.join(told, ["trial", "fold"]).withColumn("score_holds", F.abs(F.col("score") - f1) < 1e-12)


@query
def model_search(spark, folder):
    """A search over all families, its winner scored on the test rows, registered and promoted."""
    sides = _encoded_sides(spark, folder)
    label = MARRIAGES.target
    kept = new_path(spark, "search-predictions")
    found = search.model_search(
        _folded(sides["train"]), MARRIAGES.features, label, SEARCH_TRIALS, SEARCH_SEED, startup=SEARCH_STARTUP, batch=SEARCH_BATCH, predictions=kept
    )
    store = Store(spark, new_path(spark, "store"))
    train.publish_search(store, "search", "model", found, sides["train"], sides["test"], MARRIAGES.features, label)
    means = trials.mean_of_folds(found.scores)
    first = means.orderBy(F.desc("mean_score"), "trial").limit(1).select(F.col("trial").alias("first"))
    facts = _recounted(spark, found.scores, kept).agg(
        F.count(F.lit(1)).alias("n_scores"),
        F.countDistinct("trial").alias("n_trials"),
        F.count_if(~F.col("score_holds")).alias("n_wrong"),
    )
    families = found.trials.agg(F.countDistinct("classifier").alias("n_families"))
    standing = registry.resolve_alias(store.table("model_aliases"), store.table("model_versions"), train.CHAMPION)
    scored = store.table("model_aliases").select(F.col("challenger_score").between(0, 1).alias("has_test_score"))
    joined = facts.crossJoin(families).crossJoin(first).crossJoin(standing.select("name", "version")).crossJoin(scored)
    won = (F.col("first") == found.best["trial"]).alias("best_is_highest")
    return joined.select("n_scores", "n_trials", "n_families", "n_wrong", won, "name", "version", "has_test_score")


@query
def train_and_promote(spark, folder):
    """Three trainings; the alias stands for the second, with the scores that decided it."""
    sides = _encoded_sides(spark, folder)
    store = Store(spark, new_path(spark, "store"))
    label = MARRIAGES.target
    common = (store, "promotion", "model", sides["train"], sides["test"], MARRIAGES.features, label)
    train.train_initial(*common, models.tree_classifier(label, 1))
    train.retrain(*common, models.tree_classifier(label, 6))
    train.retrain(*common, models.tree_classifier(label, 1))
    return store.table("model_aliases").select(
        "name", "alias", "version", "metric", (F.col("challenger_score") > F.col("champion_score")).alias("challenger_better")
    )


def _scoring(spark, folder):
    """A dictionary and a model trained on the encoded marriage table."""
    encoded, dictionary = etl.encode_table(fixtures.raw_marriages(spark, folder), MARRIAGES)
    encoded = materialize(encoded, "encoded")
    estimator = models.forest_classifier(MARRIAGES.target, **TREES)
    return dictionary, models.fit(encoded, estimator, MARRIAGES.features)


def request_files(rows: int) -> int:
    """How many files hold so many requests: an even number, at least four."""
    return max(4, 2 * -(-rows // (2 * ROWS_PER_FILE)))


def _outcomes(accepted, quarantined):
    good = accepted.select("row_id", F.lit("accepted").alias("status"), "str_output")
    reasons = [F.when(F.size(c) > 0, F.lit(c)) for c in ("missing", "violations", "unseen")]
    why = F.array_join(F.array_compact(F.array(*reasons)), "+")
    return good.unionByName(quarantined.select("row_id", why.alias("status"), F.lit(None).alias("str_output")))


@query
def score_requests(spark, folder):
    """Every request ends as a reply or in quarantine, with the reason."""
    dictionary, model = _scoring(spark, folder)
    requests = fixtures.marriage_requests(spark, folder)
    scored = score.score_requests(requests, "body", MARRIAGES, dictionary, model, ["row_id"])
    outcomes = _outcomes(scored.accepted, scored.quarantined)
    return outcomes.select("row_id", "status", F.col("str_output").isNotNull().alias("answered"))


@query
def score_stream(spark, folder):
    """Rows per outcome, and how many of them a stream over the same requests got otherwise."""
    dictionary, model = _scoring(spark, folder)
    source = new_path(spark, "requests")
    requests = fixtures.marriage_requests(spark, folder)
    # Two batches, in files that grow in number and not in size.
    files = request_files(requests.count())
    requests.repartition(files, "row_id").write.parquet(source)
    target = new_path(spark, "scored")
    stream = streaming.request_stream(spark, source, requests.schema, maxFilesPerTrigger=str(files // 2))
    running = streaming.score_stream(
        stream, "body", MARRIAGES, dictionary, model, ["row_id"], target, new_path(spark, "stream-checkpoint")
    )
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()
    written = streaming.read_scored(spark, target, ["row_id"])
    streamed = _outcomes(written.accepted, written.quarantined)
    scored = score.score_requests(spark.read.parquet(source), "body", MARRIAGES, dictionary, model, ["row_id"])
    batch = _outcomes(scored.accepted, scored.quarantined)
    both = batch.alias("b").join(streamed.alias("s"), "row_id", "full_outer")
    same = F.col("b.status").eqNullSafe(F.col("s.status")) & F.col("b.str_output").eqNullSafe(F.col("s.str_output"))
    return both.groupBy(F.coalesce("b.status", "s.status").alias("status")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("differing")
    )


# whole flows


def _wide_csv(spark, folder):
    """The marriage table as files come: other columns and another order, integers with a fraction."""
    raw = fixtures.raw_marriages(spark, folder)
    wide = raw.select(
        *reversed(raw.columns[1:]), F.lit("x").alias("extra"), F.concat("dur_mat", F.lit(".0")).alias("_dur"), F.col("row_id")
    )
    path = new_path(spark, "wide-csv")
    write_csv(wide.drop("dur_mat").withColumnRenamed("_dur", "dur_mat"), path)
    return path


@query
def ingest_wide_csv(spark, folder):
    """Read a file without a key by the header's names; the rows get keys of their own."""
    keyless = new_path(spark, "keyless-csv")
    rows = spark.read.option("header", True).csv(_wide_csv(spark, folder)).drop("row_id")
    write_csv(rows, keyless)
    layout = etl.Layout(new_path(spark, "etl"))
    etl.run(spark, keyless, layout, MARRIAGES, DESCRIBED_CATEGORIES, SEED, TEST_SIZE)
    raw = spark.read.parquet(layout.raw)
    typed = clean.clean(raw, MARRIAGES).drop("row_id")
    keys = raw.agg(F.countDistinct("row_id").alias("n_keys"))
    return typed.crossJoin(F.broadcast(keys))


@query
def score_accuracy(spark, folder):
    """Replies to the good requests against the rule that the target follows."""
    dictionary, model = _scoring(spark, folder)
    requests = fixtures.marriage_requests(spark, folder)
    replies = score.score_requests(requests, "body", MARRIAGES, dictionary, model, ["row_id"]).accepted
    truth = fixtures.marriages(spark, folder).select("row_id", F.col(MARRIAGES.target).cast("int").alias("target"))
    both = replies.join(truth, "row_id")
    right = F.avg((F.col("int_output") == F.col("target")).cast("double"))
    labelled = F.count_if((F.col("int_output") > 0) == (F.col("str_output") == POSITIVE_LABEL))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), labelled.alias("n_labelled"), (right > 0.75).alias("accurate"))


@query
def stream_follows_champion(spark, folder):
    """A stream over two waves of requests, with a promotion between them."""
    dictionary, _ = _scoring(spark, folder)
    sides = _encoded_sides(spark, folder)
    store = Store(spark, new_path(spark, "store"))
    label = MARRIAGES.target
    source, target, checkpoint = (new_path(spark, name) for name in ("requests", "scored", "stream-checkpoint"))
    requests = fixtures.marriage_requests(spark, folder)
    late = F.substring(F.md5(F.col("row_id").cast("string")), 1, 1) >= "8"
    current = streaming.CurrentModel(store, "model")
    used = []
    for wave, flipped in ((requests.where(~late), False), (requests.where(late), True)):
        rows = sides["train"].withColumn(label, 1 - F.col(label)) if flipped else sides["train"]
        version, _ = train.fit_and_log(
            store, "stream", "model", rows, sides["test"], MARRIAGES.features, label, models.forest_classifier(label, **TREES), "accuracy"
        )
        store.set_alias("model", train.CHAMPION, version)
        wave.write.mode("append").parquet(source)
        stream = streaming.request_stream(spark, source, requests.schema)
        running = streaming.score_stream(stream, "body", MARRIAGES, dictionary, current, ["row_id"], target, checkpoint)
        running.awaitTermination()
        if running.exception() is not None:
            raise running.exception()
        used.append(current.version)
    replies = streaming.read_scored(spark, target, ["row_id"]).accepted
    truth = fixtures.marriages(spark, folder).select("row_id", F.col(label).cast("int").alias("target"))
    second = F.substring(F.md5(F.col("row_id").cast("string")), 1, 1) >= "8"
    right = F.avg((F.col("int_output") == F.when(second, 1 - F.col("target")).otherwise(F.col("target"))).cast("double"))
    found = replies.join(truth, "row_id").groupBy(second.alias("second_wave")).agg(F.count(F.lit(1)).alias("n_rows"), (right > 0.75).alias("accurate"))
    return found.withColumn("version", F.when(F.col("second_wave"), F.lit(used[1])).otherwise(F.lit(used[0])))


@query
def export_split(spark, folder):
    """The files of a split, read again: features and target of both parts."""
    source = new_path(spark, "source-csv")
    write_csv(fixtures.raw_marriages(spark, folder), source)
    layout, target = etl.Layout(new_path(spark, "etl")), new_path(spark, "export")
    etl.run(spark, source, layout, MARRIAGES, DESCRIBED_CATEGORIES, SEED, TEST_SIZE)
    etl.export_split(spark, layout, MARRIAGES, target)
    found = None
    for part in ("train", "test"):
        x = spark.read.option("header", True).option("inferSchema", False).csv(f"{target}/{part}/X_{part}")
        y = spark.read.option("header", True).csv(f"{target}/{part}/y_{part}")
        typed = align.concat_columns(x, y, ["row_id"]).select(*[F.col(c).cast("long").alias(c) for c in [*x.columns, MARRIAGES.target]])
        rows = typed.withColumn(MARRIAGES.target, F.col(MARRIAGES.target).cast("int")).withColumn("split", F.lit(part))
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def etl_flow(spark, folder):
    """Delimited text in, encoded and split table out."""
    source = _wide_csv(spark, folder)
    layout = etl.Layout(new_path(spark, "etl"))
    etl.run(spark, source, layout, MARRIAGES, DESCRIBED_CATEGORIES, SEED, TEST_SIZE)
    return spark.read.parquet(layout.split)


@query
def encode_then_correlate(spark, folder):
    """The association report of an encoded table."""
    encoded, _ = etl.encode_table(fixtures.raw_marriages(spark, folder), MARRIAGES)
    report = stats.correlation_with_target(encoded, MARRIAGES.features, MARRIAGES.target)
    return report.withColumn("correlation", F.round("correlation", 8))
