"""For each registered query that SQL can express, the same result in DuckDB's SQL."""

from __future__ import annotations

from quipu.operators.trials import FAMILIES
from quipu.plans.fixtures import LINE_FEATURES, marriage_select
from quipu.schema import DESCRIBED_CATEGORIES, MARRIAGES

SEED = 42

TYPED = f"typed AS (SELECT {marriage_select('VARCHAR', 'list_extract', '[', ']')} FROM orders)"
NAMES = [*MARRIAGES.features, MARRIAGES.target]


def _hash(*key: str) -> str:
    texts = ", '|', ".join(_part(k) for k in key)
    return f"md5(concat('{SEED}|', {texts}))"


def _part(key: str) -> str:
    return f"length(CAST({key} AS VARCHAR)), ':', CAST({key} AS VARCHAR)"


def _codes(column: str, source: str) -> str:
    return f"(SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT {column} AS value FROM {source}))"


def _encoded(columns: list[str], source: str) -> str:
    """Each text column replaced by its place among its sorted distinct values."""
    texts = MARRIAGES.text_features
    shown = [f"c_{c}.code AS {c}" if c in texts else f"t.{c}" for c in columns]
    joins = " ".join(f"LEFT JOIN {_codes(c, source)} c_{c} ON c_{c}.value = t.{c}" for c in columns if c in texts)
    return f"SELECT {', '.join(shown)} FROM {source} t {joins}"


CLEAN = "cleaned AS (SELECT * REPLACE (CAST(es_divorcio AS INTEGER) AS es_divorcio) FROM typed)"
ENCODED = f"encoded AS ({_encoded(['row_id', *NAMES], 'cleaned')})"


def _texts() -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in NAMES)


def _test_sizes(test_size: str) -> str:
    """Rows of the test part per class: train rows by largest remainder."""
    return f"""
    counts AS (SELECT s, count(*) AS n FROM base GROUP BY s),
    total AS (SELECT CAST(sum(n) AS BIGINT) AS n FROM counts),
    wanted AS (SELECT n, n - CAST(ceil(CAST({test_size} AS DOUBLE) * n) AS BIGINT) AS train FROM total),
    floors AS (SELECT s, c.n, (c.n * train) // w.n AS lo, (c.n * train) % w.n AS rest, train FROM counts c, wanted w),
    placed AS (SELECT *, row_number() OVER (ORDER BY rest DESC, s) AS place, sum(lo) OVER () AS given FROM floors),
    sizes AS (SELECT s, n - lo - CASE WHEN place <= train - given THEN 1 ELSE 0 END AS n_test FROM placed),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY h) AS place FROM base)"""


def _split(key: str, stratum: str, source: str, shown: str, test_size: str) -> str:
    return f"""
    base AS (SELECT {shown}, {stratum} AS s, {_hash(key)} AS h FROM {source}),
    {_test_sizes(test_size)},
    parted AS (SELECT r.* EXCLUDE (place, h), CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS split
               FROM ranked r JOIN sizes USING (s))"""


ORDERS_SPLIT = _split("o_orderkey", "o_orderstatus", "orders", "o_orderkey, o_orderstatus", "0.3")

FOLDS = 5
FOLD_STARTS = f"""
    base AS (SELECT o_orderkey, o_orderpriority AS s, {_hash('o_orderkey')} AS h FROM orders),
    counts AS (SELECT s, count(*) AS n FROM base GROUP BY s),
    runs AS (SELECT s, CAST(sum(n) OVER (ORDER BY s) AS BIGINT) - n AS first, n FROM counts),
    dealt AS (SELECT s, i AS fold, (first + n + {FOLDS - 1} - i) // {FOLDS} - (first + {FOLDS - 1} - i) // {FOLDS} AS size
              FROM runs, range({FOLDS}) r(i)),
    ends AS (SELECT s, fold, sum(size) OVER (PARTITION BY s ORDER BY fold) AS last FROM dealt),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY h) AS place FROM base)"""


def _pearson(column: str, target: str) -> str:
    return f"SELECT '{column}' AS feature, round(corr({target}, CAST({column} AS DOUBLE)), 8) AS correlation FROM source"


def _correlations(columns: list[str], target: str) -> str:
    return " UNION ALL ".join(_pearson(c, target) for c in columns)


def _gain(feature: str, value: str, target: str) -> str:
    return f"""
    SELECT '{feature}' AS feature, round(greatest(sum(n / t * ln((n / t) / ((nx / t) * (ny / t)))), 0.0), 8) AS information_gain
    FROM (SELECT CAST(n AS DOUBLE) AS n, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny, sum(n) OVER () AS t
          FROM (SELECT {value} AS x, {target} AS y, count(*) AS n FROM source GROUP BY ALL))"""


def _binned(column: str, bins: int) -> str:
    """How many distinct quantiles lie below the value."""
    shares = ", ".join(str(i / bins) for i in range(1, bins))
    edges = f"SELECT DISTINCT unnest(quantile_disc({column}, [{shares}])) AS edge FROM lines"
    return f"(SELECT count(*) FROM ({edges}) WHERE edge < lines.{column})"


def _digamma(n: str) -> str:
    """At a whole number: the asymptotic series ten steps up, less the reciprocals in between."""
    z = f"({n} + 10.0::DOUBLE)"
    series = f"ln({z}) - 0.5 / {z} - 1 / (12 * pow({z}, 2)) + 1 / (120 * pow({z}, 4)) - 1 / (252 * pow({z}, 6)) + 1 / (240 * pow({z}, 8))"
    return f"({series} - " + " - ".join(f"1 / ({n} + {j}.0::DOUBLE)" for j in range(10)) + ")"


def _near_information(features: list[str], target: str, key: str, source: str, k: int) -> str:
    """Nearest-neighbour information of each feature, ranks being looked up in the sorted values."""

    def points(c: str) -> str:
        unit = f"(SELECT CASE WHEN m > 0 THEN pow(2.0::DOUBLE, floor(log2(m)) - 30) ELSE pow(2.0::DOUBLE, -30) END FROM (SELECT max(abs({c}::DOUBLE)) AS m FROM {source}))"
        return f"SELECT '{c}' AS feature, {target} AS y, {key} AS id, {c}::DOUBLE + {_uniform(c, key)} * {unit} AS x FROM {source} WHERE {c} IS NOT NULL"

    beside = ", ".join(f"{side}(x, {i}) OVER w AS {side}{i}" for side in ("lag", "lead") for i in range(1, k + 1))
    near = ", ".join(f"struct_pack(d := abs({side}{i} - x), v := {side}{i})" for side in ("lag", "lead") for i in range(1, k + 1))
    return f"""
    every AS MATERIALIZED ({" UNION ALL ".join(points(c) for c in features)}),
    points AS MATERIALIZED (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY feature, y) AS n FROM every) WHERE n > 1),
    beside AS (SELECT *, {beside} FROM points WINDOW w AS (PARTITION BY feature, y ORDER BY x, id)),
    far AS (SELECT feature, n, x, list_sort(list_filter([{near}], lambda s: s.v IS NOT NULL))[least({k}, n - 1)] AS far FROM beside),
    ends AS (SELECT feature, n, x, CASE WHEN far.v < x THEN far.v ELSE x - far.d END AS low,
             CASE WHEN far.v > x THEN far.v ELSE x + far.d END AS high FROM far),
    ranks AS MATERIALIZED (SELECT feature, x, sum(count(*)) OVER (PARTITION BY feature ORDER BY x) AS rank FROM points GROUP BY feature, x),
    counted AS (SELECT e.feature, n, coalesce(h.rank, 0) - coalesce(l.rank, 0) AS m
                FROM ends e ASOF LEFT JOIN ranks h ON e.feature = h.feature AND e.high > h.x
                ASOF LEFT JOIN ranks l ON e.feature = l.feature AND e.low >= l.x)
    SELECT feature, round(greatest({_digamma("count(*)")} + avg({_digamma(f"least({k}, n - 1)")}) - avg({_digamma("n")}) - avg({_digamma("m")}), 0.0), 8) AS information_gain
    FROM counted GROUP BY feature"""


def _uniform(name: str, key: str) -> str:
    digits = f"substr(md5(concat('{SEED}|{name}|', {_part(key)})), 1, 8)"
    return f"(CAST(concat('0x', {digits}) AS BIGINT) / 4294967296.0::DOUBLE)"


def _log_int(name: str, low: int, high: int) -> str:
    u = _uniform(name, "o_orderkey")
    value = f"exp(ln({low - 0.5}::DOUBLE) + {u} * (ln({high + 0.5}::DOUBLE) - ln({low - 0.5}::DOUBLE)))"
    return f"CAST(greatest({low}, least({high}, round({value}))) AS INTEGER)"


def _running(by: str) -> str:
    frame = f"OVER ({by} ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
    trials AS (SELECT o_orderstatus AS study, o_orderkey AS trial, o_totalprice AS value FROM orders),
    seen AS (SELECT *, max(value) {frame} AS best, max(nullif(value, 0)) {frame} AS previous FROM trials),
    improved AS (SELECT *, abs(previous - value) / value * 100 AS percent FROM seen
                 WHERE (best IS NULL OR value > best) AND value <> 0)"""


PART_VERSIONS = """
    versions AS (SELECT p_brand AS name, CAST(p_partkey AS INTEGER) AS version,
                 CASE WHEN p_type = 'ECONOMY' THEN 'None' ELSE p_type END AS stage,
                 concat('s3://models/', p_brand, '/', CAST(p_partkey AS VARCHAR)) AS source FROM part)"""

# What the derived requests lack or hold wrongly, told from the row number alone.
REQUESTS = f"""
    {TYPED},
    requests AS (SELECT row_id, row_id % 17 = 0 AS cut_off, row_id % 13 = 0 AS wrong_type, row_id % 11 = 0 AS no_hijos,
                 row_id % 23 = 0 AS long_marriage, row_id % 29 = 0 AS unknown_place FROM typed),
    missing AS (SELECT *, CASE WHEN cut_off THEN '{",".join(MARRIAGES.features)}'
                ELSE concat_ws(',', CASE WHEN no_hijos THEN 'hijos_2' END, CASE WHEN wrong_type THEN 'edad_1' END)
                END AS missing FROM requests),
    outcomes AS (SELECT row_id, concat_ws('+', CASE WHEN missing <> '' THEN 'missing' END,
                CASE WHEN long_marriage AND NOT cut_off THEN 'violations' END,
                CASE WHEN unknown_place AND NOT cut_off THEN 'unseen' END) AS reasons FROM missing)"""


def _json_names(names: list[str]) -> str:
    return "[" + ",".join(f'"{n}"' for n in names) + "]"


def _json_types(types: dict[str, str]) -> str:
    return "{" + ",".join(f'"{n}":"{t}"' for n, t in types.items()) + "}"


def _category_entry() -> str:
    arrays = [
        f"(SELECT concat('\"{c}\":', CAST(to_json(list(v ORDER BY v)) AS VARCHAR)) FROM (SELECT DISTINCT {c} AS v FROM typed))"
        for c in sorted(DESCRIBED_CATEGORIES)
    ]
    return "concat('{', " + ", ',', ".join(arrays) + ", '}')"


TEXT_TYPES = {c: "string" for c in MARRIAGES.features}
CODE_TYPES = {c: "bigint" for c in MARRIAGES.features}

ORACLE: dict[str, str] = {
    "csv_roundtrip": "SELECT * FROM customer",
    "data_dictionary": f"""
        WITH {TYPED}
        SELECT 'columns' AS key, '{_json_names(MARRIAGES.features)}' AS value
        UNION ALL SELECT 'columns_after_clean', '{_json_names(MARRIAGES.features)}'
        UNION ALL SELECT 'target_col', '"{MARRIAGES.target}"'
        UNION ALL SELECT 'categorical_columns', '{_json_names(DESCRIBED_CATEGORIES)}'
        UNION ALL SELECT 'columns_dtypes', '{_json_types(dict(sorted(TEXT_TYPES.items())))}'
        UNION ALL SELECT 'columns_dtypes_after_clean', '{_json_types(dict(sorted(CODE_TYPES.items())))}'
        UNION ALL SELECT 'categories_values_per_categorical', {_category_entry()}
        UNION ALL SELECT 'date', concat('"', strftime(max(o_orderdate), '%Y/%m/%d-%H:%M:%S'), '"') FROM orders""",
    "category_pages": f"""
        WITH {TYPED} {" UNION ".join(f"SELECT '{c}' AS column, {c} AS value FROM typed" for c in DESCRIBED_CATEGORIES)}""",
    "model_roundtrip": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS differing FROM lineitem",
    "project_features": f"WITH {TYPED} SELECT {_texts()} FROM typed",
    "cast_schema": f"WITH {TYPED} SELECT * FROM typed",
    "bool_to_int": f"WITH {TYPED}, {CLEAN} SELECT row_id, es_divorcio FROM cleaned",
    "clean_table": f"WITH {TYPED}, {CLEAN} SELECT * FROM cleaned",
    "features_target": f"WITH {TYPED} SELECT * EXCLUDE (es_divorcio) FROM typed",
    "target_column": f"WITH {TYPED} SELECT es_divorcio FROM typed",
    "validate_ranges": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, concat_ws(',',
            CASE WHEN l_quantity < 5 OR l_quantity > 40 THEN 'l_quantity' END,
            CASE WHEN l_discount < 0.01 OR l_discount > 0.09 THEN 'l_discount' END,
            CASE WHEN l_linenumber < 1 OR l_linenumber > 6 THEN 'l_linenumber' END) AS violations
        FROM lineitem""",
    "validate_required": f"""
        WITH {REQUESTS}
        SELECT row_id, missing, cut_off AS corrupt, missing = '' AS valid FROM missing""",
    "unseen_labels": """
        SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, 'nation' AS unseen FROM customer
        WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)""",
    "score_label": """
        SELECT doc_id, toxic AS int_output, CASE WHEN toxic > 0 THEN 'Divorcio' ELSE 'No divorcio' END AS str_output
        FROM labels""",
    "assemble_features": 'SELECT event_id, value AS "first", CAST(user_id AS DOUBLE) AS "second" FROM events',
    "alignment_check": """
        WITH l AS (SELECT doc_id, count(*) AS n FROM documents GROUP BY 1),
        r AS (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1),
        both_sides AS (SELECT coalesce(l.n, 0) AS l, coalesce(r.n, 0) AS r FROM l FULL OUTER JOIN r USING (doc_id)),
        report AS (SELECT CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows,
            count(*) FILTER (r = 0) AS left_only, count(*) FILTER (l = 0) AS right_only, count(*) FILTER (l > 1 OR r > 1) AS repeated FROM both_sides)
        SELECT *, left_rows = right_rows AND left_only = 0 AND right_only = 0 AND repeated = 0 AS aligned FROM report""",
    "concat_xy": "SELECT doc_id, lang, n_chars, quality FROM documents JOIN labels USING (doc_id)",
    "label_dictionary": f"""
        SELECT 'p_name' AS "column", value, code FROM {_codes('p_name', 'part')}
        UNION ALL SELECT 'p_brand', value, code FROM {_codes('p_brand', 'part')}
        UNION ALL SELECT 'p_type', value, code FROM {_codes('p_type', 'part')}""",
    "encode_with_dictionary": f"""
        SELECT p_partkey, b.code AS p_brand, t.code AS p_type, p_name, p_size FROM part
        JOIN {_codes('p_brand', 'part')} b ON b.value = p_brand JOIN {_codes('p_type', 'part')} t ON t.value = p_type""",
    "encode_all_strings": f"WITH {TYPED}, {CLEAN}, {ENCODED} SELECT * FROM encoded",
    "encode_large_dictionary": f"""
        WITH base AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders)
        SELECT o_orderkey, customer, code FROM base JOIN {_codes('customer', 'base')} c ON c.value = customer""",
    "decode_codes": "SELECT p_partkey, p_brand, p_type FROM part",
    "one_hot_drop_first": """
        SELECT doc_id, lang = 'en' AS lang_en, lang = 'es' AS lang_es, lang = 'fr' AS lang_fr FROM documents""",
    "stratified_split": f"WITH {ORDERS_SPLIT} SELECT o_orderkey, o_orderstatus, split FROM parted",
    "random_split": f"""
        WITH {_split('event_id', '0', 'events', 'event_id', '0.25')} SELECT event_id, split FROM parted""",
    "stratified_folds": f"""
        WITH {FOLD_STARTS}
        SELECT o_orderkey, r.s AS o_orderpriority, CAST(count_if(e.last < place) AS INTEGER) AS fold
        FROM ranked r JOIN ends e ON e.s = r.s GROUP BY ALL""",
    "split_partition_check": """
        SELECT count(*) AS input_rows, count(*) AS part_rows, CAST(0 AS BIGINT) AS missing,
            CAST(0 AS BIGINT) AS overlapping, CAST(0 AS BIGINT) AS extra, true AS is_partition FROM orders""",
    "paired_sample": f"""
        WITH {TYPED}, chosen AS (SELECT row_id, es_divorcio AS t FROM typed ORDER BY {_hash('row_id')} LIMIT 100)
        SELECT 'raw' AS side, row_id, CAST(t AS VARCHAR) AS target FROM chosen
        UNION ALL SELECT 'clean', row_id, CAST(CAST(t AS INTEGER) AS VARCHAR) FROM chosen""",
    "category_values": """
        SELECT DISTINCT 'lang' AS "column", lang AS value FROM documents
        UNION ALL SELECT DISTINCT 'source', source FROM documents""",
    "correlation_with_target": f"""
        WITH source AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_f FROM lineitem)
        {_correlations([*LINE_FEATURES, 'l_linenumber'], 'is_f')}""",
    "information_gain": f"""
        WITH source AS (SELECT * FROM lineitem)
        {_gain('l_returnflag', 'l_returnflag', 'l_linestatus')}
        UNION ALL {_gain('l_linenumber', 'l_linenumber', 'l_linestatus')}
        UNION ALL {_gain('l_quantity', 'l_quantity', 'l_linestatus')}""",
    "information_gain_knn": f"WITH {TYPED}, {CLEAN}, {ENCODED}, {_near_information(MARRIAGES.features, MARRIAGES.target, 'row_id', 'encoded', 3)}",
    "information_gain_binned": f"""
        WITH lines AS (SELECT l_quantity, l_discount, l_extendedprice > 30000 AS expensive FROM lineitem),
        source AS (SELECT expensive, {_binned('l_quantity', 8)} AS q, {_binned('l_discount', 8)} AS d FROM lines)
        {_gain('l_quantity', 'q', 'expensive')}
        UNION ALL {_gain('l_discount', 'd', 'expensive')}""",
    "accuracy": "SELECT avg(CAST(quality = toxic AS INTEGER)) AS accuracy FROM labels",
    "f1_binary": """
        SELECT 2.0::DOUBLE * count_if(quality = 1 AND toxic = 1)
            / (2 * count_if(quality = 1 AND toxic = 1) + count_if((quality = 1) <> (toxic = 1))) AS f1 FROM labels""",
    "cv_mean": "SELECT o_custkey AS trial, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS mean_score FROM orders GROUP BY 1",
    "scaler_stats": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM lineitem"""
        for c in LINE_FEATURES
    ),
    "standardize": """
        WITH s AS (SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mp, stddev_pop(p_retailprice) AS sp
                   FROM part)
        SELECT p_partkey, round((p_size - ms) / ss, 6) AS p_size, round((p_retailprice - mp) / sp, 6) AS p_retailprice
        FROM part, s""",
    "encode_large_columns": """
        WITH told AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_orderdate AS VARCHAR) AS day, o_orderstatus AS status,
            CASE WHEN o_custkey % 3 > 0 THEN o_orderpriority END AS priority FROM orders)
        SELECT o_orderkey, dense_rank() OVER (ORDER BY customer) - 1 AS customer, dense_rank() OVER (ORDER BY day) - 1 AS day,
            dense_rank() OVER (ORDER BY status) - 1 AS status,
            CASE WHEN priority IS NOT NULL THEN dense_rank() OVER (ORDER BY priority NULLS LAST) - 1 END AS priority FROM told""",
    "trial_grid": f"""
        WITH drawn AS (SELECT o_orderkey,
            [{", ".join(f"'{f}'" for f in FAMILIES)}][CAST(floor({_uniform('classifier', 'o_orderkey')} * {len(FAMILIES)}) AS INTEGER) + 1]
            AS classifier FROM orders)
        SELECT o_orderkey AS trial, classifier,
            CASE WHEN starts_with(classifier, 'SVC') THEN round(exp(ln(0.01::DOUBLE) + {_uniform('svc_c', 'o_orderkey')}
                * (ln(100.0::DOUBLE) - ln(0.01::DOUBLE))), 6) END AS svc_c,
            CASE WHEN classifier = 'SVC_poly' THEN CAST(2 + floor({_uniform('svc_poly_degree', 'o_orderkey')} * 5) AS INTEGER) END AS svc_poly_degree,
            CASE WHEN classifier = 'DecisionTreeClassifier' THEN {_log_int('tree_max_depth', 2, 30)} END AS tree_max_depth,
            CASE WHEN classifier = 'RandomForest' THEN {_log_int('rf_max_depth', 2, 30)} END AS rf_max_depth,
            CASE WHEN classifier = 'RandomForest' THEN {_log_int('rf_n_estimators', 2, 10)} END AS rf_n_estimators
        FROM drawn""",
    "running_champion": f"""
        WITH {_running('')}
        SELECT trial, value, previous, CASE WHEN previous IS NULL THEN 'initial' ELSE 'improved' END AS kind,
            round(percent, 8) AS improvement_percent,
            CASE WHEN previous IS NULL THEN format('Initial trial {{}} achieved value: {{}}', trial, value)
                 ELSE format('Trial {{}} achieved value: {{}} with {{: .4f}}% improvement', trial, value, percent) END AS message
        FROM improved""",
    "running_champion_per_study": f"""
        WITH {_running('PARTITION BY study')}
        SELECT study, trial, value, previous, CASE WHEN previous IS NULL THEN 'initial' ELSE 'improved' END AS kind
        FROM improved""",
    "best_trial": """
        SELECT o_orderstatus AS study, o_orderkey AS trial, o_totalprice AS value FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) = 1""",
    "latest_version": f"""
        WITH {PART_VERSIONS} SELECT * FROM versions WHERE stage = 'None'
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1""",
    "assign_version": """
        SELECT o_orderpriority AS name, o_orderkey AS seq, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey)
            + CASE WHEN o_orderpriority = '1-URGENT' THEN (SELECT max(p_size) FROM part) ELSE 0 END AS INTEGER) AS version
        FROM orders""",
    "resolve_alias": """
        SELECT o_orderpriority AS name, 'F' AS alias, CAST(o_custkey AS INTEGER) AS version,
            concat('s3://models/', o_orderpriority, '/', CAST(o_custkey AS VARCHAR)) AS source,
            concat('run-', CAST(o_custkey AS VARCHAR)) AS run_id
        FROM orders WHERE o_orderstatus = 'F'
        QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_custkey DESC) = 1""",
    "insert_if_absent": """
        SELECT s_nationkey AS name, min(s_suppkey) AS id FROM supplier WHERE s_acctbal < 0 GROUP BY 1
        UNION ALL SELECT c_nationkey, min(c_custkey) FROM customer
            WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0) GROUP BY 1""",
    "dictionary_merge": """
        SELECT coalesce(s_suppkey, p_partkey) AS key, CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE p_name END AS value
        FROM part FULL OUTER JOIN supplier ON p_partkey = s_suppkey""",
    "champion_vs_challenger": """
        SELECT avg(CAST(quality = toxic AS INTEGER)) AS champion_score, avg(CAST(quality = 1 AS INTEGER)) AS challenger_score,
            challenger_score > champion_score AS promote,
            CASE WHEN promote THEN 'challenger' ELSE 'champion' END AS winner FROM labels""",
    "parse_uri": """
        SELECT doc_id, source AS bucket, concat(lang, '/', CAST(doc_id AS VARCHAR), '/artifacts/model') AS key,
            CAST(doc_id AS VARCHAR) AS run_of_address, CAST(doc_id AS VARCHAR) AS run_of_uri FROM documents""",
    "uri_scheme": """
        SELECT page_id, starts_with(url, 'https://') AS secure, string_split(url, '/')[3] AS host,
            string_split(substr(url, 5), '/')[1] AS rest FROM pages""",
    "run_name": """
        SELECT event_id, concat('ETL_run_', strftime(ts, '%Y/%m/%d-%H:%M:%S')) AS dashed,
            concat('Challenger_', strftime(ts, '%Y%m%d_%H%M%S')) AS compact, concat('Trial: ', CAST(event_id AS VARCHAR)) AS trial
        FROM events""",
    "json_props": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
            concat('{"k":', CAST(json_extract(props, '$.k') AS VARCHAR), ',"type":"', event_type, '"}') AS body FROM events""",
    "params_map": """
        SELECT c_custkey, 'name' AS tag, c_name AS value FROM customer
        UNION ALL SELECT c_custkey, 'segment', lower(c_mktsegment) FROM customer
        UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer""",
    "classifier_family": "SELECT p_partkey, contains(p_name, 'ring') AS is_family FROM part",
    "improvement": """
        SELECT p_partkey, round(abs(p_retailprice - p_size) / CAST(p_size AS DOUBLE) * 100, 6) AS percent,
            printf('%.4f', abs(p_retailprice - p_size) / CAST(p_size AS DOUBLE) * 100) AS shown FROM part""",
    "model_signature": f"""
        SELECT 'inputs' AS side, unnest([{", ".join(f"'{c}'" for c in LINE_FEATURES)}]) AS name, 'double' AS type
        UNION ALL SELECT 'outputs', 'prediction', 'double'""",
    **{
        name: """
        SELECT count(*) AS n_rows, count(*) FILTER (l_extendedprice > 30000) AS n_positive, true AS beats_majority
        FROM lineitem WHERE substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 1) >= 'b'"""
        for name in ("forest_classify", "tree_classify")
    },
    "svm_classify": """
        SELECT count(*) AS n_rows, count(*) FILTER (l_extendedprice > 30000) AS n_positive, true AS beats_majority, true AS converged
        FROM lineitem WHERE substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 1) >= 'b'""",
    "forest_regress": "SELECT count(*) AS n_rows, true AS beats_mean FROM lineitem WHERE substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 1) >= 'b'",
    "train_and_promote": """
        SELECT 'model' AS name, 'champion' AS alias, CAST(1 AS INTEGER) AS version, 'f1' AS metric, CAST(NULL AS BOOLEAN) AS challenger_better
        UNION ALL SELECT 'model', 'champion', 2, 'accuracy', true""",
    "cv_scores": f"""
        WITH {TYPED}, {CLEAN},
        base AS (SELECT row_id, es_divorcio AS s, {_hash('row_id')} AS h FROM cleaned),
        {_test_sizes('0.3')},
        train AS (SELECT r.s, h FROM ranked r JOIN sizes USING (s) WHERE place > n_test),
        sums AS (SELECT s, count(*) AS n FROM train GROUP BY s),
        runs AS (SELECT s, CAST(sum(n) OVER (ORDER BY s) AS BIGINT) - n AS first, n FROM sums),
        dealt AS (SELECT s, i AS fold, (first + n + {FOLDS - 1} - i) // {FOLDS} - (first + {FOLDS - 1} - i) // {FOLDS} AS size
                  FROM runs, range({FOLDS}) r(i))
        SELECT trial, CAST(fold AS INTEGER) AS fold, CAST(sum(size) AS BIGINT) AS n_rows,
            CAST(sum(size) FILTER (s > 0) AS BIGINT) AS n_positive, true AS score_holds
        FROM dealt, range(3) t(trial) GROUP BY trial, fold""",
    "model_search": """
        SELECT CAST(35 AS BIGINT) AS n_scores, CAST(7 AS BIGINT) AS n_trials, CAST(5 AS BIGINT) AS n_families, CAST(0 AS BIGINT) AS n_wrong,
            true AS best_is_highest, 'model' AS name, CAST(1 AS INTEGER) AS version, true AS has_test_score""",
    "forest_min_split": """
        WITH told AS (SELECT l_quantity AS q, l_quantity + 100 * l_discount > 28 AS y FROM lineitem),
        sums AS (SELECT q, count(*) AS n, count(*) FILTER (y) AS p FROM told GROUP BY q),
        upto AS (SELECT q, n, sum(n) OVER w AS nl, sum(p) OVER w AS pl, sum(n) OVER () AS nt, sum(p) OVER () AS pt FROM sums WINDOW w AS (ORDER BY q)),
        sides AS (SELECT *, nt - nl AS nr, pt - pl AS pr FROM upto),
        best AS (SELECT arg_min(struct_pack(q := q, l := pl * 2 > nl, r := pr * 2 > nr),
                     nl * (1 - pow(pl / nl, 2) - pow(1 - pl / nl, 2)) + nr * (1 - pow(pr / nr, 2) - pow(1 - pr / nr, 2))) AS b
                 FROM sides WHERE nr > 0),
        called AS (SELECT q, n, CAST(CASE WHEN q <= b.q THEN b.l ELSE b.r END AS INTEGER) AS c FROM sums, best)
        SELECT q AS l_quantity, n AS n_rows, c AS lowest, c AS highest, CAST(3 AS BIGINT) AS n_nodes FROM called""",
    "ingest_wide_csv": f"""
        WITH {TYPED}, {CLEAN} SELECT * EXCLUDE (row_id), (SELECT count(*) FROM orders) AS n_keys FROM cleaned""",
    "score_accuracy": f"""
        WITH {REQUESTS} SELECT count(*) AS n_rows, count(*) AS n_labelled, true AS accurate FROM outcomes WHERE reasons = ''""",
    "stream_follows_champion": f"""
        WITH {REQUESTS}, waves AS (SELECT substr(md5(CAST(row_id AS VARCHAR)), 1, 1) >= '8' AS second_wave FROM outcomes WHERE reasons = '')
        SELECT second_wave, count(*) AS n_rows, true AS accurate, CAST(CASE WHEN second_wave THEN 2 ELSE 1 END AS INTEGER) AS version
        FROM waves GROUP BY 1""",
    "export_split": f"""
        WITH {TYPED}, {CLEAN}, {ENCODED},
        {_split('row_id', 'es_divorcio', 'encoded', '*', '0.3')}
        SELECT * EXCLUDE (s) FROM parted""",
    "score_requests": f"""
        WITH {REQUESTS}
        SELECT row_id, CASE WHEN reasons = '' THEN 'accepted' ELSE reasons END AS status, reasons = '' AS answered FROM outcomes""",
    "score_stream": f"""
        WITH {REQUESTS}
        SELECT CASE WHEN reasons = '' THEN 'accepted' ELSE reasons END AS status, count(*) AS n_rows, CAST(0 AS BIGINT) AS differing
        FROM outcomes GROUP BY 1""",
    "etl_flow": f"""
        WITH {TYPED}, {CLEAN}, {ENCODED},
        {_split('row_id', 'es_divorcio', 'encoded', '*', '0.3')}
        SELECT * EXCLUDE (s) FROM parted""",
    "encode_then_correlate": f"""
        WITH {TYPED}, {CLEAN}, {ENCODED}, source AS (SELECT * FROM encoded)
        {_correlations(MARRIAGES.features, 'es_divorcio')}""",
}
