"""The ten operators over the given tables, with the parameters they run with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import bpe, context_mixing, decontaminate, exact_dedup, features, fill_middle, language, licenses, ngram_join, quality, suffix_dedup, token_files, vector_codes, warc
from quipu.llm.tables import table
from quipu.session import materialize, new_path

MULTILINGUAL = bpe.RankFile(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
ENGLISH = bpe.TokenizerFile(public_tokenizers.path("byte_bpe_50k.json"))
ENGLISH_IDS = 50_257
END_ID = 2


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal texts; of each the row with the largest id stays."""
    return exact_dedup.classes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove all bytes covered by 100-byte strings that also start earlier."""
    cut = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all texts by one shuffle of distinct words, and decode the ids again."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), MULTILINGUAL)
    return bpe.decode(encoded, MULTILINGUAL).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    out = features.held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.where(~out))
    rows = docs.select("doc_id", out.alias("held_out"), "text")
    return language.predict(rows, model).drop("text")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a Jaccard similarity of four-word shingles of 0.85 or more."""
    return ngram_join.classes(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = features.held_out(F.col("doc_id"), 3, 1)
    model = quality.fit(docs, labels.where(~out))
    rows = quality.score(docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all paragraphs of all documents."""
    docs = table(spark, sf_dir, "documents")
    return licenses.notices(docs, licenses.train(licenses.sample(docs)))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as archives, read them back, and put the transactions together."""
    path = new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path, repeats=True)
    return warc.captures(warc.assemble(warc.read(spark, path)))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all token ids as files in the order of the documents, and read them back."""
    path = new_path(spark, "token-files")
    order = token_files.write(table(spark, sf_dir, "documents"), ENGLISH, ENGLISH_IDS, END_ID, path)
    return token_files.checksums(token_files.read(spark, path, order))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a test item, exact or edited."""
    return decontaminate.pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts by context mixing, learnt from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scored = context_mixing.score(docs, ~features.held_out(F.col("doc_id"), 7, 2))
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), *columns)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors by codebooks fitted on all vectors, with their errors."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.fit(rows, parts=4, entries=256, rounds=4, scale=1024)
    coded = vector_codes.label_errors(materialize(vector_codes.encode(rows, books), "vector-codes"))
    spelled = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select("vec_id", spelled.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts rearranged to fill in the middle, and rebuilt from the outputs."""
    moved = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=7, percent=100, spm_percent=50)
    return fill_middle.restore(moved).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_language": op4_language,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_warc": op8_warc,
    "op9_token_files": op9_token_files,
    "op10_decontaminate": op10_decontaminate,
    "op11_lm_score": op11_lm_score,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_middle": op13_fill_middle,
}



def _vector_codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """The rounds one after the other, each a table of books and a table of nearest entries."""
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT)) AS v,
                   row_number() OVER (ORDER BY vec_id) - 1 AS place
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
        )""",
        f"""parts AS MATERIALIZED (
            SELECT place, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x
            FROM kept, (SELECT unnest(range({parts})) AS p)
        )""",
        f"book0 AS MATERIALIZED (SELECT p, place AS e, x AS b FROM parts WHERE place < {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
            SELECT place, p, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS best
            FROM (SELECT place, p, x, e, list_sum(list_transform(list_zip(x, b), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::BIGINT AS d
                  FROM parts JOIN book{r} USING (p))
            GROUP BY place, p
        )""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
                SELECT p, e, coalesce(m, b) AS b
                FROM book{r} LEFT JOIN (
                    SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS m
                    FROM (SELECT p, best.e AS e, i, sum(x[i])::DOUBLE AS s, count(*) AS n
                          FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i)
                          GROUP BY p, best.e, i)
                    GROUP BY p, e
                ) USING (p, e)
            )""")
    return f"""
        WITH {", ".join(steps)},
        coded AS (
            SELECT place, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
            FROM near{rounds} GROUP BY place
        ),
        digest AS (SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (place), digest
    """


ORACLE_SQL: dict[str, str] = {
    "op12_vector_codes": _vector_codes_sql(4, 256, 4, 1024),
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_warc": """
        WITH hashed AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
        ),
        digits AS (
            SELECT page_id, payload, translate(
                       to_base(('0x' || substr(digest, 1, 10))::BIGINT, 32, 8) ||
                       to_base(('0x' || substr(digest, 11, 10))::BIGINT, 32, 8) ||
                       to_base(('0x' || substr(digest, 21, 10))::BIGINT, 32, 8) ||
                       to_base(('0x' || substr(digest, 31, 10))::BIGINT, 32, 8),
                       '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
            FROM hashed
        )
        SELECT page_id, strlen(payload) AS payload_bytes, payload_digest,
               CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
        FROM digits
        WINDOW same AS (PARTITION BY payload)
    """,
    "op13_fill_middle": r"""
        WITH lined AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS digest,
                   regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
            FROM documents
        ),
        drawn AS (
            SELECT doc_id, text, units, len(units) AS n,
                   ('0x' || substr(digest, 1, 8))::BIGINT % (len(units) + 1) AS one,
                   ('0x' || substr(digest, 9, 8))::BIGINT % (len(units) + 1) AS two,
                   ('0x' || substr(digest, 17, 8))::BIGINT % 100 AS chance,
                   ('0x' || substr(digest, 25, 8))::BIGINT % 100 AS kind
            FROM lined
        ),
        parted AS (
            SELECT doc_id, text, n,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR chance >= 100
                        THEN 'plain' WHEN kind < 50 THEN 'spm' ELSE 'psm' END AS form,
                   array_to_string(units[1:least(one, two)], '') AS prefix,
                   array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
                   array_to_string(units[greatest(one, two) + 1:], '') AS suffix
            FROM drawn
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                                ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parted
    """,
}
