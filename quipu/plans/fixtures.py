"""Tables in the shapes this work expects, derived row by row from the data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.schema import DOUBLE, LONG, MARRIAGES, TEXT, Field, Table
from quipu.sources.requests import to_request
from quipu.sources.tables import table

MONTHS = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]

# One expression per column, in the SQL that Spark and other engines share.
MARRIAGE_COLUMNS = {
    "row_id": "o_orderkey",
    "dur_mat": "o_custkey % 66",
    "hijos_2": "o_orderkey % 7",
    "edad_2": "18 + o_custkey % 70",
    "edad_1": "18 + o_orderkey % 70",
    "area_1": "CASE WHEN o_orderstatus = 'F' THEN 'Rural' ELSE 'Urbana' END",
    "area_2": "CASE WHEN o_orderkey % 3 = 0 THEN 'Rural' ELSE 'Urbana' END",
    "hijos_rec": "o_orderkey % 13",
    "mcap_bie": "CASE WHEN o_totalprice > 200000 THEN 'Si' ELSE 'No' END",
    "p_etnica1": "CASE WHEN o_custkey % 5 = 0 THEN 'Indígena' ELSE 'Mestizo' END",
    "cant_insc": "concat('Cantón ', CAST(o_custkey % 221 AS {text}))",
    "p_etnica2": "CASE WHEN o_orderkey % 4 = 0 THEN 'Indígena' ELSE 'Mestizo' END",
    "cant_hab1": "concat('Cantón ', CAST(o_orderkey % 221 AS {text}))",
    "cant_hab2": "concat('Cantón ', CAST((o_orderkey + o_custkey) % 221 AS {text}))",
    "sabe_leer2": "CASE WHEN o_orderkey % 10 = 0 THEN 'No' ELSE 'Si' END",
    "sabe_leer1": "CASE WHEN o_custkey % 10 = 0 THEN 'No' ELSE 'Si' END",
    "mes_nac1": "{pick}({months}, CAST(o_custkey % 12 + 1 AS INT))",
    "niv_inst2": "o_orderpriority",
    "prov_insc": "concat('Provincia ', CAST(o_custkey % 24 AS {text}))",
    "mes_nac2": "{pick}({months}, CAST(o_orderkey % 12 + 1 AS INT))",
    "es_divorcio": "(o_custkey % 66 < 25 AND o_orderkey % 13 < 9) <> (o_orderkey % 19 = 0)",
}


def marriage_select(text: str, pick: str, opening: str, closing: str) -> str:
    """The select list of the derived table in the dialect of an engine."""
    months = opening + ", ".join(f"'{m}'" for m in MONTHS) + closing
    filled = {name: e.format(text=text, pick=pick, months=months) for name, e in MARRIAGE_COLUMNS.items()}
    return ", ".join(f"{e} AS {name}" for name, e in filled.items())


def marriages(spark: SparkSession, folder: str) -> DataFrame:
    """A typed marriage table with one row per order and a learnable target."""
    columns = marriage_select("STRING", "element_at", "array(", ")")
    return spark.sql(f"SELECT {columns} FROM {{orders}}", orders=table(spark, folder, "orders"))


def raw_marriages(spark: SparkSession, folder: str) -> DataFrame:
    """The same as text, the way a delimited file holds it."""
    typed = marriages(spark, folder)
    return typed.select("row_id", *[F.col(c).cast("string").alias(c) for c in typed.columns if c != "row_id"])


def marriage_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request text per row; some lack a field, hold a wrong type, or are cut off."""
    rows = marriages(spark, folder)
    rows = rows.withColumn("dur_mat", F.when(F.col("row_id") % 23 == 0, F.lit(66)).otherwise(F.col("dur_mat")))
    rows = rows.withColumn("hijos_2", F.when(F.col("row_id") % 11 != 0, F.col("hijos_2")))
    rows = rows.withColumn(
        "prov_insc", F.when(F.col("row_id") % 29 == 0, F.lit("Atlántida")).otherwise(F.col("prov_insc"))
    )
    good = to_request(MARRIAGES)
    # Some send a whole number with a fraction of zero, or as text.
    loose = F.when(F.col("row_id") % 5 == 0, F.regexp_replace(good, '"edad_2":([0-9]+)', '"edad_2":$1.0'))
    loose = loose.when(F.col("row_id") % 5 == 1, F.regexp_replace(good, '"edad_2":([0-9]+)', '"edad_2":"$1"'))
    good = loose.otherwise(good)
    wrong_type = F.regexp_replace(good, '"edad_1":[0-9]+', '"edad_1":"mucho"')
    cut_off = F.substring(good, 1, 40)
    body = F.when(F.col("row_id") % 17 == 0, cut_off).when(F.col("row_id") % 13 == 0, wrong_type).otherwise(good)
    return rows.select("row_id", body.alias("body"))


LINES = Table(
    fields=(
        Field("l_quantity", DOUBLE, 5, 40),
        Field("l_extendedprice", DOUBLE),
        Field("l_discount", DOUBLE, 0.01, 0.09),
        Field("l_tax", DOUBLE),
        Field("l_linenumber", LONG, 1, 6),
        Field("l_returnflag", TEXT),
        Field("l_linestatus", TEXT),
    ),
    target="expensive",
    key="l_orderkey",
)
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def expensive_lines(spark: SparkSession, folder: str, keys: list[str] | None = None) -> DataFrame:
    """Order lines with a label that their features determine."""
    lines = table(spark, folder, "lineitem")
    expensive = (F.col("l_extendedprice") > 30_000).cast("int")
    return lines.select(*(keys or []), *LINE_FEATURES, expensive.alias("expensive"))
