"""Declared tables: column order, types, bounds, target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG = T.LongType()
DOUBLE = T.DoubleType()
TEXT = T.StringType()
FLAG = T.BooleanType()


@dataclass(frozen=True)
class Field:
    """One feature: its type and, if bounded, its inclusive range."""

    name: str
    type: T.DataType
    low: float | None = None
    high: float | None = None

    @property
    def bounded(self) -> bool:
        return self.low is not None or self.high is not None


@dataclass(frozen=True)
class Table:
    """Features in the order the model sees them, the target, and the row key."""

    fields: tuple[Field, ...]
    target: str
    key: str = "row_id"

    @property
    def features(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def text_features(self) -> list[str]:
        return [f.name for f in self.fields if f.type == TEXT]

    @property
    def numeric_features(self) -> list[str]:
        return [f.name for f in self.fields if f.type != TEXT]

    def types(self, with_target: bool = True) -> dict[str, T.DataType]:
        types = {f.name: f.type for f in self.fields}
        if with_target:
            types[self.target] = FLAG
        return types

    def feature_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    def raw_schema(self) -> T.StructType:
        """The table as delimited text holds it: a key, and text everywhere else."""
        names = [*self.features, self.target]
        return T.StructType([T.StructField(self.key, LONG), *(T.StructField(n, TEXT) for n in names)])

    def request_schema(self) -> T.StructType:
        """One scoring request: the features under a ``features`` object."""
        return T.StructType([T.StructField("features", self.feature_schema())])


# Column names, types, order and bounds of the marriage table,
# and the labels of a scoring reply.
MARRIAGES = Table(
    fields=(
        Field("dur_mat", LONG, 0, 65),
        Field("hijos_2", LONG, 0, 150),
        Field("edad_2", LONG, 0, 120),
        Field("edad_1", LONG, 0, 120),
        Field("area_1", TEXT),
        Field("area_2", TEXT),
        Field("hijos_rec", LONG, 0, 12),
        Field("mcap_bie", TEXT),
        Field("p_etnica1", TEXT),
        Field("cant_insc", TEXT),
        Field("p_etnica2", TEXT),
        Field("cant_hab1", TEXT),
        Field("cant_hab2", TEXT),
        Field("sabe_leer2", TEXT),
        Field("sabe_leer1", TEXT),
        Field("mes_nac1", TEXT),
        Field("niv_inst2", TEXT),
        Field("prov_insc", TEXT),
        Field("mes_nac2", TEXT),
    ),
    target="es_divorcio",
)
DESCRIBED_CATEGORIES = ["area_1", "area_2", "mcap_bie", "p_etnica1", "cant_insc", "p_etnica2"]
POSITIVE_LABEL = "Divorcio"
NEGATIVE_LABEL = "No divorcio"
