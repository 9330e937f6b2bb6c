"""Stored schemas and the model registry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())

PAPER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("authors", _STRINGS),
        T.StructField("abstract", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("categories", _STRINGS),
        T.StructField("created", T.StringType()),
        T.StructField("updated", T.StringType()),
        T.StructField("license", T.StringType()),
    ]
)
PAPER_COLUMNS = PAPER_SCHEMA.fieldNames()

# An append-only history: the row with the greatest seq per (id, year, model_key) counts,
# and a null vector hides earlier ones. vector_sum is stored beside the vector so that
# the backlog query never reads the vectors themselves.
VECTOR_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("model_key", T.StringType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("vector_sum", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

TASK_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("model_key", T.StringType()),
    ]
)

STATUS_SCHEMA = T.StructType(
    TASK_SCHEMA.fields
    + [
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)


def yearly_schema(model_keys: Iterable[str] = ()) -> T.StructType:
    """Stored schema of the yearly table, with one vector column per model."""
    models = [T.StructField(key, T.ArrayType(T.FloatType())) for key in model_keys]
    return T.StructType([*PAPER_SCHEMA.fields, *models, T.StructField("year", T.IntegerType())])


@dataclass(frozen=True)
class ModelSpec:
    """One embedding model: its column key, the encoder's name and the vector length."""

    key: str
    name: str | None = None
    dimension: int | None = None


def registry(config: Mapping | Iterable[Mapping]) -> dict[str, ModelSpec]:
    """Model key → spec, from one ``{key: settings}`` table or a list of such tables.

    Settings are ``model_name`` and ``dimension``. A model without a dimension gets no
    backlog; a task of a model without a name fails as unconfigured.
    """
    tables = [config] if isinstance(config, Mapping) else list(config)
    specs: dict[str, ModelSpec] = {}
    for table in tables:
        for key, settings in table.items():
            if key not in specs and isinstance(settings, Mapping):
                specs[key] = ModelSpec(key, settings.get("model_name"), settings.get("dimension"))
    return specs
