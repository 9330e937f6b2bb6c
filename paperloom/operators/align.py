"""Bringing two tables to one schema before they are united."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from paperloom.functions.vectors import cast_vector, zero_vector
from paperloom.schema import ModelSpec

_VECTOR = T.ArrayType(T.FloatType())


def united_schema(a: DataFrame, b: DataFrame, models: Mapping[str, ModelSpec] | None = None) -> T.StructType:
    """Columns of ``a``, then those only in ``b``, then registered model columns in neither."""
    fields = {f.name: f for f in a.schema}
    for field in b.schema:
        fields.setdefault(field.name, field)
    for key in models or {}:
        fields.setdefault(key, T.StructField(key, _VECTOR))
    return T.StructType(list(fields.values()))


def add_missing(
    df: DataFrame,
    schema: T.StructType,
    models: Mapping[str, ModelSpec] | None = None,
    fill: str = "null",
) -> DataFrame:
    """Add absent columns and select in schema order.

    Absent columns become typed nulls; with ``fill="zero"`` an absent model column
    becomes zero vectors of its registered length.
    """
    models = models or {}
    out = []
    for field in schema:
        if field.name in df.columns:
            out.append(F.col(f"`{field.name}`"))
        elif fill == "zero" and field.name in models:
            out.append(zero_vector(models[field.name].dimension).alias(field.name))
        else:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*out)


def cast_models(df: DataFrame, models: Mapping[str, ModelSpec], check: bool = True) -> DataFrame:
    """Cast model columns to ``array<float>``; ``check`` rejects vectors of another length."""
    present = {
        key: cast_vector(key, spec.dimension if check else None)
        for key, spec in models.items()
        if key in df.columns
    }
    return df.withColumns(present) if present else df


def replace_column(df: DataFrame, name: str, values) -> DataFrame:
    """Replace a column, or append it; in both cases it ends up last."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], values.alias(name))


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """All rows of all inputs, by column name; types widen and absent columns become null."""
    out = first
    for other in rest:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def united(
    a: DataFrame,
    b: DataFrame,
    models: Mapping[str, ModelSpec] | None = None,
    fill: str = "null",
) -> tuple[DataFrame, DataFrame]:
    """Both sides in one schema, ready for a union."""
    schema = united_schema(a, b, models)
    sides = [add_missing(df, schema, models, fill) for df in (a, b)]
    if models:
        sides = [cast_models(df, models) for df in sides]
    return sides[0], sides[1]
