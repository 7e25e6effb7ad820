"""Per-value normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = r"^[\s\p{Z}\x{1C}-\x{1F}\x{85}]*$"  # blanks of all scripts, no-break ones too


def clean(col: Column, dtype: T.DataType) -> Column:
    """NULL for a blank string or a NaN; any other value is returned unchanged, untrimmed."""
    if isinstance(dtype, T.StringType):
        return F.when(~F.rlike(col, F.lit(BLANK)), col)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def clean_text(col: Column) -> Column:
    return clean(col, T.StringType())


def clock_minute(col: Column) -> Column:
    """Minute part of a clock: '64:10' gives 64, '45' gives 45."""
    text = clean_text(col.cast("string"))
    return F.trim(F.split_part(text, F.lit(":"), F.lit(1))).cast("int")


def single_outcome(event_type: Column, pass_outcome: Column, shot_outcome: Column) -> Column:
    passed, shot = clean_text(pass_outcome), clean_text(shot_outcome)
    return (
        F.when(event_type == "Pass", passed)
        .when(event_type == "Shot", shot)
        .otherwise(F.coalesce(passed, shot))
    )


def coordinate(location: Column, axis: int) -> Column:
    """One axis of a two-element location; NULL for any other length."""
    return F.when(F.size(location) == 2, F.get(location, axis))


def prune(col: Column, dtype: T.DataType) -> Column:
    """Drop NULLs and blanks at every depth, following the column's type.

    Array elements and map entries that become NULL are removed here. NULL struct fields are left
    for ``to_json``, which omits them. Types JSON lacks are rendered as text.
    """
    if isinstance(dtype, T.StructType):
        inner = F.struct(
            *[prune(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        )
        return F.when(col.isNotNull(), inner)
    if isinstance(dtype, T.ArrayType):
        kept = F.transform(col, lambda x: prune(x, dtype.elementType))
        return F.filter(kept, lambda x: x.isNotNull())
    if isinstance(dtype, T.MapType):
        kept = F.transform_values(col, lambda _, v: prune(v, dtype.valueType))
        return F.map_filter(kept, lambda _, v: v.isNotNull())
    if isinstance(dtype, (T.StringType, T.DoubleType, T.FloatType)):
        return clean(col, dtype)
    if isinstance(dtype, (T.BooleanType, T.NumericType)):
        return col
    return col.cast("string")


def payload(schema: T.StructType, core: set[str]) -> Column:
    """Every non-core column of ``schema`` folded into one JSON object, NULLs left out."""
    rest = [f for f in schema.fields if f.name not in core]
    if not rest:
        return F.lit("{}")
    return F.to_json(F.struct(*[prune(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rest]))
