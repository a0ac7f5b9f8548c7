"""Schema rules: exact assertion, write-time enforcement, evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


class SchemaMismatch(ValueError):
    """A DataFrame's columns do not fit the table they are written to."""


def from_ddl(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def assert_schema(df: DataFrame, expected: StructType | str) -> None:
    """Exact equality: names, order, types and nullability."""
    want = from_ddl(expected)
    if df.schema != want:
        raise SchemaMismatch(f"expected {want.simpleString()}, found {df.schema.simpleString()}")


def enforce(df: DataFrame, table: StructType | str) -> DataFrame:
    """The DataFrame in table column order, absent columns as NULL.

    A column the table does not have, or one of another type, raises.
    """
    want = from_ddl(table)
    have = {f.name: f for f in df.schema}
    unknown = [n for n in have if n not in want.names]
    if unknown:
        raise SchemaMismatch(f"columns not in the table: {', '.join(unknown)}")
    wrong = [
        f"{f.name} is {have[f.name].dataType.simpleString()}, table has {f.dataType.simpleString()}"
        for f in want
        if f.name in have and have[f.name].dataType != f.dataType
    ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return df.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want
        ]
    )


def evolved(table: StructType | str, incoming: StructType | str) -> StructType:
    """Table schema plus the incoming columns it lacks; a changed type raises."""
    base, new = from_ddl(table), from_ddl(incoming)
    types = {f.name: f.dataType for f in base}
    wrong = [
        f"{f.name}: {types[f.name].simpleString()} to {f.dataType.simpleString()}"
        for f in new
        if f.name in types and types[f.name] != f.dataType
    ]
    if wrong:
        raise SchemaMismatch(f"type changes are not allowed: {'; '.join(wrong)}")
    extra = [StructField(f.name, f.dataType, True) for f in new if f.name not in types]
    return StructType([*base.fields, *extra])
