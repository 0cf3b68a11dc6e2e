"""JSON read without a given schema: every line is a VARIANT, its type is found from all lines.

A field that always holds numbers of one kind gets that type; of whole numbers and fractions the wider one; a field
whose values have no common type stays VARIANT, and field_types says which types it had, how often. Nothing is
sampled, so a type seen in one line of a billion is in the result.

Defined cases: a text that is no JSON is NULL in the variant column, and its text is kept by read_json_inferred; a
field that is always null is STRING; a NULL text counts as no value at all; no rows give no fields.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    NullType,
    StringType,
    StructField,
    StructType,
)

from playmart.sources.feeds import CORRUPT, Paths, json_reader, path_list

# A quoted name, which may hold anything, or the start of an object.
_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")


def _readable(kind: DataType) -> DataType:
    """The type with STRING in place of the type of null."""
    if isinstance(kind, NullType):
        return StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_readable(kind.elementType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _readable(f.dataType)) for f in kind.fields])
    return kind


def variant_type(text: str) -> DataType:
    """The Spark type of a variant schema, such as OBJECT<a: BIGINT, b: ARRAY<STRING>>."""
    ddl = _OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    return _readable(StructType.fromDDL(f"v {ddl}")["v"].dataType)


def inferred_type(df: DataFrame, column: str) -> DataType:
    """The common type of a VARIANT column, from all rows. One value, the merged type, is fetched.

    It is as large as there are different fields: keys that are data (ids as keys) belong into field_types instead.
    """
    found = df.agg(F.schema_of_variant_agg(column)).first()[0]
    return StructType() if found in (None, "VOID") else variant_type(found)


def typed_fields(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """The top-level fields of a VARIANT column as columns of their inferred types; `keep` names columns carried along.

    A field named like a kept column is an error. A value that is no object has no fields.
    """
    kind = inferred_type(df, column)
    if not isinstance(kind, StructType):
        # Some values are no objects, so the type of the others is asked for alone.
        objects = F.schema_of_variant(column).startswith("OBJECT<")
        df = df.withColumn(column, F.when(objects, F.col(column)))
        kind = inferred_type(df, column)
    clash = sorted({f.lower() for f in kind.fieldNames()} & {k.lower() for k in keep})
    if clash:
        raise ValueError(f"fields named like kept columns: {clash}")
    if not kind.fields:
        return df.select(*keep)
    whole = F.col(column).cast(kind)
    return df.select(*keep, *[whole.getField(f.name).alias(f.name) for f in kind.fields])


def parsed(df: DataFrame, column: str, name: str = "parsed") -> DataFrame:
    """A JSON text column beside its VARIANT, NULL where it is no JSON."""
    return df.withColumn(name, F.try_parse_json(column))


def read_json_inferred(spark: SparkSession, paths: Paths, *, recursive: bool = False) -> DataFrame:
    """JSON lines with columns of inferred types, and the text of lines that are no JSON object."""
    lines = json_reader(spark, recursive).text(path_list(paths)).where(F.trim("value") != "")
    rows = parsed(lines, "value", "_parsed")
    is_object = F.coalesce(F.schema_of_variant("_parsed").startswith("OBJECT<"), F.lit(False))
    rows = rows.select(
        F.when(is_object, F.col("_parsed")).alias("_parsed"), F.when(~is_object, F.col("value")).alias(CORRUPT)
    )
    return typed_fields(rows, "_parsed", [CORRUPT])


def field_types(df: DataFrame, column: str, by: Sequence[str] = (), depth: int = 3) -> DataFrame:
    """How often each field of a VARIANT column has each type: by columns, path, type, row_count.

    Paths go `depth` levels down; the elements of a list share the path `[]`. Types are the kinds of values:
    a field that holds objects of different shapes is still one OBJECT, and decimals are one type whatever their digits.
    """
    own = [f"_{i}" for i in range(len(by))]
    kind = F.regexp_extract(F.schema_of_variant("_value"), r"^[A-Z_ ]+", 0)
    level = df.select(*[F.col(b).alias(o) for b, o in zip(by, own)], F.lit("$").alias("_path"), F.col(column).alias("_value"))
    counted = []
    for _ in range(depth):
        one = level.lateralJoin(level.sparkSession.tvf.variant_explode(F.col("_value").outer()))
        step = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), F.col("key")))
        level = one.select(*own, F.concat("_path", step).alias("_path"), F.col("value").alias("_value"))
        counted.append(level.groupBy(*own, "_path", kind.alias("type")).agg(F.count(F.lit(1)).alias("row_count")))
    rows = counted[0]
    for more in counted[1:]:
        rows = rows.unionByName(more)
    # A path is of one depth unless a key holds dots or brackets; such counts are added up.
    rows = rows.groupBy(*own, "_path", "type").agg(F.sum("row_count").alias("row_count"))
    return rows.select(*[F.col(o).alias(b) for o, b in zip(own, by)], F.col("_path").alias("path"), "type", "row_count")


def drifting(types: DataFrame) -> DataFrame:
    """Of a field_types report the paths with more than one type other than null: path, types, row_count."""
    per_type = types.where("type <> 'VOID'").groupBy("path", "type").agg(F.sum("row_count").alias("row_count"))
    per_path = per_type.groupBy("path").agg(
        F.array_join(F.array_sort(F.collect_set("type")), ", ").alias("types"), F.sum("row_count").alias("row_count")
    )
    return per_path.where(F.col("types").contains(","))
