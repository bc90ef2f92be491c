"""JSON lines without a stated schema, of files whose fields differ.

Lines are parsed once, to VARIANT. One aggregate over them gives the schema that holds all fields of
all lines, and the parsed values are cast to it; no file is read a second time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitescout import schemas
from sitescout.joins import cut_lineage

PARSED = "_parsed"
_QUOTED = re.compile(r"(`(?:[^`]|``)*`)")


def parse_objects(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines with ``_parsed``, the object as VARIANT: NULL if the line is malformed or no object."""
    parsed = F.try_parse_json(column)
    return lines.withColumn(PARSED, F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed))


def inferred_schema(objects: DataFrame) -> T.StructType:
    """The fields of all objects, in order of name; numbers are longs or doubles.

    A field of different types in different lines stays VARIANT, as does an object that is always
    empty; one that is always null is a string.
    """
    found = objects.agg(F.schema_of_variant_agg(PARSED)).first()[0]
    if not found.startswith("OBJECT<") or found == "OBJECT<>":
        return T.StructType()
    return T.StructType.fromDDL(_as_ddl(found)[len("struct<") : -1])


def _as_ddl(found: str) -> str:
    def names(part: str) -> str:
        part = re.sub(r"DECIMAL\(\d+,\s*\d+\)|FLOAT", "double", part.replace("OBJECT<>", "variant"))
        return part.replace("OBJECT<", "struct<").replace("VOID", "string")

    parts = _QUOTED.split(found)
    return "".join(part if i % 2 else names(part) for i, part in enumerate(parts))


def conflicts(schema: T.DataType, path: str = "") -> list[str]:
    """Paths of the fields whose types differ between lines; ``[]`` stands for the items of a list."""
    if isinstance(schema, T.VariantType):
        return [path]
    if isinstance(schema, T.ArrayType):
        return conflicts(schema.elementType, path + "[]")
    if isinstance(schema, T.StructType):
        return [p for f in schema for p in conflicts(f.dataType, f"{path}.{f.name}" if path else f.name)]
    return []


def typed(objects: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of the objects as columns, NULL where a line lacks them."""
    whole = objects.select(F.col(PARSED).cast(schema).alias(PARSED))
    return whole.select(*[F.col(PARSED).getField(f.name).alias(f.name) for f in schema])


def read_json_inferred(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(rows, malformed lines, conflicting paths) of JSON lines in a file, a directory or a glob."""
    lines = cut_lineage(parse_objects(spark.read.text(path)))
    schema = inferred_schema(lines.where(f"{PARSED} is not null"))
    malformed = lines.where(f"{PARSED} is null and trim(value) <> ''").select(F.col("value").alias(schemas.CORRUPT))
    return typed(lines.where(f"{PARSED} is not null"), schema), malformed, conflicts(schema)


def explode_object(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """A row for each field of the object in a VARIANT column: its name and its value, a VARIANT."""
    fields = df.sparkSession.tvf.variant_explode(F.col(column).outer())
    return df.lateralJoin(fields).drop("pos", column).withColumnsRenamed({"key": key, "value": value})


def checkins_from_json(rows: DataFrame) -> DataFrame:
    """(business_id, day_of_week, day_hour, check_in) from ``time`` as VARIANT: day -> hour -> count.

    Any days and hours may occur, so no struct of them is made.
    """
    days = explode_object(rows.select("business_id", "time"), "time", "day_of_week", "hours")
    hours = explode_object(days, "hours", "day_hour", "check_in")
    return hours.withColumn("check_in", as_long("check_in"))


def as_long(column: str) -> Column:
    return F.try_variant_get(column, "$", "long")
