"""Delimited text, out and in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio_sync.functions.text import delimited_text, undelimited_text

JSON_OPTIONS = {"ignoreNullFields": "false"}


def _field(field: T.StructField) -> Column:
    column = F.col(field.name)
    kind = field.dataType
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        column = F.to_json(column, JSON_OPTIONS)
    elif isinstance(kind, T.BooleanType):
        column = F.when(column, F.lit("True")).when(~column, F.lit("False"))
    elif isinstance(kind, T.TimestampType):
        column = F.regexp_replace(
            F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"), r"\.000000", ""
        )
    elif not isinstance(kind, T.StringType):
        column = column.cast("string")
    return delimited_text(column)


def delimited_lines(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    r"""One tab-separated line per row in the column `value`.

    NULL is `\N`, nested columns are JSON, and backslash, tab and newline are
    escaped in every column.
    """
    fields = {field.name: field for field in df.schema}
    chosen = [_field(fields[name]) for name in (columns or df.columns)]
    return df.select(F.concat_ws("\t", *chosen).alias("value"))


def write_delimited(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    delimited_lines(df, columns).write.mode("errorifexists").text(path)


def _value(text: Column, kind: T.DataType) -> Column:
    value = undelimited_text(text)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(value, kind)
    return value if isinstance(kind, T.StringType) else value.try_cast(kind)


def read_delimited(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Rows of files written by `write_delimited`, with the columns in the schema's order."""
    fields = F.split("value", "\t", -1)
    return spark.read.text(paths).select(*[
        _value(F.get(fields, F.lit(i)), field.dataType).alias(field.name)
        for i, field in enumerate(schema)
    ])
