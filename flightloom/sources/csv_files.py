"""CSV with a header, written and read in parallel.

Line breaks in texts are written as ``\\n`` and ``\\r``, and a backslash as two, so that each
row is one line: a file of any size is then read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flightloom.functions.envelope import CORRUPT
from flightloom.schemas import ddl

# Quotes are doubled and blanks kept. NULL is an empty field, the empty text a quoted one.
_FORMAT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# What the parser calls an empty field; no text, so that "" is not taken for it.
_READ = {**_FORMAT, "nullValue": "\x00", "emptyValue": ""}
# No text has it, so that a line read with it is one field.
_NO_SEPARATOR = "\x01\x02\x03"
_CODES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def _one_line(text: Column) -> Column:
    for sign, code in _CODES:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def _as_written(text: Column) -> Column:
    """Undoes ``_one_line``: what stands between two double backslashes has single ones only."""

    def breaks(part: Column) -> Column:
        for sign, code in _CODES[1:]:
            part = F.replace(part, F.lit(code), F.lit(sign))
        return part

    parts = F.transform(F.split(text, r"\\\\"), breaks)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def _texts(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, StringType)]


def write_csv(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Each task writes its own files, with the column names as header.

    One column alone is refused: its NULL would be a blank line, which CSV readers skip.
    """
    if len(df.columns) < 2:
        raise ValueError("a CSV of one column cannot hold NULL rows")
    lines = df.withColumns({c: _one_line(F.col(c)) for c in _texts(df.schema)})
    writer = lines.write.options(header="true", **_FORMAT, nullValue="", emptyValue='""')
    writer.option("maxRecordsPerFile", rows_per_file).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: StructType, one_line: bool = True
) -> DataFrame:
    """Declared schema, no inference pass; unreadable fields become NULL.

    The header must name the schema's columns in order, else reading fails. ``one_line`` is how
    ``write_csv`` writes. Without it texts are taken as they stand and may hold line breaks;
    a file is then read by one task.
    """
    reader = spark.read.schema(schema).options(header="true", enforceSchema="false", **_READ)
    if not one_line:
        return reader.option("multiLine", "true").csv(path)
    rows = reader.option("lineSep", "\n").csv(path)
    return rows.withColumns({c: _as_written(F.col(c)) for c in _texts(schema)})


def read_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The lines below the headers, as ``line``; headers are checked as in ``read_csv``."""
    whole = StructType([StructField(",".join(schema.names), StringType())])
    reader = spark.read.schema(whole).options(
        header="true", enforceSchema="false", lineSep="\n", sep=_NO_SEPARATOR, quote="",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    )
    return reader.csv(path).toDF("line")


def parsed_line(line: Column | str, schema: StructType) -> Column:
    """A line as a struct of the schema's fields and ``_corrupt_record``.

    That is the line itself if a field cannot be read or fields are lacking or left over;
    fields that cannot be read are NULL.
    """
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {**_READ, "columnNameOfCorruptRecord": CORRUPT}
    data = F.from_csv(line, F.lit(ddl(with_corrupt)), options)
    fields = [
        (_as_written(data[f.name]) if f.name in _texts(schema) else data[f.name]).alias(f.name)
        for f in schema
    ]
    return F.struct(*fields, data[CORRUPT].alias(CORRUPT))
