"""The record envelope: rows to ``(key, JSON value)`` and back.

Both directions are narrow projections: no shuffle, no Python. What the JSON
text looks like (NULL fields left out, NaN and infinities as text, timestamps
cut to milliseconds) is Spark's ``to_json``/``from_json`` default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flightloom.schemas import MESSAGE

# Keeps the microseconds that the default format cuts.
LOSSLESS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

CORRUPT = "_corrupt_record"


def record_key(column: str) -> Column:
    """Record key of a row: the number as text, NULL stays NULL."""
    return F.col(column).cast("string")


def encode(df: DataFrame, key: str, lossless_time: bool = False) -> DataFrame:
    """One record per row: ``key`` and all columns as one JSON object."""
    options = LOSSLESS if lossless_time else {}
    return df.select(
        record_key(key).alias("key"), F.to_json(F.struct("*"), options).alias("value")
    )


def messages(records: DataFrame) -> DataFrame:
    """Typed view of topic records: payload text and broker time, nothing else."""
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    ).to(MESSAGE)


def _parsed(schema: StructType, lossless_time: bool, corrupt: bool) -> Column:
    options = dict(LOSSLESS) if lossless_time else {}
    if corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT
    return F.from_json(F.col("value").cast("string"), schema, options)


def decode(
    records: DataFrame,
    schema: StructType,
    lossless_time: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """Payload columns by ``schema``, then the broker ``timestamp``.

    Unreadable fields become NULL, as does every field of an unreadable payload;
    with ``corrupt`` such a payload is also kept whole in ``_corrupt_record``.
    """
    if "timestamp" in schema.names:
        raise ValueError("payload field 'timestamp' would clash with the broker time")
    data = _parsed(schema, lossless_time, corrupt).alias("data")
    return messages(records).select(data, "timestamp").select("data.*", "timestamp")


def decode_nested(records: DataFrame, schema: StructType) -> DataFrame:
    """Payload as struct ``data`` next to struct ``record``, so no names clash.

    ``data`` carries ``_corrupt_record``; ``record`` says where the row came from.
    """
    origin = ["topic", "partition", "offset", "timestamp"]
    return records.select(
        F.struct(*origin, F.col("value").cast("string").alias("payload")).alias("record"),
        _parsed(schema, lossless_time=False, corrupt=True).alias("data"),
    )
