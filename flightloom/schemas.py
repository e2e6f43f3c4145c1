"""Row types. Names, order and types are fixed values of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """``"a int, b string"`` to a nullable struct, without needing a session."""
    pairs = (item.split() for item in text.replace("\n", " ").split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


# Inline words.
WORD = _struct("unique_id int, word string")

# Sensor samples.
SAMPLES = _struct(
    """unique_id bigint, offset double, value bigint, ems_system_id int,
       file_type string, sub_part1 string, parameter_id string, sub_part2 string"""
)

# Flight metadata. The date-like strings and the long
# scheduled_ingestion_timestamp are meant to be of these types.
METADATA = _struct(
    """unique_id bigint, scheduled_ingestion_timestamp bigint,
       ingestion_timestamp timestamp, flight_date_exact string,
       adi_flight_record_number int, parameter_table string, data_type string,
       raw_metadata_string string, customer_code string, tail_number string,
       flight_number string, decode_generation_time string, airport_depart string,
       airport_arrival string, export_config_version string, parameter_id string,
       sub_part2 string, ems_system_id int, file_type string, sub_part1 string"""
)

# The result as published, and as landed (same columns, other order).
RESULT = _struct(
    """adi_flight_record_number int, ems_system_id int, parameter_id string,
       value bigint, MaxOffset double"""
)
LANDED = _struct(
    """ems_system_id int, adi_flight_record_number int, MaxOffset double,
       parameter_id string, value bigint"""
)

# What Spark's Kafka source returns.
RECORD = _struct(
    """key binary, value binary, topic string, partition string, offset bigint,
       timestamp timestamp, timestampType int"""
)

# A record as the decoders see it: payload text and broker time.
MESSAGE = _struct("value string, timestamp timestamp")

# Where a record that could not be landed came from, and why.
REJECTED = _struct(
    """reject_reason string, topic string, partition string, offset bigint,
       timestamp timestamp, payload string"""
)

# A line of a CSV spool that could not be landed, and why.
REJECTED_LINE = _struct("reject_reason string, line string")

# What became of the records of a part: one row per measure.
ACCOUNT = _struct("measure string, n bigint")
