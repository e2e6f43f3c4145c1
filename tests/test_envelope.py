from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from flightloom.functions import decode, decode_nested, encode, messages
from flightloom.functions.envelope import CORRUPT
from flightloom.operators import drop_tombstones
from flightloom.schemas import METADATA, RESULT, SAMPLES, WORD
from tests.util import plan, rows


def as_records(spark, payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    return df.select(F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))


def parse(spark, payload, schema=RESULT):
    [row] = decode(as_records(spark, [payload]), schema).drop("timestamp").collect()
    return tuple(row)


NOTHING = (None,) * len(RESULT)


@pytest.mark.parametrize(
    "payload, expected",
    [
        (None, NOTHING),
        ("", NOTHING),
        ("{", NOTHING),
        ("no json", NOTHING),
        ("{}", NOTHING),
        ('{"value":true}', NOTHING),
        ('{"ems_system_id":3000000000,"value":5}', (None, None, None, 5, None)),
        ('{"value":1.5,"ems_system_id":1}', (None, 1, None, None, None)),
        ('{"MaxOffset":"2.5","value":7}', (None, None, None, 7, None)),
        ('{"maxoffset":2.5,"value":7}', (None, None, None, 7, None)),
        ('{"value":7,"extra":1}', (None, None, None, 7, None)),
        ('{"value":7,"value":8}', (None, None, None, 8, None)),
        ('{"MaxOffset":"Infinity"}', (None, None, None, None, float("inf"))),
        ('{"value":9007199254740993}', (None, None, None, 9007199254740993, None)),
    ],
)
def test_decode_is_permissive(spark, payload, expected):
    assert parse(spark, payload) == expected


def test_nan_survives(spark):
    assert rows(decode(as_records(spark, ['{"MaxOffset":"NaN"}']), RESULT).select("MaxOffset")) == [
        ("NaN",)
    ]


def test_corrupt_column_keeps_unreadable_text(spark):
    payloads = ["{", '{"value":"x"}', '{"value":1}', None]
    out = decode(as_records(spark, payloads), RESULT, corrupt=True)
    assert {r[CORRUPT] for r in out.collect()} == {"{", '{"value":"x"}', None}


def test_null_fields_vanish_and_key_stays_null(spark):
    df = spark.createDataFrame([(None, None), (3, "a")], WORD)
    assert rows(encode(df, "unique_id")) == [("3", '{"unique_id":3,"word":"a"}'), (None, "{}")]


def test_default_time_is_cut_to_milliseconds_and_lossless_is_not(spark):
    time = datetime(2024, 1, 1, 0, 0, 7, 179575)
    schema = StructType([METADATA["ingestion_timestamp"], METADATA["unique_id"]])
    df = spark.createDataFrame([(time, 1)], schema)

    def back(lossless):
        records = encode(df, "unique_id", lossless).select(
            F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp")
        )
        return decode(records, schema, lossless).first().ingestion_timestamp

    assert back(False) == time.replace(microsecond=179000)
    assert back(True) == time


def test_payload_may_not_hold_a_timestamp(spark):
    schema = StructType([StructField("timestamp", StringType())])
    with pytest.raises(ValueError):
        decode(as_records(spark, ["{}"]), schema)


def test_messages_are_text_and_time(spark):
    out = messages(as_records(spark, ["é"]))
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "timestamp"]
    assert out.first().value == "é"


def test_decode_nested_keeps_clashing_names_apart(spark):
    records = as_records(spark, ['{"unique_id":1,"offset":2.5,"value":3}']).selectExpr(
        "value", "timestamp", "'t' as topic", "0 as partition", "9L as offset"
    )
    row = decode_nested(records, SAMPLES).first()
    assert (row.record.offset, row.data.offset, row.data.value) == (9, 2.5, 3)


def test_tombstones_are_dropped_and_empty_text_is_not(spark):
    assert drop_tombstones(as_records(spark, [None, "", "{}"])).count() == 2


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.none() | st.integers(-(2**31), 2**31 - 1),
            st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=8),
        ),
        min_size=1,
        max_size=8,
    )
)
def test_decode_undoes_encode(spark, data):
    df = spark.createDataFrame(data, WORD)
    records = encode(df, "unique_id").select(
        F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp")
    )
    assert rows(decode(records, WORD).drop("timestamp")) == rows(df)


def test_decode_parses_once_and_only_what_is_used(spark):
    records = as_records(spark, ["{}"])
    assert plan(decode(records, SAMPLES)).count("from_json") == 1
    narrow = plan(decode(records, SAMPLES).select("value"))
    assert "sub_part1" not in narrow


def test_long_survives_above_double_precision(spark):
    schema = StructType([StructField("n", LongType())])
    df = spark.createDataFrame([(2**53 + 1,)], schema)
    assert decode(as_records(spark, [encode(df, "n").first().value]), schema).first().n == 2**53 + 1
