from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from flightloom.functions import decode, encode
from flightloom.plans import filter_and_route, round_trip
from flightloom.schemas import RECORD, WORD
from flightloom.session import settings, shared_path
from flightloom.sources import FileTopics, KafkaTopics
from tests.util import plan, rows

WORDS = [(8, "kite"), (93, "otter"), (-5, "maple")]


@pytest.fixture
def words(spark):
    return spark.createDataFrame(WORDS, WORD)


@pytest.fixture
def topics(spark, path):
    return FileTopics(spark, path("topics"))


def test_records_have_the_kafka_columns(words, topics):
    topics.publish(encode(words, "unique_id"), "a")
    records = topics.read("a")
    assert [(f.name, f.dataType) for f in records.schema] == [(f.name, f.dataType) for f in RECORD]
    assert records.where("key is null or value is null or timestamp is null").count() == 0


def test_publishing_appends_and_numbers_records(spark, words, topics):
    many = spark.range(1000).selectExpr("cast(id as int) as unique_id", "'w' as word")
    for _ in range(3):
        topics.publish(encode(many, "unique_id"), "a")
    topics.publish(encode(words, "unique_id"), "b")
    records = topics.read("a", "b")
    assert records.count() == 3003
    assert records.select("topic", "partition", "offset").distinct().count() == 3003
    assert topics.read("b").count() == 3


def test_reading_lists_only_named_topics(words, topics):
    topics.publish(encode(words, "unique_id"), "a", "b")
    assert all("topic=b" in f for f in topics.read("b").inputFiles())


def test_topic_names_are_checked(words, topics):
    with pytest.raises(ValueError):
        topics.publish(encode(words, "unique_id"), "../x")
    for names in ((), ("a", "a")):
        with pytest.raises(ValueError):
            topics.publish(encode(words, "unique_id"), *names)


def test_reading_needs_a_topic(spark, topics):
    for read in (topics.read, topics.read_stream, KafkaTopics(spark, "h:1").source_options):
        with pytest.raises(ValueError):
            read()


def test_topic_names_stay_text(words, topics):
    topics.publish(encode(words, "unique_id"), "007")
    assert {r.topic for r in topics.read("007").collect()} == {"007"}


def test_null_key_and_tombstone_survive(spark, topics):
    topics.publish(spark.createDataFrame([(None, "v"), ("k", None)], "key string, value string"), "a")
    got = topics.read("a").select(F.col("key").cast("string"), F.col("value").cast("string"))
    assert rows(got) == [("k", None), (None, "v")]


def test_round_trip_of_a_rerun_returns_both(words, topics):
    first = round_trip(words, topics, "a", WORD)
    assert rows(first.drop("timestamp")) == rows(words)
    assert "timestamp" in first.columns
    assert round_trip(words, topics, "a", WORD).count() == 6


def test_route_sends_the_same_rows_to_both(words, topics):
    routed = filter_and_route(words, F.col("unique_id") == 8, topics, ["a", "b"], WORD)
    for name in ("a", "b"):
        assert rows(routed[name].drop("timestamp")) == [(8, "kite")]


def test_one_publish_scans_its_source_once(spark, words, topics):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = words.mapInArrow(count, WORD)
    filter_and_route(counted, F.lit(True), topics, ["a", "b"], WORD)
    assert seen.value == 3


def test_publishers_at_the_same_time_do_not_meet(spark, words, topics):
    encoded = encode(words, "unique_id")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda _: topics.publish(encoded, "a", "b"), range(6)))
    for name in ("a", "b"):
        records = topics.read(name)
        assert records.count() == 18
        assert records.select("partition", "offset").distinct().count() == 18
        assert records.select("partition").distinct().count() == 6


def test_partitioned_saves_are_planned_without_a_sort(spark):
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "16"


def test_kafka_options(spark):
    with pytest.warns(UserWarning):
        topics = KafkaTopics(
            spark,
            "host:9092",
            read_options={"enable.auto.commit": "false", "isolation.level": "read_committed"},
            write_options={"enable.idempotence": "true", "transactional.id": "t-1"},
        )
    assert topics.source_options("a", "b") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "a,b",
        "kafka.isolation.level": "read_committed",
    }
    assert topics.sink_options() == {
        "kafka.bootstrap.servers": "host:9092",
        "kafka.enable.idempotence": "true",
    }
    assert KafkaTopics.connector_options({"kafka.isolation.level": "x", "startingOffsets": "latest"}) == {
        "kafka.isolation.level": "x",
        "startingOffsets": "latest",
    }


def test_shared_path_lies_in_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_path(spark, "x").startswith(f"{base}/x-")
    assert shared_path(spark, "x") != shared_path(spark, "x")


def test_shuffle_partitions_follow_the_data():
    assert settings(10 << 40)["spark.sql.shuffle.partitions"] == str((10 << 40) // (128 << 20))
    assert "spark.sql.shuffle.partitions" not in settings()
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(settings()[first]) >= 1000


def test_decode_of_topic_has_no_shuffle(words, topics):
    topics.publish(encode(words, "unique_id"), "a")
    assert "Exchange" not in plan(decode(topics.read("a"), WORD))


def test_decode_reads_only_payload_and_time(words, topics):
    topics.publish(encode(words, "unique_id"), "a")
    assert "ReadSchema: struct<value:binary,timestamp:timestamp>" in plan(decode(topics.read("a"), WORD))


def test_publish_survives_lost_tasks(spark, topics):
    """Every second task dies in its first try, after some rows."""

    def lossy(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        for batch in batches:
            yield batch
            if context.attemptNumber() == 0 and context.partitionId() % 2:
                raise RuntimeError("lost")

    rows_in = spark.range(0, 8000, 1, 8).selectExpr("cast(id as int) as unique_id", "'w' as word")
    topics.publish(encode(rows_in.mapInArrow(lossy, WORD), "unique_id"), "a", "b")
    for name in ("a", "b"):
        records = topics.read(name)
        assert rows(decode(records, WORD).drop("timestamp")) == rows(rows_in)
        assert records.select("partition", "offset").distinct().count() == 8000


def test_kafka_starts_at_a_time_and_takes_no_names(spark, words):
    kafka = KafkaTopics(spark, "h:1")
    with pytest.raises(ValueError, match="names"):
        kafka.publish(encode(words, "unique_id"), "a", name="monday")
    assert not kafka.takes_names and FileTopics.takes_names
    assert kafka.start_options(None) == {}
    since = datetime(2026, 1, 1, tzinfo=UTC)
    assert kafka.start_options(since)["startingTimestamp"] == "1767225600000"


def test_topic_files_have_small_row_groups(spark, topics):
    """So that many tasks read what one task wrote."""
    import pyarrow.parquet as pq
    from pathlib import Path

    many = spark.range(0, 600_000, 1, 1).selectExpr(
        "cast(id as int) as unique_id", "concat(sha2(string(id), 256), sha2(string(-id), 256)) as word"
    )
    topics.publish(encode(many, "unique_id"), "a")
    (file,) = Path(topics.root).rglob("part-*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 2
    assert topics.read("a").count() == 600_000
