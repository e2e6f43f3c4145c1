import math
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from flightloom.functions import encode
from flightloom.operators import cast_to, reject_non_numeric
from flightloom.plans import land_batch, land_csv, landing
from flightloom.plans.landing import (
    create_landing_tables,
    refused_rows,
    replace_part,
    stage,
    staged_rows,
)
from flightloom.schemas import LANDED, REJECTED, REJECTED_LINE, RESULT
from flightloom.sources import FileTopics, append_rows, create_table, read_csv, save_table, write_csv
from flightloom.streaming import drain_typed, land_topic
from tests.util import plan, rows

NAN = float("nan")
GOOD = [(1, 2, "a,b", 3, 4.0), (5, 6, None, 2**53 + 1, 0.5)]


def result(spark, data):
    return spark.createDataFrame(data, RESULT)


def payloads(spark, texts):
    return spark.createDataFrame([("k", t) for t in texts], "key string, value string")


def landed(data):
    return sorted(((ems, adi, top, p, v) for adi, ems, p, v, top in data), key=repr)


def test_csv_keeps_odd_text(spark, path):
    texts = ["", None, "a,b", 'q"q', "line\nbreak", "cr\rcr", "crlf\r\nx", "back\\slash", '\\"', " pad ", "é", '""', "#c"]
    df = result(spark, [(i, None, t, i, float(i)) for i, t in enumerate(texts)])
    write_csv(df, path("csv"))
    assert rows(read_csv(spark, path("csv"), RESULT)) == rows(df)


def test_csv_of_one_column_is_refused(spark, path):
    df = spark.createDataFrame([("a",), (None,)], "word string")
    with pytest.raises(ValueError):
        write_csv(df, path("csv"))


def test_csv_keeps_numbers(spark, path):
    df = result(spark, [(1, 1, "a", 2**53 + 1, x) for x in (NAN, float("inf"), 1e-320, 1.5e7, None)])
    write_csv(df, path("csv"), rows_per_file=2)
    assert rows(read_csv(spark, path("csv"), RESULT)) == rows(df)


def test_csv_with_other_header_fails(spark, path):
    write_csv(result(spark, GOOD).select(*LANDED.names), path("csv"))
    with pytest.raises(Exception, match="header"):
        read_csv(spark, path("csv"), RESULT).collect()


def test_create_fails_if_the_table_exists(spark, path):
    create_table(spark, "twice", LANDED, path("twice"))
    with pytest.raises(AnalysisException):
        create_table(spark, "twice", LANDED, path("twice"))


def test_append_matches_by_name(spark, path):
    create_table(spark, "by_name", LANDED, path("by_name"))
    append_rows(result(spark, GOOD), "by_name")
    append_rows(result(spark, GOOD), "by_name")
    assert rows(spark.table("by_name")) == landed(GOOD * 2)
    assert spark.table("by_name").schema == LANDED


def test_save_table_fails_if_it_exists(spark, path):
    save_table(result(spark, GOOD), "saved", path("saved"))
    assert rows(spark.table("saved")) == rows(result(spark, GOOD))
    with pytest.raises(AnalysisException):
        save_table(result(spark, GOOD), "saved", path("saved"))


def test_partitioned_save_splits_a_hot_period_and_merges_the_rest(spark, path):
    n = 400_000
    df = spark.range(0, n, 1, 32).selectExpr(
        "if(id % 3 = 0, '2018-08', concat('2019-', lpad(id % 12 + 1, 2, '0'))) as sub_part1",
        "xxhash64(id) as value",
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256KB")
    try:
        save_table(df, "hot_period", path("hot_period"), ["sub_part1"])
    finally:
        spark.conf.set(key, before)
    saved = spark.table("hot_period")
    files = saved.inputFiles()
    assert sum("2018-08" in f for f in files) > 1
    assert len(files) < 100
    assert saved.count() == n
    assert saved.select("value").exceptAll(df.select("value")).count() == 0


def test_reject_splits_all_rows(spark):
    data = [*GOOD, (1, 1, "p", None, 1.0), (1, 1, "p", 1, NAN), (1, 1, "p", 1, None)]
    kept, refused = reject_non_numeric(result(spark, data))
    assert rows(kept) == rows(result(spark, GOOD))
    assert refused.count() == 3


def test_cast_gives_null_where_it_fails(spark):
    df = spark.createDataFrame(
        [("1", "2", "x", "p", "9007199254740993")],
        "ems_system_id string, adi_flight_record_number string, MaxOffset string,"
        " parameter_id string, value string",
    )
    assert tuple(cast_to(df, LANDED).first()) == (1, 2, None, "p", 2**53 + 1)


DIRTY = {
    "": "unreadable,no_ems_system_id,no_flight_record_number,no_value,no_max_offset",
    "{": "unreadable,no_ems_system_id,no_flight_record_number,no_value,no_max_offset",
    '{"ems_system_id":1,"adi_flight_record_number":2,"value":3,"MaxOffset":"NaN"}':
        "max_offset_not_a_number",
    '{"ems_system_id":1,"adi_flight_record_number":2,"value":3}': "no_max_offset",
    '{"adi_flight_record_number":2,"value":3,"MaxOffset":1.0}': "no_ems_system_id",
    '{"ems_system_id":1,"value":3,"MaxOffset":1.0}': "no_flight_record_number",
    '{"ems_system_id":1,"adi_flight_record_number":2,"value":"3","MaxOffset":1.0}':
        "unreadable,no_value",
}


def test_landing_accounts_for_every_record(spark, path):
    topics = FileTopics(spark, path("topics"))
    topics.publish(encode(result(spark, GOOD), "adi_flight_record_number"), "r")
    topics.publish(payloads(spark, [*DIRTY, None]), "r")
    create_landing_tables(spark, "ok_b", "bad_b", path("tables"))
    land_batch(topics.read("r"), "ok_b", "bad_b", path("staging"))
    assert rows(spark.table("ok_b")) == landed(GOOD)
    bad = spark.table("bad_b")
    assert bad.schema == REJECTED
    assert {r.payload: r.reject_reason for r in bad.collect()} == DIRTY
    assert bad.where("topic <> 'r' or offset is null or timestamp is null").count() == 0


small = st.none() | st.integers(0, 3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            small, small, st.none() | st.sampled_from(["p", "a,b", ""]), small,
            st.none() | st.sampled_from([1.5, NAN, float("inf")]),
        ),
        min_size=1,
        max_size=10,
    )
)
def test_landing_matches_brute_force(spark, path, data):
    def lands(row):
        adi, ems, _, value, top = row
        return None not in (adi, ems, value, top) and not math.isnan(top)

    run = uuid.uuid4().hex
    topics = FileTopics(spark, path(f"topics_{run}"))
    topics.publish(encode(result(spark, data), "adi_flight_record_number"), "r")
    table, rejects = f"ok_{run}", f"bad_{run}"
    create_landing_tables(spark, table, rejects, path("tables"))
    land_batch(topics.read("r"), table, rejects, path(f"staging_{run}"))
    assert rows(spark.table(table)) == landed([r for r in data if lands(r)])
    assert spark.table(rejects).count() == sum(not lands(r) for r in data)


def test_csv_landing_refuses_rows_without_all_numbers(spark, path):
    bad = [(None, 1, "p", 1, 1.0), (1, None, "p", 1, 1.0), (1, 1, "p", None, 1.0), (1, 1, "p", 1, NAN)]
    write_csv(result(spark, GOOD + bad), path("csv"))
    create_landing_tables(
        spark, "ok_csv", "bad_csv", path("tables"), by_batch=True, rejected=REJECTED_LINE
    )
    land_csv(spark, path("csv"), "ok_csv", "bad_csv", path("staging"), load="one")
    assert rows(spark.table("ok_csv").select(*LANDED.names)) == landed(GOOD)
    reasons = {r.line: r.reject_reason for r in spark.table("bad_csv").collect()}
    assert reasons == {
        ",1,p,1,1.0": "no_flight_record_number",
        "1,,p,1,1.0": "no_ems_system_id",
        "1,1,p,,1.0": "no_value",
        "1,1,p,1,NaN": "max_offset_not_a_number",
    }


def test_staging_parses_once_and_skips_by_statistics(spark, path):
    topics = FileTopics(spark, path("topics"))
    topics.publish(payloads(spark, DIRTY), "r")
    stage(topics.read("r"), path("staging"))
    text = plan(refused_rows(staged_rows(spark, path("staging"))))
    assert "IsNotNull(reject_reason)" in text
    assert "MaxOffset" not in text


def test_drain_reads_each_record_once(spark, path):
    topics = FileTopics(spark, path("topics"))
    drained = lambda: drain_typed(topics.read_stream("r"), RESULT, path("out"), path("pos"))
    assert drained().count() == 0
    topics.publish(encode(result(spark, GOOD), "adi_flight_record_number"), "r")
    assert rows(drained().drop("timestamp")) == rows(result(spark, GOOD))
    assert drained().count() == 2
    topics.publish(payloads(spark, ["{}", None]), "r")
    assert drained().count() == 3


def test_drain_in_bounded_batches_and_several_topics(spark, path):
    topics = FileTopics(spark, path("topics"))
    for name in ("a", "b"):
        for _ in range(3):
            topics.publish(payloads(spark, ["{}"]), name)
    stream = topics.read_stream("a", "b", maxFilesPerTrigger="1")
    assert drain_typed(stream, RESULT, path("out"), path("pos")).count() == 6


def test_landing_drain_by_drain(spark, path):
    topics = FileTopics(spark, path("topics"))

    def land(create):
        land_topic(
            topics.read_stream("r"), "ok_s", "bad_s", path("staging"), path("pos"),
            create=create, location=path("tables"),
        )

    topics.publish(encode(result(spark, GOOD[:1]), "adi_flight_record_number"), "r")
    land(True)
    topics.publish(encode(result(spark, GOOD[1:]), "adi_flight_record_number"), "r")
    topics.publish(payloads(spark, DIRTY), "r")
    land(False)
    land(False)
    ok = spark.table("ok_s")
    assert rows(ok.select(*LANDED.names)) == landed(GOOD)
    assert ok.select("drain_batch").distinct().count() == 2
    assert spark.table("bad_s").count() == len(DIRTY)
    with pytest.raises(AnalysisException):
        land(True)


def test_repeated_batch_replaces_itself(spark, path):
    """What a drain does again after dying between the write and its commit."""
    create_landing_tables(spark, "ok_r", "bad_r", path("tables"), by_batch=True)
    df = result(spark, GOOD).select(*LANDED.names)
    replace_part(df, "ok_r", 0)
    replace_part(df.limit(1), "ok_r", 1)
    replace_part(df, "ok_r", 0)
    assert spark.table("ok_r").where("drain_batch = 0").count() == 2
    assert spark.table("ok_r").count() == 3


def test_landing_that_dies_midway_is_whole_after_a_retry(spark, path, monkeypatch):
    topics = FileTopics(spark, path("topics"))
    topics.publish(encode(result(spark, GOOD), "adi_flight_record_number"), "r")
    topics.publish(payloads(spark, DIRTY), "r")

    def run(create):
        land_topic(
            topics.read_stream("r"), "ok_d", "bad_d", path("staging"), path("pos"),
            create=create, location=path("tables"),
        )

    real = landing.replace_part

    def dies_on_rejects(df, table, batch):
        if table == "bad_d":
            raise OSError("lost")
        real(df, table, batch)

    monkeypatch.setattr(landing, "replace_part", dies_on_rejects)
    with pytest.raises(Exception, match="lost"):
        run(True)
    monkeypatch.setattr(landing, "replace_part", real)
    run(False)
    assert rows(spark.table("ok_d").select(*LANDED.names)) == landed(GOOD)
    assert spark.table("bad_d").count() == len(DIRTY)


def test_topic_maximum_equals_batch_maximum(spark, path):
    topics = FileTopics(spark, path("topics"))
    topics.publish(encode(result(spark, GOOD), "adi_flight_record_number"), "r")
    out = drain_typed(topics.read_stream("r"), RESULT, path("out"), path("pos"))
    assert out.agg(F.max("MaxOffset")).first()[0] == 4.0


def test_two_topics_land_in_the_same_tables(spark, path):
    topics = FileTopics(spark, path("topics"))
    topics.publish(encode(result(spark, GOOD), "adi_flight_record_number"), "a")
    topics.publish(encode(result(spark, GOOD[:1]), "adi_flight_record_number"), "b")
    topics.publish(payloads(spark, DIRTY), "b")

    def land(topic, position, create):
        land_topic(
            topics.read_stream(topic), "ok_2", "bad_2", path("staging"), path(position),
            create=create, location=path("tables"),
        )

    land("a", "pos_a", True)
    land("b", "pos_b", False)
    assert rows(spark.table("ok_2").select(*LANDED.names)) == landed(GOOD + GOOD[:1])
    assert spark.table("bad_2").count() == len(DIRTY)
    # A new checkpoint lands the topic once more, and takes nothing away.
    land("a", "pos_new", False)
    assert rows(spark.table("ok_2").select(*LANDED.names)) == landed(GOOD * 2 + GOOD[:1])


def test_a_load_that_dies_is_whole_and_single_after_a_retry(spark, path, monkeypatch):
    topics = FileTopics(spark, path("topics"))
    topics.publish(encode(result(spark, GOOD), "adi_flight_record_number"), "r")
    topics.publish(payloads(spark, DIRTY), "r")
    create_landing_tables(spark, "ok_l", "bad_l", path("tables"), by_batch=True)
    real = landing.replace_part

    def dies(df, table, part):
        if table == "bad_l":
            raise OSError("lost")
        real(df, table, part)

    def load():
        land_batch(topics.read("r"), "ok_l", "bad_l", path("staging"), load="monday")

    monkeypatch.setattr(landing, "replace_part", dies)
    with pytest.raises(OSError):
        load()
    monkeypatch.setattr(landing, "replace_part", real)
    load()
    assert rows(spark.table("ok_l").select(*LANDED.names)) == landed(GOOD)
    assert spark.table("bad_l").count() == len(DIRTY)
    assert staged_rows(spark, path("staging")).count() == 0


def test_drain_takes_files_of_any_age(spark, path):
    import os
    import time
    from pathlib import Path

    topics = FileTopics(spark, path("topics"))
    drained = lambda: drain_typed(topics.read_stream("r"), RESULT, path("out"), path("pos"))
    topics.publish(payloads(spark, ["{}"] * 5), "r")
    assert drained().count() == 5
    before = set(Path(path("topics")).rglob("*.parquet"))
    topics.publish(payloads(spark, ["{}"] * 6), "r")
    old = time.time() - 8 * 86400
    for file in set(Path(path("topics")).rglob("*.parquet")) - before:
        os.utime(file, (old, old))
    assert drained().count() == 11
