import pytest
from pyspark.sql import functions as F

from flightloom.operators import (
    collapse_samples,
    dedupe_keys,
    enrich_join,
    equals,
    in_periods,
    max_offset,
    rekey,
    unique_records,
)
from flightloom.plans import flight_max_offset
from flightloom.schemas import METADATA, SAMPLES, WORD
from flightloom.sources import inline_rows, save_table, scan, scan_where_in
from tests.util import plan, rows

FOLDER = "/root/testdata/sf0.01"


def samples(spark, data):
    """From (unique_id, system, parameter, value, offset)."""
    df = spark.createDataFrame(
        data,
        "unique_id long, ems_system_id int, parameter_id string, value long, offset double",
    )
    for f in SAMPLES:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*SAMPLES.names)


def metadata(spark, data):
    """From (flight, system, parameter, unique_id)."""
    df = spark.createDataFrame(
        data,
        "adi_flight_record_number int, ems_system_id int, parameter_id string, unique_id long",
    )
    for f in METADATA:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*METADATA.names)


NAN = float("nan")


@pytest.mark.parametrize("collapse", [True, False])
def test_maximum_semantics(spark, collapse):
    s = samples(
        spark,
        [
            (1, 1, "p", 5, 1.0), (1, 1, "p", 5, 3.0), (1, 1, "p", 5, None),
            (1, 1, "p", 6, None), (1, 1, "p", 7, 2.0), (1, 1, "p", 7, NAN),
            (1, 1, "p", None, 4.0), (1, 1, "p", None, 5.0),
            (None, 1, "p", 5, 99.0), (1, None, "p", 5, 99.0), (2, 1, "p", 5, 99.0),
        ],
    )
    m = metadata(
        spark,
        [(10, 1, "p", 1), (10, 1, "p", 1), (11, 1, "p", 1), (12, 1, "p", None), (13, None, "p", 1)],
    )
    expected = [
        (flight, 1, "p", value, top)
        for flight in (10, 11)
        for value, top in ((5, 3.0), (6, None), (7, "NaN"), (None, 5.0))
    ]
    assert rows(flight_max_offset(s, m, collapse=collapse)) == sorted(expected, key=repr)


def test_null_flight_number_forms_one_group(spark):
    s = samples(spark, [(1, 1, "p", 5, 1.0), (2, 1, "p", 5, 2.0)])
    m = metadata(spark, [(None, 1, "p", 1), (None, 1, "p", 2)])
    assert rows(flight_max_offset(s, m)) == [(None, 1, "p", 5, 2.0)]


def test_one_id_equals_filtered_result(spark):
    s = samples(spark, [(1, 1, "p", 5, 1.0), (2, 1, "p", 5, 2.0)])
    m = metadata(spark, [(10, 1, "p", 1), (10, 1, "p", 2)])
    assert rows(flight_max_offset(s, m, unique_id=1)) == [(10, 1, "p", 5, 1.0)]
    assert rows(flight_max_offset(s, m)) == [(10, 1, "p", 5, 2.0)]


def test_dedupe_is_idempotent_and_keeps_null_tuples_once(spark):
    m = metadata(spark, [(1, 1, "p", 1), (1, 1, "p", 1), (None, 1, "p", 1), (None, 1, "p", 1)])
    once = dedupe_keys(m)
    assert rows(once) == rows(dedupe_keys(once))
    assert once.count() == 2


def test_join_puts_keys_first_and_dedupe_bounds_it(spark):
    s = samples(spark, [(1, 1, "p", 5, 1.0)])
    m = metadata(spark, [(1, 1, "p", 1), (1, 1, "p", 1)])
    joined = enrich_join(s, dedupe_keys(m))
    assert joined.columns[:3] == ["unique_id", "ems_system_id", "parameter_id"]
    assert joined.count() == 1
    assert enrich_join(s, m.select("unique_id", "ems_system_id", "parameter_id")).count() == 2


def test_rekey_forms_agree_and_drop_null_keys(spark):
    m = metadata(spark, [(1, 1, "p", 1), (1, 1, "p", 1), (None, 1, "p", 1), (2, 1, None, 3)])
    assert rows(rekey(m)) == rows(rekey(m, dedupe_keys(m))) == [(1, 1, 1, "p")] * 2
    assert "Exchange" not in plan(rekey(m)) and "Join" not in plan(rekey(m))


def hot(spark, n=30_000):
    """A third of all samples in one id, values repeating, several flights per id."""
    s = spark.range(n).selectExpr(
        "if(id % 3 = 0, 0, id % 500 + 1) as unique_id", "1 as ems_system_id",
        "'p' as parameter_id", "id % 97 as value", "cast(hash(id) as double) as offset",
    )
    m = spark.range(501 * 3).selectExpr(
        "cast(id % 7 as int) as adi_flight_record_number", "1 as ems_system_id",
        "'p' as parameter_id", "id % 501 as unique_id",
    )
    return s, m


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_hot_id_gives_the_brute_force_result(spark, threshold):
    s, m = hot(spark)
    flights = {}
    for flight, _, _, uid in m.collect():
        flights.setdefault(uid, set()).add(flight)
    expected = {}
    for uid, _, _, value, offset in s.collect():
        for flight in flights[uid]:
            key = (flight, 1, "p", value)
            expected[key] = max(expected.get(key, offset), offset)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for collapse in (True, False):
            got = flight_max_offset(s, m, collapse=collapse)
            assert rows(got) == sorted(((*k, v) for k, v in expected.items()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("collapse", [True, False])
def test_partitions_of_a_hot_id_are_split(spark, collapse):
    """Values that never repeat: merging cannot shrink the hot id, so AQE must split it."""
    n = 300_000
    s = spark.range(n).selectExpr(
        "if(id % 3 = 0, 0, id) as unique_id", "1 as ems_system_id",
        "'p' as parameter_id", "id as value", "cast(id as double) as offset",
    )
    m = spark.range(n).selectExpr(
        "cast(id as int) as adi_flight_record_number", "1 as ems_system_id",
        "'p' as parameter_id", "id as unique_id",
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        result = flight_max_offset(s.repartition(16), m, collapse=collapse)
        got = result.collect()
        assert "SortMergeJoin(skew=true)" in plan(result)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == n
    assert all(r.MaxOffset == r.value for r in got)


def test_collapse_spreads_one_id_by_value(spark):
    s, _ = hot(spark)
    text = plan(collapse_samples(s))
    assert "partial_max" in text
    exchange = next(line for line in text.splitlines() if "hashpartitioning" in line)
    assert "value" in exchange


def test_filters_and_columns_reach_the_scan(spark):
    lineitem = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(equals(lineitem, "l_orderkey", 8).select("l_quantity"))
    assert "EqualTo(l_orderkey,8)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_library_plans_use_no_python(spark):
    s, m = hot(spark)
    text = plan(max_offset(enrich_join(s, dedupe_keys(m))))
    assert "Python" not in text and "CartesianProduct" not in text


def test_period_filter_prunes_directories(spark, path):
    s = samples(spark, [(1, 1, "p", 5, 1.0)]).withColumn("sub_part1", F.lit("2020-01"))
    other = s.withColumn("sub_part1", F.lit("2020-02"))
    save_table(s.union(other), "by_period", path("by_period"), ["sub_part1"])
    found = scan_where_in(spark, "by_period", ["2020-01", "2021-01"])
    assert "PartitionFilters: [sub_part1" in plan(found)
    assert found.count() == 1
    assert in_periods(scan(spark, "by_period"), ["2020-02"]).count() == 1
    # Quotes in a value are data, not SQL.
    assert scan_where_in(spark, "by_period", ["x') or ('1'='1"]).count() == 0
    assert scan_where_in(spark, "by_period", ["2020-01"], limit=3).count() == 1


def test_inline_rows_are_typed_and_filtered(spark):
    df = inline_rows(spark, [(8, "kite"), (93, "otter"), (-5, "maple")], "unique_id int, word string")
    assert df.count() == 3
    assert rows(equals(df, "unique_id", 8)) == [(8, "kite")]


def test_unique_records_drops_only_reread_ones(spark):
    df = spark.createDataFrame(
        [("t", 0, 1, "a"), ("t", 0, 1, "a"), ("t", 1, 1, "a")],
        "topic string, partition int, offset long, value string",
    )
    assert unique_records(df).count() == 2


def test_inline_rows_are_sent_to_the_large_table(spark):
    """Their size is known, so the large side is neither shuffled nor sorted."""
    words = inline_rows(spark, [(8, "kite"), (9, "otter")], WORD)
    large = spark.range(10**9).selectExpr("cast(id as int) as unique_id", "id as value")
    text = plan(large.join(words, "unique_id"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert rows(words) == [(8, "kite"), (9, "otter")]
    assert inline_rows(spark, [], WORD).count() == 0
