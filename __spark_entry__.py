
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom import testbed
from flightloom.functions import decode, encode, payload_drift
from flightloom.operators import (
    cast_to,
    collapse_samples,
    dedupe_keys,
    drop_tombstones,
    enrich_join,
    equals,
    in_periods,
    max_offset,
    preview,
    reject_non_numeric,
    rekey,
    select_columns,
    unique_records,
)
from flightloom.operators.quality import REASONS
from flightloom.plans import (
    bucketed_flight_max,
    filter_and_route,
    flight_max_offset,
    land_batch,
    land_csv,
    publish_flight_max,
    round_trip,
    save_flight_buckets,
)
from flightloom.plans.landing import create_landing_tables
from flightloom.schemas import LANDED, METADATA, REJECTED_LINE, RESULT, SAMPLES, WORD
from flightloom.session import shared_path
from flightloom.sources import (
    FileTopics,
    MaximumTable,
    inline_rows,
    read_csv,
    save_lookup_table,
    save_table,
    scan,
    scan_periods_of,
    scan_where_in,
    write_csv,
)
from flightloom.streaming import (
    drain_flight_max,
    drain_typed,
    drain_unique,
    land_topic,
    latest_maxima,
)

# The training-data operators are an own part, which may be absent as a whole.
try:
    import corpus_pipeline
    from flightloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "flightloom.llm"):
        raise
    corpus_pipeline = llm_queries = None

PERIODS = ["1998-08"]
INLINE = [(8, "kite"), (93, "otter"), (-5, "maple")]


def entry(spark: SparkSession) -> DataFrame:
    """Largest offset per flight, system, parameter and value, over all ids."""
    return _flight_max_offset(spark, "/root/testdata/sf0.001")


# --- inputs ---------------------------------------------------------------------


def _samples(spark: SparkSession, folder: str) -> DataFrame:
    """The samples through the catalog, as a job gets them."""
    testbed.samples(spark, folder).createOrReplaceTempView("flight_samples")
    return scan(spark, "flight_samples")


def _metadata(spark: SparkSession, folder: str) -> DataFrame:
    testbed.metadata(spark, folder).createOrReplaceTempView("flight_metadata")
    return scan(spark, "flight_metadata")


def _as_records(encoded: DataFrame) -> DataFrame:
    """What a topic makes of key and value, without a topic."""
    return encoded.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )


def _topics(spark: SparkSession) -> FileTopics:
    return FileTopics(spark, shared_path(spark, "topics"))


def _name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex}"


def _dirty_result(spark: SparkSession, folder: str) -> DataFrame:
    """The result with NaN and NULL put in some cells."""
    return _flight_max_offset(spark, folder).withColumns(
        {
            "MaxOffset": F.expr(
                "case when value % 11 = 0 then double('NaN')"
                " when value % 13 = 0 then null else MaxOffset end"
            ),
            "value": F.expr("case when value % 7 = 0 then null else value end"),
        }
    )


# --- scans and filters ------------------------------------------------------------


def _scan_filtered(spark: SparkSession, folder: str) -> DataFrame:
    testbed.samples(spark, folder).createOrReplaceTempView("flight_samples")
    return scan(spark, "flight_samples", unique_id=8)


def _filter_eq(spark: SparkSession, folder: str) -> DataFrame:
    return equals(_samples(spark, folder), "file_type", "R")


def _scan_partition_in(spark: SparkSession, folder: str) -> DataFrame:
    testbed.samples(spark, folder).createOrReplaceTempView("flight_samples")
    return scan_where_in(spark, "flight_samples", PERIODS)


def _counted_in(shown: DataFrame, source: DataFrame) -> DataFrame:
    """How many rows are shown, and how many of these are rows of the source.

    Which rows a limit shows has no order; these two numbers have one answer.
    """
    there = source.distinct().withColumn("there", F.lit(1))
    same = [shown[c].eqNullSafe(there[c]) for c in shown.columns]
    return shown.join(there, same, "left").agg(
        F.count("*").alias("n_shown"), F.count("there").alias("n_of_source")
    )


def _scan_partition_in_limit(spark: SparkSession, folder: str) -> DataFrame:
    testbed.samples(spark, folder).createOrReplaceTempView("flight_samples")
    shown = scan_where_in(spark, "flight_samples", PERIODS, limit=3)
    return _counted_in(shown, scan_where_in(spark, "flight_samples", PERIODS))


def _scan_partitioned_table(spark: SparkSession, folder: str) -> DataFrame:
    """The period filter on a table partitioned by period: one directory is read."""
    table = _name("samples_by_period")
    save_table(
        _samples(spark, folder), table, shared_path(spark, table), partition_columns=["sub_part1"]
    )
    return in_periods(scan(spark, table), PERIODS).select(*SAMPLES.names)


def _scan_periods_of(spark: SparkSession, folder: str) -> DataFrame:
    """The periods come from a table, of which a filter leaves some."""
    table, periods = _name("samples_by_period"), _name("periods")
    samples = _samples(spark, folder)
    save_table(samples, table, shared_path(spark, table), partition_columns=["sub_part1"])
    save_table(
        samples.select("sub_part1", F.substring("sub_part1", 1, 4).alias("year")).distinct(),
        periods, shared_path(spark, periods),
    )
    wanted = equals(scan(spark, periods), "year", "1998")
    return scan_periods_of(spark, table, wanted).select(*SAMPLES.names)


def _scan_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of one id from a table saved for lookups."""
    table = _name("samples_by_id")
    save_lookup_table(_samples(spark, folder), table, "unique_id", shared_path(spark, table))
    return scan(spark, table, unique_id=8)


def _inline_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Inline rows give the samples of their ids a word."""
    words = inline_rows(spark, INLINE, WORD)
    joined = _samples(spark, folder).join(words, ["unique_id"], "inner")
    return select_columns(joined, ["unique_id", "word", "offset", "value"])


def _preview(spark: SparkSession, folder: str) -> DataFrame:
    samples = _samples(spark, folder)
    return _counted_in(preview(samples), samples)


# --- envelope ---------------------------------------------------------------------


def _encode_samples(spark: SparkSession, folder: str) -> DataFrame:
    return encode(_samples(spark, folder), "unique_id")


def _encode_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return encode(_metadata(spark, folder), "unique_id")


def _decode_samples(spark: SparkSession, folder: str) -> DataFrame:
    records = _as_records(_encode_samples(spark, folder))
    return decode(records, SAMPLES).drop("timestamp")


def _decode_metadata(spark: SparkSession, folder: str) -> DataFrame:
    records = _as_records(_encode_metadata(spark, folder))
    return decode(records, METADATA).drop("timestamp")


def _decode_result(spark: SparkSession, folder: str) -> DataFrame:
    result = _flight_max_offset(spark, folder)
    return decode(_as_records(encode(result, "adi_flight_record_number")), RESULT).drop("timestamp")


def _skip_tombstones(spark: SparkSession, folder: str) -> DataFrame:
    """Records of one file type are tombstones: a key without a payload."""
    dead = F.col("value").contains('"file_type":"R"')
    records = _encode_samples(spark, folder).withColumn("value", F.when(~dead, F.col("value")))
    return decode(drop_tombstones(_as_records(records)), SAMPLES).drop("timestamp")


def _decode_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of which some name fields differently, hold other types, or are no object."""
    records = _encode_samples(spark, folder)
    for divisor, rest, old, new in (
        (5, 0, '"value":', '"extra":'),
        (7, 1, '"file_type":', '"File_type":'),
        (11, 2, '"offset":', '"offset":"far","was":'),
        (13, 3, '"sub_part2":', '"sub_part2":null,"old":'),
    ):
        changed = F.replace("value", F.lit(old), F.lit(new))
        hit = F.col("key").cast("bigint") % divisor == rest
        records = records.withColumn("value", F.when(hit, changed).otherwise(F.col("value")))
    key = F.col("key").cast("bigint")
    text = F.when(key % 19 == 5, None).when(key % 17 == 4, "[1]").otherwise(F.col("value"))
    return payload_drift(_as_records(records.withColumn("value", text)), SAMPLES)


# --- relational -------------------------------------------------------------------


def _dedupe_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe_keys(_metadata(spark, folder))


def _enrich_join(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_join(_samples(spark, folder), dedupe_keys(_metadata(spark, folder)))


def _metadata_rekey(spark: SparkSession, folder: str) -> DataFrame:
    return rekey(_metadata(spark, folder))


def _metadata_rekey_join(spark: SparkSession, folder: str) -> DataFrame:
    return rekey(_metadata(spark, folder), dedupe_keys(_metadata(spark, folder)))


def _collapse_samples(spark: SparkSession, folder: str) -> DataFrame:
    return collapse_samples(_samples(spark, folder))


def _max_offset(spark: SparkSession, folder: str) -> DataFrame:
    return max_offset(_enrich_join(spark, folder))


# --- jobs -------------------------------------------------------------------------


def _flight_max_offset(spark: SparkSession, folder: str) -> DataFrame:
    return flight_max_offset(_samples(spark, folder), _metadata(spark, folder))


def _flight_max_offset_one_id(spark: SparkSession, folder: str) -> DataFrame:
    return flight_max_offset(_samples(spark, folder), _metadata(spark, folder), unique_id=9)


def _flight_max_offset_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return publish_flight_max(
        _samples(spark, folder), _metadata(spark, folder), _topics(spark), "results"
    ).drop("timestamp")


def _topic_roundtrip_samples(spark: SparkSession, folder: str) -> DataFrame:
    rows = _samples(spark, folder)
    return round_trip(rows, _topics(spark), "samples", SAMPLES).drop("timestamp")


def _topic_roundtrip_metadata(spark: SparkSession, folder: str) -> DataFrame:
    rows = _metadata(spark, folder)
    return round_trip(rows, _topics(spark), "metadata", METADATA).drop("timestamp")


def _topic_roundtrip_metadata_micros(spark: SparkSession, folder: str) -> DataFrame:
    rows = _metadata(spark, folder)
    return round_trip(rows, _topics(spark), "metadata", METADATA, lossless_time=True).drop(
        "timestamp"
    )


def _topic_record_times(spark: SparkSession, folder: str) -> DataFrame:
    """Every decoded record keeps the time at which the topic got it."""
    before = F.lit(datetime.now(UTC))
    rows = _samples(spark, folder)
    read = round_trip(rows, _topics(spark), "samples", SAMPLES)
    late = (F.col("timestamp") >= before) & (F.col("timestamp") <= F.current_timestamp())
    return read.agg(
        F.count("*").alias("n_records"), F.count(F.when(late, 1)).alias("n_with_time")
    )


def _unique_records(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping reads of a topic, each record once."""
    topics = _topics(spark)
    topics.publish(_encode_samples(spark, folder), "samples")
    records = topics.read("samples").union(topics.read("samples"))
    return decode(unique_records(records), SAMPLES).drop("timestamp")


def _repeated_publish(spark: SparkSession, folder: str) -> DataFrame:
    """A publish that is run again under its name is read once."""
    topics = _topics(spark)
    for _ in range(2):
        topics.publish(_encode_samples(spark, folder), "samples", name="first")
    return decode(topics.read("samples"), SAMPLES).drop("timestamp")


def _records_since(spark: SparkSession, folder: str) -> DataFrame:
    """A topic from a time on: what was published before is not read."""
    topics, samples = _topics(spark), _samples(spark, folder)
    topics.publish(encode(samples.where("unique_id % 2 = 0"), "unique_id"), "samples")
    since = datetime.now(UTC)
    topics.publish(encode(samples.where("unique_id % 2 = 1"), "unique_id"), "samples")
    return decode(topics.read("samples", since=since), SAMPLES).drop("timestamp")


def _filter_route(spark: SparkSession, folder: str) -> DataFrame:
    routed = filter_and_route(
        testbed.words(spark, folder),
        F.col("word") == "1-URGENT",
        _topics(spark),
        ["first", "second"],
        WORD,
    )
    first, second = (
        rows.select(F.lit(topic).alias("topic"), *WORD.names) for topic, rows in routed.items()
    )
    return first.unionByName(second)


def _stream_drain(spark: SparkSession, folder: str) -> DataFrame:
    """Drains a topic twice; the second drain finds nothing new."""
    topics = _topics(spark)
    topics.publish(_encode_samples(spark, folder), "samples")
    out, checkpoint = shared_path(spark, "drained"), shared_path(spark, "position")
    drain_typed(topics.read_stream("samples"), SAMPLES, out, checkpoint)
    drained = drain_typed(topics.read_stream("samples"), SAMPLES, out, checkpoint)
    return drained.drop("timestamp")


def _stream_unique_records(spark: SparkSession, folder: str) -> DataFrame:
    """Three publishes that overlap, drained one by one: each record is there once."""
    topics, samples = _topics(spark), _samples(spark, folder)
    out, checkpoint = shared_path(spark, "drained"), shared_path(spark, "position")
    for rows in ("unique_id % 3 < 2", "unique_id % 3 > 0", "true"):
        topics.publish(encode(samples.where(rows), "unique_id"), "samples")
        drained = drain_unique(topics.read_stream("samples"), SAMPLES, out, checkpoint)
    return drained.drop("timestamp")


def _stream_flight_max(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship over a stream: a part of the samples per drain."""
    topics, samples = _topics(spark), _samples(spark, folder)
    table = MaximumTable(spark, shared_path(spark, "maxima"), buckets=16)
    checkpoint = shared_path(spark, "position")
    for part in range(2):
        rows = samples.where(F.pmod(F.xxhash64("unique_id", "sub_part2"), F.lit(2)) == part)
        topics.publish(encode(rows, "unique_id"), "samples")
        stream = topics.read_stream("samples")
        drain_flight_max(stream, _metadata(spark, folder), table, checkpoint)
    return table.read()


def _stream_flight_max_published(spark: SparkSession, folder: str) -> DataFrame:
    """The same, with each batch's maxima sent to a topic and the result read from there."""
    topics = _topics(spark)
    topics.publish(_encode_samples(spark, folder), "samples")
    table = MaximumTable(spark, shared_path(spark, "maxima"), buckets=16)
    drain_flight_max(
        topics.read_stream("samples", maxFilesPerTrigger="3"),
        _metadata(spark, folder),
        table,
        shared_path(spark, "position"),
        publish=(topics, "results"),
    )
    return latest_maxima(topics.read("results"))


def _merged_flight_max(spark: SparkSession, folder: str) -> DataFrame:
    """The result kept up to date by merges of three parts of the samples, one of them twice."""
    table = MaximumTable(spark, shared_path(spark, "maxima"), buckets=16)
    metadata = _metadata(spark, folder)
    for part in (0, 1, 1, 2):
        rows = _samples(spark, folder).where(F.pmod("unique_id", F.lit(3)) == part)
        table.merge(flight_max_offset(rows, metadata))
    return table.read()


def _flight_max_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship on bucketed tables; ids with over five samples count as hot here."""
    table = _name("bucketed")
    save_flight_buckets(
        _samples(spark, folder), _metadata(spark, folder), table, 8, shared_path(spark, table),
        hot_rows=5,
    )
    return bucketed_flight_max(spark, table)


def _land_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """What became of the records of two drains, with tombstones and broken payloads."""
    topics = _topics(spark)
    records = encode(_dirty_result(spark, folder), "adi_flight_record_number")
    key = F.col("key").cast("bigint")
    payload = F.when(key % 5 == 0, None).when(key % 7 == 3, "{").otherwise(F.col("value"))
    records = records.withColumn("value", payload)
    table, rejects, accounts = _name("landed"), _name("rejected"), _name("accounts")
    staging, checkpoint = shared_path(spark, "staging"), shared_path(spark, "position")
    for part in range(2):
        topics.publish(records.where(key % 2 == part), "results")
        land_topic(
            topics.read_stream("results"), table, rejects, staging, checkpoint,
            create=part == 0, location=shared_path(spark, "warehouse"), accounts=accounts,
        )
    return spark.table(accounts).groupBy("measure").agg(F.sum("n").alias("n"))


def _landed_tables(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Publishes the dirty result, drains it into two tables, returns their names."""
    topics = _topics(spark)
    topics.publish(encode(_dirty_result(spark, folder), "adi_flight_record_number"), "results")
    table, rejects = _name("landed"), _name("rejected")
    land_topic(
        topics.read_stream("results"),
        table,
        rejects,
        staging=shared_path(spark, "staging"),
        checkpoint=shared_path(spark, "position"),
        location=shared_path(spark, "warehouse"),
    )
    return table, rejects


def _land_result_table(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = _landed_tables(spark, folder)
    return spark.table(table).select(*LANDED.names)


def _rejects(spark: SparkSession, rejects: str) -> DataFrame:
    payload = F.from_json("payload", RESULT)
    return spark.table(rejects).select(
        "reject_reason",
        *[
            payload.getField(c).alias(c)
            for c in ("adi_flight_record_number", "ems_system_id", "parameter_id")
        ],
    )


def _land_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, rejects = _landed_tables(spark, folder)
    return _rejects(spark, rejects)


def _land_batch_table(spark: SparkSession, folder: str) -> DataFrame:
    """The landing without a stream: the whole topic, two bulk inserts."""
    topics = _topics(spark)
    topics.publish(encode(_dirty_result(spark, folder), "adi_flight_record_number"), "results")
    table, rejects = _name("landed"), _name("rejected")
    create_landing_tables(spark, table, rejects, shared_path(spark, "warehouse"), by_batch=True)
    staging = shared_path(spark, "staging")
    for _ in range(2):  # a load that is run again leaves no row twice
        land_batch(topics.read("results"), table, rejects, staging, load="first")
    return spark.table(table).select(*LANDED.names)


def _reject_non_numeric(spark: SparkSession, folder: str) -> DataFrame:
    encoded = encode(_dirty_result(spark, folder), "adi_flight_record_number")
    kept, _ = reject_non_numeric(decode(_as_records(encoded), RESULT).drop("timestamp"))
    return kept


def _cast_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Text columns cast and reordered for landing."""
    result = _flight_max_offset(spark, folder)
    return cast_to(result.select(*[F.col(c).cast("string") for c in result.columns]), LANDED)


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "csv")
    write_csv(_flight_max_offset(spark, folder), path)
    return read_csv(spark, path, RESULT)


def _csv_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of many lines, by way of files that are read in pieces."""
    path = shared_path(spark, "csv")
    orders = spark.read.parquet(f"{folder}/orders.parquet").selectExpr(
        "o_orderkey as unique_id",
        "concat_ws('\\n', o_orderpriority, '\\\\n', o_orderstatus, '\\r\\n', ',\"') as word",
    )
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


def _landed_csv(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The landing by way of a CSV spool, run twice under its name; the names of both tables."""
    spool, table, rejects = shared_path(spark, "csv"), _name("landed"), _name("rejected")
    write_csv(_dirty_result(spark, folder), spool)
    create_landing_tables(
        spark, table, rejects, shared_path(spark, "warehouse"), by_batch=True,
        rejected=REJECTED_LINE,
    )
    for _ in range(2):
        land_csv(spark, spool, table, rejects, shared_path(spark, "staging"), load="spool")
    return table, rejects


def _land_csv_table(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, _landed_csv(spark, folder)[0]).select(*LANDED.names)


def _land_csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Refused lines as they stand in the spool, with all their reasons."""
    return scan(spark, _landed_csv(spark, folder)[1]).select(*REJECTED_LINE.names)


def _flight_max_offset_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship with repeated sample values merged ahead of the join."""
    return flight_max_offset(_samples(spark, folder), _metadata(spark, folder), collapse=True)


def _save_as_table(spark: SparkSession, folder: str) -> DataFrame:
    table = _name("flight_max")
    save_table(_flight_max_offset(spark, folder), table, shared_path(spark, table))
    return scan(spark, table)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator and job; each takes the session and the table folder."""
    return {
        "scan_samples": _samples,
        "scan_metadata": _metadata,
        "scan_filtered": _scan_filtered,
        "filter_eq": _filter_eq,
        "scan_partition_in": _scan_partition_in,
        "scan_partition_in_limit": _scan_partition_in_limit,
        "scan_partitioned_table": _scan_partitioned_table,
        "scan_periods_of": _scan_periods_of,
        "scan_lookup": _scan_lookup,
        "inline_rows": _inline_rows,
        "preview": _preview,
        "encode_samples": _encode_samples,
        "encode_metadata": _encode_metadata,
        "decode_samples": _decode_samples,
        "decode_metadata": _decode_metadata,
        "decode_result": _decode_result,
        "skip_tombstones": _skip_tombstones,
        "decode_drift": _decode_drift,
        "dedupe_metadata": _dedupe_metadata,
        "enrich_join": _enrich_join,
        "metadata_rekey": _metadata_rekey,
        "metadata_rekey_join": _metadata_rekey_join,
        "collapse_samples": _collapse_samples,
        "max_offset": _max_offset,
        "flight_max_offset": _flight_max_offset,
        "flight_max_offset_collapsed": _flight_max_offset_collapsed,
        "flight_max_offset_one_id": _flight_max_offset_one_id,
        "flight_max_bucketed": _flight_max_bucketed,
        "merged_flight_max": _merged_flight_max,
        "stream_flight_max": _stream_flight_max,
        "stream_flight_max_published": _stream_flight_max_published,
        "flight_max_offset_roundtrip": _flight_max_offset_roundtrip,
        "topic_roundtrip_samples": _topic_roundtrip_samples,
        "topic_roundtrip_metadata": _topic_roundtrip_metadata,
        "topic_roundtrip_metadata_micros": _topic_roundtrip_metadata_micros,
        "topic_record_times": _topic_record_times,
        "unique_records": _unique_records,
        "repeated_publish": _repeated_publish,
        "records_since": _records_since,
        "stream_unique_records": _stream_unique_records,
        "filter_route": _filter_route,
        "stream_drain": _stream_drain,
        "reject_non_numeric": _reject_non_numeric,
        "cast_landed": _cast_landed,
        "land_result_table": _land_result_table,
        "land_rejects": _land_rejects,
        "land_accounts": _land_accounts,
        "land_batch_table": _land_batch_table,
        "land_csv_table": _land_csv_table,
        "land_csv_rejects": _land_csv_rejects,
        "csv_roundtrip": _csv_roundtrip,
        "csv_line_breaks": _csv_line_breaks,
        "save_as_table": _save_as_table,
        **(llm_queries.queries() if llm_queries else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


# --- oracles ----------------------------------------------------------------------

_CTE = """
with samples as (
  select l_orderkey as unique_id, l_extendedprice as "offset",
         cast(l_quantity as bigint) as value,
         cast(l_orderkey % 8 as int) as ems_system_id,
         l_returnflag as file_type, strftime(l_shipdate, '%Y-%m') as sub_part1,
         l_linestatus as parameter_id, cast(l_linenumber as varchar) as sub_part2
  from lineitem
), flights as (
  select o_orderkey as unique_id,
         cast(20000101 + o_custkey as bigint) as scheduled_ingestion_timestamp,
         ts as ingestion_timestamp,
         strftime(o_orderdate, '%Y-%m-%d') as flight_date_exact,
         cast(o_custkey as int) as adi_flight_record_number,
         'raw_bigint' as parameter_table, 'bigint' as data_type,
         o_orderpriority as raw_metadata_string, c_mktsegment as customer_code,
         c_name as tail_number, cast(o_custkey as varchar) as flight_number,
         cast(null as varchar) as decode_generation_time,
         cast(null as varchar) as airport_depart, cast(null as varchar) as airport_arrival,
         'v1' as export_config_version, o_orderstatus as parameter_id,
         o_orderpriority as sub_part2, cast(o_orderkey % 8 as int) as ems_system_id,
         'meta' as file_type, strftime(o_orderdate, '%Y-%m') as sub_part1
  from orders join customer on o_custkey = c_custkey
  left join (select event_id, ts from events) e on e.event_id = o_orderkey
), metadata as (
  select * from flights union all select * from flights where unique_id % 3 = 0
), keys as (
  select distinct adi_flight_record_number, ems_system_id, parameter_id, unique_id
  from metadata
), joined as (
  select s.unique_id, s.ems_system_id, s.parameter_id, s."offset", s.value,
         s.file_type, s.sub_part1, s.sub_part2, k.adi_flight_record_number
  from samples s join keys k on s.unique_id = k.unique_id
   and s.ems_system_id = k.ems_system_id and s.parameter_id = k.parameter_id
), result as (
  select adi_flight_record_number, ems_system_id, parameter_id, value,
         max("offset") as "MaxOffset"
  from joined group by adi_flight_record_number, ems_system_id, parameter_id, value
), dirty as (
  select adi_flight_record_number, ems_system_id, parameter_id,
         case when value % 7 = 0 then null else value end as value,
         case when value % 11 = 0 then 'NaN'::double
              when value % 13 = 0 then null else "MaxOffset" end as "MaxOffset"
  from result
)
"""

_SAMPLE_JSON = (
    "to_json({"
    + ", ".join(f"""'{c}': "{c}\"""" for c in SAMPLES.names)
    + "})"
)


def _metadata_json() -> str:
    """JSON text without the NULL fields, timestamps with three decimals."""
    fields = []
    for f in METADATA:
        text = (
            f"""strftime("{f.name}", '"%Y-%m-%dT%H:%M:%S.%gZ"')"""
            if f.name == "ingestion_timestamp"
            else f'cast(to_json("{f.name}") as varchar)'
        )
        fields.append(
            f"""case when "{f.name}" is not null then '"{f.name}":' || {text} end"""
        )
    return f"'{{' || concat_ws(',', {', '.join(fields)}) || '}}'"


def _drift_sql() -> str:
    """Counts of the drift that ``_decode_drift`` makes, field by field."""
    lacking = {"value": "unique_id % 5 = 0", "file_type": "unique_id % 7 = 1"}
    null, unreadable = {"sub_part2": "unique_id % 13 = 3"}, {"offset": "unique_id % 11 = 2"}
    extra = {"extra": "unique_id % 5 = 0", "File_type": "unique_id % 7 = 1",
             "was": "unique_id % 11 = 2", "old": "unique_id % 13 = 3"}

    def count(holds: str) -> str:
        return f"count(*) filter (unique_id % 17 <> 4 and ({holds}))"

    parts = [
        f"select '{f}' as field, true as declared,"
        f" {count('not (' + lacking.get(f, 'false') + ')')} as n_present,"
        f" {count(lacking.get(f, 'false'))} as n_lacking, {count(null.get(f, 'false'))} as n_null,"
        f" {count(unreadable.get(f, 'false'))} as n_unreadable from alive"
        for f in SAMPLES.names
    ]
    parts += [
        f"select '{f}', false, {count(holds)}, 0, 0, 0 from alive having {count(holds)} > 0"
        for f, holds in extra.items()
    ]
    parts.append(
        f"select null, false, {count('true')}, 0, 0,"
        " count(*) filter (unique_id % 17 = 4) from alive"
    )
    alive = ", alive as (select * from samples where unique_id % 19 <> 5) "
    return _CTE + alive + " union all ".join(parts)


def _accounts_sql() -> str:
    """Measures of ``_land_accounts``: a broken payload lacks every field."""
    broken = "adi_flight_record_number % 7 = 3"
    dead = "adi_flight_record_number % 5 = 0"
    holds = {
        "unreadable": broken,
        "no_ems_system_id": f"{broken} or ems_system_id is null",
        "no_flight_record_number": f"{broken} or adi_flight_record_number is null",
        "no_value": f"{broken} or value is null",
        "no_max_offset": f'{broken} or "MaxOffset" is null',
        "max_offset_not_a_number": f'not ({broken}) and coalesce(isnan("MaxOffset"), false)',
    }
    assert tuple(holds) == REASONS
    refused = " or ".join(f"({h})" for h in holds.values())
    measures = {
        "read": "true",
        "skipped": dead,
        "kept": f"not ({dead}) and not ({refused})",
        "refused": f"not ({dead}) and ({refused})",
        **{f"refused_{r}": f"not ({dead}) and ({h})" for r, h in holds.items()},
    }
    return _CTE + " union all ".join(
        f"select '{m}' as measure, count(*) filter ({h}) as n from dirty"
        for m, h in measures.items()
    )


_REASON = (
    "concat_ws(',', case when value is null then 'no_value' end,"
    " case when \"MaxOffset\" is null then 'no_max_offset' end,"
    " case when isnan(\"MaxOffset\") then 'max_offset_not_a_number' end) as reject_reason"
)
_KEPT = 'value is not null and "MaxOffset" is not null and not isnan("MaxOffset")'


def _select(what: str) -> str:
    return f"{_CTE} {what}"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query; some training-data queries have none."""
    samples = _select("select * from samples")
    result = _select("select * from result")
    cut = "date_trunc('milliseconds', ingestion_timestamp) as ingestion_timestamp"
    metadata_ms = _select(f"select * replace ({cut}) from metadata")
    period = _select("select * from samples where sub_part1 in ('1998-08')")
    landed = _select(
        'select ems_system_id, adi_flight_record_number, "MaxOffset", parameter_id, value'
        f" from dirty where {_KEPT}"
    )
    rekeyed = _select(
        "select m.unique_id, m.adi_flight_record_number, m.ems_system_id, m.parameter_id"
        " from metadata m join keys k on m.unique_id = k.unique_id"
        " and m.adi_flight_record_number = k.adi_flight_record_number"
        " and m.ems_system_id = k.ems_system_id and m.parameter_id = k.parameter_id"
    )
    words = "select cast(o_orderkey as int) as unique_id, o_orderpriority as word from orders"
    inline = ", ".join(f"({i}, '{w}')" for i, w in INLINE)
    return {
        "scan_samples": samples,
        "scan_metadata": _select("select * from metadata"),
        "scan_filtered": _select("select * from samples where unique_id = 8"),
        "filter_eq": _select("select * from samples where file_type = 'R'"),
        "scan_partition_in": period,
        "scan_partition_in_limit": _select(
            "select least(3, count(*)) as n_shown, least(3, count(*)) as n_of_source"
            " from samples where sub_part1 in ('1998-08')"
        ),
        "preview": _select(
            "select least(20, count(*)) as n_shown, least(20, count(*)) as n_of_source"
            " from samples"
        ),
        "topic_record_times": _select(
            "select count(*) as n_records, count(*) as n_with_time from samples"
        ),
        "unique_records": samples,
        "scan_partitioned_table": period,
        "inline_rows": _select(
            'select s.unique_id, w.word, s."offset", s.value from samples s'
            f" join (values {inline}) w(unique_id, word) on s.unique_id = w.unique_id"
        ),
        "encode_samples": _select(
            "select cast(unique_id as varchar) as key,"
            f" cast({_SAMPLE_JSON} as varchar) as value from samples"
        ),
        "encode_metadata": _select(
            f"select cast(unique_id as varchar) as key, {_metadata_json()} as value from metadata"
        ),
        "decode_samples": samples,
        "decode_metadata": metadata_ms,
        "decode_result": result,
        "skip_tombstones": _select("select * from samples where file_type <> 'R'"),
        "dedupe_metadata": _select("select * from keys"),
        "enrich_join": _select("select * from joined"),
        "metadata_rekey": rekeyed,
        "metadata_rekey_join": rekeyed,
        "collapse_samples": _select(
            'select unique_id, ems_system_id, parameter_id, value, max("offset") as "offset"'
            " from samples group by unique_id, ems_system_id, parameter_id, value"
        ),
        "max_offset": result,
        "flight_max_offset": result,
        "flight_max_offset_collapsed": result,
        "flight_max_offset_one_id": _select(
            'select adi_flight_record_number, ems_system_id, parameter_id, value,'
            ' max("offset") as "MaxOffset" from joined where unique_id = 9'
            " group by adi_flight_record_number, ems_system_id, parameter_id, value"
        ),
        "flight_max_offset_roundtrip": result,
        "topic_roundtrip_samples": samples,
        "topic_roundtrip_metadata": metadata_ms,
        "topic_roundtrip_metadata_micros": _select("select * from metadata"),
        "filter_route": (
            f"select topic, unique_id, word from ({words}) w,"
            " (values ('first'), ('second')) t(topic) where word = '1-URGENT'"
        ),
        "stream_drain": samples,
        "reject_non_numeric": _select(f"select * from dirty where {_KEPT}"),
        "cast_landed": _select(
            'select ems_system_id, adi_flight_record_number, "MaxOffset", parameter_id, value'
            " from result"
        ),
        "land_result_table": landed,
        "land_batch_table": landed,
        "land_csv_table": landed,
        "land_csv_rejects": _select(
            f"select {_REASON}, adi_flight_record_number || ',' || ems_system_id || ',' ||"
            " parameter_id || ',' || coalesce(cast(value as varchar), '') || ',' ||"
            " case when isnan(\"MaxOffset\") then 'NaN'"
            " else coalesce(cast(\"MaxOffset\" as varchar), '') end as line"
            f" from dirty where not coalesce({_KEPT}, false)"
        ),
        "land_rejects": _select(
            f"select {_REASON}, adi_flight_record_number, ems_system_id, parameter_id"
            f" from dirty where not coalesce({_KEPT}, false)"
        ),
        "land_accounts": _accounts_sql(),
        "decode_drift": _drift_sql(),
        "csv_line_breaks": (
            "select o_orderkey as unique_id, o_orderpriority || chr(10) || chr(92) || 'n' ||"
            " chr(10) || o_orderstatus || chr(10) || chr(13) || chr(10) || chr(10) || ',\"'"
            " as word from orders"
        ),
        "scan_periods_of": _select("select * from samples where sub_part1 like '1998-%'"),
        "scan_lookup": _select("select * from samples where unique_id = 8"),
        "repeated_publish": samples,
        "records_since": _select("select * from samples where unique_id % 2 = 1"),
        "stream_unique_records": samples,
        "flight_max_bucketed": result,
        "merged_flight_max": result,
        "stream_flight_max": result,
        "stream_flight_max_published": result,
        "csv_roundtrip": result,
        "save_as_table": result,
        **(llm_queries.oracle_sql() if llm_queries else {}),
        **(
            {"pipeline": corpus_pipeline.ORACLE_SQL}
            if corpus_pipeline and corpus_pipeline.ORACLE_SQL
            else {}
        ),
    }
