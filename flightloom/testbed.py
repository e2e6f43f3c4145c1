"""Samples and metadata derived, by Spark, from the generated test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


from flightloom.schemas import METADATA, SAMPLES, WORD

def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """One sample per order line."""
    lines = _table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_extendedprice",
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
        "l_linestatus",
        "l_linenumber",
    )
    return (
        lines.selectExpr(
            "l_orderkey as unique_id",
            "l_extendedprice as offset",
            "cast(l_quantity as bigint) as value",
            "cast(l_orderkey % 8 as int) as ems_system_id",
            "l_returnflag as file_type",
            "date_format(l_shipdate, 'yyyy-MM') as sub_part1",
            "l_linestatus as parameter_id",
            "cast(l_linenumber as string) as sub_part2",
        )
        .select(*SAMPLES.names)
    )


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """One flight per order, and a second, equal row for each third order.

    The copies are what a repeated ingestion leaves; they give deduplication work.
    """
    orders = _table(spark, folder, "orders")
    orders = orders.selectExpr(
        "*", "explode(sequence(1, if(o_orderkey % 3 = 0, 2, 1))) as copy"
    )
    customer = _table(spark, folder, "customer")
    events = _table(spark, folder, "events").select("event_id", "ts")
    return (
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(events, events["event_id"] == orders["o_orderkey"], "left")
        .selectExpr(
            "o_orderkey as unique_id",
            "cast(20000101 + o_custkey as bigint) as scheduled_ingestion_timestamp",
            "cast(ts as timestamp) as ingestion_timestamp",
            "date_format(o_orderdate, 'yyyy-MM-dd') as flight_date_exact",
            "cast(o_custkey as int) as adi_flight_record_number",
            "'raw_bigint' as parameter_table",
            "'bigint' as data_type",
            "o_orderpriority as raw_metadata_string",
            "c_mktsegment as customer_code",
            "c_name as tail_number",
            "cast(o_custkey as string) as flight_number",
            "cast(null as string) as decode_generation_time",
            "cast(null as string) as airport_depart",
            "cast(null as string) as airport_arrival",
            "'v1' as export_config_version",
            "o_orderstatus as parameter_id",
            "o_orderpriority as sub_part2",
            "cast(o_orderkey % 8 as int) as ems_system_id",
            "'meta' as file_type",
            "date_format(o_orderdate, 'yyyy-MM') as sub_part1",
        )
        .select(*METADATA.names)
    )


def words(spark: SparkSession, folder: str) -> DataFrame:
    """One word per order."""
    return _table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey as int) as unique_id", "o_orderpriority as word"
    ).select(*WORD.names)
