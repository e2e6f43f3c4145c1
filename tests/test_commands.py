import pytest

from flightloom import testbed
from flightloom.__main__ import main, parser, run
from flightloom.plans import flight_max_offset
from flightloom.schemas import RESULT, WORD
from flightloom.sources import save_table, write_csv
from tests.util import rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    save_table(testbed.samples(spark, FOLDER), "c_samples", str(folder / "s"), ["sub_part1"])
    save_table(testbed.metadata(spark, FOLDER), "c_metadata", str(folder / "m"))
    save_table(testbed.words(spark, FOLDER), "c_words", str(folder / "w"))


def command(spark, root, *args):
    return run(spark, parser().parse_args(["--topic-root", root, *args]))


def test_flight_max_then_land(spark, tables, path):
    [shown] = command(
        spark, path("t"), "flight-max", "--samples", "c_samples", "--metadata", "c_metadata",
        "--topic", "results",
    )
    expected = flight_max_offset(spark.table("c_samples"), spark.table("c_metadata"))
    assert rows(shown.drop("timestamp")) == rows(expected)
    land = [
        "land", "--topic", "results", "--table", "c_landed", "--rejects", "c_rejected",
        "--staging", path("staging"), "--checkpoint", path("pos"), "--location", path("tables"),
        "--stream-option", "maxFilesPerTrigger=100",
    ]
    for extra in (["--create"], []):
        landed, rejected = command(spark, path("t"), *land, *extra)
        assert rows(landed.select(*RESULT.names)) == rows(expected)
        assert rejected.count() == 0


def test_round_trip_of_periods(spark, tables, path):
    [shown] = command(
        spark, path("t"), "round-trip", "--table", "c_samples", "--topic", "s", "--schema", "samples",
        "--period", "1998-08", "--period", "1998-09",
    )
    expected = spark.table("c_samples").where("sub_part1 in ('1998-08', '1998-09')")
    assert rows(shown.drop("timestamp")) == rows(expected.select(*shown.drop("timestamp").columns))


def test_route_one_id(spark, tables, path):
    shown = command(
        spark, path("t"), "route", "--table", "c_words", "--schema", "word", "--unique-id", "8",
        "--topic", "a", "--topic", "b",
    )
    for df in shown:
        assert [r.unique_id for r in df.select(*WORD.names).collect()] == [8]


def test_main_shows_rows(spark, tables, path, capsys):
    main(["--topic-root", path("t"), "round-trip", "--table", "c_metadata", "--topic", "m",
          "--schema", "metadata", "--lossless-time"])
    lines = capsys.readouterr().out.splitlines()
    assert len([x for x in lines if x.startswith("|")]) == 1 + 20
    assert spark.read.parquet(path("t")).count() == spark.table("c_metadata").count()


def test_a_topic_backend_is_required():
    with pytest.raises(SystemExit):
        parser().parse_args(["round-trip", "--table", "x", "--topic", "y", "--schema", "word"])


LANDING = [
    "--table", "{0}_landed", "--rejects", "{0}_rejected", "--accounts", "{0}_accounts",
    "--staging", "{1}", "--location", "{2}", "--load", "monday",
]


def landing(stem, path):
    return [x.format(stem, path("staging"), path("tables")) for x in LANDING]


def test_land_batch_under_a_name(spark, tables, path):
    flight_max = ["--samples", "c_samples", "--metadata", "c_metadata", "--topic", "results"]
    for _ in range(2):  # the publish has a name, too
        command(spark, path("t"), "--publish-name", "one", "flight-max", *flight_max)
    expected = rows(flight_max_offset(spark.table("c_samples"), spark.table("c_metadata")))
    for extra in (["--create"], []):
        landed, rejected, counts = command(
            spark, path("t"), "land-batch", "--topic", "results", *landing("b", path), *extra
        )
        assert rows(landed.select(*RESULT.names)) == expected and rejected.count() == 0
        assert {r.measure: r.n for r in counts.collect()}["kept"] == len(expected)
    [drift] = command(spark, path("t"), "drift", "--topic", "results", "--schema", "result")
    assert drift.where("not declared and field is not null").count() == 0
    [drift] = command(spark, path("t"), "drift", "--topic", "results", "--schema", "word")
    assert {r.field for r in drift.where("not declared").collect()} == {None, *RESULT.names}


def test_land_csv_under_a_name(spark, tables, path):
    write_csv(flight_max_offset(spark.table("c_samples"), spark.table("c_metadata")), path("csv"))
    for extra in (["--create"], []):
        landed, rejected, counts = command(
            spark, path("t"), "land-csv", "--path", path("csv"), *landing("v", path), *extra
        )
        assert landed.count() == 1979 and rejected.columns[:2] == ["reject_reason", "line"]


def test_drain_flight_max(spark, tables, path):
    topic = ["--table", "c_samples", "--topic", "s", "--schema", "samples"]
    for name in ("one", "one", "two"):
        command(spark, path("t"), "--publish-name", name, "round-trip", *topic)
    [shown] = command(
        spark, path("t"), "drain-flight-max", "--topic", "s", "--metadata", "c_metadata",
        "--path", path("max"), "--checkpoint", path("pos"), "--result-topic", "results",
    )
    [sent] = command(spark, path("t"), "drift", "--topic", "results", "--schema", "result")
    assert sent.where("field is null").first().n_present >= shown.count()
    assert rows(shown) == rows(flight_max_offset(spark.table("c_samples"), spark.table("c_metadata")))
    [drained] = command(
        spark, path("t"), "drain", "--topic", "s", "--schema", "samples", "--path", path("out"),
        "--checkpoint", path("pos2"), "--unique-within", "1 day",
    )
    assert drained.count() == spark.table("c_samples").distinct().count()
    [none] = command(
        spark, path("t"), "--since", "2100-01-01T00:00:00+00:00", "drift", "--topic", "s",
        "--schema", "samples",
    )
    assert none.agg({"n_present": "sum"}).first()[0] == 0


def test_save_for_lookups(spark, tables, path):
    save = ["save", "--table", "c_samples", "--to", "c_lookup", "--location", path("l")]
    [saved] = command(spark, path("t"), *save, "--lookup", "unique_id")
    assert rows(saved) == rows(spark.table("c_samples").select(*saved.columns))
    with pytest.raises(SystemExit):
        command(spark, path("t"), *save, "--lookup", "unique_id", "--partition", "sub_part1")
