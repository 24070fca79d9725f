import datetime as dt
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tickloom.operators import layout

START = dt.datetime(2024, 3, 1)
SYMBOLS, HOURS, FILES = 40, 240, 64


def test_interleave(spark):
    rng = [(0, 0), (1, 0), (0, 1), (3, 5), (65535, 0), (0, 65535), (65535, 65535), (12345, 54321)]
    got = spark.createDataFrame(rng, "x long, y long").select("x", "y", layout.interleave(F.col("x"), F.col("y")).alias("z"))
    for row in got.collect():
        assert row.z == sum(((row.x >> b & 1) << 2 * b) | ((row.y >> b & 1) << 2 * b + 1) for b in range(16))


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the trades in one symbol, the others spread over 39; one trade has a wrong time long ago."""
    n = 192_000
    number = F.pmod(F.xxhash64("id"), F.lit(3 * (SYMBOLS - 1)))
    symbol = F.when(number < SYMBOLS - 1, F.lit(17)).otherwise(number % SYMBOLS)
    second = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(HOURS * 3600))
    time = F.timestamp_seconds(F.when(F.col("id") == 0, F.lit(0)).otherwise(int((START - dt.datetime(1970, 1, 1)).total_seconds()) + second))
    return spark.range(n).select(F.format_string("S%02d", symbol).alias("symbol"), time.alias("event_time"), F.col("id").alias("n"))


@pytest.fixture(scope="module")
def laid(rows, tmp_path_factory):
    root = tmp_path_factory.mktemp("curve")
    paths = str(root / "table"), str(root / "files")
    layout.write_along_curve(rows, *paths, rows_per_file=3000)
    return paths


def files_of(frame):
    return {unquote(name) for name in frame.inputFiles()}


def test_files_cover_the_table(spark, rows, laid):
    facts = spark.read.parquet(laid[1]).collect()
    assert len(facts) == FILES
    assert sum(f.rows for f in facts) == rows.count()
    assert max(f.rows for f in facts) < 3 * 3000  # the hot symbol makes no large file


@pytest.mark.parametrize("symbol", ["S17", "S03"])
def test_either_predicate_and_both_leave_files_out(spark, rows, laid, symbol):
    hour = START + dt.timedelta(hours=100), START + dt.timedelta(hours=101)
    by_both = layout.look_up(spark, *laid, symbol, *hour)
    by_symbol = layout.look_up(spark, *laid, symbol)
    by_time = layout.look_up(spark, *laid, None, *hour)
    in_hour = (F.col("event_time") >= hour[0]) & (F.col("event_time") < hour[1])
    for found, wanted in ((by_both, in_hour & (F.col("symbol") == symbol)), (by_symbol, F.col("symbol") == symbol),
                          (by_time, in_hour)):
        expected = sorted(r.n for r in rows.where(wanted).collect())
        assert sorted(r.n for r in found.collect()) == expected and expected
    assert len(files_of(by_both)) <= 4
    assert len(files_of(by_time)) <= FILES // 3
    assert len(files_of(by_symbol)) <= (FILES // 2 if symbol == "S17" else FILES // 4)


def test_a_file_per_range_of_time_reads_them_all(spark, rows, laid, tmp_path):
    """What the curve is compared with: sorted by time, one symbol is in every file."""
    rows.repartitionByRange(FILES, "event_time").write.parquet(str(tmp_path / "t"))
    facts = layout.file_facts(spark, str(tmp_path / "t"))
    holding = facts.where("first_symbol <= 'S03' AND last_symbol >= 'S03'").count()
    assert holding == FILES > 3 * len(files_of(layout.look_up(spark, *laid, "S03")))


def test_no_rows_nulls_and_clashing_names(spark, tmp_path):
    paths = str(tmp_path / "t"), str(tmp_path / "f")
    schema = "symbol string, event_time timestamp, rows int, hour string, `a.b` int"
    layout.write_along_curve(spark.createDataFrame([], schema), *paths)
    assert layout.look_up(spark, *paths, "A").count() == 0
    data = [("A", START, 1, "x", 1), (None, START, 2, None, 2), ("A", None, 3, "y", 3), (None, None, 4, "z", 4),
            ("B", START, 5, "x", 5), ("A", START, 1, "x", 1)]
    layout.write_along_curve(spark.createDataFrame(data, schema), *paths, rows_per_file=1)
    assert sorted(r.rows for r in layout.look_up(spark, *paths).collect()) == [1, 1, 2, 3, 4, 5]
    assert sorted(r.rows for r in layout.look_up(spark, *paths, "A").collect()) == [1, 1, 3]
    assert sorted(r.rows for r in layout.look_up(spark, *paths, "A", START).collect()) == [1, 1]
    assert layout.look_up(spark, *paths, "C").count() == 0
    assert layout.look_up(spark, *paths, None, None, START).columns == ["symbol", "event_time", "rows", "hour", "a.b"]
