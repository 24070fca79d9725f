"""RSI, MACD, Bollinger bands and volume scores over candles.

Frames count candles, not minutes: a window without trades has no candle and is not filled in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from tickloom.functions.scalar import utc_date
from tickloom.operators.series import CHUNK_ROWS, _SERIES, index_series, over_series
from tickloom.schemas import BOLLINGER_PERIOD, BOLLINGER_WIDTH, GOLD, MACD_FAST, MACD_SIGNAL, MACD_SLOW, RSI_PERIOD


def _frame(window: WindowSpec, rows: int) -> WindowSpec:
    return window.rowsBetween(-(rows - 1), 0)


def _from_candle(n: int, value: Column) -> Column:
    """NULL until ``n`` candles with a close exist."""
    return F.when(F.col("candle_idx") >= n, value)


def add_rsi(frame: DataFrame, window: WindowSpec, period: int = RSI_PERIOD) -> DataFrame:
    """Simple-average RSI. The first candle counts as a change of 0, and no losses mean 100."""
    change = F.col("close") - F.lag("close").over(window)
    moves = frame.withColumn("change", change).withColumns(
        {
            "gain": F.when(F.col("change") > 0, F.col("change")).otherwise(0.0),
            "loss": F.when(F.col("change") < 0, -F.col("change")).otherwise(0.0),
        }
    )
    means = moves.withColumns(
        {
            "avg_gain": F.avg("gain").over(_frame(window, period)),
            "avg_loss": F.avg("loss").over(_frame(window, period)),
        }
    )
    strength = F.col("avg_gain") / F.col("avg_loss")
    value = F.when(F.col("avg_loss") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + strength))
    return means.withColumn("rsi", _from_candle(period, value))


def add_macd(
    frame: DataFrame, window: WindowSpec, fast: int = MACD_FAST, slow: int = MACD_SLOW, signal: int = MACD_SIGNAL
) -> DataFrame:
    """Moving-average approximation of MACD. The two means are not held back while a series warms up."""
    means = frame.withColumns(
        {
            f"ma{fast}": F.avg("close").over(_frame(window, fast)),
            f"ma{slow}": F.avg("close").over(_frame(window, slow)),
        }
    )
    macd = means.withColumn("macd_approx", _from_candle(slow, F.col(f"ma{fast}") - F.col(f"ma{slow}")))
    smoothed = F.avg("macd_approx").over(_frame(window, signal))
    with_signal = macd.withColumn("signal_approx", _from_candle(slow + signal, smoothed))
    return with_signal.withColumn("macd_histogram", F.col("macd_approx") - F.col("signal_approx"))


def add_bollinger(
    frame: DataFrame, window: WindowSpec, period: int = BOLLINGER_PERIOD, width: float = BOLLINGER_WIDTH
) -> DataFrame:
    """Rolling mean with bands ``width`` population standard deviations away."""
    stats = frame.withColumns(
        {
            "bb_mean": F.avg("close").over(_frame(window, period)),
            "bb_std": F.stddev_pop("close").over(_frame(window, period)),
        }
    )
    return stats.withColumns(
        {
            "bb_middle": _from_candle(period, F.col("bb_mean")),
            "bb_upper": _from_candle(period, F.col("bb_mean") + width * F.col("bb_std")),
            "bb_lower": _from_candle(period, F.col("bb_mean") - width * F.col("bb_std")),
        }
    )


def candle_index(candles: DataFrame, keys: Sequence[str] = ("symbol",), bucket: str = "day") -> DataFrame:
    return index_series(candles, keys, bucket=bucket).drop(_SERIES)


def price_change(candles: DataFrame, keys: Sequence[str] = ("symbol",), chunk_rows: int | None = CHUNK_ROWS,
                 bucket: str = "day") -> DataFrame:
    """Previous close, change, gain and loss per candle."""
    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        moved = frame.withColumn("prev_close", F.lag("close").over(window))
        change = F.col("close") - F.col("prev_close")
        return moved.withColumns(
            {
                "change": change,
                "gain": F.when(change > 0, change).otherwise(0.0),
                "loss": F.when(change < 0, -change).otherwise(0.0),
            }
        )

    return over_series(candles, add, halo=1, keys=keys, chunk_rows=chunk_rows, bucket=bucket)


def rolling_stats(
    candles: DataFrame, column: str, rows: int, keys: Sequence[str] = ("symbol",), chunk_rows: int | None = CHUNK_ROWS,
    bucket: str = "day",
) -> DataFrame:
    """Mean and population standard deviation over the last ``rows`` candles."""
    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumns(
            {
                f"mean_{rows}": F.avg(column).over(_frame(window, rows)),
                f"std_{rows}": F.stddev_pop(column).over(_frame(window, rows)),
            }
        )

    return over_series(candles, add, halo=rows - 1, keys=keys, chunk_rows=chunk_rows, bucket=bucket)


def rsi(candles: DataFrame, period: int = RSI_PERIOD, keys: Sequence[str] = ("symbol",),
        chunk_rows: int | None = CHUNK_ROWS, bucket: str = "day") -> DataFrame:
    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return add_rsi(frame, window, period).drop("change", "gain", "loss")

    return over_series(candles, add, halo=period, keys=keys, chunk_rows=chunk_rows, bucket=bucket)


def macd(candles: DataFrame, fast: int = MACD_FAST, slow: int = MACD_SLOW, signal: int = MACD_SIGNAL,
         keys: Sequence[str] = ("symbol",), chunk_rows: int | None = CHUNK_ROWS, bucket: str = "day") -> DataFrame:
    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return add_macd(frame, window, fast, slow, signal)

    return over_series(candles, add, halo=max(fast, slow) + signal - 2, keys=keys, chunk_rows=chunk_rows, bucket=bucket)


def bollinger(candles: DataFrame, period: int = BOLLINGER_PERIOD, width: float = BOLLINGER_WIDTH,
              keys: Sequence[str] = ("symbol",), chunk_rows: int | None = CHUNK_ROWS, bucket: str = "day") -> DataFrame:
    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return add_bollinger(frame, window, period, width).drop("bb_mean")

    return over_series(candles, add, halo=period - 1, keys=keys, chunk_rows=chunk_rows, bucket=bucket)


# rows before a candle that its indicators look back on
GOLD_HALO = max(RSI_PERIOD, MACD_SLOW + MACD_SIGNAL - 2, BOLLINGER_PERIOD - 1)


def gold_indicators(
    candles: DataFrame,
    keys: Sequence[str] = ("symbol",),
    chunk_rows: int | None = CHUNK_ROWS,
    start: DataFrame | None = None,
    offsets: DataFrame | None = None,
    bucket: str = "day",
) -> DataFrame:
    """All indicators in one pass: the three groups share one partitioning and one sort order.

    ``bucket`` is the span in which candles are counted first, see ``series.index_series``: one that holds many candles
    of a series, but not too many for a task (a day of minutes, a year of days).
    """
    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return add_bollinger(add_macd(add_rsi(frame, window), window), window)

    extra = [k for k in keys if k != "symbol"]
    scored = over_series(
        candles, add, GOLD_HALO, keys, chunk_rows=chunk_rows, start=start, offsets=offsets, bucket=bucket
    )
    return scored.select(*GOLD.fieldNames(), *extra)


def gold_from(recent: DataFrame, start: DataFrame, first_date, keys: Sequence[str] = ("symbol",),
              chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Indicators of the candles from ``first_date`` on, equal to those of a full pass.

    ``recent`` (with ``candle_date``) holds these candles and, per series, the dates before that have the last
    ``GOLD_HALO`` candles; ``start`` (keys, ``rows_before``, ``values_before``) counts what is left out. ``recent`` is read
    twice: pass a stored table.
    """
    scored = gold_indicators(recent, keys, chunk_rows, start)
    return scored.where(utc_date(F.col("window_start")) >= first_date)


def volume_zscore(
    candles: DataFrame, rows: int = 20, threshold: float = 3.0, keys: Sequence[str] = ("symbol",),
    chunk_rows: int | None = CHUNK_ROWS, bucket: str = "day",
) -> DataFrame:
    """Score of each volume against the ``rows`` candles before it; NULL while warming up or when those do not vary."""
    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        before = window.rowsBetween(-rows, -1)
        stats = frame.withColumns(
            {"volume_mean": F.avg("volume").over(before), "volume_std": F.stddev_pop("volume").over(before)}
        )
        ready = (F.col("row_idx") > rows) & (F.col("volume_std") > 0)
        scored = stats.withColumn(
            "volume_zscore", F.when(ready, (F.col("volume") - F.col("volume_mean")) / F.col("volume_std"))
        )
        return scored.withColumn("is_spike", F.coalesce(F.col("volume_zscore") > threshold, F.lit(False)))

    return over_series(candles, add, halo=rows, keys=keys, value="volume", chunk_rows=chunk_rows, bucket=bucket)


# The averages and the signal line as one state (f, s, g): every close takes it to another by an affine map
#   f' = df f + of,  s' = ds s + os,  g' = gg g + gf f + gs s + go
# and maps of rows in a row compose to one map of the same form.
_MAP = ("df", "of", "ds", "os", "gg", "gf", "gs", "go")
EMA_CHUNK = 256


def _struct_of(values: dict[str, Column]) -> Column:
    return F.struct(*[value.cast("double").alias(name) for name, value in values.items()])


def _applied(m: Column, v: Column) -> dict[str, Column]:
    return {
        "f": m["df"] * v["f"] + m["of"],
        "s": m["ds"] * v["s"] + m["os"],
        "g": m["gg"] * v["g"] + m["gf"] * v["f"] + m["gs"] * v["s"] + m["go"],
    }


def _composed(a: Column, b: Column) -> Column:
    """The map of ``a`` and then ``b``."""
    return _struct_of({
        "df": b["df"] * a["df"], "of": b["df"] * a["of"] + b["of"],
        "ds": b["ds"] * a["ds"], "os": b["ds"] * a["os"] + b["os"],
        "gg": b["gg"] * a["gg"], "gf": b["gg"] * a["gf"] + b["gf"] * a["df"],
        "gs": b["gg"] * a["gs"] + b["gs"] * a["ds"],
        "go": b["gg"] * a["go"] + b["gf"] * a["of"] + b["gs"] * a["os"] + b["go"],
    })


def _starts(maps: DataFrame, keys: Sequence[str], before: DataFrame) -> DataFrame:
    """The state before each map: ``maps`` (keys, number, m) in order of ``number``, from the state ``v`` of ``before``."""
    gathered = maps.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("number", "m"))).alias("maps"))
    begun = F.struct(F.col("v").alias("v"), F.expr(
        "cast(array() as array<struct<number: bigint, v: struct<f: double, s: double, g: double>>>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        out = F.concat(acc["out"], F.array(F.struct(x["number"].alias("number"), acc["v"].alias("v"))))
        return F.struct(_struct_of(_applied(x["m"], acc["v"])).alias("v"), out.alias("out"))

    states = F.explode(F.aggregate("maps", begun, step, lambda acc: acc["out"])).alias("x")
    return gathered.join(before, list(keys)).select(*keys, states).select(*keys, "x.number", "x.v")


def ema_macd(
    candles: DataFrame,
    fast: int = MACD_FAST,
    slow: int = MACD_SLOW,
    signal: int = MACD_SIGNAL,
    keys: Sequence[str] = ("symbol",),
    chunk_rows: int = EMA_CHUNK,
    bucket: str = "day",
) -> DataFrame:
    """Exponential-average MACD in the recursive form, exact, with the first close as the seed.

    A missing close changes nothing: the averages before it are kept and nothing fades. They are NULL before the first
    close. Rows are cut into chunks by position, closes or not; each chunk is reduced to one affine map, runs of
    ``chunk_rows`` chunks to one again, and the states before the runs, before the chunks and after each row follow
    from the top down. So no array holds more than ``chunk_rows`` rows, but for one map per run of a series, and all
    stays in the JVM. ``candles`` is read twice: pass a stored table.
    """
    a, b, c = (2.0 / (span + 1) for span in (fast, slow, signal))
    row = F.struct("row_idx", "window_start", "close")
    number = F.floor((F.col("row_idx") - 1) / chunk_rows).alias("number")
    chunks = (
        index_series(candles.select(*dict.fromkeys([*keys, "window_start", "close"])), keys, bucket=bucket)
        .groupBy(_SERIES, number)
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
    )
    identity = _struct_of({n: F.lit(1.0 if n in ("df", "ds", "gg") else 0.0) for n in _MAP})

    def add(m: Column, x: Column) -> Column:
        close = x["close"].cast("double")
        f, of, s, os = (1 - a) * m["df"], (1 - a) * m["of"] + a * close, (1 - b) * m["ds"], (1 - b) * m["os"] + b * close
        added = _struct_of({
            "df": f, "of": of, "ds": s, "os": os, "gg": (1 - c) * m["gg"], "gf": (1 - c) * m["gf"] + c * f,
            "gs": (1 - c) * m["gs"] - c * s, "go": (1 - c) * m["go"] + c * (of - os),
        })
        return F.when(x["close"].isNull(), m).otherwise(added)

    mapped = chunks.withColumn("m", F.aggregate("rows", identity, add))
    firsts = F.filter("rows", lambda x: x["close"].isNotNull())
    seeds = mapped.groupBy(_SERIES).agg(F.min_by(F.get(firsts, 0)["close"], F.when(F.size(firsts) > 0, F.col("number"))).alias("x"))
    seeds = seeds.select(_SERIES, _struct_of({"f": F.col("x"), "s": F.col("x"), "g": F.lit(0.0)}).alias("v"))
    run = F.floor(F.col("number") / chunk_rows)
    lean = mapped.select(_SERIES, "number", "m").withColumn("run", run)
    runs = lean.groupBy(_SERIES, "run").agg(
        F.aggregate(F.array_sort(F.collect_list(F.struct("number", "m"))), identity, lambda m, x: _composed(m, x["m"]))
        .alias("m")
    )
    before_runs = _starts(runs.withColumnRenamed("run", "number"), [_SERIES], seeds).withColumnRenamed("number", "run")
    before_chunks = _starts(lean, [_SERIES, "run"], before_runs)

    # within a chunk, one state after each row; before the first close of a series there is none
    states = "array<struct<row_idx: bigint, v: struct<f: double, s: double, g: double>>>"
    begun = F.struct(F.col("v").alias("v"), F.expr(f"cast(array() as {states})").alias("out"))

    def follow(acc: Column, x: Column) -> Column:
        v, close = acc["v"], x["close"].cast("double")
        f, s = (1 - a) * v["f"] + a * close, (1 - b) * v["s"] + b * close
        moved = _struct_of({"f": f, "s": s, "g": (1 - c) * v["g"] + c * (f - s)})
        after = F.when(x["close"].isNull(), v).otherwise(moved)
        out = F.concat(acc["out"], F.array(F.struct(x["row_idx"].cast("long").alias("row_idx"), after.alias("v"))))
        return F.struct(after.alias("v"), out.alias("out"))

    # whether an earlier chunk of the series has a close: of each chunk only its number takes part
    flags = chunks.select(_SERIES, "number", F.when(F.size(firsts) > 0, F.col("number")).alias("with_close"))
    begun_at = flags.groupBy(_SERIES).agg(F.min("with_close").alias("first_number"))
    earlier = F.coalesce(F.col("number") > F.col("first_number"), F.lit(False)).alias("earlier")
    states_before = before_chunks.drop("run").join(
        flags.join(begun_at, _SERIES).select(_SERIES, "number", earlier), [_SERIES, "number"]
    )
    walked = chunks.join(states_before, [_SERIES, "number"]).select(
        _SERIES, "earlier",
        F.explode(F.arrays_zip("rows", F.aggregate("rows", begun, follow, lambda acc: acc["out"]).alias("after"))).alias("z"),
        F.transform(firsts, lambda x: x["row_idx"])[0].alias("first_close"),
    )
    begins = F.col("earlier") | (F.col("z.rows.row_idx") >= F.col("first_close"))

    def shown(value: Column) -> Column:
        return F.when(F.coalesce(begins, F.lit(False)), value)

    v = F.col("z")["after"]["v"]
    macd = v["f"] - v["s"]
    return walked.select(
        *[F.col(f"{_SERIES}.{k}").alias(k) for k in keys],
        F.col("z.rows.window_start").alias("window_start"),
        F.col("z.rows.close").alias("close"),
        shown(v["f"]).alias("ema_fast"), shown(v["s"]).alias("ema_slow"), shown(macd).alias("ema_macd"),
        shown(v["g"]).alias("ema_signal"), shown(macd - v["g"]).alias("ema_histogram"),
    )
