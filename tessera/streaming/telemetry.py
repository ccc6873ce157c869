"""Live windows of frames, live log metrics and mining rounds as micro-batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.mining import mine_round
from ..operators.telemetry import TIMINGS
from ..sources.files import append_round

_STATS = ("avg", "p50", "p95", "max")
_EVENT_SCHEMA = "run_id long, window long, frames long, frame_index long, window_ms double, stats array<double>, timings array<double>, problem string"


def _statistics(values: Iterable[float | None]) -> list[float | None]:
    """Average, median, p95 and maximum by the rules of the batch operator: nulls don't count, NaN is above all numbers."""
    v = sorted((x for x in values if x is not None), key=lambda x: (x != x, x))
    n = len(v)
    return [sum(v) / n, v[(n - 1) // 2], v[max(-(-95 * n // 100), 1) - 1], v[-1]] if n else [None] * 4


def window_row(run_id: int, window: int, frames: dict[int, list[float | None]]) -> Row:
    """The statistics of one full window: those of each timing in turn, then the average and p95 of the frame rate."""
    columns = list(zip(*frames.values()))
    loops = [v for v in columns[TIMINGS.index("loop_ms")] if v is not None]
    rate = _statistics(1000 / v for v in loops if v > 0)  # a frame without loop time has no rate
    stats = [s for column in columns for s in _statistics(column)] + [rate[0], rate[2]]
    return Row(run_id=run_id, window=window, frames=len(frames), frame_index=max(frames), window_ms=sum(loops) if loops else None, stats=stats, timings=None, problem=None)


class FrameWindows(StatefulProcessor):
    """Keeps a run's frames of its open windows and gives a row for each window that is full, and one for each frame in no window.

    A window is full when all n frame indexes of it have come, in any order and whatever other windows lack. It is closed when
    more than `lag` later windows have come or begun; so a run's state is lag + 1 windows at most. Frames of a window that was
    closed before it was full are given as `incomplete`, frames that come after theirs was closed or given as `late`, repeated
    frames of an open window as `repeated`, and frames without an index as `no_index`.

    All of a run's state is one value, as each access to the state is a message to Spark, and there may be very many runs.
    """

    def __init__(self, n: int, lag: int = 8):
        self.n, self.lag = n, lag

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "closed long, given array<long>, indexes array<long>, timings array<double>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        closed, given, indexes, flat = self.open.get() or (None, [], [], [])
        given, held, out, width = set(given), {}, [], len(TIMINGS)
        for k, i in enumerate(indexes):
            held.setdefault(i // self.n, {})[i] = flat[k * width : (k + 1) * width]

        def refuse(i: int | None, timings: list[float | None], problem: str) -> None:
            out.append(Row(run_id=key[0], window=None if i is None else i // self.n, frames=None, frame_index=i, window_ms=None, stats=None, timings=list(timings), problem=problem))

        for i, timings in ((r["frame_index"], r["timings"]) for r in rows):
            if i is None:
                refuse(i, timings, "no_index")
            elif i // self.n in given or (closed is not None and i // self.n <= closed):
                refuse(i, timings, "late")
            elif i in held.setdefault(i // self.n, {}):
                refuse(i, timings, "repeated")
            else:
                held[i // self.n][i] = timings
        for w in sorted(w for w, own in held.items() if len(own) == self.n):
            out.append(window_row(key[0], w, held.pop(w)))
            given.add(w)
        seen = sorted(given | set(held))
        if len(seen) > self.lag + 1:
            closed = seen[-self.lag - 2]  # later than what was closed before, as all that is seen is
            for w in [w for w in seen if w <= closed]:
                given.discard(w)
                for i, timings in held.pop(w, {}).items():
                    refuse(i, timings, "incomplete")
        frames = [(i, timings) for own in held.values() for i, timings in own.items()]
        self.open.update((closed, sorted(given), [i for i, _ in frames], [v for _, timings in frames for v in timings]))
        yield from out

    def close(self) -> None:
        pass


def frame_events_stream(frames: DataFrame, n: int = 120, lag: int = 8) -> DataFrame:
    """Full windows (problem is null) and the frames that are in none (problem, and the frame's timings), in one stream: split it in
    foreachBatch to keep both of one run of the state."""
    packed = frames.select(F.col("run_id").cast("long").alias("run_id"), F.col("frame_index").cast("long").alias("frame_index"), F.array(*(F.col(t).cast("double") for t in TIMINGS)).alias("timings"))
    events = packed.groupBy("run_id").transformWithState(FrameWindows(n, lag), _EVENT_SCHEMA, "Append", "None")
    names = [*(f"{t}_{s}" for t in TIMINGS for s in _STATS), "fps_avg", "fps_p95"]
    unpacked = (F.get(c, F.lit(k)).alias(name) for c, own in (("stats", names), ("timings", TIMINGS)) for k, name in enumerate(own))
    return events.select("run_id", "window", "frames", "frame_index", "window_ms", *unpacked, "problem")


def frame_windows_stream(frames: DataFrame, n: int = 120, lag: int = 8) -> DataFrame:
    """The windows of frame_windows() of a stream, each when its last frame has come.

    A frame more than `lag` windows late is in none, as its window is closed (frame_violations_stream has it), and a repeated frame
    counts once, where frame_windows() leaves its window out.
    """
    return frame_events_stream(frames, n, lag).where("problem is null").drop("problem", *TIMINGS)


def frame_violations_stream(frames: DataFrame, n: int = 120, lag: int = 8) -> DataFrame:
    """(run_id, window, frame_index, timings, problem): the frames that no window holds."""
    return frame_events_stream(frames, n, lag).where("problem is not null").select("run_id", "window", "frame_index", *TIMINGS, "problem")


_LINE = re.compile(r"\[PERF\]\[([^\]]+)\]\s*(.*)")
_PAIR = re.compile(r'([A-Za-z0-9_]+)=("[^"]*"|\S+)')
_NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")


class LogMetrics(StatefulProcessor):
    """Numbers of a log file's lines in their order, with the number of the last summary line of their run so far.

    The state of all runs of a file is one value, as each access to the state is a message to Spark, and there may be very many runs.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.windows = handle.getValueState("windows", "runs array<string>, n array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows, out = dict(zip(*(self.windows.get() or ((), ())))), []
        for run, number, line in pd.concat(list(rows)).sort_values("line_no")[["run", "line_no", "line"]].itertuples(index=False):
            if not (head := _LINE.search(line or "")):
                continue
            section, values = head[1], dict(_PAIR.findall(head[2]))
            n = windows[run] = windows.get(run, 0) + (section == "summary")
            out += [(key[0], run, n, section, int(number), f"{section}.{name}", float(text)) for name, text in values.items() if _NUMBER.match(text)]
        self.windows.update((list(windows), list(windows.values())))
        if out:
            yield pd.DataFrame(out, columns=["file", "run", "window", "section", "line_no", "metric", "value"])

    def close(self) -> None:
        pass


def perf_log_stream(lines: DataFrame) -> DataFrame:
    """(file, line_no, line), or with run -> (file, run, window, section, line_no, metric, value) as they come; window 0 holds orphans.

    Without a column run each file is a run, named by an empty text. Lines may come in any order inside a micro-batch; later batches
    hold later lines of a file. A section that a window repeats replaces the one before: of a file, run, window and section the rows with
    the last line_no hold, as latest_sections() keeps them.
    """
    named = lines.select("file", F.coalesce("run", F.lit("")).alias("run") if "run" in lines.columns else F.lit("").alias("run"), "line_no", "line")
    return named.groupBy("file").transformWithStateInPandas(LogMetrics(), "file string, run string, window long, section string, line_no long, metric string, value double", "Append", "None")


def latest_sections(metrics: DataFrame) -> DataFrame:
    """What perf_log_stream has written so far, as log_metrics() gives it: (file, run, window, metric, value) of windows from 1 on."""
    rows = metrics.where("window > 0 and section <> 'config'")
    last = F.max("line_no").over(Window.partitionBy("file", "run", "window", "section"))
    return rows.withColumn("_last", last).where("line_no = _last").select("file", "run", "window", "metric", "value")


def mining_rounds(scored: DataFrame, ledger: str, k: int, checkpoint: str, read_ledger: Callable[[], DataFrame], once: bool = False):
    """Starts a query that mines k rows in each micro-batch as a round, among all rows that have come and no round has taken; with `once`
    it ends when all that is there now has been seen.

    Rows wait in <ledger>-pool, of which each batch writes a new version from the one before and its own rows: what a round took goes, and
    of an id that comes again the newest row stays. So a batch reads what waits, not all that ever came; the version before is
    kept for a batch that runs again after a failure, older ones are dropped. A round that the ledger has isn't mined again.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, lambda n: f"{ledger}-pool/version={n}"
        known = read_ledger()
        done = known.where(F.col("round_id") < batch_id).select("roi_id").distinct()
        rows = batch.withColumn("_new", F.lit(1))
        if batch_id:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(at(batch_id - 1)).withColumn("_new", F.lit(0)))
        newest = rows.groupBy("roi_id").agg(F.max(F.struct("_new", *(c for c in batch.columns if c != "roi_id"))).alias("_row"))
        newest = newest.select("roi_id", "_row.*").select(batch.columns).join(done, "roi_id", "left_anti")
        newest.write.mode("overwrite").parquet(at(batch_id))
        if known.where(F.col("round_id") == batch_id).isEmpty():
            append_round(mine_round(spark.read.schema(batch.schema).parquet(at(batch_id)), known, k, batch_id), ledger)
        if batch_id > 1:
            old = spark._jvm.org.apache.hadoop.fs.Path(at(batch_id - 2))
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    writer = scored.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
