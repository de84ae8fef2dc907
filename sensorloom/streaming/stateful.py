"""Streams that keep state per key: events that are still open in a zone, and late rows of a label.

State lives in the state store of the checkpoint, so a stream that is stopped or loses an executor goes on from its last
batch. A batch holds the rows of a key in any order; across batches they come in order of the grid (or of arrival).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.zones import KEY, RULES
from ..sources.shared import shared_folder

EVENTS = (
    "building string, zone string, i0 long, ts0 timestamp, sp_from double, sp_to double, t0 double, reheat boolean, minutes_to_1k long, "
    "slope_first_hour double, drop_at_2h double, t63_minutes long, window_min long"
)
#: Seconds without rows, by the stream's clock, after which a zone counts as ended and its open event is closed.
IDLE = 6 * 3600
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def closing(off: np.ndarray, setpoint: np.ndarray, gain: np.ndarray, sp_to: float) -> tuple[int | None, bool]:
    """The row that closes an event, if any, and whether the heater did: two known gains in a row at the limit or above."""
    known = np.flatnonzero(~np.isnan(gain))
    hot = gain[known] >= RULES["gain_on"]
    again = known[1:][hot[1:] & hot[:-1]]
    other = np.flatnonzero((off > RULES["max_window"]) | (setpoint > sp_to + 0.1))
    ends = [int(x[0]) for x in (again, other) if len(x)]
    if not ends:
        return None, False
    return min(ends), bool(len(again)) and int(again[0]) == min(ends)


def measured(t0: float, off: np.ndarray, actual: np.ndarray, gain: np.ndarray, end: int | None) -> tuple | None:
    """What an event shows from its start to the row before ``end``; null if it does not qualify."""
    stop = len(off) if end is None else end
    early = gain[: stop + 1][off[: stop + 1] <= 15]
    early = early[~np.isnan(early)]
    seen = ~np.isnan(actual[:stop])
    s, y = off[:stop][seen], actual[:stop][seen]
    if np.isnan(t0) or len(s) < 5 or (len(early) and early.mean() > RULES["gain_off"]):
        return None
    first = lambda hits: int(s[hits][0]) if hits.any() else None
    hour, around = s <= 60, (s >= 105) & (s <= 135)
    x = s[hour] - s[hour].mean() if hour.any() else s[hour]
    slope = float((x * y[hour]).sum() / (x * x).sum() * 60) if len(x) >= 5 else None
    total = t0 - y[s >= s[-1] - 30].mean()
    settled = s[-1] >= RULES["min_window_t63"] and total >= RULES["plateau_min_drop"]
    t63 = first(y <= t0 - 0.632 * total) if settled else None
    return first(y <= t0 - 1), slope, float(t0 - y[around][-1]) if around.any() else None, t63, int(s[-1])


class OpenDecay(StatefulProcessor):
    """Set-back events of a zone: the last known values and the rows of the event that is open, if one is.

    An event closes by a row, or by a timer once its zone has been silent for ``IDLE`` seconds of event time. While
    it is open no other starts; one may start on the closing row. An open event holds the rows of its window alone.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "setpoint double, actual double")
        self.open = handle.getValueState("open", "i0 long, ts0 timestamp, sp_from double, sp_to double, t0 double, off array<long>, actual array<double>, setpoint array<double>, gain array<double>")

    def _row(self, key, event: tuple, end: int | None, reheat: bool) -> list:
        i0, ts0, sp_from, sp_to, t0, off, actual, _, gain = event
        found = measured(t0, off, actual, gain, end)
        return [] if found is None else [(*key, i0, ts0, sp_from, sp_to, t0, reheat, *found)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values("grid_idx")
        idx, stamps = batch["grid_idx"].to_numpy(np.int64), batch["ts"].to_list()
        actual, setpoint, gain = (batch[c].to_numpy(np.float64) for c in ("actual", "setpoint", "gain"))
        before = self.known.get() if self.known.exists() else (None, None)
        nan = lambda v: np.nan if v is None else v
        filled = [pd.Series(np.r_[nan(v), x]).ffill().to_numpy() for v, x in zip(before, (setpoint, actual))]
        starts = np.flatnonzero(filled[0][:-1] - setpoint >= RULES["min_sp_drop"])
        none = lambda v: None if np.isnan(v) else float(v)
        self.known.update((none(filled[0][-1]), none(filled[1][-1])))
        out, at, event = [], 0, None
        if self.open.exists():
            held = self.open.get()
            event = (*held[:4], nan(held[4]), *(np.array([nan(v) for v in x], np.int64 if k == 0 else np.float64) for k, x in enumerate(held[5:])))
        while True:
            if event is None:
                later = starts[np.searchsorted(starts, at) :]
                if not len(later):
                    break
                j = int(later[0])
                t0 = actual[j] if not np.isnan(actual[j]) else filled[1][j]
                event, at = (int(idx[j]), stamps[j], float(filled[0][j]), float(setpoint[j]), float(t0), np.zeros(0, np.int64), *[np.zeros(0)] * 3), j + 1
            # the rows of the window and the first past it
            upto = int(np.searchsorted(idx, event[0] + RULES["max_window"], side="right")) + 1
            old = len(event[5])
            event = (*event[:5], np.r_[event[5], idx[at:upto] - event[0]], *(np.r_[h, x[at:upto]] for h, x in zip(event[6:], (actual, setpoint, gain))))
            end, reheat = closing(event[5], event[7], event[8], event[3])
            if end is None:
                break
            out += self._row(key, event, end, reheat)
            event, at = None, at + end - old
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if event is None:
            self.open.clear()
        else:
            off, *others = event[5:]
            self.open.update((*event[:4], none(event[4]), off.tolist(), *([none(v) for v in x] for x in others)))
            self.handle.registerTimer(int(pd.Timestamp(max(stamps)).timestamp() * 1000) + IDLE * 1000)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out = []
        if self.open.exists():
            held = self.open.get()
            nan = lambda v: np.nan if v is None else v
            event = (*held[:4], nan(held[4]), *(np.array([nan(v) for v in x], np.int64 if k == 0 else np.float64) for k, x in enumerate(held[5:])))
            out = self._row(key, event, None, False)
            self.open.clear()
        yield self._frame(out)

    @staticmethod
    def _frame(rows: list) -> pd.DataFrame:
        names = [c.split()[0] for c in EVENTS.split(", ")]
        frame = pd.DataFrame(rows, columns=names)
        whole = {c: "Int64" for c in ("i0", "minutes_to_1k", "t63_minutes", "window_min")}
        part = {c: "float64" for c in ("sp_from", "sp_to", "t0", "slope_first_hour", "drop_at_2h")}
        return frame.astype(whole | part | {"reheat": "boolean", "ts0": "datetime64[ns]"})

    def close(self) -> None:
        pass


class LateRows(StatefulProcessor):
    """Of a label: numeric rows so far, those older than one that came before (counted, not merged), and falls of accepted values."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "top string, value double, n long, late long, falls long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values("arrival")
        top, value, n, late, falls = self.seen.get() if self.seen.exists() else ("", None, 0, 0, 0)
        tops = np.maximum.accumulate(np.array([top, *batch["ts_text"]], object))
        fresh = batch["ts_text"].to_numpy(object) >= tops[:-1]
        accepted = batch["value"].to_numpy(np.float64)[fresh]
        whole = accepted if value is None else np.r_[value, accepted]
        falls += int((np.diff(whole) < 0).sum())
        n, late = n + len(batch), late + int((~fresh).sum())
        self.seen.update((str(tops[-1]), float(whole[-1]) if len(whole) else None, n, late, falls))
        yield pd.DataFrame({"raw_label": [key[0]], "n_num": [n], "out_of_order": [late], "n_decreases": [falls]})

    def close(self) -> None:
        pass


def open_decays(samples: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """The events of ``operators.events.decay_events`` from a stream of zone samples, each as its window closes."""
    rows = samples.where(~F.col("is_empty") & ~F.col("is_bad")).select(*KEY, "grid_idx", F.col("ts").cast("timestamp").alias("ts"), "actual", "setpoint", "gain")
    return rows.withWatermark("ts", watermark).groupBy(*KEY).transformWithStateInPandas(OpenDecay(), EVENTS, "append", "EventTime")


def late_rows(points: DataFrame) -> DataFrame:
    """Counts of each label so far, a row per label and batch that brought rows of it; the largest ``n_num`` is the latest."""
    rows = points.where("value is not null").select("raw_label", "ts_text", "value", "arrival")
    return rows.groupBy("raw_label").transformWithStateInPandas(LateRows(), "raw_label string, n_num long, out_of_order long, n_decreases long", "append", "None")


def run_in_slices(slices: list[DataFrame], query: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Streams ``slices`` one after another: each is written to the source's folder, then the stream is started again from
    its checkpoint and ends with what is there. Returns the rows that it has written."""
    spark = slices[0].sparkSession
    where = f"{shared_folder(spark)}/slices-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    for s in slices:
        s.write.mode("append").parquet(f"{where}/source")
        run_available(query(spark.readStream.schema(s.schema).parquet(f"{where}/source")), where)
    return spark.read.parquet(f"{where}/sink")


def run_available(result: DataFrame, where: str) -> None:
    spark: SparkSession = result.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        stream = result.writeStream.outputMode("append").option("checkpointLocation", f"{where}/state").trigger(availableNow=True).format("parquet").start(f"{where}/sink")
        stream.awaitTermination()
    finally:
        spark.conf.set(name, before)
