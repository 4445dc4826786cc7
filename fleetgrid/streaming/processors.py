"""Keyed state with timers: deduplication and cell matching.

A processor sees the rows of its key in arrival order.  Within a micro-batch
they are sorted by the arrival column; the batch size is bounded by the intake
limit of the source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DEDUP_WINDOW_MS = 10_000


def _together(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = list(batches)
    return pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]


def _whole(rows: pd.DataFrame, columns: list[str]) -> list[np.ndarray] | None:
    """The columns as 64-bit numbers; None where one of them has nulls or is no such number."""
    values = [rows[c].to_numpy() for c in columns]
    return values if all(v.dtype.kind == "i" for v in values) else None


def _in_order(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return _together(batches).sort_values(order, kind="stable", ignore_index=True)


class DropRepeats(StatefulProcessor):
    """Forward a row unless its timestamp equals the last one stored for the key.

    With ``ttl_ms`` a stored timestamp is void once it is older than that by
    the clock of the row that meets it; rows that are dropped do not renew it.
    With ``evict`` a timer removes it as soon as no row can meet it any more:
    when the watermark of the clock, or processing time, has passed that age.
    """

    def __init__(self, ts: str, order: list[str], ttl_ms: int | None, clock: str | None, evict: bool, columns: list[str]):
        self.ts, self.order, self.ttl_ms, self.clock, self.evict, self.columns = ts, order, ttl_ms, clock, evict, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = T.StructType([T.StructField("ts", T.LongType()), T.StructField("due", T.LongType())])
        self.last = handle.getValueState("last", schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = _together(rows)
        stored = self.last.get() if self.last.exists() else None
        before = stored[0] if stored is not None else None
        clock = self.clock if self.clock or self.ttl_ms is None else timerValues.getCurrentProcessingTimeInMs()
        whole = _whole(batch, [self.ts, *self.order, *([self.clock] if self.clock else [])])
        kept, last = self._fresh(whole, before, clock) if whole else self._fresh_with_nulls(batch, before, clock)
        self._store(last, stored[1] if stored is not None else None, timerValues)
        yield batch.take(kept)[self.columns]

    def _fresh(self, whole: list[np.ndarray], before: int | None, clock) -> tuple[np.ndarray, int]:
        """Positions of the rows that pass, in order, and the last timestamp: plain numbers, since most keys have few rows."""
        place = np.lexsort(whole[len(self.order):0:-1])
        now = whole[0][place]
        repeated = np.empty(len(now), bool)
        repeated[0] = before is not None and now[0] == before
        np.equal(now[1:], now[:-1], out=repeated[1:])
        if self.ttl_ms is not None:
            repeated &= now >= (whole[-1][place] if self.clock else clock) - self.ttl_ms
        return place[~repeated], int(now[-1])

    def _fresh_with_nulls(self, batch: pd.DataFrame, before: int | None, clock) -> tuple[np.ndarray, int | None]:
        """The same with nullable whole numbers: nothing passes through floating point on the way."""
        batch = batch.reset_index(drop=True).sort_values(self.order, kind="stable")
        now = batch[self.ts].astype("Int64")
        previous = now.shift(1)
        if before is not None:
            previous.iloc[0] = before
        repeated = (previous == now).fillna(False)
        if self.ttl_ms is not None:
            repeated &= (now >= (batch[self.clock].astype("Int64") if self.clock else clock) - self.ttl_ms).fillna(False)
        last = now.iloc[-1]
        return batch.index.to_numpy()[~repeated.astype(bool).to_numpy()], None if pd.isna(last) else int(last)

    def _store(self, last: int | None, old: int | None, timerValues) -> None:
        due = last + self.ttl_ms + 1 if self.evict and last is not None else None
        if due is not None:
            clock = timerValues.getCurrentWatermarkInMs() if self.clock else timerValues.getCurrentProcessingTimeInMs()
            if due < clock:
                last = None  # void before it is stored
        if last is None:
            due = None
        if old is not None and old != due:
            self.handle.deleteTimer(old)
        if last is None:
            self.last.clear()
            return
        self.last.update((last, due))
        if due is not None and old != due:
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


class MatchInCell(StatefulProcessor):
    """Keep the last driver that wrote to a cell; answer riders from it."""

    def __init__(self, available: bool):
        self.available = available

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("driver_id", T.StringType()), T.StructField("status", T.StringType())])
        self.driver = handle.getValueState("driver", schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows, ["arrival", "kind"])
        is_driver = batch["kind"] == "driver"
        stored = self.driver.get() if self.driver.exists() else None
        columns = ["driver_id", "status"]
        seen = batch[columns].where(is_driver)
        # position of the last driver row at or before each row; -1 means the stored driver
        at = pd.Series(range(len(batch))).where(is_driver).ffill().fillna(-1).astype(int)
        for name, old in zip(columns, stored if stored is not None else (None, None)):
            current = seen[name].reindex(at).reset_index(drop=True)
            batch[f"now_{name}"] = current.where(at >= 0, old)
        if is_driver.any():
            row = batch[is_driver].iloc[-1]
            self.driver.update((row["driver_id"], row["status"]))
        wanted = ~is_driver & batch["now_driver_id"].notna()
        if self.available:
            wanted &= batch["now_status"] == "AVAILABLE"
        matched = batch[wanted]
        yield pd.DataFrame({"rider_id": matched["rider_id"], "driver_id": matched["now_driver_id"],
                            "cell": key[0], "arrival": matched["arrival"]})

    def close(self) -> None:
        pass


CLOCK = "__clock"  # event time made of a clock column


def dedup_stream(df: DataFrame, key: str = "driver_id", ts: str = "ts_ms", order: list[str] | None = None,
                 ttl_ms: int | None = None, clock: str | None = None, lateness: str | None = None) -> DataFrame:
    """Streaming twin of ``dedup_last``.

    With ``ttl_ms`` a timestamp is forgotten once it is older than that by the
    clock: a column of milliseconds, or processing time.  By processing time,
    and with ``lateness`` by a clock column as well, what is forgotten also leaves
    the state: the watermark follows the clock at that distance, and rows behind it
    are late and left out.
    """
    evict = ttl_ms is not None and (clock is None or lateness is not None)
    mode = "None" if not evict else "EventTime" if clock else "ProcessingTime"
    processor = DropRepeats(ts, order or ["event_id"], ttl_ms, clock, evict, df.columns)
    rows = df.withColumn(CLOCK, F.timestamp_millis(clock)).withWatermark(CLOCK, lateness) if mode == "EventTime" else df
    return rows.groupBy(key).transformWithStateInPandas(processor, df.schema, "append", mode)


MATCH_SCHEMA = "rider_id STRING, driver_id STRING, cell BIGINT, arrival BIGINT"


def match_same_cell_stream(union: DataFrame, available: bool = True) -> DataFrame:
    """Riders meet the last driver that reached their cell before them.

    Each cell's rows of a micro-batch go through one task; where cells may be
    very crowded use ``jobs.match_in_batches``.
    """
    return union.groupBy("cell").transformWithStateInPandas(MatchInCell(available), MATCH_SCHEMA, "append", "None")

