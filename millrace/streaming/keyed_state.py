"""Keyed state for streams: counters, lists, alerts and timers, in event-time order.

A key's rows wait in its state until the watermark has passed them, and are then folded in (ts, seq)
order. So the answer depends on neither the order of arrival nor the size of micro-batches, as long as
the watermark's delay covers the disorder. A row that comes after the watermark has passed it is not
lost: it comes out as a late row (`late_seq`, `late_ts`; see `on_time` and `late`), as does a row without
a time. Each processor has a batch twin in `millrace.operators`, which also splits hot keys; here the
rows that one key has waiting pass through one task, bounded by the delay and the trigger's limit.

Rows travel as rows and not as pandas frames, which cannot tell a null reading from NaN.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.session import use_rocksdb_state


# processors travel to the executors by value, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LATE = "late_seq bigint, late_ts_us bigint"


#: How much time the waiting rows of one state entry span, if they are more than FEW.
BUCKET_SECONDS = 6 * 3600
#: So few rows share one state entry, whatever time they span.
FEW = 60
#: A key's rows are folded in rounds once they are so many.
MANY = 100_000

_AT = itemgetter(0)


def apply_state(df: DataFrame, key: str, processor: InOrder, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Rows (key, seq, ts, value) through one of the processors below; key keeps its name.

    The stream must have a watermark. Inside a processor every instant is a number of microseconds, in
    rows and in state alike; the watermarked column itself stays outside, as Spark would drop late rows.
    A timer reads and rewrites the rows of the buckets of time that the watermark has reached, so buckets
    should be a small part of the watermark's delay.
    """
    use_rocksdb_state(df.sparkSession)
    processor.width = bucket_seconds * 1_000_000
    kind = df.schema[key].dataType.simpleString()
    columns = [key, *processor.INPUT]
    rows = df.withColumn("at", F.unix_micros("ts")).select(*columns)
    out = rows.groupBy(key).transformWithState(
        statefulProcessor=processor,
        outputStructType=f"key {kind}, {processor.OUTPUT}, {_LATE}",
        outputMode="Append",
        timeMode="EventTime",
    )
    times = [c for c in out.columns if c.endswith("_us")]
    named = [
        F.timestamp_micros(c).alias(c[:-3]) if c in times else F.col(c) for c in out.columns if c != "key"
    ]
    return out.select(F.col("key").alias(key), F.col("late_seq").isNotNull().alias("is_late"), *named)


def on_time(emitted: DataFrame) -> DataFrame:
    """What the processor made of the rows that came in time."""
    return emitted.where("not is_late").drop("is_late", "late_seq", "late_ts")


def late(emitted: DataFrame, key: str) -> DataFrame:
    """The rows that came too late: key, seq, ts."""
    return emitted.where("is_late").select(key, F.col("late_seq").alias("seq"), F.col("late_ts").alias("ts"))


class InOrder(StatefulProcessor):
    """Holds rows until the watermark has passed them, then hands them to `fold` in order.

    Waiting rows stand in a map of entries. An entry of more than `FEW` rows holds rows of one bucket of time,
    so a timer rewrites no others; the rows of buckets with fewer share entries, as each call of the state
    costs more than its rows. A key has one timer, at the first of its rows or of what the processor waits for.
    """

    INPUT = ("seq", "at", "value")
    WAITING = "at long, seq long, value double"
    OUTPUT: str
    width = BUCKET_SECONDS * 1_000_000

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Declare further state."""

    def fold(self, key, rows: list[tuple], passed: int) -> Iterator[Row]:
        """Rows of `WAITING`, in order; no row before `passed` (microseconds) is to come after them."""
        raise NotImplementedError

    def due(self) -> int | None:
        """When the processor wants to be called without any row; asked for when `fold` has ended."""
        return None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # an array for each column: structs would be converted one by one
        columns = ", ".join(f"{f.split()[0]} array<{f.split()[1]}>" for f in self.WAITING.split(", "))
        self.waiting = handle.getMapState("waiting", "entry long", columns)
        #: how far the key has been folded; the processor's own time; for each entry its first time and number of rows
        self.clock = handle.getValueState("clock", "done long, due long, entries array<long>, firsts array<long>, sizes array<long>")
        self.names = ["key", *(c.split()[0] for c in f"{self.OUTPUT}, {_LATE}".split(", "))]
        self.open(handle)

    def row(self, key, **values) -> Row:
        return Row(**{name: values.get(name) for name in self.names} | {"key": key})

    def _load(self) -> tuple[int | None, int | None, dict[int, tuple[int, int]]]:
        done, due, entries, firsts, sizes = self.clock.get() or (None, None, [], [], [])
        return done, due, dict(zip(entries, zip(firsts, sizes, strict=True), strict=True))

    def _rows(self, entry: int) -> list[tuple]:
        return list(zip(*self.waiting.getValue((entry,)), strict=True))

    def _keep(self, rows: list[tuple], entries: dict[int, tuple[int, int]]) -> None:
        few: list[tuple] = []
        parts: list[list[tuple]] = []
        for _, own in groupby(sorted(rows, key=_AT), lambda r: r[0] // self.width):
            bucket = list(own)
            if len(bucket) < FEW:
                few += bucket
            else:
                parts.append(bucket)
        open_ = next((e for e, (_, size) in entries.items() if size + len(few) <= FEW), None) if few else None
        if open_ is not None:
            self._put(open_, self._rows(open_) + few, entries)
        else:
            parts += [few[i : i + FEW] for i in range(0, len(few), FEW)]
        for part in parts:
            self._put(max(entries, default=-1) + 1, part, entries)

    def _put(self, entry: int, rows: list[tuple], entries: dict[int, tuple[int, int]]) -> None:
        self.waiting.updateValue((entry,), tuple(map(list, zip(*rows, strict=True))))
        entries[entry] = min(r[0] for r in rows), len(rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        done, due, entries = self._load()
        fresh: list[tuple] = []
        for r in rows:
            if r["at"] is None or (done is not None and r["at"] < done):
                yield self.row(key[0], late_seq=r["seq"], late_ts_us=r["at"])
            else:
                fresh.append(tuple(r[c] for c in ("at", "seq", *self.INPUT[2:])))
        if fresh:
            before = self._timer(due, entries)
            self._keep(fresh, entries)
            self._save(done, due, entries, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        _, due, entries = self._load()
        before = self._timer(due, entries) - {expiredTimerInfo.getExpiryTimeInMs()}  # a fired timer is gone
        rounds: list[list[int]] = [[]]
        size = 0
        for entry in sorted((e for e, (first, _) in entries.items() if first < passed), key=lambda e: entries[e]):
            if size >= MANY:
                rounds.append([])
                size = 0
            rounds[-1].append(entry)
            size += entries[entry][1]
        until = [*(entries[own[0]][0] for own in rounds[1:]), passed]
        held: list[tuple] = []
        for own, end in zip(rounds, until, strict=True):
            for entry in own:
                held += self._rows(entry)
                self.waiting.removeKey((entry,))
                del entries[entry]
            held.sort(key=lambda r: r[:2])
            ready = bisect_left(held, end, key=_AT)
            yield from self.fold(key[0], held[:ready], end)
            held = held[ready:]
        self._keep(held, entries)
        self._save(passed, self.due(), entries, before)

    def _timer(self, due: int | None, entries: dict[int, tuple[int, int]]) -> set[int]:
        """The key's timer in milliseconds, if it has one."""
        times = [first // 1000 + 1 for first, _ in entries.values()] + ([] if due is None else [-(-due // 1000)])
        return {min(times)} if times else set()

    def _save(self, done: int | None, due: int | None, entries: dict[int, tuple[int, int]], before: set[int]) -> None:
        after = self._timer(due, entries)
        for timer in before - after:
            self.handle.deleteTimer(timer)
        for timer in after - before:
            self.handle.registerTimer(timer)
        self.clock.update((done, due, list(entries), [first for first, _ in entries.values()], [size for _, size in entries.values()]))

    def close(self) -> None:
        pass


class MapCounts(InOrder):
    """(key, kind, n, seq, ts): how often the key has had this kind by now, for each kind just folded."""

    INPUT = ("seq", "at", "kind")
    WAITING = "at long, seq long, kind string"
    OUTPUT = "kind string, n bigint, seq bigint, ts_us bigint"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "kind string", "n long")

    def fold(self, key, rows, passed) -> Iterator[Row]:
        fresh: dict[str, list[tuple]] = {}
        for r in rows:
            fresh.setdefault(r[2], []).append(r)
        for kind, own in fresh.items():
            held = self.counts.getValue((kind,)) if self.counts.containsKey((kind,)) else None
            n = len(own) + (held[0] if held else 0)
            self.counts.updateValue((kind,), (n,))
            yield self.row(key, kind=kind, n=n, seq=own[-1][1], ts_us=own[-1][0])


class RunningCount(InOrder):
    """(key, seq, ts, running): how many rows of the key there are up to this one."""

    OUTPUT = "seq bigint, ts_us bigint, running bigint"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def fold(self, key, rows, passed) -> Iterator[Row]:
        (n,) = self.count.get() or (0,)
        for at, seq, _ in rows:
            n += 1
            yield self.row(key, seq=seq, ts_us=at, running=n)
        self.count.update((n,))


class JumpAlert(InOrder):
    """(key, seq, previous, current) when a value differs from the one before by more than a limit.

    Nothing is known to differ from a null reading, so none of its two sides alerts.
    """

    OUTPUT = "seq bigint, previous double, current double"

    def __init__(self, threshold: float):
        self.threshold = threshold

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "v double")

    def fold(self, key, rows, passed) -> Iterator[Row]:
        (previous,) = self.last.get() or (None,)
        for _, seq, value in rows:
            if previous is not None and value is not None and abs(value - previous) > self.threshold:
                yield self.row(key, seq=seq, previous=previous, current=value)
            previous = value
        self.last.update((previous,))


class RateBlacklist(InOrder):
    """(key, seq, day, n) for each event beyond the limit of a local day."""

    OUTPUT = "seq bigint, local_day_us bigint, n bigint"

    def __init__(self, limit: int, offset_hours: int):
        self.limit, self.offset = limit, offset_hours * 3_600_000_000

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.today = handle.getValueState("today", "day long, n long")

    def fold(self, key, rows, passed) -> Iterator[Row]:
        # rows come in order, so a day is over when the next one begins
        today, n = self.today.get() or (None, 0)
        for at, seq, _ in rows:
            day = (at + self.offset) // 86_400_000_000
            today, n = day, n + 1 if day == today else 1
            if n > self.limit:
                yield self.row(key, seq=seq, local_day_us=day * 86_400_000_000, n=n)
        self.today.update((today, n))


class LastN(InOrder):
    """(key, seq, last_values) whenever rows are folded: the newest n values, oldest first, as of seq."""

    OUTPUT = "seq bigint, ts_us bigint, last_values array<double>"

    def __init__(self, n: int):
        self.n = n

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.values = handle.getListState("values", "v double")

    def fold(self, key, rows, passed) -> Iterator[Row]:
        if rows:
            held = [v[0] for v in self.values.get()] if self.values.exists() else []
            held = (held + [value for _, _, value in rows])[-self.n :]
            self.values.put([(v,) for v in held])
            at, seq, _ = rows[-1]
            yield self.row(key, seq=seq, ts_us=at, last_values=held)


class Retract(InOrder):
    """(key, flag, kind, seq, ts): for each change of a key's row, - for what stood there and + for what stands now.

    Input rows carry the row's kind, or null where the row is deleted. A change that changes nothing gives nothing.
    """

    INPUT = ("seq", "at", "kind")
    WAITING = "at long, seq long, kind string"
    OUTPUT = "flag string, kind string, seq bigint, ts_us bigint"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.shown = handle.getValueState("shown", "kind string")

    def fold(self, key, rows, passed) -> Iterator[Row]:
        before = shown = (self.shown.get() or (None,))[0]
        for at, seq, kind in rows:
            for flag, value in (("-", shown), ("+", kind)):
                if shown != kind and value is not None:
                    yield self.row(key, flag=flag, kind=value, seq=seq, ts_us=at)
            shown = kind
        if shown is None:
            self.shown.clear()
        elif shown != before:
            self.shown.update((shown,))


class CountWindowAvg(InOrder):
    """(key, window_no, avg_value) after every n rows of a key; an unfinished group stays in state.

    Null values count as rows and add nothing; a group of nulls has a null average.
    """

    OUTPUT = "window_no bigint, avg_value double"

    def __init__(self, n: int):
        self.n = n

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.group = handle.getValueState("group", "window_no long, rows long, total long")

    def fold(self, key, rows, passed) -> Iterator[Row]:
        window_no, held, total = self.group.get() or (0, 0, None)
        for _, _, value in rows:
            held += 1
            if value is not None:
                total = (total or 0) + int(value)
            if held == self.n:
                average = None if total is None else float(abs(total) // self.n * (1 if total >= 0 else -1))
                yield self.row(key, window_no=window_no, avg_value=average)
                window_no, held, total = window_no + 1, 0, None
        self.group.update((window_no, held, total))


class SustainedRise(InOrder):
    """(key, alert_at): a rise starts a timer, a fall cancels it, a fired timer alerts.

    Timers run on event time; a due timer fires before the next reading is applied. A null reading
    neither rises nor falls, and the reading after it counts as a first one.
    """

    OUTPUT = "alert_at_us bigint"

    def __init__(self, seconds: int, first_reading_starts: bool = True):
        self.wait = seconds * 1_000_000
        self.first = first_reading_starts

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "v double, pending long")

    def due(self) -> int | None:
        return self.next

    def fold(self, key, rows, passed) -> Iterator[Row]:
        previous, pending = self.last.get() or (None, None)
        for at, _, value in rows:
            if pending is not None and pending <= at:
                yield self.row(key, alert_at_us=pending)
                pending = None
            if value is not None:
                rises = value > previous if previous is not None else self.first and value > 0
                if rises and pending is None:
                    pending = at + self.wait
                elif previous is not None and value < previous:
                    pending = None
            previous = value
        if pending is not None and pending <= passed:
            yield self.row(key, alert_at_us=pending)
            pending = None
        self.next = pending
        self.last.update((previous, pending))


class Inactivity(InOrder):
    """(key, last_ts, alert_at) when a key is silent for longer than the wait."""

    OUTPUT = "last_ts_us bigint, alert_at_us bigint"

    def __init__(self, seconds: int):
        self.wait = seconds * 1_000_000

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long, alerted boolean")

    def due(self) -> int | None:
        return self.next

    def fold(self, key, rows, passed) -> Iterator[Row]:
        last, alerted = self.last.get() or (None, False)
        for at, _, _ in rows:
            if last is not None and not alerted and at - last > self.wait:
                yield self.row(key, last_ts_us=last, alert_at_us=last + self.wait)
            last, alerted = at, False
        if last is not None and not alerted and last + self.wait <= passed:
            alerted = True
            yield self.row(key, last_ts_us=last, alert_at_us=last + self.wait)
        self.next = None if last is None or alerted else last + self.wait
        self.last.update((last, alerted))


class AsOfJoin(InOrder):
    """(key, seq, ts, version_ts, version_value) for left rows, once the watermark has passed them.

    Input rows carry side 0 (version) or 1 (left) besides seq, ts and value. Rows of both sides are
    folded as one sequence, so that of all passed versions only the newest is kept.
    """

    INPUT = ("seq", "at", "value", "side")
    WAITING = "at long, seq long, value double, side long"
    OUTPUT = "seq bigint, ts_us bigint, version_ts_us bigint, version_value double"

    def __init__(self, keep_misses: bool = False):
        self.keep_misses = keep_misses

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.version = handle.getValueState("version", "at long, value double")

    def fold(self, key, rows, passed) -> Iterator[Row]:
        since, held = self.version.get() or (None, None)
        for at, seq, value, side in sorted(rows, key=lambda r: (r[0], r[3], r[1])):
            if side == 0:
                since, held = at, value
            elif since is not None or self.keep_misses:
                yield self.row(key, seq=seq, ts_us=at, version_ts_us=since, version_value=held)
        if since is not None:
            self.version.update((since, held))
