"""What a timer touches: the processors against a state store made of dictionaries that counts."""

import random
from types import SimpleNamespace

import pytest

from millrace.streaming import keyed_state as state


class Values:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Maps:
    def __init__(self):
        self.held, self.read = {}, 0

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        value = self.held[key]
        self.read += len(value[0]) if isinstance(value[0], list) else 1
        return value

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]


class Lists(Values):
    def put(self, values):
        self.held = values


class Handle:
    def __init__(self):
        self.timers, self.states = set(), {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Values())

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, Maps())

    def getListState(self, name, schema):
        return self.states.setdefault(name, Lists())

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Key:
    """One key of a stream: batches of rows, and a watermark that moves after each."""

    def __init__(self, processor, width):
        self.processor, self.handle, self.out, self.touched = processor, Handle(), [], []
        processor.width = width
        processor.init(self.handle)

    def feed(self, rows, watermark):
        rows = [dict(zip(("at", *self.processor.INPUT[:1], *self.processor.INPUT[2:]), r, strict=True)) for r in rows]
        self.out += list(self.processor.handleInputRows(("k",), iter(rows), None))
        while fired := sorted(t for t in self.handle.timers if t <= watermark // 1000):
            self.handle.timers.remove(fired[0])
            waiting = self.handle.states["waiting"]
            before = waiting.read
            times = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark // 1000)
            self.out += list(self.processor.handleExpiredTimer(("k",), times, SimpleNamespace(getExpiryTimeInMs=lambda: fired[0])))
            self.touched.append(waiting.read - before)


HOUR = 3_600_000_000


def test_a_timer_reads_one_bucket():
    key = Key(state.RunningCount(), HOUR)
    rows = [(i * HOUR // 60, i, 0.0) for i in range(60 * 100)]  # a hundred hours, a row a minute
    random.Random(1).shuffle(rows)
    key.feed(rows, 0)
    for hour in range(1, 102):
        key.feed([], hour * HOUR)
    assert [r["running"] for r in key.out] == list(range(1, 6001)) and [r["seq"] for r in key.out] == list(range(6000))
    assert max(key.touched) <= 60 and sum(key.touched) <= 2 * 6000
    assert not key.handle.timers and not key.handle.states["waiting"].held


@pytest.mark.parametrize("make", [lambda: state.SustainedRise(4000), lambda: state.Inactivity(5000), lambda: state.JumpAlert(3.0), lambda: state.RateBlacklist(3, 8)])
@pytest.mark.parametrize("seed", range(8))
def test_buckets_change_nothing(make, seed):
    """Small buckets, large buckets and one feed at the end of time give the same rows."""
    rng = random.Random(seed)
    rows = sorted({rng.randrange(0, 40 * HOUR) for _ in range(120)})
    rows = [(at, i, rng.choice([None, 1.0, 2.0, 5.0, 9.0])) for i, at in enumerate(rows)]
    found = []
    for width, batches in ((HOUR, 7), (100 * HOUR, 5), (HOUR // 7, 1)):
        key = Key(make(), width)
        for b in range(batches):
            share = rows[b * len(rows) // batches : (b + 1) * len(rows) // batches]
            rng.shuffle(share)
            key.feed(share, max(0, min(r[0] for r in share) - HOUR))
        key.feed([], 60 * HOUR)
        assert not any(r["late_seq"] for r in key.out)
        found.append([tuple(r[c] for c in sorted(r.asDict())) for r in key.out])
    assert found[0] == found[1] == found[2] and found[0]


def test_counts_in_a_map():
    key = Key(state.MapCounts(), HOUR)
    key.feed([(5, 1, "a"), (3, 2, "b"), (9, 3, "a"), (None, 4, "a")], 0)
    assert [r["late_seq"] for r in key.out] == [4]
    key.feed([(HOUR, 5, "b"), (2 * HOUR, 6, "a"), (HOUR, 8, None)], HOUR // 2)
    key.feed([(1, 7, "a")], 9 * HOUR)
    assert [(r["kind"], r["n"]) for r in key.out if r["kind"]] == [("b", 1), ("a", 2), ("b", 2), ("a", 3)]
    assert [r["late_seq"] for r in key.out if r["late_seq"]] == [4, 7]
    assert key.handle.states["counts"].held == {("a",): (3,), ("b",): (2,), (None,): (1,)}


def test_signed_rows_of_a_key():
    key = Key(state.Retract(), HOUR)
    changes = [(1, 1, "a"), (2, 2, "a"), (3, 3, "b"), (4, 4, None), (5, 5, None), (6, 6, "c")]
    key.feed(changes[3:] + changes[:3], 0)
    key.feed([], HOUR)
    signed = [(r["flag"], r["kind"], r["seq"]) for r in key.out]
    assert signed == [("+", "a", 1), ("-", "a", 3), ("+", "b", 3), ("-", "b", 4), ("+", "c", 6)]
    key.feed([(2 * HOUR, 7, None)], 3 * HOUR)
    assert (key.out[-1]["flag"], key.out[-1]["kind"]) == ("-", "c") and not key.handle.states["shown"].exists()


class Counted:
    """Counts the calls of each method of a state."""

    def __init__(self, state, calls):
        self.state, self.calls = state, calls

    def __getattr__(self, name):
        self.calls.append(name)
        return getattr(self.state, name)


@pytest.mark.parametrize("make", [state.RunningCount, state.MapCounts, state.AsOfJoin, lambda: state.SustainedRise(4000), lambda: state.Inactivity(5000), lambda: state.CountWindowAvg(2)])
def test_a_key_of_few_rows_costs_few_calls(make):
    """Twenty buckets of three rows, folded at once: calls of the state do not grow with the buckets."""
    key, calls = Key(make(), HOUR), []
    key.processor.waiting, key.processor.clock = Counted(key.processor.waiting, calls), Counted(key.processor.clock, calls)
    register = key.handle.registerTimer
    key.handle.registerTimer = lambda at: (calls.append("registerTimer"), register(at))
    rest = () if len(key.processor.INPUT) == 3 else (1,)
    rows = [(i * HOUR // 3, i, "a" if isinstance(key.processor, state.MapCounts) else float(i), *rest) for i in range(60)]
    random.Random(2).shuffle(rows)
    key.feed(rows, 0)
    key.feed([], 100 * HOUR)
    assert len(key.touched) <= 2 and len(calls) <= 13 and not key.handle.states["waiting"].held


@pytest.mark.parametrize("few,many", [(60, 100_000), (3, 7), (1, 1)])
def test_rows_in_many_batches(monkeypatch, few, many):
    """Rows that come one by one for the same bucket share entries, and are folded in order in any number of rounds."""
    monkeypatch.setattr(state, "FEW", few)
    monkeypatch.setattr(state, "MANY", many)
    key = Key(state.RunningCount(), 10 * HOUR)
    rows = [(i // 2 * HOUR // 4, i, 0.0) for i in range(200)]
    random.Random(3).shuffle(rows)
    for at in range(0, 100):
        key.feed(rows[at : at + 1], 0)
    assert len(key.handle.states["waiting"].held) <= 2 * 100 / few + 1
    key.feed(rows[100:], 13 * HOUR)
    assert {r["seq"] for r in key.out} == set(range(104))  # two rows each quarter of an hour before the 13th hour
    key.feed([], 100 * HOUR)
    assert [(r["seq"], r["running"]) for r in key.out] == [(i, i + 1) for i in range(200)]
    assert not key.handle.timers and not key.handle.states["waiting"].held
