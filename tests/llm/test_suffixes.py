"""Repeated strings of bytes (12) against brute force, with small sizes, hot landmarks and odd rows."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import queries, suffixes
from millrace.sources.tables import load

from .conftest import SCHEMA, prose


def brute(docs, size):
    texts = [(i, (t or "").encode()) for i, t in docs]
    times = {}
    for _, t in texts:
        for p in range(len(t) - size + 1):
            times[t[p : p + size]] = times.get(t[p : p + size], 0) + 1
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - size + 1):
            if times[t[p : p + size]] > 1:
                gone[p : p + size] = b"\x01" * size
        spans = sum(1 for p in range(len(t)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.drop("spans").collect()), key=repr)


def test_query_equals_brute_force(spark, sf):
    docs = [tuple(r) for r in load(spark, sf, "documents").select("doc_id", "text").collect()]
    expected = brute(docs, 400)
    assert rows(queries.QUERIES["op12_suffix_dedup"](spark, sf)) == expected
    assert sum(r[2] for r in expected) > 0


def test_sorted_columns_equal_brute_force():
    rng = np.random.default_rng(2)
    for rows_, columns, size, letters in [(40, 30, 5, 2), (200, 24, 8, 2), (3, 9, 9, 1), (1, 10, 4, 3), (300, 40, 12, 3)]:
        symbols = rng.integers(0, letters, (columns, rows_)).astype(np.uint8)
        symbols[:, rows_ // 2 :] = symbols[:, : rows_ - rows_ // 2]
        for r in range(rows_):
            symbols[: rng.integers(0, 4), r] = 255
            symbols[columns - rng.integers(0, 4) :, r] = 255
        found = suffixes.repeated_starts(symbols, size)
        for c in range(columns - size + 1):
            own = [bytes(symbols[c : c + size, r]) for r in range(rows_)]
            assert [bool(f) for f in found[c]] == [255 not in w and own.count(w) > 1 for w in own]


def made(n, seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("ab \n") for _ in range(rng.randrange(10, 90))) for _ in range(6)]
    out = []
    for i in range(n):
        own = [rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh é汉") for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(6))]
        out.append((i, "".join(own)))
    return out


@pytest.mark.parametrize("hot,batch,part", [(4096, 4096, 1 << 20), (3, 8, 100), (0, 50, 64)])
def test_small_strings(spark, monkeypatch, hot, batch, part):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "BATCH", batch)
    monkeypatch.setattr(suffixes, "PART", part)
    monkeypatch.setattr(suffixes, "REMEMBERED", 5 if hot == 3 else 1000)
    docs = made(250, 4) + [(300 + i, prose(30, 5) + f" end {i}") for i in range(60)] + [(400, "a" * 500), (401, "ab" * 300), (402, "a" * 30)]
    docs += [(500, None), (501, ""), (None, prose(20, 8)), (502, "no copy of this one"), (1, prose(25, 9)), (1, prose(25, 9)), (None, None)]
    frame = spark.createDataFrame([(i, t, None, "s", 1, 2, "c") for i, t in docs], SCHEMA).repartition(6)
    assert rows(suffixes.remove_repeats(frame, 24, 8)) == brute(docs, 24)


def test_odd_rows(odd, odd_rows):
    got = suffixes.remove_repeats(odd)
    assert rows(got) == brute([(i, t) for i, t, *_ in odd_rows], 400)
    spans = {r["n_removed"] - sum(s["stop"] - s["start"] for s in r["spans"]) for r in got.collect()}
    assert spans == {0}


def test_empty(none):
    assert suffixes.remove_repeats(none).count() == 0
