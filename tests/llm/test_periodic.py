"""Runs (13) against brute force: the registered query, odd rows, and words that beat weak hashes."""

import hashlib
import random
import re
import zlib

import numpy as np

from millrace.llm import periodic, queries
from millrace.sources.tables import load


def brute(words):
    """(start, length, period) of all runs, period by period."""
    names = {}
    ids = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    out = []
    for q in range(1, len(ids) // 3 + 1):
        agree = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        edges = np.flatnonzero(agree[1:] != agree[:-1])
        for s, e in zip(edges[::2], edges[1::2] + q, strict=True):
            smaller = any(np.array_equal(ids[s : e - d], ids[s + d : e]) for d in range(1, q)) if e - s >= max(24, 3 * q) else True
            if not smaller:
                out.append((int(s), int(e - s), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def report(doc, words):
    runs = brute(words)
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(kept))


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def changed(doc, words):
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text").collect()
    expected = sorted((report(d, changed(d, cut(t))) for d, t in docs), key=repr)
    assert rows(queries.QUERIES["op13_periodic_runs"](spark, sf)) == expected
    assert sum(r[1] for r in expected) > 10


def texts():
    rng = random.Random(7)
    out = []
    for _ in range(120):
        own = [f"w{rng.randrange(rng.choice([1, 2, 60]))}" for _ in range(rng.randrange(200))]
        for _ in range(rng.randrange(4)):
            base = [f"w{rng.randrange(9)}" for _ in range(rng.randrange(1, 45))]
            at = rng.randrange(len(own) + 1)
            own[at:at] = (base * 200)[: rng.randrange(10, 220)]
        out.append(" ".join(own))
    thue = [0]
    for _ in range(13):
        thue += [1 - x for x in thue]
    out += [" ".join("ab"[x] for x in thue), "x " * 3000, "a b " * 2000 + "a " * 500]
    # a period of 2,048 words, and a near period whose halves only weak hashes take for equal
    half, other = thue[:2048], thue[2048:4096]
    out.append(" ".join("ab"[x] for x in (half + other) * 3))
    out.append(" ".join("ab"[x] for x in half + other + half))
    long_a, long_b = ("".join("ab"[x] for x in t) for t in (half, other))
    out.append(" ".join([long_a, long_b] * 20 + [long_a] * 30))
    return out


def test_all_kinds_of_texts(spark):
    docs = list(enumerate(texts())) + [(None, "a b c " * 10), (5, None), (5, ""), (5, " \n\t"), (6, "é 汉字 " * 12), (6, "é 汉字 " * 12), (7, "a\x0bb\x0c" * 20), (8, "a\x85b\x1cc" * 30)]
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id bigint, text string, row string, runs int, text_2 int").repartition(4)
    expected = sorted((report(d, cut(t)) for d, t in docs), key=repr)
    assert rows(periodic.report(periodic.find_runs(frame, with_text=False))) == expected
    full = periodic.find_runs(frame)
    assert rows(periodic.report(full)) == expected
    kept = {(r["doc_id"], hashlib.sha256(r["collapsed"].encode()).hexdigest()) for r in full.collect()}
    assert kept == {(r[0], r[-1]) for r in expected}


def test_tiles_of_a_long_run_are_stitched(spark, monkeypatch):
    monkeypatch.setattr(periodic, "PAIRS", 64)
    words = [f"w{i}" for i in range(300)] * 9
    found = np.arange(len(words)) % 300
    parts = list(periodic.fragments(found.astype(np.int32), np.array([0]), np.array([len(words)])))
    assert len(parts) > 5 and all(stop - start < len(words) for _, _, start, stop in parts)
    frame = spark.createDataFrame([(0, p, s, e) for _, p, s, e in parts], "row bigint, period bigint, start bigint, stop bigint")
    assert rows(periodic.stitched(frame)) == [(0, 300, 0, len(words))]


def test_empty(none):
    assert periodic.find_runs(none).count() == 0
    assert periodic.report(periodic.find_runs(none, with_text=False)).count() == 0
