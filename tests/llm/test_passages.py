"""Benchmark passages (1), repeated windows (4) and similar documents (5) against brute force."""

import hashlib
import itertools
import re

import pytest

from millrace.llm import decontam, ngram_join, substrings

from .conftest import SCHEMA, prose


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def items_frame(spark):
    items = [(1, prose(30)), (1, "one two"), (2, "ONE"), (3, None), (4, ""), (None, "word"), (10, prose(8, 5)), (11, prose(119_990, 3)[-400:])]
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string"), items


def test_contamination_equals_brute_force(spark, odd, odd_rows):
    frame, items = items_frame(spark)
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    windows = {}
    for item, text in items:
        own = cut(text)
        for i in range(max(1, len(own) - 9)):
            if own and item is not None:
                windows.setdefault(tuple(own[i : i + 10]), set()).add(str(item))
    expected = []
    for doc, text, *_ in odd_rows:
        own = cut(text)
        hit, met = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if (w := tuple(own[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    met |= windows[w]
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        expected.append((doc, len(own), len(hit), len(met), digest, bool(hit)))
    got = decontam.contamination(odd, frame)
    assert rows(got, *got.columns) == sorted(expected, key=repr)
    clean = decontam.without_contaminated(odd, frame)
    assert clean.columns == odd.columns
    assert clean.count() == sum(not e[-1] for e in expected)


def test_contamination_with_full_bit_maps(spark, odd, monkeypatch):
    """If the bit maps let every place pass and nothing is broadcast, the joins alone give the same rows."""
    frame, _ = items_frame(spark)
    whole = rows(decontam.contamination(odd, frame), "doc_id", "n_hit", "items_sha256")
    monkeypatch.setattr(decontam, "_among", lambda hashes, bit_map: hashes == hashes)
    monkeypatch.setattr(decontam, "broadcast_if_small", lambda df: df)
    assert rows(decontam.contamination(odd, frame), "doc_id", "n_hit", "items_sha256") == whole


def test_contamination_by_a_window_of_many_items(spark):
    """A window that 400 items share, in 300 copies and 100 other texts; columns named as the operator's own."""
    shared = prose(10, 4)
    items = spark.createDataFrame([(i, shared if i % 2 else f"{shared} tail{i}", i, "x") for i in range(400)], "item_id int, text string, window int, key string")
    texts = [(i, f"{prose(50, 2)} {shared} end") for i in range(300)] + [(300 + i, f"own{i} {shared} {shared}") for i in range(100)] + [(400, prose(9, 4))]
    docs = spark.createDataFrame([(i, t, "d", 1, i) for i, t in texts], "doc_id int, text string, digest string, n_hit int, windows int")
    ids = sorted(str(i) for i in range(400))
    digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
    got = {r["doc_id"]: r for r in decontam.contamination(docs, items).collect()}
    assert len(got) == 401
    assert all((got[i]["n_hit"], got[i]["n_items"], got[i]["items_sha256"]) == (10, 400, digest) for i in range(300))
    assert all((got[300 + i]["n_hit"], got[300 + i]["n_items"]) == (20, 400) for i in range(100))
    assert (got[400]["n_hit"], got[400]["contaminated"]) == (0, False)
    assert [tuple(r) for r in decontam.without_contaminated(docs, items).collect()] == [(400, prose(9, 4), "d", 1, 400)]
    spans = decontam.find_passages(docs.where("doc_id in (0, 300)"), items).select("doc_id", "spans").collect()
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in spans} == {0: [(50, 60)], 300: [(1, 21)]}


def test_empty_tables(spark, none, odd):
    no_items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.contamination(none, no_items).count() == 0
    assert decontam.contamination(odd, no_items).where("contaminated").count() == 0
    assert substrings.remove_repeats(none).count() == 0
    assert ngram_join.near_duplicates(none).count() == 0


def test_repeats_equal_brute_force(odd, odd_rows):
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    first = {}
    for doc, text, *_ in odd_rows:
        own = cut(text)
        for i in range(len(own) - 49) if doc is not None else ():
            w = hash(tuple(own[i : i + 50]))
            first[w] = min(first.get(w, doc), doc)
    expected = []
    for doc, text, *_ in odd_rows:
        own = cut(text)
        gone = set()
        for i in range(len(own) - 49) if doc is not None else ():
            if first[hash(tuple(own[i : i + 50]))] < doc:
                gone.update(range(i, i + 50))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        expected.append((doc, len(own), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    got = substrings.remove_repeats(odd)
    assert rows(got, *got.columns) == sorted(expected, key=repr)


def test_hot_passage(spark):
    docs = [(i, prose(10, i) + " " + prose(60, 99) + " " + prose(10, i + 1)) for i in range(300)] + [(300 + i, prose(80, 7)) for i in range(300)]
    got = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(9))
    removed = {r["doc_id"]: r["n_removed"] for r in got.collect()}
    assert removed[0] == 0 and removed[300] == 0
    assert all(removed[i] >= 60 for i in range(1, 300)) and all(removed[300 + i] == 80 for i in range(1, 300))


def shingles(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def brute_components(docs):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = set()
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            links.add((a, b))
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in sets}, links, sets


def edited(n, i, places):
    own = prose(n, 1).split()
    for p in range(places):
        own[(i * 37 + p * 53) % n] = f"edit{i}x{p}"
    return " ".join(own)


@pytest.mark.parametrize("cap", [255, 3])
def test_similar_documents_equal_brute_force(spark, odd_rows, monkeypatch, cap):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "LENGTH_CAP", cap)
    docs = [(100 + i, edited(150 + i % 7, i, i % 6)) for i in range(90)]
    docs += [(300 + i, prose(40, i % 5) + f" tail{i % 9}") for i in range(40)]
    docs += [(i, t) for i, t, *_ in odd_rows if i not in (None, 2, 8)]
    frame = spark.createDataFrame([(i, t, None, None, None, 3, "c") for i, t in docs], SCHEMA).repartition(7)
    expected, links, sets = brute_components(docs)
    got = {r["doc_id"]: r for r in ngram_join.near_duplicates(frame).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == expected
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    documents, pairs = ngram_join.similar(frame, all_pairs=True)
    classes = {r["doc_id"]: r["class_id"] for r in documents.collect()}
    assert {tuple(r) for r in pairs.collect()} == {(a, b) for a, b in links if classes[a] == a and classes[b] == b and sets[a] != sets[b]}


def test_rows_that_share_an_id_or_have_none(odd):
    got = rows(ngram_join.near_duplicates(odd), "doc_id", "component_id")
    assert [r for r in got if r[0] in (1, 2, 12)] == [(1, 1), (12, 1), (2, 1), (2, 1)]
    assert (7, 6) in got and (3, 3) in got and (11, 11) in got
    assert [r for r in got if r[0] is None] == [(None, 1), (None, None)]


def test_repeated_rows_in_several_partitions(spark):
    base = prose(100, 1).split()
    first, second, third = base, base[:60] + prose(40, 50).split(), prose(50, 77).split()
    docs = [(1, " ".join(first)), (2, " ".join(second)), (3, " ".join(third)), (3, " ".join(first[:50]))]
    both = len(shingles(docs[0][1]) & shingles(docs[1][1])) / len(shingles(docs[0][1]) | shingles(docs[1][1]))
    assert 0.35 < both < 0.45
    # id 5 has a copy of the third text and one of its own, and is linked by each row for itself
    docs += [(5, docs[2][1] + " more"), (5, prose(60, 31))]
    frame = spark.createDataFrame(docs * 4, "doc_id bigint, text string").repartition(8)
    got = rows(ngram_join.near_duplicates(frame), "doc_id", "n_shingles", "component_id")
    components = [1, 2, 3, 3, 3, 5]
    assert got == sorted(((i, len(shingles(t)), c) for (i, t), c in zip(docs, components, strict=True) for _ in range(4)), key=repr)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([((i * 7919) % 1009, ((i + 1) * 7919) % 1009) for i in range(1008)], "a bigint, b bigint")
    assert {r["component"] for r in ngram_join.components(links).collect()} == {0}


def thue_morse(letters):
    """Words of 2,048 letters with all letters swapped, which sums modulo 2**64 cannot tell apart."""
    out = letters[0]
    while len(out) < 2048:
        out += out.translate(str.maketrans(letters, letters[::-1]))
    return out


def test_words_that_beat_sums(spark):
    a, b = thue_morse("ab"), thue_morse("ba")
    rest = prose(49)
    docs = [(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, a), (4, b), (5, a), (6, f"{a} {rest} tail")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    removed = rows(substrings.remove_repeats(frame), "doc_id", "n_removed")
    assert removed == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 0), (6, 50)]
    components = rows(ngram_join.near_duplicates(frame), "doc_id", "component_id")
    assert components == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 3), (6, 1)]
    kept = ngram_join.without_near_duplicates(frame.where("doc_id in (3, 4, 5)"))
    assert rows(kept, "doc_id") == [(3,), (4,)]


def test_any_column_names(spark):
    text = prose(60)
    data = [(1, text, 8, "k", 1, 2, "c"), (2, text + " more", 9, "l", 3, 4, "d"), (None, text, 7, "m", 5, 6, "e"), (3, None, 6, None, 7, 8, "f")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, _id int, _key string, id int, key int, component string")
    got = ngram_join.without_near_duplicates(docs)
    assert got.dtypes == docs.dtypes
    assert rows(got, *docs.columns) == sorted([data[0], data[3]], key=repr)
