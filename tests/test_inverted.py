"""The inverted index: scores against a plain computation, fuzzy terms against all distances, and what is read."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import inverted
from millrace.operators.inverted import Index, distance
from millrace.session import scratch_path


def texts(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    out = []
    for i in range(n):
        own = [words[min(39, int(rng.expovariate(0.2)))] for _ in range(rng.randrange(30))]
        out.append((i, " ".join(own) if own or i % 2 else None))
    return out


@pytest.fixture(scope="module")
def index(spark):
    docs = texts(400) + [(1000 + i, "w0 w1 w39") for i in range(5)] + [(2000, "W0,w0;über 汉字")]
    frame = spark.createDataFrame(docs, "id bigint, text string")
    return docs, Index(spark, scratch_path(spark, "t-inverted"), "id", 8).build(frame, "text", fuzzy=True)


def cut(text):
    return [t for t in (text or "").lower().replace(",", " ").replace(";", " ").replace("汉字", "汉 字").split() if t]


def brute(docs, query, k):
    own = {i: Counter(cut(t)) for i, t in docs if cut(t)}
    lengths = {i: sum(c.values()) for i, c in own.items()}
    average = sum(lengths.values()) / len(own)
    scores = Counter()
    for token in set(cut(query)):
        df = sum(token in c for c in own.values())
        for i, c in own.items():
            if c[token]:
                scores[i] += math.log(1 + (len(own) - df + 0.5) / (df + 0.5)) * c[token] / (c[token] + 1.2 * (0.25 + 0.75 * lengths[i] / average))
    return sorted(((i, round(s, 6)) for i, s in scores.items()), key=lambda r: (-r[1], r[0]))[:k]


@pytest.mark.parametrize("query", ["w0 w1", "w0 w39 w38 w1", "W5", "nothing", "w39 nothing w0 w2 w3", "汉 ÜBER w0", ""])
@pytest.mark.parametrize("k", [1, 7, 5000])
def test_scores_equal_brute_force(index, query, k):
    docs, built = index
    assert [tuple(r) for r in built.search(query, k).collect()] == brute(docs, query, k)


def test_a_query_reads_its_tokens_only(index):
    _, built = index
    rows = built._of("postings", "token", ["w3"])
    assert {r["token"] for r in rows.collect()} == {"w3"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "In(token" in plan or "EqualTo(token,w3)" in plan
    assert rows.inputFiles()  # of one bucket
    files = {f.split("bucket=")[1].split("/")[0] for f in rows.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert len(files) == 1


def test_distances():
    assert [distance(a, b) for a, b in [("ring", "rnig"), ("ring", "rign"), ("abc", ""), ("ca", "abc"), ("same", "same"), ("ab", "ba")]] == [1, 1, 3, 3, 0, 1]


def test_fuzzy_terms_equal_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = {"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(400)} | {"x" * 23 + "ab", "x" * 30, "汉字"[:1]}
    docs = [(i, " ".join(rng.sample(sorted(vocabulary), 5))) for i in range(200)] + [(500, "x" * 23 + "ba")]
    built = Index(spark, scratch_path(spark, "t-fuzzy"), "id", 4).build(spark.createDataFrame(docs, "id bigint, text string"), "text", fuzzy=True)
    known = {t for _, text in docs for t in text.split()}
    for term in ("abca", "a", "dcba", "x" * 23 + "ab", "zzzz", "bcdabcda"):
        for d in (0, 1, 2):
            expected = {(t, distance(term, t)) for t in known if distance(term, t) <= d}
            assert {tuple(r) for r in built.like(term, d).collect()} == expected
            found = {t for t, _ in expected}
            assert sorted(r["id"] for r in built.documents_like(term, d).collect()) == sorted(i for i, text in docs if found & set(text.split()))
    monkeypatch.setattr(inverted, "MOST_TOKENS", 1)
    assert built.documents_like("abca", 2).count() > 1


def test_texts_are_cut_once(spark, monkeypatch):
    """However often its parts are used, an index cuts each text into tokens once; texts without any leave no trace."""
    cuts = spark.sparkContext.accumulator(0)

    def counted(c):
        def cut(text):
            cuts.add(1)
            return (text or "").split()

        return F.udf(cut, "array<string>")(c)

    monkeypatch.setattr(inverted, "tokens", counted)
    docs = spark.createDataFrame([(i, f"a b{i} a") for i in range(30)] + [(40, ""), (41, None)], "id bigint, text string")
    built = Index(spark, scratch_path(spark, "t-once"), "id", 4).build(docs, "text")
    assert cuts.value == 32 and built.totals() == (30, 3.0)
    rows = built._of("postings", "token", ["a"]).select("id", "freq", "length")
    assert {tuple(r) for r in rows.collect()} == {(i, 2, 3) for i in range(30)}
