"""The pipeline stage by stage, each on what the one before kept."""

import re

import corpus_pipeline
from millrace.llm import bpe, secrets
from millrace.sources.tables import load

from .conftest import prose
from .test_passages import brute_components, fold


def test_stages_on_the_smallest_tables(spark, sf):
    from tokenizers import Tokenizer

    docs = load(spark, sf, "documents")
    names = docs.columns
    (_, first), (_, second), (_, third), (_, fourth), (_, fifth) = corpus_pipeline.STAGES

    good = first(spark, docs, sf)
    assert good.columns == names
    kept = {r["doc_id"] for r in good.collect()}
    marks = load(spark, sf, "labels").collect()
    assert sum(r["doc_id"] in kept for r in marks if r["quality"] == 1) >= 0.95 * sum(r["quality"] == 1 for r in marks)

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    components, _, _ = brute_components(rows)
    single = second(spark, good, sf)
    assert single.columns == names
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(components.values()))

    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(r["text"])) for r in load(spark, sf, "benchmark").collect()]
    windows = {" " + " ".join(w[i : i + 10]) + " " for w in items for i in range(max(1, len(w) - 9)) if w}
    padded = {r["doc_id"]: " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(r["text"]))) + " " for r in single.collect()}
    clean = third(spark, single, sf)
    assert clean.columns == names
    assert {r["doc_id"] for r in clean.collect()} == {i for i, t in padded.items() if not any(w in t for w in windows)}

    masked = fourth(spark, clean, sf)
    assert masked.columns == names and masked.dtypes == docs.dtypes
    assert masked.count() == clean.count() and secrets.scan(masked).where("spans <> ''").count() == 0
    assert all(r["n_chars"] == len(r["text"]) for r in masked.collect())

    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    library = Tokenizer.from_file(bpe.VOCABULARY)
    last = fifth(spark, masked, sf).collect()
    assert {r["doc_id"]: r["ids"] for r in last} == {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    assert sorted(map(repr, corpus_pipeline.run(spark, sf).collect())) == sorted(map(repr, last))


def test_stages_on_odd_and_empty_rows(spark, sf, odd, none):
    for frame in (odd, none):
        docs = frame.drop("bucket", "component")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf)
            if i < 4:
                assert out.dtypes == docs.dtypes
                docs = out
        assert out.count() == docs.count()


def test_one_row_of_each_component_stays(spark, sf):
    a, b, alone = prose(80), prose(70, 9), prose(60, 31)
    rows = [(1, a, "s")] * 5 + [(1, a.upper(), "s"), (2, a + " more", "s"), (None, a, "s")]  # repeats, near copy, no id
    rows += [(3, b + " end", "s"), (7, b, "s"), (7, alone, "s")]  # of id 7, one row is a copy
    rows += [(None, prose(50, 77), "t"), (None, prose(50, 77), "s"), (4, None, "s"), (4, None, "s"), (5, "", "s"), (None, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(6)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    kept = [(1, a.upper(), "s"), (3, b + " end", "s"), (7, alone, "s"), (None, prose(50, 77), "s"), *rows[-4:]]
    assert got.dtypes == docs.dtypes
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(kept, key=repr)
