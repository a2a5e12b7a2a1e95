"""Exact Jaccard self-join of documents on word shingles, as a T-occurrence search.

Two documents of n and m shingles link when their sets overlap in at least T(n, m) shingles, the
least number that makes the similarity reach the threshold. DivideSkip counts occurrences in the
short inverted lists only, and probes the long ones for the candidates found there:

1. Spark counts in how many documents each shingle occurs (packed hashes, by bucket) and gives each
   document those shingles that others have too, in the order of their list lengths. A shingle of
   one document is a list without partner.
2. Equal sets are one class, known by a key of 64 digest bits wherever its copies lie, and named by its
   smallest document. Among n sets two keys are expected to meet n * n / 2**65 times.
3. With T(n) the least overlap that any partner of a document may have, its n - T(n) + 1 shortest
   lists must contain every partner at least once; the T(n) - 1 longest are put aside. The short
   lists are merged: within a list, records are heap-merged in the order of their sizes, and pairs
   pass whose sizes and list positions still allow the required overlap.
4. Candidates are verified: the remaining, long lists are probed by binary search for the partner.
5. Links give components. A list of one component needs no further pairs. First each record meets
   its next neighbours in a list, then components are formed, and only records of different
   components meet in full. Lists beyond `BLOCK` records are dealt as pairs of blocks, so that no
   task ever holds a whole hot list. No link between different components is lost.

Null, empty and blank texts have no shingles and link with nothing. Every row is judged by its own text: rows
that share an id belong to the class of their text each, and a component is named by its smallest id.
Rows without id come after all ids: they belong to the component of their text, which has no name (null) if
no row with an id is in it. `similar` leaves them out, as its links are pairs of ids. Columns other than
the id and the text play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import packed, words
from millrace.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
PERCENT = 80
#: List lengths count up to here; lists beyond are all "long" and ordered by their shingle's hash.
LENGTH_CAP = 255
#: Records of one list that one task takes together.
BLOCK = 512
#: Groups that share the records of one bucket's very long lists.
PARTS = 16
#: So many next records of its block does a record meet, round by round, before it meets them all.
NEAR = (2, 8)

#: Bits of the parity sketch that a record takes along.
SKETCH = 512

#: Stands for a missing id, in the order of ids.
NO_ID = (1 << 63) - 1

_SENT = "bucket int, doc_id bigint, steps binary, runs binary, hashes binary"
_KNOWN = "doc_id bigint, hashes binary, lengths binary"
_RECORD = "doc_id bigint, n bigint, short int, hashes binary, class_id bigint"
_POSTING = "shingle bigint, n bigint, doc_id bigint, after bigint, shared bigint, sketch binary"
_VERIFIED = "a bigint, b bigint, id_a bigint, id_b bigint"
_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in ddl.split(", ")])


def _batch(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def least_overlap(n: int, m: int, percent: int) -> int:
    """The smallest overlap x with 100 x >= percent (n + m - x)."""
    return -(-percent * (n + m) // (100 + percent))


def _least_any(n, percent: int):
    """The smallest overlap with any partner: of a partner as small as the threshold allows."""
    return -(-percent * n // 100)


def _sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, counts = words.hashed_words(texts)
    shingles = words.window_hashes(hashes, size)
    at = 0
    for count in counts:
        if count >= size:
            yield np.unique(shingles[at : at + count - size + 1])
        else:
            yield words.sequence_hash(hashes[at : at + count]) if count else np.zeros(0, np.uint64)
        at += count


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    rows = (
        (doc, text.lower())  # of bytes, this changes A-Z only
        for batch in batches
        for doc, text in zip(batch.column(0).to_pylist(), words.utf8(batch.column(1)), strict=True)
    )
    return words.in_chunks(rows, 1)


def _key(own: np.ndarray) -> int | None:
    """The key of a set's class; an empty set has none."""
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True) if len(own) else None


def _digests(size: int):
    schema = _schema("doc_id bigint, n bigint, key bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _folded(batches):
            sets = _sets([t for _, t in chunk], size)
            yield _batch([(doc, len(own), _key(own)) for (doc, _), own in zip(chunk, sets, strict=True)], schema)

    return run


def _keyed(size: int, text_at: int):
    """Rows (row, id) with the class key of the row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((t.lower(),) for t in words.utf8(batch.column(0).field(text_at)))
            keys = [_key(own) for chunk in words.in_chunks(texts, 0) for own in _sets([t for (t,) in chunk], size)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=["row", "id", "key"])

    return run


def _emit(size: int, bits: int):
    """Shingles of the chunk's classes; from here on, doc_id is the key of a class."""
    schema = _schema(_SENT)

    def chunk_rows(chunk: list[tuple]) -> Iterator[tuple]:
        sets: dict[int, np.ndarray] = {}
        for own in _sets([r[1] for r in chunk], size):
            if len(own) and (key := _key(own)) not in sets:
                sets[key] = packed.cut(own, bits)
        if not sets:
            return
        ids = sorted(sets)
        hashes, docs = np.concatenate([sets[i] for i in ids]), np.repeat(np.array(ids, np.int64), [len(sets[i]) for i in ids])
        order = np.argsort(hashes, kind="stable")
        firsts = packed.runs_of(hashes[order])
        lengths = np.diff(np.append(firsts, len(order)))
        place = np.arange(len(order)) - np.repeat(firsts, lengths)
        # of a list of full length within the chunk the rest goes by document, past the bucket: its length is known
        send = np.ones(len(order), bool)
        send[order] = place < LENGTH_CAP
        for bucket, steps, runs, digests in packed.by_bucket(docs[send], hashes[send], bits):
            yield bucket, None, steps, runs, digests
        docs, hashes = docs[~send], hashes[~send]
        for doc, at in packed.per_document(docs):
            for bucket, _, _, digests in packed.by_bucket(docs[at], hashes[at], bits):
                yield bucket, doc, None, None, digests

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _folded(batches):
            yield _batch(list(chunk_rows(chunk)), schema)

    return emit


def _list_lengths(bits: int):
    schema = _schema(_KNOWN)

    def count(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        rows, open_ = [], []
        for doc, steps, runs, own in zip(*(table[c].to_pylist() for c in ("doc_id", "steps", "runs", "hashes")), strict=True):
            if doc is None:
                open_.append((steps, runs, own))
            else:
                own = packed.unpack(own, bucket, bits)
                rows.append((doc, own.tobytes(), np.full(len(own), LENGTH_CAP, np.uint8).tobytes()))
        docs, hashes = packed.from_bucket(open_, bucket, bits)
        order = np.lexsort((docs, hashes))
        docs, hashes = docs[order], hashes[order]
        # every chunk that holds a copy has sent the class
        once = np.ones(len(docs), bool)
        once[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
        docs, hashes = docs[once], hashes[once]
        firsts = packed.runs_of(hashes)
        lengths = np.diff(np.append(firsts, len(hashes)))
        lengths = np.repeat(np.minimum(lengths, LENGTH_CAP), lengths).astype(np.uint8)
        shared = lengths > 1
        docs, hashes, lengths = docs[shared], hashes[shared], lengths[shared]
        for doc, at in packed.per_document(docs):
            rows.append((doc, hashes[at].tobytes(), lengths[at].tobytes()))
        return pa.Table.from_batches([_batch(rows, schema)])

    return count


def _records(percent: int):
    """Per class: its shared shingles by rising list length, and how many of them are short lists."""
    schema = _schema(_RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, n, parts, class_id in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                hashes = np.frombuffer(b"".join(p["hashes"] for p in parts), np.uint64)
                lengths = np.frombuffer(b"".join(p["lengths"] for p in parts), np.uint8)
                hashes, once = np.unique(hashes, return_index=True)  # every chunk that holds a copy may have sent it
                lengths = lengths[once]
                alone = n - len(hashes)  # these come first and have no partner
                short = n - _least_any(n, percent) + 1 - alone
                if short > 0:
                    order = np.lexsort((hashes, lengths))
                    out.append((doc, n, short, hashes[order].tobytes(), class_id))
            yield _batch(out, schema)

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A record's entries in its short lists: `after` shared shingles follow there, of `shared` in all.

    The sketch has a bit for each residue of hashes: whether an odd number of shared shingles has it.
    Two sketches differ in at most as many bits as their sets have shingles of one side only.
    """
    for batch in batches:
        for doc, n, short, hashes in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            own = np.frombuffer(hashes, np.uint64)
            k = min(short, len(own))
            residues = (words.mix(own) % np.uint64(SKETCH)).astype(np.int64)
            sketch = np.packbits(np.bincount(residues, minlength=SKETCH) & 1).tobytes()
            fixed = [np.full(k, n), np.full(k, doc), len(own) - 1 - np.arange(k), np.full(k, len(own))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[:k].view(np.int64)), *(pa.array(f, pa.int64()) for f in fixed), pa.array([sketch] * k, pa.binary())],
                names=[c.split()[0] for c in _POSTING.split(", ")],
            )


def _merge(percent: int, near: int):
    """Candidates of lists, or of pairs of blocks of a list, that come one after the other by size.

    A record is held against those that follow in its list: with near > 0 against so many, else
    against all whose size still allows the overlap.
    """
    schema = _schema("a bigint, b bigint")

    def pairs(cols: list[np.ndarray]) -> pa.RecordBatch:
        shingle, block, other, n, doc, after, shared, component, side, sketch = cols
        begins = np.ones(len(n), bool)
        begins[1:] = (shingle[1:] != shingle[:-1]) | (block[1:] != block[:-1]) | (other[1:] != other[:-1])
        group = np.cumsum(begins)
        first, found, step = np.arange(len(n)), [], 0
        while len(first) and (not near or step < near):
            step += 1
            first = first[first + step < len(n)]
            second = first + step
            open_ = (group[first] == group[second]) & (100 * n[first] >= percent * n[second])
            first, second = first[open_], second[open_]
            going = first
            new = component[first] != component[second]
            new &= (side[first] != side[second]) | (block[first] == other[first])
            least = least_overlap(n[first], n[second], percent)
            new &= 1 + np.minimum(after[first], after[second]) >= least
            first, second, least = first[new], second[new], least[new]
            apart = np.bitwise_count(sketch[first] ^ sketch[second]).sum(axis=1, dtype=np.int64)
            near_enough = apart <= shared[first] + shared[second] - 2 * least
            first_kept, second_kept = first[near_enough], second[near_enough]
            found.append(np.sort(np.stack([doc[first_kept], doc[second_kept]], axis=1), axis=1))
            first = going
        both = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(9)]
            sketches = np.frombuffer(b"".join(batch.column(9).to_pylist()), np.uint64)
            cols.append(sketches.reshape(-1, SKETCH // 64))
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            last = cols[0] == cols[0][-1]  # the list at the end may go on in the next batch
            cut = int(np.argmax(last & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])))
            if cut:
                yield pairs([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None:
            yield pairs(held)

    return run


def _verify(percent: int):
    schema = _schema(_VERIFIED)

    def probe(short: np.ndarray, long: np.ndarray) -> int:
        """How many of the fewer shingles stand in the longer list, by binary search."""
        at = np.searchsorted(long, short)
        at[at == len(long)] = 0
        return int(np.count_nonzero(long[at] == short)) if len(long) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, n, m, x, y, *ids in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                x, y = np.sort(np.frombuffer(x, np.uint64)), np.sort(np.frombuffer(y, np.uint64))
                if probe(*((x, y) if len(x) < len(y) else (y, x))) >= least_overlap(n, m, percent):
                    out.append((a, b, *ids))
            yield _batch(out, schema)

    return run


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component): the smallest document that links (a, b) reach, for every linked document.

    Each round every vertex moves to the smallest vertex around it, a chain of moves is followed one
    step further, and the links of merged vertices shrink to links between the new ones.
    """
    edges = cut_lineage(links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high").distinct())
    vertices = edges.select("low").union(edges.select("high")).distinct()
    labels = vertices.select(F.col("low").alias("doc_id"), F.col("low").alias("component"))
    while edges.limit(1).count():
        down = edges.groupBy(F.col("high").alias("vertex")).agg(F.min("low").alias("target"))
        further = down.select(F.col("vertex").alias("target"), F.col("target").alias("beyond"))
        moves = cut_lineage(down.join(further, "target", "left").select("vertex", F.coalesce("beyond", "target").alias("target")))

        def moved(df: DataFrame, column: str) -> DataFrame:
            onto = moves.select(F.col("vertex").alias(column), "target")
            return df.join(onto, column, "left").withColumn(column, F.coalesce("target", column)).drop("target")

        labels = cut_lineage(moved(labels, "component"))
        ends = moved(moved(edges, "high"), "low")
        ends = ends.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
        edges = cut_lineage(ends.where("low < high").distinct())
    return labels


def _candidates(lists: DataFrame, percent: int, near: int) -> DataFrame:
    """Candidate pairs of every list whose records do not all share a component."""
    size = lists.groupBy("shingle").agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = size.where("low <> high").select("shingle", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    dealt = lists.join(open_, "shingle").withColumn("block", F.expr(f"cast(pmod(xxhash64(doc_id, {near}), blocks) as int)"))
    if near:
        met = dealt.withColumns({"other": F.col("block"), "side": F.lit(0)})
    else:  # block i meets block j: the record goes to all pairs with its own block in it
        met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.withColumns({"other": F.greatest("block", "with"), "side": F.col("block")}).withColumn("block", F.least("block", "with"))
    rows = met.select("shingle", "block", "other", "n", "doc_id", "after", "shared", "component", "side", "sketch").repartition("shingle", "block", "other")
    ordered = rows.sortWithinPartitions("shingle", "block", "other", "n", "doc_id")
    return ordered.mapInArrow(_merge(percent, near), "a bigint, b bigint").distinct()


def _linked(texts: DataFrame, size: int, percent: int, all_pairs: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, links) of rows (doc_id, text).

    members: doc_id, n, key (of the row's class, null without shingles). classes: key, class_id, n. links:
    pairs (a, b) of vertices (class_id, key), whose order is that of the smallest documents.
    """
    bits = packed.bucket_bits(texts)
    members = cut_lineage(texts.mapInArrow(_digests(size), "doc_id bigint, n bigint, key bigint"))
    least = F.min(F.coalesce("doc_id", F.lit(NO_ID)))
    classes = members.where("n > 0").groupBy("key").agg(least.alias("class_id"), F.max("n").alias("n"))

    part = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + F.pmod("doc_id", F.lit(PARTS)))
    sent = texts.mapInArrow(_emit(size, bits), _SENT).withColumn("part", part)
    known = sent.groupBy("bucket", "part").applyInArrow(_list_lengths(bits), _KNOWN)
    shared = known.groupBy("doc_id").agg(F.collect_list(F.struct("hashes", "lengths")).alias("parts"))
    records = shared.join(classes.withColumnRenamed("key", "doc_id"), "doc_id").select("doc_id", "n", "parts", "class_id")
    records = cut_lineage(records.mapInArrow(_records(percent), _RECORD))
    lists = records.drop("class_id").mapInArrow(_postings, _POSTING)

    def verified(pairs: DataFrame) -> DataFrame:
        sets = records.select("doc_id", "n", "hashes", "class_id")
        left = pairs.join(sets.toDF("a", "n", "x", "id_a"), "a")
        whole = left.join(sets.toDF("b", "m", "y", "id_b"), "b").select("a", "b", "n", "m", "x", "y", "id_a", "id_b")
        vertex = lambda c: F.struct(F.col(f"id_{c}").alias("class_id"), F.col(c).alias("key")).alias(c)
        return whole.mapInArrow(_verify(percent), _VERIFIED).select(vertex("a"), vertex("b"))

    alone = lists.withColumn("component", F.col("doc_id"))
    if all_pairs:
        return members, classes, cut_lineage(verified(_candidates(alone, percent, 0)))
    links, grouped = None, alone
    for near in (*NEAR, 0):
        more = verified(_candidates(grouped, percent, near))
        links = cut_lineage(more if links is None else links.union(more))
        if near:
            found = components(links).select(F.col("doc_id.key").alias("doc_id"), F.col("component.key").alias("component"))
            grouped = lists.join(found, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    return members, classes, links


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, all_pairs: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, links).

    documents: doc_id, n_shingles, class_id (smallest document of the same set; null for none), one
    row per row with an id. links: pairs (a, b) of classes, verified; enough of them to connect all
    that is connected, or with `all_pairs` every similar pair of classes.
    """
    members, classes, links = _linked(_texts(docs).where("doc_id is not null"), size, percent, all_pairs)
    documents = members.join(classes.select("key", "class_id"), "key", "left").select("doc_id", F.col("n").alias("n_shingles"), "class_id")
    return documents, links.select(F.least("a", "b")["class_id"].alias("a"), F.greatest("a", "b")["class_id"].alias("b"))


def _grouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(key, component): the smallest vertex that each class reaches, itself included."""
    groups = components(links).select(F.col("doc_id.key").alias("key"), "component")
    return classes.join(groups, "key", "left").select("key", F.coalesce("component", F.struct("class_id", "key")).alias("component"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest document reachable by links, itself included."""
    members, classes, links = _linked(_texts(docs), size, percent)
    joined = members.join(_grouped(classes, links), "key", "left")
    component = F.nullif(F.coalesce("component.class_id", "doc_id"), F.lit(NO_ID))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def without_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns, with one row of each component: the least by id (none is last), text and the rest.

    Rows without shingles are components of their own.
    """
    members, classes, links = _linked(_texts(docs), size, percent)
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id")
    counted = members.where("n > 0").groupBy("key", order).agg(F.count("*").alias("rows"))
    placed = cut_lineage(counted.join(_grouped(classes, links), "key").select("key", "id", "rows", "component"))
    least = placed.where("id = component.class_id")
    several = least.groupBy("component").agg(F.sum("rows").alias("rows")).where("rows > 1").select("component")
    tied = cut_lineage(least.join(several, "component").select("key", "id", "component"))
    gone = placed.where("id <> component.class_id").select("key", "id").union(tied.select("key", "id"))

    # the caller's columns travel as one, so that their names can be any
    rows = docs.select(F.struct("*").alias("row"), order)
    schema = T.StructType([rows.schema["row"], T.StructField("id", T.LongType()), T.StructField("key", T.LongType())])
    keyed = rows.mapInArrow(_keyed(size, docs.columns.index("text")), schema)
    kept = keyed.join(gone, ["key", "id"], "left_anti").select("row.*")
    if not tied.limit(1).count():
        return kept
    # several rows have the least id of their component
    first = F.struct(F.col("row.doc_id").isNull(), F.col("row.text"), F.to_json("row"))
    firsts = keyed.join(tied, ["key", "id"]).groupBy("component").agg(F.min_by("row", first).alias("row")).select("row.*")
    return kept.union(firsts)
