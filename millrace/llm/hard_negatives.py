"""Hard negatives of anchor vectors, found in a tree of split points with distance ranges (after GNAT).

Vectors get one more component that gives them all the length of the longest one. On that sphere a
larger inner product with an anchor is a smaller angle, and angles obey the triangle inequality.

1. A tree is built on the driver from at most about `SAMPLE` rows: a node holds up to `FANOUT` split
   points far from each other, and a vector goes on with its nearest one (a hyperplane partition).
   Spark takes every row to its leaf and finds, for each split point of a node and each subtree
   beside it, the least and the largest angle between that point and the rows there. The tree has at most
   as many leaves as the sample has rows; a leaf of many rows is dealt to blocks.
2. Positives: an anchor first meets one block of its own leaf, which bounds how far its best rows can
   be. All leaves within that bound are then searched: a subtree is left out as soon as the ball around
   the anchor misses the range that one of the split points has for it.
3. Negatives: the scores that a positive allows are an annulus around the anchor. A leaf is searched if
   for some positive the annulus meets all ranges on its path.
4. Leaves are searched exactly: all of a block's rows against those anchors that reach it, as matrix
   products. Anchors travel in chunks, so a task holds `BLOCK` rows and `CHUNK` anchors at a time.

Nothing is approximate: ranges only leave out what cannot count. Vectors without clusters have few
leaves that can be left out; then the blocks do the whole work.

Rows with a null label or vector, or with a null or non-finite component, take no part. A shorter vector
counts as filled up with zeros, an empty one as zeros. A row without id is never an anchor by itself, and
comes after all ids among equal scores; rows that share an id are rows of their own. Only the columns
vec_id, embedding and label are read. Scores are exact; what a bigint can't hold becomes its nearest
value. An empty table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that the tree is built from, about; the bound of what the driver holds.
SAMPLE = 20_000
FANOUT = 8
#: A leaf is split while it is expected to hold more rows than this.
LEAF_ROWS = 16_384
#: Rows of the sample that a node needs at least for being split.
LEAST_SPLIT = 24
BLOCK = 32_768
CHUNK = 8192
#: Anchors of a chunk that are scored at once.
TILE = 64
#: Angles are computed with errors far below this.
SLACK = 1e-6

_EXACT = float(1 << 53)
_MOST = (1 << 63) - 1

_ROWS = "row bigint, vec_id bigint, label bigint, anchor boolean, dim int, norm double, vector binary"
_FOUND = "anchor bigint, slot int, vec_id bigint, row bigint, score bigint"


def _vectors(column: pa.Array, scale: float) -> Iterator[np.ndarray | None]:
    """floor(scale * x) of every list, or None if it takes no part."""
    for value in column:
        items = value.values if value.is_valid else None
        if items is None or items.null_count:
            yield None
            continue
        own = np.floor(scale * items.to_numpy(zero_copy_only=False).astype(np.float64))
        yield own if np.isfinite(own).all() else None


def _prepare(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, dims, norms, packed = [], [], [], []
            for i, v in enumerate(_vectors(batch.column(4), scale)):
                if v is not None:
                    kept.append(i)
                    dims.append(len(v))
                    norms.append(float(np.sqrt(v @ v)))
                    small = not len(v) or np.abs(v).max() <= 1 << 24  # such numbers are exact in four bytes
                    packed.append(v.astype("<f4" if small else "<f8").tobytes())
            rest = batch.take(pa.array(kept, pa.int64()))
            more = [pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([*rest.columns[:4], *more], names=[c.split()[0] for c in _ROWS.split(", ")])

    return run


def unpack(vectors: list[bytes], dims: list[int], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, (v, d) in enumerate(zip(vectors, dims, strict=True)):
        out[i, :d] = np.frombuffer(v, "<f4" if len(v) == 4 * d else "<f8")
    return out


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond a bigint its nearest value."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[1]
    if size < _EXACT:
        return (a @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(x).T, -_MOST, _MOST).astype(np.int64)


class Tree:
    """Split points of every node, and what they know about the subtrees beside them."""

    def __init__(self, most: float, width: int):
        self.most, self.width = most, width
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []  # a node, or ~leaf
        self.paths: list[list[tuple[int, int]]] = []  # of leaves: (node, child) from the root on
        self.low: list[np.ndarray] = []  # by node: split point x child
        self.high: list[np.ndarray] = []

    def lift(self, x: np.ndarray) -> np.ndarray:
        """One more component, so that all vectors are as long as the longest one."""
        rest = np.sqrt(np.maximum(0.0, self.most**2 - (x * x).sum(axis=1)))
        return np.column_stack([x, rest])

    def angles(self, lifted: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(lifted @ points.T / self.most**2, -1.0, 1.0)) if self.most else np.zeros((len(lifted), len(points)))

    def _far_apart(self, sample: np.ndarray) -> np.ndarray:
        """Up to FANOUT rows, each the farthest from those before."""
        chosen = [0]
        near = self.angles(sample, sample[:1])[:, 0]
        while len(chosen) < FANOUT and near.max() > SLACK:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, self.angles(sample, sample[chosen[-1:]])[:, 0])
        return sample[chosen]

    def grow(self, sample: np.ndarray, leaf: float, path: list[tuple[int, int]] | None = None) -> int:
        path = path or []
        points = self._far_apart(sample) if len(sample) > max(leaf, LEAST_SPLIT) else sample[:1]
        if len(points) < 2:
            self.paths.append(path)
            return ~(len(self.paths) - 1)
        node = len(self.points)
        self.points.append(points)
        self.children.append([])
        own = self.angles(sample, points).argmin(axis=1)
        for j in range(len(points)):
            self.children[node].append(self.grow(sample[own == j], leaf, [*path, (node, j)]))
        return node

    def leaf_of(self, lifted: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lifted), np.int64)
        waiting = [(0, np.arange(len(lifted)))] if self.points else []
        while waiting:
            node, at = waiting.pop()
            own = self.angles(lifted[at], self.points[node]).argmin(axis=1)
            for j, child in enumerate(self.children[node]):
                if len(part := at[own == j]):
                    if child < 0:
                        out[part] = ~child
                    else:
                        waiting.append((child, part))
        return out

    def reached(self, x: np.ndarray, near: np.ndarray, far: np.ndarray) -> list[np.ndarray]:
        """The leaves of each vector that can hold rows within one of its annuli (vectors x annuli, angles)."""
        out: list[list[int]] = [[] for _ in x]
        lengths = np.sqrt((x * x).sum(axis=1))
        flat = np.where(lengths[:, None] > 0, np.column_stack([x, np.zeros(len(x))]) / np.maximum(lengths, 1e-300)[:, None] * self.most, 0.0)
        waiting = [(0, np.arange(len(x)))] if self.points else []
        if not self.points:
            return [np.zeros(1, np.int64) for _ in x]
        while waiting:
            node, at = waiting.pop()
            own = self.angles(flat[at], self.points[node])
            blind = lengths[at] == 0  # all scores are 0, wherever a row lies
            for j, child in enumerate(self.children[node]):
                low, high = self.low[node][:, j], self.high[node][:, j]
                least = np.maximum(low - own, own - high).max(axis=1) - SLACK
                most = np.minimum(own + high, 2 * np.pi - own - low).min(axis=1) + SLACK
                open_ = (near[at] <= most[:, None]) & (far[at] >= least[:, None])
                open_ = (open_.any(axis=1) | blind) & np.isfinite(high).all()
                if len(part := at[open_]):
                    if child >= 0:
                        waiting.append((child, part))
                    else:
                        for i in part:
                            out[i].append(~child)
        return [np.array(leaves, np.int64) for leaves in out]

    def angle_of(self, score: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The angle at which a row has this score; larger scores are nearer."""
        reach = np.maximum(lengths * self.most, 1e-300)
        return np.arccos(np.clip(score / reach, -1.0, 1.0))


def _leaves(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpack(batch["vector"].to_pylist(), batch["dim"].to_pylist(), tree.width)
            leaf = pa.array(tree.leaf_of(tree.lift(x)), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=[*batch.schema.names, "leaf"])

    return run


def _ranges(tree: Tree):
    """Per task, the least and largest angle of each split point and the rows of each subtree beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[tuple[int, int], np.ndarray] = {}
        high: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            lifted = tree.lift(unpack(batch["vector"].to_pylist(), batch["dim"].to_pylist(), tree.width))
            leaf = batch["leaf"].to_numpy()
            for own in np.unique(leaf):
                rows = lifted[leaf == own]
                for node, j in tree.paths[own]:
                    angles = tree.angles(rows, tree.points[node])
                    low[node, j] = np.minimum(low.get((node, j), np.inf), angles.min(axis=0))
                    high[node, j] = np.maximum(high.get((node, j), -np.inf), angles.max(axis=0))
        out = [(n, i, j, float(low[n, j][i]), float(high[n, j][i])) for n, j in low for i in range(len(low[n, j]))]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
        columns = zip(*out, strict=True) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["node", "point", "child", "low", "high"])

    return run


class Index:
    """All rows with their leaves (a written table), the tree, and how leaves are dealt to blocks."""

    def __init__(self, vectors: DataFrame, anchors: Column, scale: float):
        rows = vectors.select(
            F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("label").cast("bigint").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col("embedding"),
        )
        rows = cut_lineage(rows.where("label is not null and embedding is not null").mapInArrow(_prepare(scale), _ROWS))
        about = rows.agg(F.count("*").alias("n"), F.max("norm").alias("most"), F.max("dim").alias("dim"), F.count_if("anchor").alias("anchors")).first()
        self.tree = Tree(about["most"] or 0.0, about["dim"] or 0)
        self.chunks = max(1, -(-about["anchors"] // CHUNK))
        share = min(1.0, SAMPLE / max(1, about["n"]))
        drawn = rows.where(F.pmod(F.xxhash64("row"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))).orderBy("row").collect()
        if drawn:
            sample = self.tree.lift(unpack([r["vector"] for r in drawn], [r["dim"] for r in drawn], self.tree.width))
            self.tree.grow(sample, LEAF_ROWS * len(drawn) / about["n"])
        tree = self.tree
        self.rows = cut_lineage(rows.mapInArrow(_leaves(tree), f"{_ROWS}, leaf bigint"))
        tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
        tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
        if tree.points:
            found = self.rows.mapInArrow(_ranges(tree), "node int, point int, child int, low double, high double")
            for r in found.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
                tree.low[r["node"]][r["point"], r["child"]] = r["low"]
                tree.high[r["node"]][r["point"], r["child"]] = r["high"]
        sizes = {r["leaf"]: r["count"] for r in self.rows.groupBy("leaf").count().collect()}
        block = max(256, min(BLOCK, (BLOCK << 6) // max(1, self.tree.width)))
        self.blocks = [-(-sizes.get(leaf, 0) // block) for leaf in range(len(tree.paths))]
        self.firsts = [int(f) for f in np.cumsum([0, *self.blocks])]

    def placed(self, df: DataFrame) -> DataFrame:
        """df, rows of the index, with their `block`; a block is one part of one leaf."""
        many, first = (F.element_at(F.lit(np.array([*of, 1], np.int64)), F.col("leaf").cast("int") + 1) for of in (self.blocks, self.firsts))
        return df.withColumn("block", first + F.pmod(F.xxhash64("row"), F.greatest(many, F.lit(1))))

    def search(self, visits: DataFrame, inside: Callable) -> DataFrame:
        """`inside(rows, anchors)` for every block and chunk of anchors that visit it.

        visits: block, row, label, dim, vector, least and most (arrays of score bounds).
        """
        unit = lambda chunk: F.col("block") * self.chunks + chunk
        visits = cut_lineage(visits.select(unit(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(self.chunks))).alias("unit"), "row", "label", "dim", "vector", "least", "most"))
        rows = self.placed(self.rows).withColumn("chunk", F.explode(F.lit(np.arange(self.chunks, dtype=np.int64))))
        rows = rows.select(unit(F.col("chunk")).alias("unit"), "row", "vec_id", "label", "dim", "vector")
        rows = rows.join(visits.select("unit").distinct(), "unit", "left_semi")
        return rows.groupBy("unit").cogroup(visits.groupBy("unit")).applyInArrow(inside, _FOUND)


def _block(width: int, rows: pa.Table, anchors: pa.Table):
    """Both sides as arrays; rows in the order of ids, those without id at the end."""
    row = rows["row"].to_numpy()
    ids = rows["vec_id"].fill_null(0).to_numpy()
    order = np.lexsort((row, ids, rows["vec_id"].is_null().to_numpy()))
    x = unpack(rows["vector"].to_pylist(), rows["dim"].to_pylist(), width)[order]
    a = unpack(anchors["vector"].to_pylist(), anchors["dim"].to_pylist(), width)
    return x, row[order], rows["vec_id"].take(pa.array(order)), rows["label"].to_numpy()[order], a, anchors["row"].to_numpy(), anchors["label"].to_numpy()


def _table(parts: list[tuple], ids: pa.ChunkedArray) -> pa.Table:
    names = [c.split()[0] for c in _FOUND.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    if not parts:
        return pa.table([pa.array([], k) for k in kinds], names=names)
    anchor, slot, at, row, score = (np.concatenate(c) for c in zip(*parts, strict=True))
    ids = pa.concat_arrays(ids.take(pa.array(at)).chunks) if isinstance(ids, pa.ChunkedArray) else ids.take(pa.array(at))
    return pa.table([pa.array(anchor, kinds[0]), pa.array(slot, kinds[1]), ids, pa.array(row, kinds[3]), pa.array(score, kinds[4])], names=names)


def _first_of_each(owner: np.ndarray, n: int) -> np.ndarray:
    """Which entries are among the first n of their owner; owners stand together."""
    begins = np.flatnonzero(np.concatenate([np.ones(min(1, len(owner)), bool), owner[1:] != owner[:-1]]))
    place = np.arange(len(owner)) - np.repeat(begins, np.diff(np.append(begins, len(owner))))
    return place < n


def _positives(width: int, count: int):
    """The best other rows of an anchor's label, of those that score at least `least`."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(rows) or not len(anchors):
            return _table([], rows["vec_id"])
        x, row, ids, label, a, own_row, own_label = _block(width, rows, anchors)
        least = np.array([v[0] for v in anchors["least"].to_pylist()], np.int64)
        out = []
        for low in range(0, len(a), TILE):
            t = slice(low, low + TILE)
            s = scores(a[t], x)
            i, j = np.nonzero((label == own_label[t, None]) & (row != own_row[t, None]) & (s >= least[t, None]))
            found = s[i, j]
            order = np.lexsort((j, -found, i))
            order = order[_first_of_each(i[order], count)]
            i, j, found = i[order] + low, j[order], found[order]
            out.append((own_row[i], np.zeros(len(i), np.int32), j, row[j], found))
        return _table(out, ids)

    return run


def _negatives(width: int, count: int):
    """For each window of scores of an anchor, the best rows of other labels in it."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(rows) or not len(anchors):
            return _table([], rows["vec_id"])
        x, row, ids, label, a, own_row, own_label = _block(width, rows, anchors)
        least, most = anchors["least"].to_pylist(), anchors["most"].to_pylist()
        lowest, highest = np.array([min(v) for v in least]), np.array([max(v) for v in most])
        out = []
        for low in range(0, len(a), TILE):
            t = slice(low, low + TILE)
            s = scores(a[t], x)
            i, j = np.nonzero((label != own_label[t, None]) & (s >= lowest[t, None]) & (s <= highest[t, None]))
            found = s[i, j]
            order = np.lexsort((j, -found, i))
            i, j, found = i[order], j[order], found[order]
            edges = np.searchsorted(i, np.arange(len(s) + 1))
            for k in np.flatnonzero(np.diff(edges)):
                own = found[edges[k] : edges[k + 1]]
                for slot, (lo, hi) in enumerate(zip(least[low + k], most[low + k], strict=True)):
                    first = int(np.searchsorted(-own, -hi))
                    last = first + int(np.count_nonzero(own[first : first + count] >= lo))
                    at = slice(edges[k] + first, edges[k] + last)
                    if last > first:
                        n = last - first
                        out.append((np.full(n, own_row[low + k]), np.full(n, slot, np.int32), j[at], row[j[at]], found[at]))
        return _table(out, ids)

    return run


def _share(score: Column, percent: int, up: bool) -> Column:
    """percent hundredths of a whole number, rounded up or down, without overflow."""
    exact = score.cast("decimal(20,0)") * percent / 100
    return (F.ceil(exact) if up else F.floor(exact)).cast("bigint")


def _visits(tree: Tree, blocks: list[int], firsts: list[int], positive: bool):
    """Anchors once for every block that they have to see."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpack(batch["vector"].to_pylist(), batch["dim"].to_pylist(), tree.width)
            lengths = np.sqrt((x * x).sum(axis=1))
            least, most = batch["least"].to_pylist(), batch["most"].to_pylist()
            slots = max((len(v) for v in least), default=0)
            near, far = np.full((len(x), slots), np.inf), np.full((len(x), slots), -np.inf)
            for i in range(len(x)):
                k = len(least[i])
                far[i, :k] = tree.angle_of(np.array(least[i], float), lengths[i])
                near[i, :k] = 0.0 if positive else tree.angle_of(np.array(most[i], float), lengths[i])
            leaves = tree.reached(x, near, far)
            of = [np.concatenate([np.arange(firsts[v], firsts[v] + blocks[v]) for v in own]) if len(own) else np.zeros(0, np.int64) for own in leaves]
            at = pa.array(np.repeat(np.arange(len(x)), [len(b) for b in of]))
            block = pa.array(np.concatenate(of) if of else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([block, *batch.take(at).columns], names=["block", *batch.schema.names])

    return run


def mine(
    vectors: DataFrame, anchors: Column, scale: float = 256.0, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` tells which rows are anchors. A row's score with an anchor is the inner product of their
    components floor(scale * x). An anchor's positives are its best `positives` other rows of the same
    label. Each positive takes the best `negatives` rows of other labels whose scores lie between `low`
    and `high` hundredths of its own. Equal scores are ordered by vec_id.
    """
    index = Index(vectors, anchors, scale)
    tree, width = index.tree, index.tree.width
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    first = lambda df, n: df.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n)
    about = ("row", "label", "dim", "vector")
    own = index.rows.where("anchor")

    whole = (F.array(F.lit(-_MOST - 1)).alias("least"), F.array(F.lit(_MOST)).alias("most"))
    seeds = index.search(index.placed(own).select("block", *about, *whole), _positives(width, positives))
    bound = first(seeds, positives).groupBy("anchor").agg(F.when(F.count("*") == positives, F.min("score")).alias("bound"))
    asked = own.join(bound.withColumnRenamed("anchor", "row"), "row", "left")
    asked = asked.select(*about, F.array(F.coalesce("bound", F.lit(-_MOST - 1))).alias("least"), F.array(F.lit(_MOST)).alias("most"))
    schema = "block bigint, row bigint, label bigint, dim int, vector binary, least array<bigint>, most array<bigint>"
    reach = lambda df, positive: df.mapInArrow(_visits(tree, index.blocks, index.firsts, positive), schema)
    found = cut_lineage(first(index.search(reach(asked, True), _positives(width, positives)), positives))

    windows = found.withColumns({"lo": _share(F.col("score"), low, True), "hi": _share(F.col("score"), high, False)}).where("lo <= hi")
    listed = windows.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "lo", "hi", "vec_id", "score"))).alias("of"))
    listed = cut_lineage(own.join(listed.withColumnRenamed("anchor", "row"), "row").select(*about, F.col("vec_id").alias("anchor_id"), "of"))
    asked = listed.select(*about, F.col("of.lo").alias("least"), F.col("of.hi").alias("most"))
    hard = first(index.search(reach(asked, False), _negatives(width, negatives)), negatives)
    positive = F.get("of", F.col("slot"))
    return hard.join(listed.select(F.col("row").alias("anchor"), "anchor_id", "of"), "anchor").select(
        "anchor_id", positive["vec_id"].alias("positive_id"), F.col("place").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )
