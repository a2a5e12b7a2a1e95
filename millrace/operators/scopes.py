"""Table lineage by tokens: bracket depth, scopes of names and several inserts of one statement.

A running sum over the tokens of a statement gives their bracket depth, and the last opening
bracket of that depth names the group a token stands in. A group is a query if it begins with one or
follows FROM or JOIN; a call such as `extract(year from x)` has no sources.

The name of a common table expression hides tables of that name from the end of its body (with RECURSIVE
from its definition) to the end of the group that defines it, and nowhere else. A source before the first
target of a statement feeds all its targets (`from s insert ... insert ...`), any other the target it
follows. Common table expressions count for the targets by their place too, used or not.

All that concerns one statement stays in its row, tokens included: only edges are shuffled.

A null text or script without edges gives no rows; repeated scripts give their edges once. Column lists
of common table expressions (`with t (a) as`) are not understood.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.lineage import statements

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TOKEN = r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*)*|[0-9][A-Za-z0-9_.]*|\S"
_CLAUSES = (
    "select from join where on group order having lateral union except intersect set values "
    "insert with recursive limit window cluster distribute sort using partition"
).split()
_OTHERS = "( ) , distinct into overwrite table create external temporary replace or not if exists as".split()
#: Words are numbers in the tasks; 0 is any other word, or none.
_WORD = {word: i for i, word in enumerate([*_CLAUSES, *_OTHERS], 1)}
_KINDS = ("source", "cte", "target")
_NEVER = np.iinfo(np.int64).max
_MARK = pa.struct([("kind", pa.int8()), ("pos", pa.int64()), ("token", pa.string()), ("word", pa.string()),
                   ("part", pa.int64()), ("seen_from", pa.int64()), ("seen_to", pa.int64())])
_MARKS = "array<struct<kind: tinyint, pos: bigint, token: string, word: string, part: bigint, seen_from: bigint, seen_to: bigint>>"


def _any(words: np.ndarray, *names: str) -> np.ndarray:
    return np.isin(words, [_WORD[n] for n in names])


def _last(marked: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where the last marked place up to each place is, -1 if none; `fresh` begins a new run of places."""
    at = np.arange(len(marked))
    found = np.maximum.accumulate(np.where(marked, at, -1))
    return np.where(found >= np.maximum.accumulate(np.where(fresh, at, 0)), found, -1)


def _mark(word: np.ndarray, name: np.ndarray, statement: np.ndarray) -> dict[str, np.ndarray]:
    """The tokens that are sources, targets or names of common table expressions, of many statements in order."""
    n = len(word)
    at = np.arange(n)
    fresh = np.r_[True, statement[1:] != statement[:-1]]
    start = np.flatnonzero(fresh)[statement]

    def near(step: int) -> np.ndarray:
        there = np.clip(at + step, 0, n - 1)
        return np.where((there == at + step) & (statement[there] == statement), word[there], 0)

    before1, before2, before3, before4 = (near(-i) for i in (1, 2, 3, 4))
    after1, after2 = near(1), near(2)

    opens, closes = word == _WORD["("], word == _WORD[")"]
    sums = np.cumsum(opens.astype(np.int64) - closes)
    sums -= sums[start] - opens[start] + closes[start]
    depth = sums + closes  # both brackets belong inside
    level = np.lexsort((depth, statement))
    new_level = np.r_[True, (statement[level][1:] != statement[level][:-1]) | (depth[level][1:] != depth[level][:-1])]
    found = _last(opens[level], new_level)
    group = np.empty(n, np.int64)  # the place of the opening bracket, or -1
    group[level] = np.where(found >= 0, level[found], -1)

    inside = group >= 0
    own = np.where(inside, group, n + statement)
    by_group = np.argsort(own, kind="stable")
    sorted_own = own[by_group]
    new_group = np.r_[True, sorted_own[1:] != sorted_own[:-1]]
    begins, follows = np.where(inside, after1[group], 0), np.where(inside, before1[group], 0)
    ends = by_group[np.r_[np.flatnonzero(new_group)[1:] - 1, n - 1]]
    end = np.empty(n, np.int64)
    end[by_group] = ends[np.cumsum(new_group) - 1]

    is_clause = _any(word, *_CLAUSES) & ~((word == _WORD["from"]) & _any(before1, "distinct"))
    last = np.r_[-1, _last(is_clause[by_group], new_group)[:-1]]  # before the token itself
    clause = np.empty(n, word.dtype)
    clause[by_group] = np.where((last >= 0) & ~new_group, word[by_group][last], 0)
    second = np.r_[by_group[2:], [0, 0]][:n]
    in_group = np.r_[sorted_own[2:] == sorted_own[:-2], [False, False]][:n]
    behind_body = np.empty(n, np.int64)
    behind_body[by_group] = np.where(in_group, second, _NEVER)

    in_query = ~inside | _any(begins, "select", "with", "from", "(") | _any(follows, "from", "join")
    after_from = (_any(before1, "from") & ~_any(before2, "distinct")) | _any(before1, "join")
    in_list = _any(before1, ",") & _any(clause, "from", "join", "on")
    in_brackets = _any(before1, "(") & _any(follows, "from", "join")
    source = name & in_query & ~_any(after1, "(") & (after_from | in_list | in_brackets)
    into = _any(before1, "into", "overwrite") & _any(before2, "insert")
    into_table = _any(before1, "table") & (
        (_any(before2, "into", "overwrite") & _any(before3, "insert"))
        | _any(before2, "create")
        | (_any(before2, "external", "temporary", "replace") & (_any(before3, "create") | _any(before4, "create")))
        | (_any(before2, "external", "temporary") & _any(before3, "replace") & _any(before4, "or"))
    )
    if_missing = _any(before1, "exists") & _any(before2, "not") & _any(before3, "if") & _any(before4, "table")
    # of the statements with IF NOT EXISTS, those that create; a dropped or altered table has no NOT
    target = name & ~inside & (into | into_table | if_missing)
    defines = name & _any(before1, "with", "recursive", ",") & _any(after1, "as") & _any(after2, "(") & _any(clause, "with", "recursive")
    targets = np.cumsum(target)
    return {
        "kind": np.select([target, defines, source], [2, 1, 0], -1).astype(np.int8),
        "pos": at,
        "part": targets - targets[start] + target[start],
        "seen_from": np.where(_any(clause, "recursive"), at, behind_body),
        "seen_to": np.where(inside, end, _NEVER),
    }


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of statements to their marked tokens; statements without a source or a target are left out."""
    for batch in batches:
        lists = batch.column(2)
        tokens = lists.flatten()
        if not len(tokens):
            continue
        length = np.asarray(pc.list_value_length(lists))
        words = pc.utf8_lower(tokens).dictionary_encode()
        known = pc.index_in(words.dictionary, value_set=pa.array(list(_WORD))).fill_null(-1).to_numpy() + 1
        code = words.indices.to_numpy()
        named = np.asarray(pc.match_substring_regex(words.dictionary, "^[a-z_]")) & ~_any(known, *_CLAUSES, "table", "as")
        filled = np.flatnonzero(length)  # statements are not blank, but that is not known here
        statement = np.repeat(np.arange(len(filled)), length[filled])
        marks = _mark(known[code].astype(np.int8), named[code], statement)
        has = lambda kind: np.bincount(statement, marks["kind"] == _KINDS.index(kind)) > 0  # noqa: E731, B023
        wanted = has("source") & has("target")
        kept = np.flatnonzero((marks["kind"] >= 0) & wanted[statement])
        out = {name: pa.array(values[kept]) for name, values in marks.items()}
        out |= {"token": tokens.take(pa.array(kept)), "word": words.dictionary.take(pa.array(code[kept]))}
        counts = np.bincount(statement[kept], minlength=len(filled))[wanted]
        structs = pa.StructArray.from_arrays([out[f.name].cast(f.type) for f in _MARK], fields=list(_MARK))
        whole = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), structs)
        at = pa.array(filled[wanted])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), whole], names=["script_id", "statement_no", "marks"])


def scoped_edges(scripts: DataFrame) -> DataFrame:
    """(script_id, statement_no, input_table, output_table), each once."""
    cut = statements(scripts).select("script_id", "statement_no", F.regexp_extract_all("statement", F.lit(_TOKEN), F.lit(0)).alias("tokens"))
    kind = StructType([cut.schema["script_id"], cut.schema["statement_no"], *StructType.fromDDL(f"marks {_MARKS}").fields])
    rows = cut.mapInArrow(_marked, kind)
    of = lambda kind: F.filter("marks", lambda m: m["kind"] == _KINDS.index(kind))

    def hidden(s: Column) -> Column:
        return F.exists(of("cte"), lambda c: (s["word"] == c["word"]) & (s["pos"] >= c["seen_from"]) & (s["pos"] < c["seen_to"]))

    def feeds(s: Column) -> Column:
        fed = F.filter(of("target"), lambda t: (s["part"] == 0) | (s["part"] == t["part"]))
        return F.transform(fed, lambda t: F.struct(s["token"].alias("input_table"), t["token"].alias("output_table")))

    real = F.filter(of("source"), lambda s: ~hidden(s))
    edges = rows.select("script_id", "statement_no", F.explode(F.array_distinct(F.flatten(F.transform(real, feeds)))).alias("edge"))
    edges = edges.select("script_id", "statement_no", "edge.*")
    # few edges are the same, so they meet first: summed up before, they would fill the tasks' memory for nothing
    return edges.repartition(*edges.columns).distinct()
