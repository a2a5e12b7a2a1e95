"""Secrets in texts, through a trigram index sharded by document.

From each rule's regular expression a Boolean query over trigrams is derived: what every match must
contain. Each shard (the texts of one chunk) indexes the trigrams that the queries name, intersects
and unites their postings, and only the documents left are matched against the rule. A rule without
a mandatory trigram scans all texts. Trigrams are folded to lower case, so the index can only give
too many candidates, never too few.

Null is the empty text, without secrets. Each row is judged by itself; other columns are ignored by
`scan` and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a match counts if its group has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)
RULES = BASE + MORE

_MOST_STRINGS = 64


def trigram_query(pattern: str):
    """("and"/"or", parts), a trigram, or True where nothing is mandatory."""
    return _whole(*_sequence(re._parser.parse(pattern)))


def _both(kind: str, parts: list):
    flat = []
    for p in parts:
        flat += p[1] if isinstance(p, tuple) and p[0] == kind else [p]
    if kind == "and":
        flat = [p for p in flat if p is not True]
        if not flat:
            return True
    elif any(p is True for p in flat):
        return True
    flat = list(dict.fromkeys(flat))
    return flat[0] if len(flat) == 1 else (kind, tuple(flat))


def _of_strings(strings: set[str]):
    """One of these strings occurs: for each, all its trigrams."""
    return _both("or", [_both("and", [s[i : i + 3].lower() for i in range(len(s) - 2)]) for s in sorted(strings)])


def _whole(strings: set[str] | None, query):
    return _both("and", [query, _of_strings(strings)]) if strings is not None else query


def _sequence(items) -> tuple[set[str] | None, object]:
    """(all strings it matches, or None if too many; query that holds besides)."""
    run, query, exact = {""}, True, True
    for op, value in items:
        strings, more = _node(str(op), value)
        query = _both("and", [query, more])
        if strings is not None and len(run) * len(strings) <= _MOST_STRINGS:
            run = {a + b for a in run for b in strings}
        else:
            query, exact = _both("and", [query, _of_strings(run)]), False
            run = strings if strings is not None else {""}
    return (run, query) if exact else (None, _both("and", [query, _of_strings(run)]))


def _node(op: str, value) -> tuple[set[str] | None, object]:
    if op == "LITERAL":
        return {chr(value)}, True
    if op == "IN" and all(str(o) == "LITERAL" for o, _ in value) and len(value) <= 8:
        return {chr(v) for _, v in value}, True
    if op == "SUBPATTERN":
        return _sequence(value[3])
    if op == "BRANCH":
        found = [_sequence(branch) for branch in value[1]]
        if all(s is not None for s, _ in found):
            strings = set().union(*(s for s, _ in found))
            if len(strings) <= _MOST_STRINGS:
                return strings, True
        return None, _both("or", [_whole(*f) for f in found])
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, item = value
        strings, query = _sequence(item)
        if strings is not None and int(high) == 1 and len(strings) < _MOST_STRINGS:
            return (strings | {""}, True) if low == 0 else (strings, query)
        if strings is not None and low == high and len(strings) == 1:
            return {next(iter(strings)) * low}, True
        return None, _whole(strings, query) if low > 0 else True
    return None, True


def _named(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(_named, query[1]))


class Scanner:
    """Rules with their trigram queries, applied to one shard of texts at a time."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.match = [re.compile(r.pattern, re.ASCII) for r in rules]
        self.match_bytes = [re.compile(r.pattern.encode()) for r in rules]
        grams = sorted(set().union(*map(_named, self.queries)))
        if not all(g.isascii() for g in grams):
            raise ValueError("mandatory parts of a rule must be ASCII")
        self.codes = {g: int.from_bytes(g.encode(), "big") for g in grams}
        self.heads = np.zeros(1 << 16, bool)
        self.heads[[c >> 8 for c in self.codes.values()]] = True

    def index(self, data: bytes, offsets: np.ndarray) -> dict[int, np.ndarray]:
        """Postings: the texts, by number, that have each named trigram."""
        low = np.frombuffer(data.lower(), np.uint8)
        if len(low) < 3 or not self.codes:
            return {}
        pair = (low[:-2].astype(np.uint16) << np.uint16(8)) | low[1:-1]
        at = np.flatnonzero(self.heads[pair])
        code = (pair[at].astype(np.int64) << 8) | low[at + 2]
        named = np.isin(code, list(self.codes.values()))
        at, code = at[named], code[named]
        owner = np.searchsorted(offsets, at, side="right") - 1
        both = np.unique(np.stack([code, owner]), axis=1)
        edges = np.append(np.flatnonzero(np.diff(both[0], prepend=-1)), both.shape[1])
        return {int(both[0, a]): both[1, a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)}

    def candidates(self, query, postings: dict[int, np.ndarray]) -> np.ndarray:
        if isinstance(query, str):
            return postings.get(self.codes[query], np.zeros(0, np.int64))
        parts = [self.candidates(p, postings) for p in query[1]]
        join = np.intersect1d if query[0] == "and" else np.union1d
        return reduce(join, parts)

    def _full_scan(self, i: int, data: bytes, offsets: np.ndarray) -> list[int]:
        rule = self.rules[i]
        at = [m.start() for m in self.match_bytes[i].finditer(data) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return sorted(set((np.searchsorted(offsets, at, side="right") - 1).tolist()))

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, number of the rule, end) in code points, sorted."""
        data = b"\0".join(texts)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        postings = self.index(data, offsets)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for i, rule in enumerate(self.rules):
            query = self.queries[i]
            for k in self._full_scan(i, data, offsets) if query is True else self.candidates(query, postings).tolist():
                for m in self.match[i].finditer(texts[k].decode()):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[k].append((m.start(), i, m.end()))
        return [sorted(f) for f in found]


def _listed(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...], kinds: int) -> str:
    return ",".join(f"{rules[i].kind}:{start}:{end}" for start, i, end in spans if i < kinds)


def _scan(rules: tuple[Rule, ...], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), words.utf8(batch.column(1)), strict=True)
            for chunk in words.in_chunks(rows, 1):
                found = scanner.spans([t for _, t in chunk])
                counts = [[sum(i == k for _, i, _ in f) for f in found] for k in range(len(BASE))]
                base = [_listed(f, rules, len(BASE)) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in chunk], pa.int64()),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                        pa.array([_listed(f, rules, len(rules)) for f in found], pa.string()),
                    ],
                    names=names,
                )

    return run


def scan(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined)."""
    names = ["doc_id", *(f"n_{r.kind}" for r in BASE), "base_sha256", "spans"]
    kinds = ["bigint"] * (1 + len(BASE)) + ["string", "string"]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_scan(BASE + more, names), ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))


def _redact(rules: tuple[Rule, ...], text_at: int):
    def masked(text: bytes, spans: list[tuple[int, int, int]]) -> str:
        whole, out, at = text.decode(), [], 0
        for start, i, end in spans:
            if start >= at:
                out += [whole[at:start], f"[{rules[i].kind}]"]
            at = max(at, end)
        return "".join([*out, whole[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            column = batch.column(text_at)
            texts = column.to_pylist()
            rows = ((i, t) for i, t in enumerate(words.utf8(column)))
            for chunk in words.in_chunks(rows, 1):
                for (i, text), spans in zip(chunk, scanner.spans([t for _, t in chunk]), strict=True):
                    if spans:
                        texts[i] = masked(text, spans)
            yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(texts, column.type))

    return run


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs with every secret in `text` replaced by its kind in brackets."""
    return docs.mapInArrow(_redact(rules, docs.columns.index("text")), docs.schema)
