"""An inverted index of one text field: scored search and fuzzy terms without reading the texts again.

    postings/bucket=<n>   (token, id, freq, length): one row per token and document, sorted by token
    tokens/bucket=<n>     (token, docs, most): in how many documents, and the most that a document can score
                          by it before its weight
    forms/bucket=<n>      (form, token): each token with up to `DELETES` letters left out
    totals                number of documents with tokens, and their tokens

A query reads the buckets of its tokens only, and within them the row groups that can hold them.
Scores are BM25: a token weighs ln(1 + (N - df + 0.5) / (df + 0.5)), and counts by
freq / (freq + K1 * (1 - B + B * length / average)).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import computed_once, tokens
from millrace.operators.joins import broadcast_if_small
from millrace.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K1, B = 1.2, 0.75
DELETES = 2
#: Longer tokens have no forms; a fuzzy query compares them one by one.
MOST_LETTERS = 24
#: Bounds and sums of the same numbers may differ in their last bits.
SLACK = 1e-9


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    path: str
    id: str
    buckets: int = 64

    def _bucket(self, c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, name: str, by: str) -> None:
        rows = df.withColumn("bucket", self._bucket(F.col(by)))
        # a bucket of frequent tokens is split by document
        rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", by)
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}")

    def build(self, docs: DataFrame, field: str, fuzzy: bool = False) -> Index:
        """Write the index; a document without tokens is not in it."""
        # cutting a text costs more than all else done with it, so texts are cut once and their tokens kept
        cut = cut_lineage(computed_once(docs.select(self.id, field), tokens(F.col(field)), "t").select(self.id, "t").where(F.size("t") > 0))
        each = cut.select(self.id, F.size("t").alias("length"), F.explode("t").alias("token"))
        self._write(each.groupBy("token", self.id, "length").agg(F.count(F.lit(1)).alias("freq")), "postings", "token")
        sums = cut.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("t")).alias("length")).select("docs", F.coalesce("length", F.lit(0)).alias("length"))
        sums.write.mode("overwrite").parquet(f"{self.path}/totals")
        _, average = self.totals()
        most = F.max(_share(F.col("freq"), F.col("length"), average)).alias("most")
        self._write(self._read("postings").groupBy("token").agg(F.count(F.lit(1)).alias("docs"), most), "tokens", "token")
        if fuzzy:
            short = self._read("tokens").where(F.length("token") <= MOST_LETTERS)
            self._write(short.select("token", F.explode(deletions(F.col("token"), DELETES)).alias("form")), "forms", "form")
        return self

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").drop("bucket")

    def _of(self, name: str, by: str, values: list[str]) -> DataFrame:
        """The rows of some tokens or forms; only their buckets are opened."""
        if not values:
            return self._read(name).where("false")
        wanted = self.spark.createDataFrame([(v,) for v in values], "v string")
        own = [r[0] for r in wanted.select(self._bucket(F.col("v"))).distinct().collect()]
        rows = self.spark.read.parquet(f"{self.path}/{name}")
        return rows.where(F.col("bucket").isin(own) & F.col(by).isin(values)).drop("bucket")

    def totals(self) -> tuple[int, float]:
        """Documents, and their average length."""
        row = self._read("totals").first()
        return row["docs"], row["length"] / max(1, row["docs"])

    # ---- scored search

    def _scored(self, own: list[str], weights: dict[str, float], average: float, only: DataFrame | None = None) -> DataFrame:
        """(id, score) of documents with some of the tokens, or of `only` those that are given."""
        weight = F.lit(None).cast("double")
        for token in own:
            weight = F.when(F.col("token") == token, weights[token]).otherwise(weight)
        rows = self._of("postings", "token", own)
        if only is not None:
            rows = rows.join(broadcast_if_small(only.select(self.id)), self.id, "left_semi")
        return rows.select(self.id, (weight * _share(F.col("freq"), F.col("length"), average)).alias("part")).groupBy(self.id).agg(F.sum("part").alias("score"))

    def search(self, query: str, k: int = 10) -> DataFrame:
        """The k best documents: id and score, equal scores by id.

        Tokens that cannot lift a document to the k-th best score, even all together, are looked up only for
        documents that the other tokens have found, and of those only for such as can still come that far.
        """
        asked = sorted(set(self.spark.range(1).select(tokens(F.lit(query)).alias("t")).first()["t"]))
        known = self._of("tokens", "token", asked).collect()
        docs, average = self.totals()
        weights = {r["token"]: math.log(1 + (docs - r["docs"] + 0.5) / (r["docs"] + 0.5)) for r in known}
        bounds = {r["token"]: weights[r["token"]] * r["most"] for r in known}
        by_bound = sorted(bounds, key=lambda t: (-bounds[t], t))
        best = self._scored(by_bound, weights, average)
        if len(by_bound) > 1:
            reached = self._scored(by_bound[:1], weights, average).orderBy(F.desc("score")).limit(k).collect()
            least = reached[-1]["score"] if len(reached) == k else 0.0
            cut = next(i for i in range(1, len(by_bound) + 1) if sum(bounds[t] for t in by_bound[i:]) < least - SLACK or i == len(by_bound))
            if cut < len(by_bound):
                rest = sum(bounds[t] for t in by_bound[cut:])
                found = cut_lineage(self._scored(by_bound[:cut], weights, average).where(F.col("score") + rest >= least - SLACK))
                more = self._scored(by_bound[cut:], weights, average, found).withColumnRenamed("score", "more")
                best = found.join(more, self.id, "left").select(self.id, (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
        return best.select(self.id, F.round("score", 6).alias("score")).orderBy(F.desc("score"), self.id).limit(k)

    # ---- fuzzy terms

    def like(self, term: str, distance: int = 2) -> DataFrame:
        """(token, distance): tokens within the distance; a swap of two neighbours counts 1."""
        if distance > DELETES:
            raise ValueError(f"forms leave out {DELETES} letters at most")
        forms = self.spark.range(1).select(deletions(F.lit(term), distance)).first()[0]
        near = self._of("forms", "form", forms).select("token").distinct()
        long = self._read("tokens").where((F.length("token") > MOST_LETTERS) & (F.abs(F.length("token") - len(term)) <= distance))
        compared = near.union(long.select("token")).mapInPandas(_compare(term), "token string, distance int")
        return compared.where(F.col("distance") <= distance)

    def documents_like(self, term: str, distance: int = 2) -> DataFrame:
        """(id): documents with such a token."""
        found = [r["token"] for r in self.like(term, distance).limit(MOST_TOKENS + 1).collect()]
        if len(found) <= MOST_TOKENS:
            return self._of("postings", "token", found).select(self.id).distinct()
        near = self.like(term, distance).select("token")
        return self._read("postings").join(broadcast_if_small(near), "token", "left_semi").select(self.id).distinct()


#: So many tokens are looked up by name; more are joined.
MOST_TOKENS = 1000


def _share(freq: Column, length: Column, average: float) -> Column:
    return freq / (freq + K1 * (1 - B + B * length / F.lit(average)))


def deletions(c: Column, count: int) -> Column:
    """The text and all that is left of it without up to `count` of its characters."""
    out = F.array(c)
    for _ in range(count):
        shorter = F.flatten(F.transform(out, _without_one))
        out = F.array_distinct(F.concat(out, shorter))
    return out


def _without_one(c: Column) -> Column:
    places = F.when(F.length(c) > 0, F.sequence(F.lit(1), F.length(c))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))


def distance(a: str, b: str) -> int:
    """Edits from a to b, where a swap of two neighbouring letters is one edit."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1]


def _compare(term: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(distance=[distance(term, t) for t in frame["token"]])

    return run
