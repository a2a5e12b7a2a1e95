"""Search-style predicates, paging and highlighting over document tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.operators.joins import broadcast_if_small


def term(field: str, value) -> Column:
    """Exact value of a keyword or number."""
    return F.col(field) == F.lit(value)


def text_term(field: str, token: str) -> Column:
    """One token of analyzed text; the plain substring test spares most texts the splitting."""
    return F.lower(F.col(field)).contains(token) & F.array_contains(tokens(F.col(field)), token)


def match(field: str, query: str) -> Column:
    """Any token of the query occurs in the analyzed text."""
    return F.arrays_overlap(tokens(F.col(field)), tokens(F.lit(query)))


def in_range(field: str, gte=None, lt=None) -> Column:
    bounds = []
    if gte is not None:
        bounds.append(F.col(field) >= F.lit(gte))
    if lt is not None:
        bounds.append(F.col(field) < F.lit(lt))
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def fuzzy(field: str, query: str, distance: int = 2) -> Column:
    """Some token is within the edit distance (a transposition costs 2)."""
    return F.exists(
        tokens(F.col(field)), lambda t: F.levenshtein(t, F.lit(query), distance) >= F.lit(0)
    )


def bool_query(
    must: list[Column] = (),
    must_not: list[Column] = (),
    should: list[Column] = (),
    minimum_should: int | None = None,
) -> Column:
    """All of must, none of must_not, and enough of should (one, if there is no must)."""
    parts = [*must, *[~c for c in must_not]]
    needed = minimum_should if minimum_should is not None else (0 if must or not should else 1)
    if needed == 1:
        parts.append(reduce(lambda a, b: a | b, should))
    elif needed > 1:
        hits = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(False)).cast("int") for c in should])
        parts.append(hits >= needed)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def source_filter(df: DataFrame, includes: list[str] = (), excludes: list[str] = ()) -> DataFrame:
    names = [c for c in df.columns if (not includes or c in includes) and c not in excludes]
    return df.select(*names)


def highlight(field: str, query: str, pre: str = "<em>", post: str = "</em>") -> Column:
    """The field's text with each match of the term wrapped; the case of the text is kept.

    A term ends where a token ends: at a border of letters and digits, or at an ideograph.
    """
    ideograph = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"
    before = rf"(?:\b|(?<={ideograph})|(?={ideograph}))"
    after = rf"(?:\b|(?={ideograph})|(?<={ideograph}))"
    safe = [part.replace("\\", "\\\\").replace("$", "\\$") for part in (pre, post)]
    return F.regexp_replace(
        F.col(field), rf"(?i){before}({re.escape(query)}){after}", f"{safe[0]}$1{safe[1]}"
    )


#: Rows that a page by offset may reach; they are gathered at the driver.
DEEPEST = 10_000


def page(df: DataFrame, order: list[Column], offset: int, size: int = 10) -> DataFrame:
    """Rows offset .. offset + size - 1 of a total order (top-k, not a full sort).

    Beyond `DEEPEST` rows it refuses; `page_after` goes on from a key at any depth.
    """
    if offset + size > DEEPEST:
        raise ValueError(f"a page by offset reaches {DEEPEST} rows at most; use page_after")
    return df.orderBy(*order).offset(offset).limit(size)


def page_with_total(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page plus the number of hits over all pages."""
    rows = page(df, order, number * size, size)
    return with_total(rows, df)


def with_total(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Each row also tells how many hits there are in all, by a scalar subquery."""
    return rows.withColumn("total_hits", hits.agg(F.count(F.lit(1))).scalar())


def page_after(df: DataFrame, key: str, last_key, size: int) -> DataFrame:
    """Deep paging by key: the filter is pushed down, nothing before it is read or sorted."""
    return df.where(F.col(key) > F.lit(last_key)).orderBy(key).limit(size)


def index_documents(base: DataFrame, writes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Full replace by id: of all writes of an id the last one stands."""
    rest = [c for c in base.columns if c != key]
    row = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    latest = writes.groupBy(key).agg(row).select(key, *[F.col(f"__row.{c}") for c in rest])
    kept = base.join(_keys(latest, key), key, "left_anti")
    return kept.unionByName(latest)


def update_documents(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Partial update: the patch's non-null fields replace the stored ones.

    Two patches of one id are an error, as nothing tells which of them is the last.
    """
    fields = [c for c in patch.columns if c != key]
    clash = F.raise_error(F.concat(F.lit("several patches of id "), F.col(key).cast("string")))
    once = patch.where(F.col(key).isNotNull()).groupBy(key).agg((F.count("*") > 1).alias("__many"), *[F.first(c).alias(c) for c in fields])
    checked = F.when(F.col("__many"), clash.cast(patch.schema[key].dataType)).otherwise(F.col(key)).alias(key)
    renamed = once.select(checked, *[F.col(c).alias(f"__p_{c}") for c in fields])
    out = base.join(broadcast_if_small(renamed), key, "left")
    return out.withColumns({c: F.coalesce(F.col(f"__p_{c}"), F.col(c)) for c in fields}).drop(
        *[f"__p_{c}" for c in fields]
    )


def delete_documents(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return base.join(_keys(ids, key), key, "left_anti")


def get_documents(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Many point gets in one pass."""
    return base.join(_keys(ids, key), key, "left_semi")


def _keys(df: DataFrame, key: str) -> DataFrame:
    return broadcast_if_small(df.select(key).distinct())
