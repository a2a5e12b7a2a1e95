"""The registered queries: each applies its operator to the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontam, hard_negatives, html_main, merkle, ngram_join, periodic, quality, secrets, shards, substrings, suffixes, token_counts
from millrace.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontamination(spark, sf):
    return decontam.contamination(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


ORACLES["op1_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS s
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(p) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT * FROM d CROSS JOIN lengths), unnest(range(1, len(w) - n + 2)) AS t(p)),
met AS (SELECT doc_id, p, n, item_id FROM doc_windows JOIN item_windows USING (n, s)),
places AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM met, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query
def op2_sharding(spark, sf):
    return shards.assign(load(spark, sf, "documents"))


@query
def op3_token_counts(spark, sf):
    """Counts before and after an edit: in the middle, up to 40 characters give way to the text's first ones."""
    half = F.floor(F.length("text") / 2).cast("int")
    change = F.struct(half.alias("start"), F.lit(40).alias("length"), F.substring("text", 1, 40).alias("replacement"))
    docs = load(spark, sf, "documents").withColumn("edits", F.array(change))
    columns = ("doc_id", "n_tokens", "edited_tokens", "edited_chars", "encoded_chars")
    return token_counts.recount(token_counts.build_trees(docs), columns=columns)


@query
def op4_substring_dedup(spark, sf):
    return substrings.remove_repeats(load(spark, sf, "documents"), with_text=False)


ORACLES["op4_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, hash(array_to_string(w[i:i + 49], ' ')) AS h
  FROM words, unnest(range(1, len(w) - 48)) AS t(i)),
late AS (
  SELECT doc_id, i FROM windows JOIN (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h) USING (h)
  WHERE doc_id > first_doc),
covered AS (SELECT DISTINCT doc_id, p FROM late, unnest(range(i, i + 50)) AS t(p)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w[p], ' ' ORDER BY p) AS k
  FROM (SELECT doc_id, w, p FROM words, unnest(range(1, len(w) + 1)) AS t(p)) ANTI JOIN covered USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""


@query
def op5_ngram_jaccard_join(spark, sf):
    return ngram_join.near_duplicates(load(spark, sf, "documents"))


ORACLES["op5_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
meets AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM meets JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least_id AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_id USING (doc_id)"""


@query
def op6_quality_resampling(spark, sf):
    """The documents that are kept."""
    docs = load(spark, sf, "documents").select("doc_id", "text")
    model = quality.fit(docs, load(spark, sf, "labels"))
    return quality.resample(docs, model).select("doc_id", "weight", "n_grams", "gumbel")


@query
def op7_bpe(spark, sf):
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode(load(spark, sf, "documents"), columns=columns)


@query
def op8_html_extraction(spark, sf):
    return html_main.main_text(load(spark, sf, "pages"))


@query
def op9_secret_scan(spark, sf):
    return secrets.scan(load(spark, sf, "documents"))


@query
def op10_merkle_fingerprint(spark, sf):
    return merkle.compare_edits(load(spark, sf, "documents"))


ORACLES["op10_merkle_fingerprint"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (
  SELECT doc_id, text, length(text) // 3 AS k,
    coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text FROM d WINDOW w AS (ORDER BY doc_id DESC, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, substr(text, 1, length(text) - k) || substr(next_text, 1, k) AS edited FROM n),
texts AS (SELECT DISTINCT t FROM (SELECT text AS t FROM e UNION ALL SELECT edited FROM e)),
trees AS (
  SELECT t, list_transform(string_split(t, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
    lambda p: list_transform(regexp_extract_all(p, '(?s).{1,32}'), lambda x: sha256(x)))) AS tree
  FROM texts),
nodes AS (
  SELECT t, list_transform(tree, lambda s: sha256(array_to_string(list_transform(s,
      lambda p: sha256(array_to_string(p, ','))), ','))) AS sections,
    list_transform(tree, lambda s: array_to_string(list_transform(s,
      lambda p: array_to_string(list_transform(p, lambda d: d[1:12]), ',')), '/')) AS lines
  FROM trees),
prints AS (
  SELECT t, sha256(array_to_string(sections, ',')) || '|' ||
      array_to_string(list_transform(sections, lambda d: d[1:16]), ',') || '|' || array_to_string(lines, ';') AS fp,
    list_distinct(list_filter(string_split_regex(array_to_string(lines, ';'), '[,/;]'), lambda x: x <> '')) AS leaves
  FROM nodes)
SELECT doc_id, length(e.text) AS n_chars, sha256(edited) AS edited_sha256, a.fp AS fingerprint,
  b.fp AS edited_fingerprint,
  CASE WHEN a.fp = b.fp THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect(a.leaves, b.leaves)) / (len(a.leaves) + len(b.leaves)) END AS near_edited,
  CASE WHEN a.fp = c.fp THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect(a.leaves, c.leaves)) / (len(a.leaves) + len(c.leaves)) END AS near_next
FROM e JOIN prints a ON a.t = e.text JOIN prints b ON b.t = e.edited JOIN prints c ON c.t = e.next_text"""


@query
def op11_hard_negatives(spark, sf):
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label")
    vectors = load(spark, sf, "embeddings").select("vec_id", "embedding", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


ORACLES["op11_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q,
    CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3"""


@query
def op13_periodic_runs(spark, sf):
    """Every tenth text, by a hash of its id, is first made periodic from a word on that the hash names."""
    text, ident = F.coalesce("text", F.lit("")), F.col("doc_id").cast("string")
    w, h = F.col("w"), F.crc32(ident)
    n, g = F.size("w"), F.floor(h / 10)
    begin = F.pmod(g, n)
    period = 1 + F.floor((n - begin) / (3 + F.pmod(g, F.lit(8))))
    source = lambda i: F.when(i < begin, i).otherwise(begin + F.pmod(i - begin, period)).cast("int")
    changed = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, source(i))), " ")
    docs = load(spark, sf, "documents").select("doc_id", text.alias("text"), (F.pmod(h, F.lit(10)) == 0).alias("chosen"))
    cut = F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    docs = docs.withColumn("w", cut).select("doc_id", F.when(F.col("chosen") & (n > 0), changed).otherwise(F.col("text")).alias("text"))
    return periodic.report(periodic.find_runs(docs, with_text=False))


@query
def op12_suffix_dedup(spark, sf):
    return suffixes.remove_repeats(load(spark, sf, "documents")).drop("spans")


ORACLES["op12_suffix_dedup"] = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, p, hash(b[p:p + 399]) AS h FROM d, unnest(range(1, octet_length(b) - 398)) AS t(p)),
again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
s AS (
  SELECT doc_id, p, sum(apart) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, CAST(coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400, true) AS INTEGER) AS apart
    FROM w SEMI JOIN again USING (h))),
spans AS (SELECT doc_id, min(p) AS low, max(p) + 399 AS high FROM s GROUP BY doc_id, run),
ends AS (
  SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) + 1 AS a, low - 1 AS z FROM spans
  UNION ALL SELECT doc_id, max(high) + 1, NULL FROM spans GROUP BY doc_id),
kept AS (
  SELECT doc_id, unhex(string_agg(hex(b[a:coalesce(z, octet_length(b))]), '' ORDER BY a)) AS k
  FROM ends JOIN d USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(high - low + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(coalesce(k, b)) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""
