"""Document fingerprints: a Merkle tree over sections, paragraphs and their pieces.

Sections end at blank lines, paragraphs at line ends, and a paragraph is cut into pieces of `PIECE`
code points, the leaves. Every node is a SHA-256: of the piece, of the digests of a paragraph's leaves, of
those of a section's paragraphs, and the root of those of all sections. So roots are equal for equal texts
only. The fingerprint is written `root|sections|leaves` and names sections by the first 16 and leaves by
the first 12 hex digits; leaves are separated by `,` in a paragraph, `/` between paragraphs, `;` between
sections. Where roots differ, differing sections and paragraphs locate the edit.

Everything is built-in column functions. Null is the empty text. The document after a given one
is the next smaller id (rows without id come last, equal ids by their text); after the last comes
the first, and a single row is followed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.ranges import range_of

PIECE = 32
#: Hex digits of a leaf's and of a section's name.
LEAF, SECTION = 12, 16
BUCKET_BYTES = 16 << 20
#: Beyond a terabyte, buckets grow: 1.6 GB at 100 TB.
MOST_BUCKETS = 1 << 16
_LEAST_KEY = -(1 << 63)


def fingerprint(text: Column, piece: int = PIECE) -> Column:
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    joined = lambda digests: sha(F.array_join(digests, ","))

    def leaves(paragraph: Column) -> Column:
        return F.transform(F.regexp_extract_all(paragraph, F.lit(f"(?s).{{1,{piece}}}"), F.lit(0)), sha)

    tree = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n\n", -1),
        lambda section: F.transform(F.split(section, "\n", -1), leaves),
    )
    names = lambda paragraph: F.array_join(F.transform(paragraph, lambda d: F.substring(d, 1, LEAF)), ",")

    def written(found: Column, sections: Column) -> Column:
        own = F.array_join(F.transform(sections, lambda d: F.substring(d, 1, SECTION)), ",")
        lines = F.array_join(F.transform(found, lambda s: F.array_join(F.transform(s, names), "/")), ";")
        return F.concat(joined(sections), F.lit("|"), own, F.lit("|"), lines)

    # each step stands behind a one-element array, so that it is computed once
    nodes = lambda found: F.transform(found, lambda s: joined(F.transform(s, joined)))
    both = F.transform(F.array(tree), lambda found: F.struct(found.alias("tree"), nodes(found).alias("sections")))
    return F.transform(both, lambda b: written(b["tree"], b["sections"]))[0]


def _leaves(print_: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.substring_index(print_, "|", -1), "[,/;]"), lambda x: x != ""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the share of leaves that the two have in common; 0 if neither has leaves."""
    x, y = _leaves(a), _leaves(b)
    common = F.size(F.array_intersect(x, y)).cast("double")
    equal = F.substring_index(a, "|", 1) == F.substring_index(b, "|", 1)
    return F.when(equal, 1.0).otherwise(2 * common / F.greatest(F.size(x) + F.size(y), F.lit(1)))


def edited_paragraphs(old: Column, new: Column) -> Column:
    """Places (section * 2**20 + paragraph) in the new text of paragraphs that no section of the old has."""
    known = F.split(F.substring_index(old, "|", -1), "[/;]")
    sections = F.split(F.substring_index(new, "|", -1), ";")

    def inside(section: Column, i: Column) -> Column:
        own = F.transform(F.split(section, "/"), lambda p, j: F.when(~F.array_contains(known, p), i * (1 << 20) + j))
        return F.filter(own, lambda p: p.isNotNull())

    return F.flatten(F.transform(sections, inside))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fp and the text and fp of the following document, in falling order of id.

    Documents are dealt to ranges of ids. Each range also gets the first document of the range after
    it, as a guest at its end, so that every document finds its successor in its own range.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("key", F.coalesce("doc_id", F.lit(_LEAST_KEY)))
    n_bytes = base.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = int(min(MOST_BUCKETS, max(32, n_bytes // BUCKET_BYTES)))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = base.select(F.percentile_approx("key", shares, max(10_000, 10 * buckets)).alias("cuts")).first()["cuts"] or []
    placed = base.withColumn("bucket", range_of([(c,) for c in sorted(set(cuts))], "key"))

    tops = placed.groupBy("bucket").agg(F.max("key").alias("key"))  # one row per bucket
    falling = Window.orderBy(F.desc("bucket"))
    before = F.coalesce(F.lag("bucket").over(falling), F.min("bucket").over(Window.partitionBy(F.lit(0))))
    hosts = tops.select("bucket", "key", before.alias("host"))
    first_texts = placed.join(F.broadcast(hosts), ["bucket", "key"]).groupBy("host").agg(F.min("text").alias("text"))
    guests = first_texts.select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.lit(_LEAST_KEY).alias("key"), F.col("host").alias("bucket"), F.lit(1).alias("guest"))

    rows = placed.withColumn("guest", F.lit(0)).unionByName(guests).withColumn("fp", fingerprint(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("key"), "text")
    follows = rows.select("doc_id", "text", "fp", "guest", F.lead("text").over(order).alias("next_text"), F.lead("fp").over(order).alias("next_fp"))
    return follows.where("guest = 0").drop("guest")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose last third the next document overwrites."""
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = with_next(docs).withColumn("edited", edited).withColumn("edited_fp", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
