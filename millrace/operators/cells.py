"""Wide-column tables kept as long cells (row_key, family, qualifier, value, ts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import csv_fields
from millrace.operators.joins import broadcast_if_small

CELL = ["row_key", "family", "qualifier"]


def to_cells(df: DataFrame, row_key: Column, columns: dict[str, tuple[str, str]], ts: Column) -> DataFrame:
    """One cell per row and column; ``columns`` maps a column to (family, qualifier)."""
    cells = F.array(
        *[
            F.struct(
                F.lit(family).alias("family"),
                F.lit(qualifier).alias("qualifier"),
                F.col(c).cast("string").alias("value"),
            )
            for c, (family, qualifier) in columns.items()
        ]
    )
    wide = df.select(row_key.alias("row_key"), cells.alias("__cells"), ts.alias("ts"))
    return wide.select("row_key", F.inline("__cells"), "ts").select(*CELL, "value", "ts")


def csv_to_cells(lines: DataFrame, line: str, family: str, names: list[str], ts: Column) -> DataFrame:
    """``key,a,b,...`` lines to one cell per field after the key."""
    fields = csv_fields(F.col(line), {n: "string" for n in ["row_key", *names]})
    df = lines.select(*fields, ts.alias("__ts"))
    return to_cells(df, F.col("row_key"), {n: (family, n) for n in names}, F.col("__ts"))


def latest(cells: DataFrame) -> DataFrame:
    """The newest version of each cell; combined map-side."""
    return cells.groupBy(*CELL).agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))


def keep_versions(cells: DataFrame, versions: int, tie: list[str] = ()) -> DataFrame:
    """At most n newest versions per cell; the rank limit is applied before the shuffle as well."""
    w = Window.partitionBy(*CELL).orderBy(F.desc("ts"), *[F.desc(c) for c in tie])
    ranked = cells.withColumn("version", F.row_number().over(w)).where(F.col("version") <= versions)
    return ranked.withColumn("version", F.col("version").cast("long"))


def update(cells: DataFrame, changes: DataFrame) -> DataFrame:
    """New versions are appended; readers resolve by time."""
    return latest(cells.unionByName(changes))


def delete(cells: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Tombstones (row_key, family, qualifier): null qualifier = family, both null = whole row."""
    whole = tombstones.where("family is null").select("row_key")
    family = tombstones.where("family is not null and qualifier is null").select(*CELL[:2])
    single = tombstones.where("family is not null and qualifier is not null").select(*CELL)
    out = cells
    for marks, on in ((whole, CELL[:1]), (family, CELL[:2]), (single, CELL)):
        out = out.join(broadcast_if_small(marks.distinct()), on, "left_anti")
    return out


def range_scan(cells: DataFrame, start: str, stop: str, family: str) -> DataFrame:
    """[start, stop) of one family: per row the newest values joined by comma, by qualifier.

    Versions are resolved map-side first, so what is gathered per row is its set of columns.
    """
    wanted = cells.where(
        (F.col("row_key") >= start) & (F.col("row_key") < stop) & (F.col("family") == family)
    )
    pairs = F.array_sort(F.collect_list(F.struct("qualifier", "value")))
    return (
        latest(wanted)
        .groupBy("row_key")
        .agg(F.array_join(F.transform(pairs, lambda p: p["value"]), ",").alias("vals"))
    )


def full_scan(cells: DataFrame) -> DataFrame:
    return latest(cells).select(*CELL, "value")


def point_get(cells: DataFrame, row_key: str) -> DataFrame:
    return latest(cells.where(F.col("row_key") == row_key)).select(*CELL, "value")


def row_key_matches(pattern: str) -> Column:
    """Regex on the row key; a pure prefix pattern becomes a startswith that reaches the scan."""
    if pattern.startswith("^") and pattern[1:].replace("_", "").replace("-", "").isalnum():
        return F.col("row_key").startswith(pattern[1:])
    return F.col("row_key").rlike(pattern)


def value_filter(
    cells: DataFrame, family: str, qualifier: str, value: str, filter_if_missing: bool = False
) -> DataFrame:
    """Whole rows whose cell equals value; rows without that cell pass unless filter_if_missing."""
    current = latest(cells).select(*CELL, "value")
    here = (F.col("family") == family) & (F.col("qualifier") == qualifier)
    deciding = latest(cells.where(here))
    if filter_if_missing:
        rows, how = deciding.where(F.col("value") == value), "left_semi"
    else:
        rows, how = deciding.where(~F.col("value").eqNullSafe(F.lit(value))), "left_anti"
    return current.join(rows.select("row_key"), "row_key", how)


def prefix_filter(cells: DataFrame, prefix: str) -> DataFrame:
    return cells.where(F.col("qualifier").startswith(prefix))


def all_filters(cells: DataFrame, family: str, qualifier: str, value: str, prefix: str) -> DataFrame:
    """Both filters must pass: row by value, then cells by qualifier prefix."""
    return prefix_filter(value_filter(cells, family, qualifier, value), prefix)


def copy_columns(cells: DataFrame, family: str, qualifiers: list[str]) -> DataFrame:
    return cells.where((F.col("family") == family) & F.col("qualifier").isin(*qualifiers))
