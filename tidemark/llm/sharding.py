"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Rows of each source are shuffled by a seeded hash and ranked; row r of n gets the fraction
(2r - 1) / 2n. In the order of fractions the sources are interleaved in proportion, so every
stretch of that order holds the corpus' mixture. The order is cut into shards whose row
counts differ by one at most.

Ranks are found without ordering a source, or everything, in one task: rows fall into many
cells by hash (then by fraction), a small table of cell counts gives what lies before a
cell, and rows are numbered within their cell only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

#: Rows a cell holds on average, at most.
CELL_ROWS = 20_000
#: Hash bits that order a source; the rest of the order comes from a second hash and the id.
_BITS = 40


def _hash(*parts: Column) -> Column:
    """60 bits of SHA-256, as a number that SQL can compute as well."""
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _number(rows: DataFrame, strata: list[str], cell: Column, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name``: 1, 2, ... along ``cell`` and ``order`` within each stratum."""
    rows = rows.withColumn("_cell", cell)
    counts = rows.groupBy(*strata, "_cell").agg(F.count("*").alias("_n"))
    # Cells are some thousands of times fewer than rows; still a running sum over runs of
    # cells first, so that no task orders all cells of a large stratum.
    counts = counts.withColumn("_run", F.col("_cell").bitwiseAND(F.lit(~1023)))
    runs = counts.groupBy(*strata, "_run").agg(F.sum("_n").alias("_run_n"))
    before = Window.partitionBy(*strata).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_run_before", F.coalesce(F.sum("_run_n").over(before), F.lit(0))).drop("_run_n")
    before = Window.partitionBy(*strata, "_run").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.withColumn("_in_run", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(
        runs, [*strata, "_run"]
    )
    cells = cells.select(*strata, "_cell", (F.col("_run_before") + F.col("_in_run")).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*strata, "_cell").orderBy(*order))
    return (
        rows.withColumn("_within", within)
        .join(cells, [*strata, "_cell"])
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_cell", "_before", "_within")
    )


def interleaved_shards(
    docs: DataFrame,
    n_shards: int = 16,
    seed: str = "interleave-1",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus one, ``text_crc32`` that of its bytes; a null
    text counts as an empty one. A null source is a source of its own. Rows that repeat an
    id follow each other by size and checksum; wholly equal rows are interchangeable, so
    numbering them either way gives the same result. With fewer rows than shards the later
    shards are empty, and an empty table gives no rows. Other columns are not read.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(source), F.lit("")).alias("_source"),
        F.col(source).isNull().alias("_no_source"),
        (F.octet_length(content).cast("long") + 1).alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("_h", _hash(key, F.col("size"), F.col("text_crc32")))
    rows = stored(rows, "shard-rows")
    strata = ["_source", "_no_source"]
    totals = rows.groupBy(*strata).agg(F.count("*").alias("_total"))
    n_rows = rows.count()
    cells = max(1, -(-n_rows // CELL_ROWS))
    cell = F.floor(F.col("_h") / F.lit((1 << 60) / cells)).cast("long")
    ties = [F.col(c).asc_nulls_first() for c in ("_h", "doc_id", "size", "text_crc32")]
    ranked = _number(rows, strata, cell, ties, "_rank").join(totals, strata)
    # The fraction decides the cell; within it exact fractions are compared as doubles of
    # the same division in every engine, and ties go to the source.
    ranked = ranked.withColumn("_fraction", (F.col("_rank") - 0.5) / F.col("_total"))
    cell = F.floor(F.col("_fraction") * cells).cast("long")
    order = [F.col("_fraction"), F.col("_no_source"), F.col("_source")]
    placed = _number(ranked, [], cell, order, "_place").withColumn("_place", F.col("_place") - 1)
    # The first n mod k shards hold one row more.
    small, extra = divmod(n_rows, n_shards)
    edge = extra * (small + 1)
    place = F.col("_place")
    shard = F.when(place < edge, F.floor(place / (small + 1))).otherwise(
        extra + F.floor((place - edge) / max(small, 1))
    )
    start = F.when(F.col("shard") < extra, F.col("shard") * (small + 1)).otherwise(
        edge + (F.col("shard") - extra) * small
    )
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        F.when(~F.col("_no_source"), F.col("_source")).alias("source"),
        "size",
        "text_crc32",
        "shard",
        (place - start).cast("long").alias("slot"),
    )
