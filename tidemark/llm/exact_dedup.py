"""Exact duplicate removal that splits frequent texts from the rest.

Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the row with the
largest id stays (a null id counts as smallest; of rows repeated with the same id, one stays).

1. The digests of all texts are written once: 32 bytes a row from here on.
2. A Misra-Gries summary (``approx_top_k``: a frequent-items sketch of that family, of fixed size and merged from all
   tasks) names digests that may be frequent. It finds every digest with a share over some 4 / TRACKED of the rows.
3. The candidates are counted exactly; at most CANDIDATES winners, with the id that stays, are broadcast. Their rows
   get their answer in place and are never shuffled.
4. The other digests are shuffled as usual; none of them can hold more than that small share.

The sketch decides only which way a row takes, never its answer. All steps are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import partitions, written

TRACKED = 2_000
CANDIDATES = 500
MERGED = 64
STEP = 100_000  # copies of one row that are written out in one step

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, as hexadecimal digits."""
    text = F.coalesce(text, F.lit(""))
    one_byte_each = F.octet_length(text) == F.length(text)  # then lower() changes A-Z only
    return F.sha2(F.when(one_byte_each, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)).cast("binary"), 256)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text_sha256`` of each row, written to the shared folder."""
    return written(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("text_sha256")), "digests"
    )


def frequent(table: DataFrame) -> DataFrame:
    """Frequent digests of a written digest table with their exact group size and the id that stays."""
    sketches = (
        table.select(F.xxhash64("text_sha256").alias("item"), (F.spark_partition_id() % MERGED).alias("tasks"))
        .groupBy("tasks")
        .agg(F.expr(f"approx_top_k_accumulate(item, {TRACKED})").alias("sketch"))
        .groupBy(F.lit("all"))  # a key, so that an empty table gives no row
        .agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    )
    candidates = sketches.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {CANDIDATES})")).alias("top"))
    return (
        table.withColumn("item", F.xxhash64("text_sha256"))
        .join(F.broadcast(candidates.select("top.item")), "item", "left_semi")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        .where(F.col("group_size") > 1)
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    An empty table gives an empty result. Columns other than the two named ones are not read. Rows repeated with one id are
    rows each, of which one stays.
    """
    table = digests(docs, id_col, text_col)
    winners = written(frequent(table), "frequent")

    light = table.join(F.broadcast(winners), "text_sha256", "left_anti")
    group = Window.partitionBy("text_sha256")
    light = light.withColumns(
        {
            "keep_id": F.max("doc_id").over(group),
            "group_size": F.count("*").over(group),
            "rank": F.row_number().over(group.orderBy(F.col("doc_id").desc_nulls_last())),
        }
    ).withColumn("kept", F.col("rank") == 1)

    heavy = table.join(F.broadcast(winners), "text_sha256")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    dropped = heavy.where(~stays).withColumn("kept", F.lit(False))
    # normally one row for each digest; rows repeated with that id are counted and written out again, in steps of bounded
    # size that are dealt over all tasks
    repeated = heavy.where(stays).groupBy("doc_id", "keep_id", "group_size", "text_sha256").agg(F.count("*").alias("n"))
    last_step = F.floor((F.col("n") - 1) / STEP).cast("long")
    steps = repeated.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), last_step)))
    steps = steps.repartition(partitions(docs.sparkSession), "text_sha256", "step")
    left = F.least(F.col("n") - F.col("step") * STEP, F.lit(STEP)).cast("int")
    last = steps.select("*", F.posexplode(F.array_repeat(F.lit(True), left)).alias("i", "copy"))
    last = last.withColumn("kept", (F.col("step") == 0) & (F.col("i") == 0))

    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return light.select(columns).unionByName(dropped.select(columns)).unionByName(last.select(columns))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names."""
    winners = written(frequent(digests(docs, id_col, text_col)), "frequent")
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(every.alias("row"), F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"))
    losers = F.broadcast(winners.select(F.col("text_sha256").alias("digest"), F.col("keep_id")))
    rows = rows.join(losers, "digest", "left").where(
        F.col("keep_id").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    )
    # the rank filter becomes a group limit ahead of the shuffle
    best = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("row"))
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == 1).select("row.*")
