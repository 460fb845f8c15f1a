"""Token counts of documents in flat token files that have no index, only an end-of-document id after each document.

Files are read in blocks of equal size, by as many tasks as there are blocks. A block finds all its separators in one
array comparison and reports how many tokens it has before the first, between neighbours and after the last of them. A
prefix scan over the blocks of a file then tells each block how many documents ended before it and how many tokens of
the document that is open where it begins were already read. The scan has two levels, blocks within spans and spans
within a file, so that no task sees all blocks of a large file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.encoding import byte_tokenizer
from tidemark.llm.files import as_uri, new_file, read_range
from tidemark.llm.shared import folder, ship, written

BLOCK_BYTES = 8 << 20
SPAN_BLOCKS = 256


def write_token_files(
    docs: DataFrame, path: str, ranks: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text into flat files of 16-bit ids, ``end_id`` after each; one file for each task that has rows.

    Returns which document is which of its file: file, ordinal, doc_id. Null texts are empty, null ids stay null.
    """
    ship(docs.sparkSession)
    root = as_uri(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, name = byte_tokenizer(ranks), f"part-{pyspark.TaskContext.get().partitionId():06d}.ids"
        end, ordinal = np.array([end_id], "<u2").tobytes(), 0
        batches = w.slices(batches, "text")
        batch = next(batches, None)
        if batch is None:
            return
        with new_file(f"{root}/{name}") as file:
            while batch is not None:
                for text in batch["text"].to_pylist():
                    ids = encoder.encode_to_numpy(text or "", disallowed_special=())
                    file.write(ids.astype("<u2").tobytes() + end)
                numbers = pa.array(range(ordinal, ordinal + batch.num_rows), pa.int64())
                ordinal += batch.num_rows
                names = pa.array([name] * batch.num_rows)
                yield pa.RecordBatch.from_arrays([names, numbers, batch["doc_id"]], ["file", "ordinal", "doc_id"])
                batch = next(batches, None)

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    written_ids = docs.mapInArrow(encode, "file string, ordinal long, doc_id long")
    written_ids.write.parquet(f"{path}/_documents")
    return docs.sparkSession.read.schema(written_ids.schema).parquet(f"{path}/_documents")


def block_counts(spark: SparkSession, path: str, end_id: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each block of each file below ``path``: its tokens, separators, and the lengths around them.

    ``head`` counts the tokens before the first separator, ``tail`` those after the last; without a separator both
    count the whole block. ``inner`` has place and length of each document between neighbours.
    """
    ship(spark)
    root = as_uri(path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = row["block"] * block_bytes
                content = read_range(f"{root}/{row['file']}", start, min(block_bytes, row["length"] - start))
                ids = np.frombuffer(content, "<u2")
                ends = np.flatnonzero(ids == end_id)
                some = len(ends) > 0
                own = [
                    *(row["file"], row["block"], len(ids), len(ends)),
                    int(ends[0]) if some else len(ids),
                    int(len(ids) - 1 - ends[-1]) if some else len(ids),
                ]
                between = [pa.array(ends[:-1] + 1, pa.int64()), pa.array(np.diff(ends) - 1, pa.int64())]
                between = pa.StructArray.from_arrays(between, fields=list(kinds.field("inner").type.value_type))
                inner = pa.ListArray.from_arrays(pa.array([0, len(between)], pa.int32()), between)
                columns = [pa.array([x], kind) for x, kind in zip(own, kinds.types, strict=False)]
                yield pa.RecordBatch.from_arrays([*columns, inner], schema=kinds)

    kinds = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), *[(c, pa.int64()) for c in ("n_tokens", "n_ends", "head", "tail")]]
        + [("inner", pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())])))]
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(path).select("path", "length")
    blocks = files.where("length > 0").select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        "length",
        F.explode(F.sequence(F.lit(0), ((F.col("length") - 1) / block_bytes).cast("long"))).alias("block"),
    )
    scanned = blocks.repartition("file", "block").mapInArrow(
        scan, "file string, block long, n_tokens long, n_ends long, head long, tail long, inner array<struct<at: long, n: long>>"
    )
    return written(scanned, "blocks")


def _before(rows: DataFrame, within: list[str], by: str) -> DataFrame:
    """Adds what precedes each row of ``within``: documents ended, tokens, and the place after the last separator."""
    earlier = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("n_tokens", "n_ends")}
    )
    after_last = F.when(F.col("n_ends") > 0, F.col("n_tokens_before") + F.col("n_tokens") - F.col("tail"))
    return rows.withColumn("open_from", F.last(after_last, ignorenulls=True).over(earlier))


def document_counts(blocks: DataFrame, span_blocks: int = SPAN_BLOCKS) -> DataFrame:
    """file, ordinal, start (place of its first token in the file), n_tokens (without the separator) and whether it ended.

    What follows the last separator of a file is a document that did not end; nothing there is no document.
    """
    blocks = blocks.withColumn("span", F.floor(F.col("block") / span_blocks))
    inside = _before(blocks, ["file", "span"], "block")
    last_end = F.max(F.when(F.col("n_ends") > 0, F.col("n_tokens_before") + F.col("n_tokens") - F.col("tail")))
    spans = inside.groupBy("file", "span").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_ends").alias("n_ends"), last_end.alias("last_end")
    )
    spans = spans.withColumn("tail", F.col("n_tokens") - F.coalesce("last_end", F.lit(0)))
    spans = _before(spans, ["file"], "span").select(
        "file", "span",
        F.col("n_tokens_before").alias("span_tokens"), F.col("n_ends_before").alias("span_ends"),
        F.coalesce("open_from", F.lit(0)).alias("span_open"),
    )
    placed = inside.join(spans, ["file", "span"]).withColumns(
        {
            "begin": F.col("span_tokens") + F.col("n_tokens_before"),
            "ordinal": F.col("span_ends") + F.col("n_ends_before"),
            "open": F.coalesce(F.col("span_tokens") + F.col("open_from"), F.col("span_open")),
        }
    )
    # documents that end in the block: the one open at its begin, then those between its separators
    first = F.struct((F.col("begin") - F.col("open") + F.col("head")).alias("n"), F.col("open").alias("start"))
    ended = placed.where("n_ends > 0").withColumn("first", first)
    opened = ended.select("file", "ordinal", F.col("first.start").alias("start"), F.col("first.n").alias("n_tokens"))
    within = ended.select("file", "ordinal", "begin", F.posexplode("inner").alias("i", "doc")).select(
        "file", (F.col("ordinal") + F.col("i") + 1).alias("ordinal"), (F.col("begin") + F.col("doc.at")).alias("start"), "doc.n"
    )
    at_end = Window.partitionBy("file").orderBy(F.col("block").desc())
    last = placed.withColumn("back", F.row_number().over(at_end)).where("back = 1")
    size = F.col("begin") + F.col("n_tokens")
    start = F.when(F.col("n_ends") > 0, size - F.col("tail")).otherwise(F.col("open"))
    rest = last.select(
        "file", (F.col("ordinal") + F.col("n_ends")).alias("ordinal"), start.alias("start"), (size - start).alias("n_tokens")
    ).where("n_tokens > 0")
    return opened.union(within).withColumn("ended", F.lit(True)).union(rest.withColumn("ended", F.lit(False)))


def token_counts(
    docs: DataFrame, ranks: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, file, ordinal, start, n_tokens of every row of ``docs``, counted in the files that it is written to.

    Null and empty texts have no tokens. Repeated rows are documents of their own, each with its place; null ids stay
    null. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = folder(spark, "token-files")
    named = write_token_files(docs, path, ranks, end_id, id_col, text_col)
    if named.isEmpty():
        return spark.createDataFrame([], "doc_id long, file string, ordinal long, start long, n_tokens long")
    counts = document_counts(block_counts(spark, path, end_id))
    return named.join(counts, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
