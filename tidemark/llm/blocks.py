"""A table of short texts (benchmark items, queries) handed to all tasks in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 64 << 20  # of text that is broadcast at once


def text_blocks(items: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, str]]]:
    """The distinct rows (id as text, text) without null texts, in blocks of some ``most`` bytes, dealt by a hash.

    The size is summed first: the number of blocks follows from it, so no block grows with the table. An empty table gives one
    empty block.
    """
    rows = items.select(F.col("id").cast("string").alias("id"), "text").where("text is not null").distinct()
    n_bytes = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n_blocks = -(-n_bytes // most) or 1
    for block in range(n_blocks):
        here = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == block)
        yield sorted(((r.id, r.text) for r in here.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))
