"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import written

SAMPLE = 20_000  # labelled documents at most, whatever the number of labels


def known(labels: DataFrame, columns: list[str], usable: Column) -> DataFrame:
    """One row for each labelled id that ``usable`` lets through, with the largest label of each of ``columns``; no nulls."""
    rows = labels.where(usable).select("doc_id", *columns).dropna()
    return rows.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns])


def one_of(column: str, text_hash: str | Column) -> Column:
    """Of the rows that share an id, ``column`` of the one with the smallest hash of its text."""
    return F.min_by(column, F.struct(text_hash, column)).alias(column)


def sample(
    docs: DataFrame, labels: DataFrame, columns: list[str], usable: Column, most: int = SAMPLE, name: str = "labelled"
) -> DataFrame:
    """``doc_id``, ``text`` and the label columns of at most ``most`` documents, drawn by a hash of their ids.

    ``usable`` is a condition on the labels. Labels with a null id or a null in ``columns`` are left out; an id with
    several different labels keeps its largest; documents without a label are no part of it. Of the rows that share an
    id one stands for all, that with the smallest hash of its text.
    """
    drawn = written(known(labels, columns, usable).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), f"{name}-drawn")
    # at most ``most`` ids: small enough for a broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    one = one_of("text", F.xxhash64("text"))  # combined before the shuffle
    return written(rows.groupBy("doc_id", *columns).agg(one).select("doc_id", "text", *columns), name)
