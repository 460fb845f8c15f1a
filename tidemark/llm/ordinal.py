"""Toxicity as expected severity, by a cumulative-link ordinal regression on sparse text features.

Grades are 0, 1, ..., K. The probability of at most grade k is the logistic function of theta_k - w . x: one vector of
weights for all grades, and ordered thresholds. The expected severity is the sum over k of the probability of a grade
above k. A feature is the logarithm of one plus the count of a word, or of longer words with a common beginning, that
tells labelled toxic from other documents apart; words here are runs of letters, so marks and capitals around one do not
hide it. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm import words as w
from tidemark.llm.ranking import logistic
from tidemark.llm.shared import crc_remainder, ship

VOCABULARY = 4_096  # words with the largest difference; each with a z of at least LEAST_Z
LEAST_Z = 4.0
MARKER = np.log(10)
CUTS = (2, 4)  # markers in a toxic document from which its grade is 2, and 3
TOXIC_FROM = 0.3  # probability of a grade above 0; to miss a toxic document is worse than to report a clean one

BEGINNINGS = (6, 7, 8, 9, 10)  # bytes of the beginnings of longer words

LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def letter_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs of letters (ASCII letters and all bytes of other characters), and how many each text has."""
    data, offsets = w.text_bytes(texts)
    keep = LETTER[data]
    begins = keep.copy()
    begins[1:] &= ~keep[:-1]
    begins |= keep & w.text_starts(offsets, len(data))
    return w.pieces(w.LOWER[data], offsets, begins, keep)


def terms(distinct: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Places of words and the terms that they count for: the word itself, and its beginnings, marked by a star."""
    yield np.arange(len(distinct)), distinct
    size = pc.binary_length(distinct).to_numpy(zero_copy_only=False) if len(distinct) else np.zeros(0, np.int32)
    for k in BEGINNINGS:
        longer = np.flatnonzero(size > k)
        if len(longer):
            beginnings = pc.binary_slice(distinct.take(pa.array(longer)), 0, k)
            yield longer, pc.binary_join_element_wise(beginnings, pa.scalar(b"*"), pa.scalar(b""))


def word_counts(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the vocabulary's terms, as places."""
    found, counts = letter_runs(texts)
    numbers, distinct = w.coded(found)
    owner, width, cells = np.repeat(np.arange(len(texts)), counts), max(1, len(vocabulary)), []
    for places, names in terms(distinct):
        known = np.full(len(distinct), -1, np.int64)
        known[places] = pc.fill_null(pc.index_in(names, vocabulary), -1).to_numpy(zero_copy_only=False)
        term = known[numbers] if len(numbers) else known
        hit = term >= 0
        cells.append(owner[hit] * width + term[hit])
    cell, count = np.unique(np.concatenate(cells), return_counts=True)
    return cell // width, cell % width, count


@dataclass
class Severity:
    vocabulary: list[bytes]
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade but the highest

    def above(self, texts: pa.Array) -> np.ndarray:
        """Probability of a grade above 0, above 1, ...: one row for each text."""
        text, word, count = word_counts(texts, pa.array(self.vocabulary, pa.binary()))
        linear = np.bincount(text, self.weights[word] * np.log1p(count), minlength=len(texts))
        return logistic(linear[:, None] - self.thresholds[None])


def fit_thresholds_and_weights(
    doc: np.ndarray, word: np.ndarray, value: np.ndarray, grade: np.ndarray, words: int,
    ridge: float = 1e-4, steps: int = 400, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the mean log-likelihood; the thresholds' gaps are exponentials."""
    grades = int(grade.max(initial=0))
    if grades == 0:
        return np.zeros(words), np.array([9.0])  # nothing toxic was seen
    share = np.array([np.mean(grade > k) for k in range(grades)]).clip(1e-4, 1 - 1e-4)
    start = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    p = np.concatenate([np.zeros(words), start[:1], gaps])
    mean, square = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        weights, gap = p[:words], np.exp(p[words + 1 :])
        theta = p[words] + np.concatenate([[0], np.cumsum(gap)])
        linear = np.bincount(doc, weights[word] * value, minlength=len(grade))
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = logistic(edges[grade + 1] - linear), logistic(edges[grade] - linear)
        inside = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / inside, lower * (1 - lower) / inside
        d_linear = (d_upper - d_lower) / len(grade)  # of the loss
        d_theta = np.zeros(grades + 2)
        np.add.at(d_theta, grade + 1, -d_upper / len(grade))
        np.add.at(d_theta, grade, d_lower / len(grade))
        d_theta = d_theta[1:-1]
        tail = np.cumsum(d_theta[::-1])[::-1]
        d_weights = np.bincount(word, value * d_linear[doc], minlength=words) + ridge * weights
        gradient = np.concatenate([d_weights, tail[:1], tail[1:] * gap])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        p = p - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return p[:words], p[words] + np.concatenate([[0], np.cumsum(np.exp(p[words + 1 :]))])


def telling_terms(chosen: DataFrame, column: str) -> list[tuple[bytes, float, float]]:
    """Terms with the largest |z| between the shares of documents with ``column`` > 0 and of others that have them.

    With each its z and the logarithm of the ratio of the two shares.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.slices(batches, "text"):
            found, per_text = letter_runs(batch["text"])
            numbers, distinct = w.coded(found)
            owner = np.repeat(np.arange(batch.num_rows), per_text)
            marked_text = batch[column].to_numpy(zero_copy_only=False) > 0
            for places, names in terms(distinct):
                coded = names.dictionary_encode()
                code = np.full(len(distinct), -1, np.int64)
                code[places] = coded.indices.to_numpy()
                size, of_word = max(1, len(coded.dictionary)), code[numbers] if len(numbers) else code
                cell = np.unique(owner[of_word >= 0] * size + of_word[of_word >= 0])
                marked = marked_text[cell // size]
                split = [np.bincount(cell[x] % size, minlength=len(coded.dictionary)) for x in (marked, ~marked)]
                columns = [coded.dictionary, *[pa.array(x, pa.int64()) for x in split]]
                yield pa.RecordBatch.from_arrays(columns, ["word", "marked", "other"])

    size = chosen.agg(F.count_if(F.col(column) > 0).alias("marked"), F.count_if(F.col(column) <= 0).alias("other")).first()
    if not size.marked or not size.other:
        return []
    p, q = F.col("marked") / size.marked, F.col("other") / size.other
    both = (F.col("marked") + F.col("other")) / (size.marked + size.other)
    spread = F.sqrt(both * (1 - both) * (1 / size.marked + 1 / size.other)) + F.lit(1e-9)
    rows = (
        chosen.select(column, "text")
        .mapInArrow(counts, "word binary, marked long, other long")
        .groupBy("word")
        .agg(F.sum("marked").alias("marked"), F.sum("other").alias("other"))
        .withColumn("z", (p - q) / spread)
        .where(F.abs("z") >= LEAST_Z)
        .orderBy(F.abs("z").desc(), "word")
        .limit(VOCABULARY)
        .collect()
    )

    def ratio(marked: int, other: int) -> float:
        return float(np.log((marked + 0.5) / (size.marked + 1)) - np.log((other + 0.5) / (size.other + 1)))

    return [(bytes(r.word), r.z, ratio(r.marked, r.other)) for r in rows]


def train(docs: DataFrame, labels: DataFrame, usable: Column, most: int = labelled.SAMPLE) -> Severity:
    """Fit on at most ``most`` labelled documents. ``toxic`` grades: 0 none; a 1 is graded by how often the document
    has markers, words that are ten times likelier in toxic documents: 1, 2 from CUTS[0] on, 3 from CUTS[1] on.
    """
    ship(docs.sparkSession)
    chosen = labelled.sample(docs, labels, ["toxic"], usable, most, "toxicity").select("doc_id", "toxic", "text")
    chosen = chosen.withColumn("toxic", F.col("toxic").cast("int"))
    telling = telling_terms(chosen, "toxic")
    vocabulary = [word for word, _, _ in telling]
    marker = np.array([ratio > MARKER for _, _, ratio in telling], dtype=bool)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.binary())
        for batch in w.slices(batches, "text"):
            text, word, count = word_counts(batch["text"], known)
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1))
            part = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["toxic"],
                    pa.array([word[s].tobytes() for s in part], pa.binary()),
                    pa.array([count[s].tobytes() for s in part], pa.binary()),
                ],
                ["doc_id", "toxic", "word", "count"],
            )

    schema = "doc_id long, toxic int, word binary, count binary"
    found = chosen.mapInArrow(rows, schema).orderBy("doc_id", "toxic").collect()
    words = [np.frombuffer(r.word, np.int64) for r in found]
    counts = [np.frombuffer(r["count"], np.int64) for r in found]
    toxic = np.array([r.toxic > 0 for r in found], dtype=bool)
    marks = np.array([c[marker[x]].sum() if len(x) else 0 for x, c in zip(words, counts, strict=True)])
    grade = np.where(toxic, 1 + sum((marks >= cut).astype(int) for cut in CUTS), 0).astype(int)
    doc = np.repeat(np.arange(len(found)), [len(x) for x in words])
    word = np.concatenate(words) if words else np.zeros(0, np.int64)
    value = np.log1p(np.concatenate(counts)) if counts else np.zeros(0)
    return Severity(vocabulary, *fit_thresholds_and_weights(doc, word, value, grade, len(vocabulary)))


def toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> DataFrame:
    """doc_id, held_out, severity (expected grade), probability (of a grade above 0) and toxic (0 or 1) of every row.

    Null and empty texts have no features and get what the thresholds alone say. Without toxic labels nothing is toxic.
    Repeated rows get equal answers each; an empty table gives an empty result.
    """
    usable = crc_remainder("doc_id", 4) != 2 if usable is None else usable
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(docs, labels, usable)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.slices(batches, "text"):
            above = model.above(batch["text"])
            columns = [pa.array(above.sum(axis=1), pa.float64()), pa.array(above[:, 0], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "severity", "probability"])

    scored = docs.mapInArrow(rows, "doc_id long, severity double, probability double")
    return scored.select(
        "doc_id",
        (~usable).alias("held_out"),
        "severity",
        "probability",
        (F.col("probability") >= TOXIC_FROM).cast("int").alias("toxic"),
    )
