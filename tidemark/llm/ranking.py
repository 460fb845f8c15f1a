"""Quality by pairwise ranking: a Bradley-Terry model of which of two documents is the better one.

The probability that document i is better than j is the logistic function of w . (x_i - x_j). The weights come from
all pairs of a good and a bad labelled document by Newton steps on the logistic loss of their feature differences. The
threshold is the quantile of all labelled documents' scores at the share of bad ones among them; scores are shifted so
that it lies at 0.7 and mapped to 0..1 by the logistic function.

No pair is ever formed. What a document adds to the loss, its gradient and its curvature depends on the other kind only
by the distribution of their scores (and of their features along it), so two passes over the documents make a step: one
counts both kinds over the scores, one sums features weighted by the counts of the other kind. Scores are counted on
nodes WIDTH apart, each shared by the two nodes beside it in proportion; this is the only approximation.

Features are shares of kinds of characters, words and lines, so they read the whole text and nothing but the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm import words as w
from tidemark.llm.shared import crc_remainder, ship, written

WIDTH = 1 / 16  # between two nodes of the scores, unless they spread over more than NODES of them
NODES = 2_048
STEPS, CLOSE = 30, 1e-4  # Newton steps at most; the last one changes no weight by more than CLOSE
RIDGE = 1e-3
CUTS = 1_024  # ranges into which the search of a quantile cuts the scores in one round
FEW_BYTES = 100  # a text of this size counts half: its shares are pulled towards the mean
CUT = 0.7
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

KIND = np.zeros(256, dtype=np.int64)  # 0: control
for kind, members in enumerate((b" ", b"\n", b"\t\v\f\r", range(48, 58), range(65, 91), range(97, 123), range(128, 256)), 1):
    KIND[list(members)] = kind
for kind, mark in enumerate(MARKS, 8):
    KIND[mark] = kind
KINDS = 8 + len(MARKS)
FEATURES = KINDS + 10


def features(texts: pa.Array) -> np.ndarray:
    """One row for each text; a text without bytes has zeros."""
    data, offsets = w.text_bytes(texts)
    docs, size = len(offsets) - 1, np.diff(offsets)
    place = np.repeat(np.arange(docs), size)
    kinds = np.bincount(place * KINDS + KIND[data], minlength=docs * KINDS).reshape(docs, KINDS)
    found, counts = w.words(texts)
    owner = np.repeat(np.arange(docs), counts)
    length = pc.binary_length(found).to_numpy(zero_copy_only=False).astype(np.int64) if len(found) else np.zeros(0, np.int64)

    def share(of: np.ndarray, total: np.ndarray) -> np.ndarray:
        return np.sqrt(of / np.maximum(total, 1))

    def of_words(chosen: np.ndarray) -> np.ndarray:
        return share(np.bincount(owner[chosen], minlength=docs), counts)

    numbers, distinct = w.coded(found)
    again = np.zeros(len(found), dtype=bool)
    again[1:] = (numbers[1:] == numbers[:-1]) & (owner[1:] == owner[:-1])
    different = np.unique(owner * max(1, len(distinct)) + numbers) // max(1, len(distinct))

    last = LAST_MARK[data]
    ends = np.zeros(len(data), dtype=bool)
    if len(data):
        ends[:-1] = ~w.SPACE[data[:-1]] & w.SPACE[data[1:]]
        ends[offsets[1:][size > 0] - 1] = ~w.SPACE[data[offsets[1:][size > 0] - 1]]
    marked = np.bincount(place[ends & last], minlength=docs)
    total = np.bincount(owner, length, minlength=docs)
    out = np.empty((docs, FEATURES))
    out[:, :KINDS] = share(kinds, size[:, None])
    out[:, KINDS] = np.log1p(size)
    out[:, KINDS + 1] = np.log1p(counts)
    out[:, KINDS + 2] = total / np.maximum(counts, 1) / 10
    out[:, KINDS + 3] = of_words(length <= 3)
    out[:, KINDS + 4] = of_words(length >= 15)
    out[:, KINDS + 5] = share(marked, counts)  # words that end in a mark other than usual punctuation
    out[:, KINDS + 6] = share(kinds[:, 5], kinds[:, 5] + kinds[:, 6])  # capitals among ASCII letters
    out[:, KINDS + 7] = share(np.bincount(owner, minlength=docs), size)
    out[:, KINDS + 8] = of_words(again)
    out[:, KINDS + 9] = np.bincount(different, minlength=docs) / np.maximum(counts, 1)
    return out


LAST_MARK = np.zeros(256, dtype=bool)
LAST_MARK[[m for m in MARKS if m not in b".,;:?'\")-"]] = True


def logistic(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        size = np.expm1(x[:, KINDS])
        return (x - self.mean) / self.scale * (size / (size + FEW_BYTES))[:, None]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (self.standard(x) * self.weights).sum(axis=1)  # row by row, the same in any batch

    def score(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.raw(x) - self.threshold + np.log(CUT / (1 - CUT)))


def fit(
    x: np.ndarray, good: np.ndarray, pairs: int | None = None, ridge: float = RIDGE, steps: int = 12, seed: int = 7
) -> Ranking:
    """The plain form of ``train`` for rows in memory: weights from all pairs of one good and one bad row, or ``pairs`` drawn ones.

    With one kind only, all weights are 0 and all scores that label.
    """
    mean = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    scale = x.std(axis=0) if len(x) else np.ones(FEATURES)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    model = _untaught(mean, scale, len(better), len(worse))
    if not len(better) or not len(worse):
        return model
    z, weights = model.standard(x), model.weights
    if pairs is None:
        first, second = np.repeat(better, len(worse)), np.tile(worse, len(better))
    else:
        rng = np.random.default_rng(seed)
        n = min(pairs, 4 * len(better) * len(worse))
        first, second = rng.choice(better, n), rng.choice(worse, n)
    difference = z[first] - z[second]
    n = len(difference)
    for _ in range(steps):
        p = logistic(difference @ weights)
        gradient = difference.T @ (p - 1) / n + ridge * weights
        curve = (difference * (p * (1 - p))[:, None]).T @ difference / n + ridge * np.eye(len(weights))
        weights = weights - np.linalg.solve(curve, gradient)
    raw = np.sort(z @ weights)
    at = len(worse)
    model.weights, model.threshold = weights, float((raw[at - 1] + raw[min(at, len(raw) - 1)]) / 2)
    return model


def _untaught(mean: np.ndarray, scale: np.ndarray, good: int, bad: int) -> Ranking:
    """No weights; with one kind only, a threshold that gives every text that kind (good without any)."""
    threshold = 0.0 if good and bad else 1.0 if bad else -1.0
    return Ranking(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(FEATURES), threshold)


def featured(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text and the features (8 bytes each) of every row."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.slices(batches, "text"):
            values = pa.array([x.tobytes() for x in features(batch["text"])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["hash"], values], ["doc_id", "hash", "x"])

    given = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    return given.mapInArrow(rows, "doc_id long, hash long, x binary")


def _matrix(values: pa.Array) -> np.ndarray:
    return w.text_bytes(values)[0].view(np.float64).reshape(len(values), FEATURES)


def _over_tasks(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray], join: Callable) -> np.ndarray | None:
    """``part`` of each batch's features and labels, joined within each task and then in the order of the tasks.

    A task sends one array, whose size does not depend on its rows; without any row the result is None.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (part(_matrix(b["x"]), b["quality"].to_numpy() == 1) for b in batches if b.num_rows)
        total = reduce(join, found, None)
        if total is not None:
            place = pyspark.TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["place", "total"])

    found = sorted(rows.mapInArrow(run, "place int, total binary").collect(), key=lambda r: r.place)
    return reduce(join, (np.frombuffer(r.total) for r in found), None)


def _added(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    return b if a is None else a + b


def _moments(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Good and bad rows, and of each feature the mean and the sum of squares around it."""
    return np.concatenate([[good.sum(), (~good).sum()], x.mean(axis=0), x.var(axis=0) * len(x)])


def _joined_moments(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    if a is None:
        return b
    n, m, gap = a[:2].sum(), b[:2].sum(), b[2 : 2 + FEATURES] - a[2 : 2 + FEATURES]
    mean = a[2 : 2 + FEATURES] + gap * (m / (n + m))
    return np.concatenate([a[:2] + b[:2], mean, a[2 + FEATURES :] + b[2 + FEATURES :] + gap**2 * (n * m / (n + m))])


@dataclass
class Nodes:
    """Good and bad documents counted over their scores, at (first + k) * width."""

    first: int
    width: float
    counts: np.ndarray  # 2 x nodes: good, bad

    def beside(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The node below each score, and the share of the next one."""
        at = raw / self.width
        below = np.floor(at)
        return below.astype(np.int64) - self.first, at - below

    def gaps(self) -> np.ndarray:
        """Score of each node less that of each other."""
        scores = np.arange(self.counts.shape[1]) * self.width
        return scores[:, None] - scores[None]

    def loss(self) -> float:
        """The mean over all pairs."""
        good, bad = self.counts
        return float(good @ np.logaddexp(0, -self.gaps()) @ bad / (good.sum() * bad.sum()))


def _counted(rows: DataFrame, model: Ranking) -> Nodes:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = model.raw(_matrix(batch["x"])) / WIDTH
            below, good = np.floor(at), batch["quality"].to_numpy() == 1
            both = np.concatenate([below, below + 1]).astype(np.int64)
            share = np.concatenate([1 - (at - below), at - below])
            nodes, place = np.unique(both, return_inverse=True)
            kinds = [np.bincount(place, share * np.tile(kind, 2), minlength=len(nodes)) for kind in (good, ~good)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), *[pa.array(k) for k in kinds]], ["node", "good", "bad"])

    sums = rows.mapInArrow(count, "node long, good double, bad double").groupBy("node").agg(F.sum("good"), F.sum("bad"))
    found = sorted(map(tuple, sums.collect()))
    nodes, width = np.array([f[0] for f in found], np.int64), WIDTH
    kinds = np.array([f[1:] for f in found]).T
    while nodes.max() - nodes.min() >= NODES:  # every second node falls away and is shared by its neighbours
        both = np.concatenate([nodes >> 1, (nodes + 1) >> 1])
        nodes, place = np.unique(both, return_inverse=True)
        kinds = np.array([np.bincount(place, np.tile(k / 2, 2), minlength=len(nodes)) for k in kinds])
        width *= 2
    counts = np.zeros((2, nodes.max() - nodes.min() + 1))
    counts[:, nodes - nodes.min()] = kinds
    return Nodes(int(nodes.min()), width, counts)


def _step(rows: DataFrame, model: Ranking, nodes: Nodes, ridge: float) -> np.ndarray:
    """The Newton step of the mean loss over all pairs, to be taken off the weights."""
    good, bad = nodes.counts
    wrong = logistic(-nodes.gaps())  # of a good document at the first node and a bad one at the second
    curved = wrong * (1 - wrong)
    # for good and for bad documents at each node: slope and curvature, summed over the other kind
    tables = np.array([[-wrong @ bad, good @ wrong], [curved @ bad, good @ curved]])
    size = len(good)

    def part(x: np.ndarray, is_good: np.ndarray) -> np.ndarray:
        z = model.standard(x)
        below, share = nodes.beside((z * model.weights).sum(axis=1))
        below, kind = np.clip(below, 0, max(0, size - 2)), np.where(is_good, 0, 1)
        above = np.minimum(below + 1, size - 1)
        slope, curve = tables[:, kind, below] * (1 - share) + tables[:, kind, above] * share
        sums = np.zeros(2 * size * FEATURES)
        for node, part_of in ((below, 1 - share), (above, share)):
            cell = ((kind * size + node) * FEATURES)[:, None] + np.arange(FEATURES)
            sums += np.bincount(cell.ravel(), (z * part_of[:, None]).ravel(), minlength=len(sums))
        return np.concatenate([slope @ z, ((z * curve[:, None]).T @ z).ravel(), sums])

    total, pairs = _over_tasks(rows, part, _added), good.sum() * bad.sum()
    gradient, own = total[:FEATURES], total[FEATURES : FEATURES * (FEATURES + 1)].reshape(FEATURES, FEATURES)
    of_good, of_bad = total[FEATURES * (FEATURES + 1) :].reshape(2, size, FEATURES)
    cross = of_good.T @ curved @ of_bad
    curve = (own - cross - cross.T) / pairs + ridge * np.eye(FEATURES)
    return np.linalg.solve(curve, gradient / pairs + ridge * model.weights)


def _ranked(scores: DataFrame, rank: int) -> tuple[float, float]:
    """The scores in places ``rank`` and ``rank`` + 1 (from 0; the last one twice) of their ascending order.

    Exact: each round counts the scores of CUTS ranges and goes on in the one that holds the place, until all in it are equal.
    """
    c = F.col("raw")
    low, high = scores.agg(F.min(c), F.max(c)).first()
    before = 0
    while low < high:
        span = F.floor((c - low) / F.lit((high - low) / CUTS or high - low))
        ranges = scores.where(c.between(low, high)).groupBy(span.alias("span"))
        for r in sorted(ranges.agg(F.count("*").alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).collect(), key=lambda r: r.low):
            if before + r.n > rank:
                low, high = r.low, r.high
                break
            before += r.n
    after = scores.agg(F.count_if(c <= low).alias("n"), F.min(F.when(c > low, c)).alias("next")).first()
    return low, low if after.n > rank + 1 or after.next is None else after.next


def fit_all(rows: DataFrame, ridge: float = RIDGE) -> Ranking:
    """The ranking of all pairs of good and bad rows of a stored table (quality, x)."""
    ship(rows.sparkSession)
    moments = _over_tasks(rows, _moments, _joined_moments)
    if moments is None:
        return _untaught(np.zeros(FEATURES), np.ones(FEATURES), 0, 0)
    good, bad = (int(n) for n in moments[:2])
    model = _untaught(moments[2 : 2 + FEATURES], np.sqrt(moments[2 + FEATURES :] / (good + bad)), good, bad)
    if not good or not bad:
        return model
    step, last = np.full(FEATURES, np.inf), np.inf
    for _ in range(STEPS):
        nodes = _counted(rows, model)
        loss = nodes.loss() + ridge / 2 * float(model.weights @ model.weights)
        if loss > last + 1e-6:  # too far: half the way back
            step = step / 2
            model = replace(model, weights=model.weights + step)
            continue
        last, step = loss, _step(rows, model, nodes, ridge)
        model = replace(model, weights=model.weights - step)
        if np.abs(step).max() <= CLOSE:
            break

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(batch["x"])))], ["raw"])

    at = _ranked(written(rows.mapInArrow(raw, "raw double"), "quality-raw"), bad - 1)
    return replace(model, threshold=sum(at) / 2)


def train(found: DataFrame, labels: DataFrame, usable: Column) -> Ranking:
    """Fit on all labelled rows of ``featured``; of rows with one id, ``labelled.known`` and ``labelled.one_of`` take one."""
    known = labelled.known(labels, ["quality"], usable).withColumn("quality", F.col("quality").cast("int"))
    rows = found.join(known, "doc_id").groupBy("doc_id", "quality").agg(labelled.one_of("x", "hash"))
    return fit_all(written(rows.select("quality", "x"), "quality"))


def scores(found: DataFrame, model: Ranking) -> DataFrame:
    """doc_id and score of every row of ``featured``; rows whose text is null or empty have one too."""
    ship(found.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(model.score(_matrix(batch["x"])), pa.float64())], ["doc_id", "score"]
            )

    return found.select("doc_id", "x").mapInArrow(rows, "doc_id long, score double")


def usable(column: str = "doc_id") -> Column:
    """Rows to learn from; the others are held out."""
    return crc_remainder(column, 4) != 2


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.7) of every row of ``docs``.

    Without any labelled document every document is taken as good. Null and empty texts are scored alike. Repeated rows
    get equal answers each; an empty table gives an empty result.
    """
    found = written(featured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "features")
    scored = scores(found, train(found, labels, usable()))
    return scored.select(
        "doc_id", (~usable()).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted as good, with all their columns, whatever their names."""
    ship(docs.sparkSession)
    model = train(featured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), labels, usable())
    columns = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in w.slices(batches, "text"):
            yield batch.filter(pa.array(model.score(features(batch.column(at))) >= CUT))

    return docs.mapInArrow(rows, docs.schema)
