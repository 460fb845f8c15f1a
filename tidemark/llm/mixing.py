"""Mixing documents to target weights of domains that are only known softly.

1. A classifier fitted on labelled documents predicts for each document a posterior over the domains (softmax regression
   on shares of characters, words and lines, and on the log-odds of terms that tell one domain from the others).
2. Every document gets a rate, how often it should occur. The expected tokens of domain k are the sum over documents of
   rate x tokens x posterior of k. Projected gradient descent on the weighted squares of their distances from the
   targets finds rates of at least ``least`` (0: any rate that is not negative). Each step is one aggregate of as many
   numbers as there are domains; a document's rate follows from the steps so far and its posterior, and is written every
   KEPT steps. After STEPS steps the squares are weighted by the inverse of each domain's share of the tokens instead, so
   that a rare domain moves as fast as a frequent one. The descent ends at the targets, or with a warning where it
   comes no closer.
3. Copies: the whole part of the rate, and one more with the probability of the rest, drawn by a hash of the id.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm import labelled, ranking
from tidemark.llm import words as w
from tidemark.llm.ordinal import telling_terms, word_counts
from tidemark.llm.shared import ship, written

STEPS = 40
KEPT = 20
CLOSE = 1e-6  # of the weighted squares, relative to the first
STALLED = 0.01  # the least part of the weighted squares that KEPT steps must take off


@dataclass
class Domains:
    names: list[str]
    terms: list[bytes]
    odds: np.ndarray  # terms x domains
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # (features + 1) x domains

    def inputs(self, texts: pa.Array) -> np.ndarray:
        text, term, _ = word_counts(texts, pa.array(self.terms, pa.binary()))
        odds = np.stack([np.bincount(text, self.odds[term, k], minlength=len(texts)) for k in range(len(self.names))], axis=1)
        return np.hstack([ranking.features(texts), np.sign(odds) * np.sqrt(np.abs(odds))])

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))]) @ self.weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def softmax_regression(x: np.ndarray, y: np.ndarray, domains: int, ridge: float = 1e-3, steps: int = 300, rate: float = 0.05):
    """Weights by Adam on the mean log-likelihood; the last row holds the constants."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weights, target = np.zeros((x.shape[1], domains)), np.eye(domains)[y]
    share = target.mean(axis=0).clip(1e-6)
    weights[-1] = np.log(share)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        z = x @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gradient = x.T @ (p - target) / len(x) + ridge * weights
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        weights = weights - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return weights


def train(docs: DataFrame, labels: DataFrame, names: list[str], usable: Column, most: int = labelled.SAMPLE) -> Domains:
    """Fit on at most ``most`` labelled documents. ``labels`` has doc_id and ``domain``, a place in ``names``.

    Without labelled documents every posterior is uniform.
    """
    ship(docs.sparkSession)
    chosen = labelled.sample(docs, labels, ["domain"], usable, most, "domains").select("doc_id", "domain", "text")
    chosen = chosen.withColumn("domain", F.col("domain").cast("int"))
    odds: dict[bytes, np.ndarray] = {}
    for k in range(len(names)):
        marked = chosen.select("text", (F.col("domain") == k).cast("int").alias("own"))
        for term, _, ratio in telling_terms(marked, "own"):
            odds.setdefault(term, np.zeros(len(names)))[k] = ratio
    terms = sorted(odds)
    table = np.array([odds[t] for t in terms]).reshape(len(terms), len(names))
    width = ranking.FEATURES + len(names)
    model = Domains(names, terms, table, np.zeros(width), np.ones(width), np.zeros((width + 1, len(names))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.slices(batches, "text"):
            values = pa.array([x.tobytes() for x in model.inputs(batch["text"])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["domain"], values], ["doc_id", "domain", "x"])

    found = chosen.mapInArrow(rows, "doc_id long, domain int, x binary").orderBy("doc_id", "x").collect()
    if found:
        x = np.array([np.frombuffer(r.x) for r in found])
        model.mean, scale = x.mean(axis=0), x.std(axis=0)
        model.scale = np.where(scale > 1e-9, scale, 1.0)
        model.weights = softmax_regression((x - model.mean) / model.scale, np.array([r.domain for r in found]), len(names))
    return model


def with_posteriors(docs: DataFrame, model: Domains, text_col: str = "text") -> tuple[DataFrame, str, list[str]]:
    """``docs`` with the number of words and the posteriors as further columns, whose names are new to it."""
    ship(docs.sparkSession)
    tail = "_" * (1 + max((len(c) for c in docs.columns), default=0))
    tokens, shares = f"tokens{tail}", [f"p{k}{tail}" for k in range(len(model.names))]
    at = docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.slices(batches, text_col):
            texts = batch.column(at)
            p = model.posteriors(model.inputs(texts))
            added = [pa.array(w.words(texts)[1], pa.int64()), *[pa.array(p[:, k], pa.float64()) for k in range(p.shape[1])]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, tokens, *shares])

    schema = StructType(list(docs.schema.fields))
    for name, kind in [(tokens, "long"), *[(s, "double") for s in shares]]:
        schema = schema.add(name, kind)
    return written(docs.mapInArrow(rows, schema), "posteriors"), tokens, shares


def _moved(rate: Column, step: np.ndarray, shares: list[str], least: float) -> Column:
    along = sum((F.col(s) * float(g) for s, g in zip(shares, step, strict=True)), F.lit(0.0))
    return F.greatest(F.lit(float(least)), rate - along)


@dataclass
class Rates:
    steps: list[np.ndarray]
    start: float
    least: float

    def column(self, shares: list[str]) -> Column:
        if not self.steps:
            return F.lit(self.start)

        def moved(rate: Column, step: Column) -> Column:
            along = sum((F.col(s) * step[k] for k, s in enumerate(shares)), F.lit(0.0))
            return F.greatest(F.lit(float(self.least)), rate - along)

        # a loop over literals: the plan does not grow deeper with the number of steps
        steps = F.array(*[F.array(*[F.lit(float(g)) for g in step]) for step in self.steps])
        return F.aggregate(steps, F.lit(self.start), moved)


def fit_rates(
    members: DataFrame, tokens: str, shares: list[str], targets: list[float], total: float = 1.0, least: float = 0.0,
    steps: int | None = None,
) -> Rates:
    """Rates that bring the expected tokens of each domain to its share in ``targets`` of ``total`` x all tokens.

    The squares are weighted by the inverse of the targets, and a document's part of the gradient by the inverse of its
    tokens, so that equal posteriors get equal rates. No tokens at all: every rate is ``total``. ``steps`` bounds their
    number; a descent that ends before the targets are met warns.
    """
    n = F.col(tokens)
    cells = [F.sum(n * F.col(a) * F.col(b)) for i, a in enumerate(shares) for b in shares[: i + 1]]
    first = members.agg(F.sum(n).cast("double"), *cells).first()
    rates = Rates([], max(float(total), least), least)
    if not first[0]:
        return rates
    k, target = len(shares), np.array(targets, float) / sum(targets)
    curve = np.zeros((k, k))
    curve[np.tril_indices(k)] = np.array(first[1:], float) / first[0]
    curve = curve + np.tril(curve, -1).T
    weight = 1 / np.maximum(target, 1e-3)
    # the largest eigenvalue of W curve bounds the step
    size = float(np.linalg.eigvalsh(np.sqrt(weight)[:, None] * curve * np.sqrt(weight)[None]).max())
    goal, begin, met, losses = total * target, None, False, []
    # the rows of curve sum to the shares, so these weights bound the largest eigenvalue by 1
    even = 1 / np.maximum(curve.sum(axis=1), 1e-12)
    members, rate = members.select(tokens, *shares), F.lit(rates.start)
    while True:
        now = np.array(members.agg(*[F.sum(rate * n * F.col(s)) for s in shares]).first(), float) / first[0]
        off = now - goal
        loss = float(weight @ off**2)
        begin = loss if begin is None else begin
        met = loss <= CLOSE * begin or loss < 1e-12
        done = len(rates.steps)
        losses += [float(even @ off**2)] if done >= STEPS else []
        stuck = len(losses) > KEPT and losses[-1] > (1 - STALLED) * losses[-1 - KEPT]
        if met or stuck or done == steps:
            break
        step = weight * off / size if done < STEPS else even * off
        rates.steps.append(step)
        rate = _moved(rate, step, shares, least)
        if len(rates.steps) % KEPT == 0:
            column = f"rate{'_' * (1 + max(map(len, [tokens, *shares])))}"
            members = written(members.select(tokens, *shares, rate.alias(column)), "rates")
            rate = F.col(column)
    if not met:
        warnings.warn(f"mixing ends after {done} steps at shares {now.tolist()}, targets {goal.tolist()}", stacklevel=2)
    return rates


def drawn(rate: Column, id_col: str, seed: int = 17) -> Column:
    """Copies of a document: the whole part of its rate, and one more where a hash of its id falls below the rest."""
    uniform = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11) / F.lit(float(1 << 53))
    return (F.floor(rate) + (uniform < rate - F.floor(rate)).cast("int")).cast("int")


def rates_of(
    docs: DataFrame, model: Domains, targets: dict[str, float], total: float = 1.0, least: float = 0.0
) -> DataFrame:
    """doc_id, n_tokens, posteriors (by name of the domain), rate and copies of every row.

    Null texts are empty: they have no tokens and count for nothing, but have a rate. Repeated rows get equal answers. An
    empty table gives an empty result. A text of any length is read whole, as one row of features.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members, tokens, shares = with_posteriors(docs, model)
    members = written(members.select("doc_id", tokens, *shares), "members")
    rates = fit_rates(members, tokens, shares, [targets[d] for d in model.names], total, least)
    named = [F.col(s).alias(f"p_{d}") for s, d in zip(shares, model.names, strict=True)]
    found = members.select("doc_id", F.col(tokens).alias("n_tokens"), *named, rates.column(shares).alias("rate"))
    return found.withColumn("copies", drawn(F.col("rate"), "doc_id"))


def mixed(docs: DataFrame, model: Domains, targets: dict[str, float], total: float = 1.0, least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with their columns as they are."""
    members, tokens, shares = with_posteriors(docs, model)
    rates = fit_rates(members, tokens, shares, [targets[d] for d in model.names], total, least)
    copies = drawn(rates.column(shares), "doc_id")
    again = members.withColumn(tokens, copies).where(F.col(tokens) > 0)
    again = again.withColumn(tokens, F.explode(F.sequence(F.lit(1), F.col(tokens))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])
