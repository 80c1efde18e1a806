"""Mixing to target weights with soft domain membership.

A softmax classifier of hashed words, fitted on the labelled table, gives every
document its domain posteriors. Document rates ``r >= 0`` are then fitted so that
the expected domain token totals ``sum_d r_d * tokens_d * p_dk`` match the
targets, by projected-gradient least squares from ``r = 1``:

    r <- max(0, r - P (G^-1 e)),  e = (totals - targets) / tokens

where G is the posteriors' token-weighted Gram matrix over documents whose rate
is above 0 (it conditions the step, so a rare domain moves as fast as a common
one). A rate depends on the posteriors and the past steps alone, so a pass over
the compact table (id, tokens, posteriors) recomputes it and sums K totals and
K*K products; only those reach the driver. A step that does not bring the totals
nearer is halved until it does; the best steps are returned. A fit that still
misses its targets raises unless the caller accepts it.

Defined cases: null or empty text: no tokens; its posteriors are those of the
intercept and its rate follows from them. No labelled rows: all posteriors
equal. No tokens at all: every rate is 1. A domain that no document has keeps
its total of 0, whatever its target. Rows that repeat an id get equal rates.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm import hashed_words as H
from cohortcraft.llm import kernels as K
from cohortcraft.llm import labelled
from cohortcraft.llm.storage import written

DOMAINS = ("clean", "low", "toxic")
LIMIT = 10_000
"""Labelled rows that the classifier's fit may use (a documented bound of the sample)."""

BITS = 17
ANCHOR = "clean"
TARGETS = {"clean": 0.95, "low": 0.03, "toxic": 0.02}
"""Target shares of tokens. The anchor's total stays what it is and fixes the scale."""


REPORTED = 1e-3
"""Share of all tokens by which fitted totals may miss the targets."""

HALVINGS = 12


class MissedTargets(RuntimeError):
    """No rates were found that meet the targets."""


def domain_label() -> Column:
    """Domain of a labelled row: toxic before low before clean."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)


def train(xs: list[np.ndarray], ys: np.ndarray, bits: int = BITS, classes: int = len(DOMAINS), epochs: int = 4, step: float = 0.5) -> bytes:
    """Softmax regression by adaptive gradient steps; intercepts are the last row."""
    weights = np.zeros(((1 << bits) + 1, classes))
    squares = np.full_like(weights, 1e-2)
    rows = [H.counted(x) for x in xs]
    rng = np.random.default_rng(13)
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            at, x = rows[r]
            at, x = np.append(at, 1 << bits), np.append(x, 1.0)
            margin = x @ weights[at]
            p = np.exp(margin - margin.max())
            p /= p.sum()
            p[ys[r]] -= 1
            g = x[:, None] * p
            squares[at] += g * g
            weights[at] -= step * g / np.sqrt(squares[at])
    return weights.astype("<f4").tobytes()


def fit(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, bits: int = BITS) -> np.ndarray:
    """docs (doc_id, text), labels (doc_id, quality, toxic) -> weights (features + 1, domains)."""
    model = labelled.fit(docs, labels.select("doc_id", domain_label().alias("label")), limit, bits, lambda xs, ys: train(xs, ys, bits))
    shape = ((1 << bits) + 1, len(DOMAINS))
    return np.zeros(shape, np.float32) if model is None else np.frombuffer(model, "<f4").reshape(shape)


_MEMBERS = ("n_tokens", *(f"p_{d}" for d in DOMAINS))


def memberships(docs: DataFrame, weights: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but ``text``), then n_tokens (white-space words) and the posteriors of whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2^bits rows, whatever the input
    bits = int(len(weights) - 1).bit_length() - 1
    rest = [c for c in docs.columns if c != text and c not in _MEMBERS] if keep is None else keep
    names = [*rest, *_MEMBERS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            column = batch.column(text)
            data, offsets = K.buffer(column)
            for i, j, flat, first in H.features(column, bits):
                margin = H.linear(flat, first, table[:-1]) + table[-1]
                p = np.exp(margin - margin.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                _, _, words = K.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                part = batch.slice(i, j - i)
                added = [pa.array(np.diff(words), pa.int64()), *(pa.array(p[:, k], pa.float64()) for k in range(len(DOMAINS)))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), *added], names=names)

    plain = docs.select(*dict.fromkeys([*rest, text]))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.select(*rest).schema]
    return plain.mapInArrow(run, ", ".join([*kinds, "n_tokens bigint", *(f"p_{d} double" for d in DOMAINS)]))


def _rate(steps: list[np.ndarray]) -> Column:
    rate = F.lit(1.0)
    for s in steps:
        moved = rate
        for d, x in zip(DOMAINS, s, strict=True):
            moved = moved - F.lit(float(x)) * F.col(f"p_{d}")
        rate = F.greatest(F.lit(0.0), moved)
    return rate


@dataclass(frozen=True)
class Fit:
    steps: list[np.ndarray]
    targets: np.ndarray
    totals: np.ndarray
    residual: float


def _sums(members: DataFrame, rate: Column) -> tuple[np.ndarray, np.ndarray, float]:
    k = len(DOMAINS)
    p = [F.col(f"p_{d}") for d in DOMAINS]
    live = members.withColumn("_r", rate)
    n = F.col("n_tokens").cast("double")
    active = F.when(F.col("_r") > 0, n).otherwise(0.0)
    row = live.agg(
        *(F.sum(F.col("_r") * n * x) for x in p), *(F.sum(active * p[i] * p[j]) for i in range(k) for j in range(k)), F.sum(n)
    ).first()
    v = np.array([float(x or 0.0) for x in row])
    return v[:k], v[k : k + k * k].reshape(k, k), v[-1]


def fit_rates(
    members: DataFrame, targets: dict[str, float] = TARGETS, anchor: str | None = ANCHOR, repeats: bool = True, tolerance: float = 1e-9,
    passes: int = 60, accept: bool = False,
) -> Fit:
    """Steps of the projected gradient, those with the least error.

    Without an anchor the targets share out all tokens. Without ``repeats`` no
    domain's target exceeds the total that it has. Targets that are missed by
    more than ``REPORTED`` of all tokens raise; with ``accept`` they only warn.
    """
    share = np.array([targets[d] for d in DOMAINS], float)
    share = share / share.sum()
    totals, gram, tokens = _sums(members, _rate([]))
    if tokens == 0:
        return Fit([], np.zeros(len(DOMAINS)), totals, 0.0)
    anchor_at = DOMAINS.index(anchor) if anchor else None
    goal = share * (tokens if anchor_at is None else totals[anchor_at] / share[anchor_at])
    goal = goal if repeats else np.minimum(goal, totals)
    off = lambda t: float(np.abs((t - goal) / tokens).max())
    best, error, used = [], off(totals), 1
    while error > tolerance and used < passes:
        # a ridge keeps the step finite when a domain has no active document
        step = np.linalg.solve(gram / tokens + 1e-9 * np.eye(len(DOMAINS)), (totals - goal) / tokens)
        for _ in range(HALVINGS):
            tried = [*best, step]
            found = _sums(members, _rate(tried))
            used += 1
            if off(found[0]) < error * (1 - 1e-6):
                break
            step = step / 2
            if used >= passes:
                break
        if off(found[0]) >= error * (1 - 1e-6):
            break
        best, (totals, gram, _), error = tried, found, off(found[0])
    if error > REPORTED:
        missed = f"mixing: totals miss the targets by up to {error:.3g} of all tokens"
        if not accept:
            raise MissedTargets(missed)
        warnings.warn(missed, stacklevel=2)
    return Fit(best, goal, totals, error)


def _draw(doc_id: Column) -> Column:
    """A number in [0, 1) per document, from its id alone."""
    return F.pmod(F.xxhash64(doc_id.cast("string"), F.lit("mix")), F.lit(1 << 32)) / float(1 << 32)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """(doc_id, n_tokens, posteriors, rate, copies) per row of ``docs``.

    ``copies`` rounds the rate down or up by a hash of the id, so that its
    expectation is the rate and a document's draw never depends on others.
    Targets that no rates meet are missed as little as possible, with a warning.
    """
    weights = fit(docs.select("doc_id", "text"), labels)
    members = written(memberships(docs.select("doc_id", "text"), weights), "memberships")
    rate = _rate(fit_rates(members, targets, accept=True).steps)
    return members.withColumn("rate", rate).withColumn("copies", F.floor(F.col("rate") + _draw(F.col("doc_id"))).cast("bigint"))


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, that stay in the mix: drawn by a hash of the id against rates fitted without repeats.

    A rate of 1 or more always stays. The posteriors are computed a second time
    on the way out, so whole texts are never shuffled to meet their rates.
    """
    weights = fit(docs.select(F.col(doc_id).alias("doc_id"), "text"), labels)
    members = written(memberships(docs.select("text"), weights), "memberships")
    rate = _rate(fit_rates(members, targets, repeats=False, accept=True).steps)
    plain = docs.select(*(F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)))
    rated = memberships(plain, weights, f"c{docs.columns.index('text')}", keep=plain.columns)
    own = F.coalesce(F.col(f"c{docs.columns.index(doc_id)}").cast("string"), F.lit(""))
    return rated.where(_draw(own) < rate).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))
