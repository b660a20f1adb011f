"""Quality scores learned from trusted good documents and unlabelled text only.

Positive-unlabelled learning: documents that labels call good are the positives, all text of
the corpus is the unlabelled sample, and no document counts as bad. A linear model of whole-text
features minimises the non-negative unbiased risk

    prior * E_good[loss(f)] + max(0, E_all[loss(-f)] - prior * E_good[loss(-f)])

with the logistic loss, so that its output is the chance of being good. The share of good
documents, the prior, is estimated too: a model tells the good ones from all, and among the
documents it finds best the shares of both that are left give the smallest bound on the prior
that their numbers bear out.

Features are made in one pass over the texts and written as short rows. Newton steps are sums
over these rows, added up by Spark; the driver sees numbers of features squared, no rows.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import map_arrow, raw, slices, table
from cohortloom.sources.storage import materialize

KINDS = ("lower", "upper", "digit", "stop", "sign", "high", "space", "line")
SHARES = (*KINDS, "repeated", "distinct", "bare", "packed", "lines")
WIDTH = 2 * len(SHARES) + 2  # each share and its root, length of words and of the text
RIDGE = 1e-4
STEPS = 30  # passes over the rows at most
SETTLED = 1e-7  # gain of a step below which a fit ends
BINS = 1 << 12  # of the scores that the prior is read from
DOUBT = 0.1  # chance that the prior's bound fails
KEPT = 0.3  # score from which a document counts as good
HELD = "doc_id long, x array<float>"


def _kinds() -> np.ndarray:
    kind = np.full(256, KINDS.index("sign"), np.uint8)
    for name, signs in (
        ("lower", b"abcdefghijklmnopqrstuvwxyz"),
        ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("digit", b"0123456789"),
        ("stop", b".,;:!?'\"()-"),
        ("space", b" \t"),
        ("line", b"\n\r\x0b\x0c"),
        ("high", bytes(range(128, 256))),
    ):
        kind[list(signs)] = KINDS.index(name)
    return kind


KIND = _kinds()


def features(text: bytes) -> list[float]:
    """Shares of a whole text, their roots, and two lengths; zeros for an empty one.

    Shares of the kinds of bytes; of words that repeat the one before, that are distinct, that
    have neither letter nor digit; of the bytes left when packed; of the lines that are distinct.
    """
    if not text:
        return [0.0] * WIDTH
    n = len(text)
    kinds = np.bincount(KIND[np.frombuffer(text, np.uint8)], minlength=len(KINDS)) / n
    words = text.split()
    many = max(1, len(words))
    repeated = sum(map(operator.eq, words, words[1:])) / many
    alike = set(words)
    bare = {w for w in alike if len(w) < 4 and not (w.isalnum() or max(w) > 127)}
    lines = text.split(b"\n")
    shares = [
        *kinds.tolist(),
        repeated,
        len(alike) / many,
        (sum(map(bare.__contains__, words)) if bare else 0) / many,
        min(1.0, len(zlib.compress(text, 1)) / n),
        len(set(lines)) / len(lines),
    ]
    lengths = [min(n / many, 40.0) / 10, np.log1p(n) / 10]
    return [*shares, *np.sqrt(shares).tolist(), *lengths]


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and features `x` of each row; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            found = [features(text) for text in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.float32()))],
                names=["doc_id", "x"],
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text_col}` AS text")
    return map_arrow(rows, run, HELD)


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def added_up(held: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of `part(features, good)` over the rows: a vector of fixed size from each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                good = np.asarray(batch.column("good").cast(pa.int8())).astype(bool)
                total = total + part(matrix(batch.column("x")), good)
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["k", "v"]
            )

    sums = map_arrow(held.select("x", "good"), run, "k int, v double").groupBy("k").agg(F.sum("v"))
    found = sorted(map(tuple, sums.collect()))
    return np.array([v for _, v in found])


def softplus(f: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, f)


def chance(f: np.ndarray) -> np.ndarray:
    return np.exp(-softplus(-f))


@dataclass
class Scale:
    """Features with mean zero and spread one, and a constant."""

    mean: np.ndarray
    spread: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - self.mean) / self.spread, np.ones((len(x), 1))])


def _scale(held: DataFrame) -> tuple[Scale, float, float, np.ndarray]:
    """The scale, the numbers of rows and of good ones, and the good ones' mean."""
    sums = added_up(
        held,
        lambda x, good: np.concatenate([[len(x), good.sum()], x.sum(0), (x * x).sum(0), x[good].sum(0)]),
    )
    if not len(sums):
        return Scale(np.zeros(0), np.zeros(0)), 0.0, 0.0, np.zeros(0)
    rows, good, (a, b, c) = sums[0], sums[1], np.split(sums[2:], 3)
    mean = a / rows
    spread = np.sqrt(np.maximum(b / rows - mean * mean, 0))
    scale = Scale(mean, np.where(spread > 1e-9, spread, 1.0))
    return scale, rows, good, scale((c / max(good, 1))[None])[0]


def _risks(held: DataFrame, scale: Scale, w: np.ndarray, rows: float, good: float):
    """Means that a step needs: losses, and gradient and curvature of loss(-f) over both sets."""
    d = len(w)

    def part(x: np.ndarray, is_good: np.ndarray) -> np.ndarray:
        z = scale(x)
        f = z @ w
        p, loss = chance(f), softplus(f)
        own, g = z[is_good], p[is_good]
        bend = p * (1 - p)
        return np.concatenate(
            [
                [loss.sum(), loss[is_good].sum(), softplus(-f[is_good]).sum()],
                z.T @ p,
                own.T @ g,
                ((z * bend[:, None]).T @ z).ravel(),
                ((own * bend[is_good][:, None]).T @ own).ravel(),
            ]
        )

    sums = added_up(held, part)
    losses, vectors, squares = sums[:3], sums[3 : 3 + 2 * d], sums[3 + 2 * d :]
    all_loss, good_loss, missed = losses / [rows, good, good]
    grad_all, grad_good = vectors[:d] / rows, vectors[d:] / good
    bend_all, bend_good = (m.reshape(d, d) / n for m, n in zip(np.split(squares, 2), (rows, good), strict=True))
    return (all_loss, good_loss, missed), (grad_all, grad_good), (bend_all, bend_good)


def _descend(evaluate: Callable[[np.ndarray], tuple | None], d: int) -> np.ndarray:
    """Newton steps, halved where they don't lower the risk or `evaluate` refuses them."""
    w = np.zeros(d)
    value, grad, bend = evaluate(w)
    step, passes = np.linalg.solve(bend, grad), 1
    while passes < STEPS:
        found = evaluate(w - step)
        passes += 1
        if found is None or found[0] > value:
            step = step / 2
            if np.abs(step).max() < 1e-6:
                break
            continue
        gain = value - found[0]
        w, (value, grad, bend) = w - step, found
        if gain < SETTLED:
            break
        step = np.linalg.solve(bend, grad)
    return w


def _ridge(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Penalty of the weights, not of the constant, its gradient and curvature."""
    weight = np.append(np.full(len(w) - 1, RIDGE), 1e-9)
    return 0.5 * float(weight @ (w * w)), weight * w, np.diag(weight)


def estimate_prior(held: DataFrame, scale: Scale, w: np.ndarray, rows: float, good: float) -> float:
    """Share of good documents among all, from the scores of a model of good against all.

    Above a score there are a share q of all and a share q_good of the good documents, and
    q / q_good is the prior plus what others are above it. The score is chosen at which this and
    a margin for the finite numbers are least.
    """

    def part(x: np.ndarray, is_good: np.ndarray) -> np.ndarray:
        at = np.minimum((chance(scale(x) @ w) * BINS).astype(int), BINS - 1)
        return np.concatenate(
            [np.bincount(at, minlength=BINS), np.bincount(at[is_good], minlength=BINS)]
        ).astype(float)

    above = added_up(held, part).reshape(2, BINS)[:, ::-1].cumsum(axis=1)
    q, q_good = above[0] / rows, above[1] / good
    margin = sum(np.sqrt(np.log(4 / DOUBT) / (2 * n)) for n in (rows, good))
    seen = q_good > 0
    best = np.argmin((q[seen] + 1.01 * margin) / q_good[seen])
    return float(np.clip(q[seen][best] / q_good[seen][best], 0.01, 0.99))


@dataclass
class Model:
    scale: Scale
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        # sums of rows, unlike products of matrices, don't depend on the rows beside them
        return chance((self.scale(x) * self.weights).sum(axis=1))


def fit(held: DataFrame) -> Model | None:
    """Minimise the risk over the written rows (x, good); None without good documents."""
    scale, rows, good, mean_good = _scale(held)
    if not good:
        return None
    d = len(mean_good)

    def against_all(w: np.ndarray):
        (all_loss, _, missed), (grad_all, grad_good), bends = _risks(held, scale, w, rows, good)
        extra, pull, curve = _ridge(w)
        gradient = grad_all + grad_good - mean_good
        return all_loss + missed + extra, gradient + pull, bends[0] + bends[1] + curve

    prior = estimate_prior(held, scale, _descend(against_all, d), rows, good)

    def risk(w: np.ndarray):
        (all_loss, good_loss, missed), (grad_all, _), (bend_all, _) = _risks(held, scale, w, rows, good)
        negative = all_loss - prior * good_loss
        if negative < 0:  # no risk is below zero: the step went too far
            return None
        extra, pull, curve = _ridge(w)
        # loss(f) - loss(-f) = -f, so the good documents pull by their mean alone
        return prior * missed + negative + extra, grad_all - prior * mean_good + pull, bend_all + curve

    # at zero the negative part is (1 - prior) log 2, so there is a place to start from
    return Model(scale, _descend(risk, d), prior)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows to test on: the CRC-32 of the identifier as text leaves 0 modulo 5."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def trusted(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Identifiers that all their labels call good."""
    return (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.min(label_col).alias("least"))
        .where("least = 1")
        .select("doc_id")
    )


def quality_scores(
    docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of `docs`: doc_id, score (0 to 1), predicted (1 from 0.3 on).

    `good` holds the identifiers of the trusted documents. The score depends on the whole text
    alone: equal texts get equal scores. Null counts as empty, which has a score too. Rows
    that repeat an identifier, or have none, are judged one by one. Without a trusted document
    every score is a half. An empty table gives no rows. Other columns are not read.
    """
    marks = good.select(F.col("doc_id").cast("long")).distinct().withColumn("good", F.lit(True))
    held = materialize(
        text_features(docs, id_col, text_col)
        .join(marks, "doc_id", "left")
        .select("doc_id", "x", F.coalesce("good", F.lit(False)).alias("good")),
        "quality-features",
    )
    model = fit(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= KEPT).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return map_arrow(held.select("doc_id", "x"), run, "doc_id long, score double, predicted int")


def op13_quality(spark, sf_dir):
    good = trusted(table(spark, sf_dir, "labels")).where(~held_out())
    scores = quality_scores(table(spark, sf_dir, "documents"), good)
    return scores.select("doc_id", held_out().alias("held_out"), "score", "predicted")
