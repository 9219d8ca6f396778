"""Toxicity: a cumulative-link ordinal regression on sparse word features.

One weight vector is shared by all thresholds: the probability that a text is worse than grade k is
the logistic function of (weights · features − threshold k), with thresholds in increasing order. The
output is the expected grade, the sum of these probabilities. The model is fitted on a bounded sample
of labelled rows (``SAMPLE``); every whole text is scored by a vectorised map without a shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.llm.catalog import held_out, id_and_text, register, table
from textloom.llm.learning import labelled_sample
from textloom.llm.text import Words, chunks, slices, span_hashes, texts_of

#: Labelled rows to learn from, at most, and word features, at most.
SAMPLE = 5000
FEATURES = 4000
#: Lengths of the heads of words that are features beside the words.
HEADS = (3, 5, 7)
GRADES = 4


def present(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and heads of longer words of all texts: (text number, hash), sorted by text."""
    words = Words(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.firsts))
    owners, hashes = [owner], [words.hashes]
    for size in HEADS:
        longer = words.ends - words.starts > size
        starts = words.starts[longer]
        owners.append(owner[longer])
        hashes.append(~span_hashes(words.chunk.cps, starts, starts + size))  # another feature than the whole word
    o, h = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((h, o))
    o, h = o[order], h[order]
    fresh = np.ones(len(h), bool)
    if len(h) > 1:
        fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return o[fresh], h[fresh]


class Severity(NamedTuple):
    """Sorted word hashes with their weights, and ordered thresholds."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, texts: list[str]) -> np.ndarray:
        """Probability of a grade above 0, 1, ... for each text."""
        owner, hashes = present(texts)
        linear = np.zeros(len(texts))
        if len(self.words) and len(hashes):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = self.words[at] == hashes
            linear = np.bincount(owner[hit], self.weights[at[hit]], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(linear[:, None] - self.thresholds, -40, 40)))


def graded(owner: np.ndarray, hashes: np.ndarray, toxic: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Grades for rows that only have a 0/1 label.

    Label 0 is grade 0. Toxic rows get 1 to ``grades - 1`` by how many of the words that mark toxic
    rows they hold, cut at even quantiles of that number.
    """
    out = np.zeros(len(toxic), np.int64)
    if not toxic.any():
        return out
    words, at = np.unique(hashes, return_inverse=True)
    with_label = np.bincount(at, toxic[owner], minlength=len(words))
    without = np.bincount(at, 1 - toxic[owner], minlength=len(words))
    odds = np.log((with_label + 0.5) / (toxic.sum() + 1)) - np.log((without + 0.5) / ((1 - toxic).sum() + 1))
    marks = (with_label >= 3) & (odds > 2)
    held = np.bincount(owner, marks[at], minlength=len(toxic))
    cuts = np.quantile(held[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    out[toxic == 1] = 1 + (held[toxic == 1][:, None] > cuts).sum(1)
    return out


def fit(owner: np.ndarray, hashes: np.ndarray, grade: np.ndarray, grades: int = GRADES, steps: int = 300, rate: float = 0.05, decay: float = 1e-4) -> Severity:
    """Maximum likelihood with a small penalty, by Adam on all rows; deterministic."""
    rows = len(grade)
    if not rows or not grade.any():
        return Severity(np.empty(0, np.uint64), np.empty(0), np.arange(grades - 1) + 5.0)
    words, at = np.unique(hashes, return_inverse=True)
    bad = grade > 0
    a = np.bincount(at, bad[owner], minlength=len(words))
    total = np.bincount(at, minlength=len(words))
    share = bad.mean()
    # words whose share of bad rows differs most from the average, seen three times at least
    gain = np.where(total >= 3, np.abs(a - share * total) / np.sqrt(np.maximum(total * share * (1 - share), 1e-9)), -1)
    chosen = np.sort(np.argsort(-gain, kind="stable")[: min(FEATURES, int((gain >= 0).sum()))])
    number = np.full(len(words), -1)
    number[chosen] = np.arange(len(chosen))
    f = number[at]
    o, f = owner[f >= 0], f[f >= 0]
    w = np.zeros(len(chosen))
    above = np.clip([(grade > k).mean() for k in range(grades - 1)], 1e-3, 1 - 1e-3)
    first = -np.log(above / (1 - above))
    theta = np.concatenate(([first[0]], np.log(np.maximum(np.diff(first), 0.1))))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(theta), np.zeros_like(theta)]
    y = grade.astype(int)
    for t in range(1, steps + 1):
        cuts = theta[0] + np.concatenate(([0], np.cumsum(np.exp(theta[1:]))))
        linear = np.bincount(o, w[f], minlength=rows)
        # P(y = k) = F(cut k) - F(cut k-1), with F the distribution of the latent severity
        cdf = np.hstack((np.zeros((rows, 1)), 1 / (1 + np.exp(-np.clip(cuts - linear[:, None], -40, 40))), np.ones((rows, 1))))
        slope = cdf * (1 - cdf)
        r = np.arange(rows)
        p = np.maximum(cdf[r, y + 1] - cdf[r, y], 1e-12)
        d_linear = (slope[r, y + 1] - slope[r, y]) / p / rows
        d_cuts = np.zeros(grades - 1)
        for k in range(grades - 1):
            d_cuts[k] = (-(slope[:, k + 1] / p)[y == k].sum() + (slope[:, k + 1] / p)[y == k + 1].sum()) / rows
        tail = np.cumsum(d_cuts[::-1])[::-1]
        g_theta = np.concatenate(([tail[0]], tail[1:] * np.exp(theta[1:])))
        g_w = np.bincount(f, d_linear[o], minlength=len(w)) + decay * w
        for x, g, m, v in ((w, g_w, state[0], state[1]), (theta, g_theta, state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
    return Severity(words[chosen], w, theta[0] + np.concatenate(([0], np.cumsum(np.exp(theta[1:])))))


def fit_severity(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, grades: int = GRADES) -> Severity:
    """Learn from ``labels(doc_id, toxic)`` of at most ``limit`` rows outside the held-out fifth."""
    sample = labelled_sample(docs, labels, "toxic", limit)

    def words(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(2))
            for lo, hi in chunks(texts):
                owner, hashes = present(texts[lo:hi])
                cut = np.searchsorted(owner, np.arange(hi - lo + 1)).tolist()
                parts = pa.array([hashes[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], parts], names=["doc_id", "label", "words"])

    kept = sorted(sample.mapInArrow(words, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, label int, words binary").collect(), key=lambda r: str(r[0]))
    parts = [np.frombuffer(bytes(r[2]), np.uint64) for r in kept]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts]).astype(np.int64)
    hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    toxic = np.array([r[1] > 0 for r in kept], np.int64)
    return fit(owner, hashes, graded(owner, hashes, toxic, grades), grades)


def score_severity(docs: DataFrame, model: Severity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, severity, grade, p_toxic``: one row per input row.

    ``severity`` is the expected grade, ``grade`` the largest one that is exceeded or met with
    probability of one half. Null and empty texts have no features and get the lowest severity.
    """
    source = id_and_text(docs, id_col, text_col)

    def score(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            for lo, hi in chunks(texts):
                above = model.above(texts[lo:hi])
                columns = [pa.array(above.sum(1)), pa.array((above >= 0.5).sum(1).astype(np.int32)), pa.array(above[:, 0].copy())]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *columns], names=["doc_id", "severity", "grade", "p_toxic"])

    return source.mapInArrow(score, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, severity double, grade int, p_toxic double")


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; ``predicted`` is 1 where the text is more likely toxic than not."""
    docs = table(spark, sf_dir, "documents")
    scored = score_severity(docs, fit_severity(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "severity", "grade", "p_toxic", (F.col("grade") > 0).cast("int").alias("predicted")
    )
