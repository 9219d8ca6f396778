"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata.

Every feature has a weight and a short vector; pairs of features interact by the product of their
vectors. All pairs are summed in linear time, as half the difference between the squared sum and the
sum of squares. The model is fitted on a bounded sample of labelled rows (``SAMPLE``) and applied to
every whole text by a vectorised map without a shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.llm.catalog import held_out, register, table
from textloom.llm.learning import labelled_sample
from textloom.llm.text import LETTER, NUMBER, SPACE, Words, chunks, slices, texts_of, uppers

#: Labelled rows to learn from, at most.
SAMPLE = 6000
#: Buckets of hashed words, and length of the interaction vectors.
BUCKETS = 1024
RANK = 6
#: Documents with a lower score are rejected.
THRESHOLD = 0.3

_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]


def _shares(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (sums[ends] - sums[starts]) / sizes


def structure(words: Words, texts: list[str], n_chars: np.ndarray) -> np.ndarray:
    """Statistics of each text's form (not of its words), one row per text."""
    chunk = words.chunk  # in lower case; cases are counted on the text itself
    starts, ends = chunk.starts, chunk.ends
    sizes = np.maximum(ends - starts, 1).astype(float)
    owner = np.repeat(np.arange(len(texts)), ends - starts)
    plain = chunk.cps < 128
    grid = np.bincount(owner[plain] * 128 + chunk.cps[plain], minlength=128 * len(texts)).reshape(len(texts), 128)
    given = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    given_sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    given_ends = np.cumsum(given_sizes)
    letters = np.maximum(_shares(chunk.kinds == LETTER, starts, ends, np.ones_like(sizes)), 1)
    counts = np.diff(words.firsts)
    many = np.maximum(counts, 1).astype(float)
    of = np.repeat(np.arange(len(texts)), counts)
    repeated = np.zeros(len(words.hashes))
    if len(of) > 1:
        repeated[1:] = (words.hashes[1:] == words.hashes[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((words.hashes, of))
    h, o = words.hashes[order], of[order]
    fresh = np.ones(len(h), bool)
    if len(h) > 1:
        fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[fresh], minlength=len(texts)) if len(o) else np.zeros(len(texts))
    lengths = np.bincount(of, words.ends - words.starts, minlength=len(texts)) if len(of) else np.zeros(len(texts))
    columns = [
        np.log1p(ends - starts),
        np.log1p(np.maximum(n_chars, 0)),
        np.log1p(counts),
        lengths / many / 10,
        distinct / many,
        np.bincount(of, repeated, minlength=len(texts)) / many if len(of) else np.zeros(len(texts)),
        _shares(uppers()[given], given_ends - given_sizes, given_ends, letters),
        _shares(chunk.kinds == NUMBER, starts, ends, sizes),
        _shares(chunk.kinds == SPACE, starts, ends, sizes),
        np.sqrt(grid[:, 10] / sizes),
        counts == 0,
        *(np.sqrt(grid[:, c] / many) for c in _SIGNS),
    ]
    return np.stack(columns, 1).astype(np.float32)


def features(texts: list[str], n_chars: np.ndarray) -> np.ndarray:
    """Word buckets (logarithmic counts of unit length), then the statistics, one row per text."""
    words = Words(texts)
    counts = np.diff(words.firsts)
    owner = np.repeat(np.arange(len(texts)), counts)
    bucket = (words.hashes % np.uint64(BUCKETS)).astype(np.int64)
    hashed = np.log1p(np.bincount(owner * BUCKETS + bucket, minlength=BUCKETS * len(texts)).reshape(len(texts), BUCKETS)).astype(np.float32)
    hashed /= np.maximum(np.linalg.norm(hashed, axis=1, keepdims=True), 1e-6)
    return np.hstack((hashed, structure(words, texts, n_chars)))


class Machine(NamedTuple):
    """Shift and scale of the features, bias, weights and interaction vectors."""

    shift: np.ndarray
    scale: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        x = np.clip((x - self.shift) * self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(_raw(x, self.bias, self.weights, self.vectors), -30, 30)))


def _raw(x: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    sums = x @ vectors
    return bias + x @ weights + 0.5 * ((sums**2).sum(1) - (x**2) @ (vectors**2).sum(1))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 0.01, decay: float = 1e-4) -> Machine:
    """Logistic loss by Adam; deterministic. Without rows the score is 0.5, with one class near that class."""
    width = x.shape[1]
    if not len(y):
        return Machine(np.zeros(width, np.float32), np.ones(width, np.float32), 0.0, np.zeros(width, np.float32), np.zeros((width, RANK), np.float32))
    shift, spread = x.mean(0), x.std(0)
    shift[:BUCKETS] = 0
    scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0).astype(np.float32)
    scale[:BUCKETS] = 4.0
    z = np.clip((x - shift) * scale, -8, 8).astype(np.float32)
    rng = np.random.default_rng(7)
    rate_of_one = np.clip(y.mean(), 0.01, 0.99)
    params = [np.array([np.log(rate_of_one / (1 - rate_of_one))], np.float32), np.zeros(width, np.float32), rng.normal(0, 0.01, (width, RANK)).astype(np.float32)]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            rows = order[k : k + batch]
            part = z[rows]
            sums = part @ params[2]
            error = (1 / (1 + np.exp(-np.clip(_raw(part, params[0][0], params[1], params[2]), -30, 30))) - y[rows]) / len(rows)
            grads = [
                np.array([error.sum()]),
                part.T @ error + decay * params[1],
                part.T @ (error[:, None] * sums) - params[2] * ((part**2).T @ error)[:, None] + decay * params[2],
            ]
            step += 1
            for p, m, v, g in zip(params, means, squares, grads, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Machine(shift.astype(np.float32), scale, float(params[0][0]), params[1], params[2])


def _inputs(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_chars``; the metadata may be missing."""
    size: Column = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.char_length("text")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(size, F.lit(0)).cast("long").alias("n_chars"))


def _featured(batch: pa.RecordBatch, at: int = 1):
    texts, sizes = texts_of(batch.column(at)), batch.column(at + 1).to_numpy(zero_copy_only=False)
    for lo, hi in chunks(texts):
        yield lo, hi, features(texts[lo:hi], sizes[lo:hi].astype(float))


def fit_quality(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Machine:
    """Learn from ``labels(doc_id, quality)`` of at most ``limit`` rows; ids divisible into the held-out fifth never count."""
    sample = labelled_sample(docs, labels, "quality", limit)
    sizes = docs.select("doc_id", "n_chars").groupBy("doc_id").agg(F.max("n_chars").alias("n_chars")) if "n_chars" in docs.columns else None
    rows = sample if sizes is None else sample.join(sizes, "doc_id", "left")
    inputs = _inputs(rows).join(F.broadcast(rows.select(F.col("doc_id").alias("_id"), "label")), F.col("doc_id") == F.col("_id")).select("label", "text", "n_chars", "doc_id")

    def featurise(batches):
        for batch in slices(batches):
            for lo, hi, x in _featured(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(3)[lo:hi], batch.column(0)[lo:hi], pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary())], names=["doc_id", "label", "x"]
                )

    kept = sorted(inputs.mapInArrow(featurise, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, x binary").collect(), key=lambda r: str(r[0]))
    width = features([""], np.zeros(1)).shape[1]
    x = np.frombuffer(b"".join(bytes(r[2]) for r in kept), np.float32).reshape(-1, width)
    return fit(x.copy(), np.array([r[1] for r in kept], np.float32))


def score_quality(docs: DataFrame, model: Machine) -> DataFrame:
    """``doc_id, score``: one row per input row; empty and null texts are scored too."""
    source = _inputs(docs)

    def score(batches):
        for batch in slices(batches):
            for lo, hi, x in _featured(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(model.scores(x).astype(float), pa.float64())], names=["doc_id", "score"])

    return source.mapInArrow(score, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    model = fit_quality(docs, labels)
    text_at, size_at = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def keep(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(text_at))
            sizes = [len(t) for t in texts] if size_at is None else [n or 0 for n in batch.column(size_at).to_pylist()]
            for lo, hi in chunks(texts):
                good = model.scores(features(texts[lo:hi], np.array(sizes[lo:hi], float))) >= threshold
                yield batch.slice(lo, hi - lo).filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


@register("op8_quality_machine")
def op8_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
