"""Relevance formulas of one term in one document, as Columns.

``tf`` in the document, ``dl`` tokens of the document, ``df`` documents with the
term, ``ctf`` occurrences in the collection. Collection totals are two numbers
per field.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class FieldStats:
    n_docs: int
    n_tokens: int

    @property
    def avg_len(self) -> float:
        return self.n_tokens / self.n_docs if self.n_docs else 0.0


# Parameters of the formulas.
K1, B = 1.2, 0.75
MU = 2000.0
LAMBDA = 0.1


def idf(df: Column, stats: FieldStats) -> Column:
    return F.log(F.lit(1.0) + (F.lit(float(stats.n_docs)) - df + F.lit(0.5)) / (df + F.lit(0.5)))


def saturation(tf: Column, dl: Column, stats: FieldStats, norms: bool = True) -> Column:
    """Term frequency part of BM25; without norms no length correction."""
    b = B if norms else 0.0
    length = F.lit(1.0 - b) + F.lit(b) * dl / F.lit(stats.avg_len or 1.0)
    return tf * F.lit(K1 + 1.0) / (tf + F.lit(K1) * length)


def bm25(tf, dl, df, ctf, stats: FieldStats, norms: bool = True) -> Column:
    return idf(df, stats) * saturation(tf, dl, stats, norms)


def lm_dirichlet(tf, dl, df, ctf, stats: FieldStats, norms: bool = True) -> Column:
    p = ctf / F.lit(float(stats.n_tokens))
    return _floor0(F.log(F.lit(1.0) + tf / (F.lit(MU) * p)) + F.log(F.lit(MU) / (dl + F.lit(MU))))


def lm_jelinek_mercer(tf, dl, df, ctf, stats: FieldStats, norms: bool = True) -> Column:
    p = ctf / F.lit(float(stats.n_tokens))
    return _floor0(F.log(F.lit(1.0) + (F.lit(1.0 - LAMBDA) * tf / dl) / (F.lit(LAMBDA) * p)))


def dfr(tf, dl, df, ctf, stats: FieldStats, norms: bool = True) -> Column:
    return _floor0(tf / (tf + F.lit(1.0)) * F.log2(F.lit(stats.n_docs + 1.0) / (df + F.lit(0.5))))


def dfi(tf, dl, df, ctf, stats: FieldStats, norms: bool = True) -> Column:
    expected = ctf * dl / F.lit(float(stats.n_tokens))
    return F.when(tf <= expected, F.lit(0.0)).otherwise(F.log2(F.lit(1.0) + F.pow(tf - expected, 2) / expected))


def ib(tf, dl, df, ctf, stats: FieldStats, norms: bool = True) -> Column:
    lam = df / F.lit(float(stats.n_docs))
    return _floor0(F.log((lam + tf) / lam))


def _floor0(c: Column) -> Column:
    return F.greatest(F.lit(0.0), c)


SIMILARITY = {"BM25": bm25, "LMDirichlet": lm_dirichlet, "LMJelinekMercer": lm_jelinek_mercer, "DFR": dfr, "DFI": dfi, "IB": ib}
