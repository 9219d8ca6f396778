"""SQL twins of scored search: the same formulas over token tables."""

from __future__ import annotations

from textloom.catalog.common import STD_LOW, q, sql_tokens

# The formulas as SQL over tf, dl, df, ctf, n (documents) and c (tokens).
FORMULAS = {
    "BM25": "ln(1::DOUBLE + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (c::DOUBLE / n))))",
    "LMDirichlet": "greatest(0::DOUBLE, ln(1::DOUBLE + tf / (2000::DOUBLE * (ctf / c::DOUBLE))) + ln(2000::DOUBLE / (dl + 2000::DOUBLE)))",
    "LMJelinekMercer": "greatest(0::DOUBLE, ln(1::DOUBLE + (0.9::DOUBLE * tf / dl) / (0.1::DOUBLE * (ctf / c::DOUBLE))))",
    "DFR": "greatest(0::DOUBLE, tf / (tf + 1::DOUBLE) * log2((n + 1::DOUBLE) / (df + 0.5::DOUBLE)))",
    "DFI": "CASE WHEN tf <= ctf * dl / c::DOUBLE THEN 0::DOUBLE ELSE log2(1::DOUBLE + pow(tf - ctf * dl / c::DOUBLE, 2) / (ctf * dl / c::DOUBLE)) END",
    "IB": "greatest(0::DOUBLE, ln((df / n::DOUBLE + tf) / (df / n::DOUBLE)))",
}

DOCS = """wd AS (SELECT CAST(d.doc_id AS VARCHAR) AS _id, text, lang, source, n_chars, CASE WHEN d.doc_id % 7 <> 0 THEN source END AS origin,
  CAST(coalesce(quality, 0) * 10 + 1 AS INTEGER) AS weight FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

TURN_ID = "conv_id || '-' || turn"
PART_ID = "CAST(p_partkey AS VARCHAR)"


def field(name: str, words: str = STD_LOW, source: str = "documents", _id: str = "CAST(doc_id AS VARCHAR)", formula: str = "BM25") -> str:
    """CTEs of one field: ``{name}_tok``, ``_tf``, ``_df``, ``_st``, ``_dl`` and the per-term scores ``{name}_s``."""
    return f"""{name}_tok AS ({sql_tokens(words, source, _id)}),
    {name}_dl AS (SELECT _id, count(*) AS dl FROM {name}_tok GROUP BY _id),
    {name}_st AS (SELECT (SELECT count(*) FROM {source}) AS n, (SELECT count(*) FROM {name}_tok) AS c),
    {name}_tf AS (SELECT _id, token, count(*) AS tf FROM {name}_tok GROUP BY 1, 2),
    {name}_df AS (SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM {name}_tf GROUP BY 1),
    {name}_s AS (SELECT t._id, t.token, {FORMULAS[formula]} AS score FROM {name}_tf t JOIN {name}_dl d ON d._id = t._id JOIN {name}_df f ON f.token = t.token, {name}_st)"""


def words_of(column: str) -> str:
    return STD_LOW.replace("text", column, 1)


def part_field(name: str, column: str) -> str:
    return field(name, words_of(column), "part", PART_ID)


def match(name: str, terms: list[str], weight: str = "1::DOUBLE", every: bool = False) -> str:
    """``(_id, score)`` of a list of terms, repeated ones counted again."""
    values = ", ".join(f"({i}, {q(t)})" for i, t in enumerate(terms))
    having = f" HAVING count(DISTINCT w.i) = {len(terms)}" if every else ""
    return f"SELECT s._id, sum({weight} * s.score) AS score FROM {name}_s s JOIN (VALUES {values}) w(i, token) ON w.token = s.token GROUP BY s._id{having}"


def fuzzy_rows(name: str, terms: list[str], edits: str, prefix: int = 0, weight: str = "1::DOUBLE") -> str:
    """``(_id, i, score)`` over all near vocabulary terms of each query term."""
    values = ", ".join(f"({i}, {q(t)})" for i, t in enumerate(terms))
    near = f" AND left(f.token, {prefix}) = left(w.q, {prefix})" if prefix else ""
    return f"""SELECT s._id, e.i, {weight} * (1::DOUBLE - e.d / least(length(e.q), length(e.token))::DOUBLE) * s.score AS score FROM (
        SELECT * FROM (
          SELECT w.i, w.q, f.token, f.df, levenshtein(w.q, f.token) AS d FROM (VALUES {values}) w(i, q), {name}_df f WHERE abs(length(w.q) - length(f.token)) <= 2 AND levenshtein(w.q, f.token) <= {edits}{near}) x) e
      JOIN {name}_s s ON s.token = e.token WHERE e.d < least(length(e.q), length(e.token))"""


AUTO = "(CASE WHEN length(w.q) <= 2 THEN 0 WHEN length(w.q) <= 5 THEN 1 ELSE 2 END)"


def phrase(name: str, terms: list[str], last_prefix: bool = False) -> str:
    """``(_id, score)`` of adjacent terms, by position joins."""
    tests = [f"t{i}.token = {q(t)}" if not (last_prefix and i == len(terms) - 1) else f"starts_with(t{i}.token, {q(t)})" for i, t in enumerate(terms)]
    joins = "".join(f" JOIN {name}_tok t{i} ON t{i}._id = t0._id AND t{i}.position = t0.position + {i}" for i in range(1, len(terms)))
    dfs = [f"(SELECT max(df) FROM {name}_df WHERE " + (f"token = {q(t)}" if not (last_prefix and i == len(terms) - 1) else f"starts_with(token, {q(t)})") + ")" for i, t in enumerate(terms)]
    idfs = " + ".join(f"ln(1::DOUBLE + (n - {d} + 0.5::DOUBLE) / ({d} + 0.5::DOUBLE))" for d in dfs)
    return f"""SELECT p._id, ({idfs}) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (c::DOUBLE / n)))) AS score
      FROM (SELECT t0._id, count(*) AS tf FROM {name}_tok t0{joins} WHERE {' AND '.join(tests)} GROUP BY 1) p JOIN {name}_dl d ON d._id = p._id, {name}_st"""


def hits(inner: str) -> str:
    return f"SELECT _id, round(score, 6) AS _score FROM ({inner}) h"


def top(inner: str, cols: str, docs: str, k: int, offset: int = 0) -> str:
    return f"SELECT d._id, h._score, {cols} FROM ({hits(inner)} ORDER BY _score DESC, _id LIMIT {k} OFFSET {offset}) h JOIN {docs} d ON d._id = h._id"
