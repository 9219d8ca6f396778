"""From query objects to DataFrames.

A query on stored columns becomes a predicate, which Spark pushes into the scan.
A query on text becomes scored rows from postings. A boolean query merges all of
its predicates into one scan of the documents and all of its scored parts into
one union with one aggregation on ``_id``; there is no chain of joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from textloom.functions import geo
from textloom.functions.dates import parse_date
from textloom.operators.analyzers import Analyzer
from textloom.operators.scoring import match_scores, multi_match_scores, phrase_scores, query_terms, term_scores, union_all
from textloom.plans import queries as Q
from textloom.plans.mapping import Field
from textloom.sources.collection import Collection
from textloom.sources.ingest import has_search_form, ip_key, searchable


@dataclass(frozen=True)
class Filtered:
    """Documents by a predicate, each with a score that is a Column."""

    predicate: Column
    score: Column


@dataclass(frozen=True)
class Scored:
    """Scored document keys ``(_id, score)``."""

    rows: DataFrame


def compile_query(index: Collection, q: Q.Query) -> Filtered | Scored:
    p = predicate(index, q)
    if p is not None:
        return Filtered(p, F.lit(1.0))
    if isinstance(q, Q.Bool):
        return _bool(index, q)
    return Scored(_text(index, q))


def hits(index: Collection, q: Q.Query) -> DataFrame:
    """``(_id, score)`` of any query."""
    c = compile_query(index, q)
    return c.rows if isinstance(c, Scored) else index.docs.where(c.predicate).select("_id", c.score.alias("score"))


def predicate(index: Collection, q: Q.Query) -> Column | None:
    """The query as a Column over the documents, or None where it needs postings."""
    if isinstance(q, Q.MatchAll):
        return F.lit(True)
    if isinstance(q, Q.Exists):
        path = _column(index, q.field)
        several = isinstance(_type(index, path), T.ArrayType)
        return (F.col(path).isNotNull() & (F.size(path) > 0)) if several else F.col(path).isNotNull()
    if isinstance(q, (Q.Term, Q.Prefix)) and q.field in index.text:
        return None
    if isinstance(q, (Q.Term, Q.Range, Q.Prefix)):
        _check_indexed(index, q.field)
        f, path = index.mapping.get(q.field), _column(index, q.field)
        dtype = _type(index, path)
        if f is None or not has_search_form(f) or isinstance(dtype, T.ArrayType):
            return column_test(q, F.col(path), dtype, None if f is None else f.null_value)
        derived = f"{path}__search"
        ready = derived in index.schema_on_read.names or "__" in path
        column = F.col(derived if derived in index.schema_on_read.names else path)
        return column_test(q, column if ready else searchable(f, column, index.settings), dtype, None, _asked(index, f))
    if isinstance(q, Q.GeoDistance):
        return geo.within(F.col(q.field), q.lat, q.lon, geo.parse_distance(q.distance))
    if isinstance(q, Q.Nested):
        return F.exists(q.path, lambda x: _inside(index, q.query, x, q.path))
    return None


def _check_indexed(index: Collection, name: str) -> None:
    f = index.mapping.get(name)
    if f is not None and f.index is False:
        raise ValueError(f"{name} is not indexed")


def _column(index: Collection, name: str) -> str:
    """The column of a field; a keyword multi-field ``a.b`` stands in ``a__b``."""
    flat = name.replace(".", "__")
    return flat if flat in index.schema_on_read.names else name


def _asked(index: Collection, f: Field) -> Callable[[object], Column]:
    """A value of a query in the form in which the field is searched."""
    if f.type in ("ip", "ip_range"):
        return lambda v: ip_key(F.lit(v))
    if f.normalizer:
        return lambda v: index.settings.get_normalizer(f.normalizer).apply(F.lit(v))
    return F.lit


def _type(index: Collection, name: str) -> T.DataType | None:
    found: T.DataType = index.schema_on_read
    for part in name.split("."):
        if not isinstance(found, T.StructType) or part not in found.names:
            return None
        found = found[part].dataType
    return found


def column_test(q: Q.Query, col: Column, dtype: T.DataType | None, null_value: object = None, value: Callable[[object], Column] = F.lit) -> Column:
    """Term, range and prefix on one column; plain comparisons, so that they push down.

    ``value`` gives a query's value in the form in which the column holds it.
    """
    if null_value is not None:
        col = F.coalesce(col, F.lit(null_value))
    if isinstance(q, Q.Term):
        values = list(q.value) if isinstance(q.value, (list, tuple, set)) else [q.value]
        if isinstance(dtype, T.ArrayType):
            return F.arrays_overlap(col, F.array(*[value(v) for v in values]))
        return col == value(values[0]) if len(values) == 1 else col.isin([value(v) for v in values])
    if isinstance(q, Q.Prefix):
        return col.startswith(value(q.text))
    bound = (lambda v: parse_date(F.lit(v), q.format)) if q.format else value
    if isinstance(dtype, T.StructType) and {"gte", "lte"} <= set(dtype.names):
        # two ranges meet where each begins before the other ends
        tests = []
        if q.lte is not None or q.lt is not None:
            tests.append(col["gte"] <= bound(q.lte) if q.lte is not None else col["gte"] < bound(q.lt))
        if q.gte is not None or q.gt is not None:
            tests.append(col["lte"] >= bound(q.gte) if q.gte is not None else col["lte"] > bound(q.gt))
        return reduce(lambda a, b: a & b, tests)
    tests = [
        test(bound(v))
        for v, test in ((q.gt, lambda b: col > b), (q.gte, lambda b: col >= b), (q.lt, lambda b: col < b), (q.lte, lambda b: col <= b))
        if v is not None
    ]
    return reduce(lambda a, b: a & b, tests)


def row_test(q: Q.Query, schema: T.StructType) -> Column:
    """A query on plain columns as a predicate that is never NULL, for frames without an index."""
    if isinstance(q, Q.Bool):
        tests = [row_test(x, schema) for x in q.must + q.filter] + [~row_test(x, schema) for x in q.must_not]
        if q.should and not (q.must or q.filter):
            tests.append(_any([row_test(x, schema) for x in q.should]))
        return _all(tests) if tests else F.lit(True)
    if isinstance(q, Q.MatchAll):
        return F.lit(True)
    if isinstance(q, Q.Exists):
        return F.col(q.field).isNotNull()
    if isinstance(q, (Q.Term, Q.Range, Q.Prefix)):
        return F.coalesce(column_test(q, F.col(q.field), schema[q.field].dataType if q.field in schema.names else None), F.lit(False))
    raise ValueError(f"{type(q).__name__} needs an index")


def _inside(index: Collection, q: Q.Query, element: Column, path: str) -> Column:
    """A query on the fields of one nested element. Text is matched by its words, without a score."""
    inner = lambda x: _inside(index, x, element, path)
    if isinstance(q, Q.Bool):
        every = [inner(x) for x in q.must + q.filter] + [~F.coalesce(inner(x), F.lit(False)) for x in q.must_not]
        some = [inner(x) for x in q.should]
        if some and not (q.must or q.filter):
            every.append(reduce(lambda a, b: a | b, some))
        return reduce(lambda a, b: a & b, every) if every else F.lit(True)
    if not isinstance(q, (Q.Term, Q.Range, Q.Prefix, Q.Exists, Q.Match)):
        raise ValueError(f"{type(q).__name__} is not known inside a nested query")
    name = q.field.removeprefix(path + ".")
    if isinstance(q, Q.Exists):
        return element[name].isNotNull()
    if not isinstance(q, Q.Match):
        return column_test(q, element[name], None)
    f = index.mapping.get(f"{path}.{name}")
    stored = index.settings.get_analyzer((f.analyzer if f else None) or "standard")
    asked = _analyzer(index, q.analyzer or (f.search_analyzer if f else None)) or stored
    words = sorted({t for _, t in query_terms(index.spark, asked, q.text)})
    if q.fuzziness not in (None, 0, "0"):
        raise ValueError("fuzziness is not known inside a nested query")
    if not words:
        return F.lit(False)
    held = F.transform(stored.array(element[name]), lambda t: t["token"])
    has = [F.array_contains(held, w) for w in words]
    return reduce((lambda a, b: a & b) if q.operator.upper() == "AND" else (lambda a, b: a | b), has)


def _analyzer(index: Collection, name: str | None) -> Analyzer | None:
    return index.settings.get_analyzer(name) if name else None


def _text(index: Collection, q: Q.Query) -> DataFrame:
    if isinstance(q, Q.Match):
        return match_scores(
            index, q.field, q.text, _analyzer(index, q.analyzer), q.boost, q.operator,
            fuzziness=q.fuzziness, prefix_length=q.prefix_length, max_expansions=q.max_expansions,
        )
    if isinstance(q, Q.Phrase):
        return phrase_scores(index, q.field, q.text, _analyzer(index, q.analyzer), q.boost, q.last_is_prefix)
    if isinstance(q, Q.MultiMatch):
        return multi_match_scores(
            index, q.boosted(), q.text, _analyzer(index, q.analyzer), q.type, q.operator,
            fuzziness=q.fuzziness, prefix_length=q.prefix_length, max_expansions=q.max_expansions,
        )
    if isinstance(q, Q.Term):
        values = list(q.value) if isinstance(q.value, (list, tuple, set)) else [q.value]
        rows = term_scores(index, q.field, [(i, str(v), 1.0) for i, v in enumerate(dict.fromkeys(values))])
        return rows.groupBy("_id").agg(F.sum("score").alias("score"))
    if isinstance(q, Q.Prefix):
        return index.prefix_postings(q.field, q.text).select("_id").distinct().withColumn("score", F.lit(1.0))
    raise ValueError(f"no such query: {q!r}")


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _bool(index: Collection, q: Q.Bool) -> Filtered | Scored:
    def split(clauses: tuple[Q.Query, ...]) -> tuple[list[Filtered], list[DataFrame]]:
        done = [compile_query(index, c) for c in clauses]
        return [c for c in done if isinstance(c, Filtered)], [c.rows for c in done if isinstance(c, Scored)]

    must, must_rows = split(q.must)
    flt, flt_rows = split(q.filter)
    should, should_rows = split(q.should)
    no, no_rows = split(q.must_not)
    optional = bool(q.must or q.filter)
    no = [F.coalesce(c.predicate, F.lit(False)) for c in no]
    zero = F.lit(0.0)
    bonus = [F.when(c.predicate, c.score).otherwise(zero) for c in should]
    fixed = [c.score for c in must]
    required = [c.predicate for c in must + flt]

    if not (must_rows or flt_rows or should_rows or no_rows):
        # stored columns only: one predicate, no shuffle
        tests = required + [~t for t in no]
        if should and not optional:
            tests.append(_any([c.predicate for c in should]))
        total = reduce(lambda a, b: a + b, fixed + bonus, zero)
        return Filtered(_all(tests) if tests else F.lit(True), total)

    # rows (_id, score, req, opt, bad): one per clause group that a document meets
    def rows(df: DataFrame, score: Column, req: Column, opt: Column, bad: Column) -> DataFrame:
        return df.select("_id", score.alias("score"), req.cast("int").alias("req"), opt.cast("int").alias("opt"), bad.cast("int").alias("bad"))

    one, none = F.lit(1), F.lit(0)
    parts = [rows(df, F.col("score"), one, none, none) for df in must_rows]
    parts += [rows(df, zero, one, none, none) for df in flt_rows]
    parts += [rows(df, F.col("score"), none, one, none) for df in should_rows]
    parts += [rows(df, zero, none, none, one) for df in no_rows]
    n_required = len(must_rows) + len(flt_rows)
    positive = optional or bool(q.should)
    if required or not positive:
        # the documents' own conditions in one scan, with what their optional clauses add
        tests = required + [~t for t in no]
        scan = index.docs.where(_all(tests)) if tests else index.docs
        own = reduce(lambda a, b: a + b, fixed + bonus, zero)
        n_opt = reduce(lambda a, b: a + b, [F.when(c.predicate, 1).otherwise(0) for c in should], none)
        parts.append(rows(scan, own, one, n_opt, none))
        n_required += 1
    else:
        if should:
            scan = index.docs.where(_any([c.predicate for c in should]))
            parts.append(rows(scan, reduce(lambda a, b: a + b, bonus), none, one, none))
        if no:
            parts.append(rows(index.docs.where(_any(no)), zero, none, none, one))
    merged = union_all(parts).groupBy("_id").agg(
        F.sum("score").alias("score"), F.sum("req").alias("req"), F.sum("opt").alias("opt"), F.sum("bad").alias("bad")
    )
    keep = (F.col("req") == n_required) & (F.col("bad") == 0)
    if not optional and q.should:
        keep = keep & (F.col("opt") > 0)
    return Scored(merged.where(keep).select("_id", "score"))
