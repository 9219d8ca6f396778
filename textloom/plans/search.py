"""Search requests: query clauses, paging, sorting, projection, rescoring."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from fnmatch import fnmatch
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from textloom.plans import queries as Q
from textloom.plans.compile import Filtered, compile_query
from textloom.session import materialize
from textloom.sources.collection import Collection, unused

# Limits of one request.
MAX_SIZE, MIN_SIZE, MAX_FROM, DEFAULT_SIZE = 2000, 1, 2000, 50
# Scores are compared and returned at this precision, so that ties are ties.
SCORE_DIGITS = 6


@dataclass(frozen=True)
class Search:
    """One request; ``size=None`` means all hits, without a page limit."""

    must: tuple[Q.Query, ...] = ()
    filter: tuple[Q.Query, ...] = ()
    should: tuple[Q.Query, ...] = ()
    must_not: tuple[Q.Query, ...] = ()
    match_all: bool = False
    size: int | None = DEFAULT_SIZE
    from_: int = 0
    sort: tuple[tuple[str, str], ...] = ()
    sort_script: tuple[Q.Script, str, str] | None = None
    search_after: tuple = ()
    source: tuple[str, ...] | None = None
    track_scores: bool = False
    score_script: Q.Script | None = None

    def validate(self) -> None:
        if self.search_after and not self.sort:
            raise ValueError("search_after needs a sort")
        if self.search_after and len(self.search_after) != len(self.sort):
            raise ValueError("search_after and sort must have the same length")
        if self.search_after and self.from_:
            raise ValueError("from and search_after exclude each other")
        if self.from_ > MAX_FROM:
            raise ValueError(f"from may be at most {MAX_FROM}")
        if self.size is not None and self.size > MAX_SIZE:
            raise ValueError(f"a page holds at most {MAX_SIZE} hits, not {self.size}; read_all returns every hit")
        if not self.match_all and not (self.must or self.filter or self.should or self.must_not):
            raise ValueError("a search needs a clause or match_all")

    def query(self) -> Q.Query:
        if self.match_all and not (self.must or self.filter or self.should or self.must_not):
            return Q.MatchAll()
        must = self.must + ((Q.MatchAll(),) if self.match_all else ())
        if len(must + self.should) == 1 and not (self.filter or self.must_not):
            return (must + self.should)[0]
        return Q.Bool(must, self.filter, self.should, self.must_not)

    def page(self) -> int | None:
        return None if self.size is None else max(MIN_SIZE, self.size)


def source_columns(df: DataFrame, patterns: tuple[str, ...] | None) -> list[str]:
    """Column names that match a list of names and ``*`` patterns."""
    # derived columns (name__...) are for searching, not part of the source
    names = [c for c in df.columns if c != "_id" and "__" not in c]
    if patterns is None:
        return names
    return [c for c in names if any(fnmatch(c, p) for p in patterns)]


def script_column(df: DataFrame, script: Q.Script) -> tuple[DataFrame, Column]:
    """The frame with the script's parameters in scope, and the script."""
    if script.params:
        df = df.withColumn("params", F.struct(*[F.lit(v).alias(k) for k, v in script.params.items()]))
    return df, F.expr(script.source)


def after(sort: tuple[tuple[str, str], ...], values: tuple) -> Column:
    """Rows that come after ``values`` in sort order: the first differing key decides."""

    def beyond(name: str, order: str, v: object) -> Column:
        col = F.col(name)
        if v is None:
            return F.lit(False)
        return ((col > F.lit(v)) if order == "asc" else (col < F.lit(v))) | col.isNull()

    def same(name: str, v: object) -> Column:
        return F.col(name).isNull() if v is None else F.col(name) == F.lit(v)

    tests = []
    for i, ((name, order), v) in enumerate(zip(sort, values)):
        tests.append(reduce(lambda a, b: a & b, [same(n, w) for (n, _), w in zip(sort[:i], values[:i])] + [beyond(name, order, v)]))
    return reduce(lambda a, b: a | b, tests)


def _order(sort: tuple[tuple[str, str], ...], backwards: bool = False) -> list[Column]:
    if backwards:
        return [F.col(n).desc_nulls_first() if o == "asc" else F.col(n).asc_nulls_first() for n, o in sort]
    return [F.col(n).asc_nulls_last() if o == "asc" else F.col(n).desc_nulls_last() for n, o in sort]


def matched(index: Collection, request: Search) -> DataFrame:
    """All matching documents with ``_score``, before sort and paging."""
    request.validate()
    c = compile_query(index, request.query())
    if isinstance(c, Filtered):
        df = index.docs.where(c.predicate).withColumn("_score", c.score)
    else:
        df = index.docs.join(c.rows.withColumnRenamed("score", "_score"), "_id")
    return _rescored(df, request)


def _rescored(df: DataFrame, request: Search) -> DataFrame:
    if request.score_script:
        df, score = script_column(df, request.score_script)
        df = df.withColumn("_score", score.cast("double"))
    return df.withColumn("_score", F.round("_score", SCORE_DIGITS))


def _with_keys(index: Collection, request: Search) -> tuple[DataFrame, tuple[tuple[str, str], ...]]:
    """The matches after the given point, with what they are sorted by: columns and their directions."""
    df = matched(index, request)
    if request.sort_script is not None:
        script, order, kind = request.sort_script
        df, key = script_column(df, script)
        return df.withColumn("_sort_key", key.cast({"number": "double"}.get(kind, kind))), (("_sort_key", order),)
    if not request.sort:
        return df, (("_score", "desc"),)
    return (df.where(after(request.sort, request.search_after)) if request.search_after else df), request.sort


def run(index: Collection, request: Search) -> DataFrame:
    """The page of hits: ``_id``, ``_score``, source columns, in order.

    A page is ranked first, on keys alone; that job runs at once and gives at most ``MAX_SIZE`` ids and
    scores. Their documents are then read by a scan that knows the ids. Without a page the hits are one
    sorted frame.
    """
    request.validate()
    page = request.page()
    by_score = not request.sort and request.sort_script is None
    cols = source_columns(index.docs, request.source)
    if by_score and not request.score_script:
        c = compile_query(index, request.query())
        rows = index.docs.where(c.predicate).select("_id", c.score.alias("score")) if isinstance(c, Filtered) else c.rows
        df, sort = rows.select("_id", F.round("score", SCORE_DIGITS).alias("_score")), (("_score", "desc"),)
    else:
        df, sort = _with_keys(index, request)
    order = [*_order(sort), F.col("_id").asc()]
    if page is None:
        if by_score and not request.score_script:
            df, _ = _with_keys(index, request)
        whole = df.orderBy(*order)
        return (whole.offset(request.from_) if request.from_ else whole).select("_id", _shown(request, by_score), *cols)
    best = df.orderBy(*order)
    if request.from_:
        best = best.offset(request.from_)
    return _page(index, best.limit(page).select("_id", _shown(request, by_score)), cols)


def _shown(request: Search, by_score: bool) -> Column:
    return F.col("_score") if by_score or request.track_scores else F.lit(None).cast("double").alias("_score")


def _page(index: Collection, ranked: DataFrame, cols: list[str]) -> DataFrame:
    """The documents of a ranked page of keys, in its order."""
    found = ranked.collect()  # at most MAX_SIZE rows
    place, score, _id = (unused(n, index.docs) for n in ("_place", "_page_score", "_page_id"))
    columns = {_id: pa.array([r["_id"] for r in found], pa.string()), score: pa.array([r["_score"] for r in found], pa.float64()), place: pa.array(range(len(found)), pa.int32())}
    page = F.broadcast(index.spark.createDataFrame(pa.table(columns)))
    docs = index.fetch([r["_id"] for r in found]).select("_id", *cols)
    joined = docs.join(page, docs["_id"] == page[_id]).orderBy(place)
    return joined.select("_id", F.col(score).alias("_score"), *cols)


def total(index: Collection, request: Search) -> DataFrame:
    """The exact number of matches, as a one-row frame."""
    request.validate()
    c = compile_query(index, request.query())
    if not isinstance(c, Filtered):
        # the keys are distinct already: no document is read
        return c.rows.agg(F.count(F.lit(1)).alias("total"))
    return matched(index, request).agg(F.count(F.lit(1)).alias("total"))


def read_all(index: Collection, request: Search) -> DataFrame:
    """Every hit in sort order: one range sort instead of a page loop."""
    if not request.sort:
        raise ValueError("reading all hits needs a sort")
    return run(index, Search(**{**request.__dict__, "size": None}))


def transformed(index: Collection, request: Search, fn: Callable[[DataFrame], DataFrame], size: int) -> DataFrame:
    """The first ``size`` rows of ``fn`` over the hits; ``fn`` may drop and add rows, but keeps ``_id``.

    The query runs once and leaves the keys of its hits. They are then taken in steps, each four times
    as large as the one before, until ``fn`` has made enough rows: only the documents of these hits are
    read and transformed. ``fn`` sees the hits of one step at a time, so it has to treat each hit on its
    own. Its rows are put in the order of their hits, several of one hit by their own columns.
    """
    request = Search(**{**request.__dict__, "size": None})
    df, sort = _with_keys(index, request)
    cols = source_columns(index.docs, request.source)
    by_score = not request.sort and request.sort_script is None
    shown = _shown(request, by_score)
    names = [f"_key_{i}" for i in range(len(sort))]
    keys = df.select(F.col("_id").alias("_hit"), shown.alias("_shown"), *[F.col(n).alias(k) for k, (n, _) in zip(names, sort)])
    places = (*zip(names, (o for _, o in sort)), ("_hit", "asc"))
    if request.from_:
        keys = keys.orderBy(*_order(places)).offset(request.from_)
    keys = materialize(keys, "hit-keys")

    def hits_of(page: DataFrame, docs: DataFrame) -> DataFrame:
        rows = docs.select("_id", *cols).join(page, F.col("_id") == F.col("_hit"))
        return rows.orderBy(*_order(places)).select("_id", F.col("_shown").alias("_score"), *cols)

    parts, have, step, last = [], 0, max(size, MIN_SIZE), ()
    while have < size:
        rest = keys.where(after(places, last)) if last else keys
        page = materialize(rest.orderBy(*_order(places)).limit(step), "hits")
        ends = page.orderBy(*_order(places, backwards=True)).limit(1).collect()
        if parts and not ends:
            break
        few = [r["_hit"] for r in page.select("_hit").collect()] if step <= MAX_SIZE else None
        docs = index.docs.join(page.select(F.col("_hit").alias("_id")), "_id", "left_semi") if few is None else index.fetch(few)
        made = fn(hits_of(page, docs))
        if "_id" not in made.columns:
            raise ValueError("the function has to keep the column _id, which tells the place of its rows")
        wrapped = made.select(F.struct(*[F.col(f"`{c}`") for c in made.columns]).alias("row"))
        part = materialize(wrapped.join(page, F.col("row._id") == F.col("_hit")), "transformed")
        parts.append(part)
        if not ends:
            break
        have += part.count()
        last = tuple(ends[0][n] for n, _ in places)
        step *= 4
    rows = reduce(DataFrame.unionByName, parts)
    fields = rows.schema["row"].dataType.fields
    own = [F.col(f"row.`{f.name}`").asc_nulls_last() for f in fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return rows.orderBy(*_order(places), *own).limit(size).select("row.*")
