"""The search language: small value objects, without any Spark in them."""

from __future__ import annotations

from dataclasses import dataclass, field


class Query:
    pass


@dataclass(frozen=True)
class MatchAll(Query):
    pass


@dataclass(frozen=True)
class Exists(Query):
    field: str


@dataclass(frozen=True)
class Term(Query):
    """Exact value; a list of values matches any of them."""

    field: str
    value: object


@dataclass(frozen=True)
class Match(Query):
    """Analyzed text. ``fuzziness`` is an edit distance or ``"AUTO"``; 0 means none."""

    field: str
    text: str
    analyzer: str | None = None
    boost: float = 1.0
    fuzziness: int | str | None = None
    prefix_length: int = 0
    operator: str = "OR"
    max_expansions: int | None = None


@dataclass(frozen=True)
class Phrase(Query):
    field: str
    text: str
    analyzer: str | None = None
    boost: float = 1.0
    last_is_prefix: bool = False


def PhrasePrefix(field: str, text: str, analyzer: str | None = None, boost: float = 1.0) -> Phrase:
    """A phrase whose last word may be unfinished."""
    return Phrase(field, text, analyzer, boost, last_is_prefix=True)


@dataclass(frozen=True)
class Prefix(Query):
    field: str
    text: str


@dataclass(frozen=True)
class Range(Query):
    field: str
    gt: object = None
    gte: object = None
    lt: object = None
    lte: object = None
    format: str | None = None

    def __post_init__(self) -> None:
        if all(v is None for v in (self.gt, self.gte, self.lt, self.lte)):
            raise ValueError("a range needs at least one bound")


MULTI_MATCH_TYPES = ("best_fields", "most_fields", "cross_fields", "phrase", "phrase_prefix", "bool_prefix")


@dataclass(frozen=True)
class MultiMatch(Query):
    """One text over several fields; a field may carry ``^boost``."""

    fields: tuple[str, ...]
    text: str
    type: str = "best_fields"
    analyzer: str | None = None
    fuzziness: int | str | None = None
    prefix_length: int = 0
    operator: str = "OR"
    max_expansions: int | None = None

    def __post_init__(self) -> None:
        if self.type not in MULTI_MATCH_TYPES:
            raise ValueError(f"no multi match type {self.type!r}")

    def boosted(self) -> list[tuple[str, float]]:
        pairs = (f.partition("^") for f in self.fields)
        return [(name, float(boost) if boost else 1.0) for name, _, boost in pairs]


@dataclass(frozen=True)
class GeoDistance(Query):
    field: str
    distance: str
    lat: float
    lon: float


@dataclass(frozen=True)
class Nested(Query):
    """Some element of an array of structs satisfies the inner query."""

    path: str
    query: Query


@dataclass(frozen=True)
class Bool(Query):
    must: tuple[Query, ...] = ()
    filter: tuple[Query, ...] = ()
    should: tuple[Query, ...] = ()
    must_not: tuple[Query, ...] = ()


@dataclass(frozen=True)
class Script:
    """A Spark SQL expression over the document's columns, ``_score`` and ``params``."""

    source: str
    params: dict = field(default_factory=dict, hash=False)

    def __post_init__(self) -> None:
        if not self.source:
            raise ValueError("a script needs its source")
