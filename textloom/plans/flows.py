"""Composed searches: phonetic, and search as you type."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame

from textloom.operators.scoring import query_terms
from textloom.plans import queries as Q
from textloom.plans.search import Search, run, transformed
from textloom.sources.collection import Collection

# Boosts of the three parts of a phonetic search, and the score divisors.
WORDS_BOOST, PHRASE_BOOST, SOUND_BOOST = 0.8, 1.0, 0.3
PHONETIC_DIVISOR, TYPING_DIVISOR = 1000, 10.0


def phonetic_request(
    index: Collection, text: str, search_fields: tuple[str, ...], fields: tuple[str, ...], phonetic_analyzer: str | None = None,
    phonetic_fields: tuple[str, ...] = (), fuzziness: int | str | None = None, size: int = 10, contexts: tuple[tuple[str, object], ...] = (),
    weight_field: str | None = None, sort: tuple[tuple[str, str], ...] = (), search_after: tuple = (),
) -> Search:
    """Words, phrases and sounds as optional clauses; contexts as filters.

    The sound part looks for the sound keys of the text (longer than one letter),
    by default with automatic fuzziness; ``fuzziness=0`` looks for the text itself.
    """
    if search_after and not sort:
        raise ValueError("search_after needs a sort")
    if phonetic_fields and not phonetic_analyzer:
        raise ValueError("phonetic fields need a phonetic analyzer")
    should: list[Q.Query] = [Q.Match(f, text, boost=WORDS_BOOST) for f in search_fields]
    should += [Q.Phrase(f, text, boost=PHRASE_BOOST) for f in fields]
    if fuzziness == 0:
        should += [Q.Match(f, text, boost=SOUND_BOOST) for f in phonetic_fields]
    elif phonetic_analyzer:
        keys = " ".join(t for _, t in query_terms(index.spark, index.settings.get_analyzer(phonetic_analyzer), text) if len(t) > 1)
        if keys:
            should += [Q.Match(f, keys, analyzer="standard", fuzziness="AUTO" if fuzziness is None else fuzziness, boost=SOUND_BOOST) for f in phonetic_fields]
    script = Q.Script(f"{weight_field} * _score / {PHONETIC_DIVISOR}") if weight_field else None
    return Search(
        should=tuple(should), filter=tuple(Q.Term(f, v) for f, v in contexts), size=size, sort=sort, search_after=search_after, score_script=script
    )


def phonetic_search(index: Collection, text: str, *args, **options) -> DataFrame:
    return run(index, phonetic_request(index, text, *args, **options))


def phonetic_search_transformed(index: Collection, fn: Callable[[DataFrame], DataFrame], sort: tuple[tuple[str, str], ...], size: int, text: str, *args, **options) -> DataFrame:
    """The ordered hits through ``fn`` until ``size`` rows are there."""
    return transformed(index, phonetic_request(index, text, *args, sort=sort, **options), fn, size)


def typing_request(
    index: Collection, analyzer: str, text: str, fields: tuple[str, ...], multi_fields: tuple[str, ...], size: int = 10,
    contexts: tuple[tuple[str, object], ...] = (), stop_words: tuple[str, ...] = (), weight_field: str | None = None,
    sort: tuple[tuple[str, str], ...] = (), search_after: tuple = (),
) -> Search | None:
    """Search while the user types; None where the text has no tokens.

    Of the words that are no stop words the first two positions count. The last
    of them must match. The first of two may be misspelt: it filters where it is
    longer than three letters, and only adds to the score otherwise.
    """
    if search_after and not sort:
        raise ValueError("search_after needs a sort")
    tokens = query_terms(index.spark, index.settings.get_analyzer(analyzer), text)
    stops = [t for _, t in tokens if t in stop_words]
    groups: dict[int, list[str]] = {}
    for position, token in tokens:
        if token not in stop_words and len(token) > 1:
            groups.setdefault(position, []).append(token)
    words = [groups[p] for p in sorted(groups)][:2]
    if not words and not stops:
        return None

    def across(tokens: list[str], fuzziness: int | str) -> Q.MultiMatch:
        return Q.MultiMatch(tuple(multi_fields), " ".join(tokens), analyzer="standard", fuzziness=fuzziness)

    first = [across(words[0], "AUTO")] if len(words) > 1 else []
    strict = bool(first) and any(len(t) > 3 for t in words[0])
    several = [(f, v) for f, v in contexts if isinstance(v, (list, tuple))]
    single = [(f, v) for f, v in contexts if not isinstance(v, (list, tuple))]
    should: list[Q.Query] = []
    if words:
        should += [Q.Prefix(f, text.split()[0].lower()) for f in fields]
    should += [Q.Phrase(f, text) for f in fields]
    if stops:
        should.append(across(stops, 0))
    if not strict:
        should += first
    must: list[Q.Query] = [across(words[-1], 0)] if words else []
    must += [Q.Bool(should=tuple(Q.Term(f, x) for x in v)) for f, v in several]
    script = Q.Script(f"coalesce({weight_field}, 1) * _score / {TYPING_DIVISOR}") if weight_field else None
    return Search(
        must=tuple(must), filter=tuple(Q.Term(f, v) for f, v in single) + (tuple(first) if strict else ()), should=tuple(should),
        size=size, sort=sort, search_after=search_after, score_script=script,
    )


def search_as_you_type(index: Collection, analyzer: str, text: str, *args, **options) -> DataFrame:
    request = typing_request(index, analyzer, text, *args, **options)
    if request is None:
        return run(index, Search(match_all=True, size=1)).where("false")
    return run(index, request)


def search_as_you_type_transformed(index: Collection, fn: Callable[[DataFrame], DataFrame], sort: tuple[tuple[str, str], ...], size: int, analyzer: str, text: str, *args, **options) -> DataFrame:
    request = typing_request(index, analyzer, text, *args, sort=sort, **options)
    if request is None:
        return run(index, replace(Search(match_all=True), size=1)).where("false")
    return transformed(index, request, fn, size)
