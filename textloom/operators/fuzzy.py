"""Approximate term lookup on the vocabulary (distinct terms, not documents)."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, Window, functions as F


def max_edits(token: Column, fuzziness: int | str) -> Column:
    """Allowed edit distance; AUTO depends on the length of the query term."""
    if str(fuzziness).upper() == "AUTO":
        return F.when(F.length(token) <= 2, F.lit(0)).when(F.length(token) <= 5, F.lit(1)).otherwise(F.lit(2))
    return F.lit(int(fuzziness))


def _close(q: Column, token: Column, edits: Column, prefix_length: int) -> Column:
    """Cheap tests first: length, common prefix, then the bounded edit distance."""
    test = F.abs(F.length(q) - F.length(token)) <= edits
    if prefix_length:
        test = test & (F.substring(q, 1, prefix_length) == F.substring(token, 1, prefix_length))
    near = F.lit(False)
    for d in (0, 1, 2):
        near = F.when(edits == d, F.levenshtein(q, token, d) >= 0).otherwise(near)
    return test & F.when(edits > 2, F.levenshtein(q, token) <= edits).otherwise(near)


def expand_terms(vocab: DataFrame, terms: list[tuple[int, str, float]], fuzziness: int | str, prefix_length: int = 0, max_expansions: int | None = None) -> DataFrame:
    """Vocabulary terms near each query term: ``(term_idx, token, weight, df, ttf)``.

    The query's few terms are a literal array, tested in one pass over the
    vocabulary; no join. All terms count, unless the caller asks for the best
    ``max_expansions`` per query term.
    """
    wanted = F.array(*[F.struct(F.lit(i).alias("term_idx"), F.lit(t).alias("q"), F.lit(float(w)).alias("w")) for i, t, w in terms])
    hits = vocab.select(
        "token", "df", "ttf", F.explode(F.filter(wanted, lambda t: _close(t["q"], F.col("token"), max_edits(t["q"], fuzziness), prefix_length))).alias("t")
    ).select("token", "df", "ttf", "t.*")
    d = F.levenshtein("q", "token")
    hits = hits.withColumn("d", d)
    if max_expansions is not None:
        rank = F.row_number().over(Window.partitionBy("term_idx").orderBy("d", F.desc("df"), "token"))
        hits = hits.withColumn("rank", rank).where(F.col("rank") <= max_expansions)
    weight = F.col("w") * (F.lit(1.0) - F.col("d") / F.least(F.length("q"), F.length("token")))
    return hits.where(weight > 0).select("term_idx", "token", weight.alias("weight"), "df", "ttf")


def deletions(token: Column, edits: int) -> Column:
    """The token and all spellings with up to ``edits`` (at most 2) characters removed."""

    def shorter(t: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))),
            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))),
        )

    out = F.array(token)
    ring = F.array(token)
    for _ in range(edits):
        ring = F.array_distinct(F.flatten(F.transform(ring, shorter)))
        out = F.array_union(out, ring)
    return out


def fuzzy_join(queries: DataFrame, vocab: DataFrame, edits: int, prefix_length: int = 0) -> DataFrame:
    """Pairs ``(q, token, d)`` within ``edits`` (1 or 2) for a large *table* of query terms.

    Two words within d edits share a spelling with at most d deletions on each
    side, so an equi-join on deletions finds every pair; the distance is then
    checked. ``queries`` has a column ``q``, ``vocab`` a column ``token``.
    """
    if edits not in (1, 2):
        raise ValueError("the deletion join covers distances 1 and 2")
    left = queries.select("q").distinct().select("q", F.explode(deletions(F.col("q"), edits)).alias("key"))
    right = vocab.select("token").distinct().select("token", F.explode(deletions(F.col("token"), edits)).alias("key"))
    pairs = left.join(right, "key")
    if prefix_length:
        pairs = pairs.where(F.substring("q", 1, prefix_length) == F.substring("token", 1, prefix_length))
    d = F.levenshtein("q", "token", edits)
    return pairs.select("q", "token", d.alias("d")).where(F.col("d") >= 0).distinct()


# --- stored spellings: each term by three pieces of it
#
# Two edits leave one of three pieces of a term as it is, moved by at most two places. So the terms near
# a word are among those that have a piece in common with it at nearly the same place. A term has three
# keys, whatever the number of its misspellings.

PIECES, MAX_EDITS = 3, 2
#: The key of terms that are too short to be cut.
SHORT = "short"


def _cuts(length: int) -> list[tuple[int, int]]:
    """``(start, size)`` of the pieces of a term; later ones are longer where they cannot be equal."""
    sizes = [length // PIECES + (i >= PIECES - length % PIECES) for i in range(PIECES)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(PIECES)]


def spelling_keys(token: Column) -> Column:
    """The keys under which a term is stored: its length, and the number and letters of each piece."""
    length = F.length(token)
    least, more = F.floor(length / PIECES).cast("int"), length % PIECES

    def key(i: int) -> Column:
        size = least + F.when(F.lit(i) >= PIECES - more, 1).otherwise(0)
        start = least * i + F.greatest(F.lit(0), F.lit(i - PIECES) + more)
        return F.concat_ws(":", length, F.lit(i), F.substring(token, start + 1, size))

    return F.when(length < PIECES, F.array(F.lit(SHORT))).otherwise(F.array(*[key(i) for i in range(PIECES)]))


def lookup_keys(word: str, edits: int) -> list[str]:
    """The keys of all terms within ``edits`` (at most 2) of a word."""
    keys = {SHORT} if len(word) - edits < PIECES else set()
    for length in range(max(PIECES, len(word) - edits), len(word) + edits + 1):
        for i, (start, size) in enumerate(_cuts(length)):
            for at in range(max(0, start - edits), min(len(word) - size, start + edits) + 1):
                keys.add(f"{length}:{i}:{word[at : at + size]}")
    return sorted(keys)


def lookup_key_column(word: Column, edits: Column) -> Column:
    """``lookup_keys`` for a table of words."""

    def of_length(length: Column) -> Column:
        least, more = F.floor(length / PIECES).cast("int"), length % PIECES

        def of_piece(i: int) -> Column:
            size = least + F.when(F.lit(i) >= PIECES - more, 1).otherwise(0)
            start = least * i + F.greatest(F.lit(0), F.lit(i - PIECES) + more)
            first, last = F.greatest(F.lit(0), start - edits), F.least(F.length(word) - size, start + edits)
            keys = F.transform(F.sequence(first, last), lambda at: F.concat_ws(":", length, F.lit(i), F.substring(word, at + 1, size)))
            return F.when(last >= first, keys).otherwise(F.array().cast("array<string>"))

        return F.concat(*[of_piece(i) for i in range(PIECES)])

    longest = F.length(word) + edits
    shortest = F.greatest(F.lit(PIECES), F.length(word) - edits)
    cut = F.when(longest >= shortest, F.flatten(F.transform(F.sequence(shortest, longest), of_length))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.when(F.length(word) - edits < PIECES, F.array(F.lit(SHORT))).otherwise(F.array().cast("array<string>")), cut))


def key_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(buckets)).cast("int")


def bucket_of_key(key: str, buckets: int) -> int:
    return zlib.crc32(key.encode("utf-8")) % buckets


def edits_of(word: str, fuzziness: int | str) -> int:
    """``max_edits`` for one word of a query."""
    if str(fuzziness).upper() == "AUTO":
        return 0 if len(word) <= 2 else 1 if len(word) <= 5 else 2
    return int(fuzziness)


def stored_join(queries: DataFrame, spellings: DataFrame, edits: int, prefix_length: int = 0) -> DataFrame:
    """Pairs ``(q, token, d)`` like ``fuzzy_join``, from stored spellings ``(key, token)``; the vocabulary is not expanded."""
    left = queries.select("q").distinct().select("q", F.explode(lookup_key_column(F.col("q"), F.lit(edits))).alias("key"))
    pairs = left.join(spellings, "key").where(F.abs(F.length("q") - F.length("token")) <= edits)
    if prefix_length:
        pairs = pairs.where(F.substring("q", 1, prefix_length) == F.substring("token", 1, prefix_length))
    return pairs.select("q", "token", F.levenshtein("q", "token", edits).alias("d")).where(F.col("d") >= 0).distinct()
