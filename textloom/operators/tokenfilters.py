"""Token filters over the token array of one document.

A filter never leaves the row: word lists become hashed ``IN`` sets, positional
filters slice the array, per-document filters sort it. Tables of words that are
too large for a literal go through ``operators.dictionary`` instead.

Consecutive one-token rewrites are merged into a single pass over the array.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace as copy_with

from pyspark.sql import Column, functions as F

from textloom.functions import charmaps, phonetic
from textloom.functions.arrays import first_per_key, let
from textloom.operators.charfilters import replace_pattern
from textloom.operators.tokenizers import grams, token_type

Rewrite = Callable[[Column], Column]


@dataclass(frozen=True)
class Tokens:
    """An array of token structs and the names of the struct's fields.

    Fresh from the tokenizer ``column`` still holds plain words (``plain``).
    """

    column: Column
    fields: tuple[str, ...] = ("token", "position")
    pending: tuple[Rewrite, ...] = ()
    plain: bool = False

    def array(self) -> Column:
        """The structs, with all pending rewrites applied in the same pass."""

        def rewritten(token: Column) -> Column:
            for rewrite in self.pending:
                token = rewrite(token)
            return token

        if self.plain:
            made = {"token": lambda w, i: rewritten(w), "position": lambda w, i: i, "type": lambda w, i: token_type(w)}
            return F.transform(self.column, lambda w, i: F.struct(*[made[f](w, i).alias(f) for f in self.fields]))
        if not self.pending:
            return self.column
        return F.transform(self.column, lambda t: self.struct(t, token=rewritten(t["token"])))

    def struct(self, base: Column, **changes: Column) -> Column:
        """The struct of ``base`` with some fields replaced."""
        return F.struct(*[(changes[f] if f in changes else base[f]).alias(f) for f in self.fields])

    def rewrite(self, fn: Rewrite) -> Tokens:
        return copy_with(self, pending=self.pending + (fn,))

    def with_array(self, column: Column, fields: tuple[str, ...] | None = None) -> Tokens:
        return Tokens(column, fields or self.fields)

    def keep(self, predicate: Callable[[Column], Column]) -> Tokens:
        return self.with_array(F.filter(self.array(), predicate))

    def expand(self, fn: Callable[[Column], Column], fields: tuple[str, ...] | None = None) -> Tokens:
        """Each token becomes an array of structs."""
        return self.with_array(F.flatten(F.transform(self.array(), fn)), fields)

    def words(self, t: Column, words: Column) -> Column:
        """Array of strings to token structs that keep the rest of ``t``."""
        return F.transform(words, lambda w: self.struct(t, token=w))

    def with_field(self, name: str, value: Callable[[Column], Column]) -> Tokens:
        """Add a field, or replace it where it is there already."""
        base = self.array()
        if name in self.fields:
            return self.with_array(F.transform(base, lambda t: self.struct(t, **{name: value(t)})))
        fields = self.fields + (name,)
        return Tokens(F.transform(base, lambda t: F.struct(*[t[f].alias(f) for f in self.fields], value(t).alias(name))), fields)


def read_words(words: tuple[str, ...], path: str | None) -> list[str]:
    out = list(words)
    if path:
        with open(path, encoding="utf-8") as f:
            out += [line.strip() for line in f if line.strip() and not line.startswith("#")]
    return out


def in_words(token: Column, words: list[str], ignore_case: bool) -> Column:
    """Membership as a hashed set, built once per task."""
    if ignore_case:
        return F.lower(token).isin(sorted({w.lower() for w in words}))
    return token.isin(sorted(set(words)))


def literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for k in sorted(table) for x in (k, table[k])])


def lookup(token: Column, table: dict[str, str]) -> Column:
    """Value of a small table, NULL where absent; the map is scanned for members only."""
    return F.when(token.isin(sorted(table)), F.element_at(literal_map(table), token))


# --- one token in, one token out -------------------------------------------------


@dataclass(frozen=True)
class Lowercase:
    language: str | None = None

    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(lambda t: charmaps.lower_for(t, self.language))


@dataclass(frozen=True)
class Uppercase:
    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(F.upper)


@dataclass(frozen=True)
class Trim:
    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(F.trim)


@dataclass(frozen=True)
class Reverse:
    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(F.reverse)


@dataclass(frozen=True)
class AsciiFolding:
    preserve_original: bool = False

    def apply(self, ts: Tokens) -> Tokens:
        fold = lambda t: charmaps.apply_map(t, charmaps.LATIN_FOLDING)
        if not self.preserve_original:
            return ts.rewrite(fold)
        return ts.expand(lambda t: ts.words(t, F.array_distinct(F.array(fold(t["token"]), t["token"]))))


@dataclass(frozen=True)
class Apostrophe:
    """Drop the apostrophe and all that follows."""

    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(lambda t: F.regexp_replace(t, "['’].*$", ""))


@dataclass(frozen=True)
class ClassicNormalize:
    """Drop the English possessive and the dots of acronyms."""

    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(
            lambda t: F.when(t.rlike(r"^(?:\p{L}\.)+\p{L}?$"), F.replace(t, F.lit("."), F.lit(""))).otherwise(F.regexp_replace(t, "['’][sS]$", ""))
        )


@dataclass(frozen=True)
class MapCharacters:
    """Rewrite by a character table."""

    table: dict[str, str] = field(default_factory=dict, hash=False)

    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(lambda t: charmaps.apply_map(t, self.table))


@dataclass(frozen=True)
class GermanNormalize:
    def apply(self, ts: Tokens) -> Tokens:
        def fold(t: Column) -> Column:
            t = charmaps.apply_map(t, charmaps.GERMAN_UMLAUTS)
            t = charmaps.apply_map(t, charmaps.GERMAN_PAIRS)
            return F.regexp_replace(t, "(^|[^aeiouq])ue", "$1u")

        return ts.rewrite(fold)


@dataclass(frozen=True)
class ScandinavianNormalize:
    """Interchangeable letters and letter pairs to å, æ and ø."""

    def apply(self, ts: Tokens) -> Tokens:
        table = {**charmaps.SCANDINAVIAN_PAIRS, **charmaps.SCANDINAVIAN_LETTERS}
        return ts.rewrite(lambda t: charmaps.apply_map(t, table))


@dataclass(frozen=True)
class ScandinavianFold:
    """Letters to a and o, letter pairs to their first letter."""

    def apply(self, ts: Tokens) -> Tokens:
        table = {**charmaps.SCANDINAVIAN_PAIR_FOLDS, **charmaps.SCANDINAVIAN_FOLDS}
        return ts.rewrite(lambda t: charmaps.apply_map(t, table))


@dataclass(frozen=True)
class Elision:
    articles: tuple[str, ...] = ()
    articles_path: str | None = None
    articles_case: bool = False

    def apply(self, ts: Tokens) -> Tokens:
        words = read_words(self.articles, self.articles_path)
        if not words:
            raise ValueError("elision got no articles, neither as a list nor from a file")
        flag = "(?i)" if self.articles_case else ""
        return ts.rewrite(lambda t: F.regexp_replace(t, f"{flag}^(?:{'|'.join(words)})['’]", ""))


@dataclass(frozen=True)
class Truncate:
    length: int = 10

    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(lambda t: F.substring(t, 1, self.length))


@dataclass(frozen=True)
class PatternReplace:
    pattern: str
    replacement: str = ""
    all: bool = True

    def apply(self, ts: Tokens) -> Tokens:
        return ts.rewrite(lambda t: replace_pattern(t, self.pattern, self.replacement, self.all))


@dataclass(frozen=True)
class StemmerOverride:
    """Fixed stems by ``word => stem`` rules; the stemmed token counts as a keyword."""

    rules: tuple[str, ...] = ()
    rules_path: str | None = None

    def apply(self, ts: Tokens) -> Tokens:
        rules = read_words(self.rules, self.rules_path)
        if not rules:
            raise ValueError("stemmer_override got no rules, neither as a list nor from a file")
        table = {w.strip(): right.strip() for left, right in (r.split("=>", 1) for r in rules) for w in left.split(",")}
        had = "keyword" in ts.fields
        free = (lambda t: ~t["keyword"]) if had else (lambda t: F.lit(True))
        listed = lambda t: free(t) & t["token"].isin(sorted(table))
        # a token that is a keyword already keeps its word, and every keyword stays one
        fields = ts.fields if had else (*ts.fields, "keyword")

        def stemmed(t: Column) -> Column:
            values = {"token": F.when(listed(t), lookup(t["token"], table)).otherwise(t["token"]), "keyword": listed(t) | ~free(t)}
            return F.struct(*[(values[f] if f in values else t[f]).alias(f) for f in fields])

        return Tokens(F.transform(ts.array(), stemmed), fields)


@dataclass(frozen=True)
class Phonetic:
    """Sound key of each token."""

    encoder: str = "soundex"

    def apply(self, ts: Tokens) -> Tokens:
        if self.encoder not in phonetic.ENCODERS:
            raise ValueError(f"encoder {self.encoder!r} is not built; use one of {sorted(phonetic.ENCODERS)}")
        return ts.rewrite(phonetic.ENCODERS[self.encoder])


@dataclass(frozen=True)
class DelimitedPayload:
    """Cut ``word|value`` into token and payload."""

    delimiter: str = "|"
    encoding: str = "float"

    def apply(self, ts: Tokens) -> Tokens:
        def payload(t: Column) -> Column:
            tail = F.when(F.instr(t["token"], self.delimiter) > 0, F.substring_index(t["token"], self.delimiter, -1))
            return tail if self.encoding == "identity" else tail.try_cast({"float": "double", "int": "int"}[self.encoding])

        d = self.delimiter
        return ts.with_field("payload", payload).rewrite(
            lambda t: F.when(
                F.instr(t, d) > 0, F.substring(t, F.lit(1), F.length(t) - F.length(F.substring_index(t, d, -1)) - len(d))
            ).otherwise(t)
        )


# --- one token in, kept or not ---------------------------------------------------

# The short English stop list of common search engines.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of",
    "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)


def stop_words(words: tuple[str, ...] | str, path: str | None) -> list[str]:
    if words == "_none_":
        return []
    if words == "_english_":
        return list(ENGLISH_STOP_WORDS)
    if isinstance(words, str):
        raise ValueError(f"no built-in list {words!r}: give the words, or use a (lang, word) table")
    return read_words(words, path)


@dataclass(frozen=True)
class Stop:
    """Drop listed words; the positions of the others stay as they are."""

    stopwords: tuple[str, ...] | str = "_english_"
    stopwords_path: str | None = None
    ignore_case: bool = False
    remove_trailing: bool = True

    def apply(self, ts: Tokens) -> Tokens:
        words = stop_words(() if self.stopwords_path and self.stopwords == "_english_" else self.stopwords, self.stopwords_path)
        if not words:
            return ts
        if self.remove_trailing:
            return ts.keep(lambda t: ~in_words(t["token"], words, self.ignore_case))
        return ts.with_array(
            let(ts.array(), lambda a: F.filter(a, lambda t, i: (i == F.size(a) - 1) | ~in_words(t["token"], words, self.ignore_case)))
        )


@dataclass(frozen=True)
class Keep:
    keep_words: tuple[str, ...] = ()
    keep_words_path: str | None = None
    keep_words_case: bool = False

    def apply(self, ts: Tokens) -> Tokens:
        words = read_words(self.keep_words, self.keep_words_path)
        if not words:
            raise ValueError("keep got no words, so it would drop every token")
        return ts.keep(lambda t: in_words(t["token"], words, self.keep_words_case))


@dataclass(frozen=True)
class KeepTypes:
    types: tuple[str, ...] = ()
    mode: str = "include"
    needs_types = True

    def apply(self, ts: Tokens) -> Tokens:
        if not self.types:
            raise ValueError(f"keep_types got types={self.types!r}; name at least one token type")
        hit = lambda t: t["type"].isin(list(self.types))
        return ts.keep(hit if self.mode == "include" else lambda t: ~hit(t))


@dataclass(frozen=True)
class Length:
    min: int = 0
    max: int = 2**31 - 1

    def apply(self, ts: Tokens) -> Tokens:
        return ts.keep(lambda t: F.length(t["token"]).between(self.min, self.max))


@dataclass(frozen=True)
class Predicate:
    """Keep tokens for which a SQL predicate over ``token.term`` and its other fields holds."""

    script: str

    def apply(self, ts: Tokens) -> Tokens:
        return ts.keep(lambda t: on_fields(self.script, t, ts.fields))


def on_fields(script: str, t: Column, fields: tuple[str, ...]) -> Column:
    """A SQL predicate such as ``length(token.term) > 5`` bound to one token."""
    bound = F.struct(*[t[f].alias("term" if f == "token" else f) for f in fields])
    return F.get(F.call_function("transform", F.array(bound), F.expr(f"token -> ({script})")), F.lit(0))


# --- one token in, several out ---------------------------------------------------


@dataclass(frozen=True)
class NgramFilter:
    min_gram: int = 1
    max_gram: int = 2
    preserve_original: bool = False
    edge = False

    def apply(self, ts: Tokens) -> Tokens:
        def out(t: Column) -> Column:
            parts = grams(t["token"], self.min_gram, self.max_gram, self.edge)
            if self.preserve_original:
                n = F.length(t["token"])
                parts = F.when((n < self.min_gram) | (n > self.max_gram), F.array_append(parts, t["token"])).otherwise(parts)
            return ts.words(t, parts)

        return ts.expand(out)


@dataclass(frozen=True)
class EdgeNgramFilter(NgramFilter):
    edge = True


@dataclass(frozen=True)
class PatternCapture:
    """Every match of each pattern's first group, at the token's position."""

    patterns: tuple[str, ...]
    preserve_original: bool = True

    def apply(self, ts: Tokens) -> Tokens:
        def out(t: Column) -> Column:
            found = [F.regexp_extract_all(t["token"], F.lit(p), F.lit(1 if "(" in p else 0)) for p in self.patterns]
            lead = [F.array(t["token"])] if self.preserve_original else []
            return ts.words(t, F.array_distinct(F.filter(F.concat(*lead, *found), lambda w: w != "")))

        return ts.expand(out)


@dataclass(frozen=True)
class KeywordMarker:
    """Set the keyword flag by word list or by pattern."""

    keywords: tuple[str, ...] = ()
    keywords_path: str | None = None
    keywords_pattern: str | None = None
    ignore_case: bool = False

    def apply(self, ts: Tokens) -> Tokens:
        words = read_words(self.keywords, self.keywords_path)
        if bool(words) == bool(self.keywords_pattern):
            raise ValueError("keyword_marker takes a word list or a pattern, exactly one of the two")
        if self.keywords_pattern:
            return ts.with_field("keyword", lambda t: t["token"].rlike(f"^(?:{self.keywords_pattern})$"))
        return ts.with_field("keyword", lambda t: in_words(t["token"], words, self.ignore_case))


@dataclass(frozen=True)
class KeywordRepeat:
    """Every token twice: once as keyword, once free for stemming."""

    def apply(self, ts: Tokens) -> Tokens:
        plain = ts.with_field("keyword", lambda t: F.lit(False))
        return plain.expand(lambda t: F.array(plain.struct(t, keyword=F.lit(True)), plain.struct(t)))


@dataclass(frozen=True)
class Condition:
    """Run filters on the tokens for which a SQL predicate holds."""

    script: str
    filters: tuple = ()

    def apply(self, ts: Tokens) -> Tokens:
        if not self.filters:
            raise ValueError("filters is required")

        def out(t: Column) -> Column:
            chosen = Tokens(F.array(t), ts.fields)
            for f in self.filters:
                chosen = f.apply(chosen)
            return F.when(on_fields(self.script, t, ts.fields), chosen.array()).otherwise(F.array(t))

        return ts.expand(out)


@dataclass(frozen=True)
class Multiplexer:
    """Each token through several filter chains; equal results at a position count once."""

    branches: tuple = ()
    preserve_original: bool = True

    def apply(self, ts: Tokens) -> Tokens:
        if not self.branches:
            raise ValueError("filters is required")

        def out(t: Column) -> Column:
            results = [F.array(t)] if self.preserve_original else []
            for branch in self.branches:
                one = Tokens(F.array(t), ts.fields)
                for f in branch:
                    one = f.apply(one)
                results.append(one.array())
            return F.array_distinct(F.concat(*results))

        return ts.expand(out)


@dataclass(frozen=True)
class WordDelimiter:
    """Cut tokens at case changes, digits and punctuation, with optional rejoining.

    All outputs keep the token's position; the graph form adds the part count.
    """

    generate_word_parts: bool = True
    generate_number_parts: bool = True
    catenate_words: bool = False
    catenate_numbers: bool = False
    catenate_all: bool = False
    split_on_case_change: bool = True
    split_on_numerics: bool = True
    stem_english_possessive: bool = True
    preserve_original: bool = False
    protected_words: tuple[str, ...] = ()
    protected_words_path: str | None = None
    graph = False

    def part_pattern(self) -> str:
        if self.split_on_case_change and self.split_on_numerics:
            return r"\p{Lu}?\p{Ll}+|\p{Lu}+|[\p{Lo}\p{Lt}\p{Lm}]+|\p{N}+"
        if self.split_on_numerics:
            return r"\p{L}+|\p{N}+"
        if self.split_on_case_change:
            return r"\p{Lu}?[\p{Ll}\p{N}]+|[\p{Lu}\p{N}]+|[\p{Lo}\p{Lt}\p{Lm}\p{N}]+"
        return r"[\p{L}\p{N}]+"

    def apply(self, ts: Tokens) -> Tokens:
        fields = ts.fields + (("position_length",) if self.graph and "position_length" not in ts.fields else ())
        protected = read_words(self.protected_words, self.protected_words_path)

        def out(t: Column) -> Column:
            token = t["token"]
            base = F.regexp_replace(token, "['’][sS]$", "") if self.stem_english_possessive else token

            def one(w: Column, length: Column) -> Column:
                cols = [(w if f == "token" else t[f]).alias(f) for f in ts.fields]
                return F.struct(*cols, *([length.alias("position_length")] if len(fields) > len(ts.fields) else []))

            def build(parts: Column) -> Column:
                bare = F.regexp_replace(base, r"[^\p{L}\p{N}]+", "")
                pieces = []
                if self.preserve_original:
                    pieces.append(F.array(token))
                if self.generate_word_parts:
                    pieces.append(F.filter(parts, lambda p: ~p.rlike(r"^\p{N}+$")))
                if self.generate_number_parts:
                    pieces.append(F.filter(parts, lambda p: p.rlike(r"^\p{N}+$")))
                if self.catenate_words:
                    pieces.append(F.regexp_extract_all(bare, F.lit(r"\p{L}+"), F.lit(0)))
                if self.catenate_numbers:
                    pieces.append(F.regexp_extract_all(bare, F.lit(r"\p{N}+"), F.lit(0)))
                if self.catenate_all:
                    pieces.append(F.array(bare))
                words = F.filter(F.array_distinct(F.concat(*pieces)), lambda w: w != "")
                if protected:
                    words = F.when(token.isin(protected), F.array(token)).otherwise(words)

                return F.transform(words, lambda w: one(w, F.when(w == bare, F.greatest(F.size(parts), F.lit(1))).otherwise(F.lit(1))))

            cut = let(F.regexp_extract_all(base, F.lit(self.part_pattern()), F.lit(0)), build)
            # a plain word, the usual case, has one part and needs no cutting
            kept = self.preserve_original or self.generate_word_parts or self.catenate_words or self.catenate_all
            whole = F.transform(F.array(token) if kept else F.array().cast("array<string>"), lambda w: one(w, F.lit(1)))
            return F.when(token.rlike(r"^\p{Lu}?\p{Ll}+$"), whole).otherwise(cut)

        return ts.expand(out, fields)


@dataclass(frozen=True)
class WordDelimiterGraph(WordDelimiter):
    graph = True


@dataclass(frozen=True)
class Decompound:
    """Add the dictionary words contained in a token."""

    word_list: tuple[str, ...] = ()
    word_list_path: str | None = None
    min_word_size: int = 5
    min_subword_size: int = 2
    max_subword_size: int = 15
    only_longest_match: bool = False

    def apply(self, ts: Tokens) -> Tokens:
        words = read_words(self.word_list, self.word_list_path)
        if not words:
            raise ValueError("word_list or word_list_path is required")
        words = sorted({w.lower() for w in words if self.min_subword_size <= len(w) <= self.max_subword_size})

        def out(t: Column) -> Column:
            def at(start: Column) -> Column:
                sizes = F.sequence(F.lit(self.min_subword_size), F.least(F.lit(self.max_subword_size), F.length(t["token"]) - start + 1))
                subs = F.filter(
                    F.transform(sizes, lambda k: F.substring(t["token"], start, k)), lambda s: F.lower(s).isin(words)
                )
                return F.slice(subs, F.greatest(F.size(subs), F.lit(1)), F.lit(1)) if self.only_longest_match else subs

            starts = F.sequence(F.lit(1), F.length(t["token"]) - self.min_subword_size + 1)
            found = F.when(
                F.length(t["token"]) >= max(self.min_word_size, self.min_subword_size), F.flatten(F.transform(starts, at))
            ).otherwise(F.array().cast("array<string>"))
            return ts.words(t, F.concat(F.array(t["token"]), found))

        return ts.expand(out)


CJK_SCRIPTS = {"han": r"\p{IsHan}", "hangul": r"\p{IsHangul}", "hiragana": r"\p{IsHiragana}", "katakana": r"\p{IsKatakana}"}


@dataclass(frozen=True)
class CjkBigram:
    """Overlapping pairs inside runs of CJK letters; other runs stay whole."""

    ignored_scripts: tuple[str, ...] = ()
    output_unigrams: bool = False

    def apply(self, ts: Tokens) -> Tokens:
        members = "".join(rx for name, rx in CJK_SCRIPTS.items() if name not in self.ignored_scripts)
        if not members:
            return ts
        runs = f"[{members}]+|[^{members}]+"

        def grams_of(run: Column) -> Column:
            n = F.length(run)
            pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(run, i, F.lit(2)))
            singles = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(run, i, F.lit(1)))
            multi = F.concat(singles, pairs) if self.output_unigrams else pairs
            return F.when(run.rlike(f"^[{members}]") & (n > 1), multi).otherwise(F.array(run))

        def out(t: Column) -> Column:
            return ts.words(t, F.flatten(F.transform(F.regexp_extract_all(t["token"], F.lit(runs), F.lit(0)), grams_of)))

        return ts.expand(out)


@dataclass(frozen=True)
class Synonym:
    """Add or replace by rules ``a, b => c`` (replace) and ``a, b`` (all alike).

    Several-word sources match adjacent tokens; their targets are added at the
    first token, and the sources stay. Added tokens have the type SYNONYM.
    """

    synonyms: tuple[str, ...] = ()
    synonyms_path: str | None = None
    expand: bool = True
    lenient: bool = False
    graph = False
    needs_types = True

    def rules(self) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
        """(single-word sources, several-word sources), each with its targets."""
        lines = read_words(self.synonyms, self.synonyms_path)
        if not lines:
            raise ValueError("synonyms or synonyms_path is required")
        single: dict[str, list[str]] = {}
        multi: dict[str, list[str]] = {}

        def add(source: str, targets: list[str]) -> None:
            table = multi if " " in source else single
            table[source] = list(dict.fromkeys(table.get(source, []) + targets))

        for line in lines:
            left, arrow, right = line.partition("=>")
            sources = [" ".join(w.split()) for w in left.split(",") if w.strip()]
            targets = [" ".join(w.split()) for w in right.split(",") if w.strip()]
            if not sources or (arrow and not targets):
                if self.lenient:
                    continue
                raise ValueError(f"not a synonym rule: {line!r}")
            if not arrow:
                targets = sources if self.expand else sources[:1]
            for s in sources:
                add(s, targets)
        return single, multi

    def apply(self, ts: Tokens) -> Tokens:
        single, multi = self.rules()
        fields = ts.fields + (("position_length",) if self.graph and "position_length" not in ts.fields else ())

        def struct(t: Column, word: Column, kind: Column, length: Column) -> Column:
            cols = [(word if f == "token" else kind if f == "type" else t[f]).alias(f) for f in ts.fields]
            if len(fields) > len(ts.fields):
                cols.append(length.cast("int").alias("position_length"))
            return F.struct(*cols)

        def targets(table: dict[str, list[str]], key: Column) -> Column:
            values = F.create_map(*[x for k in sorted(table) for x in (F.lit(k), F.array(*[F.lit(v) for v in table[k]]))])
            return F.element_at(values, key)

        def expand(a: Column) -> Column:
            def out(t: Column, i: Column) -> Column:
                own = F.array(struct(t, t["token"], t["type"], F.lit(1)))
                pieces = own
                if single:
                    kind = lambda w: F.when(w == t["token"], t["type"]).otherwise(F.lit("SYNONYM"))
                    pieces = F.when(
                        t["token"].isin(sorted(single)),
                        F.transform(targets(single, t["token"]), lambda w: struct(t, w, kind(w), F.lit(1))),
                    ).otherwise(own)
                for size in sorted({len(s.split()) for s in multi}):
                    phrases = {s: v for s, v in multi.items() if len(s.split()) == size}
                    here = F.array_join(F.transform(F.slice(a, i + 1, F.lit(size)), lambda x: x["token"]), " ")
                    extra = let(
                        here,
                        lambda h: F.when(
                            h.isin(sorted(phrases)),
                            F.transform(
                                F.filter(targets(phrases, h), lambda w: w != h), lambda w: struct(t, w, F.lit("SYNONYM"), F.lit(size))
                            ),
                        ),
                    )
                    heads = sorted({s.split()[0] for s in phrases})
                    pieces = F.when(t["token"].isin(heads), F.concat(pieces, F.coalesce(extra, F.slice(pieces, F.lit(1), F.lit(0))))).otherwise(pieces)
                return pieces

            return F.flatten(F.transform(a, out))

        return ts.with_array(let(ts.array(), expand), fields)


@dataclass(frozen=True)
class SynonymGraph(Synonym):
    graph = True


# --- positional and whole-document filters ---------------------------------------


@dataclass(frozen=True)
class Limit:
    max_token_count: int = 1

    def apply(self, ts: Tokens) -> Tokens:
        return ts.with_array(F.slice(ts.array(), 1, self.max_token_count))


@dataclass(frozen=True)
class Unique:
    """First token of each spelling, in the document or only at one position."""

    only_on_same_position: bool = False

    def apply(self, ts: Tokens) -> Tokens:
        if self.only_on_same_position:
            return ts.with_array(first_per_key(ts.array(), lambda t: F.struct(t["position"], t["token"])))
        return ts.with_array(first_per_key(ts.array(), lambda t: t["token"]))


@dataclass(frozen=True)
class RemoveDuplicates:
    def apply(self, ts: Tokens) -> Tokens:
        return Unique(only_on_same_position=True).apply(ts)


@dataclass(frozen=True)
class Shingle:
    """Word n-grams over adjacent tokens."""

    min_shingle_size: int = 2
    max_shingle_size: int = 2
    output_unigrams: bool = True
    separator: str = " "

    def apply(self, ts: Tokens) -> Tokens:
        if not 2 <= self.min_shingle_size <= self.max_shingle_size:
            raise ValueError("shingle sizes need 2 <= min <= max")

        def of_one_size(a: Column) -> Column:
            """One shingle at most for each token, without a list of its own."""
            k = self.min_shingle_size
            firsts = F.slice(a, F.lit(1), F.greatest(F.size(a) - F.lit(k - 1), F.lit(0)))
            return F.transform(firsts, lambda t, i: ts.struct(t, token=F.concat_ws(self.separator, t["token"], *[F.get(a, i + j)["token"] for j in range(1, k)])))

        def build(a: Column) -> Column:
            def out(t: Column, i: Column) -> Column:
                sizes = [k for k in range(self.min_shingle_size, self.max_shingle_size + 1)]
                parts = [F.when(F.lit(self.output_unigrams), t["token"])] + [
                    F.when(
                        i + k <= F.size(a),
                        F.concat_ws(self.separator, t["token"], *[F.get(a, i + j)["token"] for j in range(1, k)]),
                    )
                    for k in sizes
                ]
                return ts.words(t, F.filter(F.array(*parts), lambda w: w.isNotNull()))

            return F.flatten(F.transform(a, out))

        one_size = self.min_shingle_size == self.max_shingle_size and not self.output_unigrams
        return ts.with_array(let(ts.array(), of_one_size if one_size else build))


@dataclass(frozen=True)
class CommonGrams:
    """Join a token with its neighbour as ``a_b`` where either is a common word."""

    common_words: tuple[str, ...] = ()
    common_words_path: str | None = None
    ignore_case: bool = False
    query_mode: bool = False

    def apply(self, ts: Tokens) -> Tokens:
        words = read_words(self.common_words, self.common_words_path)
        if not words:
            raise ValueError("common_grams got no words, neither as a list nor from a file")

        def build(a: Column) -> Column:
            common = lambda x: F.coalesce(in_words(x["token"], words, self.ignore_case), F.lit(False))

            def out(t: Column, i: Column) -> Column:
                after = F.get(a, i + 1)
                pair = after.isNotNull() & (common(t) | common(after))
                gram = F.when(pair, F.concat_ws("_", t["token"], after["token"]))
                own = t["token"]
                if self.query_mode:
                    # a word stays only where no pair covers it
                    before = F.get(a, i - 1)
                    covered = pair | ((i > 0) & before.isNotNull() & (common(t) | common(before)))
                    own = F.when(~covered, t["token"])
                return ts.words(t, F.filter(F.array(own, gram), lambda w: w.isNotNull()))

            return F.flatten(F.transform(a, out))

        return ts.with_array(let(ts.array(), build))


@dataclass(frozen=True)
class Fingerprint:
    """All distinct tokens, sorted and joined, as the one token of the document."""

    max_output_size: int = 255
    separator: str = " "

    def apply(self, ts: Tokens) -> Tokens:
        joined = F.array_join(F.sort_array(F.array_distinct(F.transform(ts.array(), lambda t: t["token"]))), self.separator)
        return Tokens(
            let(
                joined,
                lambda j: F.when(
                    (j != "") & (F.length(j) <= self.max_output_size), F.array(F.struct(j.alias("token"), F.lit(0).alias("position")))
                ).otherwise(F.array().cast("array<struct<token:string,position:int>>")),
            )
        )


HASHES_PER_DIGEST = 4


def digest(token: Column, no: int) -> Column:
    """md5 of a numbered token; it serves four hash functions of 32 bits."""
    return F.md5(F.concat(F.lit(f"{no}:"), token))


def hash32(digest_hex: Column, part: int) -> Column:
    """Eight hex digits of a digest, as a number every engine can compute."""
    return F.conv(F.substring(digest_hex, 1 + 8 * part, 8), 16, 10).cast("bigint")


@dataclass(frozen=True)
class MinHash:
    """Smallest token hashes per hash function and bucket.

    Tokens are ``seed:bucket:hash``; with rotation an empty bucket takes the
    values of the next bucket that has any.
    """

    hash_count: int = 1
    bucket_count: int = 512
    hash_set_size: int = 1
    with_rotation: bool | None = None

    def bucket(self, h: Column) -> Column:
        return F.floor(h * self.bucket_count / F.lit(4294967296)).cast("int")

    def apply(self, ts: Tokens) -> Tokens:
        rotate = self.bucket_count > 1 if self.with_rotation is None else self.with_rotation
        m = self.hash_set_size

        def chosen(hashes: Column) -> Column:
            """Sorted ``(bucket, hash)`` pairs that survive, for one hash function."""
            def smallest(hs: Column) -> Column:
                kept = F.filter(hs, lambda h, i: (i < m) | (self.bucket(F.get(hs, F.greatest(i - m, F.lit(0)))) != self.bucket(h)))
                found = F.transform(kept, lambda h: F.struct(self.bucket(h).alias("b"), h.alias("h")))
                return let(found, lambda f: _rotated(f, self.bucket_count, m) if rotate else f)

            return let(F.sort_array(F.array_distinct(hashes)), smallest)

        def per_digest(words: Column, no: int) -> Column:
            seeds = range(no * HASHES_PER_DIGEST, min((no + 1) * HASHES_PER_DIGEST, self.hash_count))

            def least(digests: Column, seed: int) -> Column:
                """The token of the smallest hash; hex digits of one length sort like their numbers."""
                part = seed % HASHES_PER_DIGEST
                low = F.array_min(digests) if part == 0 else F.array_min(F.transform(digests, lambda d: F.substring(d, 1 + 8 * part, 8)))
                return F.concat_ws(":", F.lit(str(seed)), F.lit("0"), hash32(low, 0).cast("string"))

            def tokens(digests: Column) -> Column:
                if self.bucket_count == 1 and m == 1:
                    return F.when(F.size(digests) > 0, F.array(*[least(digests, s) for s in seeds])).otherwise(F.array().cast("array<string>"))
                return F.concat(
                    *[
                        F.transform(
                            let(F.transform(digests, lambda d: hash32(d, seed % HASHES_PER_DIGEST)), chosen),
                            lambda e: F.concat_ws(":", F.lit(str(seed)), e["b"].cast("string"), e["h"].cast("string")),
                        )
                        for seed in seeds
                    ]
                )

            return let(F.transform(words, lambda w: digest(w, no)), tokens)

        words = F.array_distinct(F.transform(ts.array(), lambda t: t["token"]))
        n = -(-self.hash_count // HASHES_PER_DIGEST)
        out = let(words, lambda w: F.concat(*[per_digest(w, no) for no in range(n)]))
        return Tokens(F.transform(out, lambda w, i: F.struct(w.alias("token"), i.alias("position"))))


def _rotated(found: Column, buckets: int, m: int) -> Column:
    """Fill every bucket from itself or from the next filled one, wrapping around.

    ``found`` is sorted by bucket, so each entry fills the empty buckets between
    its predecessor and itself; the first one also takes the tail.
    """
    n = F.size(found)

    def spans(e: Column, i: Column) -> Column:
        # entry i belongs to the group of its bucket: fill from the last bucket of the group before
        before = F.filter(F.slice(found, F.greatest(i + 1 - m, F.lit(1)), F.least(i, F.lit(m))), lambda x: x["b"] < e["b"])
        prev = F.when(F.size(before) > 0, F.element_at(before, -1)["b"]).otherwise(F.lit(-1))
        own = F.transform(F.sequence(prev + 1, e["b"]), lambda b: F.struct(b.alias("b"), e["h"].alias("h")))
        last = F.element_at(found, -1)["b"]
        first = F.element_at(found, 1)["b"]
        tail = F.when(
            (e["b"] == first) & (last < buckets - 1),
            F.transform(F.sequence(last + 1, F.lit(buckets - 1)), lambda b: F.struct(b.alias("b"), e["h"].alias("h"))),
        ).otherwise(F.slice(own, F.lit(1), F.lit(0)))
        return F.concat(own, tail)

    return F.when(n > 0, F.sort_array(F.flatten(F.transform(found, spans)))).otherwise(found)


TOKEN_FILTERS: dict[str, Callable] = {
    "lowercase": Lowercase, "uppercase": Uppercase, "trim": Trim, "reverse": Reverse, "asciifolding": AsciiFolding,
    "apostrophe": Apostrophe, "classic": ClassicNormalize,
    "decimal_digit": lambda: MapCharacters(charmaps.DECIMAL_DIGITS), "cjk_width": lambda: MapCharacters(charmaps.WIDTH_FOLDING),
    "arabic_normalization": lambda: MapCharacters(charmaps.ARABIC), "persian_normalization": lambda: MapCharacters(charmaps.PERSIAN),
    "sorani_normalization": lambda: MapCharacters(charmaps.SORANI), "hindi_normalization": lambda: MapCharacters(charmaps.HINDI),
    "indic_normalization": lambda: MapCharacters(charmaps.INDIC), "bengali_normalization": lambda: MapCharacters(charmaps.BENGALI),
    "serbian_normalization": lambda: MapCharacters(charmaps.SERBIAN), "german_normalization": GermanNormalize,
    "scandinavian_normalization": ScandinavianNormalize, "scandinavian_folding": ScandinavianFold, "elision": Elision,
    "stop": Stop, "keep": Keep, "keep_types": KeepTypes, "length": Length, "limit": Limit, "truncate": Truncate,
    "unique": Unique, "remove_duplicates": RemoveDuplicates, "fingerprint": Fingerprint, "min_hash": MinHash,
    "shingle": Shingle, "common_grams": CommonGrams, "cjk_bigram": CjkBigram, "ngram": NgramFilter,
    "edge_ngram": EdgeNgramFilter, "pattern_capture": PatternCapture, "pattern_replace": PatternReplace,
    "synonym": Synonym, "synonym_graph": SynonymGraph, "stemmer_override": StemmerOverride,
    "keyword_marker": KeywordMarker, "keyword_repeat": KeywordRepeat, "condition": Condition,
    "predicate_token_filter": Predicate, "multiplexer": Multiplexer, "delimited_payload": DelimitedPayload,
    "word_delimiter": WordDelimiter, "word_delimiter_graph": WordDelimiterGraph,
    "dictionary_decompounder": Decompound, "phonetic": Phonetic,
}
# Filters that may stand in a normalizer: they rewrite one value without cutting it.
SINGLE_VALUE_FILTERS = {
    "lowercase", "uppercase", "trim", "reverse", "asciifolding", "apostrophe", "classic", "decimal_digit", "cjk_width",
    "arabic_normalization", "persian_normalization", "sorani_normalization", "hindi_normalization", "indic_normalization",
    "bengali_normalization", "serbian_normalization", "german_normalization", "scandinavian_normalization",
    "scandinavian_folding", "elision", "truncate", "pattern_replace",
}
