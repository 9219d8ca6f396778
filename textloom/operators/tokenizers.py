"""Tokenizers: a text column to an array of words, inside the row.

No tokenizer explodes or shuffles: a document stays one row, so the work is
spread exactly as the input is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from textloom.functions.arrays import let, prefix_sums

APOSTROPHES = "['’]"
STANDARD = rf"[\p{{L}}\p{{N}}]+(?:{APOSTROPHES}[\p{{L}}\p{{N}}]+)*"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL = r"(?:https?|ftp)://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~%!$&'()*+,;=:@/-]*)?(?:\?[A-Za-z0-9._~%!$&'()*+,;=:@/?-]*)?(?:#[A-Za-z0-9._~%!$&'()*+,;=:@/?-]*)?"
HOST = r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)+"
ACRONYM = r"(?:\p{L}\.){2,}"
NUMBER_WORD = r"[\p{L}\p{N}]+(?:[-/_.,][\p{L}\p{N}]*\p{N}[\p{L}\p{N}]*)+"

# Character classes by name, as regex class members.
CHAR_CLASSES = {"letter": r"\p{L}", "digit": r"\p{N}", "whitespace": r"\s", "punctuation": r"\p{P}", "symbol": r"\p{S}"}
# Regex flag names and their inline letters.
REGEX_FLAGS = {"UNIX_LINES": "d", "CASE_INSENSITIVE": "i", "COMMENTS": "x", "MULTILINE": "m", "DOTALL": "s", "UNICODE_CASE": "u", "UNICODE_CHARACTER_CLASS": "U"}


def with_flags(pattern: str, flags: tuple[str, ...]) -> str:
    if "LITERAL" in flags:
        pattern = r"\Q" + pattern + r"\E"
    letters = "".join(REGEX_FLAGS[f] for f in flags if f in REGEX_FLAGS)
    return f"(?{letters}){pattern}" if letters else pattern


def char_class(names: tuple[str, ...], custom: str = "") -> str:
    """Members of a regex class from class names, single characters and custom characters."""
    parts = [CHAR_CLASSES[n] if n in CHAR_CLASSES else _escape(n) for n in names if n != "custom"]
    return "".join(parts) + "".join(_escape(c) for c in custom)


def _escape(text: str) -> str:
    return "".join(c if c.isalnum() or c in "\n\t\r " else "\\" + c for c in text)


def token_type(token: Column) -> Column:
    return (
        F.when(token.rlike(r"^\p{N}+$"), F.lit("<NUM>"))
        .when(token.rlike(r"^\p{IsHangul}"), F.lit("<HANGUL>"))
        .otherwise(F.lit("<ALPHANUM>"))
    )


def _cut_long(words: Column, limit: int) -> Column:
    """Cut words longer than ``limit``; texts without such words pass unchanged."""
    return let(
        words,
        lambda ws: F.when(
            F.exists(ws, lambda w: F.length(w) > limit),
            F.flatten(
                F.transform(
                    ws,
                    lambda w: F.transform(
                        F.sequence(F.lit(0), F.floor((F.length(w) - 1) / limit).cast("int")),
                        lambda k: F.substring(w, k * limit + 1, F.lit(limit)),
                    ),
                )
            ),
        ).otherwise(ws),
    )


class _Words:
    """Base of tokenizers that are a list of words per text."""

    typed = False
    max_token_length: int | None = None

    def pattern(self) -> str | None:
        """Regex whose matches are the tokens, if there is one (offsets need it)."""
        return None

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern()), F.lit(0))

    def apply(self, text: Column) -> Column:
        """The words of the text in order."""
        words = self.words(text)
        return _cut_long(words, self.max_token_length) if self.max_token_length else words

    def apply_with_offsets(self, text: Column) -> Column:
        """Tokens with character offsets, from word lengths and gap lengths."""
        if self.pattern() is None:
            raise ValueError(f"{type(self).__name__} reports no offsets")
        limit = self.max_token_length or (1 << 30)

        def build(words: Column) -> Column:
            gaps = F.transform(F.split(text, self.pattern(), -1), lambda g: F.length(g))
            # distance from the start of word i to the start of word i + 1
            steps = F.transform(gaps, lambda g, i: F.when(i == 0, g).otherwise(g + F.length(F.get(words, i - 1))))
            return let(
                let(steps, lambda st: F.zip_with(prefix_sums(st), st, lambda before, own: before + own)),
                lambda st: F.flatten(
                    F.transform(
                        words,
                        lambda w, i: F.transform(
                            F.sequence(F.lit(0), F.floor((F.length(w) - 1) / limit).cast("int")),
                            lambda k: F.struct(
                                F.substring(w, k * limit + 1, F.lit(limit)).alias("w"),
                                (F.get(st, i) + k * limit).alias("s"),
                            ),
                        ),
                    )
                ),
            )

        return F.transform(
            let(F.regexp_extract_all(text, F.lit(self.pattern()), F.lit(0)), build),
            lambda e, i: F.struct(
                e["w"].alias("token"),
                i.alias("position"),
                token_type(e["w"]).alias("type"),
                e["s"].alias("start_offset"),
                (e["s"] + F.length(e["w"])).alias("end_offset"),
            ),
        )


@dataclass(frozen=True)
class Standard(_Words):
    max_token_length: int = 255

    def pattern(self) -> str:
        return STANDARD


@dataclass(frozen=True)
class Whitespace(_Words):
    max_token_length: int = 255

    def pattern(self) -> str:
        return r"\S+"


@dataclass(frozen=True)
class UrlEmail(_Words):
    """Standard, but a URL or an e-mail address stays one token."""

    max_token_length: int = 255

    def pattern(self) -> str:
        return f"{URL}|{EMAIL}|{STANDARD}"


@dataclass(frozen=True)
class Classic(_Words):
    """English grammar: e-mail, acronym, hyphenated number, host name, word."""

    max_token_length: int = 255

    def pattern(self) -> str:
        return f"{EMAIL}|{ACRONYM}|{NUMBER_WORD}|{HOST}|{STANDARD}"


@dataclass(frozen=True)
class Letter(_Words):
    def pattern(self) -> str:
        return r"\p{L}+"


@dataclass(frozen=True)
class LowercaseLetter(_Words):
    """Letter runs, lowercased."""

    def pattern(self) -> str:
        return r"\p{L}+"

    def words(self, text: Column) -> Column:
        return F.transform(super().words(text), F.lower)


@dataclass(frozen=True)
class Ngram(_Words):
    """All substrings of min..max characters of each run of allowed characters."""

    min_gram: int = 1
    max_gram: int = 2
    token_chars: tuple[str, ...] = ()
    custom_token_chars: str = ""
    edge: bool = False

    def runs(self, text: Column) -> Column:
        if not self.token_chars:
            return F.array(text)
        members = char_class(self.token_chars, self.custom_token_chars)
        return F.regexp_extract_all(text, F.lit(f"[{members}]+"), F.lit(0))

    def words(self, text: Column) -> Column:
        return F.flatten(F.transform(self.runs(text), lambda r: grams(r, self.min_gram, self.max_gram, self.edge)))


def grams(word: Column, low: int, high: int, edge: bool) -> Column:
    """Substrings of one word by start, then by length."""
    n = F.length(word)

    def at(start: Column) -> Column:
        longest = F.least(F.lit(high), n - start + 1)
        return F.transform(F.sequence(F.lit(low), longest), lambda k: F.substring(word, start, k))

    none = F.array().cast("array<string>")
    if edge:
        return F.when(n >= low, at(F.lit(1))).otherwise(none)
    return F.when(n >= low, F.flatten(F.transform(F.sequence(F.lit(1), n - low + 1), at))).otherwise(none)


@dataclass(frozen=True)
class EdgeNgram(Ngram):
    edge: bool = True


@dataclass(frozen=True)
class Keyword(_Words):
    def words(self, text: Column) -> Column:
        return F.array(text)


@dataclass(frozen=True)
class Pattern(_Words):
    """Split on a regex (``group=-1``) or keep one of its groups."""

    regex: str = r"\W+"
    flags: tuple[str, ...] = ()
    group: int = -1

    def words(self, text: Column) -> Column:
        rx = with_flags(self.regex, self.flags)
        if self.group < 0:
            return F.filter(F.split(text, rx), lambda w: w != "")
        return F.filter(F.regexp_extract_all(text, F.lit(rx), F.lit(self.group)), lambda w: w != "")


@dataclass(frozen=True)
class SimplePattern(_Words):
    regex: str = ""

    def pattern(self) -> str:
        return self.regex


@dataclass(frozen=True)
class SimplePatternSplit(_Words):
    regex: str = ""

    def words(self, text: Column) -> Column:
        return F.filter(F.split(text, self.regex), lambda w: w != "")


@dataclass(frozen=True)
class CharGroup(_Words):
    """Split on listed characters or character classes."""

    tokenize_on_chars: tuple[str, ...] = ()

    def words(self, text: Column) -> Column:
        if not self.tokenize_on_chars:
            raise ValueError("tokenize_on_chars is required")
        return F.filter(F.split(text, f"[{char_class(self.tokenize_on_chars)}]+"), lambda w: w != "")


@dataclass(frozen=True)
class PathHierarchy(_Words):
    """Every ancestor of a path: ``/a/b`` gives ``/a`` and ``/a/b``."""

    delimiter: str = "/"
    replacement: str | None = None
    reverse: bool = False
    skip: int = 0

    def words(self, text: Column) -> Column:
        glue = self.delimiter if self.replacement is None else self.replacement
        parts = F.split(text, _escape(self.delimiter))

        def build(ps: Column) -> Column:
            n = F.size(ps)
            if self.reverse:
                kept = F.slice(ps, F.lit(1), F.greatest(n - self.skip, F.lit(0)))
                return let(kept, lambda k: F.transform(k, lambda _p, i: F.array_join(F.slice(k, i + 1, F.size(k)), glue)))
            kept = F.slice(ps, F.lit(self.skip + 1), n)
            return let(kept, lambda k: F.transform(k, lambda _p, i: F.array_join(F.slice(k, F.lit(1), i + 1), glue)))

        return F.filter(let(parts, build), lambda w: w != "")


TOKENIZERS = {
    "standard": Standard, "whitespace": Whitespace, "uax_url_email": UrlEmail, "classic": Classic, "letter": Letter,
    "lowercase": LowercaseLetter, "ngram": Ngram, "edge_ngram": EdgeNgram, "keyword": Keyword, "pattern": Pattern,
    "simple_pattern": SimplePattern, "simple_pattern_split": SimplePatternSplit, "char_group": CharGroup,
    "path_hierarchy": PathHierarchy,
}
