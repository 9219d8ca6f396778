"""Analyzers, normalizers and the settings that name them."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.arrays import let
from textloom.operators.charfilters import CHAR_FILTERS
from textloom.operators.tokenfilters import SINGLE_VALUE_FILTERS, TOKEN_FILTERS, Fingerprint, AsciiFolding, Lowercase, Stop, Tokens
from textloom.operators.tokenizers import TOKENIZERS, Keyword, LowercaseLetter, Pattern, Standard, Whitespace

# Languages with an analyzer of their own, and those without stem exclusions.
LANGUAGES = (
    "arabic", "armenian", "basque", "bengali", "brazilian", "bulgarian", "catalan", "cjk", "czech", "danish",
    "dutch", "english", "estonian", "finnish", "french", "galician", "german", "greek", "hindi", "hungarian",
    "indonesian", "irish", "italian", "latvian", "lithuanian", "norwegian", "persian", "portuguese", "romanian",
    "russian", "sorani", "spanish", "swedish", "turkish", "thai",
)
NO_STEM_EXCLUSION = {"brazilian", "cjk", "danish", "estonian", "greek", "persian", "thai"}
# Elided articles by language code.
ELISIONS = {
    "fr": ("l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu"),
    "ca": ("d", "l", "m", "n", "s", "t"),
    "it": ("c", "l", "all", "dall", "dell", "nell", "sull", "coll", "pell", "gl", "agl", "dagl", "degl", "negl", "sugl", "un", "m", "t", "s", "v", "d"),
    "ga": ("d", "m", "b"),
}
# Token filters that are normalizers by themselves.
BUILT_IN_NORMALIZERS = (
    "arabic_normalization", "asciifolding", "bengali_normalization", "cjk_width", "decimal_digit", "elision",
    "german_normalization", "hindi_normalization", "indic_normalization", "lowercase", "persian_normalization",
    "scandinavian_folding", "serbian_normalization", "sorani_normalization", "uppercase",
)


@dataclass(frozen=True)
class Analyzer:
    """Char filters, one tokenizer, token filters: one Column expression."""

    tokenizer: object
    char_filters: tuple = ()
    filters: tuple = ()
    position_increment_gap: int = 100

    def __post_init__(self) -> None:
        if self.tokenizer is None:
            raise ValueError("an analyzer cuts text with exactly one tokenizer; none was given")

    def filtered(self, text: Column) -> Column:
        for c in self.char_filters:
            text = c.apply(text)
        return text

    def tokens(self, text: Column, types: bool = False, offsets: bool = False) -> Tokens:
        """The token array of a text; offsets refer to the text after char filters."""
        text = self.filtered(text)
        types = types or any(getattr(f, "needs_types", False) for f in self.filters)
        if offsets:
            ts = Tokens(self.tokenizer.apply_with_offsets(text), ("token", "position", "type", "start_offset", "end_offset"))
        else:
            ts = Tokens(self.tokenizer.apply(text), ("token", "position") + (("type",) if types else ()), plain=True)
        for f in self.filters:
            ts = f.apply(ts)
        return ts

    def array(self, text: Column, **options: bool) -> Column:
        return self.tokens(text, **options).array()

    def values(self, texts: Column) -> Column:
        """Tokens of a multi-valued field: positions go on after a gap per value."""

        fields = self.tokens(F.lit("x"))

        def shifted(arrays: Column) -> Column:
            # what each value moves those after it by; one without tokens moves nothing
            steps = F.transform(arrays, lambda a: F.when(F.size(a) > 0, F.element_at(a, -1)["position"] + 1 + self.position_increment_gap).otherwise(F.lit(0)))
            sums = F.aggregate(steps, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array((F.element_at(acc, -1) + n).cast("int"))))

            def moved(shifts: Column) -> Column:
                each = lambda a, i: F.transform(a, lambda t: fields.struct(t, position=(t["position"] + F.get(shifts, i)).cast("int")))
                return F.flatten(F.transform(arrays, each))

            return let(sums, moved)

        return let(F.transform(texts, lambda text: self.tokens(text).array()), shifted)


@dataclass(frozen=True)
class Normalizer:
    """Char filters and one-value filters for keyword columns."""

    char_filters: tuple = ()
    filters: tuple = ()

    def __post_init__(self) -> None:
        if not self.char_filters and not self.filters:
            raise ValueError("a normalizer without any char filter or token filter would change nothing")

    def apply(self, value: Column) -> Column:
        for c in self.char_filters:
            value = c.apply(value)
        ts = Tokens(F.lit(None))
        for f in self.filters:
            ts = f.apply(ts)
        for rewrite in ts.pending:
            value = rewrite(value)
        return value


# --- ready-made analyzers --------------------------------------------------------


def standard(stopwords=(), stopwords_path: str | None = None, max_token_length: int = 255) -> Analyzer:
    return Analyzer(Standard(max_token_length), filters=(Lowercase(), *_stop(stopwords, stopwords_path)))


def simple() -> Analyzer:
    return Analyzer(LowercaseLetter())


def whitespace() -> Analyzer:
    return Analyzer(Whitespace())


def keyword() -> Analyzer:
    return Analyzer(Keyword())


def stop(stopwords="_english_", stopwords_path: str | None = None) -> Analyzer:
    return Analyzer(LowercaseLetter(), filters=_stop(stopwords, stopwords_path))


def pattern(pattern: str = r"\W+", flags: tuple[str, ...] = (), lowercase: bool = True, stopwords=(), stopwords_path: str | None = None) -> Analyzer:
    return Analyzer(Pattern(pattern, tuple(flags)), filters=((Lowercase(),) if lowercase else ()) + _stop(stopwords, stopwords_path))


def fingerprint(separator: str = " ", max_output_size: int = 255, stopwords=(), stopwords_path: str | None = None) -> Analyzer:
    return Analyzer(
        Standard(), filters=(Lowercase(), AsciiFolding(), *_stop(stopwords, stopwords_path), Fingerprint(max_output_size, separator))
    )


def _stop(words, path: str | None) -> tuple:
    if isinstance(words, list):
        words = tuple(words)
    if not words and not path:
        return ()
    return (Stop(words or (), path),)


def language(name: str, stopwords=(), stopwords_path: str | None = None, stem_exclusion: tuple[str, ...] = (), stems: dict[str, str] | None = None) -> Analyzer:
    """Analyzer of one language: elision, lowercase, stop list, given stems.

    Algorithmic stemming is not built; stems come as a table of the user's.
    """
    from textloom.operators import tokenfilters as tf

    if name not in LANGUAGES:
        raise ValueError(f"no language {name!r}")
    if stem_exclusion and name in NO_STEM_EXCLUSION:
        raise ValueError(f"stem_exclusion is not supported for {name}")
    code = {"french": "fr", "catalan": "ca", "italian": "it", "irish": "ga"}.get(name)
    extra = {
        "arabic": ("decimal_digit", "arabic_normalization"), "bengali": ("decimal_digit", "indic_normalization", "bengali_normalization"),
        "hindi": ("decimal_digit", "indic_normalization", "hindi_normalization"), "persian": ("decimal_digit", "arabic_normalization", "persian_normalization"),
        "sorani": ("sorani_normalization", "decimal_digit"), "german": ("german_normalization",), "cjk": ("cjk_width", "cjk_bigram"),
        "thai": ("decimal_digit",),
    }.get(name, ())
    filters: list = [tf.Elision(ELISIONS[code], articles_case=True)] if code else []
    if name == "turkish":
        filters.append(tf.Apostrophe())
    filters.append(Lowercase(name if name in ("greek", "turkish", "irish") else None))
    filters += [TOKEN_FILTERS[f]() for f in extra]
    filters += _stop(stopwords, stopwords_path)
    kept = {w: s for w, s in (stems or {}).items() if w not in stem_exclusion}
    if kept:
        filters.append(tf.StemmerOverride(tuple(f"{w} => {s}" for w, s in kept.items())))
    return Analyzer(Standard(), filters=tuple(filters))


BUILT_IN_ANALYZERS = {"standard": standard, "simple": simple, "whitespace": whitespace, "keyword": keyword, "stop": stop, "pattern": pattern, "fingerprint": fingerprint}


# --- settings --------------------------------------------------------------------


@dataclass(frozen=True)
class AnalysisSettings:
    """Named parts as plain JSON-like specs ``{"name": {"type": ..., option: value}}``."""

    char_filter: dict = field(default_factory=dict)
    tokenizer: dict = field(default_factory=dict)
    filter: dict = field(default_factory=dict)
    normalizer: dict = field(default_factory=dict)
    analyzer: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(self.__dict__, ensure_ascii=False, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> AnalysisSettings:
        return AnalysisSettings(**json.loads(text))

    def has_analyzer(self, name: str) -> bool:
        return name in self.analyzer or name in BUILT_IN_ANALYZERS or name in LANGUAGES

    def has_normalizer(self, name: str) -> bool:
        return name in self.normalizer or name in BUILT_IN_NORMALIZERS

    def _part(self, kind: str, catalog: dict, name: str):
        spec = dict(getattr(self, kind).get(name, {"type": name}))
        cls = spec.pop("type")
        if cls not in catalog:
            raise ValueError(f"no {kind} {name!r}")
        options = {k: tuple(v) if isinstance(v, list) else v for k, v in spec.items()}
        if kind == "filter" and cls == "condition":
            options["filters"] = tuple(self._part("filter", catalog, f) for f in options.pop("filter", ()))
        if kind == "filter" and cls == "multiplexer":
            options["branches"] = tuple(
                tuple(self._part("filter", catalog, f.strip()) for f in branch.split(",")) for branch in options.pop("filters", ())
            )
        if kind == "tokenizer" and cls in ("pattern", "simple_pattern", "simple_pattern_split") and "pattern" in options:
            options["regex"] = options.pop("pattern")
        return catalog[cls](**options)

    def get_analyzer(self, name: str) -> Analyzer:
        spec = dict(self.analyzer.get(name, {"type": name}))
        kind = spec.pop("type", "custom")
        if kind == "custom":
            if not spec.get("tokenizer"):
                raise ValueError(f"analyzer {name!r} names no tokenizer; known are {', '.join(sorted(TOKENIZERS))}")
            return Analyzer(
                self._part("tokenizer", TOKENIZERS, spec["tokenizer"]),
                tuple(self._part("char_filter", CHAR_FILTERS, c) for c in spec.get("char_filter", ())),
                tuple(self._part("filter", TOKEN_FILTERS, f) for f in spec.get("filter", ())),
                spec.get("position_increment_gap", 100),
            )
        options = {k: tuple(v) if isinstance(v, list) else v for k, v in spec.items()}
        if kind in BUILT_IN_ANALYZERS:
            return BUILT_IN_ANALYZERS[kind](**options)
        if kind in LANGUAGES:
            return language(kind, **options)
        raise ValueError(f"no analyzer {name!r}")

    def get_normalizer(self, name: str) -> Normalizer:
        spec = self.normalizer.get(name)
        if spec is None:
            if name not in BUILT_IN_NORMALIZERS:
                raise ValueError(f"no normalizer {name!r}")
            options = {"articles": ELISIONS["fr"], "articles_case": True} if name == "elision" else {}
            return Normalizer(filters=(TOKEN_FILTERS[name](**options),))
        for f in spec.get("filter", ()):
            if self.filter.get(f, {"type": f})["type"] not in SINGLE_VALUE_FILTERS:
                raise ValueError(f"filter {f!r} may not stand in a normalizer")
        return Normalizer(
            tuple(self._part("char_filter", CHAR_FILTERS, c) for c in spec.get("char_filter", ())),
            tuple(self._part("filter", TOKEN_FILTERS, f) for f in spec.get("filter", ())),
        )


def analyze(df: DataFrame, text: str, analyzer: Analyzer, keep: tuple[str, ...] = ("_id",), types: bool = False, offsets: bool = False) -> DataFrame:
    """Token table of a text column: the kept columns, then one row per token."""
    ts = analyzer.tokens(F.col(text), types=types, offsets=offsets)
    return df.select(*keep, F.explode(ts.array()).alias("t")).select(*keep, "t.*")
