"""Character tables for folding and normalising tokens.

Long tables come from the Unicode database by rule; short ones are fixed values.
``apply_map`` turns a table into one ``translate`` plus a few ``replace`` calls.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F


def _latin_folding() -> dict[str, str]:
    """Latin letters with marks, ligatures and full-width forms to their ASCII letters, by decomposition."""
    table = {}
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
        if base and base.isascii() and base.isalpha():
            table[chr(cp)] = base
    # fixed values: letters without a decomposition
    table.update({"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i", "ð": "d", "Ð": "D"})
    table.update({"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH"})
    return table


def _decimal_digits() -> dict[str, str]:
    """Every decimal digit of the basic plane to its ASCII digit."""
    return {chr(cp): str(unicodedata.decimal(chr(cp))) for cp in range(0x80, 0xFFFF) if unicodedata.category(chr(cp)) == "Nd"}


def _width_folding() -> dict[str, str]:
    """Full-width ASCII and half-width katakana to their usual width."""
    return {chr(cp): unicodedata.normalize("NFKC", chr(cp)) for cp in list(range(0xFF01, 0xFF5F)) + list(range(0xFF65, 0xFF9E))}


LATIN_FOLDING = _latin_folding()
DECIMAL_DIGITS = _decimal_digits()
WIDTH_FOLDING = _width_folding()

# Orthographic variants per language. An empty value drops the character.
ARABIC = {"آ": "ا", "أ": "ا", "إ": "ا", "ى": "ي", "ة": "ه", "ـ": "", "ً": "", "ٌ": "", "ٍ": "", "َ": "", "ُ": "", "ِ": "", "ّ": "", "ْ": ""}
PERSIAN = {"ی": "ي", "ے": "ي", "ک": "ك", "ۀ": "ه", "ہ": "ه", "ٔ": ""}
SORANI = {"ي": "ی", "ى": "ی", "ك": "ک", "ە": "ه", "ھ": "ه", "ـ": "", "ً": "", "ٌ": "", "ٍ": "", "َ": "", "ُ": "", "ِ": "", "ّ": "", "ْ": ""}
HINDI = {"ऩ": "न", "ऱ": "र", "ऴ": "ळ", "क़": "क", "ख़": "ख", "ग़": "ग", "ज़": "ज", "ड़": "ड", "ढ़": "ढ", "फ़": "फ", "य़": "य", "ँ": "ं", "आ": "अ", "ई": "इ", "ऊ": "उ", "ी": "ि", "ू": "ु", "ै": "े", "ौ": "ो", "़": "", "्": "", "‍": "", "‌": ""}
INDIC = {"अा": "आ", "एे": "ऐ", "ऎ": "ए", "ऒ": "ओ"}
BENGALI = {"ঈ": "ই", "ঊ": "উ", "ী": "ি", "ূ": "ু", "শ": "স", "ষ": "স", "ণ": "ন", "ড়": "র", "ঢ়": "র", "়": "", "ৎ": "ত", "‍": "", "‌": ""}
SERBIAN = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "ђ": "dj", "е": "e", "ж": "z", "з": "z", "и": "i", "ј": "j", "к": "k", "л": "l", "љ": "lj", "м": "m", "н": "n", "њ": "nj", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "ћ": "c", "у": "u", "ф": "f", "х": "h", "ц": "c", "ч": "c", "џ": "dz", "ш": "s", "č": "c", "ć": "c", "š": "s", "ž": "z", "đ": "dj"}
SCANDINAVIAN_LETTERS = {"ä": "æ", "Ä": "Æ", "ö": "ø", "Ö": "Ø"}
SCANDINAVIAN_PAIRS = {"aa": "å", "ao": "å", "ae": "æ", "oe": "ø", "oo": "ø"}
SCANDINAVIAN_FOLDS = {"å": "a", "ä": "a", "æ": "a", "Å": "A", "Ä": "A", "Æ": "A", "ö": "o", "ø": "o", "Ö": "O", "Ø": "O"}
SCANDINAVIAN_PAIR_FOLDS = {"aa": "a", "ae": "a", "ao": "a", "oe": "o", "oo": "o"}
GERMAN_UMLAUTS = {"ä": "a", "ö": "o", "ü": "u", "ß": "ss"}
GERMAN_PAIRS = {"ae": "a", "oe": "o"}

# Case pairs that plain lowercasing treats differently.
LOWERCASE_BY_LANGUAGE = {
    "greek": {"ά": "α", "έ": "ε", "ή": "η", "ί": "ι", "ό": "ο", "ύ": "υ", "ώ": "ω", "ς": "σ"},
    "turkish": {"İ": "i", "I": "ı"},
    "irish": {},
}


def split_map(table: dict[str, str]) -> tuple[str, str, list[tuple[str, str]]]:
    """(from, to, replacements): one-to-one pairs and drops for ``translate``, the rest for ``replace``."""
    single = [(k, v) for k, v in table.items() if len(k) == 1 and len(v) == 1]
    dropped = [k for k, v in table.items() if len(k) == 1 and v == ""]
    longer = sorted(((k, v) for k, v in table.items() if len(k) > 1 or len(v) > 1), key=lambda p: (-len(p[0]), p[0]))
    return "".join(k for k, _ in single) + "".join(dropped), "".join(v for _, v in single), longer


def apply_map(col: Column, table: dict[str, str]) -> Column:
    """Replace by table: longest keys first, then all single characters in one pass."""
    src, dst, longer = split_map(table)
    out = col
    for key, value in longer:
        out = F.replace(out, F.lit(key), F.lit(value))
    if src:
        out = F.translate(out, src, dst)
    if any(k.isascii() for k in table):
        return out
    # plain ASCII values, the usual case, skip the whole chain
    return F.when(col.rlike("[^\\x00-\\x7F]"), out).otherwise(col)


def lower_for(col: Column, language: str | None) -> Column:
    """Lowercase with the letter rules of the language, where it has its own."""
    if language == "turkish":
        return F.lower(apply_map(col, LOWERCASE_BY_LANGUAGE["turkish"]))
    if language == "irish":
        return F.lower(F.regexp_replace(col, "^([nt])([AEIOUÁÉÍÓÚ])", "$1-$2"))
    if language == "greek":
        return apply_map(F.lower(col), LOWERCASE_BY_LANGUAGE["greek"])
    return F.lower(col)
