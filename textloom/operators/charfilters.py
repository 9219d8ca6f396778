"""Character filters: rewrites of the whole text before it is cut into tokens."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from textloom.functions.charmaps import apply_map

# Named character references, the ampersand last.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&copy;": "©", "&reg;": "®",
    "&middot;": "·", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—", "&euro;": "€", "&laquo;": "«", "&raquo;": "»",
    "&amp;": "&",
}
KEEP_OPEN, KEEP_CLOSE = "\ue000", "\ue001"


@dataclass(frozen=True)
class HtmlStrip:
    """Remove script and style blocks, comments and tags; decode references."""

    escaped_tags: tuple[str, ...] = ()

    def apply(self, text: Column) -> Column:
        for block in ("script", "style"):
            text = F.regexp_replace(text, rf"(?is)<{block}\b[^>]*>.*?</{block}\s*>", " ")
        text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
        if self.escaped_tags:
            names = "|".join(self.escaped_tags)
            text = F.regexp_replace(text, rf"(?i)<(/?(?:{names})(?:\s[^>]*)?)>", f"{KEEP_OPEN}$1{KEEP_CLOSE}")
        text = F.regexp_replace(text, r"<[^>]*>", " ")
        text = F.translate(text, KEEP_OPEN + KEEP_CLOSE, "<>") if self.escaped_tags else text
        for name, char in ENTITIES.items():
            text = F.replace(text, F.lit(name), F.lit(char))
        return text


@dataclass(frozen=True)
class CharMapping:
    """Replace by ``key => value`` rules, longest key first."""

    mappings: tuple[str, ...] = ()
    mappings_path: str | None = None

    def table(self) -> dict[str, str]:
        rules = list(self.mappings)
        if self.mappings_path:
            with open(self.mappings_path, encoding="utf-8") as f:
                rules += [line for line in f.read().splitlines() if line.strip()]
        if not rules:
            raise ValueError("mappings or mappings_path is required")
        return {k.strip(): v.strip() for k, v in (r.split("=>", 1) for r in rules)}

    def apply(self, text: Column) -> Column:
        return apply_map(text, self.table())


@dataclass(frozen=True)
class PatternReplaceChars:
    """Regex replacement over the text; ``all=False`` stops after the first match."""

    pattern: str
    replacement: str = ""
    all: bool = True

    def apply(self, text: Column) -> Column:
        return replace_pattern(text, self.pattern, self.replacement, self.all)


def replace_pattern(col: Column, pattern: str, replacement: str, every: bool) -> Column:
    if every:
        return F.regexp_replace(col, pattern, replacement)
    # The lazy prefix reaches the first match only; groups move up by one.
    shifted = "".join(
        f"${int(replacement[i + 1]) + 1}" if c == "$" and replacement[i + 1 : i + 2].isdigit() else ("" if i and replacement[i - 1] == "$" and c.isdigit() else c)
        for i, c in enumerate(replacement)
    )
    return F.regexp_replace(col, rf"\A([\s\S]*?)(?:{pattern})", "$1" + shifted)


CHAR_FILTERS = {"html_strip": HtmlStrip, "mapping": CharMapping, "pattern_replace": PatternReplaceChars}
