"""Secret scans: all rules in one pass over the bytes of a text (see ``automaton`` for the method)."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.llm.automaton import compile_rules, scan
from textloom.llm.catalog import id_and_text, register, table
from textloom.llm.text import slices, texts_of


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _value(match: bytes) -> bytes:
    """What stands after the sign of an assignment."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    return match[at + 1 :].lstrip(b" ").lstrip(b"\"'")


class Rule(NamedTuple):
    """A kind of secret: its pattern, and which of its matches count."""

    kind: str
    pattern: str
    counts: Callable[[bytes], bool]
    base: bool = False


_KEYWORDS = "|".join((*(either_case(w) for w in ("password", "passwd", "secret", "token")), "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"))

#: The base kinds, in the order in which ties are listed; then kinds added here.
RULES = (
    Rule("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=\-]+)""", lambda m: len(_value(m)) >= 12, True),
    Rule("access", "AKIA[A-Z0-9]+", lambda m: len(m) >= 18, True),
    Rule("hex", "[0-9a-f]{16,}", lambda m: True, True),  # runs are maximal, so shorter ones can be left out at once
    Rule("forge", r"gh[oprsu]_[A-Za-z0-9]+", lambda m: len(m) >= 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9\-]+", lambda m: len(m) >= 20),
    Rule("private", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", lambda m: True),
)

MASK = "[secret]"


def spans_of(automaton, rules, text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) in code points, in order of start and then of the rules."""
    data = text.encode("utf-8")
    found = [(start, k, end) for k, start, end in scan(automaton, data) if rules[k].counts(data[start:end])]
    found.sort()
    if len(data) == len(text):
        return [(start, rules[k].kind, end) for start, k, end in found]
    out, seen, at = [], 0, 0
    for start, k, end in found:
        at += len(data[seen:start].decode("utf-8"))
        seen = start
        out.append((at, rules[k].kind, at + len(data[start:end].decode("utf-8"))))
    return out


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: one row per input row with all spans ``(kind, start, end)``, possibly none.

    Offsets are code points, the end exclusive. Matches of a kind are leftmost and do not overlap;
    matches of different kinds may. Null and empty texts have no spans.
    """
    source = id_and_text(docs, id_col, text_col)
    automaton = compile_rules({r.kind: r.pattern for r in rules})

    def find(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches):
            rows = [[{"kind": k, "start": s, "end": e} for s, k, e in spans_of(automaton, rules, t)] for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return source.mapInArrow(find, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def masked(text: str, spans: list[tuple[int, str, int]], mask: str = MASK) -> str:
    """The text with each stretch of spans replaced; overlapping ones become one."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join((*parts, text[at:]))


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with secrets replaced in the text and its length brought up to date.

    Rows without secrets, null texts included, stay as they are.
    """
    automaton = compile_rules({r.kind: r.pattern for r in rules})

    def mask(batches):
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            changed = {i: masked(t, spans) for i, t in enumerate(texts) if t and (spans := spans_of(automaton, rules, t))}
            columns = list(batch.columns)
            columns[at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], batch.schema.field(at).type)
            where = batch.schema.get_field_index(length_col) if length_col else -1
            if where >= 0:
                sizes = columns[where].to_pylist()
                columns[where] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(sizes)], batch.schema.field(where).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(mask, docs.schema)


@register("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in RULES if r.base]
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
