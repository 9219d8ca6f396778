"""Typed ingest: raw columns to the mapping's types, with rejects set aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from textloom.functions.arrays import let
from textloom.functions.dates import parse_date
from textloom.operators.analyzers import AnalysisSettings
from textloom.plans.mapping import Field, Mapping

NUMERIC = {"byte", "short", "integer", "long", "half_float", "float", "double", "scaled_float"}


def ip_number(ip: Column) -> Column:
    """IPv4 text as a number, so that ranges compare."""
    part = lambda i: F.split_part(ip, F.lit("."), F.lit(i)).try_cast("bigint")
    return F.when(ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), part(1) * 16777216 + part(2) * 65536 + part(3) * 256 + part(4))


def ip_key(ip: Column) -> Column:
    """An IPv4 or IPv6 address as 32 hexadecimal digits that sort as addresses do; NULL for other text.

    IPv4 addresses stand where IPv6 maps them (``::ffff:a.b.c.d``).
    """
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    quad = rf"{octet}(?:\.{octet}){{3}}"
    quad_hex = lambda text: F.array_join(F.transform(F.split(text, r"\."), lambda part: F.lpad(F.lower(F.hex(part.try_cast("bigint"))), 2, "0")), "")
    # the last two groups may be written as an IPv4 address
    mapped = lambda pair: F.concat(F.regexp_replace(ip, f"{quad}$", ""), F.substring(pair, 1, 4), F.lit(":"), F.substring(pair, 5, 4))
    plain = F.when(ip.rlike(f":{quad}$"), let(quad_hex(F.regexp_extract(ip, f":({quad})$", 1)), mapped)).otherwise(ip)
    groups = lambda text: F.filter(F.split(F.coalesce(text, F.lit("")), ":"), lambda g: g != "")

    def filled(h: Column) -> Column:
        """The eight groups of an address split at its ``::``."""
        missing = F.lit(8) - F.size(h["left"]) - F.size(h["right"])
        zeros = F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0)))
        return F.when(h["halves"] == 1, h["left"]).when((h["halves"] == 2) & (missing > 0), F.concat(h["left"], zeros, h["right"]))

    def digits(text: Column) -> Column:
        parts = lambda h: F.struct(groups(F.get(h, F.lit(0))).alias("left"), groups(F.get(h, F.lit(1))).alias("right"), F.size(h).alias("halves"))
        eight = let(let(F.split(F.lower(text), "::"), parts), filled)
        return let(eight, lambda g: F.when(F.size(g) == 8, F.array_join(F.transform(g, lambda x: F.lpad(x, 4, "0")), "")))

    wrong = r"[^0-9A-Fa-f:]|^:(?!:)|[^:]:$|:::|[0-9A-Fa-f]{5}"
    six = let(plain, lambda text: F.when(~text.rlike(wrong), digits(text)))
    return F.when(ip.rlike(f"^{quad}$"), F.concat(F.lit("0" * 20 + "ffff"), quad_hex(ip))).when(ip.contains(":"), six)


def typed(f: Field, raw: Column, raw_type: T.DataType) -> Column:
    """The value of a field, NULL where the raw value does not fit its type."""
    target = f.spark_type()
    is_text = isinstance(raw_type, T.StringType)
    if f.type in NUMERIC or f.type == "boolean":
        if is_text and f.coerce is False:
            return F.lit(None).cast(target)
        return raw.try_cast(target)
    if f.type in ("date", "date_nanos"):
        if isinstance(raw_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return raw.cast("timestamp")
        return parse_date(raw.cast("string"), f.format)
    if f.type == "ip":
        return F.when(ip_key(raw).isNotNull(), raw)
    if f.type in ("text", "keyword", "search_as_you_type"):
        return raw if isinstance(raw_type, T.ArrayType) else raw.cast("string")
    return raw.cast(target) if raw_type != target else raw


def has_search_form(f: Field) -> bool:
    """Whether a field is searched by other values than it holds."""
    return f.type in ("ip", "ip_range") or f.null_value is not None or f.ignore_above is not None or f.normalizer is not None


def searchable(f: Field, value: Column, settings: AnalysisSettings) -> Column:
    """A value as it is searched: missing value, length limit, normalizer, address key."""
    if f.null_value is not None:
        value = F.coalesce(value, F.lit(f.null_value).cast(f.spark_type()))
    if f.ignore_above is not None:
        value = F.when(F.length(value) <= f.ignore_above, value)
    if f.normalizer:
        value = settings.get_normalizer(f.normalizer).apply(value)
    if f.type == "ip":
        value = ip_key(value)
    if f.type == "ip_range":
        value = F.struct(ip_key(value["gte"]).alias("gte"), ip_key(value["lte"]).alias("lte"))
    return value


def ingest(raw: DataFrame, mapping: Mapping, settings: AnalysisSettings | None = None) -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)`` from rows with ``_id`` and raw columns.

    A malformed value becomes NULL where the field ignores malformed input, and
    sends its row to the rejects otherwise. Fields outside the mapping stay in
    ``_raw`` as JSON, or become columns where the mapping is dynamic. Every field
    keeps its value; where it is searched by another one (missing value, length
    limit, normalizer, address), that stands in ``name__search``. Multi-fields
    become ``name__sub``; ``copy_to`` fills its target from all sources.
    """
    settings = settings or AnalysisSettings()
    types = {c.name: c.dataType for c in raw.schema.fields}
    known = [f for f in mapping.fields if f.enabled is not False]
    values: dict[str, Column] = {}
    broken: list[Column] = []
    for f in known:
        if f.name not in types:
            values[f.name] = F.lit(None).cast(f.spark_type())
            continue
        value = typed(f, F.col(f.name), types[f.name])
        if f.ignore_malformed is not True:
            broken.append(F.when(F.col(f.name).isNotNull() & value.isNull(), F.lit(f.name)))
        values[f.name] = value

    targets: dict[str, list[str]] = {}
    for f in known:
        for t in f.copy_to:
            targets.setdefault(t, []).append(f.name)
    for target, sources in targets.items():
        own = [values[target]] if target in values and target in types else []
        values[target] = F.concat_ws(" ", *own, *[values[s].cast("string") for s in sources])

    cols = []
    for f in known:
        cols.append(values[f.name].alias(f.name))
        if has_search_form(f):
            cols.append(searchable(f, values[f.name], settings).alias(f"{f.name}__search"))
        for sub in f.fields:
            if sub.type not in ("text", "search_as_you_type"):
                cols.append(searchable(sub, typed(sub, values[f.name], f.spark_type()), settings).alias(f"{f.name}__{sub.name}"))
    mapped = {f.name for f in mapping.fields}
    others = [c for c in raw.columns if c != "_id" and c not in mapped]
    if mapping.dynamic:
        cols += [F.col(c) for c in others]
    hidden = [f.name for f in mapping.fields if f.enabled is False and f.name in types]
    kept_raw = hidden + ([] if mapping.dynamic else others)
    if kept_raw:
        cols.append(F.to_json(F.struct(*kept_raw)).alias("_raw"))

    reasons = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    checked = raw.withColumn("_malformed", reasons)
    docs = checked.where(F.size("_malformed") == 0).select("_id", *cols)
    rejects = checked.where(F.size("_malformed") > 0)
    return docs, rejects


def from_json_lines(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """Documents held as JSON text: every mapped field as its raw string, ``_id`` and ``_index`` from the body."""
    paths = ["_id", "_index"] + [f.name for f in mapping.fields]
    return df.select("*", *[F.get_json_object(column, f"$.{p}").alias(p) for p in paths if p not in df.columns])
