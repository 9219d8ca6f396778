"""A searchable collection: a folder of Parquet tables on shared storage.

``docs``        typed documents, range-partitioned by the index sort, or else by id
``forward``     one row per (field, document): its length and its distinct terms
``postings``    one row per (field, term, document), partitioned by field and term bucket
``vocabulary``  document and total frequency per (field, term), by field, sorted by term across files
``field_stats`` two totals per field
``spellings``   for fields that ask for it: the terms by their pieces, for fuzzy lookup
``gone``        ids that a change replaced or deleted
``marks``       the order of the last ordered write of an id
``meta``        one JSON file per version: mapping, settings, options and the folders of each table

A change writes what it adds, and the ids that no longer count in earlier versions; its vocabulary and
totals are differences. It writes into folders of its own, which nobody reads until the version that
lists them is published as one file (``versions``). So a job that dies leaves readers and later writers
as they were, and of two writers of one version one fails. A reader merges the folders that its version
lists; ``compact`` writes a new base. A change of the mapping writes the tables of changed fields only:
``since`` tells from which version on the rows of such a field count.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from textloom.functions.arrays import let
from textloom.operators import postings as P
from textloom.operators.analyzers import AnalysisSettings, Analyzer
from textloom.operators.fuzzy import MAX_EDITS, bucket_of_key, key_bucket, lookup_keys, spelling_keys
from textloom.operators.similarity import FieldStats
from textloom.operators.tokenfilters import Shingle
from textloom.plans.mapping import TEXT_TYPES, Field, Mapping, evolve
from textloom.session import materialize, spread
from textloom.sources import versions
from textloom.sources.ingest import searchable, typed


SCHEMAS = {
    "forward": f"field string, _id string, dl bigint, terms {P.TERMS}",
    "postings": "token string, _id string, tf bigint, dl bigint, positions array<int>, field string, term_bucket int",
    "vocabulary": "token string, df bigint, ttf bigint, term_bucket int, field string",
    "field_stats": "field string, n_docs bigint, n_tokens bigint",
    "spellings": "key string, token string, field string, key_bucket int",
    "gone": "_id string",
}
#: Terms of a prefix that are named one by one; longer lists are read by their buckets and the prefix.
MAX_TERMS = 1000


@dataclass(frozen=True)
class TextField:
    """A text field as it is indexed: where its values are and how they are cut."""

    name: str
    column: str
    analyzer: Analyzer
    search_analyzer: Analyzer
    quote_analyzer: Analyzer
    boost: float = 1.0
    norms: bool = True
    similarity: str = "BM25"
    options: str = "positions"


def text_fields(mapping: Mapping, settings: AnalysisSettings) -> dict[str, TextField]:
    out: dict[str, TextField] = {}

    def add(f: Field, path: str, column: str) -> None:
        if f.type in TEXT_TYPES and f.index is not False and f.enabled is not False:
            index_side = settings.get_analyzer(f.analyzer or "standard")
            if f.position_increment_gap is not None:
                index_side = Analyzer(index_side.tokenizer, index_side.char_filters, index_side.filters, f.position_increment_gap)
            search_side = settings.get_analyzer(f.search_analyzer) if f.search_analyzer else index_side
            quote_side = settings.get_analyzer(f.search_quote_analyzer) if f.search_quote_analyzer else search_side
            common = dict(boost=f.boost or 1.0, norms=f.norms is not False, similarity=f.similarity or "BM25", options=f.index_options or "positions")
            out[path] = TextField(path, column, index_side, search_side, quote_side, **common)
            if f.type == "search_as_you_type":
                for size in range(2, (f.max_shingle_size or 3) + 1):
                    grams = Analyzer(index_side.tokenizer, index_side.char_filters, index_side.filters + (Shingle(size, size, False),))
                    out[f"{path}._{size}gram"] = TextField(f"{path}._{size}gram", column, grams, grams, grams, **common)
        for child in f.properties:
            if f.type == "object":
                add(child, f"{path}.{child.name}", f"{column}.{child.name}")
        for child in f.fields:
            add(child, f"{path}.{child.name}", column)

    for f in mapping.fields:
        add(f, f.name, f.name)
    return out


def forward_table(docs: DataFrame, fields: dict[str, TextField]) -> DataFrame:
    """Analyze all text fields of a document in one pass over its row (no shuffle)."""
    if not fields:
        return docs.sparkSession.createDataFrame([], SCHEMAS["forward"])

    def one(f: TextField) -> Column:
        value = F.col(f.column)
        several = isinstance(_type_at(docs.schema, f.column), T.ArrayType)
        tokens = f.analyzer.values(value) if several else f.analyzer.array(value)
        cut = lambda ts: P.terms_of(ts, positions=f.options in ("positions", "offsets"), freqs=f.options != "docs")
        entry = lambda length, terms: F.struct(length.alias("dl"), terms.alias("terms"))
        # the text is analyzed once for both; without frequencies the length is not in the terms
        if f.options == "docs":
            found = let(tokens, lambda ts: entry(F.size(ts).cast("bigint"), cut(ts)))
        else:
            found = let(cut(tokens), lambda terms: entry(F.aggregate(terms, F.lit(0).cast("bigint"), lambda acc, t: acc + t["tf"]), terms))
        return F.struct(F.lit(f.name).alias("field"), F.when(value.isNotNull(), found).alias("found"))

    analyzed = docs.select("_id", F.explode(F.array(*[one(f) for f in fields.values()])).alias("f"))
    return analyzed.select("f.field", "_id", "f.found.dl", "f.found.terms").where(F.col("terms").isNotNull())


def _type_at(schema: T.StructType, path: str) -> T.DataType:
    found: T.DataType = schema
    for part in path.split("."):
        found = found[part].dataType
    return found


class Draft:
    """The tables of a version that is not published: folders that no reader knows."""

    def __init__(self, spark: SparkSession, path: str, version: int):
        self.spark, self.path, self.version, self.name = spark, path.rstrip("/"), version, f"w{uuid.uuid4().hex}"
        self.tables: list[str] = []

    def write(self, rows: DataFrame, table: str, *partitions: str, ids: bool = False) -> DataFrame:
        """Write a table and read it back; ``ids`` adds a bloom filter on ``_id``."""
        where = self.place(table)
        writer = rows.write.mode("errorifexists")
        if ids:
            # sized for the ids of one row group
            writer = writer.option("parquet.bloom.filter.enabled#_id", "true").option("parquet.bloom.filter.expected.ndv#_id", "100000")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(where)
        self.tables.append(table)
        return self.spark.read.schema(rows.schema).parquet(where)

    def place(self, table: str) -> str:
        return f"{self.path}/{table}/v={self.version}/w={self.name}"

    def docs(self, docs: DataFrame, sort: list) -> DataFrame:
        return self.write(sorted_docs(docs, sort), "docs", ids=True)

    def forward(self, rows: DataFrame) -> DataFrame:
        return self.write(rows, "forward", ids=True)

    def postings(self, rows: DataFrame) -> None:
        # rebalance: adaptive execution splits the bucket of a very common term and merges small ones
        dealt = rows.hint("rebalance", "field", "term_bucket").sortWithinPartitions("field", "term_bucket", "token")
        self.write(dealt, "postings", "field", "term_bucket")

    def vocabulary(self, rows: DataFrame) -> None:
        """Sorted by term over all files of a field, so that a term or a prefix is in few row groups."""
        rows = rows.select("token", "df", "ttf", "term_bucket", "field")
        self.write(rows.repartitionByRange("field", "token").sortWithinPartitions("field", "token"), "vocabulary", "field")

    def spellings(self, terms: DataFrame, buckets: int) -> None:
        """The terms ``(field, token)`` under the keys of their pieces."""
        rows = terms.select("field", "token", F.explode(spelling_keys(F.col("token"))).alias("key")).withColumn("key_bucket", key_bucket(F.col("key"), buckets))
        dealt = rows.select("key", "token", "field", "key_bucket").hint("rebalance", "field", "key_bucket").sortWithinPartitions("field", "key_bucket", "key")
        self.write(dealt, "spellings", "field", "key_bucket")

    def folders(self) -> dict[str, list]:
        return {t: [[self.version, self.name]] for t in self.tables}


@dataclass
class Pending:
    """A version whose tables are written and which nobody sees before ``publish``."""

    spark: SparkSession
    path: str
    version: int
    meta: dict

    def publish(self) -> Collection:
        versions.publish(self.spark, self.path, self.version, self.meta)
        return Collection(self.spark, self.path, self.meta, self.version)


class Collection:
    def __init__(self, spark: SparkSession, path: str, meta: dict, version: int):
        self.spark, self.path, self.meta, self.version = spark, path.rstrip("/"), meta, version
        self.mapping = Mapping.from_json(meta["mapping"])
        self.settings = AnalysisSettings.from_json(meta["settings"])
        self.buckets: int = meta["buckets"]
        self.sort: list[tuple[str, str]] = [tuple(s) for s in meta["sort"]]
        self.base: int = meta["base"]
        #: Fields that were analyzed again, and the version from which on their rows count.
        self.since: dict[str, int] = meta["since"]
        self.text = text_fields(self.mapping, self.settings)
        self.schema_on_read: T.StructType = T.StructType.fromJson(json.loads(meta["schema"]))
        # a version never changes, so its files are listed once
        self._read: dict[str, DataFrame] = {}
        # one row per field of the mapping: a bounded read
        totals = self._current(self._parts("field_stats")).groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        self.stats = {r["field"]: FieldStats(r["n_docs"], r["n_tokens"]) for r in totals.collect() if r["n_docs"]}

    # --- opening and creating

    @staticmethod
    def open(spark: SparkSession, path: str) -> Collection:
        version = versions.newest(spark, path)
        if version is None:
            raise ValueError(f"no collection at {path}")
        return Collection(spark, path, versions.read(spark, path, version), version)

    @staticmethod
    def create(
        spark: SparkSession, path: str, docs: DataFrame, mapping: Mapping, settings: AnalysisSettings | None = None,
        sort: list[tuple[str, str]] = (), buckets: int = 64,
    ) -> Collection:
        """Write ``docs`` (a string ``_id`` and the mapped columns) and build its index tables."""
        settings = settings or AnalysisSettings()
        if not path.strip("/"):
            raise ValueError(f"path={path!r} names no folder for the collection")
        if exists(spark, path):
            raise versions.VersionExists(f"a collection exists at {path}")
        mapping.validate(settings)
        draft = Draft(spark, path, 1)
        stored = draft.docs(docs, list(sort))
        _index(draft, draft.forward(forward_table(spread(stored), text_fields(mapping, settings))), buckets)
        meta = {
            "mapping": mapping.to_json(), "settings": settings.to_json(), "buckets": buckets, "sort": list(sort), "base": 1, "since": {}, "order": None, "batches": {}, "spelled": [],
            "schema": docs.schema.json(), "parts": draft.folders(),
        }
        return Pending(spark, path, 1, meta).publish()

    @staticmethod
    def create_or_evolve(
        spark: SparkSession, path: str, docs: DataFrame, mapping: Mapping, settings: AnalysisSettings | None = None, **options
    ) -> Collection:
        """Open the collection and evolve its mapping, or create it from ``docs`` where there is none.

        An existing collection keeps its documents; ``docs`` is not written to it.
        """
        if not exists(spark, path):
            return Collection.create(spark, path, docs, mapping, settings, **options)
        found = Collection.open(spark, path)
        return found.put_mapping(mapping, settings)

    def _schema(self, table: str) -> T.StructType:
        if table == "docs":
            return self.schema_on_read
        if table == "marks":
            return T.StructType([T.StructField("_id", T.StringType()), T.StructField("mark", self._order())])
        return T.StructType.fromDDL(SCHEMAS[table])

    def _parts(self, table: str) -> DataFrame:
        """All rows of a table in the folders of this version, with the version ``v`` that wrote them."""
        if table not in self._read:
            schema = T.StructType([*self._schema(table).fields, T.StructField("v", T.IntegerType()), T.StructField("w", T.StringType())])
            folders = [f"{self.path}/{table}/v={v}/w={w}" for v, w in self.meta["parts"].get(table, [])]
            if folders:
                rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*folders)
            else:
                rows = self.spark.createDataFrame([], schema)
            self._read[table] = rows.drop("w")
        return self._read[table]

    def _current(self, rows: DataFrame) -> DataFrame:
        """Rows by field without those from before their field was analyzed again."""
        old = [(F.col("field") == f) & (F.col("v") < v) for f, v in self.since.items()]
        return rows.where(~reduce(lambda a, b: a | b, old)) if old else rows

    def _live(self, rows: DataFrame) -> DataFrame:
        """Rows of documents that no later version replaced or deleted."""
        if not self.meta["parts"].get("gone"):
            return rows.drop("v")
        gone = self._parts("gone").groupBy(F.col("_id").alias("_gone")).agg(F.max("v").alias("_at"))
        return rows.join(gone, (F.col("_id") == F.col("_gone")) & (F.col("v") < F.col("_at")), "left_anti").drop("v")

    # --- reading

    @property
    def docs(self) -> DataFrame:
        return self._live(self._parts("docs"))

    @property
    def forward(self) -> DataFrame:
        return self._live(self._current(self._parts("forward")))

    def _of_field(self, table: str, field: str) -> DataFrame:
        rows = self._parts(table).where(F.col("field") == field)
        return rows.where(F.col("v") >= self.since[field]) if field in self.since else rows

    def postings(self, field: str, tokens: list[str] | None = None) -> DataFrame:
        """Postings of a field; literal tokens prune the scan to their buckets."""
        rows = self._of_field("postings", field)
        if tokens is not None:
            buckets = sorted({P.bucket_of(t, self.buckets) for t in tokens})
            rows = rows.where(F.col("term_bucket").isin(buckets) & one_of("token", tokens))
        return self._live(rows)

    def prefix_postings(self, field: str, prefix: str) -> DataFrame:
        """Postings of all terms that begin with ``prefix``.

        The terms are looked up in the sorted vocabulary first, and name the postings to read. A prefix
        of more than ``MAX_TERMS`` terms reads the buckets of its terms, whose files are sorted by term.
        """
        terms = self.vocabulary(field, prefix=prefix)
        few = [r["token"] for r in terms.select("token").limit(MAX_TERMS + 1).collect()]
        if len(few) <= MAX_TERMS:
            return self.postings(field, few)
        buckets = sorted(r["term_bucket"] for r in terms.select("term_bucket").distinct().collect())  # a fixed number of buckets
        return self._live(self._of_field("postings", field).where(F.col("term_bucket").isin(buckets) & F.col("token").startswith(prefix)))

    def vocabulary(self, field: str, tokens: list[str] | None = None, prefix: str | None = None) -> DataFrame:
        """Terms of a field with their frequencies; tokens and a prefix are pushed into the scan."""
        rows = self._of_field("vocabulary", field)
        if tokens is not None:
            rows = rows.where(one_of("token", tokens))
        if prefix is not None:
            rows = rows.where(F.col("token").startswith(prefix))
        if sum(v >= self.since.get(field, 0) for v, _ in self.meta["parts"]["vocabulary"]) == 1:
            return rows.select("token", "df", "ttf", "field", "term_bucket")
        # later versions hold differences
        total = rows.groupBy("token", "field", "term_bucket").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))
        return total.where("df > 0").select("token", "df", "ttf", "field", "term_bucket")

    def spellings(self, field: str) -> DataFrame | None:
        """``key, token`` of a field with stored spellings; a term may stand there that no document has any more."""
        return self._of_field("spellings", field).select("key", "token", "key_bucket") if field in self.meta["spelled"] else None

    def near_terms(self, field: str, words: list[tuple[str, int]]) -> list[str] | None:
        """The terms within some edits (at most 2) of some words, from the buckets of their keys alone.

        None where spellings are not stored, or where the terms are too many to be named.
        """
        rows = self.spellings(field)
        if rows is None or any(e > MAX_EDITS for _, e in words):
            return None
        keys = sorted({k for w, e in words for k in lookup_keys(w, e)})
        buckets = sorted({bucket_of_key(k, self.buckets) for k in keys})
        near = reduce(lambda a, b: a | b, [F.levenshtein(F.lit(w), F.col("token"), e) >= 0 for w, e in words])
        found = rows.where(F.col("key_bucket").isin(buckets) & one_of("key", keys) & near).select("token").distinct().limit(MAX_TERMS + 1).collect()
        return [r["token"] for r in found] if len(found) <= MAX_TERMS else None

    def get(self, _id: str) -> DataFrame:
        return self.docs.where(F.col("_id") == _id)

    def get_many(self, ids: DataFrame) -> DataFrame:
        return self.docs.join(ids.select("_id"), "_id", "left_semi")

    def fetch(self, ids: list[str]) -> DataFrame:
        """The documents of a page of ids; the ids reach the scan, which skips row groups without them."""
        return self.docs.where(one_of("_id", ids))

    def describe(self) -> DataFrame:
        return self.mapping.describe(self.spark, self.path.rsplit("/", 1)[-1])

    # --- writing: every change is a new version

    def put(self, batch: DataFrame, order: list[str] = (), source: str | None = None, number: int | None = None) -> Collection:
        """Replace or add documents by ``_id``; the last of a batch in ``order`` wins.

        Without an order the batch may hold an id once only, and an id may never be missing. With an
        order a row that is not after the last ordered write of its id is left out, whenever that was; a
        write without an order always counts, and forgets the order of its ids. ``source`` and
        ``number`` name a batch of a feed: one that was already put is not put again. Only the batch is
        analyzed and written; of the replaced documents only their terms are looked up.
        """
        pending = self.prepare_put(batch, order, source, number)
        return pending.publish() if pending else self

    def prepare_put(self, batch: DataFrame, order: list[str] = (), source: str | None = None, number: int | None = None) -> Pending | None:
        """All of a put but its publication; None where nothing changes."""
        batches = self.meta["batches"]
        if source is not None:
            if number <= batches.get(source, -1):
                return None
            batches = {**batches, source: number}
        # documents and their terms must come from the same row, so the choice is written down first
        latest = materialize(required(last_per_id(batch, list(order))), "batch")
        if not order:
            return self._change(align(latest, self.mapping), latest.select("_id"), batches=batches)
        kept, marks = self._in_order(latest, list(order))
        if kept.isEmpty():
            return Pending(self.spark, self.path, self.version + 1, {**self.meta, "batches": batches}) if source is not None else None
        return self._change(align(kept, self.mapping), kept.select("_id"), marks, batches)

    def delete(self, ids: DataFrame, order: list[str] = ()) -> Collection:
        """Delete by ``_id``. With an order a deletion counts like an ordered write: only after the last one."""
        if not order:
            return self._change(None, materialize(ids.select("_id").distinct(), "deleted")).publish()
        kept, marks = self._in_order(materialize(required(last_per_id(ids.select("_id", *order), list(order))), "deleted"), list(order))
        return self if kept.isEmpty() else self._change(None, kept.select("_id"), marks).publish()

    def _order(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.meta["order"]))

    def _in_order(self, latest: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
        """The rows that come after the last ordered write of their id, and their new marks."""
        if self.meta["order"] is None:
            rank = F.struct(*order)
        else:
            known = self._order()
            if known.names != order:
                raise ValueError(f"order={order}; earlier writes were ordered by {known.names}")
            rank = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in known.fields])
            stored = self._of_ids(self._live(self._parts("marks")), latest)
            seen, mark = unused("_seen", latest), unused("_mark", latest)
            stored = stored.select(F.col("_id").alias(seen), F.col("mark").alias(mark))
            joined = latest.join(stored, F.col("_id") == F.col(seen), "left").where(F.col(mark).isNull() | (rank > F.col(mark)))
            latest = materialize(joined.select(*latest.columns), "newer")
        return latest, latest.select("_id", rank.alias("mark"))

    def _of_ids(self, rows: DataFrame, ids: DataFrame) -> DataFrame:
        """The rows of some ids. A short list of ids reaches the scan and prunes it, a long one is joined."""
        few = [r["_id"] for r in ids.select("_id").limit(MAX_TERMS + 1).collect()]
        return rows.where(one_of("_id", few)) if len(few) <= MAX_TERMS else rows.join(ids.select("_id"), "_id", "left_semi")

    def _change(self, added: DataFrame | None, gone: DataFrame, marks: DataFrame | None = None, batches: dict | None = None) -> Pending:
        """Write the next version: documents to add, and ids that no longer count before it."""
        draft = Draft(self.spark, self.path, self.version + 1)
        old = self._of_ids(self.forward, gone)
        words = P.vocabulary(old, self.buckets).withColumns({c: -F.col(c) for c in ("df", "ttf")})
        totals = P.field_stats(old).withColumns({c: -F.col(c) for c in ("n_docs", "n_tokens")})
        schema = self.schema_on_read
        if added is not None:
            schema = T.StructType([*schema.fields, *(f for f in added.schema.fields if f.name not in schema.names)])
            new = draft.forward(forward_table(draft.docs(added, self.sort), self.text))
            draft.postings(P.postings(new, self.buckets))
            words, totals = words.unionByName(P.vocabulary(new, self.buckets)), totals.unionByName(P.field_stats(new))
            if self.meta["spelled"]:
                draft.spellings(P.vocabulary(new, self.buckets).where(F.col("field").isin(self.meta["spelled"])), self.buckets)
        change = words.groupBy("field", "token", "term_bucket").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))
        draft.vocabulary(change.where("df <> 0 OR ttf <> 0"))
        draft.write(totals.coalesce(1), "field_stats")
        draft.write(gone, "gone")
        changes = {"schema": schema.json(), "batches": self.meta["batches"] if batches is None else batches}
        if marks is not None:
            draft.write(marks, "marks", ids=True)
            changes["order"] = self.meta["order"] or marks.schema["mark"].dataType.json()
        return self._next(draft, **changes)

    def _next(self, draft: Draft, **changes) -> Pending:
        """The next version: this one's folders, then those of the draft."""
        parts = {t: [*self.meta["parts"].get(t, []), *draft.folders().get(t, [])] for t in {**self.meta["parts"], **draft.folders()}}
        return Pending(self.spark, self.path, draft.version, {**self.meta, "parts": parts, **changes})

    def compact(self) -> Collection:
        """Write the current state as a new base, so that readers no longer merge versions."""
        draft = Draft(self.spark, self.path, self.version + 1)
        draft.docs(self.docs, self.sort)
        _index(draft, draft.forward(self.forward.repartitionByRange("_id").sortWithinPartitions("_id")), self.buckets)
        if self.meta["spelled"]:
            draft.spellings(reduce(DataFrame.unionByName, [self.vocabulary(f).select("field", "token") for f in self.meta["spelled"]]), self.buckets)
        if self.meta["order"] is not None:
            draft.write(self._live(self._parts("marks")), "marks", ids=True)
        meta = {**self.meta, "base": draft.version, "since": {}, "parts": draft.folders()}
        return Pending(self.spark, self.path, draft.version, meta).publish()

    def update(self, where: Column, assignments: dict[str, str], params: dict | None = None) -> Collection:
        """Scripted update of the documents that match ``where``; only they are analyzed again."""
        return self.put(scripted_update(self.docs.where(where), F.lit(True), assignments, params))

    def put_mapping(self, new: Mapping, settings: AnalysisSettings | None = None) -> Collection:
        """Evolve the mapping; only fields whose index-side analysis changed are analyzed and written again.

        Documents are written again only where a new multi-field needs a column of its own. A new
        field without values is part of the schema alone.
        """
        settings = settings or self.settings
        merged, changed = evolve(self.mapping, new, settings)
        if not changed and merged.dynamic == self.mapping.dynamic and settings == self.settings:
            return self
        draft = Draft(self.spark, self.path, self.version + 1)
        aligned = align(self.docs, merged)
        docs = with_multi_fields(aligned, merged, settings)
        changes = {"mapping": merged.to_json(), "settings": settings.to_json(), "schema": docs.schema.json()}
        after = text_fields(merged, settings)
        redo = {n: f for n, f in after.items() if n not in self.text or self.text[n].analyzer != f.analyzer or self.text[n].options != f.options}
        if redo:
            _index(draft, draft.forward(forward_table(docs, redo)), self.buckets)
            changes["since"] = {**self.since, **dict.fromkeys(redo, draft.version)}
            again = [f for f in self.meta["spelled"] if f in redo]
            if again:
                words = P.vocabulary(self.spark.read.schema(SCHEMAS["forward"]).parquet(draft.place("forward")), self.buckets)
                draft.spellings(words.where(F.col("field").isin(again)), self.buckets)
        if docs.columns != aligned.columns:
            draft.docs(docs, self.sort)
        pending = self._next(draft, **changes)
        if "docs" in draft.tables:
            # all live documents stand in the new folder
            pending.meta["parts"]["docs"] = draft.folders()["docs"]
        return pending.publish()

    def store_spellings(self, *fields: str) -> Collection:
        """Store the spellings of some fields' terms; later changes add those of their documents."""
        new = [f for f in fields if f not in self.meta["spelled"]]
        if not new:
            return self
        draft = Draft(self.spark, self.path, self.version + 1)
        draft.spellings(reduce(DataFrame.unionByName, [self.vocabulary(f).select("field", "token") for f in new]), self.buckets)
        return self._next(draft, spelled=[*self.meta["spelled"], *new]).publish()

    def put_settings(self, settings: AnalysisSettings) -> Collection:
        return self.put_mapping(self.mapping, settings)


def bulk_put(targets: dict[str, Collection], batch: DataFrame, order: list[str] = ()) -> dict[str, Collection]:
    """Put each row of a batch into the collection that its ``_index`` names, and give back the new ones.

    A row for a collection that is not among the targets, or without a name, is an error at run time.
    The versions of all targets are written before the first one is published, so a job that fails
    leaves all targets as they were. Publication itself is one small file per target.
    """
    names = sorted(targets)
    known = F.coalesce(F.col("_index").isin(names), F.lit(False))
    checked = batch.withColumn("_index", F.when(known, F.col("_index")).otherwise(F.raise_error(F.concat(F.lit("no collection for "), F.to_json(F.struct("_index", "_id")))).cast("string")))
    rows = materialize(checked, "bulk")
    ready = {name: targets[name].prepare_put(rows.where(F.col("_index") == name).drop("_index"), order) for name in names}
    for p in filter(None, ready.values()):
        if (versions.newest(p.spark, p.path) or 0) >= p.version:
            raise versions.VersionExists(f"version {p.version} of {p.path} exists; no target was changed")
    return {name: p.publish() if p else targets[name] for name, p in ready.items()}


def _index(draft: Draft, forward: DataFrame, buckets: int) -> None:
    """Postings, vocabulary and totals of a whole forward table."""
    draft.postings(P.postings(forward, buckets))
    draft.vocabulary(P.vocabulary(forward, buckets))
    draft.write(P.field_stats(forward).coalesce(1), "field_stats")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a collection with a published version."""
    return versions.newest(spark, path) is not None


def one_of(column: str, values: list[str]) -> Column:
    """``column IN (values)`` as one expression; a long list of literals is slow to build one by one."""
    if not values:
        return F.lit(False)
    # as bytes, so that no character of a value needs care
    return F.expr(f"{column} IN ({', '.join(f"CAST(X'{v.encode().hex()}' AS STRING)" for v in sorted(set(values)))})")


def unused(name: str, df: DataFrame) -> str:
    """A column name that the frame does not have."""
    while name in df.columns:
        name += "_"
    return name


def sorted_docs(docs: DataFrame, sort: list[tuple[str, str]]) -> DataFrame:
    """Range-partition and sort by the index sort, or else by id, so that row groups can be skipped."""
    sort = sort or [("_id", "asc")]
    keys = [F.col(f).asc_nulls_last() if o == "asc" else F.col(f).desc_nulls_last() for f, o in sort]
    return docs.repartitionByRange(*keys).sortWithinPartitions(*keys)


def last_per_id(batch: DataFrame, order: list[str], keys: tuple[str, ...] = ("_id",)) -> DataFrame:
    """One row per key, the greatest in ``order``; combined before the shuffle, so a hot key is cheap."""
    others = [c for c in batch.columns if c not in keys]
    if not order:
        # nothing tells which of several rows is the last one
        rows = batch.groupBy(*keys).agg(F.first(F.struct(*others)).alias("row"), F.count(F.lit(1)).alias("n"))
        message = F.concat(F.lit("several rows for "), F.to_json(F.struct(*keys)), F.lit(", and no order to choose by"))
        row = F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(message).cast(rows.schema["row"].dataType))
        return rows.select(*keys, row.alias("row")).select(*keys, "row.*").select(*batch.columns)
    rank = F.struct(*[F.col(c) for c in order])
    newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("row"))
    return newest.select(*keys, "row.*").select(*batch.columns)


def required(rows: DataFrame, keys: tuple[str, ...] = ("_id",)) -> DataFrame:
    """The same rows; a missing key is an error at run time."""
    return rows.withColumns({k: F.coalesce(k, F.raise_error(F.lit(f"{k} is required")).cast(rows.schema[k].dataType)) for k in keys})


def upsert(docs: DataFrame, latest: DataFrame, keys: tuple[str, ...] = ("_id",)) -> DataFrame:
    """Full replacement by key; a missing key is an error at run time."""
    latest = required(latest, keys)
    return docs.join(latest.select(*keys), list(keys), "left_anti").unionByName(latest, allowMissingColumns=True)


def scripted_update(docs: DataFrame, where: Column, assignments: dict[str, str], params: dict | None = None) -> DataFrame:
    """SQL expressions per column on the matching rows; ``params.name`` are literals."""
    given = F.struct(*[F.lit(v).alias(k) for k, v in (params or {"none": 0}).items()])
    schema = {f.name: f.dataType for f in docs.schema.fields}
    changed = docs.withColumn("params", given).select(
        *[
            (F.when(where, F.expr(assignments[c]).cast(schema[c])).otherwise(F.col(c)) if c in assignments else F.col(c)).alias(c)
            for c in docs.columns
        ]
    )
    return changed


def with_multi_fields(docs: DataFrame, mapping: Mapping, settings: AnalysisSettings) -> DataFrame:
    """The documents with a column for every multi-field that is not text and has none yet."""
    new = {
        f"{f.name}__{sub.name}": searchable(sub, typed(sub, F.col(f.name), docs.schema[f.name].dataType), settings)
        for f in mapping.fields
        for sub in f.fields
        if sub.type not in TEXT_TYPES and f.name in docs.columns and f"{f.name}__{sub.name}" not in docs.columns
    }
    return docs.withColumns(new) if new else docs


def align(docs: DataFrame, mapping: Mapping) -> DataFrame:
    """The documents with every mapped column, new ones as NULL."""
    have = set(docs.columns)
    new = [F.lit(None).cast(f.dataType).alias(f.name) for f in mapping.schema().fields if f.name not in have]
    return docs.select(*docs.columns, *new) if new else docs
