"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

1. Each document becomes its set of word n-grams. Documents with equal sets form one class; all later
   steps work on classes, so copies are never paired.
2. A class has one label per tree: ``DEPTH`` min-hashes in a row. Sorting a tree's labels lays its
   prefix trie out as a list, in which the longest matches stand next to each other. Long matches are
   taken as they are. Shorter prefixes are looked at only down to the length at which the trees
   together find a pair of the least similarity with the target recall, and a pair that matches on a
   short prefix must also agree in its sketch. Where more than ``NEAR`` classes share a short prefix,
   they are all linked instead. Only components count later on, so a batch of the list gives out one
   chain per component of its matches, which has fewer links than classes.
3. The matches' connected components are cut into blocks of bounded size, and every pair of blocks of
   a component is compared exactly by its n-grams inside one task. A task gives out one row per class:
   the number of its links and its root among them, never the pairs.
4. The verified links' components are the result's classes.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.llm.catalog import id_and_text, register, table
from textloom.llm.components import components
from textloom.llm.text import Words, chunks, shingles, slices, texts_of
from textloom.session import materialize

WIDTH = 5
SIMILARITY = 0.8
RECALL = 0.9995
TREES, DEPTH = 16, 8
#: Prefixes of this length match without a look at the sketch.
FIRM = 6
#: Min-hashes of each tree that are part of the sketch, one byte each.
SKETCHED = 4
#: Standard deviations by which a sketch may fall short of the similarity.
SLACK = 4.0
#: Neighbours in a tree's list that are compared on a short prefix. A longer stretch of one such prefix
#: is linked as a whole, so that no pair in it depends on its distance.
NEAR = 16
#: Rows of partition ends that one task joins.
ENDS = 100_000
#: Classes and n-grams of one block.
BLOCK_CLASSES = 512
BLOCK_GRAMS = 1 << 19

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def prefix_length(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """The longest prefix by which the trees find a pair of that similarity with that probability."""
    fit = [d for d in range(1, DEPTH + 1) if 1 - (1 - similarity**d) ** TREES >= recall]
    if not fit:
        raise ValueError(f"{TREES} trees cannot reach a recall of {recall}")
    return max(fit)


def _gram_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, and the first of each with the total at the end."""
    grams, firsts = shingles(Words(texts), width)
    owner = np.repeat(np.arange(len(texts)), np.diff(firsts))
    order = np.lexsort((grams, owner))
    g, o = grams[order], owner[order]
    fresh = np.ones(len(g), bool)
    if len(g) > 1:
        fresh[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
    g, o = g[fresh], o[fresh]
    return g, np.searchsorted(o, np.arange(len(texts) + 1))


def _key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def min_hashes(grams: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """One row per set: its ``TREES * DEPTH`` min-hashes (upper 32 bits); zeros for an empty set."""
    out = np.zeros((len(firsts) - 1, TREES * DEPTH), np.uint32)
    filled = np.flatnonzero(np.diff(firsts) > 0)
    if len(filled):
        for k in range(TREES * DEPTH):
            out[filled, k] = np.minimum.reduceat((grams ^ _MASKS[k]) * _FACTORS[k], firsts[filled]) >> np.uint64(32)
    return out


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, mark, key, grams, labels, sketch`` of ``doc_id, text, mark``; ``key`` is null without words."""

    def sign(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            for lo, hi in chunks(texts):
                g, firsts = _gram_sets(texts[lo:hi], width)
                sizes = np.diff(firsts)
                mins = min_hashes(g, firsts).reshape(-1, TREES, DEPTH)
                labels = (mins >> np.uint32(16)).astype(">u2")  # big-endian, so that bytes sort as the numbers do
                sketch = (mins[:, :, :SKETCHED] & np.uint32(0xFF)).astype(np.uint8).reshape(len(sizes), -1)
                keys = [_key(g[a:b]) if b > a else None for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                columns = [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array([x.tobytes() for x in labels], pa.binary()), pa.array([x.tobytes() for x in sketch], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(2)[lo:hi], *columns], names=["doc_id", "mark", "key", "grams", "labels", "sketch"])

    return docs.mapInArrow(sign, "doc_id bigint, mark bigint, key binary, grams bigint, labels binary, sketch binary")


def _matches(ids: np.ndarray, labels: np.ndarray, sketch: np.ndarray, depth: int, least: float) -> np.ndarray:
    """Links among sorted rows of one or several trees (the first byte of a label is its tree).

    Any two rows with a common prefix of ``depth`` are either compared by their sketches or linked
    through all rows between them.
    """
    found = []
    for gap in range(1, min(NEAR, len(ids) - 1) + 1):
        same = labels[gap:] == labels[:-gap]
        shared = np.where(same.all(1), labels.shape[1], same.argmin(1)) - 1  # bytes after the tree
        ok = shared >= 2 * depth
        if not ok.any():
            break  # rows further apart share no more
        at = np.flatnonzero(ok)
        if gap == NEAR:  # a long stretch: each window of it is linked from row to row
            steps = np.unique((at[:, None] + np.arange(NEAR)).ravel())
            found.append(np.stack((ids[steps], ids[steps + 1]), 1))
        firm = (shared[at] >= 2 * FIRM) if gap == 1 else np.zeros(len(at), bool)
        agree = (sketch[at] == sketch[at + gap]).mean(1)
        at = at[firm | (agree >= least)]
        found.append(np.stack((ids[at], ids[at + gap]), 1))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def _chains(links: np.ndarray) -> np.ndarray:
    """Links with the components of the given ones: each member with the next larger one, so fewer than members."""
    nodes, ends = np.unique(links, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while (apart := root[a] != root[b]).any():
        x, y = root[a[apart]], root[b[apart]]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    order = np.argsort(root, kind="stable")
    same = np.flatnonzero(root[order[1:]] == root[order[:-1]])
    return np.stack((nodes[order[same]], nodes[order[same + 1]]), 1)


def _matched(rows: DataFrame, depth: int, least: float) -> DataFrame:
    """Links (kind 0), and the first and last rows of each partition (kind 1), of sorted ``rep, sketch, label``."""
    size, sketch_size = 2 * DEPTH + 1, TREES * SKETCHED

    def match(batches):
        tail, heads = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            labels = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, size)
            sketch = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, sketch_size)
            out = _ends(ids[: NEAR - heads], labels, sketch)
            heads += len(out)
            if tail is not None:
                ids, labels, sketch = (np.concatenate(x) for x in zip(tail, (ids, labels, sketch), strict=True))
            links = _chains(_matches(ids, labels, sketch, depth, least))
            tail = (ids[-NEAR:], labels[-NEAR:], sketch[-NEAR:])
            yield _links_batch(out + [[0, a, None, None, b] for a, b in links.tolist()])
        if tail is not None:
            yield _links_batch(_ends(*tail))

    return rows.mapInArrow(match, "kind int, a bigint, label binary, sketch binary, b bigint")


def candidate_links(classes: DataFrame, similarity: float, recall: float) -> DataFrame:
    """``a, b``: links whose components hold every pair that the forest finds."""
    depth = prefix_length(similarity, recall)
    # what two random bytes share by chance is part of the agreement
    sure = similarity + (1 - similarity) / 256
    least = sure - SLACK * (sure * (1 - sure) / (TREES * SKETCHED)) ** 0.5
    tree = lambda t: F.concat(F.unhex(F.lit(f"{t:02x}")), F.substring("labels", 2 * DEPTH * t + 1, 2 * DEPTH))
    rows = classes.select("rep", "sketch", F.explode(F.array(*(tree(t) for t in range(TREES)))).alias("label"))
    # the representative is the last key, so that a label of very many classes is spread as well
    laid = rows.repartitionByRange("label", "rep").sortWithinPartitions("label", "rep")
    found = materialize(_matched(laid, depth, least), "matches")
    links = found.filter("kind = 0").select("a", "b")
    # the ends of all partitions, in order, are such a list too, only shorter each time
    while True:
        ends = found.filter("kind = 1").select(F.col("a").alias("rep"), "sketch", "label").dropDuplicates(["label", "rep"])
        parts = -(-ends.count() // ENDS) or 1
        laid = (ends.repartitionByRange(parts, "label", "rep") if parts > 1 else ends.coalesce(1)).sortWithinPartitions("label", "rep")
        found = materialize(_matched(laid, depth, least), "end-matches")
        links = links.unionByName(found.filter("kind = 0").select("a", "b"))
        if parts == 1:
            return links


def _ends(ids: np.ndarray, labels: np.ndarray, sketch: np.ndarray) -> list[list]:
    return [[1, int(i), label.tobytes(), part.tobytes(), None] for i, label, part in zip(ids, labels, sketch, strict=False)]


def _links_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["kind", "a", "label", "sketch", "b"])


def _common(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Numbers of n-grams that each left set shares with each right set (or left with left)."""
    sets = left + (right or [])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    v, o = values[order], owner[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = v[1:] != v[:-1]
    number = np.cumsum(fresh) - 1
    shared = np.bincount(number) > 1
    keep = shared[number]
    number, o = (np.cumsum(shared) - 1)[number[keep]], o[keep]
    out = np.zeros((len(left), len(right) if right is not None else len(left)), np.float32)
    total = int(shared.sum())
    for start in range(0, total, 4096):
        a, b = np.searchsorted(number, (start, start + 4096))
        grid = np.zeros((len(sets), min(4096, total - start)), np.float32)
        grid[o[a:b], number[a:b] - start] = 1
        out += grid[: len(left)] @ (grid[len(left) :] if right is not None else grid).T
    return out


def _linked(left: list[np.ndarray], right: list[np.ndarray] | None, similarity: Fraction) -> np.ndarray:
    common = np.rint(_common(left, right)).astype(np.int64)
    n, m = (np.array([len(s) for s in x], np.int64) for x in (left, right if right is not None else left))
    out = similarity.denominator * common >= similarity.numerator * (n[:, None] + m[None, :] - common)
    if right is None:
        np.fill_diagonal(out, False)
    return out


def _roots(ids: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Least id that each member reaches over links (a square matrix)."""
    root = ids.copy()
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
        if (new == root).all():
            return root
        root = new


def verify(members: DataFrame, similarity: float) -> DataFrame:
    """``rep, root, links``: partial results of the blocks, from ``task, apart, part, component, rep, copies, set``.

    ``apart`` tells that a task is for two different blocks, either of which may have no class.
    """
    exact = Fraction(str(similarity))

    def compare(table: pa.Table) -> pa.Table:
        reps, copies = (table.column(c).to_numpy() for c in ("rep", "copies"))
        apart, part, component = (table.column(c).to_numpy() for c in ("apart", "part", "component"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        root, links = reps.copy(), np.zeros(len(reps), np.int64)
        order = np.lexsort((reps, part, component))
        cuts = np.flatnonzero(np.diff(component[order])) + 1
        for rows in np.split(order, cuts):
            across = part[rows] == 1  # the second block of a pair of different ones
            a, b = rows[~across], rows[across]
            if apart[rows[0]]:
                if not len(a) or not len(b):
                    continue
                linked = _linked([sets[i] for i in a], [sets[i] for i in b], exact)
                links[a] += linked @ copies[b]
                links[b] += linked.T @ copies[a]
                square = np.zeros((len(rows), len(rows)), bool)
                square[: len(a), len(a) :] = linked
                square[len(a) :, : len(a)] = linked.T
                rows = np.concatenate((a, b))
            else:
                square = _linked([sets[i] for i in a], None, exact)
                links[a] += square @ copies[a]
            root[rows] = _roots(reps[rows], square)
        return pa.table({"rep": reps, "root": root, "links": links})

    return members.groupBy("task").applyInArrow(compare, "rep bigint, root bigint, links bigint")


def jaccard_classes(
    docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, class_id, class_size, n_links``.

    Words are runs of letters and digits in lower case. ``n_links`` counts the other documents whose
    n-gram sets have a Jaccard similarity of ``similarity`` or more; ``class_id`` is the least id that
    links lead to, ``class_size`` the documents of that class. Texts with fewer words than ``width``
    have one n-gram of all their words. Texts without words (null, empty, signs only) have no links
    and are classes of their own, as are rows without an id, whose class is null. A repeated row is a
    copy like others, and rows that share an id are told apart by their texts. Sets are compared by 64-bit hashes of their n-grams.
    """
    return _classified(docs, width, similarity, recall, id_col, text_col).select("doc_id", "class_id", "class_size", "n_links")


def _classified(docs: DataFrame, width: int, similarity: float, recall: float, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``jaccard_classes`` with ``mark``, the hash of the text, and ``kept``, one text of each class."""
    source = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    signed = materialize(signatures(source, width), "signatures")
    known = signed.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    # a class goes by a number of its own, unique as it is written once; ids may repeat with other texts
    classes = materialize(
        known.groupBy("key")
        .agg(
            F.min(F.struct("doc_id", "mark")).alias("least"), F.count(F.lit(1)).alias("copies"), F.first("grams").alias("grams"), F.first("labels").alias("labels"), F.first("sketch").alias("sketch")
        )
        .withColumn("rep", F.monotonically_increasing_id()),
        "gram-classes",
    )
    groups = components(candidate_links(classes, similarity, recall))
    # blocks: as many as a component's classes and n-grams ask for
    grouped = materialize(groups.join(classes.select("rep", "copies", "grams"), groups["node"] == F.col("rep")).select("component", "rep", "copies", "grams"), "grouped")
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("grams").alias("g"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("g") / BLOCK_GRAMS)).cast("int")
    sizes = materialize(sizes.select(F.col("component").alias("_of"), blocks.alias("blocks")), "component-sizes")
    bins = int(-(-(grouped.agg(F.sum("grams")).first()[0] or 0) // BLOCK_GRAMS)) or 1
    dealt = grouped.join(sizes, F.col("component") == F.col("_of")).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    alone = dealt.filter("blocks = 1").select(
        F.concat(F.lit("bin "), F.pmod(F.xxhash64("component"), F.lit(bins))).alias("task"), F.lit(0).alias("apart"), F.lit(0).alias("part"), "component", "rep", "copies"
    )
    paired = dealt.filter("blocks > 1").withColumn("other", other).select(
        F.concat_ws(" ", "component", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
        (F.col("block") != F.col("other")).cast("int").alias("apart"), (F.col("block") > F.col("other")).cast("int").alias("part"), "component", "rep", "copies",
    )
    sets = materialize(_sets_of(source, classes.join(grouped.select("rep"), "rep", "left_semi"), width), "gram-sets")
    members = alone.unionByName(paired).join(sets, "rep").select("task", "apart", "part", "component", "rep", "copies", "set")
    checked = materialize(verify(members, similarity), "verified")
    final = components(checked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("rep").agg(F.sum("links").alias("links")).withColumnRenamed("rep", "_linked")
    own = classes.select("key", "rep", "copies", "least").join(links, F.col("rep") == F.col("_linked"), "left")
    own = own.join(final, F.col("rep") == F.col("node"), "left").select(
        "key", "copies", "least", F.coalesce("component", "rep").alias("group"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    own = materialize(own, "linked")
    totals = own.groupBy("group").agg(F.sum("copies").alias("class_size"), F.min("least").alias("first")).withColumnRenamed("group", "_of")
    facts = materialize(own.join(totals, F.col("group") == F.col("_of")).select(F.col("key").alias("_key"), "first", "class_size", "n_links"), "facts")
    idless = F.col("doc_id").isNull()
    alone = F.col("first").isNull() | idless
    return signed.join(facts, F.col("key") == F.col("_key"), "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        "mark",
        (alone | (F.struct("doc_id", "mark") == F.col("first"))).alias("kept"),
    )


def _sets_of(source: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """``rep, set``: n-gram hashes of the classes that were matched, from the text of their least row."""
    wanted = classes.select("rep", "key", F.col("least.doc_id").alias("_id"), F.col("least.mark").alias("_mark"))
    texts = source.join(wanted, (source["doc_id"] == F.col("_id")) & (source["mark"] == F.col("_mark"))).select("rep", "text", "key")

    def cut(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            for lo, hi in chunks(texts):
                g, firsts = _gram_sets(texts[lo:hi], width)
                sets = [g[a:b] for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                # another text of that id with the same mark is left out
                right = pa.array([_key(x) == k for x, k in zip(sets, batch.column(2)[lo:hi].to_pylist(), strict=True)], pa.bool_())
                whole = pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array([x.tobytes() for x in sets], pa.binary())], names=["rep", "set"])
                yield whole.filter(right)

    return texts.mapInArrow(cut, "rep bigint, set binary").dropDuplicates(["rep"])


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the least id of each class, with all columns; texts without words all stay.

    Repeated rows of the document that stays all stay; of other texts under its id none does.
    """
    rows = _classified(docs, WIDTH, SIMILARITY, RECALL, "doc_id", "text")
    gone = rows.filter("NOT kept").select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_mark")).distinct()
    return docs.join(gone, (docs["doc_id"].cast("bigint") == gone["_gone"]) & (F.xxhash64(docs["text"].cast("string")) == gone["_mark"]), "left_anti")


_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"


@register(
    "op1_ngram_join",
    f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS l FROM documents),
    g AS (SELECT DISTINCT doc_id, array_to_string(l[i : i + 4], ' ') AS s
          FROM (SELECT doc_id, l, unnest(generate_series(1, greatest(len(l) - 4, 1))) AS i FROM w WHERE len(l) > 0) x),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
    e AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 5 * c.c >= 4 * (x.n + y.n - c.c)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    k AS (SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size FROM r GROUP BY a),
    l AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a)
    SELECT k.doc_id, k.class_id, k.class_size, coalesce(l.n_links, 0) AS n_links FROM k LEFT JOIN l ON l.doc_id = k.doc_id""",
)
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))
