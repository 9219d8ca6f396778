import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import ngram_join
from textloom.llm.components import components
from textloom.llm.exact_dedup import drop_exact, exact_groups
from textloom.llm.ngram_join import jaccard_classes, keep_one, prefix_length


def exact(rows, keep):
    groups = defaultdict(set)
    for i, t in rows:
        groups[t or ""].add(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        stays = (min if keep == "smallest" else max)(known) if known else None
        out += [(i, stays, len(ids), i == stays, sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(map(str, out))


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(odd_docs, no_docs, keep, weak):
    options = {"hashed": lambda t: F.unhex(F.substring(F.md5(t), 1, 1))} if weak else {}  # nearly everything collides
    got = exact_groups(odd_docs, keep=keep, **options).collect()
    assert sorted(str(tuple(r)) for r in got) == exact([(r["doc_id"], r["text"]) for r in odd_docs.collect()], keep)
    assert exact_groups(no_docs, keep=keep, **options).count() == 0


def test_drop_exact(odd_docs):
    kept = drop_exact(odd_docs, keep="largest")
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["2", "5", "6", "8", "9", "10", "11", "4"])
    with pytest.raises(ValueError):
        exact_groups(odd_docs, keep="any")


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def least_members(nodes, links):
    parent = {n: n for n in nodes}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}


def test_components(spark):
    rnd = random.Random(2)
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(600, 650)] + [(7, 7)]
    links += [(rnd.randrange(90), rnd.randrange(90)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    proper = [(a, b) for a, b in links if a != b]
    assert got == least_members({x for link in proper for x in link}, proper)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_classes(rows, width=5, threshold=(4, 5)):
    import re

    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\W_]+", (t or "").lower())
        sets[i] = {tuple(words[k : k + width]) for k in range(max(len(words) - width + 1, 1))} if words else set()
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and threshold[1] * len(sets[a] & sets[b]) >= threshold[0] * len(sets[a] | sets[b])]
    least = least_members(ids, links)
    size, count = defaultdict(int), defaultdict(int)
    for i in ids:
        size[least[i]] += 1
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {i: (least[i], size[least[i]], count[i]) for i in ids}


def near_copies():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows, n = [], 0
    for size, length in ((90, 140), (12, 60), (3, 300), (2, 30)):
        base = [word() for _ in range(length)]
        for k in range(size):
            copy = list(base)
            for _ in range(rnd.randrange(3)):
                copy[rnd.randrange(length)] = word()
            rows.append((n, " ".join(copy).capitalize() + "." if k % 2 else " ".join(copy)))
            n += 1
    rows += [(n + k, " ".join(word() for _ in range(80))) for k in range(60)]
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_near_copies_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: (r["class_id"], r["class_size"], r["n_links"]) for r in jaccard_classes(docs).collect()}
    assert got == brute_classes(rows)


def test_blocks_without_a_class_add_no_links(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 40)  # more blocks than classes, so that many are empty
    rnd = random.Random(3)
    rows = []
    for k in range(12):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(60)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join([*base, "more"]))]
    got = {r["doc_id"]: (r["class_id"], r["class_size"], r["n_links"]) for r in jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_classes(rows)


def test_rows_that_share_an_id(spark):
    rnd = random.Random(5)
    first, second = ([f"w{rnd.randrange(10**6)}" for _ in range(80)] for _ in range(2))
    rows = [(1, first), (1, second), (2, [*first, "more"]), (3, [*second, "other"]), (3, [*second, "other"]), (4, second[:50])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id bigint, text string").repartition(3)
    got = sorted(tuple(r) for r in jaccard_classes(docs).collect())
    assert got == [(1, 1, 2, 1), (1, 1, 3, 2), (2, 1, 2, 1), (3, 1, 3, 2), (3, 1, 3, 2), (4, 4, 1, 0)]
    assert sorted((r["doc_id"], r["text"]) for r in keep_one(docs).collect()) == sorted((i, " ".join(t)) for i, t in (rows[0], rows[1], rows[5]))


def test_one_text_of_a_class_under_one_id_stays(spark):
    words = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (1, " ".join([*words, "end"])), (1, " ".join([*words, "end"]).upper())], "doc_id bigint, text string")
    assert keep_one(docs).count() == 1
    assert {tuple(r) for r in jaccard_classes(docs).collect()} == {(1, 1, 3, 2)}


def template_family(members, rnd):
    """Texts of which a third of the n-grams is common; one in ten has a close copy."""
    common = [f"t{k}" for k in range(84)]
    rows = []
    for n in range(members):
        own = [f"u{rnd.randrange(10**9)}" for _ in range(76)]
        rows.append((len(rows), common + own))
        if n % 10 == 0:
            near = list(own)
            for _ in range(3):
                near[rnd.randrange(76)] = f"u{rnd.randrange(10**9)}"
            rows.append((len(rows), common + near))
    rnd.shuffle(rows)
    return [(i, " ".join(t)) for i, t in rows]


def test_large_template_family_loses_no_link(spark):
    rows = template_family(3000, random.Random(12))
    grams = {i: {tuple(t.split()[k : k + 5]) for k in range(156)} for i, t in rows}
    holders = defaultdict(list)
    for i, g in grams.items():
        for x in g:
            holders[x].append(i)
    # n-grams of the template alone give 80 / 232, so linked texts share another one
    pairs = {(a, b) for ids in holders.values() if len(ids) < 100 for a in ids for b in ids if a < b}
    links = {p for p in pairs if 5 * len(grams[p[0]] & grams[p[1]]) >= 4 * len(grams[p[0]] | grams[p[1]])}
    assert len(links) > 150
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}
    least = least_members(list(grams), links)
    assert got == {i: (least[i], sum(i in p for p in links)) for i in grams}


@pytest.mark.parametrize("stretch", [40, 900])
def test_every_shared_prefix_is_compared_or_linked(spark, monkeypatch, stretch):
    """Over several partitions and rounds of their ends, with stretches longer than the neighbours compared."""
    monkeypatch.setattr(ngram_join, "ENDS", 100)
    rnd = np.random.default_rng(stretch)
    n = 900
    labels = rnd.integers(0, 1 << 16, (n, ngram_join.TREES, ngram_join.DEPTH)).astype(">u2")
    labels[:, 0, :4] = (np.arange(n) // stretch)[:, None]  # equal in one tree only
    sketch = rnd.integers(0, 256, (n, 64)).astype(np.uint8)
    for a in range(0, n - 37, 37):  # alike, but far from each other in the list
        sketch[a + 36] = sketch[a]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, labels[k].tobytes(), sketch[k].tobytes()) for k in range(n)]
        got = ngram_join.candidate_links(spark.createDataFrame(rows, "rep bigint, labels binary, sketch binary"), 0.8, 0.9995).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    least = least_members(range(n), [(r["a"], r["b"]) for r in got])
    for a in range(n):
        for b in range(a + 1, n):
            if a // stretch == b // stretch and (sketch[a] == sketch[b]).mean() >= 0.8:
                assert least[a] == least[b]
    assert all(a // stretch == b // stretch for a, b in ((r["a"], r["b"]) for r in got))


def test_chains_keep_the_components():
    rnd = random.Random(8)
    for links in ([], [(5, 5)], [(k, k + 1) for k in range(50, 0, -1)], [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] * 2):
        nodes = {x for link in links for x in link}
        chains = ngram_join._chains(np.array(links, np.int64).reshape(-1, 2)).tolist()
        least = least_members(nodes, links)
        assert least_members(nodes, chains) == least
        assert len(chains) == len(nodes) - len(set(least.values()))


def test_links_grow_with_the_members_of_a_family(spark):
    """In batches of any number of trees: one link per class and tree at most, not one per pair of neighbours."""
    rnd = random.Random(21)
    base, rows = [f"w{rnd.randrange(10**6)}" for _ in range(150)], []
    for k in range(400):
        copy = list(base)
        copy[rnd.randrange(150)] = f"own{k}"
        rows.append((k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    classes = ngram_join.signatures(docs.withColumn("mark", F.xxhash64("text"))).select(F.col("doc_id").alias("rep"), "labels", "sketch")
    links = {(r["a"], r["b"]) for r in ngram_join.candidate_links(classes, 0.8, 0.9995).collect()}
    assert set(least_members(range(400), links).values()) == {0}
    assert len(links) <= ngram_join.TREES * len(rows)
    got = {r["doc_id"]: (r["class_id"], r["class_size"], r["n_links"]) for r in jaccard_classes(docs).collect()}
    assert got == brute_classes(rows)
    assert [r["doc_id"] for r in keep_one(docs).collect()] == [0]


def test_odd_documents(odd_docs, no_docs):
    got = sorted((str(r["doc_id"]), str(r["class_id"]), r["class_size"], r["n_links"]) for r in jaccard_classes(odd_docs).collect())
    want = [("1", "1", 2, 1), ("2", "1", 2, 1), ("3", "3", 1, 0), ("4", "4", 1, 0), ("5", "5", 1, 0), ("6", "6", 2, 1), ("6", "6", 2, 1), ("7", "7", 2, 1), ("8", "7", 2, 1),
            ("9", "9", 1, 0), ("10", "10", 1, 0), ("11", "11", 1, 0), ("None", "None", 1, 0), ("None", "None", 1, 0)]
    assert got == sorted(want)
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id IN (2, 8)").count() == 0 and kept.count() == 12
    assert jaccard_classes(no_docs).count() == 0


def test_prefix_length_follows_the_recall():
    assert prefix_length(0.8, 0.9995) == 4 and prefix_length(0.8, 0.9) > prefix_length(0.8, 0.99999)
    with pytest.raises(ValueError):
        prefix_length(0.1, 0.999999)
