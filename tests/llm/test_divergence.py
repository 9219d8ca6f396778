import math
import random
import re
from collections import Counter


from textloom.llm import divergence as D
from tests.llm.conftest import SF_SMALL


def base(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(runs)
    held = {i + j for i, r in enumerate(runs) if count[r] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(words) < 20 or 100 * len(held) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(held), failed


def counted(rows):
    return sorted(map(repr, ((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows)))


def test_base_counts(spark, odd_docs, no_docs):
    rnd = random.Random(8)
    few = "a b c d".split()
    more = [(100 + i, "".join(rnd.choice(few) + rnd.choice(" \n\t") for _ in range(rnd.choice((7, 8, 9, 30, 90))))) for i in range(60)]
    line = "one line of nine words that comes again here"
    more += [(200, "\n".join([line, line, " ", " ", line + "\r", "#*$%&|<>"])), (201, "   x\u0085y 🙂<"), (202, " ".join([line] * 50)), (203, "\x0b\x0c\x1c")]
    docs = odd_docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(i, t, "en") for i, t in more], "doc_id bigint, text string, lang string"))
    got = D.quality_rules(docs).collect()
    assert counted(got) == sorted(repr((r["doc_id"], *base(r["text"]))) for r in docs.collect())
    # without a reference the base rules alone decide
    assert all(r["kept"] == (not r["base_failed"]) and r["class_distance"] is None for r in D.quality_rules(odd_docs).collect())
    assert D.quality_rules(odd_docs).count() == odd_docs.count() and D.quality_rules(no_docs).count() == 0


def distance(p, q):
    a, b = sum(p), sum(q)
    p, q = [x / a for x in p], [x / b for x in q]
    m = [(x + y) / 2 for x, y in zip(p, q)]
    part = lambda v: sum(x * math.log2(x / y) for x, y in zip(v, m) if x > 0)
    return math.sqrt(max(0.0, (part(p) + part(q)) / 2))


def classes(text):
    left, out = re.sub("[\x20\x09-\x0d]", "", text), []
    is_a = [lambda c: "a" <= c <= "z", lambda c: c.isupper(), str.isalpha, str.isnumeric, lambda c: c in ".,;:!?'\"()-", lambda c: c in "#*$%&|<>"]
    solid = len(left)
    for test in is_a:
        rest = "".join(c for c in left if not test(c))
        out.append(len(left) - len(rest))
        left = rest
    return [*out, len(text) - solid, len(left)]


def test_distances_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows += [(10_000 + i, rows[0][1], rows[0][2]) for i in range(100)]  # copies of one text weigh once
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    spoken = {i: re.findall(r"[^\W\d_]+", t.lower()) for i, t, _ in rows}
    want = {}
    for lang in {x for _, _, x in rows}:
        mine = [(i, t) for i, t, x in rows if x == lang]
        words = Counter(w for i, _ in mine for w in spoken[i])
        common = [w for w, n in words.items() if n >= D.COMMON * sum(words.values())]
        bins = {}
        for i, t in mine:
            c = Counter(spoken[i])
            bins[i] = (classes(t), [*(c[w] for w in common), sum(n for w, n in c.items() if w not in common)])
        once = {t: i for i, t in mine}.values()
        refs = [[sum(x) for x in zip(*(bins[i][k] for i in once))] for k in (0, 1)]
        for i, _ in mine:
            want[i] = tuple(distance(bins[i][k], refs[k]) if sum(bins[i][k]) >= guard else None for k, guard in ((0, D.CLASS_GUARD), (1, D.WORD_GUARD)))
    got = {r["doc_id"]: (r["class_distance"], r["word_distance"], r["kept"], r["base_failed"]) for r in D.quality_rules(docs).collect()}
    assert got.keys() == want.keys()
    for i, (c, w, kept, failed) in got.items():
        for have, should in ((c, want[i][0]), (w, want[i][1])):
            assert (have is None) == (should is None) and (have is None or math.isclose(have, should, abs_tol=1e-9)), i
        assert kept == (not failed and (c or 0) <= D.CLASS_LIMIT and (w or 0) <= D.WORD_LIMIT)


def test_other_texts_are_rejected_and_the_plan_is_native(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    fine = spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter("quality = 1")
    good = docs.join(fine, "doc_id", "left_semi").filter("lang = 'en' AND length(text) > 1500").orderBy("doc_id").select("text").first()[0]
    rnd = random.Random(2)
    other = [(-1, " ".join("".join(rnd.choice("ABCDEFGHIJ") for _ in range(7)) for _ in range(300)), "en"), (-2, " ".join("".join(rnd.choice("#$%1234") for _ in range(5)) for _ in range(300)), "en")]
    made = D.quality_rules(docs.unionByName(spark.createDataFrame([*other, (-3, good, "en"), (-4, good, None)], "doc_id bigint, text string, lang string")))
    got = {r["doc_id"]: r for r in made.filter("doc_id < 0").collect()}
    assert not got[-1]["kept"] and not got[-2]["kept"] and got[-3]["kept"] and got[-4]["word_distance"] is None
    counts = D.document_counts(D._source(docs, "doc_id", "text", "lang"), D.common_words(D._source(docs, "doc_id", "text", "lang")))
    for frame in (made, counts, D.language_references(counts)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text and "CartesianProduct" not in text
    assert "Exchange" not in counts.drop("vocabulary")._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
