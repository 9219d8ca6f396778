import hashlib

import pytest
from pyspark.sql import functions as F

from textloom.operators import analyzers as A, charfilters as C, dictionary as D, fuzzy, tokenfilters as TF, tokenizers as TK
from textloom.operators.postings import bucket_of, term_bucket, terms_of


def tokens(spark, analyzer, text, **options):
    df = spark.createDataFrame([("1", text)], "_id string, text string")
    return [tuple(r)[1:] for r in A.analyze(df, "text", analyzer, **options).collect()]


def words(spark, analyzer, text):
    return [t[0] for t in tokens(spark, analyzer, text)]


def std(*filters):
    return A.Analyzer(TK.Standard(), filters=filters)


@pytest.mark.parametrize(
    "make",
    [
        lambda: TK.CharGroup().words(F.lit("x")),
        lambda: C.CharMapping().table(),
        lambda: std(TF.Elision()).array(F.lit("x")),
        lambda: std(TF.Keep()).array(F.lit("x")),
        lambda: std(TF.KeepTypes()).array(F.lit("x")),
        lambda: std(TF.KeywordMarker()).array(F.lit("x")),
        lambda: std(TF.KeywordMarker(("a",), keywords_pattern="b")).array(F.lit("x")),
        lambda: std(TF.CommonGrams()).array(F.lit("x")),
        lambda: std(TF.Condition("true")).array(F.lit("x")),
        lambda: std(TF.Multiplexer()).array(F.lit("x")),
        lambda: std(TF.Synonym()).array(F.lit("x")),
        lambda: std(TF.Synonym(("a =>",))).array(F.lit("x")),
        lambda: std(TF.StemmerOverride()).array(F.lit("x")),
        lambda: std(TF.Decompound()).array(F.lit("x")),
        lambda: std(TF.Shingle(1, 2)).array(F.lit("x")),
        lambda: std(TF.Phonetic("nysiis")).array(F.lit("x")),
        lambda: A.Analyzer(None),
        lambda: A.Normalizer(),
        lambda: A.language("danish", stem_exclusion=("x",)),
        lambda: A.language("klingon"),
        lambda: A.AnalysisSettings(analyzer={"a": {"type": "custom"}}).get_analyzer("a"),
        lambda: A.AnalysisSettings(normalizer={"n": {"filter": ["shingle"]}}).get_normalizer("n"),
        lambda: TF.Stop("_klingon_").apply(TF.Tokens(F.lit(None))),
    ],
)
def test_guards(spark, make):
    with pytest.raises(ValueError):
        make()


def test_empty_and_null_texts(spark):
    df = spark.createDataFrame([("1", ""), ("2", None), ("3", "a")], "_id string, text string")
    for filters in ((), (TF.Unique(),), (TF.Shingle(),), (TF.Fingerprint(),), (TF.MinHash(1, 4),), (TF.CommonGrams(("a",)),)):
        got = A.analyze(df, "text", std(*filters)).select("_id").distinct().collect()
        assert {r[0] for r in got} == {"3"}
    assert df.select(std().array(F.col("text")).alias("t")).where("t is null").count() == 1


def test_long_token_is_cut_with_offsets(spark):
    got = tokens(spark, std(), "ab " + "x" * 600, offsets=True)
    assert [(len(t[0]), t[1], t[3], t[4]) for t in got] == [(2, 0, 0, 2), (255, 1, 3, 258), (255, 2, 258, 513), (90, 3, 513, 603)]


def test_offsets_of_a_long_text(spark):
    text = "  ".join(f"w{i}" for i in range(500)) + " end"
    for token, _, _, start, end in tokens(spark, std(), text, offsets=True):
        assert text[start:end] == token


def test_shingle_counts(spark):
    text = " ".join(f"w{i}" for i in range(9))
    for n in (2, 3, 4):
        assert len(words(spark, std(TF.Shingle(n, n, False)), text)) == 9 - n + 1
    assert words(spark, std(TF.Shingle(2, 2, False)), "one") == []


def test_payloads_and_graph_lengths(spark):
    assert tokens(spark, A.Analyzer(TK.Whitespace(), filters=(TF.DelimitedPayload(encoding="int"),)), "a|3 b") == [("a", 0, 3), ("b", 1, None)]
    got = tokens(spark, std(TF.SynonymGraph(("new york => ny", "big, large"))), "big new york")
    assert [(t[0], t[1], t[2], t[3]) for t in got] == [
        ("big", 0, "<ALPHANUM>", 1), ("large", 0, "SYNONYM", 1), ("new", 1, "<ALPHANUM>", 1), ("ny", 1, "SYNONYM", 2), ("york", 2, "<ALPHANUM>", 1)
    ]


def test_word_delimiter_options(spark):
    ws = lambda **o: words(spark, A.Analyzer(TK.Whitespace(), filters=(TF.WordDelimiter(**o),)), "PowerShot500-42's")
    assert ws() == ["Power", "Shot", "500", "42"]
    assert ws(split_on_case_change=False) == ["PowerShot", "500", "42"]
    assert ws(split_on_numerics=False, split_on_case_change=False) == ["PowerShot500", "42"]
    assert ws(generate_word_parts=False, generate_number_parts=False, catenate_all=True) == ["PowerShot50042"]
    assert ws(protected_words=("PowerShot500-42's",)) == ["PowerShot500-42's"]


def test_min_hash_shape(spark):
    an = std(TF.MinHash(hash_count=2, bucket_count=4, hash_set_size=2, with_rotation=False))
    text = " ".join(f"t{i}" for i in range(100))
    got = words(spark, an, text)
    assert len(got) == 16 and len({tuple(g.split(":")[:2]) for g in got}) == 8
    assert len(words(spark, std(TF.MinHash(hash_count=1, bucket_count=8)), "one")) == 8
    assert words(spark, an, text) == words(spark, an, " ".join(reversed(text.split())))


def test_language_rules(spark):
    assert words(spark, A.language("french", stopwords=("et",)), "L'avion et jusqu'ici") == ["avion", "ici"]
    assert words(spark, A.language("german"), "Größe Müll") == ["grosse", "mull"]
    assert words(spark, A.language("turkish"), "DIŞ Ankara'da") == ["dış", "ankara"]
    assert words(spark, A.language("cjk"), "東京都 ｗｉｄｅ") == ["東京", "京都", "wide"]
    assert words(spark, A.language("english", stems={"cats": "cat", "dogs": "dog"}, stem_exclusion=("dogs",)), "cats dogs") == ["cat", "dogs"]
    for name in A.LANGUAGES:
        assert words(spark, A.language(name), "abc 12") == ["abc", "12"]


def test_multi_values_have_a_gap(spark):
    df = spark.createDataFrame([(["a b", "c"],)], "v array<string>")
    rows = df.select(F.explode(A.standard().values(F.col("v"))).alias("t")).select("t.*").collect()
    assert [tuple(r) for r in rows] == [("a", 0), ("b", 1), ("c", 102)]


def test_html(spark):
    page = "<p>a &amp; b<!-- x --><script>var i = '<b>';</script> <B class='k'>c</B></p>"
    df = spark.createDataFrame([(page,)], "t string")
    assert " ".join(df.select(C.HtmlStrip().apply(F.col("t"))).first()[0].split()) == "a & b c"
    assert "<B class='k'>c</B>" in df.select(C.HtmlStrip(("b",)).apply(F.col("t"))).first()[0]


def test_buckets_agree(spark):
    ws = ["the", "é", "東京", ""]
    rows = spark.createDataFrame([(w,) for w in ws], "token string").select("token", term_bucket(F.col("token"), 7)).collect()
    assert all(bucket_of(t, 7) == b for t, b in rows)


def test_terms_of_equals_grouping(spark):
    df = spark.createDataFrame([("1", "b a b c a b")], "_id string, text string")
    got = df.select(F.explode(terms_of(A.standard().array(F.col("text")))).alias("t")).select("t.*").collect()
    assert [tuple(r) for r in got] == [("a", 2, [1, 4]), ("b", 3, [0, 2, 5]), ("c", 1, [3])]


def test_dictionary_tables(spark):
    toks = spark.createDataFrame([("en", "the", 0), ("en", "cats", 1), ("de", "the", 0)], "lang string, token string, position int")
    stops = spark.createDataFrame([("en", "the")], "lang string, token string")
    assert sorted(r.token for r in D.stop_by_table(toks, stops).collect()) == ["cats", "the"]
    assert D.keep_by_table(toks, stops.select("token")).count() == 2
    stems = spark.createDataFrame([("en", "cats", "cat")], "lang string, token string, stem string")
    assert "cat" in [r.token for r in D.stem_by_table(toks, stems).collect()]
    assert "cat" not in [r.token for r in D.stem_by_table(toks, stems, exclusions=stems.select("lang", "token")).collect()]
    syn = spark.createDataFrame([("cats", "felines")], "from_term string, to_term string")
    assert ("felines", "SYNONYM") in [(r.token, r.type) for r in D.synonyms_by_table(toks, syn).collect()]


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits,prefix", [(1, 0), (2, 0), (2, 1)])
def test_fuzzy_join_equals_brute_force(spark, edits, prefix):
    vocab = ["a", "ab", "abc", "abd", "bcd", "abcd", "abdc", "xabc", "zzz", "abcde", "", "ba", "cab"]
    asked = ["abc", "ab", "dcba", "zz", "a"]
    v = spark.createDataFrame([(w,) for w in vocab], "token string")
    q = spark.createDataFrame([(w,) for w in asked], "q string")
    got = sorted((r.q, r.token, r.d) for r in fuzzy.fuzzy_join(q, v, edits, prefix).collect())
    want = sorted((a, b, _distance(a, b)) for a in asked for b in vocab if _distance(a, b) <= edits and (not prefix or a[:prefix] == b[:prefix]))
    assert got == want


@pytest.mark.parametrize(
    "name,text,want",
    [
        ("asciifolding", "Ünïcödé Straße Ærø œuf ﬁ Łódź", "Unicode Strasse AEro oeuf fi Lodz"),
        ("decimal_digit", "٣४๕７", "3457"),
        ("cjk_width", "ＡＢＣ１", "ABC1"),
        ("german_normalization", "größe mueller", "grosse muller"),
        ("scandinavian_folding", "åäæöøÅ", "aaaooA"),
        ("serbian_normalization", "ђурађ", "djuradj"),
        ("arabic_normalization", "أحمد", "احمد"),
        ("persian_normalization", "کی", "كي"),
        ("lowercase", "ÀÉÎ", "àéî"),
        ("uppercase", "àéî", "ÀÉÎ"),
    ],
)
def test_character_tables_give_known_outputs(spark, name, text, want):
    normalizer = A.AnalysisSettings().get_normalizer(name)
    assert spark.range(1).select(normalizer.apply(F.lit(text)).alias("v")).first()["v"] == want


@pytest.mark.parametrize(
    "tokenizer,text,want",
    [
        (TK.Standard(), "It's the year 2024, naïve!", ["It's", "the", "year", "2024", "naïve"]),
        (TK.Whitespace(), " a,b\tc\n", ["a,b", "c"]),
        (TK.LowercaseLetter(), "Ab1Cd-e", ["ab", "cd", "e"]),
    ],
)
def test_tokenizers_give_known_outputs(spark, tokenizer, text, want):
    assert words(spark, A.Analyzer(tokenizer), text) == want


def test_entities_give_known_outputs(spark):
    text = "<p>a &lt;b&gt; &amp; &euro;5&nbsp;&hellip;</p>"
    got = spark.range(1).select(C.HtmlStrip().apply(F.lit(text)).alias("v")).first()["v"]
    assert " ".join(got.split()) == "a <b> & €5 …"


def test_values_keep_their_gap(spark):
    df = spark.createDataFrame([(["a b", "", "c", "d"],)], "v array<string>")
    rows = df.select(std().values(F.col("v")).alias("t")).first()["t"]
    assert [(t["token"], t["position"]) for t in rows] == [("a", 0), ("b", 1), ("c", 102), ("d", 203)]


def test_smallest_hashes_are_converted_once(spark):
    texts = {"a": "one two three four five six", "b": "one two three", "c": "one two", "d": "", "e": None, "f": "x " * 40 + "y z"}
    an = std(TF.Shingle(3, 3, False), TF.MinHash(hash_count=9, bucket_count=1))
    df = spark.createDataFrame(list(texts.items()), "_id string, text string").select("_id", F.transform(an.array(F.col("text")), lambda t: t["token"]).alias("w"))
    for r in df.collect():
        ws = (texts[r["_id"]] or "").split()
        grams = {" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)}
        low = lambda s: min(int(hashlib.md5(f"{s // 4}:{g}".encode()).hexdigest()[8 * (s % 4) : 8 * (s % 4) + 8], 16) for g in grams)  # noqa: E731, B023
        assert r["w"] == ([f"{s}:0:{low(s)}" for s in range(9)] if grams else [])
    # no number is made of a hash that is not the smallest
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min(transform(" in plan and "lambdafunction(cast(conv(" not in plan
    shingles = [t["token"] for t in spark.sql("SELECT 1").select(std(TF.Shingle(2, 2, False, "-")).array(F.lit("a b c")).alias("t")).first()["t"]]
    assert shingles == ["a-b", "b-c"]
