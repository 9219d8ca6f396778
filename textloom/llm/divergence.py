"""Quality rules: counts of a text, and its divergence from the texts of its language.

A document is compared with its language by two histograms: classes of characters, and the words that
are common in the language. The measure is the Jensen-Shannon distance (base 2, from 0 to 1). A document
that is too short for a histogram is not judged by it.

Everything is DataFrame functions. The counts of a document come from its own row. References are sums
over all documents, each distinct text once, so that a large group of copies weighs as one text. Common
words are found exactly in two passes: words of a large share can only lie in hash buckets of at least
that share, and only such buckets are counted word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from textloom.functions.arrays import let
from textloom.llm.catalog import register, table
from textloom.session import materialize

#: Share of a language's words from which a word is common: at most 200 words in each language.
COMMON = 0.005
#: Share of all words from which a language gets a reference: at most 1,000 languages.
LANGUAGE = 0.001
BUCKETS = 4096
#: Distances from which a document is rejected.
CLASS_LIMIT, WORD_LIMIT = 0.33, 0.32
#: Characters and words from which a document is judged.
CLASS_GUARD, WORD_GUARD = 300, 100
#: Base rules: words at least, and the share of words in repeated windows at most.
LEAST_WORDS, REPEATED_PERCENT, WINDOW = 20, 30, 8

# fixed values: the blanks of [\x20\x09-\x0D], and the symbols that are counted
_BLANK, _SYMBOL = r"[\x20\x09-\x0D]", r"[#*$%&|<>]"
#: Classes of characters in the order in which they are taken out of a text; blanks and the rest follow.
CLASSES = ("[a-z]+", r"\p{Lu}+", r"\p{L}+", r"\p{N}+", r"[.,;:!?'\"()\-]+", _SYMBOL + "+")


def words_of(text: Column) -> Column:
    """Runs of characters that are not blanks."""
    return F.array_remove(F.split(text, f"{_BLANK}+", -1), "")


def letter_words(text: Column) -> Column:
    """Runs of letters in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+", -1), "")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _twins(entries: Column) -> Column:
    """The places, in order, of the entries ``(key, at)`` whose key occurs more than once."""

    def equal(a: Column, i: Column, j: Column) -> Column:
        return F.coalesce(F.get(a, i)["key"] == F.get(a, j)["key"], F.lit(False))

    def several(a: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: equal(a, i, i - 1) | equal(a, i, i + 1))

    return let(F.sort_array(entries), lambda a: F.sort_array(F.transform(several(a), lambda i: F.get(a, i)["at"])))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a run of ``window`` words which the text holds more than once.

    Runs are told apart by hashes first; most texts have no equal ones and end there. Runs of equal
    hashes are compared word by word.
    """
    entry = lambda key, at: F.struct(key.alias("key"), at.alias("at"))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def exact(w: Column, keys: Column) -> Column:
        maybe = _twins(F.transform(keys, entry))
        sure = let(maybe, lambda m: _twins(F.transform(m, lambda at: entry(F.array_join(F.slice(w, at + 1, F.lit(window)), " "), at))))
        return let(sure, covered)

    def count(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        keys = let(hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - window + 1), lambda i: F.xxhash64(F.slice(h, i, F.lit(window)))))
        return let(keys, lambda k: F.when(F.size(F.array_distinct(k)) < F.size(k), exact(w, k)).otherwise(F.lit(0)))

    return let(words, lambda w: F.when(F.size(w) > window, count(w)).otherwise(F.lit(0)))


def class_counts(text: Column, solid: Column) -> Column:
    """Characters of each class, then blanks, then the rest; ``solid`` is the text without blanks."""

    def strip(left: Column, classes: tuple[str, ...], counts: list[Column]) -> Column:
        if not classes:
            return F.array(*counts, F.length(text) - F.length(solid), F.length(left))
        return let(F.regexp_replace(left, classes[0], ""), lambda rest: strip(rest, classes[1:], [*counts, F.length(left) - F.length(rest)]))

    return strip(solid, CLASSES, [])


def _source(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang"))


def common_words(source: DataFrame, share: float = COMMON, least: float = LANGUAGE) -> DataFrame:
    """``lang, vocabulary``: the words that make up at least ``share`` of their language's words, by frequency."""
    spoken = source.filter("lang IS NOT NULL").select("lang", F.explode(letter_words(F.col("text"))).alias("word"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int")
    # at most BUCKETS rows a language
    counts = materialize(spoken.groupBy("lang", bucket.alias("bucket")).count(), "word-buckets")
    every = counts.agg(F.sum("count")).scalar()
    totals = counts.groupBy("lang").agg(F.sum("count").alias("total")).filter(F.col("total") >= least * every)
    # at most 1 / least languages, and 1 / share buckets of each
    heavy = counts.join(F.broadcast(totals), "lang").filter(F.col("count") >= share * F.col("total")).drop("count")
    wanted = F.broadcast(heavy.withColumnsRenamed({"lang": "of_lang", "bucket": "of_bucket"}))
    exact = spoken.withColumn("bucket", bucket).join(wanted, (F.col("lang") == F.col("of_lang")) & (F.col("bucket") == F.col("of_bucket")))
    found = exact.groupBy("lang", "word", "total").count().filter(F.col("count") >= share * F.col("total"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("n"), "word")))
    return materialize(found.groupBy("lang").agg(F.transform(ordered, lambda e: e["word"]).alias("vocabulary")), "common-words")


def document_counts(source: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Per document its base counts, its classes, and its common words in the order of the vocabulary, the rest last."""
    words, solid = words_of(F.col("text")), F.array_join(F.col("words"), "")
    rows = source.join(F.broadcast(vocabulary), "lang", "left").withColumn("words", words).withColumn("solid", solid)
    classes = class_counts(F.col("text"), F.col("solid"))

    def histogram(spoken: Column) -> Column:
        each = F.transform(F.coalesce("vocabulary", F.array().cast("array<string>")), lambda w: F.size(spoken) - F.size(F.array_remove(spoken, w)))
        return let(each, lambda e: F.concat(e, F.array(F.size(spoken) - F.aggregate(e, F.lit(0), lambda a, x: a + x))))

    return rows.select(
        "doc_id", "lang", F.xxhash64("text").alias("content"), F.size("words").cast("long").alias("n_words"), F.length("solid").cast("long").alias("word_chars"),
        classes.alias("classes"), repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"), repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.when(F.col("vocabulary").isNotNull(), let(letter_words(F.col("text")), histogram)).alias("common"),
    ).withColumn("n_symbols", F.get("classes", F.lit(5)).cast("long"))


def language_references(counts: DataFrame) -> DataFrame:
    """``lang, class_share, word_share``: shares over all distinct texts of each language."""
    once = counts.filter("common IS NOT NULL").groupBy("lang", "content").agg(F.any_value("classes").alias("classes"), F.any_value("common").alias("common"))
    long = reduce(DataFrame.unionByName, [once.select("lang", F.lit(name).alias("kind"), F.posexplode(name).alias("i", "n")) for name in ("classes", "common")])
    sums = long.groupBy("lang", "kind", "i").agg(F.sum("n").alias("n"))
    share = sums.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang", "kind")))
    listed = lambda kind: F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("i", "share")))), lambda e: e["share"])
    return share.groupBy("lang").agg(listed("classes").alias("class_share"), listed("common").alias("word_share"))


def jensen_shannon(counts: Column, share: Column) -> Column:
    """Distance between a histogram of counts (not all zero) and a list of shares; null without shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def term(p: Column, q: Column) -> Column:
        return (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2

    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    divergence = let(total, lambda t: F.aggregate(F.zip_with(counts, share, lambda n, q: term(n / t, q)), F.lit(0.0), lambda a, x: a + x))
    # without shares there is no distance
    return F.when(share.isNotNull(), F.sqrt(F.least(F.greatest(divergence, F.lit(0.0)), F.lit(1.0))))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT
) -> DataFrame:
    """One row per input row: base counts, both distances, and whether the document is kept.

    ``class_distance`` is null below ``CLASS_GUARD`` characters and ``word_distance`` below ``WORD_GUARD``
    words of letters; both are null where the language is null or has no reference. A null distance
    rejects nothing. A null text is empty, and an empty text fails the base rules. Repeated rows give
    repeated results. References come from the table itself; an empty table gives no rows.
    """
    source = _source(docs, id_col, text_col, lang_col)
    vocabulary = common_words(source)
    counts = materialize(document_counts(source, vocabulary), "document-counts")
    # at most 1 / LANGUAGE rows of 1 / COMMON shares
    references = F.broadcast(language_references(counts))
    size = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    # common words and the rest
    spoken = size(F.col("common"))
    distances = {
        "class_distance": F.when(size(F.col("classes")) >= CLASS_GUARD, jensen_shannon(F.col("classes"), F.col("class_share"))),
        "word_distance": F.when(spoken >= WORD_GUARD, jensen_shannon(F.col("common"), F.col("word_share"))),
    }
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= class_limit) & (F.coalesce("word_distance", F.lit(0.0)) <= word_limit)
    judged = counts.join(references, "lang", "left").withColumns(distances).withColumn("base_failed", failed)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & near).alias("kept"),
        "class_distance", "word_distance",
    )


def _sql() -> str:
    steps, stripped = [], "solid"
    for i, c in enumerate(CLASSES):
        steps.append(f"s{i} AS (SELECT *, regexp_replace({stripped}, {_quoted(c)}, '', 'g') AS r{i} FROM {'t' if i == 0 else f's{i - 1}'})")
        stripped = f"r{i}"
    last = len(CLASSES) - 1
    sizes = [f"length({'solid' if i == 0 else f'r{i - 1}'}) - length(r{i})" for i in range(len(CLASSES))] + ["length(text) - length(solid)", f"length(r{last})"]
    distance = """SELECT n, sqrt(least(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0), 1)) AS distance
        FROM (SELECT n, h.c / sum(h.c) OVER (PARTITION BY n) AS p, coalesce(share, 0) AS q, sum(h.c) OVER (PARTITION BY n) AS total FROM {hist} h JOIN {ref} r ON h.lang = r.lang AND h.bin = r.bin) x
        WHERE total >= {guard} GROUP BY n"""
    reference = "SELECT lang, bin, sum(c) / sum(sum(c)) OVER (PARTITION BY lang) AS share FROM {hist} WHERE n IN (SELECT min(n) FROM t WHERE lang IN (SELECT lang FROM vocab) GROUP BY lang, text) GROUP BY lang, bin"
    return rf"""
WITH t AS MATERIALIZED (
  SELECT *, array_to_string(words, '') AS solid FROM (
    SELECT row_number() OVER () AS n, doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words FROM documents) d),
{', '.join(steps)},
classes AS MATERIALIZED (SELECT n, lang, unnest([{', '.join(sizes)}]) AS c, unnest(range({last + 3})) AS bin FROM s{last}),
spoken AS MATERIALIZED (SELECT n, lang, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM t),
totals AS (SELECT lang, count(*) AS total FROM spoken WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= {LANGUAGE} * (SELECT count(*) FROM spoken WHERE lang IS NOT NULL)),
vocab AS MATERIALIZED (SELECT lang, word FROM spoken JOIN totals USING (lang) GROUP BY lang, word, total HAVING count(*) >= {COMMON} * total),
common AS MATERIALIZED (
  SELECT k.n, k.lang, k.bin, count(s.word) AS c FROM (SELECT n, t.lang, v.word AS bin FROM t JOIN vocab v ON t.lang = v.lang) k LEFT JOIN spoken s ON s.n = k.n AND s.word = k.bin GROUP BY ALL
  UNION ALL SELECT t.n, t.lang, '', count(s.word) FROM t LEFT JOIN (SELECT * FROM spoken WHERE (lang, word) NOT IN (SELECT (lang, word) FROM vocab)) s ON s.n = t.n WHERE t.lang IN (SELECT lang FROM vocab) GROUP BY ALL),
class_ref AS MATERIALIZED ({reference.format(hist='classes')}),
common_ref AS MATERIALIZED ({reference.format(hist='common')}),
cd AS ({distance.format(hist='classes', ref='class_ref', guard=CLASS_GUARD)}),
wd AS ({distance.format(hist='common', ref='common_ref', guard=WORD_GUARD)}),
lines AS (
  SELECT n, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM t) l
  WHERE regexp_matches(line, '[^ 	-
]') GROUP BY n),
runs AS (
  SELECT n, unnest(range(1, len(words) - {WINDOW - 2})) AS i, unnest(list_transform(range(1, len(words) - {WINDOW - 2}), lambda i: array_to_string(words[i:i + {WINDOW - 1}], ' '))) AS run
  FROM t WHERE len(words) >= {WINDOW}),
twice AS (SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, run) AS k FROM runs) x WHERE k > 1),
covered AS (SELECT n, count(DISTINCT i + j) AS n_repeat_words FROM twice, range({WINDOW}) r(j) GROUP BY n),
base AS (
  SELECT t.n, doc_id, len(words) AS n_words, length(solid) AS word_chars, length(solid) - length(regexp_replace(solid, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, cd.distance AS class_distance, wd.distance AS word_distance
  FROM t LEFT JOIN lines USING (n) LEFT JOIN covered USING (n) LEFT JOIN cd USING (n) LEFT JOIN wd USING (n)),
f AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(class_distance, 0) <= {CLASS_LIMIT} AND coalesce(word_distance, 0) <= {WORD_LIMIT} AS kept,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM f"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@register("op11_divergence", _sql())
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})
