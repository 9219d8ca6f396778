"""Char filters, tokenizers, token filters and analyzers over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog.common import (
    STD, STD_LOW, census, q, register, sql_census, sql_expand, sql_map, sql_table, sql_tokens, sql_where, table, texts,
)
from textloom.functions import charmaps
from textloom.operators import analyzers as A, charfilters as C, dictionary as D, tokenfilters as TF, tokenizers as TK
from textloom.session import spread

Analyzer = A.Analyzer
STANDARD = A.standard()


def std(*filters, lower: bool = True) -> Analyzer:
    return Analyzer(TK.Standard(), filters=((TF.Lowercase(),) if lower else ()) + filters)


# --- analyze with offsets

_GAPS = f"list_transform(string_split_regex(text, {q(TK.STANDARD)}), lambda g: length(g))"


@register(
    "analyze_offsets",
    f"""WITH w AS (
      SELECT _id, unnest(l) AS raw, unnest(g[1:len(l)]) AS gap, generate_subscripts(l, 1) - 1 AS position
      FROM (SELECT CAST(doc_id AS VARCHAR) AS _id, {STD} AS l, {_GAPS} AS g FROM documents) s0),
    o AS (SELECT *, sum(gap + length(raw)) OVER (PARTITION BY _id ORDER BY position) AS e FROM w)
    SELECT lower(raw) AS token,
      CASE WHEN regexp_matches(raw, '^\\p{{N}}+$') THEN '<NUM>' WHEN regexp_matches(raw, '^\\p{{Hangul}}') THEN '<HANGUL>' ELSE '<ALPHANUM>' END AS type,
      count(*) AS n, CAST(sum(position) AS BIGINT) AS pos_sum,
      CAST(sum(e - length(raw)) AS BIGINT) AS start_sum, CAST(sum(e) AS BIGINT) AS end_sum
    FROM o GROUP BY 1, 2""",
)
def analyze_offsets(spark, sf):
    ts = STANDARD.tokens(F.col("text"), offsets=True)
    return (
        texts(spark, sf).select(F.explode(ts.array()).alias("t")).groupBy("t.token", "t.type")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("t.position").cast("bigint").alias("pos_sum"),
            F.sum("t.start_offset").cast("bigint").alias("start_sum"), F.sum("t.end_offset").cast("bigint").alias("end_sum"),
        )
    )


# --- char filters


def _sql_html(keep: str) -> str:
    x = "html"
    for block in ("script", "style"):
        x = f"regexp_replace({x}, '(?is)<{block}\\b[^>]*>.*?</{block}\\s*>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?i)<(/?(?:{keep})(?:\\s[^>]*)?)>', {q(C.KEEP_OPEN + chr(92) + '1' + C.KEEP_CLOSE)}, 'g')"
    x = f"translate(regexp_replace({x}, '<[^>]*>', ' ', 'g'), {q(C.KEEP_OPEN + C.KEEP_CLOSE)}, '<>')"
    for name, char in C.ENTITIES.items():
        x = f"replace({x}, {q(name)}, {q(char)})"
    return x


@register("html_strip", f"SELECT CAST(page_id AS VARCHAR) AS _id, {_sql_html('b|li')} AS text FROM pages")
def html_strip(spark, sf):
    pages = spread(table(spark, sf, "pages").select("page_id", "html"))
    return pages.select(F.col("page_id").cast("string").alias("_id"), C.HtmlStrip(("b", "li")).apply(F.col("html")).alias("text"))


_RULES = ("the => DER", "a => 4", "e => 3", "ing => in'", "on => ")
_RULE_TABLE = C.CharMapping(_RULES).table()


@register("char_mapping", f"SELECT CAST(doc_id AS VARCHAR) AS _id, {sql_table('text', _RULE_TABLE)} AS text FROM documents")
def char_mapping(spark, sf):
    return texts(spark, sf).select("_id", C.CharMapping(_RULES).apply(F.col("text")).alias("text"))


@register(
    "char_pattern_replace",
    """SELECT CAST(doc_id AS VARCHAR) AS _id, regexp_replace(text, '(\\w)(\\w)ion', '\\2\\1_', 'g') AS every,
    regexp_replace(text, '(\\w)(\\w)ion', '\\2\\1_') AS first FROM documents""",
)
def char_pattern_replace(spark, sf):
    every, first = C.PatternReplaceChars(r"(\w)(\w)ion", "$2$1_"), C.PatternReplaceChars(r"(\w)(\w)ion", "$2$1_", all=False)
    return texts(spark, sf).select("_id", every.apply(F.col("text")).alias("every"), first.apply(F.col("text")).alias("first"))


# --- tokenizers


def tokenizer(key: str, tok, sql_words: str, source: str = "documents", types: bool = False):
    def run(spark, sf):
        df = texts(spark, sf) if source == "documents" else spread(table(spark, sf, "pages").select(F.col(source).alias("text")))
        return census(df, Analyzer(tok))

    if source == "documents":
        sql = sql_census(sql_tokens(sql_words))
    else:
        sql = sql_census(sql_tokens(sql_words.replace("text", source), "pages", "CAST(page_id AS VARCHAR)"))
    register(key, sql)(run)


def _find(pattern: str) -> str:
    return f"regexp_extract_all(text, {q(pattern)})"


tokenizer("tok_whitespace", TK.Whitespace(), _find(r"\S+"))
tokenizer("tok_url_email", TK.UrlEmail(), _find(TK.UrlEmail().pattern()))
tokenizer("tok_url_email_pages", TK.UrlEmail(), _find(TK.UrlEmail().pattern()), source="url")
tokenizer("tok_classic", TK.Classic(), _find(TK.Classic().pattern()))
tokenizer("tok_letter", TK.Letter(), _find(r"\p{L}+"))
tokenizer("tok_lowercase", TK.LowercaseLetter(), f"list_transform({_find(chr(92) + 'p{L}+')}, lambda x: lower(x))")
tokenizer("tok_keyword", TK.Keyword(), "[text]")
tokenizer("tok_pattern", TK.Pattern(r"\W+"), r"list_filter(string_split_regex(text, '\W+'), lambda x: x <> '')")
tokenizer("tok_pattern_group", TK.Pattern("([a-z]+)ion", ("CASE_INSENSITIVE",), 1), "list_filter(regexp_extract_all(text, '(?i)([a-z]+)ion', 1), lambda x: x <> '')")
tokenizer("tok_simple_pattern", TK.SimplePattern("[a-z]{3}"), _find("[a-z]{3}"))
tokenizer("tok_simple_split", TK.SimplePatternSplit("[aeiou ]"), "list_filter(string_split_regex(text, '[aeiou ]'), lambda x: x <> '')")
tokenizer("tok_char_group", TK.CharGroup(("whitespace", "punctuation", "t")), r"list_filter(string_split_regex(text, '[\s\p{P}t]+'), lambda x: x <> '')")


def _cut(words: str, n: int) -> str:
    return f"flatten(list_transform({words}, lambda w: list_transform(range(0, CAST(ceil(length(w) / {n}.0) AS BIGINT)), lambda k: substr(w, k * {n} + 1, {n}))))"


@register("tok_standard", sql_census(
    "SELECT *, CASE WHEN regexp_matches(token, '^\\p{N}+$') THEN '<NUM>' WHEN regexp_matches(token, '^\\p{Hangul}') THEN '<HANGUL>' ELSE '<ALPHANUM>' END AS type "
    f"FROM ({sql_tokens(STD)}) s3", "type"))
def tok_standard(spark, sf):
    return census(texts(spark, sf), Analyzer(TK.Standard()), "type", types=True)


tokenizer("tok_standard_max_length", TK.Standard(max_token_length=5), _cut(STD, 5))


def _sql_grams(word: str, low: int, high: int, edge: bool) -> str:
    starts = "range(1, 2)" if edge else f"range(1, length({word}) - {low} + 2)"
    return (
        f"(CASE WHEN length({word}) >= {low} THEN flatten(list_transform({starts}, lambda s: "
        f"list_transform(range({low}, least({high}, length({word}) - s + 1) + 1), lambda k: substr({word}, s, k)))) ELSE [] END)"
    )


_RUNS = "regexp_extract_all(text, '[\\p{L}\\p{N}]+')"
tokenizer("tok_ngram", TK.Ngram(2, 3, ("letter", "digit")), f"flatten(list_transform({_RUNS}, lambda r: {_sql_grams('r', 2, 3, False)}))")
tokenizer("tok_edge_ngram", TK.EdgeNgram(1, 4, ("letter", "digit")), f"flatten(list_transform({_RUNS}, lambda r: {_sql_grams('r', 1, 4, True)}))")
tokenizer("tok_path", TK.PathHierarchy(), "list_filter(list_transform(range(1, len(string_split(text, '/')) + 1), lambda i: array_to_string(string_split(text, '/')[1:i], '/')), lambda x: x <> '')", source="url")
tokenizer(
    "tok_path_reverse", TK.PathHierarchy(replacement=">", reverse=True, skip=1),
    "list_filter(list_transform(range(1, len(string_split(text, '/'))), lambda i: array_to_string(string_split(text, '/')[i:len(string_split(text, '/')) - 1], '>')), lambda x: x <> '')",
    source="url",
)


# --- token filters


def token_filter(key: str, filters, sql: str, lower: bool = True, text=None, extra: tuple[str, ...] = ()):
    def run(spark, sf):
        return census(texts(spark, sf, text() if text else None), std(*filters, lower=lower), *extra)

    register(key, sql)(run)


token_filter("tf_lowercase", (), sql_map("token"))


@register("tf_case_trim_reverse", sql_map("reverse(trim(replace(upper(token), 'ẞ', 'SS')))", STD))
def tf_case_trim_reverse(spark, sf):
    return census(texts(spark, sf), std(TF.Uppercase(), TF.Trim(), TF.Reverse(), lower=False))


token_filter("tf_lowercase_turkish", (TF.Lowercase("turkish"),), sql_map("lower(translate(token, 'İI', 'iı'))", STD), lower=False)
_FOLD = sql_table("token", charmaps.LATIN_FOLDING)
token_filter("tf_asciifolding", (TF.AsciiFolding(),), sql_map(_FOLD))
token_filter("tf_asciifolding_preserve", (TF.AsciiFolding(True),), sql_expand(f"list_distinct([{_FOLD}, token])"))


def _derived_apostrophes():
    """French-like elisions and possessives made from the texts themselves."""
    return F.replace(F.replace(F.replace(F.col("text"), F.lit(" le "), F.lit(" l'")), F.lit(" de "), F.lit(" D’")), F.lit("ion "), F.lit("ion's "))


_DERIVED = "replace(replace(replace(text, ' le ', ' l'''), ' de ', ' D’'), 'ion ', 'ion''s ')"
_DERIVED_STD = STD.replace("text", _DERIVED, 1)


@register(
    "tf_simple_normalizers",
    sql_census(
        f"SELECT unnest([regexp_replace(token, '[''’].*$', ''), CASE WHEN regexp_matches(token, '^(?:\\p{{L}}\\.)+\\p{{L}}?$') THEN replace(token, '.', '') ELSE regexp_replace(token, '[''’][sS]$', '') END, "
        f"translate(translate(token, '0123456789', '٠١٢٣٤٥٦٧٨٩'), '٠١٢٣٤٥٦٧٨٩', '0123456789'), token]) AS token, unnest(['apostrophe', 'classic', 'digits', 'width']) AS kind, position FROM ({sql_tokens(_DERIVED_STD)}) s2",
        "kind",
    ),
)
def tf_simple_normalizers(spark, sf):
    """Digits and width come from texts written in Arabic digits and full-width letters."""
    base = texts(spark, sf, _derived_apostrophes())
    wide = "".join(chr(c) for c in range(0xFF41, 0xFF5B))
    variants = {
        "apostrophe": (F.col("text"), TF.Apostrophe()),
        "classic": (F.col("text"), TF.ClassicNormalize()),
        "digits": (F.translate("text", "0123456789", "٠١٢٣٤٥٦٧٨٩"), TF.TOKEN_FILTERS["decimal_digit"]()),
        "width": (F.translate("text", "abcdefghijklmnopqrstuvwxyz", wide), TF.TOKEN_FILTERS["cjk_width"]()),
    }
    arrays = [F.struct(F.lit(k).alias("kind"), std(f, lower=False).array(col).alias("ts")) for k, (col, f) in variants.items()]
    return (
        base.select(F.inline(F.array(*arrays))).select("kind", F.explode("ts").alias("t"))
        .groupBy(F.col("t.token").alias("token"), "kind")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("t.position").cast("bigint").alias("pos_sum"))
    )


_G = sql_table(sql_table("token", charmaps.GERMAN_UMLAUTS), charmaps.GERMAN_PAIRS)
token_filter("tf_german_norm", (TF.GermanNormalize(),), sql_map(f"regexp_replace({_G}, '(^|[^aeiouq])ue', '\\1u', 'g')"))
_S = sql_table("token", {**charmaps.SCANDINAVIAN_PAIRS, **charmaps.SCANDINAVIAN_LETTERS})
_SF = sql_table("token", {**charmaps.SCANDINAVIAN_PAIR_FOLDS, **charmaps.SCANDINAVIAN_FOLDS})
token_filter(
    "tf_scandinavian", (TF.Multiplexer(((TF.ScandinavianNormalize(),), (TF.ScandinavianFold(),)), preserve_original=False),),
    sql_expand(f"list_distinct([{_S}, {_SF}])"),
)

# Other scripts: the texts' Latin letters written in the script, so the work grows with the table.
_SCRIPTS = {
    "arabic": ("abcdefghij", "آأإىةـًبتث", charmaps.ARABIC), "persian": ("abcdefghij", "یےکۀہبتثجح", charmaps.PERSIAN),
    "sorani": ("abcdefghij", "يىكەھبتثجح", charmaps.SORANI), "hindi": ("abcdefghij", "आईऊकखगचजटन", charmaps.HINDI),
    "bengali": ("abcdefghij", "ঈঊশষণকখগচজ", charmaps.BENGALI), "indic": ("abcdefghij", "ऎऒकखगचजटतन", charmaps.INDIC),
    "serbian": ("abcdefghij", "абвгдђжљњћ", charmaps.SERBIAN),
}


def _script_filters():
    for name, (src, dst, mapping) in _SCRIPTS.items():
        def run(spark, sf, name=name, src=src, dst=dst):
            df = texts(spark, sf, F.translate(F.lower("text"), src, dst))
            return census(df, Analyzer(TK.Whitespace(), filters=(TF.TOKEN_FILTERS[f"{name}_normalization"](),)))

        words = f"regexp_extract_all(translate(lower(text), {q(src)}, {q(dst)}), '\\S+')"
        register(f"tf_{name}_norm", sql_map(sql_table("token", mapping), words))(run)


_script_filters()

token_filter(
    "tf_elision", (TF.Elision(("l", "d"), articles_case=True),),
    sql_map("regexp_replace(token, '(?i)^(?:l|d)[''’]', '')", _DERIVED_STD), lower=False, text=_derived_apostrophes,
)

_STOP = ("the", "of", "and", "la", "les", "der", "die", "el", "los", "in", "is")
_STOP_SQL = "(" + ", ".join(q(w) for w in _STOP) + ")"
token_filter("tf_stop", (TF.Stop(_STOP),), sql_where(f"token NOT IN {_STOP_SQL}"))
token_filter(
    "tf_stop_keep_trailing", (TF.Stop(_STOP, ignore_case=True, remove_trailing=False),),
    sql_census(f"SELECT token, position FROM (SELECT *, max(position) OVER (PARTITION BY _id) AS last FROM ({sql_tokens(STD)}) s2) s3 WHERE position = last OR lower(token) NOT IN {_STOP_SQL}"),
    lower=False,
)
token_filter("tf_keep", (TF.Keep(_STOP),), sql_where(f"token IN {_STOP_SQL}"))
token_filter("tf_keep_types", (TF.KeepTypes(("<NUM>",)),), sql_where("regexp_matches(token, '^\\p{N}+$')"))
token_filter("tf_keep_types_exclude", (TF.KeepTypes(("<NUM>",), mode="exclude"),), sql_where("NOT regexp_matches(token, '^\\p{N}+$')"))
token_filter("tf_length", (TF.Length(3, 6),), sql_where("length(token) BETWEEN 3 AND 6"))
token_filter("tf_limit", (TF.Limit(10),), sql_where("position < 10"))
token_filter("tf_truncate", (TF.Truncate(4),), sql_map("substr(token, 1, 4)"))
token_filter("tf_unique", (TF.Unique(),), sql_census(f"SELECT token, min(position) AS position FROM ({sql_tokens(STD_LOW)}) s2 GROUP BY _id, token"))
token_filter(
    "tf_remove_dups", (TF.KeywordRepeat(), TF.RemoveDuplicates()),
    sql_census(f"SELECT DISTINCT _id, token, position FROM ({sql_tokens(STD_LOW)}) s2"),
)


@register(
    "tf_fingerprint",
    f"SELECT _id, token FROM (SELECT _id, string_agg(DISTINCT token, ' ' ORDER BY token) AS token FROM ({sql_tokens(STD_LOW)}) s2 GROUP BY _id) s3 WHERE length(token) <= 600",
)
def tf_fingerprint(spark, sf):
    return A.analyze(texts(spark, sf), "text", std(TF.Fingerprint(600))).select("_id", "token")


def _sql_hash(seed: str, token: str) -> str:
    return f"CAST('0x' || substr(md5(({seed} // 4) || ':' || {token}), CAST(1 + 8 * ({seed} % 4) AS BIGINT), 8) AS BIGINT)"


_BIGRAMS = f"SELECT _id, token || ' ' || nxt AS token FROM (SELECT *, lead(token) OVER (PARTITION BY _id ORDER BY position) AS nxt FROM ({sql_tokens(STD_LOW)}) s2) s3 WHERE nxt IS NOT NULL"
_MIN_HASHES = f"""
    SELECT _id, seed, h * 8 // 4294967296 AS bucket, min(h) AS h FROM (
      SELECT _id, seed, {_sql_hash("seed", "token")} AS h FROM ({_BIGRAMS}) s4, (SELECT unnest(range(0, 2)) AS seed) s5) s6
    GROUP BY ALL"""


@register("tf_min_hash", f"SELECT _id, seed || ':' || bucket || ':' || h AS token FROM ({_MIN_HASHES}) s7")
def tf_min_hash(spark, sf):
    an = std(TF.Shingle(2, 2, output_unigrams=False), TF.MinHash(hash_count=2, bucket_count=8, with_rotation=False))
    return A.analyze(texts(spark, sf), "text", an).select("_id", "token")


@register(
    "tf_min_hash_rotated",
    f"""WITH m AS ({_MIN_HASHES}), want AS (SELECT DISTINCT _id, seed, b FROM m, (SELECT unnest(range(0, 8)) AS b) s8)
    SELECT _id, seed || ':' || b || ':' || coalesce(nxt, fst) AS token FROM (
      SELECT w._id, w.seed, w.b, arg_min(m.h, m.bucket) FILTER (WHERE m.bucket >= w.b) AS nxt, arg_min(m.h, m.bucket) AS fst
      FROM want w JOIN m ON m._id = w._id AND m.seed = w.seed GROUP BY ALL) s9""",
)
def tf_min_hash_rotated(spark, sf):
    an = std(TF.Shingle(2, 2, output_unigrams=False), TF.MinHash(hash_count=2, bucket_count=8, with_rotation=True))
    return A.analyze(texts(spark, sf), "text", an).select("_id", "token")


def _lead(k: int) -> str:
    return f"lead(token, {k}) OVER (PARTITION BY _id ORDER BY position)"


token_filter(
    "tf_shingle", (TF.Shingle(2, 3),),
    sql_census(
        f"SELECT unnest([token, token || ' ' || n1, token || ' ' || n1 || ' ' || n2]) AS token, position FROM (SELECT *, {_lead(1)} AS n1, {_lead(2)} AS n2 FROM ({sql_tokens(STD_LOW)}) s2) s3"
    ).replace(") s1 GROUP BY", ") s1 WHERE token IS NOT NULL GROUP BY"),
)
_CG = f"SELECT *, {_lead(1)} AS nxt, lag(token) OVER (PARTITION BY _id ORDER BY position) AS prv FROM ({sql_tokens(STD_LOW)}) s2"
token_filter(
    "tf_common_grams", (TF.CommonGrams(_STOP),),
    sql_census(
        f"SELECT unnest([token, CASE WHEN token IN {_STOP_SQL} OR nxt IN {_STOP_SQL} THEN token || '_' || nxt END]) AS token, position FROM ({_CG}) s3"
    ).replace(") s1 GROUP BY", ") s1 WHERE token IS NOT NULL GROUP BY"),
)
token_filter(
    "tf_common_grams_query", (TF.CommonGrams(_STOP, query_mode=True),),
    sql_census(
        f"SELECT unnest([CASE WHEN NOT ((nxt IS NOT NULL AND (token IN {_STOP_SQL} OR nxt IN {_STOP_SQL})) OR (prv IS NOT NULL AND (token IN {_STOP_SQL} OR prv IN {_STOP_SQL}))) THEN token END, "
        f"CASE WHEN nxt IS NOT NULL AND (token IN {_STOP_SQL} OR nxt IN {_STOP_SQL}) THEN token || '_' || nxt END]) AS token, position FROM ({_CG}) s3"
    ).replace(") s1 GROUP BY", ") s1 WHERE token IS NOT NULL GROUP BY"),
)

# Latin letters written as Han and Hangul characters
_CJK_SRC, _CJK_DST = "abcdefghijklmnop", "東京都大阪府한국어中文日本語학교"
_CJK_TEXT = f"translate(lower(text), {q(_CJK_SRC)}, {q(_CJK_DST)})"
token_filter(
    "tf_cjk_bigram", (TF.CjkBigram(),),
    sql_census(
        "SELECT unnest(flatten(list_transform(regexp_extract_all(token, '[\\p{Han}\\p{Hangul}\\p{Hiragana}\\p{Katakana}]+|[^\\p{Han}\\p{Hangul}\\p{Hiragana}\\p{Katakana}]+'), lambda r: "
        "CASE WHEN regexp_matches(r, '^[\\p{Han}\\p{Hangul}\\p{Hiragana}\\p{Katakana}]') AND length(r) > 1 THEN list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) ELSE [r] END))) AS token, position "
        f"FROM ({sql_tokens(STD.replace('text', _CJK_TEXT, 1))}) s2"
    ),
    lower=False, text=lambda: F.translate(F.lower("text"), _CJK_SRC, _CJK_DST),
)
token_filter("tf_ngram", (TF.NgramFilter(3, 4),), sql_expand(_sql_grams("token", 3, 4, False)))
token_filter(
    "tf_edge_ngram", (TF.EdgeNgramFilter(2, 5, preserve_original=True),),
    sql_expand(f"list_concat({_sql_grams('token', 2, 5, True)}, CASE WHEN length(token) < 2 OR length(token) > 5 THEN [token] ELSE [] END)"),
)
token_filter(
    "tf_pattern_capture", (TF.PatternCapture(("([a-z]+)ion", "([0-9]+)")),),
    sql_expand("list_distinct(list_filter(list_concat([token], regexp_extract_all(token, '([a-z]+)ion', 1), regexp_extract_all(token, '([0-9]+)', 1)), lambda x: x <> ''))"),
)
token_filter("tf_pattern_replace", (TF.PatternReplace("(e)([a-z])", "$2$1"),), sql_map("regexp_replace(token, '(e)([a-z])', '\\2\\1', 'g')"))

_SYN = ("the, le, der => art", "ing, tion", "of the => ofthe")


def _sql_synonyms(length: bool) -> str:
    base = f"SELECT *, {_lead(1)} AS nxt FROM ({sql_tokens(STD_LOW)}) s2"
    kind = "CASE WHEN regexp_matches(token, '^\\p{N}+$') THEN '<NUM>' ELSE '<ALPHANUM>' END"
    one = lambda w, k, n: f"{{'token': {w}, 'type': {k}, 'position_length': {n}}}"
    own = (
        f"CASE WHEN token IN ('the', 'le', 'der') THEN [{one(q('art'), q('SYNONYM'), 1)}] "
        f"WHEN token = 'ing' THEN [{one('token', kind, 1)}, {one(q('tion'), q('SYNONYM'), 1)}] "
        f"WHEN token = 'tion' THEN [{one('token', kind, 1)}, {one(q('ing'), q('SYNONYM'), 1)}] ELSE [{one('token', kind, 1)}] END"
    )
    more = f"CASE WHEN token = 'of' AND nxt = 'the' THEN [{one(q('ofthe'), q('SYNONYM'), 2)}] ELSE [] END"
    inner = f"SELECT s.token AS token, s.type AS type, s.position_length AS position_length, position FROM (SELECT unnest(list_concat({own}, {more})) AS s, position FROM ({base}) s3) s4"
    return sql_census(inner, *(("type", "position_length") if length else ("type",)))


token_filter("tf_synonym", (TF.Synonym(_SYN),), _sql_synonyms(False), extra=("type",))
token_filter("tf_synonym_graph", (TF.SynonymGraph(_SYN),), _sql_synonyms(True), extra=("type", "position_length"))
token_filter(
    "tf_stemmer_override", (TF.StemmerOverride(("the, les, der => le", "and => et")),),
    sql_census(f"SELECT CASE WHEN token IN ('the', 'les', 'der') THEN 'le' WHEN token = 'and' THEN 'et' ELSE token END AS token, token IN ('the', 'les', 'der', 'and') AS keyword, position FROM ({sql_tokens(STD_LOW)}) s2", "keyword"),
    extra=("keyword",),
)
token_filter(
    "tf_marker_override", (TF.KeywordMarker(("the", "of")), TF.StemmerOverride(("the, les, der => le", "and => et"))),
    sql_census(f"SELECT CASE WHEN token IN ('les', 'der') THEN 'le' WHEN token = 'and' THEN 'et' ELSE token END AS token, token IN ('the', 'of', 'les', 'der', 'and') AS keyword, position FROM ({sql_tokens(STD_LOW)}) s2", "keyword"),
    extra=("keyword",),
)
token_filter(
    "tf_keyword_marker", (TF.KeywordMarker(keywords_pattern="th.*"),),
    sql_census(f"SELECT *, regexp_matches(token, '^(?:th.*)$') AS keyword FROM ({sql_tokens(STD_LOW)}) s2", "keyword"), extra=("keyword",),
)
token_filter(
    "tf_keyword_repeat", (TF.KeywordRepeat(),),
    sql_census(f"SELECT token, position, unnest([true, false]) AS keyword FROM ({sql_tokens(STD_LOW)}) s2", "keyword"), extra=("keyword",),
)
token_filter(
    "tf_condition", (TF.Condition("length(token.term) < 4", (TF.Uppercase(), TF.Truncate(2))),),
    sql_map("CASE WHEN length(token) < 4 THEN substr(replace(upper(token), 'ẞ', 'SS'), 1, 2) ELSE token END"),
)
token_filter("tf_predicate", (TF.Predicate("length(token.term) > 5 AND token.position % 2 = 0"),), sql_where("length(token) > 5 AND position % 2 = 0"))
token_filter(
    "tf_multiplexer", (TF.Multiplexer(((TF.Lowercase(),), (TF.Lowercase(), TF.Reverse()))),),
    sql_expand("list_distinct([token, lower(token), reverse(lower(token))])", STD), lower=False,
)


@register(
    "tf_payload",
    "SELECT split_part(token, '|', 1) AS token, TRY_CAST(split_part(token, '|', 2) AS DOUBLE) AS payload, count(*) AS n, CAST(sum(position) AS BIGINT) AS pos_sum "
    f"FROM ({sql_tokens('''regexp_extract_all(regexp_replace(replace(text, '|', ''), '(\\S+) (\\S+)', '\\1|' || (doc_id % 10) || '.5 \\2', 'g'), '\\S+')''')}) s2 GROUP BY 1, 2",
)
def tf_payload(spark, sf):
    """Every second word carries a number made from the document's key."""
    score = F.concat((F.col("_id").cast("bigint") % 10).cast("string"), F.lit(".5"))
    marked = F.replace(F.regexp_replace(F.replace("text", F.lit("|"), F.lit("")), r"(\S+) (\S+)", "$1| $2"), F.lit(""), score)
    return census(texts(spark, sf, marked), Analyzer(TK.Whitespace(), filters=(TF.DelimitedPayload(),)), "payload")


_PARTS = "regexp_extract_all(base, '\\p{Lu}?\\p{Ll}+|\\p{Lu}+|[\\p{Lo}\\p{Lt}\\p{Lm}]+|\\p{N}+')"
_BARE = "regexp_replace(base, '[^\\p{L}\\p{N}]+', '', 'g')"
_WD_WORDS = f"SELECT *, regexp_replace(token, '[''’][sS]$', '') AS base FROM ({sql_tokens('''regexp_extract_all(text, '\\S+')''')}) s2"


@register(
    "tf_word_delimiter",
    sql_census(f"SELECT unnest(list_filter(list_distinct(list_concat([token], {_PARTS}, regexp_extract_all({_BARE}, '\\p{{L}}+'), regexp_extract_all({_BARE}, '\\p{{N}}+'), [{_BARE}])), lambda x: x <> '')) AS token, position FROM ({_WD_WORDS}) s3"),
)
def tf_word_delimiter(spark, sf):
    wd = TF.WordDelimiter(preserve_original=True, catenate_words=True, catenate_numbers=True, catenate_all=True)
    return census(texts(spark, sf), Analyzer(TK.Whitespace(), filters=(wd,)))


@register(
    "tf_word_delimiter_graph",
    sql_census(
        f"SELECT unnest(list_filter(list_distinct(list_concat({_PARTS}, [{_BARE}])), lambda x: x <> '')) AS token, base, position FROM ({_WD_WORDS}) s3"
    ).replace("SELECT token,", "SELECT token, position_length,", 1).replace("GROUP BY token", "GROUP BY token, position_length")
    .replace("FROM (SELECT unnest", f"FROM (SELECT token, position, CASE WHEN token = {_BARE} THEN greatest(len({_PARTS}), 1) ELSE 1 END AS position_length FROM (SELECT unnest", 1)
    .replace(") s1 ", ") s9) s1 ", 1),
)
def tf_word_delimiter_graph(spark, sf):
    wd = TF.WordDelimiterGraph(catenate_all=True)
    return census(texts(spark, sf), Analyzer(TK.Whitespace(), filters=(wd,)), "position_length").withColumn(
        "position_length", F.col("position_length").cast("bigint")
    )


_DICT = ("the", "tion", "and", "ing", "ent", "that", "with", "eau", "ver")
_DICT_SQL = "[" + ", ".join(q(w) for w in _DICT) + "]"
_SUBS = "flatten(list_transform(range(1, length(token)), lambda s: list_transform(range(3, least(6, length(token) - s + 1) + 1), lambda k: substr(token, s, k))))"
token_filter(
    "tf_decompound", (TF.Decompound(_DICT, min_subword_size=3, max_subword_size=6),),
    sql_expand(f"list_concat([token], CASE WHEN length(token) >= 5 THEN list_filter({_SUBS}, lambda x: list_contains({_DICT_SQL}, x)) ELSE [] END)"),
)
token_filter(
    "tf_decompound_longest", (TF.Decompound(_DICT, min_subword_size=3, max_subword_size=6, only_longest_match=True),),
    sql_census(
        f"SELECT unnest(list_concat([token], CASE WHEN length(token) >= 5 THEN list_filter(list_transform(range(1, length(token) - 1), lambda s: "
        f"list_last(list_filter(list_transform(range(3, least(6, length(token) - s + 1) + 1), lambda k: substr(token, s, k)), lambda x: list_contains({_DICT_SQL}, x)))), lambda x: x IS NOT NULL) ELSE [] END)) AS token, position FROM ({sql_tokens(STD_LOW)}) s2"
    ),
)


_SOUNDEX_CODES = "01230120022455012623010202"


def _sql_soundex(word: str) -> str:
    """Soundex by hand: letters of one code merge, also across h and w; vowels part them."""
    rest = f"translate(upper({word}), 'HW', '')"
    x = f"translate({rest}, 'ABCDEFGIJKLMNOPQRSTUVXYZ', '012301202245501262301202')"
    for d in "0123456":
        x = f"regexp_replace({x}, '{d}+', '{d}', 'g')"
    return x


@register(
    "tf_soundex",
    "SELECT code, refined, count(*) AS n, count(DISTINCT token) AS spellings FROM ("
    "SELECT token, CASE WHEN up = '' THEN token ELSE substr(rpad(substr(up, 1, 1) || replace(substr(CASE WHEN regexp_matches(up, '^[HW]') THEN '0' || codes ELSE codes END, 2), '0', ''), 4, '0'), 1, 4) END AS code, "
    "CASE WHEN up = '' THEN token ELSE substr(up, 1, 1) || ref END AS refined FROM ("
    f"SELECT token, upper(token) AS up, {_sql_soundex('token')} AS codes, "
    + "".join("regexp_replace(" for _ in "0123456789")
    + "translate(upper(token), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01360240043788015936020505')"
    + "".join(f", '{d}+', '{d}', 'g')" for d in "0123456789")
    + f" AS ref FROM ({sql_tokens('''regexp_extract_all(lower(text), '[a-z]+')''')}) s2) s3) s4 GROUP BY 1, 2",
)
def tf_soundex(spark, sf):
    from textloom.functions.phonetic import refined_soundex, soundex

    words = Analyzer(TK.SimplePattern("[a-z]+")).array(F.lower("text"))
    per_word = texts(spark, sf).select(F.explode(words).alias("t")).groupBy("t.token").agg(F.count(F.lit(1)).alias("c"))
    keyed = per_word.select(soundex(F.col("token")).alias("code"), refined_soundex(F.col("token")).alias("refined"), "c")
    return keyed.groupBy("code", "refined").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("spellings"))


# --- analyzers and normalizers

_CUSTOM = A.AnalysisSettings(
    char_filter={"amp": {"type": "mapping", "mappings": ["& => and"]}},
    filter={"short": {"type": "truncate", "length": 6}, "stops": {"type": "stop", "stopwords": list(_STOP)}},
    analyzer={"folded": {"type": "custom", "tokenizer": "standard", "char_filter": ["amp"], "filter": ["lowercase", "asciifolding", "stops", "short"]}},
)


@register(
    "an_custom",
    sql_census(
        f"SELECT substr(token, 1, 6) AS token, position FROM (SELECT {sql_table('token', charmaps.LATIN_FOLDING)} AS token, position FROM ({sql_tokens(STD_LOW.replace('text', '''replace(text, '&', 'and')''', 1))}) s2) s3 WHERE token NOT IN {_STOP_SQL}"
    ),
)
def an_custom(spark, sf):
    return census(texts(spark, sf), _CUSTOM.get_analyzer("folded"))


_EN = "(" + ", ".join(q(w) for w in TF.ENGLISH_STOP_WORDS) + ")"


@register("an_standard", sql_census(f"SELECT * FROM ({sql_tokens(_cut(STD, 12).replace('substr(w, k * 12 + 1, 12)', 'lower(substr(w, k * 12 + 1, 12))'))}) s2 WHERE token NOT IN {_EN}"))
def an_standard(spark, sf):
    return census(texts(spark, sf), A.standard("_english_", max_token_length=12))


_LETTERS = f"list_transform({_find(chr(92) + 'p{L}+')}, lambda x: lower(x))"


@register(
    "an_builtin",
    " UNION ALL ".join(
        f"SELECT {q(k)} AS analyzer, count(*) AS n, count(DISTINCT token) AS n_distinct, CAST(sum(position) AS BIGINT) AS pos_sum, CAST(sum(length(token)) AS BIGINT) AS chars FROM ({sql_tokens(w)}) s2"
        for k, w in (("simple", _LETTERS), ("whitespace", _find(r"\S+")), ("keyword", "[text]"))
    ),
)
def an_builtin(spark, sf):
    arrays = [F.struct(F.lit(k).alias("analyzer"), an.array(F.col("text")).alias("ts")) for k, an in (("simple", A.simple()), ("whitespace", A.whitespace()), ("keyword", A.keyword()))]
    per_token = (
        texts(spark, sf).select(F.inline(F.array(*arrays))).select("analyzer", F.explode("ts").alias("t"))
        .groupBy("analyzer", "t.token").agg(F.count(F.lit(1)).alias("c"), F.sum("t.position").alias("p"))
    )
    return per_token.groupBy("analyzer").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_distinct"), F.sum("p").cast("bigint").alias("pos_sum"), F.sum(F.length("token") * F.col("c")).cast("bigint").alias("chars")
    )


@register("an_stop", sql_where(f"token NOT IN {_EN}", _LETTERS))
def an_stop(spark, sf):
    return census(texts(spark, sf), A.stop())


@register("an_pattern", sql_where(f"token NOT IN {_STOP_SQL}", r"list_transform(list_filter(string_split_regex(text, '\W+'), lambda x: x <> ''), lambda x: lower(x))"))
def an_pattern(spark, sf):
    return census(texts(spark, sf), A.pattern(stopwords=_STOP))


@register(
    "an_fingerprint",
    f"SELECT sha256(token) AS fingerprint, count(*) AS n, min(_id) AS first_id FROM (SELECT _id, string_agg(DISTINCT token, '+' ORDER BY token) AS token FROM (SELECT _id, {sql_table('token', charmaps.LATIN_FOLDING)} AS token FROM ({sql_tokens(STD_LOW)}) s2) s3 WHERE token NOT IN {_STOP_SQL} GROUP BY _id) s4 GROUP BY 1",
)
def an_fingerprint(spark, sf):
    fp = A.analyze(texts(spark, sf), "text", A.fingerprint("+", 2**31 - 1, _STOP))
    return fp.groupBy(F.sha2("token", 256).alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first_id"))


_LANG_TOKENS = sql_tokens(STD_LOW, more="lang")
_TOP_WORDS = f"SELECT lang, token, df, row_number() OVER (PARTITION BY lang ORDER BY df DESC, token) AS rank FROM (SELECT lang, token, count(DISTINCT _id) AS df FROM ({_LANG_TOKENS}) s2 GROUP BY 1, 2) s3"


def top_words(spark, sf, k):
    words = std(TF.Unique()).array(F.col("text"))
    per_doc = texts(spark, sf, None, "lang").select("lang", F.explode(words).alias("t")).select("lang", "t.token")
    return D.frequent_words(per_doc, k)


@register("derive_stopwords", f"SELECT * FROM ({_TOP_WORDS}) s4 WHERE rank <= 25")
def derive_stopwords(spark, sf):
    return top_words(spark, sf, 25).withColumn("rank", F.col("rank").cast("bigint"))


@register(
    "an_language",
    f"""WITH tok AS (SELECT _id, lang, position, CASE WHEN lang = 'fr' THEN regexp_replace(token, '^(?:l|m|t|qu|n|s|j|d|c|jusqu|quoiqu|lorsqu|puisqu)[''’]', '') ELSE token END AS token FROM ({_LANG_TOKENS}) s1),
    stops AS (SELECT lang, token FROM ({_TOP_WORDS}) s4 WHERE rank <= 20),
    stems AS (SELECT DISTINCT lang, token, left(token, length(token) - 3) AS stem FROM tok WHERE lang = 'en' AND token LIKE '%ing' AND length(token) > 5)
    SELECT t.lang, coalesce(m.stem, t.token) AS token, count(*) AS n, CAST(sum(t.position) AS BIGINT) AS pos_sum
    FROM tok t LEFT JOIN stems m ON m.lang = t.lang AND m.token = t.token
    WHERE NOT EXISTS (SELECT 1 FROM stops s WHERE s.lang = t.lang AND s.token = t.token) GROUP BY 1, 2""",
)
def an_language(spark, sf):
    """Rules by the row's language: elision, then stop and stem *tables* derived from the corpus."""
    elide = TF.Elision(A.ELISIONS["fr"])
    plain, french = std().array(F.col("text")), std(elide).array(F.col("text"))
    docs = texts(spark, sf, None, "lang")
    tokens = docs.select("_id", "lang", F.explode(F.when(F.col("lang") == "fr", french).otherwise(plain)).alias("t")).select("_id", "lang", "t.*")
    stops = top_words(spark, sf, 20).select("lang", "token")
    per_token = tokens.groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"), F.sum("position").cast("bigint").alias("pos_sum"))
    stems = per_token.where((F.col("lang") == "en") & F.col("token").endswith("ing") & (F.length("token") > 5)).select(
        "lang", "token", F.expr("left(token, length(token) - 3)").alias("stem")
    )
    # the tables meet the combined tokens, not every occurrence
    left = D.stem_by_table(D.stop_by_table(per_token, stops), stems)
    return left.groupBy("lang", "token").agg(F.sum("n").alias("n"), F.sum("pos_sum").alias("pos_sum"))


@register(
    "normalizer",
    f"SELECT CAST(c_custkey AS VARCHAR) AS _id, {sql_table('lower(regexp_replace(c_mktsegment, ' + q('[AEIOU]') + ', ' + q('É') + '))', charmaps.LATIN_FOLDING)} AS segment, translate(upper(c_name), '#', '_') AS name FROM customer",
)
def normalizer(spark, sf):
    settings = A.AnalysisSettings(
        char_filter={"hash": {"type": "mapping", "mappings": ["# => _"]}, "accent": {"type": "pattern_replace", "pattern": "[AEIOU]", "replacement": "É", "all": False}},
        normalizer={"folded": {"char_filter": ["accent"], "filter": ["lowercase", "asciifolding"]}, "upper": {"char_filter": ["hash"], "filter": ["uppercase"]}},
    )
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("_id"),
        settings.get_normalizer("folded").apply(F.col("c_mktsegment")).alias("segment"),
        settings.get_normalizer("upper").apply(F.col("c_name")).alias("name"),
    )
