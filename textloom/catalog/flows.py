"""Composed searches over the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import sqlscore as S
from textloom.catalog.common import q, register, sql_tokens
from textloom.catalog.indexes import index_for
from textloom.plans import flows

# The names are plain ASCII words, for which Soundex needs no special cases.
_CODE = "translate(upper(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230129022455012623019202')"


def _soundex(word: str) -> str:
    """Soundex in SQL: equal codes merge, also across h and w (9), vowels (0) part them."""
    codes = f"replace({_CODE.replace('(w)', f'({word})')}, '9', '')"
    for d in "123456":
        codes = f"regexp_replace({codes}, '{d}+', '{d}', 'g')"
    return f"lower(substr(rpad(substr({word}, 1, 1) || replace(substr({codes}, 2), '0', ''), 4, '0'), 1, 4))"


_SOUND_WORDS = f"list_transform(regexp_extract_all(p_name, '[a-z]+'), lambda w: {_soundex('w')})"
_WEIGHT = "CASE WHEN p_partkey % 5 <> 0 THEN p_size END"
_FIELDS = f"{S.part_field('a', 'p_name')}, {S.field('z', _SOUND_WORDS, 'part', S.PART_ID)}, p AS (SELECT {S.PART_ID} AS _id, p_name, p_type, p_brand, p_size, {_WEIGHT} AS weight FROM part)"


def _phonetic(brand: str) -> str:
    """Sum of the optional parts for the documents that pass the context filter."""
    parts = " UNION ALL ".join(
        (
            S.match("a", ["large", "widgit"], "0.8::DOUBLE"),
            S.phrase("a", ["large", "widgit"]),
            f"SELECT _id, sum(score) AS score FROM ({S.fuzzy_rows('z', ['l620', 'w323'], S.AUTO, weight='0.3::DOUBLE')}) f GROUP BY _id",
        )
    )
    return f"SELECT p._id, coalesce(sum(score), 0) AS score FROM p LEFT JOIN ({parts}) u ON u._id = p._id WHERE p_brand = {q(brand)} GROUP BY p._id"


@register(
    "x_phonetic_search",
    f"WITH {_FIELDS} SELECT p._id, round(p_size * score / 1000, 6) AS _score, p_name FROM ({_phonetic('Brand#14')}) h JOIN p ON p._id = h._id ORDER BY _score DESC, p._id LIMIT 20",
)
def x_phonetic_search(spark, sf):
    index = index_for(spark, sf, "part")
    found = flows.phonetic_search(
        index, "large widgit", ("p_name",), ("p_name",), "sounds", ("p_name.sound",), contexts=(("brand", "Brand#14"),), weight_field="p_size", size=20
    )
    return found.select("_id", "_score", "p_name")


@register(
    "x_phonetic_transformed",
    f"WITH {_FIELDS} SELECT p._id, upper(p_name) AS name FROM ({_phonetic('Brand#2')}) h JOIN p ON p._id = h._id WHERE p_size % 2 = 0 ORDER BY p_size DESC, p._id LIMIT 12",
)
def x_phonetic_transformed(spark, sf):
    index = index_for(spark, sf, "part")
    fn = lambda df: df.where("p_size % 2 = 0").select("_id", F.upper("p_name").alias("name"))
    return flows.phonetic_search_transformed(
        index, fn, (("p_size", "desc"),), 12, "large widgit", ("p_name",), ("p_name",), "sounds", ("p_name.sound",), contexts=(("brand", "Brand#2"),)
    )


def _typing(context: str = "", bonus: str = "0") -> str:
    """Text ``larje widget``: the first word filters with automatic fuzziness, the second must match."""
    return f"""SELECT m._id, m.score + coalesce(t.score, 0) + {bonus} AS score
      FROM ({S.match('a', ['widget'])}) m {context}
      JOIN (SELECT DISTINCT _id FROM ({S.fuzzy_rows('a', ['larje'], S.AUTO)}) f) fz ON fz._id = m._id
      LEFT JOIN (SELECT _id, sum(score) AS score FROM ({S.phrase('a', ['larje', 'widget'])} UNION ALL SELECT DISTINCT _id, 1::DOUBLE FROM a_tok WHERE starts_with(token, 'larje')) u GROUP BY _id) t ON t._id = m._id"""


_CONTEXT = f"JOIN ({S.match('b', ['promo', 'large'])}) x ON x._id = m._id"


@register(
    "x_as_you_type",
    f"WITH {_FIELDS}, {S.part_field('b', 'p_type')} SELECT p._id, round(coalesce(weight, 1) * score / 10, 6) AS _score, p_name FROM ({_typing(_CONTEXT, 'x.score')}) h JOIN p ON p._id = h._id ORDER BY _score DESC, p._id LIMIT 25",
)
def x_as_you_type(spark, sf):
    index = index_for(spark, sf, "part")
    found = flows.search_as_you_type(
        index, "standard", "larje widget", ("p_name",), ("p_name",), size=25, contexts=(("p_type", ["promo", "large"]),), weight_field="weight"
    )
    return found.select("_id", "_score", "p_name")


@register(
    "x_as_you_type_transformed",
    f"WITH {_FIELDS} SELECT p._id, p_brand FROM ({_typing()}) h JOIN p ON p._id = h._id WHERE p_size > 5 ORDER BY p_size, p._id LIMIT 15",
)
def x_as_you_type_transformed(spark, sf):
    index = index_for(spark, sf, "part")
    fn = lambda df: df.where("p_size > 5").select("_id", "p_brand")
    return flows.search_as_you_type_transformed(index, fn, (("p_size", "asc"),), 15, "standard", "larje widget", ("p_name",), ("p_name",))
