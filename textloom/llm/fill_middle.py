"""Fill-in-middle transformation: a text is cut at two token boundaries and its parts are reordered.

The cuts are looked up by rank in a learned index of all token boundaries (``rank_index``). Each text
is worked on whole, in one pass over its row, so nothing is shuffled. The choice of cuts and form
depends on the id and the seed alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.llm import rank_index
from textloom.llm.catalog import id_and_text, register, table
from textloom.llm.text import slices

SEED = 42
#: Of a hundred documents, how many are cut, and of a hundred of these, how many have the suffix first.
CUT, SUFFIX_FIRST = 50, 80
#: The marks before each part.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_SEGMENT = "array<struct<rank:bigint,offset:bigint,slope:double>>"


def draws(doc_id: Column, seed: int = SEED) -> Column:
    """Four numbers of 32 bits from the id: the head of a digest of ``seed:id`` (null: no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)])


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def boundary_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", error: int = rank_index.ERROR) -> DataFrame:
    """``doc_id, n, segments, residuals``: the learned index of each text's token boundaries.

    ``residuals`` holds one signed byte per boundary (eight bytes from an error of 127 on), n + 1 in
    all. A null or empty text has no tokens and one boundary.
    """
    source = id_and_text(docs, id_col, text_col)
    kind = pa.list_(pa.struct([("rank", pa.int64()), ("offset", pa.int64()), ("slope", pa.float64())]))

    def build(batches):
        for batch in slices(batches):
            found = [rank_index.fit(rank_index.boundaries(_code_points(t)), error) for t in batch.column(1).to_pylist()]
            rows = [[{"rank": r, "offset": o, "slope": s} for r, o, s in zip(x.ranks.tolist(), x.offsets.tolist(), x.slopes.tolist())] for x in found]
            columns = [batch.column(0), pa.array([len(x.residuals) - 1 for x in found], pa.int64()), pa.array(rows, kind), pa.array([x.residuals.tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "segments", "residuals"])

    return source.mapInArrow(build, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n bigint, segments {_SEGMENT}, residuals binary")


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST, id_col: str = "doc_id", text_col: str = "text", error: int = rank_index.ERROR
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: one row per input row.

    ``form`` is "psm" (prefix, suffix, middle), "spm" (suffix, prefix, middle) or "plain", whose output
    is the text itself and whose lengths are null. Texts that are empty or null, or that hold a mark,
    stay plain; the output of a null text is empty. A text of blanks is one token. Parts may be empty,
    as both cuts may fall on one place. Rows with the same id get the same numbers; a null id counts as
    an id without digits. Other columns of the input are left out.
    """
    source = id_and_text(docs, id_col, text_col)
    drawn = source.withColumn("draws", draws(F.col("doc_id"), seed))

    def transform(batches):
        for batch in slices(batches):
            hashes = batch.column(2).flatten().to_numpy().reshape(-1, 4).tolist()
            sizes, forms, heads, middles, outputs = [], [], [], [], []
            for text, (h1, h2, h3, h4) in zip(batch.column(1).to_pylist(), hashes):
                ends = rank_index.boundaries(_code_points(text))
                n = len(ends) - 1
                sizes.append(n)
                if not text or h3 % 100 >= cut or PREFIX in text or SUFFIX in text or MIDDLE in text:
                    forms.append("plain"), heads.append(None), middles.append(None), outputs.append(text)
                    continue
                units = np.array(sorted((h1 % (n + 1), h2 % (n + 1))), np.int64)
                a, b = rank_index.fit(ends, error).lookup(units).tolist()
                heads.append(a), middles.append(b - a)
                head, middle, tail = text[:a], text[a:b], text[b:]
                if h4 % 100 < suffix_first:
                    forms.append("spm"), outputs.append("".join((SUFFIX, tail, PREFIX, head, MIDDLE, middle)))
                else:
                    forms.append("psm"), outputs.append("".join((PREFIX, head, SUFFIX, tail, MIDDLE, middle)))
            arrays = [pa.array(sizes, pa.int64()), pa.array(forms, pa.string()), pa.array(heads, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    id_kind = source.schema["doc_id"].dataType.simpleString()
    return drawn.mapInArrow(transform, f"doc_id {id_kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text, rebuilt from an output and its form alone.

    No part holds a mark, and a mark cannot arise where a part meets one, so the marks cut exactly.
    """
    parts = F.split(output, "<[PSM]>", -1)
    second, third, middle = F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
    return F.when(form == "psm", F.concat(second, middle, third)).when(form == "spm", F.concat(third, middle, second)).otherwise(output)


_H = ", ".join(f"('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT AS h{i + 1}" for i in range(4))

_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
e AS (SELECT doc_id, text, t, len(t) AS n, {_H} FROM d),
f AS (
  SELECT doc_id, text, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (
  SELECT doc_id, text, n, form, array_to_string(t[1:a], '') AS p, array_to_string(t[a + 1:b], '') AS m, array_to_string(t[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM g
"""


@register("op13_fill_middle", _SQL)
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
