"""BPE encoding and decoding of tables (see ``bpe`` for the method)."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.llm.bpe import decode_ids, encode_texts
from textloom.llm.catalog import id_and_text, register, table
from textloom.llm.text import chunks, slices, texts_of

RANKS = "byte_bpe_50k.tiktoken"


def encode_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """``doc_id, ids`` and, if asked, ``decoded``: one row per input row, without any shuffle.

    ``ids`` holds little-endian unsigned 32-bit integers; ``decoded`` the bytes that these ids
    stand for. Null and empty texts have no ids. Whole texts are encoded, of any length.
    """
    source = id_and_text(docs, id_col, text_col)

    def encode(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            for lo, hi in chunks(texts):
                ids, firsts = encode_texts(path, texts[lo:hi])
                parts = [ids[a:b] for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
                columns = [batch.column(0)[lo:hi], pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())]
                if decode:
                    columns.append(pa.array([decode_ids(path, p) for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(encode, f"doc_id {kind}, ids binary" + (", decoded binary" if decode else ""))


def decode_table(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded``: the bytes of each row's ids (null ids: empty)."""
    source = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def decode(batches):
        for batch in batches:
            parts = [decode_ids(path, np.frombuffer(x or b"", "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], names=["doc_id", "decoded"])

    return source.mapInArrow(decode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, decoded binary")


@register("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_table(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), decode=True)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
