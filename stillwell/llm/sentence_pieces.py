"""SentencePiece encoding and decoding of whole texts.

The driver reads the model's tables (bounded by its vocabulary) and broadcasts them. Tasks encode
texts by the last token of each prefix (``piece_table``), word by word where the model allows it,
and remember up to ``KNOWN_WORDS`` words and ``KNOWN_PAIRS`` pairs. Decoding gathers the bytes of all
ids of a batch at once. Nothing is shuffled; a lost task is run again from its rows.

Cases: a null or empty text has the end id only and decodes to an empty text; letters that are no
piece become their bytes; very long texts and words are encoded in linear time; null ids count as
none and decode to an empty text, ids outside the vocabulary raise an error as in the library;
repeated rows stay repeated; null doc_ids are kept; further columns are ignored; an empty table
gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stillwell.llm.common import Shared, map_arrow, utf8
from stillwell.llm.piece_table import Encoder, PieceTable, whole_letters


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and the ids of each text, the end id last."""
    table = Shared(docs.sparkSession, PieceTable(model))

    def encode(batches):
        encoder, end = Encoder(table.value), np.array([table.value.end], "<i4").tobytes()
        for b in batches:
            ids = [encoder.ids(text.decode("utf-8", "replace")) + end for text in utf8(b["text"])]
            ends = np.cumsum([0] + [len(i) // 4 for i in ids]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield {"doc_id": b["doc_id"], "ids": pa.ListArray.from_arrays(ends, values)}

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(narrow, encode, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and the text that the ids stand for."""
    table = Shared(rows.sparkSession, PieceTable(model))

    def decode(batches):
        surface, spaced = pa.array(table.value.surface, pa.binary()), table.value.spaced
        empty = np.array([not s for s in table.value.surface])
        for b in batches:
            lists = b["ids"].fill_null([])
            values = lists.flatten()
            ids = values.to_numpy(zero_copy_only=False)
            if len(ids) and not 0 <= ids.min() <= ids.max() < len(spaced):
                raise IndexError("an id is not in the vocabulary")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            made = surface.take(values)
            places = np.frombuffer(made.buffers()[1], np.int32, len(made) + 1, 4 * made.offset)
            data = memoryview(made.buffers()[2]) if len(ids) else b""
            texts = []
            for start, end in zip(ends[:-1], ends[1:]):
                # Control ids stand for nothing, but bytes on both sides make no letter together.
                stops = [start - 1, *(start + np.flatnonzero(empty[ids[start:end]])), end]
                first = next((i + 1 for i, j in zip(stops, stops[1:]) if j > i + 1), end)
                own = first < end and spaced[ids[first]]  # the encoder put a space there
                texts.append("".join(
                    whole_letters(bytes(data[places[i + 1] + (own and i + 1 == first):places[j]]))
                    for i, j in zip(stops, stops[1:])))
            yield {"doc_id": b["doc_id"], "ids": b["ids"], "text": texts}

    return map_arrow(rows.select("doc_id", "ids"), decode,
                     "doc_id long, ids array<int>, text string")


def encode_and_decode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of ``docs``."""
    return decoded(encoded(docs, model), model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
