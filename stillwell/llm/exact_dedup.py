"""Exact duplicates by a heavy-hitter split.

Misra-Gries summaries find frequent digests, their winners are verified by an exact count and
broadcast (at most ``COUNTERS`` rows), so the rows of hot groups are judged where they lie. Only
the remaining digests are shuffled.

Cases: null text counts as empty; null doc_ids never win over others; of rows that repeat the
winning doc_id one stays; an empty table gives an empty result.
"""

import hashlib
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from stillwell.llm.common import ROW, documents, map_arrow, stored, utf8

COUNTERS = 1024


def digested(docs: DataFrame) -> DataFrame:
    """Row key, doc_id and SHA-256 of the text with A-Z lower-cased."""
    def digest(batches):
        for b in batches:
            yield {ROW: b[ROW], "doc_id": b["doc_id"],
                   "digest": [hashlib.sha256(t.lower()).digest() for t in utf8(b["text"])]}

    return map_arrow(docs, digest, f"{ROW} long, doc_id long, digest binary")


def merged(counts: Counter, size: int) -> Counter:
    """Cut a summary back to ``size`` counters: all lose what the next largest one holds."""
    if len(counts) <= size:
        return counts
    cut = sorted(counts.values(), reverse=True)[size]
    return Counter({k: n - cut for k, n in counts.items() if n > cut})


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may hold more than 2/``counters`` of all rows: at most ``counters`` of them.

    Each summary undercounts by at most its rows / (counters + 1), so every digest with so many
    rows keeps a summed count of rows / counters."""
    def summary(batches):
        kept = Counter()
        for b in batches:
            kept.update(b["digest"].to_pylist())
            kept = merged(kept, counters)
        yield {"digest": list(kept), "n": list(kept.values())}

    total = digests.count()
    sums = map_arrow(digests.select("digest"), summary, "digest binary, n long", rows=8192)
    return (sums.groupBy("digest").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= max(2, -(-total // counters))).select("digest"))


def duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs`` (from ``documents``): row key, doc_id, digest, keep_row,
    keep_id, group_size. The row with the largest doc_id is the one to keep."""
    rows = stored(digested(docs), "digests")
    best = F.max(F.struct("doc_id", ROW))

    def winners(part):
        return part.groupBy("digest").agg(
            best.alias("best"), F.count(F.lit(1)).alias("group_size"))

    candidates = stored(frequent(rows, counters), "frequent")
    hot = stored(winners(rows.join(F.broadcast(candidates), "digest")), "winners")
    cold_rows = rows.join(F.broadcast(candidates), "digest", "left_anti")
    judged = rows.join(F.broadcast(hot), "digest").unionByName(
        cold_rows.join(winners(cold_rows).hint("shuffle_merge"), "digest"))
    return judged.select(
        ROW, "doc_id", "digest", F.col(f"best.{ROW}").alias("keep_row"),
        F.col("best.doc_id").alias("keep_id"), "group_size")


def exact_dedup(table: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of each row of ``table``."""
    return duplicates(documents(table)).select(
        "doc_id", "keep_id", "group_size", (F.col(ROW) == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
