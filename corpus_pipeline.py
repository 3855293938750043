"""A corpus made ready for training: toxic documents out, copies out, mixed, packed.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``.

* ``toxicity``: documents scored at 0.3 or more go; rows without doc_id stay if their text does.
* ``exact_dedup``: of equal texts the row with the largest doc_id stays.
* ``near_dedup``: of each group of near copies (``SIMILAR`` % of their shingles in common) the row
  with the smallest doc_id stays.
* ``mixing``: no document goes; those of domains below their weight are repeated, as often as their
  rate says, so the domains' tokens meet the weights.
* ``packing``: one row for each piece, with its sequence and offset.

Columns beyond the usual ones pass through, whatever their names. A null text counts as empty.
"""

import public_tokenizers
from pyspark.sql import functions as F

from stillwell.llm.common import ROW, free_name, keyed, likely, stored

#: Shares of the tokens by domain in the mix. What the first stage left of toxic texts is no domain
#: of its own: their labels are not used.
WEIGHTS = {"good": 0.85, "poor": 0.15}
#: Near copies share so many percent of their shingles of five words.
SIMILAR = 80


def _with_key(docs):
    """The rows with a key of their own, and the narrow table that operators work on."""
    key = free_name(docs, ROW)
    rows = keyed(docs, key)
    narrow = rows.select(F.col(key).alias(ROW), F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text"))
    return rows, narrow, key



def _without(rows, key, lost):
    """The rows whose key is not in ``lost`` (a column named ``ROW``). Only rows that a filter takes
    for lost are joined, so the texts of the others are not shuffled."""
    lost = stored(lost.select(F.col(ROW).alias(key)), "lost")
    doubtful = likely(lost, key)(F.col(key))
    kept = rows.filter(doubtful).join(lost, key, "left_anti")
    return rows.filter(~doubtful).unionByName(kept).drop(key)


def toxicity(spark, docs, sf_dir):
    from stillwell.llm.toxicity import held_out, scored
    rows, narrow, key = _with_key(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = scored(narrow, labels, ~held_out(F.col("doc_id"))).filter("predicted = 1")
    return _without(rows, key, toxic)


def exact_dedup(spark, docs, sf_dir):
    from stillwell.llm.exact_dedup import duplicates
    rows, narrow, key = _with_key(docs)
    lost = duplicates(narrow).filter(F.col(ROW) != F.col("keep_row"))
    return _without(rows, key, lost)


def near_dedup(spark, docs, sf_dir):
    from stillwell.llm.near_dedup import near_duplicates
    rows, narrow, key = _with_key(docs)
    lost = near_duplicates(narrow, SIMILAR).filter(F.col(ROW) != F.col("component_row"))
    return _without(rows, key, lost)


def mixing(spark, docs, sf_dir):
    from stillwell.llm.mixing import domains_of, mixed_rates
    rows, narrow, key = _with_key(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    domains = domains_of(labels).filter(F.col("domain").isin(*WEIGHTS))
    copies = mixed_rates(narrow, domains, WEIGHTS, least=1.0)
    times = free_name(rows, "_more")
    more = stored(copies.filter("copies > 1").select(
        F.col(ROW).alias(key), (F.col("copies") - 1).alias(times)), "copies")
    repeated = rows.filter(likely(more, key)(F.col(key))).join(more, key)
    repeated = repeated.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return rows.drop(key).unionByName(repeated.drop(key, times))


def packing(spark, docs, sf_dir):
    from stillwell.llm.packing import best_fit_packing
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"),
                            ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]

#: Nearest neighbours, trees, tokens and fits are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, name)
    return docs
