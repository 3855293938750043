"""Toxicity by nearest labelled examples.

Every text becomes a TF-IDF vector over words that the labels tie to toxicity. Its nearest labelled
examples by exact cosine come from an inverted index whose postings are cut into blocks with their
largest weight: blocks are opened in the order of their bound, until no other can hold a nearer
example. Votes weighted by nearness are calibrated on the examples themselves, each without its own
vote.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); document frequencies
cover all documents. Cases: null and empty texts, and texts without such a word, get the calibrated
share of toxic examples among examples without one; null labels teach nothing; of repeated labels
the highest counts; without any label the score is ``PRIOR`` for all; rows are judged one by one, so
repeated rows get equal scores; equal nearness is settled by the examples' words and labels, never
by their doc_id; of rows that repeat a doc_id one is an example.
"""

import math
import string
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from stillwell.llm.common import ROW, Shared, documents, map_arrow, stored

SAMPLE_ROWS = 20_000
MAX_TERMS = 4096
LEAST_DOCS = 3
PRIOR = 0.1  # share of toxic texts before any is seen, with the weight of two texts
NEIGHBOURS = 15
CALIBRATED = 2000  # examples, at most, whose votes set the calibration
BLOCK = 64
THRESHOLD = 0.3
_CUTS = bytes(32 if chr(i) in string.punctuation or i < 32 else i for i in range(256))


def words(text: str) -> list[bytes]:
    """Lower-cased words, cut at white space and ASCII punctuation."""
    return text.lower().encode("utf-8", "replace").translate(_CUTS).split()


def labelled_rows(docs: DataFrame, labels: DataFrame, learn: Column, limit: int) -> DataFrame:
    """At most about ``limit`` labelled rows of those that may be learned from: row key, toxic.

    The sample is a range of doc_id hashes, so it does not depend on partitioning."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(learn)
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    known = stored(known, "labels")
    share = limit / max(1, known.count())
    part = known
    if share < 1:
        part = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**40)) < int(share * 2**40))
    one = F.min(F.struct("text", ROW)).alias("row")  # however often a doc_id is repeated
    return stored(docs.join(F.broadcast(part), "doc_id").groupBy("doc_id", "toxic").agg(one).select(
        f"row.{ROW}", "doc_id", "row.text", "toxic"), "examples")


def surprising(found: DataFrame, base: float, looked_at: int) -> DataFrame:
    """Terms seen n times, k of them toxic, that chance does not explain: with a share of ``base``,
    so many would be toxic with a probability of at most exp(-n KL(k/n || base)); the terms stay
    for which that times the number of terms looked at is below a half."""
    n, k = F.col("n"), F.col("k")
    part = k / n
    surprise = k * F.log(part / base) + F.when(
        k < n, (n - k) * F.log((1 - part) / (1 - base))).otherwise(0.0)
    return (found.filter(part > base).withColumn("surprise", surprise)
            .filter(F.col("surprise") >= math.log(2 * max(1, looked_at))))


def toxic_terms(examples: DataFrame, limit: int = MAX_TERMS) -> list[bytes]:
    """Words tied to toxic examples, first by the examples that hold them, then by the places where
    they stand: copies bring the same neighbours along, so they count once there."""
    base = examples.agg(F.avg("toxic")).first()[0]
    if not base or base == 1:
        return []

    def counts(batches):
        n, toxic = Counter(), Counter()
        for b in batches:
            for text, label in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                own = set(words(text))
                n.update(own)
                if label:
                    toxic.update(own)
        yield {"term": list(n), "n": list(n.values()), "k": [toxic[t] for t in n]}

    first = stored(map_arrow(examples.select("text", "toxic"), counts,
                             "term binary, n long, k long")
                   .groupBy("term").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
                   .filter(F.col("n") >= LEAST_DOCS), "terms")
    looked_at = first.count()
    first = (surprising(first, base, looked_at).orderBy(F.desc("surprise"), "term")
             .limit(8 * limit).select("term").collect())
    likely = Shared(examples.sparkSession, {bytes(r["term"]) for r in first})

    def places(batches):
        seen = set()
        for b in batches:
            for text, label in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                own = [b"", *words(text), b""]
                seen |= {(own[i], own[i - 1] + b" " + own[i + 1], label)
                         for i in range(1, len(own) - 1) if own[i] in likely.value}
        made = list(zip(*seen)) or [[], [], []]
        yield {"term": made[0], "place": made[1], "toxic": made[2]}

    second = stored(map_arrow(examples.select("text", "toxic"), places,
                              "term binary, place binary, toxic int")
                    .groupBy("term", "place").agg(F.min("toxic").alias("toxic"))
                    .groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")),
                    "places")
    found = (surprising(second, base, looked_at).orderBy(F.desc("surprise"), "term").limit(limit)
             .select("term").collect())
    return [bytes(r["term"]) for r in found]


def vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Row key, doc_id, and the terms of each whole text with their counts."""
    number = Shared(docs.sparkSession, {t: i for i, t in enumerate(terms)})

    def count(batches):
        known = number.value
        for b in batches:
            ids, times = [], []
            for text in b["text"].to_pylist():
                own = Counter(known[w] for w in words(text or "") if w in known)
                ids.append(sorted(own))
                times.append([own[i] for i in ids[-1]])
            yield {ROW: b[ROW], "doc_id": b["doc_id"], "terms": ids, "times": times}

    return map_arrow(docs, count, f"{ROW} long, doc_id long, terms array<int>, times array<int>")


def content(example: tuple) -> tuple:
    doc_id, label, terms, counts = example
    return list(terms), list(counts), label, doc_id


class BlockMaxIndex:
    """Unit vectors of the examples as postings by term, cut into blocks of ``block`` examples."""

    def __init__(self, examples: list[tuple], idf: np.ndarray, block: int = BLOCK):
        """``examples``: (doc_id, label, terms, counts), none without terms."""
        # Alike examples stand together, which makes the bounds of the blocks tight. Their order
        # settles ties; doc_id only tells apart what is the same.
        examples = sorted(examples, key=content)
        self.idf, self.block = idf, block
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.labels = np.array([e[1] for e in examples], np.float64)
        self.blocks = -(-len(examples) // block)
        places, weights = {}, {}
        for at, (_, _, terms, counts) in enumerate(examples):
            for term, weight in zip(terms, self.weights(terms, counts)):
                places.setdefault(term, []).append(at)
                weights.setdefault(term, []).append(weight)
        self.postings = {}
        for term in places:
            at, weight = np.array(places[term]), np.array(weights[term])
            held, first = np.unique(at // block, return_index=True)
            self.postings[term] = (at, weight, held, np.append(first, len(at)),
                                   np.maximum.reduceat(weight, first))

    def weights(self, terms, counts) -> np.ndarray:
        raw = (1 + np.log(np.asarray(counts, float))) * self.idf[np.asarray(terms, int)]
        return raw / (np.sqrt(raw @ raw) or 1.0)

    def nearest(self, terms, counts, k: int, without: int | None = None):
        """Places and cosines of the k nearest examples, and the number of blocks opened."""
        query = [(self.postings[t], w) for t, w in zip(terms, self.weights(terms, counts))
                 if t in self.postings]
        bounds = np.zeros(self.blocks)
        for (_, _, held, _, most), weight in query:
            bounds[held] += weight * most
        order = np.argsort(-bounds, kind="stable")
        places, scores, opened, least = np.zeros(0, int), np.zeros(0), 0, -1.0
        for block in order:
            if bounds[block] <= 0 or bounds[block] + 1e-12 < least:
                break
            opened += 1
            start = block * self.block
            own = np.zeros(min(self.block, len(self.ids) - start))
            for (at, weights, held, first, _), weight in query:
                j = np.searchsorted(held, block)
                if j < len(held) and held[j] == block:
                    part = slice(first[j], first[j + 1])
                    own[at[part] - start] += weight * weights[part]
            hit = np.flatnonzero(own > 0)
            if without is not None:
                hit = hit[self.ids[hit + start] != without]
            places, scores = np.append(places, hit + start), np.append(scores, own[hit])
            if len(places) >= k:
                best = np.lexsort((places, -np.round(scores, 12)))[:k]
                places, scores = places[best], scores[best]
                least = scores[-1]
        best = np.lexsort((places, -np.round(scores, 12)))[:k]
        return places[best], scores[best], opened


class Scorer:
    """Votes of the nearest examples, weighted by nearness and calibrated."""

    def __init__(self, examples: list[tuple], idf: np.ndarray, empty: tuple[int, int]):
        """``empty``: number of examples without terms, and of toxic ones among them."""
        n, toxic = empty
        total, all_toxic = n + len(examples), toxic + sum(e[1] for e in examples)
        self.base = (all_toxic + 2 * PRIOR) / (total + 2)
        self.empty = (toxic + 2 * PRIOR) / (n + 2)
        self.index = BlockMaxIndex(examples, idf) if examples else None
        self.slope, self.shift = 1.0, 0.0
        if examples:
            step = -(-len(examples) // CALIBRATED)
            part = sorted(examples, key=content)[::step]
            own = [self.vote(e[2], e[3], e[0])[0] for e in part]
            self.slope, self.shift = calibrated(np.array(own), np.array([e[1] for e in part]))

    def vote(self, terms, counts, without=None):
        """Log-odds of the smoothed vote, and the (doc_id, cosine) pairs behind it."""
        at, cosine, _ = self.index.nearest(terms, counts, NEIGHBOURS, without)
        near = cosine ** 4
        share = (near @ self.index.labels[at] + self.base) / (near.sum() + 1)
        return math.log(share / (1 - share)), list(zip(self.index.ids[at].tolist(), cosine))

    def score(self, terms, counts):
        if not len(terms) or self.index is None:
            return self.empty, []
        vote, evidence = self.vote(terms, counts)
        return 1 / (1 + math.exp(-(self.slope * vote + self.shift))), evidence


def calibrated(x: np.ndarray, y: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the votes, held near (1, 0) by a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p)
        gradient = np.array([x @ (p - y) + (a - 1), (p - y).sum() + b])
        curve = np.array([[(w * x) @ x + 1, w @ x], [w @ x, w.sum() + 1]])
        a, b = np.array([a, b]) - np.linalg.solve(curve, gradient)
    return float(a), float(b)


def scored(docs: DataFrame, labels: DataFrame, learn: Column,
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Row key, doc_id, score, predicted and evidence (nearest examples) of each row of ``docs``
    (from ``documents``). ``learn`` says over doc_id which labels may be used."""
    examples = labelled_rows(docs, labels, learn, sample_rows)
    terms = toxic_terms(examples)
    known = stored(vectors(docs, terms), "vectors")
    n = known.count()
    seen = dict(known.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    idf = np.array([math.log((n + 1) / (seen.get(i, 0) + 1)) + 1e-3 for i in range(len(terms))])
    chosen = known.join(F.broadcast(examples.select(ROW, "toxic")), ROW)
    sums = chosen.filter(F.size("terms") == 0).agg(F.count(F.lit(1)), F.sum("toxic")).first()
    filled = chosen.filter(F.size("terms") > 0).select("doc_id", "toxic", "terms", "times")
    scorer = Scorer([tuple(r) for r in filled.collect()], idf, (sums[0], sums[1] or 0))
    model = Shared(docs.sparkSession, scorer)

    def score(batches):
        seen = {}
        for b in batches:
            scores, evidence = [], []
            for own in zip(b["terms"].to_pylist(), b["times"].to_pylist()):
                key = (tuple(own[0]), tuple(own[1]))
                if key not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen[key] = model.value.score(*key)
                value, near = seen[key]
                scores.append(value)
                evidence.append([{"doc_id": i, "cosine": c} for i, c in near])
            yield {ROW: b[ROW], "doc_id": b["doc_id"], "score": scores,
                   "predicted": [int(s >= THRESHOLD) for s in scores], "evidence": evidence}

    return map_arrow(known, score, f"{ROW} long, doc_id long, score double, predicted int, "
                     "evidence array<struct<doc_id: long, cosine: double>>", rows=4096)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(table: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence; labels of held-out rows are not learned."""
    rows = scored(documents(table), labels, ~held_out(F.col("doc_id")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       "predicted", "evidence")
