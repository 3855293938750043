"""Hard negatives by coordinate pruning of length buckets.

Rows are sorted by label and length and cut into buckets of equal size, however many rows a label
or a length has. An index row per bucket holds its vectors and, for each coordinate, the places of
its unit vectors in the order of that coordinate. Anchors come in blocks, by the buckets they lie in,
and a block meets only the buckets whose labels and greatest length can serve it.

A score of at least ``t`` needs a cosine of at least ``t`` / (length of the anchor x greatest length in
the bucket). That bounds each coordinate of a fitting unit vector to a range around the anchor's
own. The ranges of the anchor's ``FOCUS`` largest coordinates are looked up in the sorted lists, the
shortest run of them is cut down by the others, and what is left is verified by exact products.
Where no range excludes anything, the whole bucket is verified. Positives come first: the anchor's
own bucket gives the threshold for the others. The scores allowed for a positive's negatives give
the threshold of the second search.

Components become ``floor(scale * x)``. Cases: rows with a null id, label or vector, or with null or
non-finite components, take no part, nor do those of length 2^31 and more, whose products leave
the range of a long; empty vectors score 0, and shorter ones count as filled up with zeros; a row
that repeats id, label and vector is one row; an anchor never meets rows of its own id; ties go to
the smaller id; a negative positive score allows no negative, and a zero one only zeros; anchors
without positives give no rows; further columns are ignored; an empty table gives an empty result.
"""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from stillwell.llm.common import map_arrow, stored

FOCUS = 4
SMALLEST, LARGEST, BUCKETS = 2048, 16384, 256
RUN = 8  # buckets whose anchors make a block
ASKED = 256
ANY = -2.0 ** 62


def integral(embeddings: DataFrame, scale: int) -> DataFrame:
    """id, label, vector (little-endian 32-bit) and length of rows that take part, each once."""
    def pack(batches):
        for b in batches:
            lists, out = b["embedding"], {c: [] for c in ("id", "label", "vector", "length")}
            values = lists.flatten()
            valid = np.asarray(values.is_valid())
            values = np.floor(scale * values.fill_null(0.0).to_numpy(zero_copy_only=False))
            valid &= np.isfinite(values)
            sizes = lists.value_lengths().to_pylist()
            at = 0
            for i, label, size in zip(b["vec_id"].to_pylist(), b["label"].to_pylist(), sizes):
                if size is None:
                    continue
                x, whole = values[at:at + size], valid[at:at + size].all()
                at += size
                if i is None or label is None or not whole:
                    continue
                length = math.hypot(*x.tolist())
                if length < 2 ** 31:
                    for name, value in zip(out, (i, label, x.astype("<i4").tobytes(), length)):
                        out[name].append(value)
            yield out

    narrow = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    return map_arrow(narrow, pack, "id long, label long, vector binary, length double",
                     rows=2048).distinct()


def in_buckets(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with a ``key`` and the number of their bucket, in the order of label and length."""
    by = [F.col("label").asc(), F.col("length").desc(), F.col("id").asc(), F.col("vector").asc()]
    spread = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        "key", F.monotonically_increasing_id()), "sorted")
    task = F.shiftright("key", 33)
    held = dict(spread.groupBy(task).count().collect())  # a figure for each task
    total, before = 0, []
    for t in sorted(held):
        before.append((t, total - (t << 33)))
        total += held[t]
    size = min(LARGEST, max(SMALLEST, total // BUCKETS))
    if not total:
        return spread.withColumn("bucket", F.lit(0).cast("long")), 0
    shift = rows.sparkSession.createDataFrame(before, "task long, shift long")
    place = F.col("key") + F.col("shift")
    placed = spread.withColumn("task", task).join(F.broadcast(shift), "task").withColumn(
        "bucket", F.floor(place / F.lit(size))).drop("task", "shift")
    return placed, -(-total // size)


def matrix(vectors: list[bytes], width: int | None = None) -> np.ndarray:
    width = max((len(v) // 4 for v in vectors), default=0) if width is None else width
    out = np.zeros((len(vectors), width), np.int32)
    for i, v in enumerate(vectors):
        x = np.frombuffer(v, "<i4")
        out[i, :len(x)] = x
    return out


def indexed(placed: DataFrame) -> DataFrame:
    """One row per bucket: ids, labels, vectors, and the places in the order of each coordinate."""
    def build(batches):
        for b in batches:
            for i, (bucket, rows) in enumerate(zip(b["bucket"].to_pylist(), b["rows"].to_pylist())):
                x = matrix([r["vector"] for r in rows])
                order = np.argsort(unit(x), axis=0, kind="stable").astype(np.uint16)
                labels = [r["label"] for r in rows]
                yield {"bucket": [bucket], "ids": [[r["id"] for r in rows]], "labels": [labels],
                       "width": [x.shape[1]], "vectors": [x.tobytes()],
                       "orders": [np.ascontiguousarray(order.T).tobytes()],
                       "low": [min(labels)], "high": [max(labels)],
                       "longest": [max(r["length"] for r in rows)]}

    row = F.struct("id", "label", "vector", "length")
    return stored(map_arrow(
        placed.groupBy("bucket").agg(F.collect_list(row).alias("rows")), build,
        "bucket long, ids array<long>, labels array<long>, width int, vectors binary, "
        "orders binary, low long, high long, longest double", rows=4), "index")


def unit(x: np.ndarray) -> np.ndarray:
    """Integral vectors at length 1; zero stays zero."""
    x = x.astype(np.float64)
    return x / np.maximum(1.0, np.sqrt((x * x).sum(axis=1, keepdims=True)))


class Bucket:
    """An index row in a task."""

    def __init__(self, ids, labels, vectors: bytes, width: int, orders: bytes):
        self.ids, self.labels = np.array(ids, np.int64), np.array(labels, np.int64)
        self.x = np.frombuffer(vectors, np.int32).reshape(len(ids), width)
        self.orders = np.frombuffer(orders, np.uint16).reshape(width, len(ids))
        self.unit = unit(self.x)
        self.lengths = np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(self.lengths.max())

    def ranges(self, asks: np.ndarray, cosines: np.ndarray):
        """Focus coordinates of each asking unit vector, and the feasible range on each."""
        k = min(FOCUS, self.x.shape[1])
        width = min(self.x.shape[1], asks.shape[1])
        focus = np.argsort(-np.abs(asks[:, :width]), axis=1, kind="stable")[:, :k]
        own = np.arccos(np.clip(np.take_along_axis(asks, focus, axis=1), -1, 1))
        reach = np.arccos(np.clip(cosines, -1, 1))[:, None]
        low = np.where(own + reach >= np.pi, -1.0, np.cos(own + reach)) - 1e-9
        high = np.where(reach >= own, 1.0, np.cos(own - reach)) + 1e-9
        return focus, low, high

    def fitting(self, asks: np.ndarray, lengths: np.ndarray, least: np.ndarray):
        """For each asking vector: the places that can reach its least score, None for all."""
        cosines = least / np.maximum(1.0, lengths * self.longest) - 1e-9
        found: list = [None] * len(asks)
        for i in np.flatnonzero(cosines > 1):
            found[i] = np.zeros(0, np.int64)
        if not self.x.shape[1] or not asks.shape[1]:
            return found
        focus, low, high = self.ranges(asks, cosines)
        inside = (low > self.unit.min(axis=0)[focus]) | (high < self.unit.max(axis=0)[focus])
        for i in np.flatnonzero(inside.any(axis=1) & (cosines <= 1) & (cosines > 0)):
            runs = []
            for f, lo, hi in zip(focus[i], low[i], high[i]):
                values = self.unit[self.orders[f], f]
                runs.append((np.searchsorted(values, lo), np.searchsorted(values, hi, "right")))
            best = min(range(len(runs)), key=lambda r: runs[r][1] - runs[r][0])
            places = self.orders[focus[i][best]][runs[best][0]:runs[best][1]].astype(np.int64)
            if 2 * len(places) > len(self.ids):
                continue  # a product over the whole bucket is cheaper
            for f, lo, hi in zip(focus[i], low[i], high[i]):
                value = self.unit[places, f]
                places = places[(value >= lo) & (value <= hi)]
            found[i] = places
        return found

    def scores(self, asks: np.ndarray, lengths: np.ndarray, least: np.ndarray):
        """(number of the asking vector, places, exact scores) of the places that can fit."""
        width = max(self.x.shape[1], asks.shape[1])
        asks = np.pad(asks, ((0, 0), (0, width - asks.shape[1])))
        own = np.pad(self.x, ((0, 0), (0, width - self.x.shape[1])))
        # Doubles hold all sums of products below 2^53 exactly.
        exact = float(lengths.max()) * self.longest < 2 ** 52
        kind = np.float64 if exact else np.int64
        own, every = own.astype(kind), np.arange(len(self.ids))
        for lo in range(0, len(asks), ASKED):
            part = asks[lo:lo + ASKED]
            found = self.fitting(unit(part), lengths[lo:lo + ASKED], least[lo:lo + ASKED])
            whole = [i for i, f in enumerate(found) if f is None]
            made = part[whole].astype(kind) @ own.T
            for n, i in enumerate(whole):
                yield lo + i, every, made[n].astype(np.int64)
            for i, places in enumerate(found):
                if places is not None and len(places):
                    yield lo + i, places, (own[places] @ part[i].astype(kind)).astype(np.int64)


def first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by id."""
    places = np.arange(len(ids))
    if len(ids) > k:
        cut = np.partition(scores, len(ids) - k)[len(ids) - k]
        places = np.flatnonzero(scores >= cut)
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def in_blocks(anchors: DataFrame, more: list[Column | str]) -> DataFrame:
    """One row per block of anchors, with what decides which buckets it asks."""
    member = F.struct("key", "bucket", "id", "label", "vector", "length", "least", *more)
    return stored(anchors.groupBy(F.floor(F.col("bucket") / RUN).alias("block")).agg(
        F.collect_list(member).alias("anchors"), F.min("label").alias("from_label"),
        F.max("label").alias("to_label"), F.max("length").alias("reach"),
        F.min("least").alias("needs")), "blocks")


def asked(blocks: DataFrame, index: DataFrame, buckets: Column, meets: Column) -> DataFrame:
    """Each block beside each of the ``buckets`` that it ``meets``."""
    kinds = index.select("bucket", "low", "high", "longest")
    pairs = (blocks.drop("anchors").withColumn("bucket", F.explode(buckets)).join(kinds, "bucket")
             .filter(meets & (F.col("needs") <= F.col("reach") * F.col("longest") * (1 + 1e-9) + 1))
             .select("block", "bucket"))
    payload = index.select("bucket", "ids", "labels", "width", "vectors", "orders")
    return pairs.join(blocks.select("block", "anchors"), "block").join(payload, "bucket")


def met(batches):
    """(number of the bucket, bucket, anchors) of each row of ``asked``."""
    for b in batches:
        names = ("bucket", "ids", "labels", "vectors", "width", "orders", "anchors")
        for number, *held, anchors in zip(*(b[c].to_pylist() for c in names)):
            bucket = Bucket(*held)
            lengths = np.array([a["length"] for a in anchors])
            least = np.array([a["least"] for a in anchors], np.float64)
            yield number, bucket, anchors, matrix([a["vector"] for a in anchors]), lengths, least


def positives(blocks: DataFrame, index: DataFrame, buckets: Column, k: int,
              home: bool) -> DataFrame:
    """The ``k`` best of each anchor's label: key, n (from 1), id, score. ``home``: only in the
    bucket that holds the anchor."""
    def search(batches):
        for number, bucket, anchors, asks, lengths, least in met(batches):
            out = {"key": [], "id": [], "score": []}
            own = [i for i, a in enumerate(anchors) if not home or a["bucket"] == number]
            if not own:
                continue
            for i, places, scores in bucket.scores(asks[own], lengths[own], least[own]):
                anchor = anchors[own[i]]
                fits = ((bucket.labels[places] == anchor["label"])
                        & (bucket.ids[places] != anchor["id"]))
                ids, scores = bucket.ids[places][fits], scores[fits]
                best = first(ids, scores, k)
                out["key"] += [anchor["key"]] * len(best)
                out["id"] += ids[best].tolist()
                out["score"] += scores[best].tolist()
            yield out

    near = (F.col("from_label") <= F.col("high")) & (F.col("to_label") >= F.col("low"))
    found = map_arrow(asked(blocks, index, buckets, near), search,
                      "key long, id long, score long", rows=4)
    order = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)


def allowed(score: int, least: int, most: int) -> tuple[int, int]:
    """Lowest and highest score with ``least`` * score <= 100 * it <= ``most`` * score."""
    return -(-least * score // 100), most * score // 100


def hard_negatives(embeddings: DataFrame, is_anchor: str, positive: int = 5, negative: int = 5,
                   least: int = 80, most: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``is_anchor``: SQL
    over ``id``; ``least`` and ``most``: percentages of the positive's score."""
    placed, buckets = in_buckets(integral(embeddings, scale))
    result = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    if not buckets:
        return embeddings.sparkSession.createDataFrame([], result)
    index, anchors = indexed(placed), stored(placed.filter(is_anchor), "anchors")
    every = F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))
    near = F.sequence(F.col("block") * RUN, F.least(F.col("block") * RUN + (RUN - 1),
                                                    F.lit(buckets - 1)))
    blocks = in_blocks(anchors.withColumn("least", F.lit(ANY)), [])
    seed = (positives(blocks, index, near, positive, True).filter(F.col("n") == positive)
            .select("key", F.col("score").cast("double").alias("least")))
    seeded = anchors.join(stored(seed, "seeds"), "key", "left").fillna(ANY, ["least"])
    chosen = stored(positives(in_blocks(seeded, []), index, every, positive, False), "positives")
    lists = chosen.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("positives"))
    # The least product any positive of the anchor allows; its sign is checked in the search.
    needed = F.array_min(F.transform("positives", lambda p: F.when(
        p["score"] >= 0, p["score"] * F.lit(least / 100)))) - 1
    ready = anchors.join(lists, "key").withColumn("least", needed).filter("least IS NOT NULL")

    def search(batches):
        for _, bucket, anchors, asks, lengths, needs in met(batches):
            out = {c: [] for c in ("key", "n", "anchor_id", "positive_id", "positive_score",
                                   "negative_id", "negative_score")}
            for i, places, scores in bucket.scores(asks, lengths, needs):
                anchor = anchors[i]
                bounds = [allowed(p["score"], least, most) for p in anchor["positives"]]
                lowest = min((lo for lo, hi in bounds if lo <= hi), default=None)
                if lowest is None:
                    continue
                fits = ((bucket.labels[places] != anchor["label"]) & (scores >= lowest)
                        & (bucket.ids[places] != anchor["id"]))
                ids, found = bucket.ids[places][fits], scores[fits]
                for p, (lo, hi) in zip(anchor["positives"], bounds):
                    inside = np.flatnonzero((found >= lo) & (found <= hi))
                    best = inside[first(ids[inside], found[inside], negative)]
                    for name, value in zip(out, (anchor["key"], p["n"], anchor["id"], p["id"],
                                                 p["score"])):
                        out[name] += [value] * len(best)
                    out["negative_id"] += ids[best].tolist()
                    out["negative_score"] += found[best].tolist()
            yield out

    others = ~((F.col("from_label") == F.col("high")) & (F.col("to_label") == F.col("low")))
    found = map_arrow(
        asked(in_blocks(ready, ["positives"]), index, every, others), search,
        "key long, n int, anchor_id long, positive_id long, positive_score long, "
        "negative_id long, negative_score long", rows=4)
    order = Window.partitionBy("key", "n").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= negative).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score")
