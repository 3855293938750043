"""Approximate nearest neighbours by balanced posting lists.

Vectors are cut into lists of equal size by halving a sample along the line between two means.
Vectors near a boundary lie in several lists, unless a list already taken is nearer to the next one
than the vector itself is. The lists' centroids are searched by best-first walks over an in-memory
graph, at most ``MAX_LISTS`` nodes in size. A query opens all lists whose distance is within a
ratio of the nearest one's: where a walk's ``BEAM`` ends within the ratio, all centroids are
measured. Where vectors hardly cluster that is most lists, and the search is nearly exhaustive.
Neighbouring lists are compared as one unit of up to ``BLOCK`` members, so a query is sent once for
many lists.

Nearness is the inner product: vectors get one more component that makes them equally long, which
turns the order by inner product into one by distance. Equal vectors are one entry with the
smallest ids, as many as a result can need, so a frequent vector fills no list and no task.

Cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows without
id, take no part; shorter vectors count as filled up with zeros; a row that repeats id and vector is
one row; a query never finds its own id; ties go to the smaller id; too few candidates in the open
lists open all lists; an empty table gives an empty result.
"""

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from stillwell.llm.common import Shared, map_arrow, stored
from stillwell.llm.near_dedup import grouped, runs

SAMPLE = 20_000
LIST_SIZE, MAX_LISTS = 160, 8192
DEGREE, BEAM, ENTRIES = 16, 64, 32
REPLICAS, BOUNDARY = 4, 1.15
QUERY_RATIO = 1.35
BLOCK, UNITS, ASKED = 4096, 64, 512


def usable(embeddings: DataFrame) -> DataFrame:
    """Id and vector (little-endian doubles) of rows that take part, each once."""
    def pack(batches):
        for b in batches:
            ids, vectors = [], []
            for i, v in zip(b["vec_id"].to_pylist(), b["embedding"].to_pylist()):
                if i is None or not v or None in v:
                    continue
                x = np.array(v, np.float64)
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    vectors.append((x + 0.0).tobytes())  # no negative zeros
            yield {"id": ids, "vector": vectors}

    narrow = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return map_arrow(narrow, pack, "id long, vector binary", rows=2048).distinct()


def matrix(vectors: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x = np.frombuffer(v, np.float64)
        out[i, :len(x)] = x
    return out


class Lists:
    """Centroids of the lists and a graph over them."""

    def __init__(self, sample: np.ndarray, longest: float, lists: int, seed: int = 11):
        self.longest, self.width = longest, sample.shape[1]
        rng = np.random.default_rng(seed)
        points, parts = self.lifted(sample), []
        self.halve(points, np.arange(len(points)), min(lists, len(points)), parts, rng)
        self.centroids = np.array([points[p].mean(axis=0) for p in parts], np.float32)
        n = len(parts)
        self.norms = (self.centroids ** 2).sum(axis=1)
        gaps = self.norms[:, None] - 2 * self.centroids @ self.centroids.T + self.norms
        np.fill_diagonal(gaps, np.inf)
        near = np.argsort(gaps, axis=1)[:, :min(DEGREE, n - 1)]
        far = rng.integers(0, n, (n, min(4, n)))  # a few long ways keep the graph in one piece
        self.graph = np.concatenate([near, far], axis=1).astype(np.int32)
        self.entries = rng.permutation(n)[:ENTRIES]

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors / self.longest
        rest = np.sqrt(np.maximum(0, 1 - (x ** 2).sum(axis=1)))
        return np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)

    def halve(self, points, own, lists, parts, rng) -> None:
        """Cut ``own`` into ``lists`` parts of equal size, along lines between two means."""
        if lists <= 1 or len(own) < 2:
            parts.append(own)
            return
        x = points[own]
        a, b = x[rng.integers(len(x))], x[rng.integers(len(x))]
        for _ in range(6):
            first = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
            if first.all() or not first.any():
                break
            a, b = x[first].mean(axis=0), x[~first].mean(axis=0)
        order = np.argsort(x @ (b - a), kind="stable")
        left = lists // 2
        cut = max(1, len(own) * left // lists)
        self.halve(points, own[order[:cut]], left, parts, rng)
        self.halve(points, own[order[cut:]], lists - left, parts, rng)

    def search(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest lists found for each point and their squared distances, nearest first."""
        n, m = len(points), len(self.centroids)
        beam = min(beam, m)
        seen = np.zeros((n, m), bool)
        rows = np.arange(n)[:, None]

        def distance(at):
            dots = np.einsum("nd,nkd->nk", points, self.centroids[at])
            return np.maximum(0, 1 - 2 * dots + self.norms[at])

        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        seen[rows, ids] = True
        far, opened = distance(ids), np.zeros(ids.shape, bool)
        while True:
            waiting = np.where(opened, np.inf, far)
            pick = waiting.argmin(axis=1)
            live = np.flatnonzero(np.isfinite(waiting[np.arange(n), pick]))
            if not len(live):
                break
            opened[live, pick[live]] = True
            ways = self.graph[ids[live, pick[live]]]
            ways = np.sort(ways, axis=1)
            again = np.zeros(ways.shape, bool)
            again[:, 1:] = ways[:, 1:] == ways[:, :-1]
            again |= seen[live[:, None], ways]
            seen[live[:, None], ways] = True
            more = np.full((n, ways.shape[1]), np.inf, np.float32)
            dots = np.einsum("nd,nkd->nk", points[live], self.centroids[ways])
            more[live] = np.where(again, np.inf, np.maximum(0, 1 - 2 * dots + self.norms[ways]))
            new = np.zeros(more.shape, np.int64)
            new[live] = ways
            ids = np.concatenate([ids, new], axis=1)
            far = np.concatenate([far, more], axis=1)
            opened = np.concatenate([opened, ~np.isfinite(more)], axis=1)
            if ids.shape[1] > beam:
                keep = np.argpartition(far, beam - 1, axis=1)[:, :beam]
                ids, far, opened = ids[rows, keep], far[rows, keep], opened[rows, keep]
        order = np.argsort(far, axis=1, kind="stable")
        return ids[rows, order], far[rows, order]

    def homes(self, vectors: np.ndarray):
        """(place, list, primary) of each vector in its nearest list and, near boundaries, others."""
        points = self.lifted(vectors)
        ids, far = self.search(points, 16)
        place, lists, primary = [np.arange(len(points))], [ids[:, 0]], [np.ones(len(points), bool)]
        taken = [ids[:, 0]]
        count = np.ones(len(points), int)
        for j in range(1, min(ids.shape[1], 8)):
            ok = np.isfinite(far[:, j]) & (far[:, j] <= BOUNDARY ** 2 * far[:, 0]) & (
                count < REPLICAS)
            for other in taken:
                held = other >= 0
                gap = ((self.centroids[ids[:, j]] - self.centroids[np.maximum(other, 0)]) ** 2
                       ).sum(axis=1)
                ok &= ~held | (gap >= far[:, j])
            taken.append(np.where(ok, ids[:, j], -1))
            count += ok
            at = np.flatnonzero(ok)
            place.append(at)
            lists.append(ids[at, j])
            primary.append(np.zeros(len(at), bool))
        return np.concatenate(place), np.concatenate(lists), np.concatenate(primary)

    def probes(self, vectors: np.ndarray, sizes: np.ndarray, least: int):
        """(place, list) to open for each query: all within the ratio, and with ``least`` members."""
        x = vectors / np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
        points = np.concatenate([x, np.zeros((len(x), 1))], axis=1).astype(np.float32)
        place, lists = [], []
        for lo in range(0, len(points), 256):
            part = points[lo:lo + 256]
            ids, far = self.search(part, BEAM)
            found = np.isfinite(far)
            held = np.cumsum(np.where(found, sizes[ids], 0), axis=1)
            need = np.concatenate([np.zeros((len(ids), 1)), held[:, :-1]], axis=1) < least
            open_ = found & ((far <= QUERY_RATIO ** 2 * far[:, :1]) | need)
            cut = open_[:, -1] | (held[:, -1] < least)  # the beam ended before the ratio did
            open_[cut] = False
            at, column = np.nonzero(open_)
            place.append(at + lo)
            lists.append(ids[at, column])
            for i in np.flatnonzero(cut):
                all_ = np.maximum(0, 1 - 2 * self.centroids @ part[i] + self.norms)
                order = np.argsort(all_, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                own = order[(all_[order] <= QUERY_RATIO ** 2 * all_[order[0]]) | (before < least)]
                place.append(np.full(len(own), i + lo))
                lists.append(own)
        return np.concatenate(place), np.concatenate(lists)


def units(held: np.ndarray, block: int) -> np.ndarray:
    """The unit of each list: runs of lists with up to ``block`` members in all, or one list."""
    most = min(block, max(1, int(held.sum()) // UNITS))
    out, unit, total = np.zeros(len(held), int), 0, 0
    for i, n in enumerate(held):
        if total and total + n > most:
            unit, total = unit + 1, 0
        out[i] = unit
        total += n
    return out


def best(queries: np.ndarray, entries: np.ndarray, ids: list[list[int]], k: int):
    """For each query the k nearest ids among the entries, as (query number, id, score)."""
    scores = queries @ entries.T
    keep = min(len(entries), k + 8)
    top = np.partition(scores, len(entries) - keep, axis=1)[:, -keep]
    sizes = np.array([len(i) for i in ids])
    flat, first = np.concatenate([np.array(i, np.int64) for i in ids]), np.cumsum(sizes) - sizes
    at, out_ids, out_scores = [], [], []
    for q in range(len(queries)):
        own = np.flatnonzero(scores[q] >= top[q] - 1e-9)  # ties at the edge stay in
        exact = (entries[own] * queries[q]).sum(axis=1)
        held = np.concatenate([flat[first[j]:first[j] + sizes[j]] for j in own])
        score = np.repeat(exact, sizes[own])
        order = np.lexsort((held, -score))[:k]
        at += [q] * len(order)
        out_ids += held[order].tolist()
        out_scores += score[order].tolist()
    return at, out_ids, out_scores


def nearest(embeddings: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each query. ``is_query``: over ``id``."""
    spark = embeddings.sparkSession
    rows = stored(usable(embeddings), "vectors")
    first = Window.partitionBy("vector").orderBy("id")
    entries = (rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
               .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
               .withColumn("entry", F.monotonically_increasing_id()))
    entries = stored(entries, "entries")
    queries = stored(rows.filter(is_query).join(entries.select("vector", "entry"), "vector")
                     .select(F.col("id").alias("query_id"), "entry"), "queries")
    result = "query_id long, rank int, vec_id long, score double"

    def norms(batches):
        for b in batches:
            x = [np.frombuffer(v, np.float64) for v in b["vector"].to_pylist()]
            yield {"norm": [float(np.sqrt(v @ v)) for v in x], "width": [len(v) for v in x]}

    shape = map_arrow(entries.select("vector"), norms, "norm double, width int").agg(
        F.max("norm"), F.max("width"), F.count(F.lit(1))).first()
    if not shape[2]:
        return spark.createDataFrame([], result)
    longest, width, n = shape
    share = min(1.0, SAMPLE / n)
    sample = entries.filter(F.pmod(F.xxhash64("vector"), F.lit(2**40)) < max(1, int(share * 2**40)))
    sample = [r[0] for r in sample.select("vector").limit(2 * SAMPLE).collect()]
    if not sample:
        sample = [r[0] for r in entries.select("vector").limit(1).collect()]
    lists = Lists(matrix([bytes(v) for v in sample], width), longest,
                  max(1, min(MAX_LISTS, n // LIST_SIZE)))
    model = Shared(spark, lists)

    def assign(batches):
        for b in batches:
            at, own, primary = model.value.homes(matrix(b["vector"].to_pylist(), width))
            yield {"list": own, "primary": primary} | {c: b[c].take(at) for c in (
                "entry", "vector", "ids")}

    kind = "list int, entry long, vector binary"
    postings = stored(map_arrow(entries.select("entry", "vector", "ids"), assign,
                                kind + ", ids array<long>, primary boolean"), "postings")
    sizes, held = np.zeros(len(lists.centroids), int), np.zeros(len(lists.centroids), int)
    for r in postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"),
                                          F.count_if("primary").alias("own")).collect():
        sizes[r["list"]], held[r["list"]] = r["own"], r["n"]

    unit_of = units(held, BLOCK)
    members = np.bincount(unit_of, held)

    def probe(batches):
        for b in batches:
            at, own = model.value.probes(matrix(b["vector"].to_pylist(), width), sizes, k + 1)
            at, own = np.unique(np.stack([at, unit_of[own]]), axis=1)
            yield {"unit": own, "entry": b["entry"].take(at), "vector": b["vector"].take(at)}

    asked = entries.join(queries.select("entry").distinct(), "entry").select("entry", "vector")
    probes = stored(map_arrow(asked, probe, "unit int, entry long, vector binary", rows=1024),
                    "probes")
    asking = {r["unit"]: r["n"] for r in
              probes.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Long lists fall into blocks, and so do many queries of one unit: a pair of blocks is compared
    # at a time, so its size is bounded.
    parts = spark.createDataFrame(
        [(i, -(-int(members[i]) // BLOCK), -(-asking[i] // BLOCK)) for i in asking if members[i]],
        "unit int, chunks int, blocks int")
    parts = F.broadcast(parts)
    places = F.broadcast(spark.createDataFrame(
        [(i, int(u)) for i, u in enumerate(unit_of)], "list int, unit int"))
    at = F.pmod(F.xxhash64("entry"), F.lit(2**31))
    sent = postings.join(places, "list").join(parts, "unit").select(
        "unit", (at % F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(False).alias("asks"), "entry", "vector", "ids")
    sent = sent.unionByName(probes.join(parts, "unit").select(
        "unit", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        (at % F.col("blocks")).cast("int").alias("block"),
        F.lit(True).alias("asks"), "entry", "vector",
        F.lit(None).cast("array<long>").alias("ids")))
    sent = sent.withColumn("unit", F.xxhash64("unit", "chunk", "block")).drop("chunk", "block")

    def compare(batches):
        for run in runs(batches, "unit"):
            asks = np.array(run["asks"])
            q, e = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(q) or not len(e):
                continue
            # replicas that meet in a unit count once
            e = e[np.unique([run["entry"][i] for i in e], return_index=True)[1]]
            vectors, ids = matrix(run["vector"], width), [run["ids"][i] for i in e]
            for lo in range(0, len(q), ASKED):
                part = q[lo:lo + ASKED]
                own, found, scores = best(vectors[part], vectors[e], ids, k + 1)
                yield {"entry": [run["entry"][part[i]] for i in own], "id": found, "score": scores}

    hits = map_arrow(grouped(sent, "unit"), compare, "entry long, id long, score double")
    hits = hits.groupBy("entry", "id").agg(F.max("score").alias("score"))  # met in several lists
    order = Window.partitionBy("entry").orderBy(F.desc("score"), "id")
    hits = (hits.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
            .groupBy("entry").agg(F.sort_array(F.collect_list(
                F.struct("n", "id", "score"))).alias("hits")))
    others = F.slice(F.filter("hits", lambda h: h["id"] != F.col("query_id")), 1, k)
    return queries.join(hits, "entry").select(
        "query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))
