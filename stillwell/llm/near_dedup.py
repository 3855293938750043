"""Near duplicates by a chosen-path join.

Equal sets are one set from the start. Independent trees branch the sets by min-wise tokens: a
node chooses, by a hash of its path, one or two places of the signature, and members with the same
token there share a child. Nodes within ``NODE`` members are compared exhaustively. What meets in a
node and agrees in enough of ``SIZE`` places is a candidate; candidates are linked only if their
full sets are similar enough.

How often nodes choose two places, how many places must agree and how many trees there are follow
from the threshold (``Plan``): trees are added until a pair at the threshold is found with a chance of
0.9988 six branchings deep and 0.9 at the greatest depth, 22. All trees see the same signature, so
the chance to lose it is the mean over the places it agrees in: at 85 % (13 trees) 7.7e-4 six deep and
0.097 at the greatest depth, at 80 % (18 trees) 4.8e-4 and 0.097; other candidates that join the
pair are left aside. Agreement in too few places has a chance of at most 1.6e-7 for such a pair.

Links are not listed: a group of n sets leaves at most n - 1 of them in a node, and sets that are
already connected are not compared again. Candidate groups with more shingles than one task should
hold are compared against pivots, block after block, on all executors.

Cases: null text counts as empty; texts without words link with nothing; null doc_ids come last;
rows that repeat a doc_id are judged by their own text; of equal rows one is kept.
"""

import hashlib
from math import comb

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stillwell.llm.common import (
    ROW, Shared, bloom_of, documents, map_arrow, mixed, power_of_two, stored, utf8,
)
from stillwell.llm.components import components
from stillwell.llm.shingles import Signatures, shingle_sets

SIZE = 64
TREES, NODE, DEPTH = 12, 192, 12
TASK_NODE, LEVELS = 4096, 10
TASK_SHINGLES = 2_000_000
PIVOTS, PIVOT_SHINGLES = 256, 4_000_000
DEEP, LOST, DISAGREE = 6, 1.2e-3, 1.6e-7
DEEPEST, LOST_DEEPEST = LEVELS + DEPTH, 0.1


class Plan:
    """``second`` of 1000 nodes choose a second place, so the places chosen are 1 / threshold on
    average; ``agree`` places make a candidate; with ``trees`` trees a pair at the threshold is lost
    ``DEEP`` branchings deep with a chance of at most ``LOST``, and as deep as nodes can go with one
    of at most ``LOST_DEEPEST``."""

    def __init__(self, percent: int):
        self.percent, self.second = percent, min(1000, 1000 * (100 - percent) // max(1, percent))
        self.agree, self.trees = 0, TREES
        while sum(self.agreeing(k) for k in range(self.agree + 1)) <= DISAGREE:
            self.agree += 1
        while self.trees < SIZE and (
                self.loss(DEEP) > LOST or self.loss(DEEPEST) > LOST_DEEPEST):
            self.trees += 1

    def agreeing(self, places: int) -> float:
        """The chance of a pair at the threshold to agree in so many places."""
        p = self.percent / 100
        return comb(SIZE, places) * p ** places * (1 - p) ** (SIZE - places)

    def loss(self, depth: int) -> float:
        """The chance of a pair at the threshold to share no node ``depth`` branchings deep."""
        total, two = 0.0, self.second / 1000
        for places in range(SIZE + 1):
            miss = 0.0
            for _ in range(depth):
                one = 1 - places / SIZE * (1 - miss)
                miss = (1 - two) * one + two * one * one
            total += self.agreeing(places) * miss ** self.trees
        return total


PLAN = Plan(85)


def choices(node: np.uint64, second: int = PLAN.second) -> list[int]:
    """Places of the signature by which the children of a node are told apart."""
    with np.errstate(over="ignore"):
        own = mixed(np.array([node], np.uint64) + np.arange(1, 4, dtype=np.uint64) * np.uint64(977))
    n = 2 if own[0] % np.uint64(1000) < second else 1
    return [int(x % np.uint64(SIZE)) for x in own[1:1 + n]]


def children(node: np.uint64, place: int, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        path = mixed(np.array([node], np.uint64) ^ np.uint64(place + 1))
        return mixed(tokens.astype(np.uint64) + path)


def hashed(docs: DataFrame) -> DataFrame:
    """Row key, doc_id, set size, digest and signature of each whole text."""
    signatures = Signatures(SIZE)

    def sets(batches):
        for b in batches:
            own = shingle_sets(utf8(b["text"]))
            yield {ROW: b[ROW], "doc_id": b["doc_id"], "n": [len(s) for s in own],
                   "digest": [hashlib.blake2b(s, digest_size=16).digest() for s in own],
                   "signature": [signatures.of(s).tobytes() for s in own]}

    return map_arrow(docs, sets, f"{ROW} long, doc_id long, n long, digest binary, "
                     "signature binary")


def branched(sets: DataFrame, node: str | None = None, plan: Plan = PLAN) -> DataFrame:
    """(node, rep) for the children of ``node``, or of the roots of all trees."""
    def roots(batches):
        with np.errstate(over="ignore"):
            tops = mixed(np.arange(1, plan.trees + 1, dtype=np.uint64) * np.uint64(7919))
        for b in batches:
            rep = b["rep"].to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(b["signature"].to_pylist()), np.uint32).reshape(-1, SIZE)
            for top in tops:
                for place in dict.fromkeys(choices(top, plan.second)):
                    yield {"node": children(top, place, sig[:, place]).view(np.int64), "rep": rep}

    def deeper(batches):
        for b in batches:
            nodes, reps = [], []
            for own, rep, sig in zip(b["node"].to_numpy(zero_copy_only=False).view(np.uint64),
                                     b["rep"].to_pylist(), b["signature"].to_pylist()):
                tokens = np.frombuffer(sig, np.uint32)
                for place in dict.fromkeys(choices(own, plan.second)):
                    nodes.append(children(own, place, tokens[place:place + 1])[0])
                    reps.append(rep)
            yield {"node": np.array(nodes, np.uint64).view(np.int64), "rep": reps}

    if node is None:
        return map_arrow(sets.select("rep", "signature"), roots, "node long, rep long", rows=4096)
    return map_arrow(sets.select("node", "rep", "signature"), deeper, "node long, rep long",
                     rows=4096)


def roots_of(n: int, links) -> list[int]:
    """The smallest member's number for each of ``n``, after joining the links."""
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            top[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def node_links(signatures: np.ndarray, node: np.uint64, agree: int = PLAN.agree,
               small: int = NODE, depth: int = 0, second: int = PLAN.second):
    """Links (i, j) that span the candidates within a node and its descendants."""
    n = len(signatures)
    if n <= small:
        alike = (signatures[:, None, :] == signatures[None, :, :]).sum(axis=2) >= agree
        a, b = np.nonzero(np.triu(alike, 1))
        top = roots_of(n, zip(a.tolist(), b.tolist()))
        return [(t, i) for i, t in enumerate(top) if t != i]
    if depth >= DEPTH:  # members that no branching tells apart: all against pivots
        return spanned(n, lambda i: (signatures == signatures[i]).sum(axis=1) >= agree)
    links = []
    for place in dict.fromkeys(choices(node, second)):
        keys = children(node, place, signatures[:, place])
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1], True])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi - lo > 1:
                own = order[lo:hi]
                links += [(int(own[i]), int(own[j])) for i, j in node_links(
                    signatures[own], keys[own[0]], agree, small, depth + 1, second)]
    return links


def spanned(n: int, linked) -> list[tuple[int, int]]:
    """Links that span the components of n members, ``linked(i)`` telling whom i links with.

    Each pivot is compared with all members. Once every member outside the largest component
    has been a pivot, no link between components can be left."""
    top, links, done = list(range(n)), [], np.zeros(n, bool)
    while True:
        label, size = np.unique(top, return_counts=True)
        left = np.flatnonzero(~done & (np.array(top) != label[size.argmax()]))
        if n > 1 and len(left) == 0:
            break
        if len(left) == 0:
            break
        i = int(left[0])
        done[i] = True
        new = [(i, int(j)) for j in np.flatnonzero(linked(i)) if j != i and top[j] != top[i]]
        if new:
            links += new
            top = roots_of(n, links)
    return links


def runs(batches, key: str):
    """The columns of each run of equal ``key``, from batches sorted by it."""
    kept: dict = {}
    for b in batches:
        keys = b[key].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        columns = {c: v.to_pylist() for c, v in b.items()}
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part = {c: v[lo:hi] for c, v in columns.items()}
            if kept and kept[key][0] == part[key][0]:
                for c in kept:
                    kept[c] += part[c]
            else:
                if kept:
                    yield kept
                kept = part
    if kept:
        yield kept


def grouped(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key)


def candidates(sets: DataFrame, task_node: int = TASK_NODE, plan: Plan = PLAN) -> DataFrame:
    """Links (a, b) between reps that span all candidates; ``sets``: rep, signature."""
    rows, links = branched(sets, plan=plan), []
    for level in range(LEVELS):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        met = stored(rows.join(sizes, "node"), "nodes")
        lists = (met.filter(F.col("size") <= task_node).groupBy("node")
                 .agg(F.sort_array(F.collect_list("rep")).alias("members"))
                 .groupBy("members").agg(F.min("node").alias("node")))  # met in several trees
        links.append(lists.select("node", F.explode("members").alias("rep")))
        large = met.filter(F.col("size") > task_node)
        if large.isEmpty():
            large = None
            break
        rows = branched(large.join(sets, "rep"), "node", plan)
    filled = links[0]
    for more in links[1:]:
        filled = filled.unionByName(more)

    def compare(batches):
        a, b = [], []
        for run in runs(batches, "node"):
            sig = np.frombuffer(b"".join(run["signature"]), np.uint32).reshape(-1, SIZE)
            if len(sig) == 2:
                found = [(0, 1)] if (sig[0] == sig[1]).sum() >= plan.agree else []
            else:
                found = node_links(sig, np.int64(run["node"][0]).view(np.uint64), plan.agree,
                                   second=plan.second)
            a += [run["rep"][i] for i, _ in found]
            b += [run["rep"][j] for _, j in found]
            if len(a) > 4096:
                yield {"a": a, "b": b}
                a, b = [], []
        yield {"a": a, "b": b}

    found = map_arrow(grouped(filled.join(sets, "rep"), "node"), compare, "a long, b long",
                      rows=4096)
    if large is not None:
        # Nodes that stayed too large for one task: all their members are candidates, as a star.
        tops = large.groupBy("node").agg(F.min("rep").alias("a"))
        found = found.unionByName(large.join(tops, "node").select("a", F.col("rep").alias("b")))
    return found


def similar(both, one, other, percent: int):
    return 100 * both >= percent * (one + other - both)


def set_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that span the components of sets by their full contents."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if similar(both, sizes[0], sizes[1], percent) else []
    tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.r_[0, np.cumsum(sizes)]

    def linked(i):
        held = np.zeros(len(tokens), np.int64)
        held[place[first[i]:first[i + 1]]] = 1
        return similar(np.add.reduceat(held[place], first[:-1]), sizes[i], sizes, percent)

    return spanned(len(sets), linked)


def large_links(members: DataFrame, percent: int, pivots: int = PIVOTS) -> DataFrame:
    """Links of groups too large for one task: blocks of pivots against all members, until each
    member outside the largest component of its group has been a pivot."""
    spark = members.sparkSession
    done = stored(members.select("rep").limit(0), "pivots")
    links = stored(members.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0),
                   "links")
    while True:
        labels = components(links)
        state = (members.select("group", "rep", "n").join(
            labels.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("label", F.coalesce("label", "rep")))
        sizes = state.groupBy("group", "label").agg(F.count(F.lit(1)).alias("size"))
        largest = sizes.groupBy("group").agg(
            F.max(F.struct("size", "label")).alias("top")).select("group", "top.label")
        left = (state.join(largest.withColumnRenamed("label", "top"), "group")
                .filter("label <> top").join(done, "rep", "left_anti")
                .orderBy(F.xxhash64("rep"), "rep").limit(pivots).select("rep", "n").collect())
        if not left:
            return links
        block, total = [], 0
        for r in left:
            if block and total + r["n"] > PIVOT_SHINGLES:
                break
            block.append(r["rep"])
            total += r["n"]
        own = members.filter(F.col("rep").isin(block)).select("group", "rep", "shingles").collect()
        known = Shared(spark, 
            [(r["group"], r["rep"], np.frombuffer(bytes(r["shingles"]), np.uint64)) for r in own])

        def against(batches):
            for b in batches:
                a, c = [], []
                for group, rep, raw in zip(b["group"].to_pylist(), b["rep"].to_pylist(),
                                           b["shingles"].to_pylist()):
                    values = np.frombuffer(raw, np.uint64)
                    for other, pivot, held in known.value:
                        if group == other and rep != pivot and similar(
                                len(np.intersect1d(values, held, assume_unique=True)),
                                len(values), len(held), percent):
                            a.append(pivot)
                            c.append(rep)
                yield {"a": a, "b": c}

        new = map_arrow(members.select("group", "rep", "shingles"), against, "a long, b long")
        links = stored(links.unionByName(new), "links")
        done = stored(done.unionByName(spark.createDataFrame(
            [(r,) for r in block], "rep long")), "pivots")


def near_duplicates(docs: DataFrame, percent: int = 85, *, task_node: int = TASK_NODE,
                    task_shingles: int = TASK_SHINGLES, pivots: int = PIVOTS) -> DataFrame:
    """Row key, doc_id, n_shingles, component_row, component_id of each row of ``docs`` (from
    ``documents``); rows with ``percent`` % of their shingles in common are linked."""
    rows = stored(hashed(docs), "hashed")
    distinct = stored(
        rows.filter("n > 0").groupBy("digest").agg(
            F.min(ROW).alias("rep"), F.min("doc_id").alias("rep_id"), F.first("n").alias("n"),
            F.first("signature").alias("signature")), "sets")
    groups = components(candidates(distinct.select("rep", "signature"), task_node,
                                   Plan(percent)))
    groups = stored(groups.withColumnsRenamed({"node": "rep", "label": "group"}).join(
        distinct.select("rep", "rep_id", "n"), "rep"), "groups")
    # Only candidates are hashed again for their full sets; others pass the filter by chance.
    filtered = bloom_of(groups.select("rep"), "rep", power_of_two(16 * groups.count()), 5)
    likely = Shared(docs.sparkSession, filtered)

    def full_sets(batches):
        for b in batches:
            at = np.flatnonzero(likely.value.holds(b[ROW].to_numpy(zero_copy_only=False)))
            texts = utf8(b["text"].take(at))
            yield {"rep": b[ROW].take(at),
                   "shingles": [s.tobytes() for s in shingle_sets(texts)] if len(at) else []}

    full = map_arrow(docs.select(ROW, "text"), full_sets, "rep long, shingles binary")
    sizes = groups.groupBy("group").agg(F.sum("n").alias("total"))
    members = stored(groups.join(sizes, "group").join(full, "rep").select(
        "group", "rep", "n", "total", "shingles"), "members")

    def compare(batches):
        for run in runs(batches, "group"):
            sets = [np.frombuffer(s, np.uint64) for s in run["shingles"]]
            found = set_links(sets, percent)
            yield {"a": [run["rep"][i] for i, _ in found], "b": [run["rep"][j] for _, j in found]}

    links = map_arrow(
        grouped(members.filter(F.col("total") <= task_shingles).select("group", "rep", "shingles"),
                "group"), compare, "a long, b long", rows=512)
    large = members.filter(F.col("total") > task_shingles)
    if not large.isEmpty():
        links = links.unionByName(large_links(large, percent, pivots))
    labels = components(links)
    ids = distinct.select(F.col("rep").alias("label"), F.col("rep_id").alias("label_id"))
    labels = labels.withColumnRenamed("node", "rep").join(ids, "label")
    named = stored(distinct.select("digest", "rep", "rep_id").join(labels, "rep", "left").select(
        "digest", F.coalesce("label", "rep").alias("component_row"),
        F.when(F.col("label").isNull(), F.col("rep_id")).otherwise(F.col("label_id"))
        .alias("component_id")), "named")
    filled, empty = rows.filter("n > 0"), rows.filter("n = 0")
    return filled.join(named, "digest").select(
        ROW, "doc_id", F.col("n").alias("n_shingles"), "component_row", "component_id",
    ).unionByName(empty.select(
        ROW, "doc_id", F.col("n").alias("n_shingles"), F.col(ROW).alias("component_row"),
        F.col("doc_id").alias("component_id")))


def near_dedup(table: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of ``table``."""
    return near_duplicates(documents(table), percent).select(
        "doc_id", "n_shingles", "component_id",
        (F.col(ROW) == F.col("component_row")).alias("kept"))
