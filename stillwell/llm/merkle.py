"""A Merkle manifest of a table: one tree per source, and a tree over the sources' roots.

Leaves are numbered within their tree by a range sort, so a tree may span any number of tasks.
Aligned builders take ``BLOCK`` consecutive leaves each (a power of ``ARITY``) and append nodes to
their part of the log in the order of completion: a node follows its last child. So the place of
any node follows from the sizes of the subtrees before it (``place``), and the root comes last. The
roots of the blocks are the leaves of the next round, until one node of each tree is left.

Proofs go down the rounds again: what lies above a block's root is known for all its leaves, and the
siblings within the block stand at their computed places in its part of the log. A path holds, level
by level, how many siblings lie left and right of the node, and their digests.

Cases: null columns enter a leaf as ``-``; a null source is a tree of its own, before all others;
null doc_ids come first in their source and are never tampered with; rows of one doc_id are ordered
by their digest, and equal rows are leaves of their own; further columns are ignored; an empty
table gives an empty result.
"""

import hashlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from stillwell.llm.common import map_arrow, stored

ARITY = 3
LEVELS = 6
BLOCK = ARITY ** LEVELS
SIZE = 32  # bytes of a digest


def node(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while ARITY ** levels < leaves:
        levels += 1
    return levels


def appended(leaves: list[bytes], levels: int) -> list[bytes]:
    """All nodes of the tree over ``leaves``, in the order of completion."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def complete(level: int) -> None:
        log.append(node(waiting[level]))
        waiting[level] = []
        waiting[level + 1].append(log[-1])

    for leaf in leaves:
        log.append(leaf)
        waiting[0].append(leaf)
        level = 0
        while level < levels and len(waiting[level]) == ARITY:
            complete(level)
            level += 1
    for level in range(levels):
        if waiting[level]:
            complete(level)
    return log


def place(level: int, number: int, leaves: int, levels: int) -> int:
    """Where the log holds a node of a tree over ``leaves``.

    A full node follows all that was complete before its last leaf, that leaf, and the nodes that
    the same leaf completes below it. The others come last, from the lowest level up."""
    last = (number + 1) * ARITY ** level
    if last <= leaves:
        return sum((last - 1) // ARITY ** j for j in range(levels + 1)) + level
    return (sum(leaves // ARITY ** j for j in range(levels + 1))
            + sum(leaves % ARITY ** j > 0 for j in range(1, level)))


def siblings(log: bytes, leaves: int, levels: int) -> list[list[bytes]]:
    """For each level below the root and each node of it: the siblings, behind their numbers on
    the left and on the right."""
    out = []
    for level in range(levels):
        nodes = -(-leaves // ARITY ** level)
        at = [SIZE * place(level, i, leaves, levels) for i in range(nodes)]
        digests = [log[a:a + SIZE] for a in at]
        steps = []
        for i in range(nodes):
            first = i - i % ARITY
            left, right = digests[first:i], digests[i + 1:first + ARITY]
            steps.append(bytes((len(left), len(right))) + b"".join(left + right))
        out.append(steps)
    return out


def steps_of(path: bytes):
    """(left siblings, right siblings) of each level of a path."""
    at = 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        held = [path[at + 2 + SIZE * i:at + 2 + SIZE * (i + 1)] for i in range(left + right)]
        yield held[:left], held[left:]
        at += 2 + SIZE * (left + right)


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings of its path make."""
    for left, right in steps_of(path):
        leaf = node([*left, leaf, *right])
    return leaf


def proof_digest(path: bytes) -> bytes:
    """Digest of the siblings of a path."""
    return node([digest for left, right in steps_of(path) for digest in left + right])


def field_digest(*columns: Column) -> Column:
    """Digest of columns: each as its size in bytes, a colon and its value, or ``-`` if null."""
    texts = [c.cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts]), 256))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``index`` of each row in its ``tree`` and the tree's number of rows ``n``."""
    by = [F.col("tree").asc(), *(F.col(c).asc_nulls_first() for c in order)]
    spread = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    spread = stored(spread.withColumn("at", F.monotonically_increasing_id()), "leaves")
    spread = spread.withColumn("task", F.shiftright("at", 33))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each tree and task that meet: each tree's rows here number at most the tasks.
    starts = spread.groupBy("tree", "task").agg(
        F.count(F.lit(1)).alias("held"), F.min("at").alias("first"))
    starts = stored(starts.select(
        "tree", "task", (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first"))
        .alias("shift"), F.sum("held").over(whole).alias("n")), "starts")
    return spread.join(starts, ["tree", "task"]).withColumn(
        "index", F.col("at") + F.col("shift")).drop("at", "task", "shift")


def built(leaves: DataFrame) -> DataFrame:
    """One row per block: tree, block, n, rows, log. ``leaves``: tree, index, n, digest, row."""
    def build(batches):
        for b in batches:
            logs = []
            for n, digests in zip(b["n"].to_pylist(), b["digests"].to_pylist()):
                levels = height(n) if n <= BLOCK else LEVELS
                logs.append(b"".join(appended(digests, levels)))
            yield {c: b[c] for c in ("tree", "block", "n", "rows")} | {"log": logs}

    member = F.struct("index", "digest", "row")
    blocks = leaves.groupBy("tree", F.floor(F.col("index") / BLOCK).alias("block"), "n").agg(
        F.sort_array(F.collect_list(member)).alias("members")).select(
        "tree", "block", "n", F.col("members.digest").alias("digests"),
        F.col("members.row").alias("rows"))
    row = leaves.schema["row"].dataType.simpleString()
    return stored(map_arrow(
        blocks, build, f"tree string, block long, n long, rows array<{row}>, log binary", rows=64),
        "blocks")


def root_of(log="log") -> Column:
    return F.substring(log, -SIZE, SIZE)


def forest(rows: DataFrame, order: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, and the root of each tree. ``rows``: tree, digest, row and the
    columns of ``order``."""
    leaves, rounds, roots = placed(rows, order), [], None
    while True:
        blocks = built(leaves.select("tree", "index", "n", "digest", "row"))
        rounds.append(blocks)
        ended = blocks.filter(F.col("n") <= BLOCK).select("tree", root_of().alias("root"))
        roots = ended if roots is None else roots.unionByName(ended)
        higher = blocks.filter(F.col("n") > BLOCK)
        if higher.isEmpty():
            return rounds, roots
        leaves = higher.select(
            "tree", F.col("block").alias("index"), F.ceil(F.col("n") / BLOCK).alias("n"),
            root_of().alias("digest"), F.col("block").alias("row"))


def paths(rounds: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The path of every leaf: tree, row, leaf, path. ``ends``: the path above each tree's root."""
    above = None
    for at in range(len(rounds) - 1, -1, -1):
        blocks, row = rounds[at], rounds[at].schema["rows"].dataType.elementType.simpleString()
        joined = blocks.filter(F.col("n") <= BLOCK).join(ends.select("tree", "path"), "tree")
        if above is not None:
            upper = above.select("tree", F.col("row").alias("block"), "path")
            joined = joined.unionByName(
                blocks.filter(F.col("n") > BLOCK).join(upper, ["tree", "block"]))

        def extract(batches):
            for b in batches:
                counts = b["rows"].value_lengths().to_pylist()
                leaves, made = [], []
                for n, held, log, path in zip(b["n"].to_pylist(), counts, b["log"].to_pylist(),
                                              b["path"].to_pylist()):
                    levels = height(n) if n <= BLOCK else LEVELS
                    steps = siblings(log, held, levels)
                    for i in range(held):
                        start = SIZE * place(0, i, held, levels)
                        leaves.append(log[start:start + SIZE])
                        made.append(b"".join(s[i // ARITY ** j] for j, s in enumerate(steps))
                                    + path)
                tree = b["tree"].take([i for i, c in enumerate(counts) for _ in range(c)])
                yield {"tree": tree, "row": b["rows"].flatten(), "leaf": leaves, "path": made}

        above = map_arrow(joined.select("tree", "n", "rows", "log", "path"), extract,
                          f"tree string, row {row}, leaf binary, path binary", rows=16)
        if at:
            above = stored(above, "paths")
    return above


def manifest(rows: DataFrame, tree: str, order: list[str]) -> tuple[DataFrame, bytes | None]:
    """Path and roots of every row: row, leaf, subroot, path; and the root over all trees.

    ``rows`` has ``digest`` (the leaf), ``row`` (carried along), the string column ``tree`` (null is
    a tree too) and the columns of ``order``."""
    # Null comes before every text, and other texts keep their order.
    keyed = rows.withColumn("tree", F.coalesce(F.concat(F.lit("+"), F.col(tree)), F.lit("")))
    rounds, roots = forest(keyed, order)
    roots = stored(roots, "roots")
    top = roots.select(F.lit("").alias("tree"), F.col("tree").alias("own"),
                       F.col("root").alias("digest"), F.col("tree").alias("row"))
    upper, end = forest(top, ["own"])
    found = end.first()
    ends = end.select("tree", F.lit(b"").alias("path"))
    ends = stored(paths(upper, ends).select(
        F.col("row").alias("tree"), F.col("leaf").alias("subroot"), "path"), "ends")
    return (paths(rounds, ends).join(ends.select("tree", "subroot"), "tree"),
            None if found is None else bytes(found["root"]))


def tamper_check(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each document, where the
    line feeds of every text whose doc_id has an even CRC-32 are gone when its proof is checked."""
    doc_id = F.col("doc_id").cast("long")
    own = [doc_id, F.col("source").cast("string"), F.col("lang").cast("string"),
           F.col("n_chars").cast("long")]
    text = F.col("text").cast("string")
    tampered = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))
    narrow = docs.select(
        doc_id.alias("doc_id"), own[1].alias("source"), field_digest(*own, text).alias("digest"),
        F.when(tampered & text.contains("\n"), field_digest(*own, F.replace(
            text, F.lit("\n"), F.lit("")))).alias("changed"))
    rows = narrow.withColumn("row", F.struct("doc_id", "changed"))
    proofs, root = manifest(rows, "source", ["doc_id", "digest"])

    def check(batches):
        for b in batches:
            changed, leaf = b["changed"].to_pylist(), b["leaf"].to_pylist()
            path = b["path"].to_pylist()
            made = [folded(c or own, p) for c, own, p in zip(changed, leaf, path)]
            yield {"doc_id": b["doc_id"], "leaf": [d.hex() for d in leaf],
                   "subroot": [d.hex() for d in b["subroot"].to_pylist()],
                   "root": [root.hex()] * len(leaf),
                   "proof_sha256": [proof_digest(p).hex() for p in path],
                   "folded_root": [d.hex() for d in made], "verified": [d == root for d in made]}

    return map_arrow(
        proofs.select("row.doc_id", "row.changed", "leaf", "subroot", "path"), check,
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean", rows=2048)
