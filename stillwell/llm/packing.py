"""Packing of documents into sequences by minimum bin slack.

Tasks turn texts into ids and number their pieces within each length. Only the number of pieces of
each length reaches the driver: at most ``LIMIT`` figures. There, bins are filled one kind at a
time: the longest length left, and with it the fullest combination of the available lengths, found
by a subset-sum over bits; a kind of bin is repeated while its lengths last. Pieces then find their
bin by their number within their length.

Cases: null text counts as empty, and an empty text is the one id 0; texts longer than the limit are
cut so that only their first piece is shorter; repeated rows are packed each on its own; an empty
table gives an empty result.
"""

import base64
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from stillwell.llm.common import Shared, loaded, map_arrow, stored

LIMIT = 2048
END = b"\0\0\0\0"


class Ids:
    """Ids of texts as little-endian 32-bit words, by the library.

    ``ranks`` names the same vocabulary as a file of ranks: texts are then encoded with it, four
    times as fast and with equal ids (tests compare them over every letter); texts that hold a
    special token still go to the library."""

    def __init__(self, path: str, ranks: str | None = None):
        self.library = loaded(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.fast = None if ranks is None else by_ranks(ranks)

    def of(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            made = self.library.encode(text, add_special_tokens=False).ids
        else:
            made = self.fast.encode_to_numpy(text, disallowed_special=())
        return np.asarray(made, "<u4").tobytes()


def by_ranks(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT,
           ranks: str | None = None) -> DataFrame:
    """The pieces of all texts, each numbered within its task and length."""
    def cut(batches):
        from pyspark import TaskContext

        task, seen, ids = TaskContext.get().partitionId(), Counter(), Ids(tokenizer, ranks)
        for b in batches:
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "crc", "number")}
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                data = ids.of(text or "") + END
                n = len(data) // 4
                start, end, piece = 0, (n - 1) % limit + 1, 0
                while start < n:
                    length = end - start
                    for name, value in zip(out, (
                            doc_id, piece, start, length, zlib.crc32(data[4 * start:4 * end]),
                            seen[length])):
                        out[name].append(value)
                    seen[length] += 1
                    start, end, piece = end, end + limit, piece + 1
            yield out | {"task": [task] * len(out["doc_id"])}

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(narrow, cut, "doc_id long, piece int, start long, length long, crc long, "
                     "number long, task int")


def fullest(capacity: int, lengths: list[int], counts: dict[int, int]) -> list[int]:
    """Lengths, repeated at most as often as available, whose sum is the largest within
    ``capacity``: a subset-sum over the bits of an integer, stopped once the sum is exact."""
    mask, reach, steps = (1 << capacity + 1) - 1, 1, []
    for length in lengths:
        for _ in range(min(counts[length], capacity // length)):
            grown = reach | reach << length & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
            if reach >> capacity & 1:
                break
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def bins(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, list[int]]]:
    """(number of bins, lengths in each) for each kind of bin, until nothing is left."""
    left, kinds = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        first = max(left)
        left[first] -= 1
        held = [first, *fullest(limit - first, sorted((n for n in left if left[n] and
                                                       n <= limit - first), reverse=True), left)]
        left[first] += 1
        need = Counter(held)
        times = min(left[n] // k for n, k in need.items())
        for n, k in need.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
        kinds.append((times, held))
    return kinds


class Places:
    """Sequence and offset of the i-th piece of each length."""

    def __init__(self, kinds: list[tuple[int, list[int]]]):
        rows: dict[int, list] = {}
        base = 0
        for times, held in kinds:
            offset = 0
            for length, k in sorted(Counter(held).items(), reverse=True):
                rows.setdefault(length, []).append((times * k, k, base, offset))
                offset += k * length
            base += times
        self.of_length = {}
        for length, parts in rows.items():
            size, k, base, offset = np.array(parts, np.int64).T
            self.of_length[length] = (np.cumsum(size), size, k, base, offset)

    def find(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            upto, size, k, base, start = self.of_length[int(length)]
            part = np.searchsorted(upto, numbers[own], side="right")
            at = numbers[own] - (upto - size)[part]
            sequence[own] = base[part] + at // k[part]
            offset[own] = start[part] + at % k[part] * length
        return sequence, offset


def best_fit_packing(docs: DataFrame, tokenizer: str, limit: int = LIMIT,
                     ranks: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of ``docs``."""
    cut = stored(pieces(docs, tokenizer, limit, ranks), "pieces")
    per_task = stored(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = dict(per_task.groupBy("length").agg(F.sum("n")).collect())
    places = Shared(docs.sparkSession, Places(bins(counts, limit)))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0))
                             .alias("before"))
    # As many rows as lengths and tasks meet, so they are shuffled, not broadcast.
    numbered = cut.join(before.hint("shuffle_merge"), ["length", "task"]).withColumn(
        "number", F.col("number") + F.col("before"))

    def place(batches):
        for b in batches:
            sequence, offset = places.value.find(
                b["length"].to_numpy(zero_copy_only=False),
                b["number"].to_numpy(zero_copy_only=False))
            yield {**b, "ids_crc32": b["crc"], "sequence_id": sequence, "offset": offset}

    return map_arrow(
        numbered.select("doc_id", "piece", "start", "length", "crc", "number"), place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
        "offset long", rows=8192)
