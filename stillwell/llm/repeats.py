"""Removal of byte strings that occur earlier, by a suffix order of the collection.

A string of ``LENGTH`` bytes has an anchor: the piece of ``PIECE`` bytes in it with the smallest
hash. Equal strings have equal anchors at equal distance, so texts fall into fragments, runs of
starts with one anchor, and only fragments with equal anchors can share a string. Three passes over
the texts follow:

1. Anchors and digests of fragments are counted; anchors seen once are out.
2. Fragments with repeated anchors meet by anchor. Equal ones are one string of the collection,
   owned by their first place. Of anchors with different strings the collection's Burrows-Wheeler
   transform is built column by column (``bwt.py``); neighbours in the order of suffixes with a
   common prefix of ``LENGTH`` are the same string, and its first place stays.
3. Spans are cut out of the texts that have some.

Anchors with more than ``HOT`` different fragments would fill one task; their fragments are cut
into single strings, which meet by their own hash instead. Within a task equal fragments are
settled before the shuffle, so a frequent passage sends one row for each task.

Hashes of fragments have 64 bits beside the 64 of their anchor. Cases: null text counts as empty;
texts shorter than the string lose nothing; null doc_ids come last; rows that repeat a doc_id are
ordered by a hash of their text; an empty table gives an empty result.
"""

import hashlib
import tempfile

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stillwell.llm.bwt import Collection
from stillwell.llm.common import (
    ROW, Shared, bloom_of, documents, map_arrow, mixed, power_of_two, stored, utf8,
)
from stillwell.llm.near_dedup import grouped, runs

LENGTH, PIECE = 100, 64
HOT = 8192
SEGMENT = 1 << 20
TASK_FRAGMENTS = 1_000_000
TASK_PLACES = 250_000
STRINGS = 6000
_rng = np.random.default_rng(41)
_BYTES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE, _INVERSE = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F,
                                          pow(0xC2B2AE3D27D4EB4F, -1, 2**64)))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n + n // 8, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


class Fragments:
    """Fragments of joined texts: document number, start, number of strings, anchor, digest."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, length: int, piece: int):
        n, pieces, starts = len(data), len(data) - piece + 1, len(data) - length + 1
        self.length, self.sums = length, np.zeros(n + 1, np.uint64)
        power, self.inverse = _power(n + 1)
        np.cumsum(_BYTES[data] * power[:n], out=self.sums[1:])
        keys = self.hashes(np.arange(pieces), piece)
        # Smallest hash in each window, the first of equals: the place is in the low bits.
        ranked = keys >> np.uint64(32) << np.uint64(32) | np.arange(pieces, dtype=np.uint64)
        width = length - piece + 1
        blocks = np.concatenate([ranked, np.full(-pieces % width, 2**64 - 1, np.uint64)])
        blocks = blocks.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:starts], ahead[width - 1:width - 1 + starts])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        inside = doc[:starts] == doc[length - 1:]
        cut = (anchor[1:] != anchor[:-1]) | (doc[1:starts] != doc[:starts - 1])
        first = np.flatnonzero(inside & np.r_[True, cut | ~inside[:-1]])
        last = np.flatnonzero(inside & np.r_[cut | ~inside[1:], True])
        self.at, self.count = first, last - first + 1
        self.doc = doc[first]
        self.start = first - (np.cumsum(sizes) - sizes)[self.doc]
        self.key = keys[anchor[first]]
        self.digest = mixed(self.hashes(first, self.count + length - 1)
                            ^ (anchor[first] - first).astype(np.uint64))

    def hashes(self, at, size):
        return mixed((self.sums[at + size] - self.sums[at]) * self.inverse[at])


def fragments(texts: list[bytes], length: int, piece: int):
    """(joined bytes, fragments, starts of the segments' documents) over segments of the texts,
    long texts being cut with an overlap that leaves every string in one segment."""
    parts, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), SEGMENT):
            part = text[at:at + SEGMENT + length - 1]
            if len(part) < length:
                continue
            parts.append((number, at, part))
            size += len(part)
            if size >= SEGMENT:
                yield _joined(parts, length, piece)
                parts, size = [], 0
    if parts:
        yield _joined(parts, length, piece)


def _joined(parts, length, piece):
    data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    with np.errstate(over="ignore"):
        own = Fragments(data, np.array([len(p[2]) for p in parts]), length, piece)
    number, shift = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    own.start = own.start + shift[own.doc]
    own.doc = number[own.doc]
    return data, own


def by_bucket(keys: np.ndarray, buckets: int):
    """(bucket, places of its keys), for each bucket that has some."""
    own = (mixed(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    cuts = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1], True])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi > lo:
            yield int(own[order[lo]]), order[lo:hi]


def anchors(docs: DataFrame, length: int, piece: int, hot: int) -> DataFrame:
    """For each bucket of anchors: those seen twice, those with different fragments, and those
    with more than ``hot`` of them; and the number of fragments of the second kind."""
    buckets = max(8, 4 * docs.rdd.getNumPartitions())

    def counted(batches):
        def packed(keys, digests):
            with np.errstate(over="ignore"):
                order = np.lexsort((digests, keys))
                keys, digests = keys[order], digests[order]
                new = np.r_[True, (keys[1:] != keys[:-1]) | (digests[1:] != digests[:-1])]
                first = np.flatnonzero(new)
                twice = np.diff(np.r_[first, len(keys)]) > 1
                keys, digests = keys[first], digests[first]
                own = list(by_bucket(keys, buckets))
            return {"bucket": [b for b, _ in own],
                    "keys": [keys[i].tobytes() for _, i in own],
                    "digests": [digests[i].tobytes() for _, i in own],
                    "twice": [twice[i].tobytes() for _, i in own]}

        keys, digests, size = [], [], 0
        for b in batches:
            for _, own in fragments(utf8(b["text"]), length, piece):
                keys.append(own.key)
                digests.append(own.digest)
                size += len(own.key)
            if size > TASK_FRAGMENTS:
                yield packed(np.concatenate(keys), np.concatenate(digests))
                keys, digests, size = [], [], 0
        if size:
            yield packed(np.concatenate(keys), np.concatenate(digests))

    def met(batches):
        for run in runs(batches, "bucket"):
            keys, digests = (np.frombuffer(b"".join(run[c]), np.uint64)
                             for c in ("keys", "digests"))
            twice = np.frombuffer(b"".join(run["twice"]), bool)
            order = np.lexsort((digests, keys))
            keys, digests, twice = keys[order], digests[order], twice[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            times = np.add.reduceat(1 + twice, first)
            new = np.r_[True, (keys[1:] != keys[:-1]) | (digests[1:] != digests[:-1])]
            kinds = np.add.reduceat(new.astype(np.int64), first)
            keys = keys[first]
            yield {"bucket": run["bucket"][:1], "repeated": [keys[times > 1].tobytes()],
                   "differing": [keys[kinds > 1].tobytes()],
                   "hot": [keys[kinds > hot].tobytes()],
                   "n": [int(kinds[kinds > 1].sum())]}

    sent = map_arrow(docs.select("text"), counted,
                     "bucket int, keys binary, digests binary, twice binary")
    return map_arrow(grouped(sent, "bucket"), met, "bucket int, repeated binary, "
                     "differing binary, hot binary, n long", rows=64)


def key_filter(found: DataFrame, column: str):
    """A Bloom filter of the packed keys, 2**26 bits at most; texts it lets pass by chance, or
    because it is full, only cost time."""
    def unpack(batches):
        for b in batches:
            for raw in b[column].to_pylist():
                yield {"key": np.frombuffer(raw, np.int64)}

    size = found.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return bloom_of(map_arrow(found.select(column), unpack, "key long"), "key",
                    power_of_two(2 * size), 2)


def united(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict:
    """Maximal runs of the spans of each row."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    upto = end.copy()
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][:len(row)])
    for lo, hi in zip(first, np.r_[first[1:], len(row)]):
        np.maximum.accumulate(upto[lo:hi], out=upto[lo:hi])
    new = np.r_[True, (row[1:] != row[:-1]) | (start[1:] > upto[:-1])][:len(row)]
    head = np.flatnonzero(new)
    tail = np.r_[head[1:], len(row)] - 1
    return {ROW: row[head], "start": start[head], "end": upto[tail] if len(head) else upto[:0]}


_PLACE = np.dtype([("key", "u8"), ("digest", "u8"), ("row", "i8"), ("start", "i8"),
                   ("count", "i4"), ("text", "i4")])


def places(docs: DataFrame, filters: dict, buckets: int, length: int, piece: int) -> DataFrame:
    """Fragments with repeated anchors, by bucket, and the spans already settled in the task."""
    known = Shared(docs.sparkSession, filters)

    def taken(data, own, rows):
        repeated = known.value["repeated"].holds(own.key)
        hot = np.zeros(len(own.key), bool)
        if known.value["hot"] is not None:
            hot = repeated & known.value["hot"].holds(own.key)
        at = np.flatnonzero(repeated & ~hot)
        out = np.zeros(len(at), _PLACE)
        out["key"], out["digest"], out["count"] = own.key[at], own.digest[at], own.count[at]
        out["row"], out["start"] = rows[own.doc[at]], own.start[at]
        with_text = known.value["differing"].holds(own.key[at])
        out["text"] = with_text * (out["count"] + length - 1)
        texts = [data[a:a + n].tobytes() if n else b"" for a, n in zip(own.at[at], out["text"])]
        if hot.any():  # single strings, which meet by their own hash
            at = np.flatnonzero(hot)
            n = own.count[at]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            more = np.zeros(len(step), _PLACE)
            with np.errstate(over="ignore"):
                more["digest"] = own.hashes(np.repeat(own.at[at], n) + step, length)
                more["key"] = mixed(more["digest"] + np.uint64(length))
            more["row"], more["count"] = np.repeat(rows[own.doc[at]], n), 1
            more["start"] = np.repeat(own.start[at], n) + step
            out, texts = np.concatenate([out, more]), texts + [b""] * len(more)
        return out, texts

    def settled(found, texts):
        order = np.lexsort((found["start"], found["row"], found["digest"], found["key"]))
        found, texts = found[order], [texts[i] for i in order]
        new = np.r_[True, (found["key"][1:] != found["key"][:-1])
                    | (found["digest"][1:] != found["digest"][:-1])]
        late = found[~new]
        spans = united(late["row"], late["start"], late["start"] + late["count"] + length - 1)
        yield {"bucket": [None] * len(spans["start"]), "places": [None] * len(spans["start"]),
               "texts": [None] * len(spans["start"])} | spans
        first = np.flatnonzero(new)
        found, texts = found[first], [texts[i] for i in first]
        own = list(by_bucket(found["key"], buckets))
        none = [None] * len(own)
        yield {"bucket": [b for b, _ in own], ROW: none, "start": none, "end": none,
               "places": [found[i].tobytes() for _, i in own],
               "texts": [b"".join(texts[j] for j in i) for _, i in own]}

    def cut(batches):
        found, texts, size = [], [], 0
        for b in batches:
            rows = b[ROW].to_numpy(zero_copy_only=False)
            for data, own in fragments(utf8(b["text"]), length, piece):
                more, more_texts = taken(data, own, rows)
                found.append(more)
                texts += more_texts
                size += len(more)
            if size > TASK_PLACES:
                yield from settled(np.concatenate(found), texts)
                found, texts, size = [], [], 0
        if size:
            yield from settled(np.concatenate(found), texts)

    return map_arrow(docs.select(ROW, "text"), cut, f"bucket int, {ROW} long, start long, "
                     "end long, places binary, texts binary")


def repeated_strings(strings: list[bytes], row, start, length: int):
    """(row, start) of every string of ``length`` bytes in ``strings`` that another place, earlier
    by (row, start), holds as well."""
    with tempfile.TemporaryDirectory() as folder:
        prefix, string, at = Collection(strings, length, folder).build()
    kind = np.cumsum(prefix < length)
    size = np.bincount(kind)
    many = size[kind] > 1
    kind, row, start = kind[many], row[string[many]], start[string[many]] + at[many]
    order = np.lexsort((start, row, kind))
    kind, row, start = kind[order], row[order], start[order]
    later = np.flatnonzero(kind[1:] == kind[:-1]) + 1
    return row[later], start[later]


def bucket_spans(found: np.ndarray, texts: bytes, length: int) -> dict:
    """Spans to remove, from all fragments of a bucket."""
    text_at = np.cumsum(found["text"].astype(np.int64)) - found["text"]
    order = np.lexsort((found["start"], found["row"], found["digest"], found["key"]))
    found, text_at = found[order], text_at[order]
    new = np.r_[True, (found["key"][1:] != found["key"][:-1])
                | (found["digest"][1:] != found["digest"][:-1])]
    late, own, text_at = found[~new], found[new], text_at[new]
    row, start = [late["row"]], [late["start"]]
    end = [late["start"] + late["count"] + length - 1]
    same = own["key"][1:] == own["key"][:-1]
    several = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
    if len(several):
        strings = [texts[a:a + n] for a, n in zip(text_at[several], own["text"][several])]
        r, s = repeated_strings(strings, own["row"][several], own["start"][several], length)
        row.append(r)
        start.append(s)
        end.append(s + length)
    return united(np.concatenate(row), np.concatenate(start), np.concatenate(end))


def repeated_spans(docs: DataFrame, length: int = LENGTH, piece: int = PIECE,
                   hot: int = HOT) -> DataFrame:
    """(row key, start, end) of spans to remove; they may overlap. ``docs``: from ``documents``."""
    found = stored(anchors(docs, length, piece, hot), "anchors")
    sums = found.agg(F.sum("n"), F.sum(F.octet_length("hot"))).first()
    filters = {"repeated": key_filter(found, "repeated"),
               "differing": key_filter(found, "differing"),
               "hot": key_filter(found, "hot") if sums[1] else None}
    buckets = max(16, (sums[0] or 0) // STRINGS + 1)
    sent = stored(places(docs, filters, buckets, length, piece), "places")

    def meet(batches):
        for run in runs(batches, "bucket"):
            yield bucket_spans(np.frombuffer(b"".join(run["places"]), _PLACE),
                               b"".join(run["texts"]), length)

    span = f"{ROW} long, start long, end long"
    late = map_arrow(grouped(sent.filter("bucket IS NOT NULL").select("bucket", "places", "texts"),
                             "bucket"), meet, span, rows=64)
    return late.unionByName(sent.filter("bucket IS NULL").select(ROW, "start", "end"))


def without(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """Remaining bytes, number of removed ones, and number of maximal removed runs."""
    kept, at, runs_, removed = [], 0, 0, 0
    upto = -1
    for start, end in sorted(spans):
        if start > upto:
            runs_ += 1
            kept.append(text[at:start])
            removed += end - start
        else:
            removed += max(0, end - upto)
        upto = at = max(upto, end)
    return b"".join(kept) + text[at:], removed, runs_


def suffix_dedup(table: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) of each row."""
    docs = documents(table)
    spans = stored(repeated_spans(docs, length).groupBy(ROW).agg(
        F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    filtered = bloom_of(spans.select(ROW), ROW, power_of_two(16 * spans.count()), 5)
    likely = Shared(docs.sparkSession, filtered)

    def touched(batches, wanted=True):
        for b in batches:
            hit = likely.value.holds(b[ROW].to_numpy(zero_copy_only=False))
            at = np.flatnonzero(hit == wanted)
            yield {c: v.take(at) for c, v in b.items()}

    def cut(batches):
        for b in batches:
            texts = utf8(b["text"])
            made = [without(t, [(s["start"], s["end"]) for s in own or []])
                    for t, own in zip(texts, b["spans"].to_pylist())]
            yield {"doc_id": b["doc_id"], "n_bytes": [len(t) for t in texts],
                   "n_removed": [m[1] for m in made], "n_spans": [m[2] for m in made],
                   "kept_sha256": [hashlib.sha256(m[0]).hexdigest() for m in made],
                   "kept": [m[0] for m in made]}

    def whole(batches):
        for b in touched(batches, wanted=False):
            texts = utf8(b["text"])
            yield {"doc_id": b["doc_id"], "n_bytes": [len(t) for t in texts],
                   "n_removed": [0] * len(texts), "n_spans": [0] * len(texts),
                   "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts], "kept": texts}

    kind = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
            "kept binary")
    some = map_arrow(docs, touched, f"{ROW} long, doc_id long, text string")
    some = some.join(spans, ROW, "left").select("doc_id", "text", "spans")
    return map_arrow(some, cut, kind).unionByName(map_arrow(docs, whole, kind))
