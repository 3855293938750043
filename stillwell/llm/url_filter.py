"""URL rules by a Bloom filter cascade.

A rule is a host and a path prefix; its key is both together. The keys a url can match, one for each
suffix of its host and each length of a rule's path, make up the universe of the corpus. Level 0 of
the cascade holds the listed keys, level 1 the keys of the universe that level 0 lets pass wrongly,
level 2 the listed keys that level 1 holds wrongly, and so on until nothing is wrong. Membership is
then exact for every key of the corpus, so tasks judge urls with the levels alone, without a join.

Level 0 is sized so that its false positives stay below the number of listed keys; all levels
together grow with the list and the logarithm of the corpus, not with the corpus.

Cases: null urls, and those without "://", have empty host and path; a rule given both as allow and
as block blocks; urls no rule fits are allowed; repeated rows are judged each; an empty table gives
an empty result.
"""

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from stillwell.llm.common import Shared, bloom_of, map_arrow, power_of_two, stored

MEMO = 100_000
DEFAULT = "allow"


def parted(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min((i for c in "?#" if (i := rest.find(c)) >= 0), default=len(rest))
    rest = rest[:cut]
    host, slash, path = rest.partition("/")
    return host.encode().lower().decode(), slash + path


def rule_key(rule: str) -> str:
    """A rule as given, like ``net/es/``: its host lower-cased, its path as it is."""
    host, slash, path = rule.partition("/")
    return host.encode().lower().decode() + slash + path


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Keys of the rules that would fit, longest first."""
    suffixes, at = [host], host.find(".")
    while at >= 0:
        suffixes.append(host[at + 1:])
        at = host.find(".", at + 1)
    return sorted((s + path[:n] for s in suffixes if s for n in lengths if n <= len(path)),
                  key=len, reverse=True)


def hashed(keys: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k.encode("utf-8", "surrogatepass")) for k in keys],
                    np.uint64)


class Cascade:
    def __init__(self, levels: list):
        self.levels = levels

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key is listed: exact for keys of the universe."""
        out = np.full(len(keys), len(self.levels) % 2 == 1)
        left = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            passed = level.holds(keys[left])
            out[left[~passed]] = i % 2 == 1
            left = left[passed]
        return out


def cascade(keys: DataFrame, column: str) -> Cascade:
    """``keys``: (hash, listed flags) of the universe and the list; ``column`` the flag to encode."""
    listed = keys.filter(F.col(column)).select("hash")
    others = keys.filter(~F.col(column)).select("hash")
    n, rest = listed.count(), others.count()
    if not n:
        return Cascade([])
    levels, inside, outside = [], listed, others
    chance = min(0.5, n * math.sqrt(0.5) / max(1, rest))
    while True:
        hashes = max(1, round(-math.log2(chance)))
        level = bloom_of(inside, "hash", power_of_two(inside.count() * hashes * 1.45), hashes,
                         salt=len(levels))
        levels.append(level)
        wrong = stored(passed(outside, level), "wrong")
        if wrong.isEmpty():
            return Cascade(levels)
        inside, outside, chance = wrong, inside, 0.5


def passed(keys: DataFrame, level) -> DataFrame:
    """The keys that ``level`` lets pass."""
    known = Shared(keys.sparkSession, level)

    def test(batches):
        for b in batches:
            hit = known.value.holds(b["hash"].to_numpy(zero_copy_only=False))
            yield {"hash": b["hash"].take(np.flatnonzero(hit))}

    return map_arrow(keys, test, "hash long", rows=8192)


def universe(urls: DataFrame, rules: DataFrame, lengths: list[int]) -> DataFrame:
    """Every key of the corpus and of the list: hash, and whether it is a rule to allow or block.
    A url's keys are cut to the rules' lengths, so there are far fewer keys than urls."""
    def keys(batches):
        for b in batches:
            heads = {(h, p[:max(lengths)]) for h, p in map(parted, b["url"].to_pylist())}
            own = sorted({k for h, p in heads for k in candidates(h, p, lengths)})
            yield {"key": own}

    corpus = map_arrow(urls.select("url"), keys, "key string", rows=4096).distinct()
    listed = rules.groupBy("key").agg(F.max("block").alias("block"))
    both = corpus.join(listed, "key", "full")

    def with_hash(batches):
        for b in batches:
            yield {"hash": hashed(b["key"].to_pylist()).view(np.int64), "allow": b["allow"],
                   "block": b["block"]}

    flags = both.select("key", F.coalesce(~F.col("block"), F.lit(False)).alias("allow"),
                        F.coalesce("block", F.lit(False)).alias("block"))
    return map_arrow(flags, with_hash, "hash long, allow boolean, block boolean", rows=4096)


def url_filter(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict of each row; ``rules``: (allow or block, host and path)."""
    spark = pages.sparkSession
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    keys = [(rule_key(r), v == "block") for v, r in rules]
    lengths = sorted({len(k) - len(k.partition("/")[0]) for k, _ in keys})
    if keys:
        listed = spark.createDataFrame(keys, "key string, block boolean")
        known = stored(universe(urls, listed, lengths), "universe")
        levels = {"block": cascade(known, "block"), "allow": cascade(known, "allow")}
    else:
        levels = {}
    model = Shared(spark, levels)

    def judged(host, path):
        own = candidates(host, path, lengths)
        if own:
            hashes = hashed(own)
            held = {v: level.holds(hashes) for v, level in model.value.items() if level.levels}
            for i, key in enumerate(own):
                for verdict, hit in held.items():
                    if hit[i]:
                        return key, verdict
        return None, DEFAULT

    def judge(batches):
        memo = {}
        for b in batches:
            out = {"host": [], "path": [], "rule": [], "verdict": []}
            for url in b["url"].to_pylist():
                host, path = parted(url)
                head = (host, path[:lengths[-1]] if lengths else "")
                if head not in memo:
                    if len(memo) > MEMO:
                        memo.clear()
                    memo[head] = judged(host, path)
                for column, value in zip(out.values(), (host, path, *memo[head])):
                    column.append(value)
            yield {"page_id": b["page_id"], **out}

    return map_arrow(urls, judge, "page_id long, host string, path string, rule string, "
                     "verdict string", rows=4096)
