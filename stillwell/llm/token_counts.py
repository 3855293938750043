"""Tokens of each text without making ids.

A pre-token is a run of bytes between ASCII white space, lower-cased: the library cuts texts at
least there, and it lower-cases itself. Pieces are counted once for each distinct pre-token by
the library. Counts of frequent pre-tokens (at most ``HEAD`` of at most ``LONGEST`` bytes each, some
6 MB) go to the tasks as a dict; the others, long ones among them, meet the per-document frequencies
in a shuffle join. A task gathers pre-tokens from at most ``GATHERED`` bytes of text at a time, or one
text. Texts without ASCII white space are pre-tokens as a whole.

Cases: null text counts as empty and has no tokens; texts that hold the opening of a special
token are not lower-cased, so the library sees it as it stands; repeated rows count each on its
own; an empty table gives an empty result.
"""

from collections import Counter

from pyspark.sql import DataFrame, functions as F

from stillwell.llm.common import ROW, documents, loaded, map_arrow, stored, utf8

HEAD = 100_000
DISTINCT = 100_000
LONGEST, GATHERED = 64, 32 << 20
_STOPS = b".,"


def pretokens(text: bytes) -> Counter:
    """Frequencies of the pre-tokens of a text. A lone full stop or comma behind an ASCII letter at
    the end of a run is a pre-token of its own for the library too."""
    if b"<|" in text:
        return Counter(text.split())
    found = Counter(text.lower().split())
    for word in [w for w in found if w[-1] in _STOPS and w[-2:-1].isalpha()]:
        n = found.pop(word)
        found[word[:-1]] += n
        found[word[-1:]] += n
    return found


def vocabulary(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Each distinct pre-token with its frequency in the corpus and its number of pieces."""
    def distinct(batches):
        kept, size = Counter(), 0
        for b in batches:
            for text in utf8(b["text"]):
                kept.update(pretokens(text))
                size += len(text)
                if len(kept) > DISTINCT or size > GATHERED:
                    yield {"word": list(kept), "n": list(kept.values())}
                    kept, size = Counter(), 0
        yield {"word": list(kept), "n": list(kept.values())}

    def counted(batches):
        library = loaded(tokenizer)
        for b in batches:
            words = [w.decode("utf-8", "replace") for w in b["word"].to_pylist()]
            made = library.encode_batch_fast(words, add_special_tokens=False)
            yield {"word": b["word"], "n": b["n"], "pieces": [len(e) for e in made]}

    words = map_arrow(docs.select("text"), distinct, "word binary, n long")
    words = words.groupBy("word").agg(F.sum("n").alias("n"))
    return map_arrow(words, counted, "word binary, n long, pieces long", rows=4096)


def token_counts(table: DataFrame, tokenizer: str, limit: int = 2048,
                 head: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of ``table``."""
    docs = documents(table)
    words = stored(vocabulary(docs, tokenizer), "pieces")
    top = words.filter(F.octet_length("word") <= LONGEST).orderBy(F.desc("n"), "word").limit(
        head).select("word", "pieces").toArrow()
    known = docs.sparkSession.sparkContext.broadcast(
        dict(zip(top["word"].to_pylist(), top["pieces"].to_pylist())))

    def frequencies(batches):
        frequent = known.value
        for b in batches:
            sizes, sums, rare, times = [], [], [], []
            for text in utf8(b["text"]):
                total, words, counts = 0, [], []
                for word, n in pretokens(text).items():
                    if (pieces := frequent.get(word)) is not None:
                        total += n * pieces
                    else:
                        words.append(word)
                        counts.append(n)
                sizes.append(len(text))
                sums.append(total)
                rare.append(words)
                times.append(counts)
            yield {ROW: b[ROW], "doc_id": b["doc_id"], "n_bytes": sizes, "tokens": sums,
                   "words": rare, "times": times}

    counts = stored(map_arrow(
        docs, frequencies, f"{ROW} long, doc_id long, n_bytes long, tokens long, "
        "words array<binary>, times array<long>"), "frequencies")
    rare = counts.select(ROW, F.explode(F.arrays_zip("words", "times")).alias("at")).select(
        ROW, F.col("at.words").alias("word"), F.col("at.times").alias("times"))
    rare = rare.join(words.select("word", "pieces"), "word").select(
        ROW, F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"),
        (F.col("times") * F.col("pieces")).alias("tokens"))
    whole = counts.select(ROW, "doc_id", "n_bytes", "tokens").unionByName(rare)
    n = F.sum("tokens")
    return whole.groupBy(ROW).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), n.alias("n_tokens"),
    ).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
