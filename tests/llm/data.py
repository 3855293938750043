"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, extra columns."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that share their names with what operators add.
CLASHING = ", _row long, kept boolean, digest string, score double, copies int, _more int"


def documents(spark, rows):
    """``rows``: (doc_id, text)."""
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), 7, None, "x", 0.5, 9, 3)
         for i, t in rows], DOCUMENTS + CLASHING)


def prose(rng: random.Random, words: int) -> str:
    parts = "th on er ing a es ti re he in ou an".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
                    for _ in range(words))


def collected(df, key):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is None, r[key]))
