"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives each document a probability for every domain. Rates
(expected numbers of copies) are then fitted so that the expected tokens of each domain meet their
targets: least squares over all documents, by accelerated projected gradient, scaled by the inverse
of the posteriors' Gram matrix, so that small domains move as fast as large ones. Steps go on until
each domain is within ``TOLERANCE`` of its own target, or a step changes rates no more, which proves
the optimum under the least rate; a warning names the domains that miss their targets. A step needs
only the domains' sums, which tasks add up; the rates themselves follow from the steps taken so far, so each
task works them out anew and nothing is kept between jobs. Gradients are taken per token, so long and
short documents of the same kind get the same rate. A rate becomes a number of copies by a hash of
the document's key.

The classifier is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``). Tokens are words.
Cases: null text counts as empty and has no tokens; null labels teach nothing; of several labels of
a doc_id one counts, the first in order; without labels, or with one domain, every rate is the same;
domains without weight or without label have weight 0 or do not exist; repeated rows have rates of
their own; an empty table gives an empty result.
"""

import warnings

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from stillwell.llm.common import ROW, Shared, documents, map_arrow, stored

SAMPLE_ROWS = 10_000
FEATURES = 1 << 14
#: Of each domain's target (of all tokens where that is 0); of rates, in the mean over tokens; steps
#: until the fit is given up.
TOLERANCE, STILL, STEPS = 2e-3, 1e-5, 150
#: Share of the tokens each domain should have.
WEIGHTS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labelled table: toxic, poor or good."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic")
                         .when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
                         .alias("domain"))


def worded(docs: DataFrame) -> DataFrame:
    words = F.filter(F.split(F.lower("text"), "[ \\t-\\r]+"), lambda w: w != "")
    return docs.withColumn("words", words)


def classified(docs: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[DataFrame, list[str]]:
    """Row key, doc_id, tokens and posteriors of all documents, and the domains' names."""
    known = (labels.filter("doc_id IS NOT NULL AND domain IS NOT NULL")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("domain").alias("domain")))
    known = stored(known, "labels")
    share = sample_rows / max(1, known.count())
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**40)) < int(share * 2**40))
    # However often a doc_id is repeated, one of its rows is an example.
    examples = stored(docs.join(F.broadcast(known), "doc_id").groupBy("doc_id", "domain").agg(
        F.min("text").alias("text")).select("text", "domain"), "examples")
    names = [r[0] for r in examples.select("domain").distinct().orderBy("domain").collect()]
    tokens = F.size("words").cast("long").alias("tokens")
    if len(names) < 2:
        flat = F.array(*[F.lit(1.0)] * len(names))
        return stored(worded(docs).select(ROW, "doc_id", tokens, flat.alias("posterior")),
                      "posteriors"), names
    counts = HashingTF(inputCol="words", outputCol="counts", numFeatures=FEATURES)
    model = Pipeline(stages=[
        StringIndexer(inputCol="domain", outputCol="label", stringOrderType="alphabetAsc"),
        counts, Normalizer(inputCol="counts", outputCol="features"),
        LogisticRegression(family="multinomial", maxIter=30, regParam=1e-4),
    ]).fit(worded(examples).repartition(8))
    found = worded(docs)
    for stage in model.stages[1:]:
        found = stage.transform(found)
    return stored(found.select(ROW, "doc_id", tokens,
                               vector_to_array("probability").alias("posterior")),
                  "posteriors"), names


def fitted(posteriors: np.ndarray, steps: list, least: float):
    """Rates after the steps, the point the next gradient is taken at, and the last step's move."""
    rate = np.ones(len(posteriors))
    ahead, moved = rate, rate * 0
    for move, push in steps:
        new = np.maximum(least, ahead - posteriors @ move)
        moved = new - ahead
        ahead = new + push * (new - rate)
        rate = new
    return rate, ahead, moved


class Fit:
    """Steps towards rates whose domains' tokens have the shares: what each subtracts along the
    posteriors, and its momentum. Without ``total`` the tokens grow as far as the shares need."""

    def __init__(self, shares: np.ndarray, total: float | None):
        self.shares, self.steps, self.t, self.weight = shares, [], 1.0, None
        one = np.ones(len(shares))
        self.of = np.eye(len(shares)) - (np.outer(shares, one) if total is None else 0)
        self.goal = shares * (total or 0)
        self.met = self.still = False
        self.last = np.inf

    def taken(self, rate, ahead, square, moved: float) -> bool:
        """Whether the fit ends, from the sums at the present steps; else one more step is added."""
        if self.weight is None:
            self.weight = np.linalg.pinv(self.of @ square @ self.of.T, rcond=1e-10, hermitian=True)
        self.rate = rate
        self.targets = self.goal if self.goal.any() else self.shares * rate.sum()
        near = np.where(self.shares > 0, self.targets, self.targets.sum())
        self.met = bool((np.abs(rate - self.targets) <= TOLERANCE * near).all())
        self.still = bool(self.steps) and moved <= STILL
        if self.met or self.still or len(self.steps) >= STEPS:
            return True
        off = self.of @ rate - self.goal
        if (off @ self.weight @ off) > self.last:  # momentum leads away: start it anew
            self.t = 1.0
        self.last = off @ self.weight @ off
        grown = (1 + np.sqrt(1 + 4 * self.t ** 2)) / 2
        move = self.of.T @ self.weight @ (self.of @ ahead - self.goal)
        self.steps.append((move, (self.t - 1) / grown))
        self.t = grown
        return False


def rates(known: DataFrame, names: list[str], fit: Fit, least: float) -> list:
    """The steps of the fit, and a warning if they miss a target."""
    spark, domains = known.sparkSession, len(names)

    def sums(steps):
        model = Shared(spark, steps)

        def add(batches):
            total, square, moved = np.zeros((2, domains)), np.zeros((domains, domains)), np.zeros(2)
            for b in batches:
                n = b["tokens"].to_numpy(zero_copy_only=False).astype(float)
                p = np.array(b["posterior"].to_pylist(), float).reshape(len(n), -1)
                rate, ahead, last = fitted(p, model.value, least)
                total += np.stack([(n * rate) @ p, (n * ahead) @ p])
                square += p.T @ (p * n[:, None])
                moved += n @ last ** 2, n @ rate ** 2
            yield {"rate": [total[0]], "ahead": [total[1]], "square": [square.ravel()],
                   "moved": [moved]}

        sizes = {"rate": domains, "ahead": domains, "square": domains ** 2, "moved": 2}
        made = map_arrow(known.select("tokens", "posterior"), add,
                         ", ".join(f"{c} array<double>" for c in sizes), rows=8192)
        row = made.agg(*[F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(size)]).alias(c)
                         for c, size in sizes.items()]).first()
        rate, ahead, square, moved = (np.array(row[c], float) for c in sizes)
        return (rate, ahead, square.reshape(domains, domains),
                np.sqrt(moved[0] / max(moved[1], 1e-300)))

    while not fit.taken(*sums(fit.steps)):
        pass
    if not fit.met:
        missed = ", ".join(f"{n}: {r:.0f} of {t:.0f}" for n, r, t in
                           zip(names, fit.rate, fit.targets))
        why = "no rates meet them better" if fit.still else f"not reached in {STEPS} steps"
        warnings.warn(f"mixing misses its targets (tokens by domain, {why}): {missed}")
    return fit.steps


def mixed_rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, *,
                least: float = 0.0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Row key, doc_id, tokens, posterior (by domain), rate and copies of each row of ``docs`` (from
    ``documents``). ``labels``: doc_id, domain. The tokens stay as many as they are, unless no rate
    may fall below ``least`` = 1: then they grow until every target can be met."""
    known, names = classified(docs, labels, sample_rows)
    weights = WEIGHTS if weights is None else weights
    steps = []
    if len(names) > 1:
        held = known.agg(*[F.sum(F.col("tokens") * F.get("posterior", F.lit(i)))
                           for i in range(len(names))]).first()
        held = np.array([h or 0 for h in held], float)
        share = np.array([weights.get(n, 0.0) for n in names], float)
        if share.sum() > 0 and held.sum() > 0:
            share /= share.sum()
            steps = rates(known, names, Fit(share, None if least >= 1 else held.sum()), least)
    model = Shared(docs.sparkSession, steps)

    def rate(batches):
        for b in batches:
            n = b["tokens"].to_numpy(zero_copy_only=False).astype(float)
            p = b["posterior"].to_pylist()
            own = np.ones(len(n))
            if model.value:
                own = fitted(np.array(p, float).reshape(len(n), -1), model.value, least)[0]
            yield {ROW: b[ROW], "doc_id": b["doc_id"], "tokens": b["tokens"],
                   "posterior": [list(zip(names, x)) for x in p], "rate": own}

    found = map_arrow(known, rate, f"{ROW} long, doc_id long, tokens long, "
                      "posterior map<string, double>, rate double", rows=8192)
    chance = F.pmod(F.xxhash64(ROW, F.lit(5)), F.lit(2**30)) / F.lit(float(2**30))
    return found.withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def mixing(table: DataFrame, labels: DataFrame,
           weights: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_tokens, posterior, rate, copies of each row of ``table``."""
    return mixed_rates(documents(table), domains_of(labels), weights).select(
        "doc_id", F.col("tokens").alias("n_tokens"), "posterior", "rate", "copies")
