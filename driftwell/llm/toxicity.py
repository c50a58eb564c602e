"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed words and word beginnings is trained in numpy from
confirmed toxic texts and unlabelled ones.  The risk is
``prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])``; where the second
part is negative, the step goes the other way.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.store import discard, materialise

SLOTS = 1 << 22
_WORDS = re.compile(r"[^\W\d_]+").findall
#: Words of which a worker remembers the slots that have a weight.
REMEMBERED = 100_000


def _slots(word: str) -> set[int]:
    parts = {word + "$", *(word[:n] for n in (4, 5, 6, 7, 8) if len(word) >= n)}
    return {zlib.crc32(p.encode("utf-8", "surrogatepass")) % SLOTS for p in parts}


def features(text: str | None) -> np.ndarray:
    """The slots that a text fills: of its lower-cased words, and of their first 4 to 8 letters."""
    return np.array(sorted(set().union(*map(_slots, set(_WORDS((text or "").lower()))))), dtype=np.int32)


class PuModel:
    """``weights`` over ``slots`` and a ``bias``."""

    def __init__(self, slots: np.ndarray, weights: np.ndarray, bias: float):
        keep = np.abs(weights) > 1e-3
        self.weights, self.bias = dict(zip(slots[keep].tolist(), weights[keep].tolist())), float(bias)
        self.seen: dict[str, tuple[int, ...]] = {}  # of a word the slots that have a weight, mostly none

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}}

    def score(self, text: str | None) -> float:
        words = set(_WORDS((text or "").lower()))
        new = [w for w in words if w not in self.seen]
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen.clear()
            new = list(words)
        for w in new:
            self.seen[w] = tuple(x for x in _slots(w) if x in self.weights)
        found = set().union(*filter(None, map(self.seen.__getitem__, words)))
        z = self.bias + sum(self.weights[x] for x in sorted(found))
        if len(self.seen) > REMEMBERED:  # a text of very many words
            self.seen.clear()
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))


def _evidence(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> np.ndarray:
    """G of the counts a of n_a and b of n_b; below zero if b's share is larger."""

    def own(x, n, rate):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log(x / n / rate), 0) + np.where(x < n, (n - x) * np.log((n - x) / n / (1 - rate)), 0)

    rate = (a + b) / (n_a + n_b)
    return np.sign(a / n_a - b / n_b) * 2 * (own(a, n_a, rate) + own(b, n_b, rate))


def telling(slots: np.ndarray, in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, least: int = 4, evidence: float = 16.0) -> np.ndarray:
    """The slots that ``least`` texts fill and that positive texts fill more often, with a
    likelihood ratio statistic of ``evidence`` or more; slots that only seem to tell
    the classes apart would be learnt by heart."""
    common = np.flatnonzero(in_p + in_u >= least)
    return np.sort(slots[common[_evidence(in_p[common], n_p, in_u[common], n_u) >= evidence]]).astype(np.int32)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], slots: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05, decay: float = 1e-4, beta: float = 0.0) -> PuModel:
    """Adam on the whole sample, whose texts are given by those of ``slots`` that they fill.

    Without a positive or an unlabelled text the model is the prior alone."""
    prior = float(np.clip(prior, 1e-4, 0.9))
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return PuModel(np.zeros(0, dtype=np.int32), np.zeros(0), start)
    texts = [*positive, *unlabelled]
    row, col = np.repeat(np.arange(len(texts)), [len(x) for x in texts]), np.searchsorted(slots, np.concatenate(texts))
    pos = np.arange(len(texts)) < len(positive)
    n_p, n_u = pos.sum(), (~pos).sum()
    w, b = np.zeros(len(slots)), start
    m, v = np.zeros(len(slots) + 1), np.zeros(len(slots) + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, weights=w[col], minlength=len(texts))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        lose = np.logaddexp(0, z)  # loss of the label 0
        below = lose[~pos].mean() - prior * lose[pos].mean()
        if below >= -beta:
            g = np.where(pos, prior * (p - 1) / n_p - prior * p / n_p, p / n_u)
        else:
            g = np.where(pos, prior * p / n_p, -p / n_u)
        grad = np.r_[np.bincount(col, weights=g[row], minlength=len(slots)) + decay * w, g.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return PuModel(slots, w, b)


def fold(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def fit(docs: DataFrame, labels: DataFrame, positives: int = 3_000, unlabelled: int = 9_000, prior: float | None = None) -> PuModel:
    """A model from the documents outside fold 2.

    ``positives`` and ``unlabelled`` bound the sample (the least hashes of
    doc_id, each id once); how many of its texts fill a slot, and the slots that
    tell the classes apart, reach the driver.  Of an id's
    rows the least text counts.  The class prior is the share of toxic rows
    among the labelled ones of the training folds, unless given.  A document
    with several labels is toxic if one says so.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(F.coalesce(fold(F.col("doc_id")), F.lit(0)) != 2)
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    if prior is None:
        prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.05
    turn = F.xxhash64(F.col("doc_id"), F.lit(4))
    yes = known.where("toxic").select("doc_id").orderBy(turn, "doc_id").limit(positives).withColumn("toxic", F.lit(True))
    rest = docs.select("doc_id").where(F.col("doc_id").isNotNull()).where(fold(F.col("doc_id")) != 2)
    rest = rest.distinct().orderBy(turn, "doc_id").limit(unlabelled).withColumn("toxic", F.lit(False))
    chosen = F.broadcast(yes.unionByName(rest))  # positives + unlabelled ids at most

    @F.pandas_udf("array<int>")
    def filled(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)

    rows = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # a row an id and class
    rows = materialise(rows.select("doc_id", "toxic", filled("text").alias("slots")), "sample")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    each = rows.select("toxic", F.explode("slots").alias("slot")).groupBy("slot").agg(F.count(F.when(F.col("toxic"), 1)).alias("p"), F.count("*").alias("all"))
    each = each.where(F.col("all") >= 4).toArrow()  # slots that four texts fill: SLOTS numbers at most
    slot, in_p, in_all = (each.column(c).to_numpy() for c in ("slot", "p", "all"))
    slots = telling(slot, in_p, in_all - in_p, n.get(True, 0), n.get(False, 0)) if len(n) == 2 else np.zeros(0, dtype=np.int32)

    @F.pandas_udf("array<int>")
    def kept(found: pd.Series) -> pd.Series:
        return pd.Series([np.intersect1d(x, slots) for x in found], dtype=object)

    texts: dict[bool, list] = {True: [], False: []}
    for r in sorted(rows.select("doc_id", "toxic", kept("slots").alias("slots")).collect(), key=lambda r: (r["doc_id"], r["toxic"])):
        texts[r["toxic"]].append(np.array(r["slots"], dtype=np.int32))
    discard(rows)
    return train(texts[True], texts[False], slots, prior)


def toxicity(docs: DataFrame, labels: DataFrame, name: str = "score", model: PuModel | None = None, **sample) -> DataFrame:
    """``docs`` and the probability of toxicity of each whole text in column ``name``.

    Null and empty texts fill no slot: their score is the bias's.  Repeated
    rows get equal scores.  The texts alone are the input of a score.
    """
    model = fit(docs, labels, **sample) if model is None else model
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, scored(F.col("text")))


def op4_nnpu_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def drop_toxic(spark, docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents whose score is below ``least``, with their own columns."""
    names = docs.columns
    inner = docs.select("doc_id", "text", F.struct(*names).alias("__doc"))
    model = fit(inner, labels)
    return toxicity(inner, labels, "__score", model).where(F.col("__score") < least).select("__doc.*")
