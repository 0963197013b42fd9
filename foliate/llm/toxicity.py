"""Toxicity: non-negative positive-unlabelled learning.

Only confirmed toxic documents and unlabelled text are at hand for training. The
risk of a classifier on the negatives is then written as its risk on the unlabelled
text, less the share of it that the positives account for; the class prior sets that
share. The difference is an estimate of a risk and may not fall below zero: a step
where it does is taken back (Kiryo et al. 2017, "Positive-Unlabeled Learning with
Non-Negative Risk Estimator").
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.frames import held_out, id_and_text, joined_bytes, learning, map_texts

GRAM = 5
BITS = 22
#: White space as one kind of byte, so that a word at the end of a line looks as it does inside one.
_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


@dataclass(frozen=True)
class PuParameters:
    """Bounds of the training sample and settings of the fit.

    The classifier is fitted on at most ``max_positive`` toxic and ``max_unlabelled``
    unlabelled documents, those with the smallest hash of their id. Scoring reads
    every document. ``min_lift`` is how much more often a feature must occur in toxic
    than in unlabelled documents to be used, ``min_z`` how many standard errors the two
    shares must lie apart, ``max_features`` how many features are used at most.
    """

    max_positive: int = 3000
    max_unlabelled: int = 6000
    min_documents: int = 5
    min_lift: float = 2.5
    min_z: float = 5.0
    max_features: int = 4096
    steps: int = 1000
    rate: float = 0.05
    l2: float = 1e-5
    beta: float = 0.0
    gamma: float = 1.0


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted buckets of the features, their weights, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float
    prior: float

    def table(self) -> np.ndarray:
        used = np.zeros(1 << BITS, bool)
        used[self.buckets] = True
        return used


def gram_buckets(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each window of five bytes of all lower-cased texts, and where each text's windows start."""
    raw = [(" " + (t or "").lower() + " ").encode().translate(_BLANKS) for t in texts]
    data, starts = joined_bytes(raw)
    n = int(starts[-1])
    keys = data[:n].astype(np.uint64)
    for i in range(1, GRAM):
        keys |= data[i : n + i].astype(np.uint64) << np.uint64(8 * i)
    keys *= np.uint64(0x9E3779B97F4A7C15)
    return (keys >> np.uint64(64 - BITS)).astype(np.uint32), starts


def _inside(at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text each window lies in, and whether it lies in it whole."""
    owner = np.searchsorted(starts, at, side="right") - 1
    return owner, at + GRAM <= starts[owner + 1]


def document_features(texts: list[str | None]) -> dict[str, Sequence]:
    """Per text the sorted distinct buckets of its windows, as bytes of 32-bit numbers, and sketches that near-copies share.

    A sketch is the smallest hash of the text's stretches of seven windows, 35 bytes, under one of three multipliers.
    """
    buckets, starts = gram_buckets(texts)
    grams, sketches = [], []
    for a, b in zip(starts, starts[1:], strict=False):
        own = buckets[a : max(a, b - GRAM + 1)].astype(np.uint64)
        grams.append(np.unique(own).astype(np.uint32).tobytes())
        n = max(1, len(own) - 6 * GRAM)
        long = np.zeros(min(n, len(own)), np.uint64)
        for i in range(7):
            part = own[i * GRAM : i * GRAM + n]
            long[: len(part)] = (long[: len(part)] ^ part) * np.uint64(0x9E3779B97F4A7C15)
            long ^= long >> np.uint64(29)
        sketches.append([int((long * np.uint64(m)).min() >> np.uint64(1)) if len(long) else 0 for m in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)])
    return {"grams": grams, "sketches": sketches}


def first_of_copies(sketches: Sequence[Sequence[int]]) -> list[bool]:
    """Which of the documents share no sketch with one before them."""
    seen: set[tuple[int, int]] = set()
    first = []
    for own in sketches:
        marks = set(enumerate(own))
        first.append(not marks & seen)
        seen |= marks
    return first


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, params: PuParameters = PuParameters()) -> ToxicityModel:
    """Fit a logistic model of feature presence by the non-negative risk, with full-batch Adam steps."""
    empty = ToxicityModel(np.zeros(0, np.int64), np.zeros(0), -20.0, prior)
    if not positive or not unlabelled:
        return empty
    n_p, n_u = len(positive), len(unlabelled)
    in_p, in_u = (np.bincount(np.concatenate(x), minlength=1 << BITS) for x in (positive, unlabelled))
    # Half a document is added to both, so that a feature no unlabelled document has gets a finite lift.
    lift = ((in_p + 0.5) / (n_p + 1)) / ((in_u + 0.5) / (n_u + 1))
    known = np.flatnonzero((in_p >= min(params.min_documents, n_p)) & (lift >= params.min_lift))
    if not len(known):
        return empty
    pooled = (in_p[known] + in_u[known] + 1) / (n_p + n_u + 2)
    z = (in_p[known] / n_p - in_u[known] / n_u) / np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))
    apart = known[z >= params.min_z] if (z >= params.min_z).any() else known
    z = z[z >= params.min_z] if len(apart) < len(known) else z
    buckets = np.sort(apart[np.argsort(-z, kind="stable")[: params.max_features]])

    def coded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        place = np.full(1 << BITS, -1, np.int32)
        place[buckets] = np.arange(len(buckets))
        flat = place[np.concatenate(docs)]
        row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        return row[flat >= 0], flat[flat >= 0]

    (rp, cp), (ru, cu) = coded(positive), coded(unlabelled)
    w, b, k = np.zeros(len(buckets)), -2.0, len(buckets)
    m, v = np.zeros(k + 1), np.zeros(k + 1)

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    for t in range(1, params.steps + 1):
        fp = b + np.bincount(rp, w[cp], n_p)
        fu = b + np.bincount(ru, w[cu], n_u)
        # Logistic losses: softplus(-f) as positive, softplus(f) as negative.
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gp_pos, gp_neg, gu_neg = -prior * sigmoid(-fp) / n_p, -prior * sigmoid(fp) / n_p, sigmoid(fu) / n_u
        if negative >= -params.beta:
            gp, gu = gp_pos + gp_neg, gu_neg
        else:
            gp, gu = -params.gamma * gp_neg, -params.gamma * gu_neg
        grad = np.append(np.bincount(cp, gp[rp], k) + np.bincount(cu, gu[ru], k) + params.l2 * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = params.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return ToxicityModel(buckets, w, float(b), prior)


def train_toxicity(docs: DataFrame, labels: DataFrame, params: PuParameters = PuParameters()) -> ToxicityModel:
    """Fit on the learning folds: toxic documents against unlabelled ones, whatever their label.

    The prior is the share of toxic rows among the labelled rows of those folds. A
    document with several labels counts as toxic when one says so. Near-copies in the
    sample count once.
    """
    docs = id_and_text(docs)
    known = (
        labels.where(learning(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    prior = float(np.clip(known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.01, 0.005, 0.5))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    ids = docs.select("doc_id").where(learning(F.col("doc_id")))
    positive = known.where("toxic = 1").select("doc_id").join(ids.distinct(), "doc_id", "left_semi").orderBy(order, "doc_id").limit(params.max_positive)
    unlabelled = ids.distinct().orderBy(order, "doc_id").limit(params.max_unlabelled)
    picked = positive.withColumn("p", F.lit(1)).unionByName(unlabelled.withColumn("p", F.lit(0))).groupBy("doc_id").agg(F.max("p").alias("p"), F.min("p").alias("all_p"))
    # At most max_positive + max_unlabelled ids, whatever the input: a bounded broadcast. Of repeated ids one row is taken.
    texts = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "p", "all_p").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = map_texts(texts, lambda: document_features, "grams binary, sketches array<bigint>")
    rows = sorted(sample.select("p", "all_p", "grams", "sketches").toLocalIterator(), key=lambda r: (r["sketches"], bytes(r["grams"])))

    def once(wanted: list) -> list[np.ndarray]:
        """Near-copies count once, or what a much copied toxic text says besides would look toxic."""
        first = first_of_copies([r["sketches"] for r in wanted])
        return [np.frombuffer(r["grams"], np.uint32) for r, new in zip(wanted, first, strict=True) if new]

    return fit_nnpu(once([r for r in rows if r["p"] == 1]), once([r for r in rows if r["all_p"] == 0]), prior, params)


def scorer(model: ToxicityModel) -> Callable[[list[str | None]], dict[str, Sequence]]:
    used = model.table()

    def score(texts: list[str | None]) -> dict[str, Sequence]:
        buckets, starts = gram_buckets(texts)
        at = np.flatnonzero(used[buckets])
        owner, whole = _inside(at, starts)
        # A feature counts once per text, however often it occurs.
        pairs = np.unique((owner[whole].astype(np.int64) << BITS) | buckets[at[whole]].astype(np.int64))
        weights = model.weights[np.searchsorted(model.buckets, pairs & ((1 << BITS) - 1))] if len(pairs) else np.zeros(0)
        total = model.intercept + np.bincount(pairs >> BITS, weights, len(texts))
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return {"score": p, "predicted": (p >= 0.7).astype(np.int32), "n_features": np.bincount(pairs >> BITS, minlength=len(texts))}

    return score


def toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every document: ``score`` from 0 to 1, ``predicted`` 1 from 0.7 up.

    Null and empty texts have no features and get the score of the intercept.
    Repeated rows get the same score. Without a toxic example the model is empty and
    every score is next to 0. Only the id and the text are read.
    """
    scored = map_texts(id_and_text(docs, id_col, text_col), lambda: scorer(model), "score double, predicted int, n_features bigint")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_features")
