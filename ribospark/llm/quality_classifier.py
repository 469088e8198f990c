"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text; label 0 is never read. A first classifier of positives
against unlabelled text gives the class prior: the least ratio, over score thresholds, of the shares of
unlabelled and of positive texts above it, with a confidence margin (best-bin estimation, Garg et al.
2021). The second minimises the non-negative unbiased risk (Kiryo et al. 2017)

    prior * R_P(+) + max(0, R_U(-) - prior * R_P(-))

with the sigmoid loss; where the second part turns negative, the step goes against it. Both are networks of
one hidden layer on measurements of the text alone (shares of character classes, word and line statistics);
language, source and ids are no inputs.

The model is fitted on the driver on at most about MAX_SAMPLE texts of either kind, picked by a hash of
doc_id; every text is scored in Arrow batches.

Edge cases: null and empty texts are scored like any other (all measurements are zero); without positives or
without unlabelled texts every score is 0.5; repeated rows are scored one by one; a null doc_id is never
learned from and not held out; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table, tidied

#: Texts of either kind that the model is fitted on, about.
MAX_SAMPLE = 20_000
HIDDEN = 24
SIGNS = b"!#*$%&|<>.,?;:\"'-_+=/()[]{}@~^\\"


def measurements(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).tolist()
    words = raw.split()
    n, nb = max(1, len(words)), max(1, len(raw))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    nl = max(1, len(lines))
    seen = Counter(words)
    pairs = set(zip(words, words[1:]))
    upper = sum(w.isupper() for w in words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        *(count[c] / n for c in SIGNS),
        sum(count[65:91]) / nb,
        sum(count[97:123]) / nb,
        sum(count[48:58]) / nb,
        sum(count[128:]) / nb,
        count[10] / n,
        np.log1p(len(words)),
        np.log1p(nb) - np.log1p(n),
        len(seen) / n,
        max(seen.values(), default=0) / n,
        len(pairs) / n,
        upper / n,
        same / n,
        1 - len(set(lines)) / nl,
        np.log1p(n / nl),
    ]


def _scale(x: np.ndarray) -> np.ndarray:
    return np.log1p(20 * np.maximum(x, 0))


@dataclass
class Net:
    """A network with one hidden layer; params are its arrays, mean and std those of the scaled inputs."""

    mean: np.ndarray
    std: np.ndarray
    params: list[np.ndarray]

    @staticmethod
    def new(x: np.ndarray, seed: int) -> Net:
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        params = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        return Net(x.mean(0), x.std(0) + 1e-2, params)

    def prepare(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -6, 6)

    def forward(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(z @ self.params[0] + self.params[1])
        return h, h @ self.params[2] + self.params[3][0]

    def gradient(self, z: np.ndarray, h: np.ndarray, dg: np.ndarray) -> list[np.ndarray]:
        dh = dg[:, None] * self.params[2] * (1 - h * h)
        return [z.T @ dh, dh.sum(0), h.T @ dg, np.array([dg.sum()])]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(self.prepare(x))[1], -30, 30)))


def _train(net: Net, xp: np.ndarray, xu: np.ndarray, risk, epochs: int, seed: int, rate: float = 3e-3, decay: float = 1e-4) -> None:
    """Adam on batches of both kinds; risk gives the derivatives by the outputs on positives and on unlabelled."""
    rng = np.random.default_rng(seed)
    zp, zu = net.prepare(xp), net.prepare(xu)
    m, v, t = [np.zeros_like(p) for p in net.params], [np.zeros_like(p) for p in net.params], 0
    size = 512
    for _ in range(epochs):
        op, ou = rng.permutation(len(zp)), rng.permutation(len(zu))
        for i in range(max(1, max(len(zp), len(zu)) // size)):
            bp = zp[op.take(np.arange(i * size, i * size + min(size, len(zp))), mode="wrap")]
            bu = zu[ou.take(np.arange(i * size, i * size + min(size, len(zu))), mode="wrap")]
            hp, gp = net.forward(bp)
            hu, gu = net.forward(bu)
            dp, du = risk(gp, gu)
            grads = [a + b for a, b in zip(net.gradient(bp, hp, dp), net.gradient(bu, hu, du), strict=True)]
            t += 1
            for j, g in enumerate(grads):
                g = g + decay * net.params[j]
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                net.params[j] -= rate * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _logistic(gp, gu):
    """Positives against unlabelled, both of equal weight."""
    return -(1 - _sigmoid(gp)) / len(gp), _sigmoid(gu) / len(gu)


def _nn_risk(prior: float):
    def risk(gp, gu):
        sp, su = _sigmoid(gp), _sigmoid(gu)
        slope_p, slope_u = sp * (1 - sp) / len(gp), su * (1 - su) / len(gu)
        # sigmoid loss: of the positive class 1 - s, of the negative class s
        rest = su.mean() - prior * sp.mean()
        if rest < 0:
            return prior * slope_p, -slope_u
        return -2 * prior * slope_p, slope_u

    return risk


def estimate_prior(sp: np.ndarray, su: np.ndarray) -> float:
    """Best-bin estimate of the share of positives among the unlabelled, from scores of held-back texts."""
    cuts = np.unique(np.concatenate((sp, su)))
    fp = 1 - np.searchsorted(np.sort(sp), cuts, side="left") / len(sp)
    fu = 1 - np.searchsorted(np.sort(su), cuts, side="left") / len(su)
    margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    bound = np.where(fp > 0, (fu + margin) / np.maximum(fp, 1e-12), np.inf)
    best = int(bound.argmin())
    return float(np.clip(fu[best] / max(fp[best], 1e-12), 0.05, 0.98))


@dataclass
class PUClassifier:
    net: Net
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.net.score(_scale(x))


def fit(xp: np.ndarray, xu: np.ndarray, seed: int = 7, epochs: int = 30) -> PUClassifier | None:
    """The classifier of measurements of positives and of unlabelled texts; None if either is missing."""
    if not len(xp) or not len(xu):
        return None
    xp, xu = _scale(xp), _scale(xu)
    epochs = max(epochs, 400 // max(1, max(len(xp), len(xu)) // 512))
    first = Net.new(xu, seed)
    half_p, half_u = slice(0, None, 2), slice(0, None, 2)
    _train(first, xp[half_p], xu[half_u], _logistic, epochs, seed)
    back_p, back_u = xp[1::2] if len(xp) > 1 else xp, xu[1::2] if len(xu) > 1 else xu
    prior = estimate_prior(first.score(back_p), first.score(back_u))
    net = Net.new(xu, seed + 1)
    _train(net, xp, xu, _nn_risk(prior), 2 * epochs, seed + 1)
    return PUClassifier(net, prior)


def _measure(it):
    for b in it:
        x = [measurements(t) for t in b.column("text").to_pylist()]
        kind = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([b.column("positive"), pa.array(x, kind)], ["positive", "x"])


def fold(doc_id: Column, of: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def fit_documents(docs: DataFrame, labels: DataFrame, sample: int = MAX_SAMPLE) -> PUClassifier | None:
    """Fit on docs (doc_id, text): positives by labels (doc_id, quality), unlabelled those without a label; fold 1 of 3 is held out."""
    small_batches(docs.sparkSession)
    learn = docs.where(fold(F.col("doc_id"), 3) != 1).select("doc_id", F.col("text").cast("string").alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("positive")).where("doc_id IS NOT NULL AND positive IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.min("positive").alias("positive"))
    known = learn.select("doc_id").join(marks, "doc_id", "left").groupBy("positive").count().collect()
    counts = {r["positive"]: r["count"] for r in known}
    pick = lambda n: (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / max(1, n))))
    ids = learn.select("doc_id").join(marks, "doc_id", "left")
    ids = ids.where((F.col("positive") & pick(counts.get(True, 0))) | (F.col("positive").isNull() & pick(counts.get(None, 0))))
    ids = ids.select("doc_id", F.coalesce("positive", F.lit(False)).alias("positive")).distinct()
    # The sample has about 2 * sample rows whatever the input is, so its ids may be broadcast.
    rows = learn.join(F.broadcast(ids), "doc_id").select("doc_id", "positive", "text")
    got = rows.select("positive", "text").mapInArrow(tidied(_measure), "positive boolean, x array<double>").toPandas()
    if got.empty:
        return None
    x = np.array(got["x"].tolist())
    order = np.lexsort(x.T)  # the order of rows must not depend on how the cluster read them
    x, positive = x[order], got["positive"].to_numpy(bool)[order]
    rng = np.random.default_rng(3)
    mix = rng.permutation(len(x))
    x, positive = x[mix], positive[mix]
    return fit(x[positive], x[~positive])


def score_documents(docs: DataFrame, model: PUClassifier | None) -> DataFrame:
    """docs with score (double) and predicted (int); columns of these names are replaced."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    docs = docs.drop("score", "predicted")
    names = docs.columns

    def run(it):
        for b in it:
            texts = b.column(names.index("text")).to_pylist()
            s = np.full(len(texts), 0.5) if model is None or not texts else model.score(np.array([measurements(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*names, "score"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return docs.mapInArrow(tidied(run), schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_documents(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return score_documents(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")
