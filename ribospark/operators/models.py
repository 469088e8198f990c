"""Models over feature columns: assembly, forests, calibration, scores with a threshold, and the scan of long sequences."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ribospark.functions.sequence import windows
from ribospark.functions.structure import anchor, base_pairs, stem_runs, tier1
from ribospark.operators.collapse import overlap_nms

Fold = Callable[[DataFrame], DataFrame]


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """df with a vector of the features in that order; a missing column, a null and a NaN are 0."""
    from pyspark.ml.feature import VectorAssembler

    value = lambda c: F.coalesce(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), F.lit(0.0)) if c in df.columns else F.lit(0.0)
    marked = df.withColumns({f"__f_{c}": value(c) for c in features})
    return VectorAssembler(inputCols=[f"__f_{c}" for c in features], outputCol=out).transform(marked).drop(*[f"__f_{c}" for c in features])


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """df with weight = rows / (classes * rows of the class); the counts are one row per class."""
    n = df.groupBy(label).agg(F.count("*").alias("__n"))
    t = n.agg(F.sum("__n").alias("__t"), F.count("*").alias("__c"))
    w = n.join(F.broadcast(t)).select(label, (F.col("__t") / (F.col("__c") * F.col("__n"))).alias("weight"))
    return df.join(F.broadcast(w), label)


def train_forest(df: DataFrame, features: Sequence[str], label: str = "label", trees: int = 500, depth: int = 10, seed: int = 42):
    """A random forest over the features with balanced weights."""
    from pyspark.ml.classification import RandomForestClassifier

    x = balanced(assemble(df, features), label)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol=label, weightCol="weight").fit(x)


def score(df: DataFrame, model, features: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """df with rf_score, the probability of label 1, and pred_label: 1 from the threshold on."""
    from pyspark.ml.functions import vector_to_array

    x = model.transform(assemble(df, features))
    return x.withColumn("rf_score", F.get(vector_to_array("probability"), 1)).withColumn("pred_label", (F.col("rf_score") >= threshold).cast("int")).select(*df.columns, "rf_score", "pred_label")


def calibrate(df: DataFrame, how: str = "isotonic", score_col: str = "rf_score", label: str = "label"):
    """A calibrator fitted on held-out scores: isotonic, or sigmoid (a logistic regression of one feature)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.regression import IsotonicRegression

    x = assemble(df, [score_col], "__s")
    if how == "isotonic":
        return IsotonicRegression(featuresCol="__s", labelCol=label).fit(x)
    return LogisticRegression(featuresCol="__s", labelCol=label).fit(x)


def calibrated(df: DataFrame, calibrator, score_col: str = "rf_score") -> DataFrame:
    """df with calibrated beside its raw score."""
    from pyspark.ml.functions import vector_to_array

    x = calibrator.transform(assemble(df, [score_col], "__s"))
    value = F.get(vector_to_array("probability"), 1) if "probability" in x.columns else F.col("prediction")
    return x.withColumn("calibrated", value).select(*df.columns, "calibrated")


def importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """feature, importance; the most important first. One row per feature."""
    rows = list(zip(features, map(float, model.featureImportances.toArray()), strict=True))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save(model, features: Sequence[str], path: str, threshold: float | None = None, reference: dict[str, float] | None = None) -> None:
    """The model and, beside it, one JSON row with its columns, its threshold and its reference thresholds."""
    spark = SparkSession.getActiveSession()
    model.save(f"{path}/model")
    side = json.dumps({"feature_cols": list(features), "decision_threshold": threshold, "reference_thresholds": reference or {}})
    spark.createDataFrame([(side,)], "value string").coalesce(1).write.text(f"{path}/sidecar")


def load(spark: SparkSession, path: str):
    """(model, features, threshold, reference thresholds); a threshold of 0 stays, one that is unset is 0.5.

    A reference threshold may be named q95 or neg_q95; one that is missing is null.
    """
    from pyspark.ml.classification import RandomForestClassificationModel

    side = json.loads(spark.read.text(f"{path}/sidecar").first()["value"])
    cut = side.get("decision_threshold", side.get("threshold"))
    ref = side.get("reference_thresholds") or {}
    reference = {q: ref.get(q, ref.get(f"neg_{q}")) for q in ("q90", "q95", "q99")}
    return RandomForestClassificationModel.load(f"{path}/model"), side.get("feature_cols") or side.get("features") or [], 0.5 if cut is None else cut, reference


def primary_hairpin(struct: Column) -> Column:
    """struct(start, end) of the first longest helix, from its first base to the partner; null without a pair."""
    first = anchor(stem_runs(base_pairs(struct)))
    return F.when(first.isNotNull(), F.struct(first["start_i"].alias("start"), (first["start_j"] + 1).alias("end")))


def hairpins(seqs: DataFrame, fold: Fold, width: int = 120, step: int = 20, shortest: int = 0, longest: int = 1 << 30) -> DataFrame:
    """Refolded hairpins (input_id, start, end, seq, struct, mfe) of seqs' windows (input_id, seq): fold, energy gate, crop to the primary hairpin, fold again."""
    x = seqs.select("input_id", "seq", F.explode(windows(F.col("seq"), width, step)).alias("w0"))
    x = fold(x.select("input_id", "w0", F.substring("seq", F.col("w0") + 1, F.lit(width)).alias("seq")))
    x = x.where(tier1(F.col("seq"), F.col("struct"), F.col("mfe"), longest=max(width, 120))).withColumn("h", primary_hairpin(F.col("struct"))).where("h IS NOT NULL")
    n = F.col("h.end") - F.col("h.start")
    x = x.where(n.between(shortest, longest)).select("input_id", (F.col("w0") + F.col("h.start")).alias("start"), (F.col("w0") + F.col("h.end")).alias("end"), F.col("seq").substr(F.col("h.start") + 1, n).alias("seq"))
    return fold(x)


def scan(seqs: DataFrame, fold: Fold, scorer: Fold, width: int = 120, step: int = 20, share: float = 0.7) -> DataFrame:
    """Scored hairpins (input_id, start, end, score) of long sequences after overlap suppression; scorer adds rf_score."""
    hits = scorer(hairpins(seqs, fold, width, step)).select("input_id", "start", "end", F.col("rf_score").alias("score")).distinct()
    return overlap_nms(hits, "input_id", share)


def predict_sequences(seqs: DataFrame, fold: Fold, scorer: Fold, threshold: float = 0.5, direct: int = 120, longest: int = 5000, width: int = 120, step: int = 20) -> DataFrame:
    """input_id, mode, start, end, length, rf_score, pred_label of seqs (input_id, seq).

    Up to direct bases: the whole sequence; up to longest: a scan; beyond: too_long, with a NaN score and label -1.
    """
    n = F.length("seq")
    whole = scorer(fold(seqs.where(n <= direct))).select("input_id", F.lit("direct").alias("mode"), F.lit(0).cast("long").alias("start"), n.cast("long").alias("end"), "rf_score")
    found = scan(seqs.where((n > direct) & (n <= longest)), fold, scorer, width, step).select("input_id", F.lit("scan").alias("mode"), "start", "end", F.col("score").alias("rf_score"))
    over = seqs.where(n > longest).select("input_id", F.lit("too_long").alias("mode"), F.lit(0).cast("long").alias("start"), n.cast("long").alias("end"), F.lit(float("nan")).alias("rf_score"))
    x = whole.unionByName(found).unionByName(over)
    label = F.when(F.isnan("rf_score"), -1).otherwise((F.col("rf_score") >= threshold).cast("int"))
    return x.select("input_id", "mode", "start", "end", (F.col("end") - F.col("start")).alias("length"), "rf_score", label.alias("pred_label"))


def with_audit(candidates: DataFrame, hits: DataFrame, key: str = "candidate_id") -> tuple[DataFrame, DataFrame]:
    """(candidates with their best hit or nulls, audit rows of those without one)."""
    x = candidates.join(hits, key, "left")
    return x, x.where("rf_score IS NULL").select(key, F.lit("NoHairpin").alias("reject_reason"))


def reextracted(verdicts: DataFrame, again: DataFrame, key: str = "id") -> DataFrame:
    """verdicts (key, b_score, verdict) replaced by again's rows where the new score is strictly greater."""
    a = again.select(key, F.col("b_score").alias("__b"), F.col("verdict").alias("__v"))
    x = verdicts.join(a, key, "left")
    up = F.coalesce(F.col("__b") > F.col("b_score"), F.lit(False))
    return x.withColumns({"verdict": F.when(up, F.col("__v")).otherwise(F.col("verdict")), "b_score": F.when(up, F.col("__b")).otherwise(F.col("b_score"))}).drop("__b", "__v")
