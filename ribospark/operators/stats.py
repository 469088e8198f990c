"""Report aggregates: quantiles, histograms, model quality, tail risk, breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantiles(score: str, ps: Sequence[float]) -> list[Column]:
    """Exact, linearly interpolated."""
    return [F.percentile(score, F.lit(p)).alias(f"q{round(100 * p)}") for p in ps]


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per metric: n, min, max, mean, population std and the 10/50/90/95/99 % quantiles."""
    long = df.unpivot([*by], list(cols), "metric", "value")
    aggs = [F.count("value").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")]
    return long.groupBy(*by, "metric").agg(*aggs, *quantiles("value", (0.1, 0.5, 0.9, 0.95, 0.99)))


def histogram(df: DataFrame, score: str, bins: int) -> DataFrame:
    """Counts of equal bins on [0, 1]; the last bin is closed."""
    return df.groupBy(F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def tail_risk(df: DataFrame, q95: float, q99: float) -> DataFrame:
    """Per bucket: sizes, extremes and the share of scores above two thresholds."""
    above = lambda t: F.count_if(F.col("score") > t)
    g = df.groupBy("bucket").agg(F.count("*").alias("n_samples"), F.max("score").alias("max_score"), F.avg("score").alias("mean_score"), F.percentile("score", F.lit(0.5)).alias("median_score"), above(q95).alias("above_q95"), above(q99).alias("above_q99"))
    return g.withColumns({"frac_above_q95": F.col("above_q95") / F.col("n_samples"), "frac_above_q99": F.col("above_q99") / F.col("n_samples")})


def tail_alerts(risk: DataFrame) -> DataFrame:
    """Alerts over the whole tail table: greatest score, rate above q99 per 1000, N2 above N3."""
    rate = lambda b: F.max(F.when(F.col("bucket") == b, F.col("frac_above_q99")))
    t = risk.agg(F.max("max_score").alias("top"), (1000 * F.sum("above_q99") / F.sum("n_samples")).alias("rate"), rate("N2").alias("r2"), rate("N3").alias("r3"))
    return t.select((F.col("top") > 0.9).alias("high_max"), (F.col("rate") > 50).alias("high_rate"), ((F.col("r2") > F.col("r3")) & (1000 * F.col("r2") > 10)).alias("n2_above_n3"))


def binary_counts(df: DataFrame) -> DataFrame:
    """Cumulative true and false positives by falling threshold: one row per distinct score."""
    by = df.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("q"))
    w = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return by.select("score", "p", "q", F.sum("p").over(w).alias("tp"), F.sum("q").over(w).alias("fp"))


def binary_metrics(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Confusion matrix, accuracy, ROC AUC, average precision, Brier score and the threshold of greatest F1.

    The running sums are over distinct scores; scores are rounded beforehand where their number must be bounded.
    """
    c = binary_counts(df)
    n = df.agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"), F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("brier"),
               *[F.count_if((F.col("label") == l) & ((F.col("score") >= threshold) == bool(h))).alias(k) for k, l, h in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))])
    x = c.withColumnsRenamed({"tp": "ctp", "fp": "cfp"}).join(F.broadcast(n))
    auc = F.sum(F.col("q") * (F.col("ctp") - F.col("p") / 2)) / F.first(F.col("pos") * F.col("neg"))
    ap = F.sum(F.col("p") / F.col("pos") * F.col("ctp") / (F.col("ctp") + F.col("cfp")))
    f1 = 2 * F.col("ctp") / (F.col("ctp") + F.col("cfp") + F.col("pos"))
    best = F.min(F.struct((-F.round(f1, 12)).alias("k"), (-F.col("score")).alias("s"))).alias("b")
    out = x.agg(auc.alias("roc_auc"), ap.alias("avg_precision"), best, *[F.first(k).alias(k) for k in ("brier", "tn", "fp", "fn", "tp")])
    return out.select("tn", "fp", "fn", "tp", ((F.col("tn") + F.col("tp")) / (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))).alias("accuracy"), "roc_auc", "avg_precision", "brier", (-F.col("b.s")).alias("best_threshold"))


def reference_thresholds(df: DataFrame) -> DataFrame:
    """Quantiles of the negatives' scores and the share of negatives at or above each."""
    neg = df.where("label = 0")
    q = neg.agg(*quantiles("score", (0.9, 0.95, 0.99)))
    x = neg.select("score").join(F.broadcast(q))
    return x.agg(*[F.first(k).alias(k) for k in ("q90", "q95", "q99")], *[F.avg((F.col("score") >= F.col(k)).cast("double")).alias(f"fpr_{k}") for k in ("q90", "q95", "q99")])


def separation(df: DataFrame) -> DataFrame:
    """Overlap of negatives with the positives' quantiles, their gap and its verdict."""
    q = df.agg(*[F.percentile(F.when(F.col("label") == l, F.col("score")), F.lit(p)).alias(k) for k, l, p in (("p10", 1, 0.1), ("p25", 1, 0.25), ("p50", 1, 0.5), ("n75", 0, 0.75))], F.avg(F.when(F.col("label") == 1, F.col("score"))).alias("mean_pos"))
    x = df.where("label = 0").join(F.broadcast(q))
    shares = [F.avg((F.col("score") >= F.col(k)).cast("double")).alias(f"neg_above_{k}") for k in ("p10", "p25", "p50")]
    out = x.agg(*shares, F.first(F.col("p25") - F.col("n75")).alias("gap"), F.first("mean_pos").alias("mean_pos"))
    kind = F.when(F.col("gap") > 0.3, "good").when(F.col("gap") > 0.1, "moderate").otherwise("poor")
    return out.withColumns({"separation": kind, "crushed": F.col("mean_pos") < 0.3})


def breakdowns(df: DataFrame) -> DataFrame:
    """Counts by label, by database, by repeat and by label and repeat, in one pass."""
    sets = [["final_label"], ["known_db"], ["repeat_class"], ["final_label", "repeat_class"]]
    cols = ["final_label", "known_db", "repeat_class"]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(F.count("*").alias("n"))


def probability_checks(df: DataFrame) -> DataFrame:
    """Sanity of scores: out of range, distinct values at four places, share of the most common one."""
    by = df.groupBy(F.round("score", 4).alias("s")).agg(F.count("*").alias("n"), F.count_if((F.col("score") < 0) | (F.col("score") > 1)).alias("bad"))
    t = by.agg(F.sum("bad").alias("out_of_range"), F.count("*").alias("n_distinct"), (F.max("n") / F.sum("n")).alias("top_share"))
    return t.withColumns({"too_few": F.col("n_distinct") < 5, "concentrated": F.col("top_share") > 0.9})


def scan_report(df: DataFrame, q95: float, score: str = "score") -> DataFrame:
    """Count, median and whether it lies outside 0.1 to 0.5, scores above 0.9, and the count and share from q95 on."""
    n, s = F.count("*"), F.col(score)
    g = df.agg(n.alias("n"), F.median(score).alias("median"), F.count_if(s > 0.9).alias("above_09"), F.count_if(s >= q95).alias("above_q95"))
    return g.select("n", "median", (~F.col("median").between(0.1, 0.5)).alias("off_band"), "above_09", "above_q95", (F.col("above_q95") / F.col("n")).alias("share_q95"))
