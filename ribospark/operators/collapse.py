"""Top rows, greedy overlap suppression, pad collapse, rejects and samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collapse_pads(scored: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per base_id: pads seen, its best row (score, then lesser pad, then lesser hairpin), ties and an audit text.

    carry: columns of the best row to keep. Scores are compared as they are and shown with six places; of rows with one
    pad the audit text has the last by hairpin length and score. Groups without a numeric score are left out (pad_rejects).
    """
    big = lambda c: F.when(F.col(c).isNull() | (F.col(c) == 0), 1_000_000_000).otherwise(F.col(c))
    x = scored.withColumn("rf_score", F.when(~F.isnan("rf_score"), F.col("rf_score")))
    best = F.min(F.when(F.col("rf_score").isNotNull(), F.struct((-F.col("rf_score")).alias("k"), big("pad").alias("p"), big("hp_len").alias("h"), "pad", "rf_score", "pred_label", *carry))).alias("b")
    rows = F.collect_list(F.struct("pad", "hp_len", "rf_score"))
    g = x.groupBy("base_id").agg(F.array_sort(F.collect_set("pad")).alias("pads_seen"), best, F.sort_array(F.collect_list("rf_score"), asc=False).alias("ss"), F.array_sort(rows).alias("rows"))
    g = g.where(F.col("b").isNotNull()).withColumn("rows", F.filter("rows", lambda r: r["rf_score"].isNotNull() & r["pad"].isNotNull()))
    last = F.filter("rows", lambda r, i: ~F.coalesce(F.get("rows", i + 1)["pad"] == r["pad"], F.lit(False)))
    audit = F.array_join(F.transform(last, lambda r: F.concat(r["pad"].cast("string"), F.lit(":"), F.format_string("%.6f", r["rf_score"]))), ",")
    tie = F.coalesce(F.get("ss", 0) == F.get("ss", 1), F.lit(False))
    kept = [F.col("b")[c].alias(c) for c in carry]
    return g.select("base_id", F.array_join(F.transform("pads_seen", lambda p: p.cast("string")), ",").alias("pads_seen"), F.size("pads_seen").alias("n_pads"), F.col("b.pad").alias("best_pad"), F.round("b.rf_score", 6).alias("best_rf_score"), F.col("b.pred_label").alias("best_pred_label"), tie.alias("is_tie"), audit.alias("pad_scores"), *kept)


def overlap_nms(hits: DataFrame, key: str = "input_id", share: float = 0.7) -> DataFrame:
    """Greedy by falling score, then start: a hit goes if it shares at least that much of the shorter with a kept one."""
    kind = "array<struct<s:bigint,e:bigint,score:double>>"
    cut = lambda x, k: F.greatest(F.lit(0), F.least(x["e"], k["e"]) - F.greatest(x["s"], k["s"])) / F.greatest(F.least(x["e"] - x["s"], k["e"] - k["s"]), F.lit(1))
    fold = lambda a, x: F.when(F.exists(a, lambda k: cut(x, k) >= share), a).otherwise(F.concat(a, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"), x["score"].alias("score")))))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), F.col("start").cast("bigint").alias("s"), F.col("end").cast("bigint").alias("e"), F.col("score").cast("double").alias("score"))))
    kept = hits.groupBy(key).agg(rows.alias("r")).select(key, F.explode(F.aggregate("r", F.array().cast(kind), fold)).alias("h"))
    return kept.select(key, F.col("h.s").alias("start"), F.col("h.e").alias("end"), F.col("h.score").alias("score"))


def best_row(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by order, from an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    first = F.min(F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order)], *rest)).alias("__b")
    return df.groupBy(*key).agg(first).select(*key, *[F.col(f"__b.{c}").alias(c) for c in rest])


def best_of_scan(hits: DataFrame, key: Sequence[str], score: str = "rf_score", ties: Sequence[str] = ("start",)) -> DataFrame:
    """The row of the greatest numeric score of each key; rows without one never win."""
    real = hits.where(F.col(score).isNotNull() & ~F.isnan(score))
    return best_row(real, key, [-F.col(score), *[F.col(c) for c in ties]])


def pad_rejects(scored: DataFrame) -> DataFrame:
    """Audit rows (base_id, reject_reason) of collapse_pads: a single pad, or no numeric score."""
    real = F.count(F.when(F.col("rf_score").isNotNull() & ~F.isnan("rf_score"), 1))
    g = scored.groupBy("base_id").agg(F.countDistinct("pad").alias("n"), real.alias("m"))
    why = F.array_compact(F.array(F.when(F.col("n") < 2, "MissingPadVariant"), F.when(F.col("m") == 0, "NoNumericRFScore")))
    return g.select("base_id", F.explode(why).alias("reject_reason"))


def percent_of_best(df: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Per key: (scores at most the best - 1) / (n - 1), 1 where n is 1."""
    g = df.groupBy(key).agg(F.max(score).alias("best"), F.count(score).alias("n"))
    return g.select(key, F.when(F.col("n") <= 1, 1.0).otherwise((F.col("n") - 1) / (F.col("n") - 1)).alias("percentile"))


def merge_rejects(frames: dict[str, DataFrame], base: Sequence[str]) -> DataFrame:
    """All audit tables in one, base columns first and the others by name, with the table each row came from."""
    marked = [df.withColumn("source_rejects", F.lit(name)) for name, df in frames.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    first = [c for c in base if c in out.columns]
    return out.select(*first, *sorted(c for c in out.columns if c not in {*first, "source_rejects"}), "source_rejects")


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that pass (without reject_reason) and rows that do not."""
    return df.where("reject_reason IS NULL").drop("reject_reason"), df.where("reject_reason IS NOT NULL")


def hash_sample(df: DataFrame, n: int, id_col: str, by: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """n rows (of each group) by a seeded hash of their id: the same rows on every run."""
    key = F.xxhash64(F.col(id_col), F.lit(seed))
    if not by:
        return df.orderBy(key, id_col).limit(n)
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(key, id_col))).where(F.col("__r") <= n).drop("__r")


def fold_of(id_col: Column, folds: int, seed: int = 42) -> Column:
    """Fold number by hash; rows of one group share their fold if id_col is the group."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(folds)).cast("int")


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    return best_row(df, [key], [F.col(order)])
