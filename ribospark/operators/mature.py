"""Mature-arm candidates on hairpins: starts, virtual duplexes and their features, relevance, ranking and its measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ribospark.functions.sequence import end_stability
from ribospark.functions.structure import apical_loop, let, pair_map
from ribospark.operators.collapse import best_row


def _paired(pair: Column, a: Column, b: Column) -> Column:
    """Partners of the paired positions from a up to b."""
    return F.filter(F.slice(pair, a + 1, F.greatest(b - a, F.lit(0))), lambda p: p != -1)


def starts(n: Column, loop: Column, pair: Column, most: int = 30, context: int = 6, buffer: int = 0) -> Column:
    """array(arm, start): the first starts of each arm, outside the loop, with half of the next bases paired."""
    at = F.sequence(F.lit(0), n - 1)
    fits = lambda i: F.lit(True) if context <= 0 else F.size(_paired(pair, i, F.least(n, i + context))) >= max(1, context // 2)
    outside = lambda i: (i < loop["start"]) | (i >= loop["end"])
    last5 = F.least(F.greatest(F.lit(0), loop["start"] - 1 + buffer), n - 1)
    first3 = F.least(F.greatest(F.lit(0), loop["end"] - buffer), n - 1)
    arm = lambda name, on: F.transform(F.slice(F.filter(at, lambda i: on(i) & outside(i) & fits(i)), 1, most), lambda i: F.struct(F.lit(name).alias("arm"), i.alias("start")))
    return F.concat(arm("5p", lambda i: i <= last5), arm("3p", lambda i: i >= first3))


def duplex_candidates(folds: DataFrame, lengths: Sequence[int] = (21, 22, 23, 24), most: int = 30, context: int = 6, buffer: int = 0) -> DataFrame:
    """Feasible windows (id, cand, arm, start, length, end, feat_*) of folds (id, seq, struct); cand counts them in order.

    A structure without an unpaired run has an empty loop at its start.
    """
    none = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("length"))
    x = folds.where(F.length("struct") > 0).select("id", "seq", "struct", F.coalesce(apical_loop(F.col("struct")), none).alias("loop"), pair_map(F.col("struct")).alias("pair"))
    x = x.withColumn("s", F.explode(starts(F.length("struct"), F.col("loop"), F.col("pair"), most, context, buffer)))
    x = x.select("id", "seq", "struct", "loop", "pair", "s.arm", "s.start", F.explode(F.array(*map(F.lit, lengths))).alias("length"))
    x = x.withColumn("end", F.col("start") + F.col("length")).where(F.col("end") <= F.length("seq"))
    window = F.slice("pair", F.col("start") + 1, F.col("length"))
    x = x.withColumns({"w": window, "ps": F.filter(window, lambda p: p != -1)})
    five = F.col("arm") == "5p"
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    tail = F.length(F.regexp_extract(F.substring("struct", F.col("start") + 1, F.col("length")), r"\.*$", 0))
    tail = F.when(five, 0.0).otherwise(tail.cast("double"))
    feats = {
        "feat_arm_5p": one(five),
        "feat_len": F.col("length").cast("double"),
        "feat_dist_loop": F.when(five, F.col("loop.start") - F.col("end")).otherwise(F.col("start") - F.col("loop.end")).cast("double"),
        "feat_dist_base": F.when(five, F.col("start")).otherwise(F.length("seq") - F.col("end")).cast("double"),
        "feat_paired_frac": F.size("ps") / F.col("length"),
        "feat_starts_U": one(F.substring("seq", F.col("start") + 1, F.lit(1)) == "U"),
        "feat_stability": end_stability(F.substring("seq", F.col("start") + 1, F.col("length"))).cast("double"),
        "feat_cut_unpaired": one(F.substring("struct", F.col("start") + 1, F.lit(1)) == "."),
        "feat_overhang_proxy": F.coalesce((F.array_max("ps") - F.get("ps", 0)).cast("double"), F.lit(0.0)),
        "feat_end_is_paired": one(F.get("w", F.col("length") - 1) != -1),
        "feat_3p_tail_unpaired": tail,
        "feat_3p_tail_abs2": F.abs(tail - 2.0),
    }
    cand = F.struct(F.when(five, 0).otherwise(1).alias("arm"), "start", "length").alias("cand")
    # -90 and less marks an infeasible window; an overhang is never below -len(seq)
    return x.select("id", cand, "arm", "start", "length", "end", *[c.alias(k) for k, c in feats.items()]).where("feat_overhang_proxy > -90")


def length_features(n: Column) -> dict[str, Column]:
    return {"feat_len_abs22": F.abs(n - 22).cast("double")} | {f"feat_len_is{k}": F.when(n == k, 1.0).otherwise(0.0) for k in range(21, 25)}


def locate(mature: DataFrame, precursors: DataFrame) -> DataFrame:
    """mature (base_id, arm, seq) with t_start, its first place in the precursor (base_id, pre), and t_len; others are dropped."""
    x = mature.join(precursors.select("base_id", "pre"), "base_id").withColumn("t_start", F.expr("instr(pre, seq)") - 1)
    return x.where("t_start >= 0 AND seq <> ''").withColumn("t_len", F.length("seq")).drop("pre")


def relevance(start: Column, length: Column, t_start: Column, t_len: Column, near_start: int = 2, near_len: int = 1) -> Column:
    """2 for the true window, 1 for one near it, 0 else or without a truth of the arm."""
    near = (F.abs(start - t_start) <= near_start) & (F.abs(length - t_len) <= near_len)
    return F.when((start == t_start) & (length == t_len), 2).when(near, 1).otherwise(0)


def pick(candidates: DataFrame, score: str = "score") -> DataFrame:
    """The best scored candidate of each id; ties go to the first."""
    return best_row(candidates, ["id"], [-F.col(score), F.col("cand")])


def predict(folds: DataFrame, candidates: DataFrame, score: str = "score") -> DataFrame:
    """One row per record of folds (id, seq): its mature window, or nulls where none is feasible."""
    best = pick(candidates.select("id", "cand", "arm", "start", "end", "length", F.col(score).alias("score"))).drop("cand")
    return folds.select("id", "seq").join(best, "id", "left").withColumn("mature_seq", F.substring("seq", F.col("start") + 1, F.col("length"))).drop("seq")


def ranking_metrics(picked: DataFrame, near: int = 2) -> DataFrame:
    """Shares of groups whose pick (arm, start, length, t_arm, t_start, t_len) is exact, near, of the true start, of the true arm, or right but for its length."""
    arm, start, size = F.col("arm") == F.col("t_arm"), F.col("start") == F.col("t_start"), F.col("length") == F.col("t_len")
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    close = F.abs(F.col("start") - F.col("t_start")) <= near
    return picked.agg(F.count("*").alias("n"), share(arm & start & size).alias("exact"), share(arm & close).alias("near"), share(arm & start).alias("start"), share(arm).alias("arm"), share(arm & start & ~size).alias("length_wrong"))


def arms_face(pair: Column, s5: Column, e5: Column, s3: Column, e3: Column, share: float = 0.5, least: int = 6) -> Column:
    """Whether enough of each window's bases pair into the other."""
    hits = lambda a, b, x, y: F.size(F.filter(F.slice(pair, a + 1, F.greatest(b - a, F.lit(0))), lambda p: (p >= x) & (p < y)))
    part = lambda n, a, b: F.when(b > a, n / (b - a)).otherwise(0.0)
    whole = F.struct(hits(s5, e5, s3, e3).alias("n5"), hits(s3, e3, s5, e5).alias("n3"))
    return let(whole, lambda h: (part(h["n5"], s5, e5) >= share) & (part(h["n3"], s3, e3) >= share) & (h["n5"] >= least) & (h["n3"] >= least))


def best_windows(folds: DataFrame, shortest: int = 18, longest: int = 26, step: int = 2) -> DataFrame:
    """Per id and arm of folds (id, seq, struct) the window of the best heuristic score; ties go to the shorter, then the first."""
    from ribospark.functions.structure import heuristic_mature

    none = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("length"))
    x = folds.where(F.length("struct") > 0).select("id", "struct", F.coalesce(apical_loop(F.col("struct")), none).alias("loop"))
    n = F.length("struct")
    arms = F.array(F.struct(F.lit("5p").alias("arm"), F.lit(0).alias("lo"), F.col("loop.start").alias("hi")), F.struct(F.lit("3p").alias("arm"), F.col("loop.end").alias("lo"), n.alias("hi")))
    x = x.select("id", "struct", F.explode(arms).alias("a")).select("id", "struct", "a.*")
    x = x.select("id", "struct", "arm", "lo", "hi", F.explode(F.sequence(F.lit(shortest), F.lit(longest))).alias("length")).where(F.col("hi") - F.col("lo") >= F.col("length"))
    x = x.select("id", "struct", "arm", "length", F.explode(F.sequence(F.col("lo"), F.col("hi") - F.col("length"), F.lit(step))).alias("start"))
    score = heuristic_mature(F.substring("struct", F.col("start") + 1, F.col("length")))
    return best_row(x.select("id", "arm", "length", "start", score.alias("score")), ["id", "arm"], [-F.col("score"), F.col("length"), F.col("start")])
