"""Feature vectors of (seq, struct, mfe): 18 core and 68 further columns, 86 in all."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import count_of, length1
from .structure import array_sum, base_pairs, bulge_bases, bulges, helix_stats, inner_runs, let, num_pairs, pair_shares, run_lengths, stem_runs

#: The motifs whose density is a feature.
MOTIFS = ("UGU", "UGUG", "GUG", "GCG", "CGC", "AUG")


def core(seq: Column, s: Column, mfe: Column) -> dict[str, Column]:
    n, u = length1(seq), F.upper(seq)
    share = lambda x: count_of(u, x) / n
    inner = inner_runs(s)
    loops = F.size(inner)
    total = array_sum(inner)
    pairs = num_pairs(s)
    return {
        "len": F.length(seq).cast("double"),
        "gc_frac": (count_of(u, "G") + count_of(u, "C")) / n,
        "au_frac": (count_of(u, "A") + count_of(u, "U")) / n,
        "g_frac": share("G"),
        "c_frac": share("C"),
        "a_frac": share("A"),
        "u_frac": share("U"),
        "num_pairs": pairs.cast("double"),
        "paired_frac": 2.0 * pairs / n,
        "unpaired_frac": 1.0 - 2.0 * pairs / n,
        "num_loops": loops.cast("double"),
        "mean_loop_size": F.when(loops > 0, total / loops).otherwise(0.0),
        "max_loop_size": F.coalesce(F.array_max(inner), F.lit(0)).cast("double"),
        "loop_unpaired_frac": total / length1(s),
        "num_bulges": bulge_bases(s).cast("double"),
        "bulge_density": bulge_bases(s) / length1(s),
        "mfe": mfe.cast("double"),
        "mfe_per_nt": mfe / n,
    }


def composition(seq: Column, mfe: Column) -> dict[str, Column]:
    """Energy by length, base shares and their balance, and densities of pairs and motifs."""
    n, u = length1(seq), F.upper(seq)
    c = {x: count_of(u, x) for x in "ACGU"}
    out = {"adj_mfe": mfe / n, **{f"pct_{x}": c[x] / n for x in "ACGU"}}
    out["imbalance_GA_CU"] = F.abs(c["G"] + c["A"] - c["C"] - c["U"]) / n
    out["imbalance_G_C"] = F.abs(c["G"] - c["C"]) / n
    for a, b in product("ACGU", repeat=2):
        out[f"di_{a}{b}"] = count_of(u, a + b) / F.greatest(F.length(seq) - 1, F.lit(1))
    for m in MOTIFS:
        out[f"tri_{m}"] = count_of(u, m) / F.greatest(F.length(seq) - 2, F.lit(1))
    return out


def segment_parts(seq: Column, s: Column) -> dict[str, Column]:
    """The four parts of sequence and structure; the last takes the rest."""
    n = F.length(seq)
    part = F.greatest(F.floor(n / 4).cast("int"), F.lit(1))
    out = {}
    for i in range(4):
        size = part if i < 3 else F.greatest(n - 3 * part, F.lit(0))
        out[f"__q{i}"] = F.substring(F.upper(seq), i * part + 1, size)
        out[f"__s{i}"] = F.substring(s, i * part + 1, size)
    return out


def segment_shares() -> dict[str, Column]:
    """Of segment_parts' columns: GC and opening brackets; null where a short sequence lacks the part."""
    out: dict[str, Column] = {}
    for i in range(4):
        q, s = F.col(f"__q{i}"), F.col(f"__s{i}")
        n = F.nullif(F.length(q), F.lit(0))
        out[f"seg{i + 1}_gc"] = F.length(F.regexp_replace(q, "[^GC]", "")) / n
        out[f"seg{i + 1}_paired_frac"] = 2.0 * F.length(F.regexp_replace(s, "[^(]", "")) / n
    return out


def segment_slopes() -> dict[str, Column]:
    """Last part minus first, missing parts as 0; null for an empty sequence."""
    change = lambda k: F.when(F.col("seg1_gc").isNotNull(), F.coalesce(F.col(f"seg4_{k}"), F.lit(0.0)) - F.col(f"seg1_{k}"))
    return {"gc_grad_last_first": change("gc"), "paired_grad_last_first": change("paired_frac")}


def stems(seq: Column, pairs: Column, runs: Column) -> dict[str, Column]:
    """Pair composition and helix statistics."""
    h = helix_stats(runs)
    named = {"helix_count": h["n_helices"], "helix_max_len": h["max_helix"], "helix_mean_len": h["mean_helix"], "anchor_stem_len": h["max_helix"]}
    shares = pair_shares(seq, pairs)
    kinds = {"pct_GC_pairs": "gc_pairs", "pct_AU_pairs": "au_pairs", "pct_GU_pairs": "gu_pairs", "pct_other_pairs": "other_pairs"}
    return {k: shares[v] for k, v in kinds.items()} | {k: c.cast("double") for k, c in named.items()}


def sided_bulges(pairs: Column, runs: Column) -> Column:
    """Unpaired runs inside the span of the pairs, each with its length and whether its centre is left of the middle."""
    lo, hi = F.array_min(F.transform(pairs, lambda p: p["i"])), F.array_max(F.transform(pairs, lambda p: p["j"]))

    def of(x: Column) -> Column:
        inside = F.filter(runs, lambda b: (b["start"] >= x["lo"]) & (b["end"] <= x["hi"] + 1))
        return F.transform(inside, lambda b: F.struct(b["length"].alias("n"), (b["start"] + b["end"] - 1 <= x["lo"] + x["hi"]).alias("left")))

    return F.coalesce(let(F.struct(lo.alias("lo"), hi.alias("hi")), of), F.array().cast("array<struct<n:int,left:boolean>>"))


def bulge_features(sided: Column) -> dict[str, Column]:
    """How many bulges, the longest on either side of the middle, chains of neighbours."""
    longest = lambda left: F.coalesce(F.array_max(F.transform(F.filter(sided, lambda b: b["left"] == left), lambda b: b["n"])), F.lit(0)).cast("double")
    n = F.size(sided)
    same = F.size(F.filter(F.transform(sided, lambda x, i: (i > 0) & (x["left"] == F.get(sided, i - 1)["left"])), lambda x: F.coalesce(x, F.lit(False))))
    return {
        "bulge_count": n.cast("double"),
        "bulge_max_left": longest(F.lit(True)),
        "bulge_max_right": longest(F.lit(False)),
        "bulge_chain_count": F.greatest(n - 1, F.lit(0)).cast("double"),
        "bulge_chain_same_side_count": same.cast("double"),
    }


def largest_loop(s: Column, runs: Column) -> Column:
    """struct(n, a): size and start of the largest run with brackets on both sides (ties: the last); null if none."""
    last = F.length(s)
    inner = F.filter(runs, lambda b: (b["start"] > 0) & (b["end"] < last))
    return F.array_max(F.transform(inner, lambda b: F.struct(b["length"].alias("n"), b["start"].alias("a"))))


def loop_motifs(seq: Column, s: Column, best: Column, near: Column) -> dict[str, Column]:
    """Motifs at the largest inner loop and the stem length against 40 bases; near is the loop with 10 bases either side."""
    u = F.translate(F.upper(seq), "T", "U")
    n = F.greatest(F.length(u), F.lit(1))
    size = F.coalesce(best["n"], F.lit(0))
    loop = F.when(best.isNotNull(), F.substring(u, best["a"] + 1, size)).otherwise("")
    cnnc = F.length(near) - F.length(F.regexp_replace(near, "C(?=..C)", ""))
    ugug, ugu, ug, stem = count_of(loop, "UGUG"), count_of(loop, "UGU"), count_of(F.substring(u, 1, 8), "UG"), num_pairs(s)
    off = F.abs(40 - stem)
    fit = F.when(off <= 3, 1.0).when(off <= 8, 0.75).when(off <= 13, 0.5).when(off <= 18, 0.25).otherwise(0.0)
    one = lambda c: F.when(c > 0, 1.0).otherwise(0.0)
    return {
        "pgs_score": one(ugug + ugu) + fit + one(ug) + one(cnnc),
        "pgs_loop_size": size.cast("double"),
        "pgs_stem_len": stem.cast("double"),
        "pgs_ugug_count": ugug.cast("double"),
        "pgs_ugu_count": ugu.cast("double"),
        "pgs_basal_ug_count": ug.cast("double"),
        "pgs_cnnc_loose_count": cnnc.cast("double"),
        "pgs_loop_size_norm": size / n,
        "pgs_stem_len_norm": stem / n,
    }


def near_loop(seq: Column, best: Column) -> Column:
    u = F.translate(F.upper(seq), "T", "U")
    a = F.greatest(best["a"] - 10, F.lit(0))
    return F.when(best.isNotNull(), F.substring(u, a + 1, F.least(best["a"] + best["n"] + 10, F.length(u)) - a)).otherwise(u)


def tier2_soft(seq: Column, s: Column, mfe: Column, on: bool = False) -> dict[str, Column]:
    """Soft geometry penalty: excess over four limits by scale and weight; zeros and a pass where tier 2 is off."""
    names = ("tier2_penalty", "tier2_mfe_per_nt", "tier2_loop_len", "tier2_unpaired_frac", "tier2_bulge_frac")
    if not on:
        return {"tier2_enabled": F.lit(0.0), "tier2_pass": F.lit(1.0)} | {k: F.lit(0.0) for k in names}
    free = count_of(s, ".")
    run = F.coalesce(F.array_max(run_lengths(s)), F.lit(0))
    per = mfe / length1(seq)
    share = F.when(F.length(s) > 0, free / F.length(s)).otherwise(0.0)
    bulged = F.least(F.lit(1.0), free / F.greatest(num_pairs(s) + count_of(s, ")"), F.lit(1)))
    over = lambda x, limit, scale: F.greatest(F.lit(0.0), (x - limit) / scale)
    penalty = over(per, -0.20, 0.05) + 0.7 * over(run, 22, 5.0) + over(bulged, 0.30, 0.10) + 0.8 * over(share, 0.55, 0.10)
    values = (penalty, per, run.cast("double"), share, bulged)
    return {"tier2_enabled": F.lit(1.0), "tier2_pass": F.when(penalty <= 0, 1.0).otherwise(0.0)} | dict(zip(names, values, strict=True))


def _stage(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """df with cols, computed here: the optimizer does not copy an expression across a generator."""
    one = F.explode(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))).alias("__g")
    return df.select("*", one).select(*[F.col(f"`{c}`") for c in df.columns], "__g.*")


def featurize(df: DataFrame, seq: str = "seq", struct: str = "struct", mfe: str = "mfe", tier2: bool = False) -> DataFrame:
    """df with all 86 features that it does not have yet; what several share is a column first, so it is computed once."""
    q, s, m = F.col(seq), F.col(struct), F.col(mfe)
    fold = F.when(F.length(s) > F.length(q), F.substring(s, F.lit(1), F.length(q))).otherwise(s)
    x = _stage(df, {"__pairs": base_pairs(s), "__bulges": bulges(s), "__fold": fold})
    x = _stage(x, {"__runs": stem_runs(F.col("__pairs")), "__sided": sided_bulges(F.col("__pairs"), F.col("__bulges")), "__best": largest_loop(F.col("__fold"), bulges(F.col("__fold"))), **segment_parts(q, s)})
    x = _stage(x, {"__near": near_loop(q, F.col("__best")), **segment_shares()})
    shares = {k: F.col(k) for k in segment_shares()}
    groups = (core(q, s, m), composition(q, m), shares | segment_slopes(), stems(q, F.col("__pairs"), F.col("__runs")), bulge_features(F.col("__sided")), loop_motifs(q, F.col("__fold"), F.col("__best"), F.col("__near")), tier2_soft(q, s, m, tier2))
    out = list(df.columns)
    for cols in groups:
        new = {k: c for k, c in cols.items() if k not in out}
        x = _stage(x, {f"__o_{k}": c for k, c in new.items()})
        out += new
    return x.select(*[F.col(f"__o_{c}").alias(c) if c not in df.columns else df[c] for c in out])
