"""Dot-bracket expressions: runs of unpaired bases, base pairs by a stack fold, helices and hairpins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import count_of, length1


def let(value: Column, body) -> Column:
    """body over value, computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def run_lengths(s: Column, pattern: str = r"\.+") -> Column:
    """Lengths of the maximal runs that match."""
    return F.transform(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), lambda x: F.length(x))


def inner_runs(s: Column) -> Column:
    """Unpaired runs with a paired symbol on both sides."""
    return run_lengths(F.regexp_replace(s, r"^\.+|\.+$", ""))


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def num_pairs(s: Column) -> Column:
    """Opening brackets, matched or not."""
    return count_of(s, "(")


def bulge_bases(s: Column) -> Column:
    """Unpaired bases with a paired neighbour on either side."""
    edge = F.when(s.rlike(r"[()]"), F.when(s.startswith("."), 1).otherwise(0) + F.when(s.endswith("."), 1).otherwise(0)).otherwise(0)
    return array_sum(F.transform(inner_runs(s), lambda n: F.least(n, F.lit(2)))) + edge


def base_pairs(s: Column) -> Column:
    """Matched pairs (i, j), 0-based, by i; brackets without a partner are left out."""
    zero = F.struct(F.array().cast("array<int>").alias("open"), F.array().cast("array<struct<i:int,j:int>>").alias("pairs"))

    def step(a: Column, x: Column) -> Column:
        depth = F.size(a["open"])
        popped = F.struct(F.slice(a["open"], F.lit(1), F.greatest(depth - 1, F.lit(0))).alias("open"), F.concat(a["pairs"], F.array(F.struct(F.try_element_at(a["open"], F.lit(-1)).alias("i"), x["i"].alias("j")))).alias("pairs"))
        pushed = F.struct(F.concat(a["open"], F.array(x["i"])).alias("open"), a["pairs"].alias("pairs"))
        return F.when(x["c"] == "(", pushed).when((x["c"] == ")") & (depth > 0), popped).otherwise(a)

    letters = F.transform(F.array_remove(F.split(s, ""), ""), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.array_sort(F.aggregate(letters, zero, step)["pairs"])


def stem_runs(pairs: Column) -> Column:
    """Helices of base_pairs: chains i+1, j-1, as (start_i, start_j, length) in order."""
    none = F.array().cast("array<struct<start_i:int,start_j:int,length:int>>")

    def step(a: Column, p: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        joins = (F.size(a) > 0) & (p["i"] == last["start_i"] + last["length"]) & (p["j"] == last["start_j"] - last["length"])
        longer = F.struct(last["start_i"].alias("start_i"), last["start_j"].alias("start_j"), (last["length"] + 1).alias("length"))
        new = F.struct(p["i"].alias("start_i"), p["j"].alias("start_j"), F.lit(1).alias("length"))
        return F.when(joins, F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(a, F.array(new)))

    return F.aggregate(pairs, none, step)


def pair_map(s: Column) -> Column:
    """Partner of each position, -1 where unpaired."""
    zero = lambda n: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.lit(-1))
    of = lambda ps: F.transform(zero(F.length(s)), lambda z, i: F.coalesce(F.get(F.transform(F.filter(ps, lambda p: (p["i"] == i) | (p["j"] == i)), lambda p: F.when(p["i"] == i, p["j"]).otherwise(p["i"])), 0), F.lit(-1)))
    return F.when(F.length(s) > 0, let(base_pairs(s), of)).otherwise(F.array().cast("array<int>"))


def helix_stats(runs: Column) -> dict[str, Column]:
    n = F.size(runs)
    lens = F.transform(runs, lambda r: r["length"])
    return {"n_helices": n, "max_helix": F.coalesce(F.array_max(lens), F.lit(0)), "mean_helix": F.when(n > 0, array_sum(lens) / n).otherwise(0.0)}


def anchor(runs: Column) -> Column:
    """The first longest helix."""
    best = lambda a, r: F.when(a.isNull() | (r["length"] > a["length"]), r).otherwise(a)
    return F.aggregate(runs, F.lit(None).cast("struct<start_i:int,start_j:int,length:int>"), best)


def pair_shares(seq: Column, pairs: Column) -> dict[str, Column]:
    """Shares of GC, AU, GU and other pairs."""
    base = lambda i: F.substring(F.translate(F.upper(seq), "T", "U"), i + 1, F.lit(1))
    kind = F.transform(pairs, lambda p: F.concat(base(p["i"]), base(p["j"])))
    n = F.greatest(F.size(pairs), F.lit(1))
    share = lambda *k: F.size(F.filter(kind, lambda x: x.isin(*k))) / n
    gc, au, gu = share("GC", "CG"), share("AU", "UA"), share("GU", "UG")
    return {"gc_pairs": gc, "au_pairs": au, "gu_pairs": gu, "other_pairs": F.when(F.size(pairs) > 0, 1 - gc - au - gu).otherwise(0.0)}


def bulges(s: Column) -> Column:
    """All unpaired runs as (start, end, length), 0-based half-open."""
    marks = F.filter(F.transform(F.array_remove(F.split(s, ""), ""), lambda c, i: F.when(c == ".", i)), lambda x: x.isNotNull())
    none = F.array().cast("array<struct<start:int,end:int,length:int>>")

    def step(a: Column, p: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), (p + 1).alias("end"), (last["length"] + 1).alias("length"))
        return F.when((F.size(a) > 0) & (last["end"] == p), F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(a, F.array(F.struct(p.alias("start"), (p + 1).alias("end"), F.lit(1).alias("length")))))

    return F.aggregate(marks, none, step)


def apical_loop(s: Column) -> Column:
    """The first longest unpaired run, edges included."""
    best = lambda a, r: F.when(a.isNull() | (r["length"] > a["length"]), r).otherwise(a)
    return F.aggregate(bulges(s), F.lit(None).cast("struct<start:int,end:int,length:int>"), best)


def tier1(seq: Column, s: Column, mfe: Column, shortest: int = 40, longest: int = 120, pairs: int = 18, energy: float = -15.0, unpaired: float = 0.8) -> Column:
    """Energy gate; all bounds are inclusive."""
    free = count_of(s, ".") / length1(s)
    return F.length(seq).between(shortest, longest) & (num_pairs(s) >= pairs) & (mfe <= energy) & (free <= unpaired)


def tier2_max(bounds: dict[str, float | None], have: dict[str, Column]) -> Column:
    """Geometry gate: only bounds that are set, on attributes that exist, can reject."""
    out = F.lit(True)
    for name, most in bounds.items():
        if most is not None and name in have:
            out &= have[name] <= most
    return out


def heuristic_mature(s: Column) -> Column:
    """0.4 paired + 0.3 longest bracket run + 0.3 (1 - unpaired), as shares of the length."""
    n = length1(s)
    dots = count_of(s, ".")
    longest = F.coalesce(F.array_max(run_lengths(s, r"[()]+")), F.lit(0))
    return 0.4 * (F.length(s) - dots) / n + 0.3 * longest / n + 0.3 * (1 - dots / n)


def pseudo_hairpin(seq: Column, s: Column, mfe: Column, longest: int = 120, energy: float = -18.0, pairs: int = 18, loops: int = 3) -> Column:
    """Decoy gate: length, energy, pairs, 1..loops unpaired runs (ends too), a stem run of 10, at most 0.45 unpaired, second run at most 8."""
    runs = F.sort_array(run_lengths(s), asc=False)
    stem = F.coalesce(F.array_max(run_lengths(s, r"\(+|\)+")), F.lit(0))
    return (
        (F.length(seq) <= longest) & (mfe <= energy) & (num_pairs(s) >= pairs) & F.size(runs).between(1, loops) & (stem >= 10)
        & (count_of(s, ".") / length1(seq) <= 0.45) & (F.coalesce(F.get(runs, 1), F.lit(0)) <= 8)
    )
