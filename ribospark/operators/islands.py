"""Aligned reads: multiplicity, islands, coverage, peaks and their evidence.

A read is (chrom, strand, start0, end0, ...) with 0-based half-open coordinates.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ribospark.operators.intervals import overlap_join

KEY = ("chrom", "strand")


def with_multiplicity(reads: DataFrame, max_hits: int = 50) -> tuple[DataFrame, DataFrame]:
    """(kept reads with nhits and is_unique, dropped reads with reject_reason) by hits per read id."""
    counted = reads.withColumn("nhits", F.count("*").over(Window.partitionBy("rid")))
    kept = counted.where(F.col("nhits") <= max_hits).withColumn("is_unique", F.col("nhits") == 1)
    return kept, counted.where(F.col("nhits") > max_hits).withColumn("reject_reason", F.lit("TooManyMaps"))


def library_counts(reads: DataFrame) -> DataFrame:
    """Mapped, unique and multi-mapping alignments."""
    return reads.agg(F.count("*").alias("mapped"), F.count_if("is_unique").alias("unique_maps"), F.count_if(~F.col("is_unique")).alias("multi_maps"))


def _locals(reads: DataFrame, gap: int, tile: int) -> DataFrame:
    """Reads with the island that their own tile shows: __tile and local."""
    w = Window.partitionBy(*KEY, "__tile").orderBy("start0", "end0")
    before = F.max("end0").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = reads.withColumn("__tile", F.floor(F.col("start0") / tile))
    x = x.withColumn("__new", F.when(before.isNull() | (F.col("start0") > before + gap), F.col("start0")))
    return x.withColumn("local", F.last("__new", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def _stitch(local: DataFrame, gap: int) -> DataFrame:
    """Tiles' islands (local, reach) with island_start. The window over a chromosome reads one row per island of a tile:
    their number is bounded by the chromosome's length over gap, however many reads there are."""
    w = Window.partitionBy(*KEY).orderBy("local")
    before = F.max("reach").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = local.withColumn("__new", F.when(before.isNull() | (F.col("local") > before + gap), F.col("local")))
    return x.withColumn("island_start", F.last("__new", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def with_islands(reads: DataFrame, gap: int = 50, tile: int = 1 << 20) -> DataFrame:
    """Reads with island_start: a new island begins where a read starts more than gap past all before it.

    Ties sort alike, so equal reads never change an island; ids follow (chrom, strand, start), not a
    global counter. Islands are found per tile, so one chromosome with most of the reads is still spread over
    its tiles, and stitched where they touch an edge; only islands that an edge cuts need a new start.
    """
    x = _locals(reads, gap, tile)
    cut = _stitch(x.groupBy(*KEY, "__tile", "local").agg(F.max("end0").alias("reach")), gap).where("local <> island_start")
    out = x.join(cut.select(*KEY, "local", F.col("island_start").alias("__from")), [*KEY, "local"], "left")
    return out.select(*reads.columns, F.coalesce("__from", "local").alias("island_start"))


def islands(reads: DataFrame, gap: int = 50, tile: int = 1 << 20) -> DataFrame:
    """One row per island: its span, depth and distinct starts. A start lies in one tile, so tiles' counts add up."""
    per = _locals(reads, gap, tile).groupBy(*KEY, "__tile", "local").agg(F.max("end0").alias("reach"), F.count("*").alias("n"), F.countDistinct("start0").alias("s"))
    g = _stitch(per, gap).groupBy(*KEY, "island_start")
    return g.agg(F.max("reach").alias("island_end"), F.sum("n").alias("depth"), F.sum("s").alias("n_starts"))


def depth_gate(isl: DataFrame, library: DataFrame, min_depth: int = 5, min_cpm: float = 0.5) -> DataFrame:
    """Islands with cpm by the number of alignments, of at least min_depth and min_cpm."""
    n = library.agg(F.count("*").alias("lib_size"))
    out = isl.join(F.broadcast(n)).withColumn("cpm", F.col("depth") / F.col("lib_size") * F.lit(1e6))
    return out.where((F.col("depth") >= min_depth) & (F.col("cpm") >= min_cpm))


def _runs(reads: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Runs (from0, to0, cov) of equal depth from +1 and -1 events; between an island's reads the depth may be 0."""
    ends = reads.select(*by, F.explode(F.array(F.struct(F.col("start0").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end0").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    steps = ends.groupBy(*by, F.col("e.pos").alias("from0")).agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(*by).orderBy("from0")
    out = steps.withColumns({"cov": F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)), "to0": F.lead("from0").over(w)})
    return out.where("to0 IS NOT NULL").drop("d")


def coverage(reads: DataFrame, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """Per-base coverage as runs (from0, to0, cov) of equal depth above zero."""
    return _runs(reads, by).where("cov > 0")


def base_signal(reads: DataFrame, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """Dense per-base coverage of each island, uncovered bases between its reads included as 0."""
    return _runs(reads, by).select(*by, F.explode(F.sequence("from0", F.col("to0") - 1)).alias("pos"), "cov")


def smooth(signal: DataFrame, width: int = 5, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """Centred rolling mean, cut at the edges; a width of at most 1 changes nothing."""
    if width <= 1:
        return signal.withColumn("y", F.col("cov").cast("double"))
    half = width // 2
    w = Window.partitionBy(*by).orderBy("pos").rowsBetween(-half, half)
    return signal.withColumn("y", F.avg("cov").over(w))


def smooth_padded(signal: DataFrame, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """The older smoothing: sum of three over three, zeros beyond the edges; under three bases unchanged."""
    w = Window.partitionBy(*by).orderBy("pos")
    n = F.count("*").over(Window.partitionBy(*by))
    return signal.withColumn("y", F.when(n < 3, F.col("cov").cast("double")).otherwise(F.sum("cov").over(w.rowsBetween(-1, 1)) / 3))


def peaks(signal: DataFrame, distance: int = 35, prominence: float = 0.3, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """Interior local maxima (plateaus give each base) whose relative prominence within distance is enough."""
    w = Window.partitionBy(*by).orderBy("pos")
    low = F.min("y").over(w.rowsBetween(-distance, distance))
    x = signal.withColumns({"__l": F.lag("y").over(w), "__r": F.lead("y").over(w), "__m": low})
    x = x.where("y >= __l AND y >= __r AND y > 0").withColumn("prominence", (F.col("y") - F.col("__m")) / F.col("y"))
    return x.where(F.col("prominence") >= prominence).drop("__l", "__r", "__m")


def height_nms(pk: DataFrame, distance: int = 35, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """Greedy suppression: by falling height (ties: lower position first), a pick blocks distance bases either side."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("y")).alias("k"), "pos")))
    far = lambda kept, p: F.forall(kept, lambda q: F.abs(q - p) > distance)
    fold = lambda a, x: F.when(far(a, x["pos"]), F.concat(a, F.array(x["pos"]))).otherwise(a)
    kept = F.aggregate("ps", F.array().cast("array<bigint>"), fold)
    return pk.groupBy(*by).agg(ordered.alias("ps")).select(*by, F.explode(kept).alias("pos"))


def merge_close(pk: DataFrame, least: int = 8, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """Ascending; a peak goes if it lies within least of the last one kept."""
    fold = lambda a, p: F.when(F.try_element_at(a, F.lit(-1)) >= p - least, a).otherwise(F.concat(a, F.array(p)))
    ps = F.array_sort(F.collect_list("pos"))
    kept = F.aggregate(F.slice("ps", 2, F.greatest(F.size("ps") - 1, F.lit(1))), F.slice("ps", 1, 1), fold)
    return pk.groupBy(*by).agg(ps.alias("ps")).select(*by, F.explode(kept).alias("pos"))


def forced_max(signal: DataFrame, pk: DataFrame, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """For islands without a peak: the first base of greatest signal, if above zero."""
    lost = signal.join(pk.select(*by).distinct(), list(by), "left_anti").where("y > 0")
    best = lost.groupBy(*by).agg(F.min(F.struct((-F.col("y")).alias("k"), "pos")).alias("m"))
    return best.select(*by, F.col("m.pos").alias("pos"))


def stack_stats(pk: DataFrame, reads: DataFrame, window: int = 15, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """Evidence of the reads that touch [pos-window, pos+window]: depth, start pile-ups, lengths, entropy.

    The mode of the lengths and the dominant start go to the one that comes first in (start0, end0) order.
    """
    p = pk.select(*by, "pos", (F.col("pos") - window).alias("__s"), (F.col("pos") + window + 1).alias("__e"))
    r = reads.select(*[F.col(c).alias(f"__{c}") for c in by], "start0", "end0")
    # Bins of position keep a deep island's peaks from meeting all of its reads.
    hit = overlap_join(p, r, ("__s", "__e"), ("start0", "end0"), [(c, f"__{c}") for c in by], width=64)
    k = [*by, "pos"]
    hit = hit.withColumn("len", F.col("end0") - F.col("start0"))
    starts = hit.groupBy(*k, "start0").agg(F.count("*").alias("n"))
    total = starts.groupBy(*k).agg(F.sum("n").alias("depth_raw"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "start0", "n"))).alias("ss"))
    share = lambda n: n / F.col("depth_raw")
    top = F.get("ss", 0)["n"] + F.coalesce(F.get("ss", 1)["n"], F.lit(0))
    main = F.get("ss", 0)["start0"]
    prec = F.aggregate(F.filter("ss", lambda s: F.abs(s["start0"] - main) <= 1), F.lit(0).cast("bigint"), lambda a, s: a + s["n"])
    ent = F.aggregate("ss", F.lit(0.0), lambda a, s: a - (s["n"] / F.col("depth_raw")) * F.log2(s["n"] / F.col("depth_raw") + 1e-12))
    total = total.select(*k, "depth_raw", share(top).alias("dominance"), share(prec).alias("prec5p"), ent.alias("start_entropy"))
    lens = hit.groupBy(*k, "len").agg(F.count("*").alias("n"), F.min(F.struct("start0", "end0")).alias("first"))
    mode = lens.groupBy(*k).agg(F.min(F.struct((-F.col("n")).alias("k"), "first", "len")).alias("m"), F.sum(F.when(F.col("len").between(20, 24), F.col("n")).otherwise(0)).alias("mid"))
    out = total.join(mode.select(*k, F.col("m.len").alias("len_mode"), "mid"), k)
    out = out.withColumn("frac_20_24", F.col("mid") / F.col("depth_raw")).drop("mid")
    out = pk.select(*k).join(out, k, "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("depth_raw", "dominance", "prec5p", "start_entropy", "frac_20_24")}
    return out.withColumns(zero | {"len_mode": F.coalesce("len_mode", F.lit(-1))})


def anchor_gate(anchor: Column, dominance: Column, prec5p: Column) -> Column:
    """Unique anchors need either kind of evidence, all others (forced ones too) both and more of it."""
    return F.when(anchor == "Unique", (dominance >= 0.5) | (prec5p >= 0.7)).otherwise((dominance >= 0.6) & (prec5p >= 0.85))


def mono_sequence(depth: Column, distinct_seqs: Column) -> Column:
    return (depth >= 10) & (distinct_seqs < 2)


def bad_lengths(frac_20_24: Column, len_mode: Column) -> Column:
    """Off in the current chain, on in the older one."""
    return (frac_20_24 < 0.3) & ~len_mode.between(20, 24)


def legacy_merge(pk: DataFrame, least: int = 8, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """The older merge: by falling height, a peak stays if all kept ones are at least that far away."""
    return height_nms(pk, least - 1, by)


def _flat_tops(y: np.ndarray) -> np.ndarray:
    """Middles (rounded down) of runs of equal values that both neighbours lie below; runs at the ends are none."""
    first = np.flatnonzero(np.concatenate(([True], y[1:] != y[:-1])))
    last = np.append(first[1:], len(y)) - 1
    v = y[first]
    top = np.zeros(len(v), bool)
    top[1:-1] = (v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])
    return (first[top] + last[top]) // 2


def prominent_peaks(y: np.ndarray, distance: int, prominence: float | None = None, width: tuple[float, float] | None = None) -> np.ndarray:
    """Places of local maxima at least distance apart (higher ones first, of equal ones the later), then by prominence and width.

    Prominence: height above the higher of the least values on both sides, each up to a higher value. Width: at half
    the prominence, between the crossings nearest to the peak, interpolated.
    """
    at = _flat_tops(y)
    keep = np.ones(len(at), bool)
    for i in np.lexsort((at, y[at]))[::-1]:
        if keep[i]:
            near = np.abs(at - at[i]) < distance
            near[i] = False
            keep &= ~near
    out = []
    least = max(1.0, 0.05 * y.max()) if prominence is None else prominence
    for p in at[keep].tolist():
        above = np.flatnonzero(y > y[p])
        i = np.searchsorted(above, p)
        a, b = (above[i - 1] + 1 if i else 0), (above[i] if i < len(above) else len(y))
        prom = y[p] - max(y[a : p + 1].min(), y[p:b].min())
        if prom < least:
            continue
        if width is not None:
            # the bases are the places nearest to the peak where each side is least
            lo, hi = p - np.argmin(y[a : p + 1][::-1]), p + np.argmin(y[p:b])
            half = y[p] - prom / 2
            left, right = p, p
            while left > lo and y[left] > half:
                left -= 1
            while right < hi and y[right] > half:
                right += 1
            start = left + (half - y[left]) / (y[left + 1] - y[left]) if y[left] < half else left
            end = right - (half - y[right]) / (y[right - 1] - y[right]) if y[right] < half else right
            if not width[0] <= end - start <= width[1]:
                continue
        out.append(p)
    return np.array(out, np.int64)


def peaks_by_prominence(signal: DataFrame, distance: int = 35, prominence: float | None = None, width: tuple[float, float] | None = None, by: tuple[str, ...] = (*KEY, "island_start")) -> DataFrame:
    """prominent_peaks of each island's signal (pos, y), one island at a time; the default prominence is max(1, 0.05 top)."""
    x = signal.select(*by, F.col("pos").cast("long").alias("pos"), F.col("y").cast("double").alias("y"))

    def find(pdf):
        pdf = pdf.sort_values("pos", ignore_index=True)
        return pdf.iloc[prominent_peaks(pdf["y"].to_numpy(), distance, prominence, width)]

    return x.groupBy(*by).applyInPandas(find, x.schema)
