"""Registered queries over the driver tables and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ribospark.functions import features as ft
from ribospark.functions import sequence as sq
from ribospark.functions import structure as st
from ribospark.operators import collapse, intervals, islands, labels, stats
from ribospark.plans import views as v

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# Reads, islands, coverage and peaks.


@query("w1_islands", f"WITH {v.READS}, {v.ISLANDS}, lib AS (SELECT count(*) AS lib_size FROM reads) SELECT *, depth / lib_size * 1e6 AS cpm FROM (SELECT chrom, strand, island_start, max(end0) AS island_end, count(*) AS depth, count(DISTINCT start0) AS n_starts FROM placed GROUP BY ALL), lib WHERE depth >= 5 AND depth / lib_size * 1e6 >= 0.5")
def w1_islands(spark, d):
    r = v.reads(spark, d)
    return islands.depth_gate(islands.islands(r), r)


@query("w1_tiled_islands", f"WITH {v.READS}, {v.ISLANDS} SELECT chrom, strand, island_start, max(end0) AS island_end, count(*) AS depth FROM placed GROUP BY ALL")
def w1_tiled_islands(spark, d):
    r = islands.with_islands(v.reads(spark, d), tile=50_000)
    return r.groupBy("chrom", "strand", "island_start").agg(F.max("end0").alias("island_end"), F.count("*").alias("depth"))


@query("a1_p3_multiplicity", f"WITH {v.READS}, n AS (SELECT *, count(*) OVER (PARTITION BY rid) AS nhits FROM reads) SELECT nhits, count(*) AS n, nhits = 1 AS is_unique FROM n WHERE nhits <= 3 GROUP BY ALL")
def a1_p3_multiplicity(spark, d):
    kept, _ = islands.with_multiplicity(v.reads(spark, d), 3)
    return kept.groupBy("nhits", "is_unique").agg(F.count("*").alias("n"))


@query("p3_rejected_reads", f"WITH {v.READS}, n AS (SELECT *, count(*) OVER (PARTITION BY rid) AS nhits FROM reads) SELECT rid, chrom, strand, start0, end0, 'TooManyMaps' AS reject_reason FROM n WHERE nhits > 3")
def p3_rejected_reads(spark, d):
    return islands.with_multiplicity(v.reads(spark, d), 3)[1].drop("nhits")


@query("a2_library_counts", f"WITH {v.READS}, n AS (SELECT count(*) OVER (PARTITION BY rid) = 1 AS u FROM reads) SELECT count(*) AS mapped, count(*) FILTER (u) AS unique_maps, count(*) FILTER (NOT u) AS multi_maps FROM n")
def a2_library_counts(spark, d):
    return islands.library_counts(islands.with_multiplicity(v.reads(spark, d))[0])


BASES_SQL = f"""WITH {v.READS}, {v.ISLANDS},
span AS (SELECT chrom, strand, island_start, min(start0) AS lo, max(end0) AS hi FROM placed GROUP BY ALL),
dense AS (SELECT chrom, strand, island_start, unnest(range(lo, hi)) AS pos FROM span),
cov AS (SELECT chrom, strand, island_start, pos, count(*) AS c FROM (SELECT chrom, strand, island_start, unnest(range(start0, end0)) AS pos FROM placed) GROUP BY ALL),
sig AS (SELECT d.*, coalesce(c, 0) AS cov FROM dense d LEFT JOIN cov USING (chrom, strand, island_start, pos)),
sm AS (SELECT *, avg(cov) OVER (PARTITION BY chrom, strand, island_start ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS y FROM sig),
pk AS (SELECT * FROM (SELECT *, lag(y) OVER w AS l, lead(y) OVER w AS r, (y - min(y) OVER (PARTITION BY chrom, strand, island_start ORDER BY pos ROWS BETWEEN 35 PRECEDING AND 35 FOLLOWING)) / y AS prominence
       FROM sm WINDOW w AS (PARTITION BY chrom, strand, island_start ORDER BY pos)) WHERE y >= l AND y >= r AND y > 0 AND prominence >= 0.3)"""


def _signal(spark, d):
    return islands.smooth(islands.base_signal(islands.with_islands(v.reads(spark, d))))


@query("w3_coverage", BASES_SQL + " SELECT chrom, strand, island_start, sum(cov) AS bases, max(cov) AS top, count(*) AS width FROM sig GROUP BY ALL")
def w3_coverage(spark, d):
    s = islands.base_signal(islands.with_islands(v.reads(spark, d)))
    return s.groupBy("chrom", "strand", "island_start").agg(F.sum("cov").alias("bases"), F.max("cov").alias("top"), F.count("*").alias("width"))


@query("w4_rolling_mean", BASES_SQL + " SELECT chrom, strand, island_start, round(sum(y), 6) AS total, round(max(y), 6) AS top FROM sm GROUP BY ALL")
def w4_rolling_mean(spark, d):
    return _signal(spark, d).groupBy("chrom", "strand", "island_start").agg(F.round(F.sum("y"), 6).alias("total"), F.round(F.max("y"), 6).alias("top"))


@query("w5_padded_mean", BASES_SQL + " SELECT chrom, strand, island_start, round(sum(y5), 6) AS total FROM (SELECT *, CASE WHEN count(*) OVER (PARTITION BY chrom, strand, island_start) < 3 THEN cov ELSE sum(cov) OVER (PARTITION BY chrom, strand, island_start ORDER BY pos ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) / 3 END AS y5 FROM sig) GROUP BY ALL")
def w5_padded_mean(spark, d):
    s = islands.smooth_padded(islands.base_signal(islands.with_islands(v.reads(spark, d))))
    return s.groupBy("chrom", "strand", "island_start").agg(F.round(F.sum("y"), 6).alias("total"))


@query("w6_w7_peaks", BASES_SQL + " SELECT chrom, strand, island_start, pos, round(y, 6) AS y, round(prominence, 6) AS prominence FROM pk")
def w6_w7_peaks(spark, d):
    p = islands.peaks(_signal(spark, d))
    return p.select("chrom", "strand", "island_start", "pos", F.round("y", 6).alias("y"), F.round("prominence", 6).alias("prominence"))


@query("w8_height_nms", BASES_SQL + """, o AS (SELECT chrom, strand, island_start, list(pos ORDER BY y DESC, pos) AS ps FROM pk GROUP BY ALL)
SELECT chrom, strand, island_start, unnest(list_reduce(list_prepend([]::BIGINT[], list_transform(ps, lambda p: [p])), lambda a, x: CASE WHEN len(list_filter(a, lambda q: abs(q - x[1]) <= 35)) > 0 THEN a ELSE list_concat(a, x) END)) AS pos FROM o""")
def w8_height_nms(spark, d):
    return islands.height_nms(islands.peaks(_signal(spark, d)))


@query("w10_merge_close", BASES_SQL + """, o AS (SELECT chrom, strand, island_start, list(pos ORDER BY pos) AS ps FROM pk GROUP BY ALL)
SELECT chrom, strand, island_start, unnest(list_reduce(list_transform(ps, lambda p: [p]), lambda a, x: CASE WHEN x[1] - a[-1] <= 8 THEN a ELSE list_concat(a, x) END)) AS pos FROM o""")
def w10_merge_close(spark, d):
    return islands.merge_close(islands.peaks(_signal(spark, d)))


@query("w13_forced_max", BASES_SQL + " SELECT chrom, strand, island_start, arg_min(pos, {'k': -y, 'p': pos}) AS pos FROM sm WHERE y > 0 AND (chrom, strand, island_start) NOT IN (SELECT (chrom, strand, island_start) FROM pk) GROUP BY ALL")
def w13_forced_max(spark, d):
    s = _signal(spark, d)
    return islands.forced_max(s, islands.peaks(s))


STACK_SQL = f"""WITH {v.READS}, {v.ISLANDS}, pk AS (SELECT chrom, strand, island_start, max(start0) AS pos FROM placed GROUP BY ALL),
h AS (SELECT p.chrom, p.strand, p.island_start, p.pos, r.start0, r.end0, r.end0 - r.start0 AS len FROM pk p JOIN placed r USING (chrom, strand, island_start) WHERE r.end0 > p.pos - 15 AND r.start0 < p.pos + 16),
s AS (SELECT chrom, strand, island_start, pos, start0, count(*) AS n FROM h GROUP BY ALL),
t AS (SELECT chrom, strand, island_start, pos, sum(n) AS depth, list({{'n': n, 's': start0}} ORDER BY n DESC, start0) AS ss FROM s GROUP BY ALL),
l AS (SELECT chrom, strand, island_start, pos, len, count(*) AS n, min({{'s': start0, 'e': end0}}) AS f FROM h GROUP BY ALL),
m AS (SELECT chrom, strand, island_start, pos, arg_min(len, {{'k': -n, 'f': f}}) AS len_mode, sum(CASE WHEN len BETWEEN 20 AND 24 THEN n ELSE 0 END) AS mid FROM l GROUP BY ALL),
stack AS (SELECT chrom, strand, island_start, pos, depth AS depth_raw, (ss[1].n + coalesce(ss[2].n, 0)) / depth AS dominance,
  list_sum(list_transform(list_filter(ss, lambda x: abs(x.s - ss[1].s) <= 1), lambda x: x.n)) / depth AS prec5p,
  -list_sum(list_transform(ss, lambda x: x.n / depth * log2(x.n / depth + 1e-12))) AS start_entropy, len_mode, mid / depth AS frac_20_24
  FROM t JOIN m USING (chrom, strand, island_start, pos))"""


def _stack(spark, d):
    r = islands.with_islands(v.reads(spark, d))
    return islands.stack_stats(r.groupBy("chrom", "strand", "island_start").agg(F.max("start0").alias("pos")), r)


@query("a3_stack_stats", STACK_SQL + " SELECT chrom, strand, island_start, pos, depth_raw::BIGINT AS depth_raw, round(dominance, 6) AS dominance, round(prec5p, 6) AS prec5p, round(start_entropy, 6) + 0.0 AS start_entropy, len_mode, round(frac_20_24, 6) AS frac_20_24 FROM stack")
def a3_stack_stats(spark, d):
    r = [F.round(c, 6).alias(c) if c != "start_entropy" else (F.round(c, 6) + 0.0).alias(c) for c in ("dominance", "prec5p", "start_entropy", "frac_20_24")]
    return _stack(spark, d).select("chrom", "strand", "island_start", "pos", "depth_raw", "len_mode", *r)


@query("p6_p7_p8_gates", STACK_SQL + """ SELECT a AS anchor, CASE WHEN a = 'Unique' THEN dominance >= 0.5 OR prec5p >= 0.7 ELSE dominance >= 0.6 AND prec5p >= 0.85 END AS passes, frac_20_24 < 0.3 AND len_mode NOT BETWEEN 20 AND 24 AS bad_lengths, count(*) AS n
FROM (SELECT *, ['Unique', 'Multi', 'ForcedMax'][pos % 3 + 1] AS a FROM stack) GROUP BY ALL""")
def p6_p7_p8_gates(spark, d):
    x = _stack(spark, d)
    x = x.withColumn("anchor", F.element_at(F.array(*map(F.lit, ("Unique", "Multi", "ForcedMax"))), (F.col("pos") % 3 + 1).cast("int")))
    gate = islands.anchor_gate(F.col("anchor"), F.col("dominance"), F.col("prec5p"))
    return x.groupBy("anchor", gate.alias("passes"), islands.bad_lengths(F.col("frac_20_24"), F.col("len_mode")).alias("bad_lengths")).agg(F.count("*").alias("n"))


# Interval joins and labels.


def _peaks(spark, d):
    r = islands.islands(v.reads(spark, d)).withColumnsRenamed({"island_start": "start0", "island_end": "end0"})
    return r.select(F.concat_ws("|", "chrom", "strand", F.col("start0").cast("string")).alias("peak_id"), "chrom", "strand", "start0", "end0", F.floor((F.col("start0") + F.col("end0")) / 2).alias("center0"), "depth")


PEAKS = f"{v.READS}, {v.ISLANDS}, peaks AS (SELECT chrom || '|' || strand || '|' || island_start AS peak_id, chrom, strand, island_start AS start0, max(end0) AS end0, (island_start + max(end0)) // 2 AS center0, count(*) AS depth FROM placed GROUP BY chrom, strand, island_start), {v.KNOWN}"


@query("j1_overlap_join", f"WITH {PEAKS} SELECT peak_id, known_id, least(end0, k_end0) - greatest(start0, k_start0) AS overlap_bp FROM peaks JOIN known ON chrom = k_chrom AND start0 < k_end0 AND k_start0 < end0")
def j1_overlap_join(spark, d):
    return intervals.overlap_join(_peaks(spark, d), v.known(spark, d)).select("peak_id", "known_id", "overlap_bp")


@query("j3_j4_x1_early_labels", f"""WITH {PEAKS}, h AS (SELECT peak_id, known_id, known_db, known_feature, least(end0, k_end0) - greatest(start0, k_start0) AS ov, center0 >= k_start0 AND center0 < k_end0 AS ci,
  strand = '.' OR k_strand = '.' OR strand = k_strand AS so FROM peaks JOIN known ON chrom = k_chrom AND start0 < k_end0 AND k_start0 < end0),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY peak_id ORDER BY CASE known_feature WHEN 'mature' THEN 0 ELSE 1 END, CASE WHEN known_feature = 'mature' AND ci THEN 0 ELSE 1 END, ov DESC, known_id) AS rn FROM h) WHERE rn = 1)
SELECT peak_id, known_id, known_db, known_feature, ov AS overlap_bp, CASE WHEN known_id IS NULL THEN 'Unknown' WHEN known_feature = 'mature' AND ci AND so THEN 'Known-Confirmed' ELSE 'Known-Region' END AS known_early_status FROM peaks LEFT JOIN b USING (peak_id)""")
def j3_j4_x1_early_labels(spark, d):
    return labels.early_labels(_peaks(spark, d), v.known(spark, d)).select("peak_id", "known_id", "known_db", "known_feature", "overlap_bp", "known_early_status")


LATE = f"""WITH {PEAKS}, hm AS (SELECT peak_id, known_id, known_db, least(end0 + 2, k_end0) - greatest(start0 - 2, k_start0) AS ov, strand = k_strand AND strand <> '.' AS same, center0 >= k_start0 - 2 AND center0 < k_end0 + 2 AS win,
  CASE known_db WHEN 'MirGeneDB' THEN 0 WHEN 'miRBase' THEN 1 ELSE 2 END AS dbr FROM peaks JOIN known ON chrom = k_chrom AND start0 - 2 < k_end0 AND k_start0 < end0 + 2 AND known_feature = 'mature'),
hp AS (SELECT peak_id, known_id, known_db, least(end0, k_end0) - greatest(start0, k_start0) AS ov, strand = k_strand AND strand <> '.' AS same, center0 >= k_start0 - 2 AND center0 < k_end0 + 2 AS win,
  CASE known_db WHEN 'MirGeneDB' THEN 0 WHEN 'miRBase' THEN 1 ELSE 2 END AS dbr FROM peaks JOIN known ON chrom = k_chrom AND start0 < k_end0 AND k_start0 < end0 AND known_feature <> 'mature'),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY peak_id ORDER BY ov DESC, same DESC, dbr, win DESC, known_id) AS rn FROM hm) WHERE rn = 1),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY peak_id ORDER BY ov DESC, same DESC, dbr, win DESC, known_id) AS rn FROM hp) WHERE rn = 1),
late AS (SELECT k.peak_id, k.depth, k.start0, CASE WHEN m.known_id IS NOT NULL AND m.same AND m.ov >= 10 AND m.win THEN 'Known-Confirmed' WHEN m.known_id IS NOT NULL OR p.known_id IS NOT NULL THEN 'Known-Atypical' ELSE 'Unknown' END AS known_status,
  CASE WHEN m.known_id IS NOT NULL AND NOT (m.same AND m.ov >= 10 AND m.win) THEN concat_ws(';', CASE WHEN NOT m.same THEN 'StrandMismatch' END, CASE WHEN m.ov < 10 THEN 'ShortOverlap' END, CASE WHEN NOT m.win THEN 'CenterOutside' END)
       WHEN m.known_id IS NULL AND p.known_id IS NOT NULL THEN 'PrecursorOnly' ELSE '' END AS known_reason, coalesce(m.known_id, p.known_id) AS known_id, coalesce(m.known_db, p.known_db) AS known_db
  FROM peaks k LEFT JOIN m USING (peak_id) LEFT JOIN p USING (peak_id))"""


@query("j5_x2_late_labels", LATE + " SELECT peak_id, known_status, known_reason, known_id, known_db FROM late")
def j5_x2_late_labels(spark, d):
    return labels.late_labels(_peaks(spark, d), v.known(spark, d)).select("peak_id", "known_status", "known_reason", "known_id", "known_db")


REPEATS = ["", "LINE/L1", "Simple_repeat", " no ", "Satellite/x", "NULL", "."]
LADDER = LATE + f""", q AS (SELECT *, (start0 * 7) % 1000 / 1000 AS s, CASE WHEN start0 % 3 = 0 THEN 0 ELSE 1 END AS y, {REPEATS}[start0 % 7 + 1] AS rep FROM late),
z AS (SELECT *, CASE WHEN upper(trim(rep)) IN ('', 'NA', 'NONE', 'NO', 'NAN') THEN '' ELSE upper(trim(split_part(rep, '/', 1))) END AS rc FROM q),
final AS (SELECT *, CASE WHEN rc IN ('SIMPLE_REPEAT', 'LOW_COMPLEXITY', 'SATELLITE') THEN 'Reject' WHEN known_status = 'Known-Confirmed' THEN known_status
  WHEN known_status = 'Known-Atypical' THEN CASE WHEN s >= (CASE WHEN rc <> '' THEN 0.65 ELSE 0.55 END) THEN known_status ELSE 'Reject' END
  WHEN y = 1 AND s >= (CASE WHEN rc <> '' THEN 0.75 ELSE 0.65 END) THEN 'Novel-High' ELSE 'Reject' END AS final_label,
 CASE WHEN rc IN ('SIMPLE_REPEAT', 'LOW_COMPLEXITY', 'SATELLITE') THEN 'RepeatBlocked:' || rc WHEN known_status = 'Known-Confirmed' THEN 'KnownConfirmed'
  WHEN known_status = 'Known-Atypical' THEN CASE WHEN s >= (CASE WHEN rc <> '' THEN 0.65 ELSE 0.55 END) THEN 'KnownAtypical+RF' ELSE 'KnownAtypicalLowRF<' || (CASE WHEN rc <> '' THEN '0.650' ELSE '0.550' END) END
  WHEN y = 1 AND s >= (CASE WHEN rc <> '' THEN 0.75 ELSE 0.65 END) THEN 'Unknown+RFHigh' WHEN y <> 1 THEN 'UnknownPredLabel0' ELSE 'UnknownLowRF<' || (CASE WHEN rc <> '' THEN '0.750' ELSE '0.650' END) END AS reason FROM z)"""


def _final(spark, d):
    x = labels.late_labels(_peaks(spark, d), v.known(spark, d))
    rep = F.element_at(F.array(*map(F.lit, REPEATS)), (F.col("start0") % 7 + 1).cast("int"))
    x = x.withColumns({"s": F.col("start0") * 7 % 1000 / 1000, "y": F.when(F.col("start0") % 3 == 0, 0).otherwise(1), "rep": rep})
    x = x.withColumns({"l": labels.ladder(F.col("known_status"), F.col("s"), F.col("y"), F.col("rep")), "repeat_class": labels.norm_repeat(F.col("rep"))})
    return x.select("peak_id", "known_db", "repeat_class", "s", "l.*")


@query("x3_decision_ladder", LADDER + " SELECT peak_id, final_label, reason FROM final")
def x3_decision_ladder(spark, d):
    return _final(spark, d).select("peak_id", "final_label", "reason")


@query("a10_breakdowns", LADDER + " SELECT final_label, known_db, rc AS repeat_class, count(*) AS n FROM final GROUP BY GROUPING SETS ((final_label), (known_db), (rc), (final_label, rc))")
def a10_breakdowns(spark, d):
    return stats.breakdowns(_final(spark, d))


@query("a11_top20", LADDER + " SELECT peak_id, s FROM final ORDER BY s DESC, peak_id DESC LIMIT 20")
def a11_top20(spark, d):
    return _final(spark, d).orderBy(F.desc("s"), F.desc("peak_id")).limit(20).select("peak_id", "s")


@query("j8_mask_anti_join", f"WITH {PEAKS} SELECT peak_id FROM peaks WHERE NOT EXISTS (SELECT 1 FROM known WHERE chrom = k_chrom AND start0 < k_end0 + 10 AND greatest(0, k_start0 - 10) < end0)")
def j8_mask_anti_join(spark, d):
    mask = v.known(spark, d).select(F.col("k_chrom").alias("chrom"), F.col("k_start0").alias("start0"), F.col("k_end0").alias("end0"))
    return intervals.semi_mask(_peaks(spark, d), mask, flank=10, anti=True).select("peak_id")


@query("j10_known_quantification", f"WITH {v.READS}, {v.KNOWN} SELECT known_id, count(*) AS n_reads FROM known JOIN reads ON chrom = k_chrom AND strand = k_strand AND start0 < k_end0 AND k_start0 < end0 GROUP BY ALL")
def j10_known_quantification(spark, d):
    hit = intervals.overlap_join(v.reads(spark, d), v.known(spark, d), on=(("chrom", "k_chrom"), ("strand", "k_strand")))
    return hit.groupBy("known_id").agg(F.count("*").alias("n_reads"))


# Sequences and structures.


@query("f1_f2_f3_letters", f"WITH {v.SEQUENCES} SELECT id, reverse(translate(seq, 'ACGTUNacgtun', 'TGCAANtgcaan')) AS rc, translate(upper(seq), 'U', 'T') AS dna, (length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) / greatest(length(seq), 1) AS gc FROM sequences")
def f1_f2_f3_letters(spark, d):
    s = F.col("seq")
    return v.sequences(spark, d).select("id", sq.revcomp(s).alias("rc"), sq.to_dna(s).alias("dna"), sq.gc_fraction(s).alias("gc"))


@query("f5_j21_kmer_jaccard", """WITH b AS (SELECT item_id, text, (SELECT list(DISTINCT substr(text, i, 6)) FROM (SELECT unnest(range(1, length(text) - 4)) AS i)) AS k FROM benchmark WHERE length(text) >= 6)
SELECT x.item_id AS a, y.item_id AS b, round(len(list_intersect(x.k, y.k)) / len(list_distinct(list_concat(x.k, y.k))), 9) AS jaccard FROM b x JOIN b y ON x.item_id < y.item_id WHERE len(list_intersect(x.k, y.k)) > 0""")
def f5_j21_kmer_jaccard(spark, d):
    b = v.load(spark, d, "benchmark").where(F.length("text") >= 6).select("item_id", sq.kmers(F.col("text"), 6).alias("k"))
    e = b.select("item_id", F.size("k").alias("n"), F.explode("k").alias("m"))
    x = e.alias("x").join(e.alias("y"), (F.col("x.m") == F.col("y.m")) & (F.col("x.item_id") < F.col("y.item_id")))
    g = x.groupBy(F.col("x.item_id").alias("a"), F.col("y.item_id").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).agg(F.count("*").alias("c"))
    return g.select("a", "b", F.round(F.col("c") / (F.col("na") + F.col("nb") - F.col("c")), 9).alias("jaccard"))


@query("p10_low_complexity", f"WITH {v.SEQUENCES} SELECT id, len(list_distinct(string_split(seq, ''))) <= 2 OR list_max(list_transform(['A', 'C', 'G', 'U'], lambda c: length(seq) - length(replace(seq, c, '')))) / length(seq) >= 0.8 AS low FROM sequences")
def p10_low_complexity(spark, d):
    return v.sequences(spark, d).select("id", sq.low_complexity(F.col("seq")).alias("low"))


@query("w14_windows", f"WITH {v.SEQUENCES}, w AS (SELECT id, seq, length(seq) AS n FROM sequences), s AS (SELECT id, seq, unnest(list_concat(range(0, greatest(n - 40, 0) + 1, 7), CASE WHEN n > 40 AND (n - 40) % 7 <> 0 THEN [n - 40] ELSE [] END)) AS start FROM w) SELECT id, start, substr(seq, start + 1, 40) AS win FROM s")
def w14_windows(spark, d):
    x = v.sequences(spark, d).select("id", "seq", F.explode(sq.windows(F.col("seq"), 40, 7)).alias("start"))
    return x.select("id", F.col("start").cast("bigint").alias("start"), F.substring("seq", F.col("start") + 1, F.lit(40)).alias("win"))


@query("m1_mirror_fold", f"WITH {v.FOLDED} SELECT id, seq, struct, mfe FROM folded")
def m1_mirror_fold(spark, d):
    return v.folded(spark, d)


CORE_SQL = f"""WITH {v.FOLDED}, c AS (SELECT *, greatest(length(seq), 1) AS n, list_transform(regexp_extract_all(trim(struct, '.'), '\\.+'), lambda x: length(x)) AS r, length(struct) - length(replace(struct, '(', '')) AS p FROM folded)"""


def _n(x: str) -> str:
    return f"(length(seq) - length(replace(seq, '{x}', ''))) / {len(x)}"


@query("f6_core_features", CORE_SQL + f""" SELECT id, length(seq)::DOUBLE AS len, ({_n("G")} + {_n("C")}) / n AS gc_frac, ({_n("A")} + {_n("U")}) / n AS au_frac, {_n("G")} / n AS g_frac, {_n("C")} / n AS c_frac, {_n("A")} / n AS a_frac, {_n("U")} / n AS u_frac,
p::DOUBLE AS num_pairs, 2.0 * p / n AS paired_frac, 1.0 - 2.0 * p / n AS unpaired_frac, len(r)::DOUBLE AS num_loops, coalesce(list_sum(r) / nullif(len(r), 0), 0)::DOUBLE AS mean_loop_size, coalesce(list_max(r), 0)::DOUBLE AS max_loop_size, coalesce(list_sum(r), 0) / n AS loop_unpaired_frac,
(coalesce(list_sum(list_transform(r, lambda x: least(x, 2))), 0) + CASE WHEN p > 0 AND struct LIKE '.%' THEN 1 ELSE 0 END + CASE WHEN p > 0 AND struct LIKE '%.' THEN 1 ELSE 0 END)::DOUBLE AS num_bulges,
(coalesce(list_sum(list_transform(r, lambda x: least(x, 2))), 0) + CASE WHEN p > 0 AND struct LIKE '.%' THEN 1 ELSE 0 END + CASE WHEN p > 0 AND struct LIKE '%.' THEN 1 ELSE 0 END) / n AS bulge_density, mfe, mfe / n AS mfe_per_nt FROM c""")
def f6_core_features(spark, d):
    x = v.folded(spark, d)
    return x.select("id", *[c.alias(k) for k, c in ft.core(F.col("seq"), F.col("struct"), F.col("mfe")).items()])


@query("f9_composition", CORE_SQL + " SELECT id, mfe / n AS adj_mfe, " + ", ".join(f"{_n(x)} / n AS pct_{x}" for x in "ACGU") + f", abs({_n('G')} + {_n('A')} - {_n('C')} - {_n('U')}) / n AS imbalance_GA_CU, abs({_n('G')} - {_n('C')}) / n AS imbalance_G_C, " + ", ".join(f"{_n(a + b)} / greatest(length(seq) - 1, 1) AS di_{a}{b}" for a in "ACGU" for b in "ACGU") + ", " + ", ".join(f"{_n(m)} / greatest(length(seq) - 2, 1) AS tri_{m}" for m in ft.MOTIFS) + " FROM c")
def f9_composition(spark, d):
    return v.folded(spark, d).select("id", *[c.alias(k) for k, c in ft.composition(F.col("seq"), F.col("mfe")).items()])


def _staged(spark, d):
    x = v.folded(spark, d).withColumns({"pairs": st.base_pairs(F.col("struct")), "bulges": st.bulges(F.col("struct"))})
    x = x.withColumns({"runs": st.stem_runs(F.col("pairs")), "sided": ft.sided_bulges(F.col("pairs"), F.col("bulges")), "best": ft.largest_loop(F.col("struct"), F.col("bulges"))})
    return x.withColumn("near", ft.near_loop(F.col("seq"), F.col("best")))


def _segment_sql() -> str:
    """Shares of GC and opening brackets of four parts; a part that the sequence is too short for is null."""
    size = lambda i: "greatest(length(seq) // 4, 1)" if i < 3 else "greatest(length(seq) - 3 * greatest(length(seq) // 4, 1), 0)"
    part = lambda c, i: f"substr({c}, {i} * greatest(length(seq) // 4, 1) + 1, {size(i)})"
    gc = lambda i: f"(length({part('seq', i)}) - length(replace(replace({part('seq', i)}, 'G', ''), 'C', ''))) / nullif(length({part('seq', i)}), 0)"
    pf = lambda i: f"2.0 * (length({part('struct', i)}) - length(replace({part('struct', i)}, '(', ''))) / nullif(length({part('seq', i)}), 0)"
    cols = [f"{gc(i)} AS seg{i + 1}_gc, {pf(i)} AS seg{i + 1}_paired_frac" for i in range(4)]
    return f"WITH {v.FOLDED}, p AS (SELECT id, {', '.join(cols)} FROM folded) SELECT *, CASE WHEN seg1_gc IS NOT NULL THEN coalesce(seg4_gc, 0) - seg1_gc END AS gc_grad_last_first, CASE WHEN seg1_gc IS NOT NULL THEN coalesce(seg4_paired_frac, 0) - seg1_paired_frac END AS paired_grad_last_first FROM p"


@query("f10_segments", _segment_sql())
def f10_segments(spark, d):
    x = v.folded(spark, d)
    x = x.withColumns(ft.segment_parts(F.col("seq"), F.col("struct"))).withColumns(ft.segment_shares())
    return x.select("id", *ft.segment_shares(), *[c.alias(k) for k, c in ft.segment_slopes().items()])


@query("f13_f14_stems")
def f13_f14_stems(spark, d):
    return _staged(spark, d).select("id", *[c.alias(k) for k, c in ft.stems(F.col("seq"), F.col("pairs"), F.col("runs")).items()])


@query("f16_bulges")
def f16_bulges(spark, d):
    return _staged(spark, d).select("id", *[c.alias(k) for k, c in ft.bulge_features(F.col("sided")).items()])


@query("f17_loop_motifs")
def f17_loop_motifs(spark, d):
    return _staged(spark, d).select("id", *[c.alias(k) for k, c in ft.loop_motifs(F.col("seq"), F.col("struct"), F.col("best"), F.col("near")).items()])


@query("p12_tier1_gate", CORE_SQL + " SELECT id, length(seq) BETWEEN 40 AND 120 AND p >= 18 AND mfe <= -15 AND (length(struct) - length(replace(struct, '.', ''))) / greatest(length(struct), 1) <= 0.8 AS passes FROM c")
def p12_tier1_gate(spark, d):
    return v.folded(spark, d).select("id", st.tier1(F.col("seq"), F.col("struct"), F.col("mfe")).alias("passes"))


@query("f11_f12_stems")
def f11_f12_stems(spark, d):
    x = v.folded(spark, d).withColumn("pairs", st.base_pairs(F.col("struct"))).withColumn("runs", st.stem_runs(F.col("pairs")))
    return x.select("id", F.size("pairs").alias("n_pairs"), *[c.alias(k) for k, c in st.helix_stats(F.col("runs")).items()], st.anchor(F.col("runs")).alias("anchor"))


@query("f18_tier2_soft", CORE_SQL + """, q AS (SELECT id, mfe / n AS per, coalesce(list_max(list_transform(regexp_extract_all(struct, '\\.+'), lambda x: length(x))), 0) AS run, length(struct) - length(replace(struct, '.', '')) AS free, length(struct) AS ls, p + length(struct) - length(replace(struct, ')', '')) AS paired FROM c),
w AS (SELECT *, least(1.0, free / greatest(paired, 1)) AS b, free / ls AS u FROM q)
SELECT id, run::DOUBLE AS tier2_loop_len, b AS tier2_bulge_frac, u AS tier2_unpaired_frac, round(greatest(0, (per + 0.2) / 0.05) + 0.7 * greatest(0, (run - 22) / 5.0) + greatest(0, (b - 0.3) / 0.1) + 0.8 * greatest(0, (u - 0.55) / 0.1), 6) AS tier2_penalty FROM w""")
def f18_tier2_soft(spark, d):
    t = ft.tier2_soft(F.col("seq"), F.col("struct"), F.col("mfe"), True)
    return v.folded(spark, d).select("id", t["tier2_loop_len"].alias("tier2_loop_len"), t["tier2_bulge_frac"].alias("tier2_bulge_frac"), t["tier2_unpaired_frac"].alias("tier2_unpaired_frac"), F.round(t["tier2_penalty"], 6).alias("tier2_penalty"))


@query("f28_heuristic_mature", CORE_SQL + " SELECT id, round(0.4 * (length(struct) - (length(struct) - length(replace(struct, '.', '')))) / greatest(length(struct), 1) + 0.3 * coalesce(list_max(list_transform(regexp_extract_all(struct, '[()]+'), lambda x: length(x))), 0) / greatest(length(struct), 1) + 0.3 * (1 - (length(struct) - length(replace(struct, '.', ''))) / greatest(length(struct), 1)), 9) AS score FROM c")
def f28_heuristic_mature(spark, d):
    return v.folded(spark, d).select("id", F.round(st.heuristic_mature(F.col("struct")), 9).alias("score"))


# Collapse, suppression, samples.


@query("a6_collapse_pads", f"""WITH {v.SCORED} SELECT base_id, string_agg(pad::VARCHAR, ',' ORDER BY pad) AS pads_seen, count(DISTINCT pad)::INT AS n_pads, arg_min(pad, {{'k': -rf_score, 'p': pad, 'h': hp_len}}) AS best_pad, round(max(rf_score), 6) AS best_rf_score,
arg_min(pred_label, {{'k': -rf_score, 'p': pad, 'h': hp_len}}) AS best_pred_label, count(DISTINCT rf_score) = 1 AS is_tie, string_agg(pad || ':' || printf('%.6f', rf_score), ',' ORDER BY pad) AS pad_scores FROM scored GROUP BY base_id""")
def a6_collapse_pads(spark, d):
    return collapse.collapse_pads(v.scored(spark, d))


@query("w17_overlap_nms", f"""WITH {v.SEQUENCES}, w AS (SELECT id, seq, length(seq) AS n FROM sequences), s AS (SELECT id, seq, unnest(list_concat(range(0, greatest(n - 40, 0) + 1, 7), CASE WHEN n > 40 AND (n - 40) % 7 <> 0 THEN [n - 40] ELSE [] END)) AS start FROM w),
h AS (SELECT id, start AS s, start + 40 AS e, (length(substr(seq, start + 1, 40)) - length(replace(replace(substr(seq, start + 1, 40), 'G', ''), 'C', ''))) / greatest(length(substr(seq, start + 1, 40)), 1) AS score FROM s),
o AS (SELECT id, list({{'s': s, 'e': e, 'score': score}} ORDER BY score DESC, s) AS r FROM h GROUP BY id),
k AS (SELECT id, unnest(list_reduce(list_transform(r, lambda x: [x]), lambda a, x: CASE WHEN len(list_filter(a, lambda q: greatest(0, least(q.e, x[1].e) - greatest(q.s, x[1].s)) / 40 >= 0.7)) > 0 THEN a ELSE list_concat(a, x) END)) AS x FROM o)
SELECT id AS input_id, x.s AS start, x.e AS "end", x.score AS score FROM k""")
def w17_overlap_nms(spark, d):
    x = v.sequences(spark, d).select(F.col("id").alias("input_id"), "seq", F.explode(sq.windows(F.col("seq"), 40, 7)).alias("start"))
    x = x.select("input_id", "start", (F.col("start") + 40).alias("end"), sq.gc_fraction(F.substring("seq", F.col("start") + 1, F.lit(40))).alias("score"))
    return collapse.overlap_nms(x)


@query("w18_best_of_scan", f"WITH {v.SCORED}, z AS (SELECT base_id, pad, rf_score FROM scored WHERE start0 % 11 <> 0 AND (start0 % 13 <> 0 OR pad <> 70)) SELECT base_id, arg_min(pad, {{'k': -rf_score, 'p': pad}}) AS pad, max(rf_score) AS rf_score FROM z GROUP BY base_id")
def w18_best_of_scan(spark, d):
    score = F.when(F.col("start0") % 11 == 0, F.lit(None)).when((F.col("start0") % 13 == 0) & (F.col("pad") == 70), float("nan")).otherwise(F.col("rf_score"))
    return collapse.best_of_scan(v.scored(spark, d).select("base_id", "pad", score.alias("rf_score")), ["base_id"], ties=["pad"])


@query("x8_router", "SELECT CASE WHEN length(text) <= 120 THEN 'direct' WHEN length(text) <= 5000 THEN 'scan' ELSE 'too_long' END AS mode, count(*) AS n FROM documents GROUP BY ALL")
def x8_router(spark, d):
    return v.load(spark, d, "documents").groupBy(labels.route(F.length("text")).alias("mode")).agg(F.count("*").alias("n"))


@query("x4_verdict", f"WITH {v.LABELLED} SELECT doc_id, CASE WHEN score >= 0.9 AND a >= 0.8 THEN 'HIGH' WHEN score < 0.6 AND a >= 0.8 THEN 'TRUNCATED' WHEN score >= 0.6 AND score < 0.9 OR a >= 0.5 AND a < 0.8 THEN 'WEAK' ELSE 'NO_SUPPORT' END AS verdict FROM (SELECT *, doc_id % 11 / 10 AS a FROM labelled)")
def x4_verdict(spark, d):
    x = v.labelled(spark, d)
    return x.select("doc_id", labels.verdict(F.col("doc_id") % 11 / 10, F.col("score"), F.lit(0.6), F.lit(0.9)).alias("verdict"))


@query("o5_stratified_sample")
def o5_stratified_sample(spark, d):
    return collapse.hash_sample(v.labelled(spark, d), 30, "doc_id", ["bucket"])


@query("o8_merge_rejects", f"WITH {v.READS}, n AS (SELECT *, count(*) OVER (PARTITION BY rid) AS nhits FROM reads) SELECT chrom, start0, rid, nhits, 'maps' AS source_rejects, 'TooManyMaps' AS reject_reason FROM n WHERE nhits > 3 UNION ALL SELECT chrom, start0, NULL, NULL, 'short', 'Short' FROM reads WHERE end0 - start0 < 19")
def o8_merge_rejects(spark, d):
    r = v.reads(spark, d)
    a = islands.with_multiplicity(r, 3)[1].select("chrom", "start0", "rid", "nhits", "reject_reason")
    b = r.where("end0 - start0 < 19").select("chrom", "start0", F.lit("Short").alias("reject_reason"))
    return collapse.merge_rejects({"maps": a, "short": b}, ["chrom", "start0", "reject_reason"])


@query("j19_membership", "SELECT d.doc_id, CASE WHEN EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text) THEN 'benchmark' ELSE 'unknown' END AS bucket FROM documents d")
def j19_membership(spark, d):
    b = v.load(spark, d, "benchmark").select("text").distinct().withColumn("bucket", F.lit("benchmark"))
    return v.load(spark, d, "documents").join(b, "text", "left").select("doc_id", F.coalesce("bucket", F.lit("unknown")).alias("bucket"))


# Reports and model quality.


def _q(p: float) -> str:
    return f"quantile_cont(score, {p})"


@query("a15_quantiles", f"WITH {v.LABELLED} SELECT label, count(*) AS n, min(score) AS min, max(score) AS max, round(avg(score), 9) AS mean, round(stddev_pop(score), 9) AS std, round({_q(0.1)}, 9) AS q10, round({_q(0.5)}, 9) AS q50, round({_q(0.9)}, 9) AS q90, round({_q(0.95)}, 9) AS q95, round({_q(0.99)}, 9) AS q99 FROM labelled GROUP BY label")
def a15_quantiles(spark, d):
    x = stats.describe(v.labelled(spark, d), ["score"], ["label"]).drop("metric")
    return x.select("label", "n", "min", "max", *[F.round(c, 9).alias(c) for c in ("mean", "std", "q10", "q50", "q90", "q95", "q99")])


@query("a17_tail_risk", f"WITH {v.LABELLED} SELECT bucket, count(*) AS n_samples, max(score) AS max_score, round(avg(score), 9) AS mean_score, round(median(score), 9) AS median_score, count(*) FILTER (score > 0.8) AS above_q95, count(*) FILTER (score > 0.95) AS above_q99, count(*) FILTER (score > 0.8) / count(*) AS frac_above_q95, count(*) FILTER (score > 0.95) / count(*) AS frac_above_q99 FROM labelled GROUP BY bucket")
def a17_tail_risk(spark, d):
    x = stats.tail_risk(v.labelled(spark, d), 0.8, 0.95)
    return x.withColumns({c: F.round(c, 9) for c in ("mean_score", "median_score")})


@query("v10_tail_alerts", f"WITH {v.LABELLED}, t AS (SELECT bucket, max(score) AS m, count(*) AS n, count(*) FILTER (score > 0.95) AS a FROM labelled GROUP BY bucket) SELECT max(m) > 0.9 AS high_max, 1000 * sum(a) / sum(n) > 50 AS high_rate, max(a / n) FILTER (bucket = 'N2') > max(a / n) FILTER (bucket = 'N3') AND 1000 * max(a / n) FILTER (bucket = 'N2') > 10 AS n2_above_n3 FROM t")
def v10_tail_alerts(spark, d):
    return stats.tail_alerts(stats.tail_risk(v.labelled(spark, d), 0.8, 0.95))


@query("a18_v8_separation", f"WITH {v.LABELLED}, q AS (SELECT quantile_cont(score, 0.1) FILTER (label = 1) AS p10, quantile_cont(score, 0.25) FILTER (label = 1) AS p25, quantile_cont(score, 0.5) FILTER (label = 1) AS p50, quantile_cont(score, 0.75) FILTER (label = 0) AS n75, avg(score) FILTER (label = 1) AS mp FROM labelled) SELECT round(avg((score >= p10)::INT), 9) AS neg_above_p10, round(avg((score >= p25)::INT), 9) AS neg_above_p25, round(avg((score >= p50)::INT), 9) AS neg_above_p50, round(any_value(p25 - n75), 9) AS gap, round(any_value(mp), 9) AS mean_pos, CASE WHEN any_value(p25 - n75) > 0.3 THEN 'good' WHEN any_value(p25 - n75) > 0.1 THEN 'moderate' ELSE 'poor' END AS separation, any_value(mp) < 0.3 AS crushed FROM labelled, q WHERE label = 0")
def a18_v8_separation(spark, d):
    x = stats.separation(v.labelled(spark, d))
    return x.withColumns({c: F.round(c, 9) for c in ("neg_above_p10", "neg_above_p25", "neg_above_p50", "gap", "mean_pos")})


@query("a22_histogram", f"WITH {v.LABELLED} SELECT least(floor(score * 20), 19)::INT AS bin, count(*) AS n FROM labelled GROUP BY ALL")
def a22_histogram(spark, d):
    return stats.histogram(v.labelled(spark, d), "score", 20)


@query("a23_distinct_scores", f"WITH {v.LABELLED} SELECT count(DISTINCT score) AS n_distinct, count(DISTINCT score) < 10 AS quantized FROM labelled")
def a23_distinct_scores(spark, d):
    return v.labelled(spark, d).agg(F.countDistinct("score").alias("n_distinct")).withColumn("quantized", F.col("n_distinct") < 10)


@query("a24_binary_metrics", f"""WITH {v.LABELLED}, c AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM labelled GROUP BY score),
k AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS ctp, sum(q) OVER (ORDER BY score DESC) AS cfp FROM c),
n AS (SELECT count(*) FILTER (label = 1) AS pp, count(*) FILTER (label = 0) AS nn, avg((score - label) ** 2) AS brier, count(*) FILTER (label = 0 AND score < 0.5) AS tn, count(*) FILTER (label = 0 AND score >= 0.5) AS fp, count(*) FILTER (label = 1 AND score < 0.5) AS fn, count(*) FILTER (label = 1 AND score >= 0.5) AS tp FROM labelled)
SELECT any_value(tn) AS tn, any_value(fp) AS fp, any_value(fn) AS fn, any_value(tp) AS tp, any_value((tn + tp) / (tn + fp + fn + tp)) AS accuracy, round(sum(q * (ctp - p / 2)) / any_value(pp * nn), 9) AS roc_auc, round(sum(p / pp * ctp / (ctp + cfp)), 9) AS avg_precision, round(any_value(brier), 9) AS brier, arg_min(score, {{'k': -round(2 * ctp / (ctp + cfp + pp), 12), 's': -score}}) AS best_threshold FROM k, n""")
def a24_binary_metrics(spark, d):
    x = stats.binary_metrics(v.labelled(spark, d))
    return x.withColumns({c: F.round(c, 9) for c in ("roc_auc", "avg_precision", "brier")})


@query("a25_reference_thresholds", f"WITH {v.LABELLED}, q AS (SELECT {_q(0.9)} AS q90, {_q(0.95)} AS q95, {_q(0.99)} AS q99 FROM labelled WHERE label = 0) SELECT round(any_value(q90), 9) AS q90, round(any_value(q95), 9) AS q95, round(any_value(q99), 9) AS q99, round(avg((score >= q90)::INT), 9) AS fpr_q90, round(avg((score >= q95)::INT), 9) AS fpr_q95, round(avg((score >= q99)::INT), 9) AS fpr_q99 FROM labelled, q WHERE label = 0")
def a25_reference_thresholds(spark, d):
    x = stats.reference_thresholds(v.labelled(spark, d))
    return x.select(*[F.round(c, 9).alias(c) for c in x.columns])


@query("v11_probability_checks", f"WITH {v.LABELLED}, b AS (SELECT round(score, 4) AS s, count(*) AS n, count(*) FILTER (score < 0 OR score > 1) AS bad FROM labelled GROUP BY ALL) SELECT sum(bad)::BIGINT AS out_of_range, count(*) AS n_distinct, max(n) / sum(n) AS top_share, count(*) < 5 AS too_few, max(n) / sum(n) > 0.9 AS concentrated FROM b")
def v11_probability_checks(spark, d):
    return stats.probability_checks(v.labelled(spark, d))


@query("stream_event_sessions", """WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, count(*) AS n, round(sum(value), 6) AS total, epoch_us(min(ts)) AS start_us, epoch_us(max(ts) + INTERVAL 30 MINUTE) AS end_us FROM s GROUP BY user_id, k""")
def stream_event_sessions(spark, d):
    from ribospark.streaming.sessions import event_sessions

    x = event_sessions(v.load(spark, d, "events"))
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias(f"{c}_us")
    return x.select("user_id", "n", F.round("total", 6).alias("total"), us("start"), us("end"))
