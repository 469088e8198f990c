"""Known-annotation labels, decision ladders and the read-aware mature choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import center_in, overlap_join, strand_ok


def early_labels(pk: DataFrame, known: DataFrame) -> DataFrame:
    """pk (peak_id, chrom, start0, end0, center0, strand) with known_early_status and its best hit.

    A mature hit with the centre inside on a fitting strand confirms; any other hit marks the region.
    Best mature: centre inside, then overlap; best precursor: overlap; ties go to the least id.
    """
    hits = overlap_join(pk, known).withColumns({"center_in": center_in(F.col("center0"), F.col("k_start0"), F.col("k_end0")), "strand_ok": strand_ok(F.col("strand"), F.col("k_strand"))})
    rank = F.when(F.col("known_feature") == "mature", 1).otherwise(0)
    inside = F.when(rank == 1, F.col("center_in").cast("int")).otherwise(0)
    best = F.min(F.struct((-rank).alias("r"), (-inside).alias("i"), (-F.col("overlap_bp")).alias("o"), "known_id", "known_db", "known_feature", "overlap_bp", "center_in", "strand_ok")).alias("b")
    b = hits.groupBy("peak_id").agg(best).select("peak_id", *[f"b.{c}" for c in ("known_id", "known_db", "known_feature", "overlap_bp", "center_in", "strand_ok")])
    status = F.when(F.col("known_id").isNull(), "Unknown").when((F.col("known_feature") == "mature") & F.col("center_in") & F.col("strand_ok"), "Known-Confirmed").otherwise("Known-Region")
    return pk.join(b, "peak_id", "left").withColumn("known_early_status", status)


def db_rank(db: Column) -> Column:
    return F.when(db == "MirGeneDB", 0).when(db == "miRBase", 1).otherwise(2)


def late_labels(pk: DataFrame, known: DataFrame, slack: int = 2, least_bp: int = 10) -> DataFrame:
    """pk with known_status and its reasons; the mature query is widened by slack.

    Confirmed: same definite strand, at least least_bp of overlap, centre within slack. Order of hits:
    overlap, strand, database, centre inside; ties go to the least id.
    """
    q = pk.withColumns({"q_start0": F.col("start0") - slack, "q_end0": F.col("end0") + slack})
    mature = known.where("known_feature = 'mature'")
    same = (F.col("strand") == F.col("k_strand")) & (F.col("strand") != ".")

    def best(hits: DataFrame, name: str) -> DataFrame:
        within = center_in(F.col("center0"), F.col("k_start0") - slack, F.col("k_end0") + slack)
        order = F.min(F.struct((-F.col("overlap_bp")).alias("o"), (-same.cast("int")).alias("s"), db_rank(F.col("known_db")).alias("d"), (-within.cast("int")).alias("c"), "known_id", "known_db", "overlap_bp", same.alias("same"), within.alias("within")))
        return hits.groupBy("peak_id").agg(order.alias("b")).select("peak_id", F.struct("b.known_id", "b.known_db", "b.overlap_bp", "b.same", "b.within").alias(name))

    m = best(overlap_join(q, mature, ("q_start0", "q_end0")), "m")
    p = best(overlap_join(pk, known.where("known_feature <> 'mature'")), "p")
    x = pk.join(m, "peak_id", "left").join(p, "peak_id", "left")
    good = F.col("m.same") & (F.col("m.overlap_bp") >= least_bp) & F.col("m.within")
    status = F.when(F.col("m").isNotNull() & good, "Known-Confirmed").when(F.col("m").isNotNull() | F.col("p").isNotNull(), "Known-Atypical").otherwise("Unknown")
    why = F.concat_ws(";", F.when(~F.col("m.same"), "StrandMismatch"), F.when(F.col("m.overlap_bp") < least_bp, "ShortOverlap"), F.when(~F.col("m.within"), "CenterOutside"))
    reason = F.when(F.col("m").isNotNull() & ~good, why).when(F.col("m").isNull() & F.col("p").isNotNull(), "PrecursorOnly").otherwise("")
    return x.select(*pk.columns, status.alias("known_status"), reason.alias("known_reason"), F.coalesce("m.known_id", "p.known_id").alias("known_id"), F.coalesce("m.known_db", "p.known_db").alias("known_db"))


def norm_repeat(c: Column) -> Column:
    """Part before "/", upper case; null-like words are empty."""
    x = F.trim(F.coalesce(c, F.lit("")))
    return F.when(F.upper(x).isin("", "NA", "NONE", "NO", "NAN"), "").otherwise(F.upper(F.trim(F.split_part(x, F.lit("/"), F.lit(1)))))


def ladder(status: Column, score: Column, label: Column, repeat: Column, block: Sequence[str] = ("SIMPLE_REPEAT", "LOW_COMPLEXITY", "SATELLITE"), allow: Sequence[str] = (), known_min: tuple[float, float] = (0.55, 0.65), novel_min: tuple[float, float] = (0.65, 0.75)) -> Column:
    """struct(final_label, reason): repeat lists first, then the known status with its score threshold (repeats: the second)."""
    rc = norm_repeat(repeat)
    pick = lambda t: F.when(rc != "", t[1]).otherwise(t[0])
    out = lambda l, r: F.struct(F.lit(l).alias("final_label"), (r if isinstance(r, Column) else F.lit(r)).alias("reason"))
    low = lambda name, t: F.concat(F.lit(name), F.format_string("%.3f", pick(t)))
    ks = F.trim(F.coalesce(status, F.lit("Unknown")))
    x = F.when(F.lit(bool(allow)) & ~rc.isin(list(allow) or [""]), out("Reject", F.concat(F.lit("RepeatNotAllowed:"), rc)))
    if not allow:
        x = x.when(rc.isin(list(block)), out("Reject", F.concat(F.lit("RepeatBlocked:"), rc)))
    x = x.when(ks == "Known-Confirmed", out("Known-Confirmed", "KnownConfirmed"))
    x = x.when((ks == "Known-Atypical") & (score >= pick(known_min)), out("Known-Atypical", "KnownAtypical+RF"))
    x = x.when(ks == "Known-Atypical", out("Reject", low("KnownAtypicalLowRF<", known_min)))
    x = x.when((ks == "Unknown") & (label == 1) & (score >= pick(novel_min)), out("Novel-High", "Unknown+RFHigh"))
    x = x.when((ks == "Unknown") & (F.coalesce(label, F.lit(0)) != 1), out("Reject", "UnknownPredLabel0"))
    x = x.when(ks == "Unknown", out("Reject", low("UnknownLowRF<", novel_min)))
    return x.otherwise(out("Reject", F.concat(F.lit("UnhandledKnownStatus:"), ks)))


def verdict(a: Column, b: Column, q95: Column, q99: Column, least_a: float = 0.8) -> Column:
    """Support from the duplex (a) and precursor (b) scores against the negatives' quantiles."""
    return (
        F.when(q95.isNull() | q99.isNull(), "WEAK")
        .when((b >= q99) & (a >= least_a), "HIGH")
        .when((b < q95) & (a >= least_a), "TRUNCATED")
        .when(((b >= q95) & (b < q99)) | ((a >= 0.5) & (a < least_a)), "WEAK")
        .otherwise("NO_SUPPORT")
    )


def route(length: Column, direct: int = 120, scan: int = 5000) -> Column:
    return F.when(length <= direct, "direct").when(length <= scan, "scan").otherwise("too_long")


def stage_a(score5: Column, score3: Column, facing: Column) -> Column:
    """Both arms facing: the lesser score; both but not facing: 0.7 of the greater; one arm: 0.7 of its score."""
    both = score5.isNotNull() & score3.isNotNull()
    return F.when(both & facing, F.least(score5, score3)).when(both, 0.7 * F.greatest(score5, score3)).otherwise(0.7 * F.coalesce(score5, score3, F.lit(0.0)))


def mature_choice(df: DataFrame, most_off: float = 20.0) -> DataFrame:
    """df (seq, pad, arm, start, end, length, score, mature_seq, len_mode) with the window around pad where the model's lies too far off.

    The window is cut at the ends of seq, its score is the text 0.0; rows whose start or end is no number keep theirs.
    """
    start, end = F.col("start").try_cast("int"), F.col("end").try_cast("int")
    far = (F.abs(F.col("pad") - (start + end) / 2) > most_off) & (F.length("seq") > 0) & (F.col("pad") > 0)
    n = F.least(F.lit(24), F.greatest(F.lit(18), F.coalesce(F.col("len_mode").try_cast("double").cast("int"), F.col("length").try_cast("int"), F.lit(21))))
    half = F.floor(n / 2).cast("int")
    first, last = F.greatest(F.lit(0), F.col("pad") - half), F.least(F.length("seq"), F.col("pad") + half + n % 2)
    over = F.coalesce(far, F.lit(False))
    pick = lambda new, old: F.when(over, new).otherwise(F.col(old))
    return df.withColumns({
        "overridden": over,
        "m_start": pick(first.cast("string"), "start"),
        "m_end": pick(last.cast("string"), "end"),
        "m_length": pick((last - first).cast("string"), "length"),
        "m_arm": pick(F.when(first < F.length("seq") / 2, "5p").otherwise("3p"), "arm"),
        "m_score": pick(F.lit("0.0"), "score"),
        "m_seq": pick(F.col("seq").substr(first + 1, F.greatest(last - first, F.lit(0))), "mature_seq"),
    })
