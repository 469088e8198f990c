from pyspark.sql import functions as F

from ribospark.functions import sequence as sq
from ribospark.functions import structure as st
from ribospark.operators import collapse, intervals, labels


def one(spark, **cols):
    return lambda **e: spark.createDataFrame([tuple(cols.values())], list(cols)).select(*[c.alias(k) for k, c in e.items()]).first().asDict()


def test_pairs_of_unbalanced_brackets(spark):
    got = one(spark, s=")((.)).(")(p=st.base_pairs(F.col("s")), r=st.stem_runs(st.base_pairs(F.col("s"))))
    assert [tuple(x) for x in got["p"]] == [(1, 5), (2, 4)]
    assert [tuple(x) for x in got["r"]] == [(1, 5, 2)]


def test_empty_and_short(spark):
    got = one(spark, s="")(low=sq.low_complexity(F.col("s")), k=sq.kmers(F.col("s"), 6), rc=sq.revcomp(F.col("s")), gc=sq.gc_fraction(F.col("s")))
    assert got == {"low": True, "k": [], "rc": "", "gc": 0.0}


def test_windows_end_at_the_end(spark):
    got = one(spark, s="ACGUACGUAC")(w=sq.windows(F.col("s"), 4, 4), whole=sq.windows(F.col("s"), 20, 3))
    assert got == {"w": [0, 4, 6], "whole": [0]}


def test_overlap_join_reports_a_pair_once_across_bins(spark):
    a = spark.createDataFrame([("c", 4000, 9000), ("c", 10, 10)], "chrom string, start0 long, end0 long")
    b = spark.createDataFrame([("c", 4095, 4097), ("c", 9000, 9100)], "k_chrom string, k_start0 long, k_end0 long")
    assert [(r.start0, r.k_start0, r.overlap_bp) for r in intervals.overlap_join(a, b).collect()] == [(4000, 4095, 2)]


def test_nms_keeps_the_best_of_overlapping_hits(spark):
    hits = spark.createDataFrame([("x", 0, 10, 0.9), ("x", 1, 11, 0.9), ("x", 8, 18, 0.5)], "input_id string, start int, end int, score double")
    assert sorted((r.start, r.end) for r in collapse.overlap_nms(hits).collect()) == [(0, 10), (8, 18)]


def test_ladder_blocks_repeats_first(spark):
    rows = [("Known-Confirmed", 0.1, 0, "Satellite/a"), ("Unknown", 0.9, 1, "NA"), ("Odd", 0.9, 1, None)]
    df = spark.createDataFrame(rows, "k string, s double, y int, r string")
    got = [tuple(x.l) for x in df.select(labels.ladder(F.col("k"), F.col("s"), F.col("y"), F.col("r")).alias("l")).collect()]
    assert got == [("Reject", "RepeatBlocked:SATELLITE"), ("Novel-High", "Unknown+RFHigh"), ("Reject", "UnhandledKnownStatus:Odd")]
