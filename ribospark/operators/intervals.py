"""Interval joins: bins make an overlap join an equi-join, so no pair of intervals is compared without a common bin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = 4096


def overlap_bp(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))


def _bins(df: DataFrame, s: str, e: str, width: int) -> DataFrame:
    first = F.floor(F.col(s) / width)
    last = F.floor(F.greatest(F.col(e) - 1, F.col(s)) / width)
    return df.withColumn("__bin", F.explode(F.sequence(first, last)))


def overlap_join(a: DataFrame, b: DataFrame, a_iv: tuple[str, str] = ("start0", "end0"), b_iv: tuple[str, str] = ("k_start0", "k_end0"), on: Sequence[tuple[str, str]] = (("chrom", "k_chrom"),), width: int = BIN) -> DataFrame:
    """All pairs that share at least one base, with overlap_bp; each pair once, from the first bin that both have."""
    (s, e), (ks, ke) = a_iv, b_iv
    x, y = _bins(a, s, e, width), _bins(b, ks, ke, width).withColumnRenamed("__bin", "__kbin")
    cond = F.col("__bin") == F.col("__kbin")
    for l, r in on:
        cond &= F.col(l) == F.col(r)
    first = F.greatest(F.floor(F.col(s) / width), F.floor(F.col(ks) / width)) == F.col("__bin")
    hit = (F.col(s) < F.col(ke)) & (F.col(ks) < F.col(e)) & first
    return x.join(y, cond & hit).drop("__bin", "__kbin").withColumn("overlap_bp", overlap_bp(F.col(s), F.col(e), F.col(ks), F.col(ke)))


def semi_mask(a: DataFrame, mask: DataFrame, flank: int = 0, width: int = BIN, anti: bool = False) -> DataFrame:
    """a's rows (chrom, start0, end0) that overlap (anti: don't overlap) a mask interval widened by flank."""
    m = mask.select(F.col("chrom").alias("k_chrom"), F.greatest(F.lit(0), F.col("start0") - flank).alias("k_start0"), (F.col("end0") + flank).alias("k_end0"))
    keyed = a.select("chrom", "start0", "end0").distinct()
    hit = overlap_join(keyed, m, width=width).select("chrom", "start0", "end0").distinct()
    return a.join(hit, ["chrom", "start0", "end0"], "left_anti" if anti else "left_semi")


def top_hit(pairs: DataFrame, key: Sequence[str], order: Sequence[Column], fields: Sequence[str]) -> DataFrame:
    """The best pair of each key by a struct of falling order columns: an aggregate that combines before the shuffle."""
    best = F.max(F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order)], *fields)).alias("__b")
    return pairs.groupBy(*key).agg(best).select(*key, *[F.col(f"__b.{f}").alias(f) for f in fields])


def center_in(center: Column, s: Column, e: Column) -> Column:
    return (center >= s) & (center < e)


def strand_ok(a: Column, b: Column) -> Column:
    """Equal strands, or either unknown."""
    return (a == ".") | (b == ".") | (a == b)
