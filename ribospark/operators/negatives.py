"""Negative sets: shuffles and decoys with the reason of every reject, scan background, provenance and report columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ribospark.functions import sequence as sq
from ribospark.functions import structure as st

#: Kinds of structured RNA that decoys may come from, the first that an id names.
DECOY_SOURCES = ("tRNA", "snoRNA", "snRNA", "rRNA", "misc_RNA")


def fixed(c: Column, digits: int) -> Column:
    """c with so many decimals; ties of binary fractions go to the even digit, minus zero is zero."""
    tie = c * 65536 == F.floor(c * 65536)
    return F.format_string(f"%.{digits}f", F.when(tie, F.bround(c, digits)).otherwise(c))


def walk(seq: str, rng: np.random.Generator) -> str:
    """A walk from the first letter over the pairs of neighbours in random order, until the last letter has none left.

    The last pairs are not fixed, so it may end early: then it is shorter than seq and has a part of its pairs.
    """
    if len(seq) <= 2:
        return seq
    after: dict[str, list[str]] = {}
    for i in rng.permutation(len(seq) - 1).tolist():
        after.setdefault(seq[i], []).append(seq[i + 1])
    out = [seq[0]]
    while after.get(out[-1]):
        out.append(after[out[-1]].pop())
    return "".join(out)


@F.pandas_udf(StringType())
def _walks(seqs: pd.Series, seeds: pd.Series) -> pd.Series:
    return pd.Series([None if s is None else walk(s, np.random.default_rng(abs(int(k)))) for s, k in zip(seqs, seeds)], dtype=object)


def dinucleotide_shuffle(seq: Column, *seed: Column) -> Column:
    """The upper-case seq walked along its pairs; the seed is a hash of seq and the given columns."""
    u = F.upper(seq)
    return _walks(u, F.xxhash64(u, *seed))


def mono_shuffles(df: DataFrame, n: int, seq: str = "seq", seed: int = 42, tries: int = 10) -> DataFrame:
    """df with i and shuffled: up to n different shuffles of each row, from the first n * tries."""
    made = [sq.mono_shuffle(F.col(seq), seed + i) for i in range(n * tries)]
    some = F.slice(F.array_distinct(F.array(*made)), 1, n)
    return df.select("*", F.posexplode(some).alias("i", "shuffled"))


def shuffled_negatives(positives: DataFrame, fold: Callable[[DataFrame], DataFrame], per_seq: int = 5, seed: int = 42, gc_off: float = 0.02, mfe_off: float = 2.0, paired_off: float = 0.05) -> DataFrame:
    """Shuffles of positives (id, seq) with neg_id and reject_reason, null where accepted.

    In the order of ids and tries a shuffle is a duplicate if it equals a positive or an accepted one before it;
    then its GC share, energy and paired share are held against the original's. fold adds struct and mfe of seq.
    """
    clean = positives.select("id", sq.to_dna(F.col("seq")).alias("seq"))
    paired = lambda: 2 * st.num_pairs(F.col("struct")) / sq.length1(F.col("seq"))
    marks = lambda df: fold(df).withColumns({"gc": sq.gc_fraction(F.col("seq")), "paired": paired()}).drop("struct")
    own = marks(clean).select("id", F.col("seq").alias("o_seq"), F.col("gc").alias("o_gc"), F.col("mfe").alias("o_mfe"), F.col("paired").alias("o_paired"))
    tries = own.withColumn("try", F.explode(F.sequence(F.lit(0), F.lit(per_seq - 1))))
    x = marks(tries.withColumn("seq", dinucleotide_shuffle(F.col("o_seq"), F.lit(seed), F.col("id"), F.col("try"))))
    gate = F.when(F.abs(F.col("gc") - F.col("o_gc")) > gc_off, "gc").when(F.col("mfe") < F.col("o_mfe") - mfe_off, "mfe").when(F.col("paired") > F.col("o_paired") + paired_off, "paired")
    x = x.withColumn("gate", gate)
    # The first of equal shuffles that passes makes all behind it duplicates.
    first = x.where("gate IS NULL").groupBy("seq").agg(F.min(F.struct("id", "try")).alias("__first"))
    x = x.join(first, "seq", "left").join(clean.select("seq", F.lit(True).alias("__pos")).distinct(), "seq", "left")
    late = F.coalesce(F.struct("id", "try") > F.col("__first"), F.lit(False))
    why = F.when(F.coalesce("__pos", F.lit(False)) | late, "dup").otherwise(F.col("gate"))
    name = F.concat(F.lit("N1|orig="), F.col("id").cast("string"), F.lit("|gc="), fixed(F.col("gc"), 3), F.lit("|mfe="), fixed(F.col("mfe"), 1), F.lit(f"|seed={seed}"))
    return x.select("id", "try", F.translate("seq", "T", "U").alias("seq"), "gc", "mfe", "paired", name.alias("neg_id"), why.alias("reject_reason"))


def decoys(rna: DataFrame, positives: DataFrame, sources: Sequence[str] | None = None, shortest: int = 50, longest: int = 200) -> DataFrame:
    """rna (id, seq) with source, neg_id and reject_reason: length, equal to a positive, or (if sources are given) of none."""
    low = F.lower(F.col("id"))
    source = F.coalesce(*[F.when(low.contains(s.lower()), s) for s in sources or DECOY_SOURCES], F.lit("unknown"))
    x = rna.withColumn("seq", sq.to_dna(F.col("seq"))).withColumns({"source": source, "len": F.length("seq")})
    x = x.join(positives.select(sq.to_dna(F.col("seq")).alias("seq"), F.lit(True).alias("__pos")).distinct(), "seq", "left")
    why = F.when(~F.col("len").between(shortest, longest), "len").when(F.col("__pos"), "dup")
    if sources:
        why = why.when(F.col("source") == "unknown", "source")
    name = F.concat(F.lit("N3|source="), "source", F.lit("|id="), F.col("id").cast("string"), F.lit("|len="), F.col("len").cast("string"))
    return x.select("id", F.translate("seq", "T", "U").alias("seq"), "source", "len", name.alias("neg_id"), why.alias("reject_reason"))


def reject_counts(df: DataFrame) -> DataFrame:
    """Rows by reject_reason, the accepted ones too."""
    return df.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")).agg(F.count("*").alias("n"))


def union_buckets(buckets: dict[str, DataFrame], seed: int = 42, id_col: str = "neg_id") -> DataFrame:
    """All buckets in one table, in an order given by a hash of seed and id."""
    out = None
    for name, df in buckets.items():
        x = df.withColumn("bucket", F.lit(name))
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    return out.orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), id_col)


def inject_background(negatives: DataFrame, scan: DataFrame, id_col: str = "id", limit: int = 500, share: float = 0.05, weight: float = 0.2) -> DataFrame:
    """negatives with sample_weight 1 and as many scan rows with a lesser weight as make up share of both, at most limit."""
    n = min(limit, int(share / (1 - share) * negatives.count()))
    some = scan.orderBy(F.xxhash64(F.col(id_col), F.lit(0)), id_col).limit(n)
    return negatives.withColumn("sample_weight", F.lit(1.0)).unionByName(some.withColumn("sample_weight", F.lit(weight)), allowMissingColumns=True)


def genome_windows(fasta: DataFrame, width: int, step: int) -> DataFrame:
    """chrom, start0, end0, seq of windows of a genome (id, seq) without a short one at the end and without N."""
    n = F.length("seq")
    starts = F.when(n >= width, F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)), F.lit(step))).otherwise(F.array().cast("array<int>"))
    x = fasta.select(F.col("id").alias("chrom"), "seq", F.explode(starts).alias("start0"))
    x = x.select("chrom", "start0", (F.col("start0") + width).alias("end0"), F.col("seq").substr(F.col("start0") + 1, F.lit(width)).alias("seq"))
    return x.where(~F.upper("seq").contains("N"))


def _field(parts: Column, name: str) -> Column:
    """The value of the last part name=value."""
    hit = F.try_element_at(F.filter(parts, lambda p: p.startswith(f"{name}=")), F.lit(-1))
    return F.get(F.split(hit, "="), 1)


def provenance(neg_id: Column) -> Column:
    """struct(bucket, source_id, chrom, start, end, mfe, mfe_nt, notes) from a negative's id; missing texts are NA."""
    parts = F.split(neg_id, r"\|")
    n1, n2, n3 = (neg_id.startswith(x) for x in ("N1", "N2", "N3"))
    place = F.get(parts, 1)
    here = n2 & F.coalesce(place.rlike("^[^:]*:[^:-]*-[^:-]*$"), F.lit(False))
    rest = F.get(F.split(place, ":"), 1)
    text = lambda c: F.coalesce(c, F.lit("NA"))
    return F.struct(
        F.when(n1, "N1_composition").when(n2, "N2_scan_matched").when(n3, "N3_decoy").otherwise("unknown").alias("bucket"),
        text(F.when(n1, _field(parts, "orig")).when(n3, _field(parts, "id"))).alias("source_id"),
        text(F.when(here, F.get(F.split(place, ":"), 0))).alias("chrom"),
        text(F.when(here, F.get(F.split(rest, "-"), 0))).alias("start"),
        text(F.when(here, F.get(F.split(rest, "-"), 1))).alias("end"),
        F.when(n1, _field(parts, "mfe").try_cast("double")).alias("mfe"),
        _field(parts, "mfe_nt").try_cast("double").alias("mfe_nt"),
        F.when(n1, "dinuc_shuffle").when(n2, "scan_extracted").when(n3, "mirbase_decoy").otherwise("").alias("notes"),
    )


def negatives_report(df: DataFrame) -> DataFrame:
    """Report texts of negatives (neg_id, seq): energy from the id, by length where only one of both is given."""
    x = df.withColumn("p", provenance(F.col("neg_id"))).withColumn("len", F.length("seq"))
    mfe = F.coalesce("p.mfe", F.col("p.mfe_nt") * F.col("len"))
    per = F.when(F.col("p.mfe").isNotNull(), F.when(F.col("len") > 0, F.col("p.mfe") / F.col("len")).otherwise(0.0)).otherwise(F.col("p.mfe_nt"))
    show = lambda c, digits: F.when(c.isNull(), "NA").otherwise(fixed(c, digits))
    return x.select("p.bucket", F.col("neg_id").alias("id"), "p.source_id", F.col("p.chrom").alias("chr"), "p.start", "p.end", "len", fixed(sq.gc_fraction(F.col("seq")), 3).alias("gc"), show(mfe, 1).alias("mfe"), show(per, 3).alias("mfe_per_nt"), F.lit("NA").alias("paired_frac"), "p.notes")
