"""Sinks: text tables, FASTA, BED6, JSON summaries and audit trails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """The given columns with a header; missing values are empty, other columns are dropped."""
    have = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    df.select(*have).write.csv(path, sep="\t", header=True, emptyValue="")


def write_fasta(df: DataFrame, path: str, id_col: str = "id", seq_col: str = "seq") -> None:
    df.select(F.concat(F.lit(">"), F.col(id_col), F.lit("\n"), F.col(seq_col)).alias("value")).write.text(path)


def bed6(peaks: DataFrame) -> DataFrame:
    """chrom, start, end, name, score, strand: the base before the centre; score min(1000, dominance * 1000), halves to even."""
    score = F.least(F.lit(1000), F.bround(1000 * F.col("dominance"), 0)).cast("int")
    return peaks.select("chrom", (F.col("center0") - 1).alias("start"), F.col("center0").alias("end"), F.col("peak_id").alias("name"), score.alias("score"), "strand")


def qc_json(df: DataFrame, stage: str, counters: dict) -> DataFrame:
    """One JSON row of named aggregates of a stage."""
    g = df.agg(*[c.alias(k) for k, c in counters.items()])
    return g.select(F.to_json(F.struct(F.lit(stage).alias("stage"), *counters)).alias("value"))


def place_of(df: DataFrame) -> DataFrame:
    """A sorted frame with place, its rows' numbers from 1: counted per partition, then offset, in no single task."""
    part = df.withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id()})
    part = part.withColumn("__i", F.col("__i").bitwiseAND((1 << 33) - 1)).persist()
    sizes = part.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.alias("a").join(sizes.select(F.col("__p").alias("__q"), F.col("__n").alias("__m")), F.col("__q") < F.col("__p"), "left")
    offset = before.groupBy("__p").agg(F.coalesce(F.sum("__m"), F.lit(0)).alias("__o"))  # one row per partition
    return part.join(F.broadcast(offset), "__p").withColumn("place", F.col("__o") + F.col("__i") + 1).drop("__p", "__i", "__o")


def write_with_rejects(df: DataFrame, path: str, rejects: str) -> None:
    """Rows without a reject_reason to path, the others appended to rejects; df is computed once."""
    held = df.persist()
    held.where("reject_reason IS NULL").drop("reject_reason").write.parquet(path)
    held.where("reject_reason IS NOT NULL").write.mode("append").parquet(rejects)
    held.unpersist()
