"""Derived tables: reads, sequences with structures, annotations and scores over the driver's tables, in both dialects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASES = ("ACGU" * 7)[:26]
FROM, TO = LETTERS + LETTERS.lower(), BASES * 2
CHUNK = 100


def load(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Alignments from lineitem; a read id with several rows maps to several places."""
    long = lambda c: F.floor(c).cast("bigint")
    start = F.col("l_partkey") * 200 + F.col("l_suppkey") % 3 * 40 + long(F.col("l_quantity")) % 4
    return load(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("rid"),
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 2).cast("string")).alias("chrom"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        start.alias("start0"),
        (start + 18 + long(F.col("l_extendedprice")) % 9).alias("end0"),
    )


READS = """reads AS (
  SELECT l_orderkey * 8 + l_linenumber AS rid, 'chr' || (l_suppkey % 2) AS chrom,
    CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
    l_partkey * 200 + l_suppkey % 3 * 40 + floor(l_quantity)::BIGINT % 4 AS start0,
    l_partkey * 200 + l_suppkey % 3 * 40 + floor(l_quantity)::BIGINT % 4 + 18 + floor(l_extendedprice)::BIGINT % 9 AS end0
  FROM lineitem)"""
ISLANDS = """marked AS (
  SELECT *, CASE WHEN before IS NULL OR start0 > before + 50 THEN start0 END AS new0 FROM (
    SELECT *, max(end0) OVER (PARTITION BY chrom, strand ORDER BY start0, end0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM reads)),
placed AS (
  SELECT rid, chrom, strand, start0, end0, max(new0) OVER (PARTITION BY chrom, strand ORDER BY start0, end0 ROWS UNBOUNDED PRECEDING) AS island_start FROM marked)"""


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """Every document's letters as bases, cut into consecutive pieces of CHUNK; id is doc_id * 10^9 + piece."""
    letters = F.translate(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""), FROM, TO)
    pieces = F.regexp_extract_all(letters, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    docs = spread(load(spark, d, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.posexplode(pieces).alias("k", "seq")).select((F.col("doc_id").cast("bigint") * 1_000_000_000 + F.col("k")).alias("id"), "seq")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files give fewer tasks than half of them (one row group is one task)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 4) if df.rdd.getNumPartitions() * 2 <= cores else df


SEQUENCES = f"""sequences AS (
  SELECT doc_id::BIGINT * 1000000000 + k AS id, substr(s, k * {CHUNK} + 1, {CHUNK}) AS seq FROM (
    SELECT doc_id, s, unnest(range(0, (length(s) - 1) // {CHUNK} + 1)) AS k FROM (
      SELECT doc_id, translate(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'), '{FROM}', '{TO}') AS s FROM documents) WHERE length(s) > 0))"""


def mirror_pair(seq: Column) -> Column:
    """For i up to (L-3) div 2: the energy of bases i and L+1-i as a pair, 0 if they are none."""
    n = F.floor((F.length(seq) - 3) / 2).cast("int")
    pair = lambda i: F.concat(F.substring(seq, i, F.lit(1)), F.substring(seq, F.length(seq) + 1 - i, F.lit(1)))
    energy = lambda i: F.when(pair(i).isin("GC", "CG"), 3).when(pair(i).isin("AU", "UA"), 2).when(pair(i).isin("GU", "UG"), 1).otherwise(0)
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), energy)).otherwise(F.array().cast("array<int>"))


def mirror_fold(df: DataFrame) -> DataFrame:
    """df with struct and mfe of the mirror fold: a stand-in that pairs each base with its mirror image."""
    side = lambda c: F.array_join(F.transform("__e", lambda e: F.when(e > 0, c).otherwise(".")), "")
    middle = F.repeat(F.lit("."), F.length("seq") - 2 * F.size("__e"))
    out = df.withColumn("__e", mirror_pair(F.col("seq")))
    mfe = -F.aggregate("__e", F.lit(0), lambda a, e: a + e).cast("double")
    return out.withColumns({"struct": F.concat(side("("), middle, F.reverse(side(")"))), "mfe": mfe}).drop("__e")


def folded(spark: SparkSession, d: str) -> DataFrame:
    return mirror_fold(sequences(spark, d))


FOLDED = SEQUENCES + """,
energies AS (
  SELECT id, seq, list_transform(range(1, greatest((length(seq) - 3) // 2, 0) + 1), lambda i:
    CASE WHEN seq[i] || seq[length(seq) + 1 - i] IN ('GC', 'CG') THEN 3 WHEN seq[i] || seq[length(seq) + 1 - i] IN ('AU', 'UA') THEN 2
         WHEN seq[i] || seq[length(seq) + 1 - i] IN ('GU', 'UG') THEN 1 ELSE 0 END) AS e FROM sequences),
folded AS (
  SELECT id, seq, coalesce(array_to_string(list_transform(e, lambda x: CASE WHEN x > 0 THEN '(' ELSE '.' END), ''), '') || repeat('.', length(seq) - 2 * len(e)) ||
    coalesce(array_to_string(list_transform(list_reverse(e), lambda x: CASE WHEN x > 0 THEN ')' ELSE '.' END), ''), '') AS struct,
    -coalesce(list_sum(e), 0)::DOUBLE AS mfe FROM energies)"""


def known(spark: SparkSession, d: str) -> DataFrame:
    """Annotations from part: mature (22) and precursor (80) intervals of several databases."""
    k = F.col("p_partkey")
    start = k * 200 + F.col("p_size") % 60
    db = F.when(k % 3 == 0, "MirGeneDB").when(k % 3 == 1, "miRBase").otherwise("other")
    mature = k % 2 == 0
    return load(spark, d, "part").select(
        F.concat(F.lit("chr"), (F.floor(k / 2) % 2).cast("string")).alias("k_chrom"),
        start.alias("k_start0"),
        (start + F.when(mature, 22).otherwise(80)).alias("k_end0"),
        F.when(k % 5 == 0, ".").when(k % 5 < 3, "+").otherwise("-").alias("k_strand"),
        F.concat(F.lit("k"), k.cast("string")).alias("known_id"),
        db.alias("known_db"),
        F.when(mature, "mature").otherwise("precursor").alias("known_feature"),
    )


KNOWN = """known AS (
  SELECT 'chr' || (p_partkey // 2 % 2) AS k_chrom, p_partkey * 200 + p_size % 60 AS k_start0,
    p_partkey * 200 + p_size % 60 + CASE WHEN p_partkey % 2 = 0 THEN 22 ELSE 80 END AS k_end0,
    CASE WHEN p_partkey % 5 = 0 THEN '.' WHEN p_partkey % 5 < 3 THEN '+' ELSE '-' END AS k_strand, 'k' || p_partkey AS known_id,
    CASE p_partkey % 3 WHEN 0 THEN 'MirGeneDB' WHEN 1 THEN 'miRBase' ELSE 'other' END AS known_db,
    CASE WHEN p_partkey % 2 = 0 THEN 'mature' ELSE 'precursor' END AS known_feature FROM part)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of each gated island start with pads 70 and 100 and scores that are ratios of integers, so ties occur."""
    r = reads(spark, d).select("chrom", "strand", "start0").distinct()
    base = F.concat_ws("|", "chrom", "strand", F.col("start0").cast("string"))
    x = r.select("chrom", "strand", "start0", base.alias("base_id"), F.explode(F.array(F.lit(70), F.lit(100))).alias("pad"))
    score = (F.col("start0") * 7 + F.col("pad")) % 1000 / 1000
    return x.select("*", F.concat_ws("|pad", "base_id", F.col("pad").cast("string")).alias("candidate_id"), score.alias("rf_score"), F.when(score >= 0.5, 1).otherwise(0).alias("pred_label"), (F.lit(50) + F.col("start0") % 40).alias("hp_len"))


SCORED = READS + """,
scored AS (
  SELECT chrom, strand, start0, base_id, pad, base_id || '|pad' || pad AS candidate_id, (start0 * 7 + pad) % 1000 / 1000 AS rf_score,
    CASE WHEN (start0 * 7 + pad) % 1000 / 1000 >= 0.5 THEN 1 ELSE 0 END AS pred_label, 50 + start0 % 40 AS hp_len
  FROM (SELECT DISTINCT chrom, strand, start0, chrom || '|' || strand || '|' || start0 AS base_id FROM reads), (VALUES (70), (100)) AS p(pad))"""


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Labels with a score between 0 and 1 and a bucket, for model quality measures."""
    score = (F.col("doc_id") * 37 % 101 + F.col("quality") * 40) / 141
    return load(spark, d, "labels").select("doc_id", F.col("quality").alias("label"), score.alias("score"), F.concat(F.lit("N"), (F.col("doc_id") % 3 + 1).cast("string")).alias("bucket"))


LABELLED = """labelled AS (
  SELECT doc_id, quality AS label, (doc_id * 37 % 101 + quality * 40) / 141 AS score, 'N' || (doc_id % 3 + 1) AS bucket FROM labels)"""
