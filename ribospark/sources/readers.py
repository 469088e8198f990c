"""File formats as DataFrames. Gzip is transparent by suffix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str, whole_header: bool = False) -> DataFrame:
    """id, seq: the id is the header's first word (whole_header: all of it); sequence lines are joined, case kept."""
    raw = spark.read.text(path, lineSep=">").where(F.length(F.trim("value")) > 0)
    head = F.regexp_replace(F.split("value", "\n", 2)[0], r"\r$", "")
    body = F.regexp_replace(F.coalesce(F.get(F.split("value", "\n", 2), 1), F.lit("")), r"\s+", "")
    return raw.select((head if whole_header else F.split(F.trim(head), r"\s+")[0]).alias("id"), body.alias("seq"))


def read_fasta_map(spark: SparkSession, path: str) -> DataFrame:
    """id (whole header), seq in upper-case RNA letters; sequences of one id are joined in file order."""
    x = read_fasta(spark, path, whole_header=True).withColumn("k", F.monotonically_increasing_id())
    g = x.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("k", "seq"))).alias("s"))
    return g.select("id", F.translate(F.upper(F.array_join(F.transform("s", lambda y: y["seq"]), "")), "T", "U").alias("seq"))


def count_fastq(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count() // 4


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Aligner text: at least six TAB fields and a whole-number offset; others are left out."""
    f = F.split("value", "\t", -1)
    x = spark.read.text(path).select(f.alias("f")).where((F.size("f") >= 6) & F.get("f", 3).try_cast("long").isNotNull())
    m = F.get("f", 7)
    nm = F.when(m.isNull() | m.isin("", "0"), 0).otherwise(F.length(m) - F.length(F.replace(m, F.lit(","), F.lit(""))) + 1)
    start = F.get("f", 3).try_cast("long")
    return x.select(F.get("f", 0).alias("rid"), F.get("f", 1).alias("strand"), F.get("f", 2).alias("chrom"), start.alias("start0"), (start + F.length(F.get("f", 4))).alias("end0"), F.get("f", 4).alias("seq"), nm.alias("nm"))


def read_bed6(spark: SparkSession, path: str, db: str, feature: str) -> DataFrame:
    """Strict BED: six TAB fields, end after start; comment, track and browser lines are skipped."""
    x = spark.read.text(path).where(~F.col("value").rlike("^(#|track|browser)")).select(F.split("value", "\t", -1).alias("f"))
    s, e = F.get("f", 1).try_cast("long"), F.get("f", 2).try_cast("long")
    strand = F.when(F.get("f", 5).isin("+", "-"), F.get("f", 5)).otherwise(".")
    return x.where((F.size("f") >= 6) & (e > s)).select(F.get("f", 0).alias("k_chrom"), s.alias("k_start0"), e.alias("k_end0"), strand.alias("k_strand"), F.coalesce(F.nullif(F.get("f", 3), F.lit("")), F.lit("NA")).alias("known_id"), F.lit(db).alias("known_db"), F.lit(feature).alias("known_feature"))


def read_bed(spark: SparkSession, path: str, db: str = "bed") -> DataFrame:
    """Lenient BED: three fields split by any white space; the name defaults to db:chrom:start-end."""
    x = spark.read.text(path).where(~F.col("value").rlike(r"^(#|track|browser)|^\s*$")).select(F.split(F.trim("value"), r"\s+").alias("f"))
    c, s, e = F.get("f", 0), F.get("f", 1).try_cast("long"), F.get("f", 2).try_cast("long")
    name = F.coalesce(F.get("f", 3), F.concat(F.lit(f"{db}:"), c, F.lit(":"), s.cast("string"), F.lit("-"), e.cast("string")))
    return x.where((F.size("f") >= 3) & s.isNotNull() & e.isNotNull()).select(c.alias("chrom"), s.alias("start0"), e.alias("end0"), name.alias("name"))


def gff3_attribute(attrs, name: str):
    """The last value of name in k=v;k=v; the first = splits."""
    hits = F.filter(F.split(attrs, ";"), lambda kv: F.trim(F.split(kv, "=", 2)[0]) == name)
    return F.trim(F.get(F.split(F.try_element_at(hits, F.lit(-1)), "=", 2), 1))


def read_gff3(spark: SparkSession, path: str, db: str, mature: Sequence[str] = ("miRNA",), precursor: Sequence[str] = ("miRNA_primary_transcript", "pre_miRNA"), names: Sequence[str] = ("Name", "ID", "Alias", "Parent", "Derives_from")) -> DataFrame:
    """GFF3 features of the given types in 0-based half-open coordinates, named by the first attribute there is."""
    x = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.split("value", "\t", -1).alias("f")).where(F.size("f") >= 9)
    a = F.get("f", 8)
    kind = F.when(F.get("f", 2).isin(list(mature)), "mature").when(F.get("f", 2).isin(list(precursor)), "precursor")
    name = F.coalesce(*[F.nullif(gff3_attribute(a, n), F.lit("")) for n in names], F.lit("NA"))
    out = x.select(F.get("f", 0).alias("k_chrom"), (F.get("f", 3).try_cast("long") - 1).alias("k_start0"), F.get("f", 4).try_cast("long").alias("k_end0"), F.when(F.get("f", 6).isin("+", "-"), F.get("f", 6)).otherwise(".").alias("k_strand"), name.alias("known_id"), F.lit(db).alias("known_db"), kind.alias("known_feature"))
    return out.where("known_feature IS NOT NULL AND k_start0 IS NOT NULL AND k_end0 > k_start0")


def read_gff3_any(spark: SparkSession, path: str, db: str) -> DataFrame:
    """All GFF3 rows with a kind inferred from the type, an ontology term, or the name's arm suffix, else "other"."""
    x = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.split("value", "\t", -1).alias("f")).where(F.size("f") == 9)
    a, t = F.get("f", 8), F.lower(F.get("f", 2))
    given = lambda *names: F.coalesce(*[F.nullif(gff3_attribute(a, n), F.lit("")) for n in names])
    # fixed values: feature types and the words of ontology terms
    term = F.coalesce(F.lower(given("so_term", "Ontology_term")), F.lit(""))
    kind = (
        F.when(t.isin("mirna", "mature_mirna", "mature-mirna"), "mature")
        .when(t.isin("mirna_primary_transcript", "pri_mirna", "pre_mirna", "mirna_precursor", "stem_loop", "hairpin"), "precursor")
        .when(term.contains("mature"), "mature")
        .when(term.rlike("precursor|stem|hairpin"), "precursor")
        .when(F.lower(given("Name", "ID")).rlike("-[53]p$"), "mature")
        .otherwise("other")
    )
    s0, e0 = F.get("f", 3).try_cast("long") - 1, F.get("f", 4).try_cast("long")
    strand = F.when(F.get("f", 6).isin("+", "-", "."), F.get("f", 6)).otherwise(".")
    place = F.concat(F.lit(f"{db}:"), F.get("f", 0), F.lit(":"), s0.cast("string"), F.lit("-"), e0.cast("string"), F.lit(":"), strand)
    known = F.coalesce(given("ID", "Name", "Alias"), place)
    out = x.select(F.get("f", 0).alias("chrom"), s0.alias("start0"), e0.alias("end0"), strand.alias("strand"), F.lit(db).alias("db"), kind.alias("feature"), known.alias("id"), F.coalesce(given("Name", "ID"), known).alias("name"))
    return out.where("start0 IS NOT NULL AND end0 IS NOT NULL")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A table with a header, all values text."""
    return spark.read.csv(path, sep="\t", header=True)


def genome_chunks(fasta: DataFrame, size: int = 1 << 16) -> DataFrame:
    """chrom, chunk, seq of a genome (id, seq): pieces of size bases."""
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.length("seq"), F.lit(1)) - 1) / size).cast("int")), lambda i: F.struct(i.cast("long").alias("chunk"), F.upper(F.substring(F.col("seq"), i * size + 1, F.lit(size))).alias("seq")))
    return fasta.select(F.col("id").alias("chrom"), F.explode(cut).alias("c")).select("chrom", "c.chunk", "c.seq")


def fetch(ranges: DataFrame, chunks: DataFrame, size: int = 1 << 16) -> DataFrame:
    """ranges (chrom, start0, end0) with fetched: starts below 0 are clamped, "" where the genome lacks the range; a range may span chunks."""
    s = F.greatest(F.col("start0"), F.lit(0))
    e = F.greatest(F.col("end0"), s)
    keys = ranges.select("chrom", "start0", "end0").distinct()
    x = keys.withColumn("chunk", F.explode(F.sequence(F.floor(s / size), F.floor(F.greatest(e - 1, s) / size)))).join(chunks, ["chrom", "chunk"])
    at = F.greatest(s - F.col("chunk") * size, F.lit(0))
    part = F.col("seq").substr((at + 1).cast("int"), (F.least(e - F.col("chunk") * size, F.lit(size)) - at).cast("int"))
    whole = x.groupBy("chrom", "start0", "end0").agg(F.array_sort(F.collect_list(F.struct("chunk", part.alias("p")))).alias("ps"))
    whole = whole.select("chrom", "start0", "end0", F.array_join(F.transform("ps", lambda p: p["p"]), "").alias("fetched"))
    return ranges.join(whole, ["chrom", "start0", "end0"], "left").withColumn("fetched", F.coalesce("fetched", F.lit("")))
