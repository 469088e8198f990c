import gzip

from pyspark.sql import functions as F

from ribospark.sources import readers, writers


def test_fasta_round_trip(spark, tmp_path):
    p = tmp_path / "a.fa.gz"
    with gzip.open(p, "wt") as f:
        f.write(">a first\nACGT\nnn\n>b\n\n>c x\nGG\n")
    df = readers.read_fasta(spark, str(p))
    assert {r.id: r.seq for r in df.collect()} == {"a": "ACGTnn", "b": "", "c": "GG"}
    writers.write_fasta(df, str(tmp_path / "out"))
    assert {r.id: r.seq for r in readers.read_fasta(spark, str(tmp_path / "out")).collect()} == {"a": "ACGTnn", "b": "", "c": "GG"}


def test_annotations(spark, tmp_path):
    (tmp_path / "x.gff3").write_text("##gff\nchr1\t.\tmiRNA\t11\t32\t.\t+\t.\tID=i;Name=m=1;Name=m2\nchr1\t.\tgene\t1\t9\t.\t+\t.\tID=g\nchr1\t.\tmiRNA\t1\t9\t.\t-\t.\tNote=x\n")
    got = [(r.k_start0, r.k_end0, r.known_id, r.known_feature) for r in readers.read_gff3(spark, str(tmp_path / "x.gff3"), "db").orderBy("k_start0").collect()]
    assert got == [(0, 9, "NA", "mature"), (10, 32, "m2", "mature")]
    (tmp_path / "x.bed").write_text("track x\nchr1\t5\t9\tn\t0\t+\nchr1\t9\t5\tbad\t0\t+\nchr2\t1\t2\ts\t0\tx\n")
    assert [(r.k_start0, r.k_strand) for r in readers.read_bed6(spark, str(tmp_path / "x.bed"), "d", "f").orderBy("k_chrom").collect()] == [(5, "+"), (1, ".")]


def test_alignments_and_fetch(spark, tmp_path):
    (tmp_path / "x.map").write_text("r1\t+\tchr1\t7\tACGT\tIIII\t0\t3:A>C,4:G>T\nr2\t-\tchr1\tx\tACGT\tIIII\nr3\t-\tchr1\t2\tAC\tII\t0\t\n")
    got = {r.rid: (r.start0, r.end0, r.nm) for r in readers.read_alignments(spark, str(tmp_path / "x.map")).collect()}
    assert got == {"r1": (7, 11, 2), "r3": (2, 4, 0)}
    genome = readers.genome_chunks(spark.createDataFrame([("chr1", "acgtacgtac" * 3)], "id string, seq string"), size=10)
    ranges = spark.createDataFrame([("chr1", -2, 3), ("chr1", 8, 13), ("chrX", 1, 2)], "chrom string, start0 long, end0 long")
    assert {(r.chrom, r.start0): r.fetched for r in readers.fetch(ranges, genome, 10).collect()} == {("chr1", -2): "ACG", ("chr1", 8): "ACACG", ("chrX", 1): ""}


def test_sessions_as_a_stream(spark, sf, tmp_path):
    from ribospark.streaming.sessions import event_sessions

    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf}/events*.parquet")
    q = event_sessions(stream).writeStream.format("memory").queryName("sessions").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert 0 < spark.table("sessions").count() <= event_sessions(events).count()
