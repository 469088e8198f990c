"""Shared plumbing of the training-data operators: scratch tables, packed arrays, components."""

from __future__ import annotations

import ctypes
import functools
import gc
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of every contract: runs without space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a batch, from Parquet or in Arrow: whole texts are long, and a batch is held by the executor and by its worker.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # The vectors of 4096 rows (Spark's default) of texts or of shingle lists are some 35 MB for each task.
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; where none is set, one in the warehouse, which is shared too."""
    small_batches(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
        else:
            root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/ribospark-scratch"
    return root.rstrip("/")


#: Bytes of a scratch table's row group (Spark: 128 MB). A task's Parquet writer holds one, its reader two columns of one;
#: hashes and blobs hardly compress, so with Spark's default the tasks of one executor fill a heap of 1 GB by themselves.
ROW_GROUP_BYTES = 4 << 20


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df as a table in the shared folder and read it back; cuts the lineage for good."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage, so that shuffle files which nothing needs leave the disks."""
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for p in paths:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(p)
        jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def tidy() -> None:
    """Give a Python worker's free memory back to the system: workers live on, and so would their greatest size."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to give back
        pass


def tidied(run):
    """run, a function over a partition's batches, with tidy() at the end of the partition."""

    @functools.wraps(run)
    def whole(it):
        try:
            yield from run(it)
        finally:
            tidy()

    return whole


def tidied_group(run):
    """run, a function over a group's table, with tidy() after each group."""

    @functools.wraps(run)
    def whole(t):
        try:
            return run(t)
        finally:
            tidy()

    return whole


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def input_bytes(df: DataFrame) -> int:
    """Bytes of df's files by the optimizer's estimate; 0 where it has none."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def pack_arrays(*arrays: np.ndarray, level: int = 1) -> bytes:
    """One compressed blob: per array its dtype, length and transposed bytes (high bytes together)."""
    import zstandard

    out = [struct.pack("<B", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        out.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"")
    return zstandard.ZstdCompressor(level=level).compress(b"".join(out))


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 1, []
    for _ in range(raw[0]):
        kind, n = struct.unpack_from("<2sQ", raw, at)
        at += 10
        dt = np.dtype("<" + kind.decode())
        if n:
            planes = np.frombuffer(raw, np.uint8, n * dt.itemsize, at).reshape(dt.itemsize, n)
            out.append(np.ascontiguousarray(planes.T).view(dt).reshape(n))
        else:
            out.append(np.empty(0, dt))
        at += n * dt.itemsize
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component label (smallest reachable id) of each node of undirected edges (a, b).

    Alternating large-star and small-star rounds (Kiveris et al. 2014), each written to the shared
    folder; a hub's row count never exceeds its edge count, and groups are reduced by min() before
    any row meets another, so no task gathers a component. Returns (id, component); nodes without an
    edge to another node are absent.
    """
    spark = edges.sparkSession
    cur, path = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc"
    )
    last = None
    for _ in range(max_rounds):
        both = cur.select("a", "b").unionAll(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: neighbours above a node move to the least of its neighbourhood
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        # small star: of the remaining parents of a node, all join the least one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        new, new_path = materialize(small, "cc")
        sig = new.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        remove(spark, path)
        cur, path = new, new_path
        if last == (sig["n"], sig["x"]):
            break
        last = (sig["n"], sig["x"])
    else:
        raise RuntimeError("components did not settle")
    nodes = cur.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.unionAll(cur.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
