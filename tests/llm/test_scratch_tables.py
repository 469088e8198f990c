"""Scratch tables are written and read in parts, however many rows a task has."""

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ribospark.llm import common


def test_row_groups_are_bounded(spark):
    """Lists of hashes, which don't compress: 24 MB of them from one task."""
    hashes = F.transform(F.sequence(F.lit(1), F.lit(500)), lambda i: F.xxhash64("id", i))
    df, path = common.materialize(spark.range(0, 6000, 1, 1).select("id", hashes.alias("sh")), "scratch-test")
    (file,) = Path(path.removeprefix("file:")).glob("part-*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) <= 2 * common.ROW_GROUP_BYTES
    assert df.agg(F.count_distinct("id"), F.sum(F.size("sh"))).first()[:] == (6000, 3_000_000)
    common.remove(spark, path)


def test_readers_take_few_rows_at_once(spark):
    common.scratch_root(spark)
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) == common.BATCH_ROWS
