"""Tables of a data folder, and the folder for what is written on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; a session on one machine may go without."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return root.rstrip("/") if root else "file://" + tempfile.mkdtemp(prefix="sylvan-")


def kept(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """`rows`, written to the shared folder and read again."""
    at = f"{scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    rows.write.parquet(at)
    return spark.read.schema(rows.schema).parquet(at)


def numbered(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """`rows` with `name`, a row's place from 1 among those of its group in an order. A group of any size is no task's alone: rows are sorted in ranges, each is numbered where it stands, and
    what a group has in earlier ranges is added. They are kept in between, as ranges are cut by a sample."""
    ranges = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    placed = kept(rows.sparkSession, ranges.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_range", F.shiftright("_at", 33))
    heads = placed.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = heads.select("_group", "_of", (before - F.col("_first") + 1).alias("_shift"))
    both = placed.join(heads, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return both.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(name))


#: Bytes of an Arrow batch that goes to Python; rows of texts of any length are bounded by it and not by their number.
BATCH = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(size).removesuffix("b")) > BATCH:
        spark.conf.set(size, BATCH)


def spread(rows: DataFrame) -> DataFrame:
    """`rows` dealt evenly over some four tasks a core: readers cut tables by bytes, so small rows of which each costs much, as in Python, would all be a few tasks' work.
    At least 64, if a shuffle has as many, since executors may still be on their way."""
    spark = rows.sparkSession
    return rows.repartition(max(4 * spark.sparkContext.defaultParallelism, min(64, int(spark.conf.get("spark.sql.shuffle.partitions")))))
