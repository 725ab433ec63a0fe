"""Shared scratch tables: intermediate results are written once and read again, so that lineage is cut
and a lost executor costs a re-read rather than a recomputation."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. A session on a single machine may go without one and
    gets a temporary folder; on a cluster that would lose rows, so it is refused."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.conf.get("spark.sylvan.scratch", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sylvan-")
        spark.conf.set("spark.sylvan.scratch", root)
    return root.rstrip("/")


#: Bytes of an Arrow batch that goes to Python; rows of texts of any length are bounded by it and not by their number.
BATCH = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(size).removesuffix("b")) > BATCH:
        spark.conf.set(size, BATCH)


class Workspace:
    """One run's folder below the shared root. `keep` writes a DataFrame there and reads it back."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        bounded_batches(spark)
        atexit.register(self.clear)

    def keep(self, df: DataFrame, label: str, rows: int | None = None, each: int = 500_000) -> DataFrame:
        """`rows`: about how many there are at most; then no more files are written than hold `each` rows, as a small table in a file for
        each shuffle partition costs more to create, list and open than to compute."""
        if rows is not None:
            df = df.coalesce(max(1, -(-rows // each)))
        self._n += 1
        at = f"{self.path}/{self._n:03d}-{label}"
        df.write.mode("overwrite").parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._sylvan_path = at
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Delete a kept table that no later plan reads."""
        at = getattr(df, "_sylvan_path", None)
        if at:
            self._delete(at)

    def clear(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            try:
                self._delete(self.path)
            except Exception:  # the JVM may be gone at exit
                pass

    def _delete(self, at: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
