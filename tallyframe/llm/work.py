"""Intermediate tables in the folder that the cluster shares.

Long jobs are cut into steps. Each step's result is written as Parquet under ``spark.checkpoint.dir`` and read again, so a
lost executor costs at most the step that runs and no plan grows with the number of steps.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one is set where none is named on a local master, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tallyframe-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: What a batch that goes to or from a Python worker has at most.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def small_batches(spark: SparkSession) -> None:
    """Lets the session's batches for Python workers be no larger than ``BATCH``; each is held several times, outside of the heap.

    No result depends on it.
    """
    for key, most in BATCH.items():
        now = spark.conf.get(key, None)
        if not (now and now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, most)


class Workspace:
    """A folder of its own for one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a step's result and reads it back, with the schema that it had."""
        schema: StructType = df.schema
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Deletes a table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def free_shuffles(self) -> None:
        """Lets Spark's cleaner delete the shuffle files of finished steps now instead of at the next full collection.

        Data frames that no name holds any more can be parts of reference cycles here, which pin their plans in the JVM; and a
        first collection there only finds the jobs' own references gone.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
        self.spark.sparkContext._jvm.System.gc()
