"""The folder for intermediate files that all executors can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


DEFAULT_WAREHOUSE = "/spark-warehouse"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the warehouse folder where that is not set.

    A ``file:`` folder may be seen by one machine only. Outside a local session it is taken
    where the session names it, as the checkpoint folder or as a warehouse other than Spark's
    default in the working folder of the driver: a standalone or Kubernetes cluster comes with
    no store of its own, and a folder mounted on all its machines is a ``file:`` folder too. A
    YARN cluster has a store, so there each one is refused.
    """
    context = spark.sparkContext
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    base = base.rstrip("/")
    hadoop = context._jvm.org.apache.hadoop.fs.Path(base)
    scheme = hadoop.getFileSystem(context._jsc.hadoopConfiguration()).getScheme()
    unnamed = context.master.startswith("yarn") or base.endswith(DEFAULT_WAREHOUSE)
    if scheme == "file" and unnamed and not context.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder all executors share, not {base}")
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder. The caller owns what is written there.

    Query results are read from such files after the call has returned, so
    nothing here can remove them: clear the shared folder when the results of a
    session are no longer needed.
    """
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(table: DataFrame, label: str) -> DataFrame:
    """``table`` written to a new Parquet folder and read from there.

    The rows are computed once and no longer depend on any executor.
    """
    spark = table.sparkSession
    path = scratch_path(spark, label)
    table.write.mode("errorifexists").parquet(path)
    return spark.read.schema(table.schema).parquet(path)
