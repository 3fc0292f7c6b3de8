"""Intermediate tables in the folder that all executors share."""
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the files.

    Cuts lineage: a lost executor costs reading the files again, nothing is recomputed.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """Broadcast ``df`` if it has few rows, all of them short."""
    return F.broadcast(df) if df.count() <= rows else df
