"""Computing an intermediate table once."""
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without one gets a temporary folder, a cluster is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="settled-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and continue from the stored result.

    For aggregates that several later steps read: value counts, user profiles. The rows
    are written as Parquet to the shared folder, so later steps read only the columns they
    use and a lost executor costs nothing but reading them again. Whoever owns the folder
    clears it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
