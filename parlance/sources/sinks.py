"""Writing results."""
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import settled

# Rows of a table that may be merged into one file.
ONE_FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` with CSV files that carry a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace ``path`` with Parquet files.

    ``single_file`` is for small report tables, of at most ``ONE_FILE_ROWS`` rows: the rows
    are computed and written by all tasks beside ``path`` first, so that only the last merge
    goes through one task, and a larger table is refused instead of passed through it.
    """
    if not single_file:
        df.write.mode("overwrite").parquet(path)
        return
    staged = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    rows = df.sparkSession.read.schema(df.schema).parquet(staged)
    n = rows.count()
    if n > ONE_FILE_ROWS:
        raise ValueError(f"{n} rows are too many for a single file; they are in {staged}")
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, path: str, by: list[str], rows_per_file: int = 1_000_000) -> None:
    """Write Parquet folders per value of ``by``, replacing those that ``df`` has rows for.

    Folders of other values stay, so a rerun for a day replaces that day only. The rows are
    counted per value first: a value gets one file per ``rows_per_file`` rows, written by as
    many tasks, so a value with a large part of all rows is split and small ones do not
    scatter into a file per task. Which file a row goes to depends on its content and on its
    place in the stored rows, so equal rows are spread as well. NULL is a value of its own.
    """
    if not by:
        raise ValueError("name the columns to partition by")
    spark, df = df.sparkSession, settled(df)
    counts = df.groupBy(*by).agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_files"))
    large = counts.filter("_files > 1").select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], "_files")
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(large), same, "left")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c not in by], "_row"), F.coalesce("_files", F.lit(1)))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    (
        dealt.withColumn("_salt", salt).repartition(tasks, *by, "_salt").select(*df.columns)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    )
