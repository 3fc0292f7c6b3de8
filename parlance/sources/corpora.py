"""Reading conversation corpora and bringing two of them together."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Scan a directory of Parquet files, one row per conversation."""
    return spark.read.parquet(path)


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Scan the (ccountry, sstate) -> timezone, gmt_offset dimension."""
    return spark.read.parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Scan text files into one row per line, column ``value``."""
    return spark.read.text(path)


def combine_corpora(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by name with missing columns as NULL and one identifier column.

    Nested structs may differ between the two sides (one moderation struct has more
    category keys than the other); Spark fills the absent fields with NULL.
    ``conversation_identifier`` is the first identifier that is not NULL.
    """
    identifiers = [
        c for c in ("conversation_hash", "conversation_id")
        if c in first.columns or c in second.columns
    ]
    both = first.unionByName(second, allowMissingColumns=True)
    return both.withColumn(
        "conversation_identifier", F.coalesce(*[F.col(c) for c in identifiers])
    ).drop(*identifiers)


def shared_columns(first: DataFrame, second: DataFrame,
                   without=("openai_moderation", "conversation")) -> DataFrame:
    """Union restricted to the columns both corpora have, nested ones left out."""
    names = [c for c in first.columns if c in second.columns and c not in without]
    return first.select(names).unionByName(second.select(names))


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row frame."""
    return df.agg(F.count("*").alias("rows"))


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Some row of each key; copies are dropped before the shuffle where they meet."""
    return df.dropDuplicates(keys)


def one_per_first_turn(conversations: DataFrame) -> DataFrame:
    """Some conversation of each first turn identifier."""
    first = F.get("conversation.turn_identifier", F.lit(0))
    return conversations.withColumn("_first", first).dropDuplicates(["_first"]).drop("_first")


def rows_not_in(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of the first frame that the second does not have.

    Copies are dropped on both sides before the rows meet.
    """
    return df.distinct().subtract(other.distinct())


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of the columns."""
    return df.select(*columns).distinct()
