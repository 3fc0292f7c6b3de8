"""Word counts."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Occurrences of each word, words being what single spaces separate.

    Counting starts on the map side, so a frequent word costs one row per task.
    """
    return (
        lines.select(F.explode(F.split(text, " ")).alias("word"))
        .groupBy("word").count()
    )
