"""Country to continent."""
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Country names of the corpora whose continent is set by hand.
CONTINENT_OVERRIDES = {
    "United States": "North America",
    "Russia": "Europe",
    "The Netherlands": "Europe",
    "DR Congo": "Africa",
    "Kosovo": "Europe",
    "Bonaire, Sint Eustatius, and Saba": "South America",
    "Congo Republic": "Africa",
    "St Vincent and Grenadines": "South America",
    "Timor-Leste": "Asia",
    "Sint Maarten": "South America",
}


def with_continent(df: DataFrame, continents: DataFrame) -> DataFrame:
    """Add ``continent`` from a (country, continent) table; NULL where unknown.

    The overrides win over the table. Call it on data already counted per country:
    the join then moves a few hundred rows whatever the size of the log.
    """
    by_hand = F.create_map(*[F.lit(x) for x in chain(*CONTINENT_OVERRIDES.items())])
    table = continents.select("country", F.col("continent").alias("listed_continent"))
    return (
        df.join(table, "country", "left")
        .withColumn("continent", F.coalesce(
            F.try_element_at(by_hand, F.col("country")), F.col("listed_continent")))
        .drop("listed_continent")
    )
