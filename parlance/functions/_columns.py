from pyspark.sql import Column
from pyspark.sql import functions as F


def fields_of(array: str, *names: str) -> Column:
    """array<struct> of only the named fields of an array of structs.

    Taking the fields before an explode or a lambda lets the Parquet scan read just
    these leaves; exploding the whole struct would read every field of each message.
    """
    return F.arrays_zip(*[F.col(f"{array}.`{n}`").alias(n) for n in names])


def as_column(value) -> Column:
    """A Column as it is, a string as a column name."""
    return value if isinstance(value, Column) else F.col(value)
