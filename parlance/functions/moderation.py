"""Expressions over moderation verdicts: flags, category keys, labels per message."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._columns import as_column


def is_harmful(moderation="openai_moderation") -> Column:
    """True if any verdict of the array is flagged.

    NULL for a NULL array, and where no verdict is true but some are NULL; such
    conversations count neither as harmful nor as harmless.
    """
    return F.array_contains(as_column(moderation)["flagged"], True)


def first_flagged_index(moderation="openai_moderation") -> Column:
    """Position, from 0, of the first flagged verdict; NULL if there is none."""
    at = F.array_position(as_column(moderation)["flagged"], True)
    return F.when(is_harmful(moderation), at - 1)


def category_keys(df: DataFrame, moderation: str = "openai_moderation") -> list[str]:
    """Names of the category fields, in schema order."""
    verdict = df.schema[moderation].dataType.elementType
    return verdict["categories"].dataType.fieldNames()


def canonical_key(key: str) -> str:
    """One spelling per category: slashes and hyphens become underscores."""
    return key.replace("/", "_").replace("-", "_")


def key_groups(keys: list[str], canonical: bool) -> dict[str, list[str]]:
    """Output key -> fields counted under it; several fields only when canonical."""
    groups: dict[str, list[str]] = {}
    for key in keys:
        groups.setdefault(canonical_key(key) if canonical else key, []).append(key)
    return groups


def any_key(categories: Column, keys: list[str]) -> Column:
    """True if any of the fields is true."""
    hit = F.coalesce(categories.getField(keys[0]), F.lit(False))
    for key in keys[1:]:
        hit = hit | F.coalesce(categories.getField(key), F.lit(False))
    return hit


def true_keys(categories, keys: list[str], canonical: bool = False) -> Column:
    """Names of the true fields of one categories struct; empty for a NULL struct."""
    c = as_column(categories)
    named = [
        F.when(any_key(c, fields), F.lit(name))
        for name, fields in key_groups(keys, canonical).items()
    ]
    return F.filter(F.array(*named), lambda k: k.isNotNull())


def true_keys_of_all(moderation, keys: list[str], canonical: bool = False) -> Column:
    """Distinct true keys over an array of verdicts, in first-seen order.

    Empty for a NULL or empty array.
    """
    per_verdict = F.transform(
        as_column(moderation), lambda m: true_keys(m["categories"], keys, canonical))
    found = F.array_distinct(F.flatten(per_verdict))
    return F.coalesce(found, F.array().cast(T.ArrayType(T.StringType())))


def zipped_messages(df: DataFrame, fields: list[str], conversation: str = "conversation",
                    moderation: str = "openai_moderation") -> Column:
    """One struct<fields..., categories> per message, categories NULL without a verdict.

    Verdicts beyond the last message are left out. Zipping before the explode keeps
    each exploded row small: it carries its own verdict, not the whole array.
    """
    categories = df.schema[moderation].dataType.elementType["categories"].dataType
    verdicts = F.coalesce(
        F.col(f"{moderation}.categories"), F.array().cast(T.ArrayType(categories)))
    parts = [F.col(f"{conversation}.{f}").alias(f) for f in fields]
    pairs = F.arrays_zip(*parts, verdicts.alias("categories"))
    return F.slice(pairs, 1, F.size(f"{conversation}.{fields[0]}"))
