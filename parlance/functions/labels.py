"""CASE-style labels on models, devices, languages and numbers."""
from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column

# Fixed value: the pattern that cuts a short tag out of a model name.
MODEL_TAG_PATTERN = r"(gpt-\d(?:\.\d)?)"


def model_family(model="model") -> Column:
    """GPT-3.5, GPT-4 or Other, by prefix of the model name; NULL counts as Other."""
    name = as_column(model)
    return (
        F.when(name.startswith("gpt-3.5"), "GPT-3.5")
        .when(name.startswith("gpt-4"), "GPT-4")
        .otherwise("Other")
    )


def model_tag(model="model") -> Column:
    """``gpt-3.5`` / ``gpt-4`` style tag; an empty string where nothing matches."""
    return F.regexp_extract(as_column(model), MODEL_TAG_PATTERN, 1)


def device_type(user_agent="header.user-agent", separate_unknown: bool = False) -> Column:
    """mobile or desktop by the user agent.

    A missing agent counts as desktop, unless ``separate_unknown`` asks for its own
    class.
    """
    agent = as_column(user_agent)
    label = F.when(F.lower(agent).contains("mobile"), "mobile")
    if separate_unknown:
        label = label.when(agent.isNull(), "unknown")
    return label.otherwise("desktop")


def top_coded(value, ceiling: int) -> Column:
    """Values below the ceiling as they are, everything else (NULL too) as the ceiling."""
    v = as_column(value)
    return F.when(v < ceiling, v).otherwise(F.lit(ceiling))


def indicator(flag) -> Column:
    """1 where the flag is true, 0 where it is false or NULL."""
    return F.when(as_column(flag), 1).otherwise(0)


def kept_or_others(value, keep: list[str], others: str = "others") -> Column:
    """The value itself when listed, else one common bucket."""
    v = as_column(value)
    return F.when(v.isin(keep), v).otherwise(F.lit(others))


def composite_user(ip="hashed_ip", part="header.user-agent") -> Column:
    """Address and header part as one key, NULL when either is NULL."""
    return F.concat(as_column(ip), F.lit("_"), as_column(part))


def bin_index(value, edges: Column, bins: int) -> Column:
    """Index of the half-open bin [edge i, edge i+1) that holds the value.

    ``edges`` is an array column of ``bins + 1`` cut points. The first matching bin
    wins where cut points repeat; a value outside all bins, such as one equal to the
    top edge, goes into the last bin.
    """
    v = as_column(value)
    out = None
    for i in range(bins):
        hit = (v >= F.get(edges, F.lit(i))) & (v < F.get(edges, F.lit(i + 1)))
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return F.when(v.isNotNull(), out.otherwise(bins - 1))


def effect_label(effect) -> Column:
    """Words for an effect size r."""
    r = as_column(effect)
    return (
        F.when(r < 0.1, "Negligible effect")
        .when(r < 0.3, "Small effect")
        .when(r < 0.5, "Medium effect")
        .when(r.isNotNull(), "Large effect")
    )
