"""Keys and stored values as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the metric families and the text of an absent value.
VISITS_PREFIX = "visitCounter"
USERS_PREFIX = "hll_dthr"
EXPERIMENTS_PREFIX = "set_experiments_experiments"
VARIANT_PREFIX = "set_var_"
OVERLAP_PREFIX = "overlap_"
NIL = "(nil)"


def counter_key() -> Column:
    """``branch|company|sku``. ``concat`` and not ``concat_ws``, which would shift fields over a null."""
    return F.concat("branch", F.lit("|"), "company", F.lit("|"), "sku")


def set_key(variant: Column | str) -> Column:
    """Key of the user set of a variant."""
    return F.concat(F.lit(VARIANT_PREFIX), variant)


def is_variant_key(key: Column) -> Column:
    """Plain prefix test: in LIKE the underscores would be wildcards."""
    return F.startswith(key, F.lit(VARIANT_PREFIX))


def variant_name(key: Column) -> Column:
    """Variant of a set key."""
    return F.substr(key, F.lit(len(VARIANT_PREFIX) + 1))


def overlap_key(first: Column, second: Column) -> Column:
    """Name of a stored intersection, from the two set keys in sorted order."""
    return F.concat_ws("-", F.lit(OVERLAP_PREFIX), first, second)


def stored_int(value: Column | str) -> Column:
    """Stored counter text as an integer: absent counts as zero, any other non-number is an error."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.nullif(value, F.lit(NIL)).cast("int"), F.lit(0))
