"""Which properties to refresh, and which forms belong to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.functions import scalars as X
from fieldweave.operators.lists import requested

# Characters of the longest whole number of each type, sign included.
DIGITS = {"byte": 4, "tinyint": 4, "short": 6, "smallint": 6, "int": 11, "bigint": 20}


def changed_properties(flags: DataFrame) -> DataFrame:
    """``property_oid, property_name`` of the selected properties."""
    return flags.filter("selected").select(
        X.flag_oid("prop_key").alias("property_oid"), X.flag_name("prop_key").alias("property_name")
    )


def reset_flags(flags: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Flags set to false, except for keys that begin with one of ``ignore``."""
    kept = F.when(X.has_prefix("prop_key", ignore), F.col("selected")).otherwise(F.lit(False)) if ignore else F.lit(False)
    return flags.withColumn("selected", kept)


def match_forms(props: DataFrame, forms: DataFrame, exact: bool = False) -> DataFrame:
    """``property_oid, form_id`` of the forms whose title contains the property key.

    Property 42 is also found in a title with 423; ``exact`` takes whole numbers only. Each title yields the few
    numbers written in it, which then meet the keys in an equi-join, so titles are never compared with every property.
    """
    # Fixed value: str() of a whole number, so neither a leading zero nor a second sign.
    number = r"^(0|-?[1-9][0-9]*)$"
    wanted = requested(props)
    digits = DIGITS[wanted.schema["property_oid"].dataType.simpleString()]
    runs = F.regexp_extract_all("title", F.lit(r"(-?[0-9]+)"), 1)
    if exact:
        numbers = F.transform(runs, lambda run: F.regexp_replace(run, r"^-?0+(?=[0-9])", ""))
    else:
        def cut(run):
            lengths = F.sequence(F.lit(1), F.least(F.length(run), F.lit(digits)))
            starts = F.sequence(F.lit(1), F.length(run))
            return F.flatten(F.transform(starts, lambda s: F.transform(lengths, lambda n: F.substring(run, s, n))))

        numbers = F.flatten(F.transform(runs, cut))
    numbers = F.filter(F.array_distinct(numbers), lambda text: text.rlike(number))
    found = forms.select("form_id", F.explode(numbers).alias("text"))
    keys = wanted.withColumn("text", F.col("property_oid").cast("string"))
    return found.join(keys, "text").select("property_oid", "form_id")


def missing_forms(props: DataFrame, matches: DataFrame) -> DataFrame:
    """``property_oid`` of the requested properties without a form."""
    return requested(props).join(matches.select("property_oid").distinct(), "property_oid", "left_anti")
