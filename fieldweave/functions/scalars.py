"""Scalar column functions. All of them are built-in Spark expressions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and prefix length that the published keys and labels use.
LOCATION_SEPARATOR = "--"
LABEL_SEPARATOR = " - "
PREFIX_LENGTH = 3


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_location(description: Column | str) -> Column:
    """Text before the first ``--``; the whole text when there is none. Nothing is trimmed and NULL stays NULL."""
    return F.substring_index(_col(description), LOCATION_SEPARATOR, 1)


def pair_label(first: Column | str, second: Column | str) -> Column:
    """``first - second``. A NULL second part drops the separator, a NULL first part leaves it, two NULLs give ''."""
    return F.concat_ws("", _col(first), F.concat(F.lit(LABEL_SEPARATOR), _col(second)))


def lookup_key(oid: Column | str) -> Column:
    """Key as the form's lookup prints it: one decimal place, so 423 reads ``423.0``."""
    return _col(oid).cast("decimal(16,1)")


def text_code(code: Column | str) -> Column:
    return _col(code).cast("string")


def integer_code(code: Column | str) -> Column:
    """Code as an integer, NULL where the text is not one."""
    return _col(code).try_cast("int")


def flag_oid(prop_key: Column | str) -> Column:
    """Property key out of ``"<oid> - <name>"``."""
    return F.split_part(_col(prop_key), F.lit(LABEL_SEPARATOR), F.lit(1)).cast("int")


def flag_name(prop_key: Column | str) -> Column:
    """Property name out of ``"<oid> - <name>"``."""
    return F.split_part(_col(prop_key), F.lit(LABEL_SEPARATOR), F.lit(2))


def has_prefix(key: Column | str, prefixes: list[str]) -> Column:
    """Whether the first three characters are one of ``prefixes``."""
    return F.substring(_col(key), 1, PREFIX_LENGTH).isin(prefixes)


def list_name(property_oid: Column | str, kind: Column | str) -> Column:
    """Name of a property's list, ``<oid>_<kind>``."""
    return F.concat(_col(property_oid).cast("string"), F.lit("_"), _col(kind))


def global_id(dataset: str, oid: Column | str) -> Column:
    """Identifier derived from the dataset name and row key.

    ``uuid()`` would give a row another identifier each time its task is retried; this one never changes.
    """
    digest = F.md5(F.concat(F.lit(f"{dataset}:"), _col(oid).cast("string")))
    # The 8-4-4-4-12 layout of a GUID, as (start, length) in the 32 hex digits.
    layout = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in layout])


def contains_oid(title: Column | str, oid: Column | str) -> Column:
    """Whether the decimal text of ``oid`` occurs anywhere in ``title``."""
    return F.contains(_col(title), _col(oid).cast("string"))
