"""Blank tests, id and e-mail patterns, small value rewrites.

Two notions of "no key" exist and must not be mixed: comparing and resolving treat only null and
the empty string as missing (:func:`has_key`), loading also treats whitespace as missing
(:func:`is_blank`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space, id shape and e-mail shape that results have to agree on.
WHITE_SPACE = ("\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000\ufeff")
ID_PATTERN = r"\A[a-zA-Z0-9]{15}([a-zA-Z0-9]{3})?\z"
EMAIL_PATTERN = r"\A[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}\z"
MASK_SUFFIX = ".invalid"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Strip white space of every kind; without a list of characters ``trim`` removes spaces only."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITE_SPACE))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(trimmed(c), F.lit("")) == ""


def not_blank(c: Column | str) -> Column:
    return ~is_blank(c)


def has_key(c: Column | str, df: DataFrame | None = None) -> Column:
    """True for a usable key: neither null nor empty, white space allowed.

    With ``df`` the column's type is known and only text is tested for emptiness.
    """
    if df is not None and not isinstance(df.schema[c].dataType, T.StringType):
        return F.col(c).isNotNull()
    c = _col(c)
    return c.isNotNull() & (c.cast("string") != "")


def looks_like_id(c: Column | str, pattern: str = ID_PATTERN) -> Column:
    return F.coalesce(_col(c).cast("string").rlike(pattern), F.lit(False))


def is_email(c: Column | str) -> Column:
    """Anchored test of the trimmed value."""
    return F.coalesce(trimmed(c).rlike(EMAIL_PATTERN), F.lit(False))


def needs_mask(c: Column | str) -> Column:
    return is_email(c) & ~trimmed(c).endswith(MASK_SUFFIX)


def mask_email(c: Column | str) -> Column:
    """Append ``.invalid`` to an address that does not have it; leave other values alone."""
    return F.when(needs_mask(c), F.concat(trimmed(c), F.lit(MASK_SUFFIX))).otherwise(_col(c))


def display_name(candidates: Sequence[Column | str]) -> Column:
    return F.coalesce(*[_col(c).cast("string") for c in candidates]) if candidates \
        else F.lit(None).cast("string")


def backfill_key(key: Column | str, id_col: Column | str, prefix: str) -> Column:
    """``prefix-<id>`` where the key is null; an id of the 15 or 18 character shape counts by its first 15."""
    text = _col(id_col).cast("string")
    return F.coalesce(_col(key).cast("string"),
                      F.concat(F.lit(prefix + "-"), F.when(looks_like_id(text), F.substring(text, 1, 15)).otherwise(text)))


def csv_boolean(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c, "TRUE").when(~c, "FALSE")
