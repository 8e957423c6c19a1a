"""Text cleaning. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean "no vendor / no product".
NOT_AVAILABLE = ["n/a", "*** n/a ***", ""]
# The characters of Unicode white space.
BLANKS = ("\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def normalize_id(c: Column, trim: bool = True) -> Column:
    """Upper-case ASCII id."""
    return F.regexp_replace(F.upper(F.trim(c) if trim else c), r"[^\x00-\x7F]", "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def clean_name(c: Column) -> Column:
    """Display name: no backslashes, blanks for underscores, words capitalised."""
    return F.initcap(F.trim(F.translate(c, "_\\", " ")))


def compact_ts(c: Column) -> Column:
    """Timestamp text without trailing fractional zeros, marked UTC; NULL stays NULL."""
    text = c.cast("string")
    short = F.when(F.contains(text, F.lit(".")),
                   F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
    return F.concat(short, F.lit(" UTC"))


def compact_ts_or_blank(c: Column) -> Column:
    return F.coalesce(compact_ts(c), F.lit(""))


def safe_name(c: Column) -> Column:
    """File-name part that Spark will not treat as hidden."""
    named = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_"), r"^[._-]+", "")
    return F.when(named == "", "file").otherwise(named)


def safe_path(c: Column) -> Column:
    """``safe_name`` applied to each part between slashes."""
    return F.array_join(F.transform(F.split(c, "/"), safe_name), "/")


def message_id(*parts: Column) -> Column:
    """Identity of a message: a digest of all its parts, whatever characters they hold."""
    return F.sha2(F.to_json(F.array(*[F.coalesce(p, F.lit("")) for p in parts])), 256)


def message_label(vendor: Column, product: Column) -> Column:
    """Entry name within a queue batch, at most 80 characters; not an identity."""
    return F.substring(F.regexp_replace(F.concat_ws("_", vendor, product), r"[^A-Za-z0-9_-]", "_"),
                       1, 80)


def clean_key(c: Column) -> Column:
    """Trimmed lower-case map key; NULL when it carries no name."""
    key = F.lower(F.btrim(c, F.lit(BLANKS)))
    return F.when(~key.isin(NOT_AVAILABLE), key)


def cpe_part(c: Column, index: int) -> Column:
    """Part of a colon-separated platform name; NULL when it is not there."""
    return F.get(F.split(c, ":"), index)


def iso_timestamp(c: Column) -> Column:
    """Feed timestamps are ISO text; NULL when they cannot be read."""
    return F.try_to_timestamp(c)


def pull_timestamp(c: Column) -> Column:
    """Pull times carry six fractional digits and an offset, or none at all."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
                      F.try_to_timestamp(c))
