"""Identity and privacy hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hireflow.functions.text import strip


def stable_hash(*cols: Column) -> Column:
    """MD5 over the texts joined by ``||``; NULL counts as empty text, so positions stay apart."""
    return F.md5(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def batch_key(source: Column, file_name: Column, checksum: Column) -> Column:
    """Identity of a batch: the same bytes under the same name are the same batch."""
    return F.md5(F.concat_ws("|", source, file_name, checksum))


def email_hash(col: Column) -> Column:
    """NULL stays NULL, unlike a hash of the word for a missing value."""
    return F.md5(F.lower(strip(col)))


def phone_hash(col: Column) -> Column:
    return F.md5(strip(col))


def salted_hash(col: Column, salt: str) -> Column:
    """Token for shared views; the salt comes from the caller's secret store."""
    return F.sha2(F.concat(F.lit(salt), F.lower(strip(col))), 256)
