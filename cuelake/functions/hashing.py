"""Content hashes. The canonical text form is ours and stays the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuelake.functions.base import C, as_col

__all__ = ["fingerprint", "hash_slices", "row_hash", "set_hash", "slices_hash"]

NULL_MARK = "\\N"
FIELD_MARK = "\u001f"


def fingerprint(**fields: C) -> Column:
    """sha256 over `name=value` pairs in name order; NULL is written as a mark."""
    parts = [
        F.concat(F.lit(name + "="), F.coalesce(as_col(fields[name]).cast("string"), F.lit(NULL_MARK)))
        for name in sorted(fields)
    ]
    return F.sha2(F.concat_ws(FIELD_MARK, *parts), 256)


def row_hash(*fields: C) -> Column:
    """sha256 over the fields in the order given."""
    parts = [F.coalesce(as_col(field).cast("string"), F.lit(NULL_MARK)) for field in fields]
    return F.sha2(F.concat_ws(FIELD_MARK, *parts), 256)


def hash_slices(row: C) -> list[Column]:
    """Four slices of a row hash as numbers; their sums stand for a set of rows."""
    digest = as_col(row)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16, 31, 46)]


def slices_hash(count: C, sums: list[Column]) -> Column:
    """The hash of a set from its row count and its four slice sums."""
    return F.sha2(F.concat_ws(":", as_col(count).cast("string"), *[F.coalesce(value.cast("string"), F.lit("0")) for value in sums]), 256)


def set_hash(row: C) -> Column:
    """Aggregate: one hash for a whole set of rows, from sums of four slices of each row hash.

    Sums combine on the map side, so no group is ever collected to be hashed in order; the
    row hashes carry times and text, which fix the order. Sums of a part of a scan are differences.
    """
    return slices_hash(F.count(as_col(row)), [F.sum(value) for value in hash_slices(row)])
