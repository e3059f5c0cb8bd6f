"""Fingerprints, surrogate keys and row ids."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the hash, so they may not change.
SEPARATOR = "||"
NULL_TEXT = "NA"
HASH_BITS = 256


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns' text; NULL counts as the text ``NA``.

    So NULL and a literal "NA" look alike, which change detection accepts.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), HASH_BITS)


def patient_key(column: str = "patient_id") -> Column:
    """One key per patient (not per version); NULL for a NULL id."""
    return F.sha2(F.col(column), HASH_BITS)


def department_key(columns: Sequence[str] = ("department", "hospital_id")) -> Column:
    """Key of a department member.

    A bare ``concat_ws`` would drop NULL parts and give ("Card", NULL) the key of
    ("Card"); here NULL keeps its place.
    """
    return fingerprint(columns)


def row_id(columns: Sequence[str]) -> Column:
    """64-bit id of a fact.

    ``xxhash64`` skips NULLs and has 64 bits only, so nothing is matched on it
    alone: upserts compare the natural key as well.
    """
    return F.xxhash64(*columns)


def bucket_column(buckets: int) -> str:
    """Name of a partition column of so many hash buckets."""
    return f"bucket_of_{buckets}"


def hash_bucket(column: str, buckets: int) -> Column:
    """Bucket of a key, from 0; the rows of a table keep theirs as long as its number of buckets stays."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int").alias(bucket_column(buckets))
