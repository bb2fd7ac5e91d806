"""Change hash of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator and algorithm decide whether hashes written by
# other writers of the same tables still compare equal.
SEPARATOR = "||"
SHA_BITS = 256

# Stands for NULL, so that (NULL, 'a') and ('a', NULL) differ.
NULL_TOKEN = "\u0001"


def hash_diff(columns: Sequence[str | Column]) -> Column:
    """SHA-256 hex digest over the text of ``columns``, never NULL."""
    texts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        texts.append(F.coalesce(text, F.lit(NULL_TOKEN)))
    return F.sha2(F.concat_ws(SEPARATOR, *texts), SHA_BITS)
