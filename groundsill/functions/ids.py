"""Keys derived from content, so that a re-run or a retry yields the same ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def chunk_key(knowledge_id: Column, chunk_index: Column, text: Column) -> Column:
    """Stable chunk id from its parent, position and content."""
    return F.sha2(F.concat_ws("|", knowledge_id, chunk_index.cast("string"), text_hash(text)), 256)


def row_key(prefix: str, *parts: Column) -> Column:
    """Stable id for rows whose source has no natural key."""
    return F.sha2(F.concat_ws("|", F.lit(prefix), *parts), 256)
