"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

A text whose length no other text has cannot have a copy, nor one whose prefix
hash is alone among its length; only what is left reads its whole content.  The
first two steps need to know just which lengths and prefix hashes occur
twice.  They are counted in a fixed number of cells (a shared cell only means
that a text is looked at once more), so the tables that go back to the rows
have a size known beforehand, and no text is moved for them.

Null texts equal the empty text.  Of equal texts the row with the largest id
stays (null ids count as smallest).  Rows that repeat both id and text are all marked
as kept by ``duplicates``; ``deduplicate`` keeps one of them.  An empty table
gives an empty result.  Equality of texts is equality of length and SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import stored

LENGTH_CELLS, PREFIX_CELLS = 1 << 18, 1 << 20
PREFIX_CHARS = 256
LENGTH, CONTENT, CELL, SHARED, KEEP, SIZE = ("__x_length", "__x_content", "__x_cell", "__x_shared", "__x_keep",
                                            "__x_size")


def _shared_cells(df: DataFrame, cell: Column, name: str) -> DataFrame:
    """Cells with two rows or more: at most as many rows as there are cells."""
    return stored(df.groupBy(cell.alias(CELL)).agg(F.count(F.lit(1)).alias(SIZE)).filter(F.col(SIZE) > 1).select(
        CELL, F.lit(True).alias(SHARED)), name)


def _mark(df: DataFrame, cell: Column, cells: DataFrame) -> DataFrame:
    return df.withColumn(CELL, cell).join(F.broadcast(cells), CELL, "left").drop(CELL)


def with_content(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with its text's length and, for texts that may have a copy, the full hash (else null)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.withColumn(LENGTH, F.octet_length(text).cast("long"))
    by_length = F.pmod(F.col(LENGTH), F.lit(LENGTH_CELLS))
    same_length = _mark(rows, by_length, _shared_cells(rows.select(LENGTH), by_length, "lengths"))
    survivors = same_length.filter(F.col(SHARED).isNotNull())
    by_prefix = F.pmod(F.xxhash64(F.col(LENGTH), F.substring(text, 1, PREFIX_CHARS)), F.lit(PREFIX_CELLS))
    prefixes = _shared_cells(survivors, by_prefix, "prefixes")
    looked_at = _mark(same_length.withColumnRenamed(SHARED, CONTENT), F.when(F.col(CONTENT), by_prefix), prefixes)
    return looked_at.withColumn(CONTENT, F.when(F.col(SHARED), F.sha2(text, 256))).drop(SHARED)


def _groups(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.groupBy(LENGTH, CONTENT).agg(F.max(id_col).alias(KEEP), F.count(F.lit(1)).alias(SIZE))


def duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``df``: ``id_col``, the ``carry`` columns, keep_id, group_size, kept."""
    rows = stored(with_content(df, text_col).select(id_col, LENGTH, CONTENT, *carry), "content")
    maybe = rows.filter(F.col(CONTENT).isNotNull())
    found = maybe.join(_groups(maybe, id_col), [LENGTH, CONTENT])
    alone = rows.filter(F.col(CONTENT).isNull()).withColumns({KEEP: F.col(id_col), SIZE: F.lit(1).cast("long")})
    return found.unionByName(alone).select(
        id_col, *carry, F.col(KEEP).alias("keep_id"), F.col(SIZE).alias("group_size"),
        F.col(id_col).eqNullSafe(F.col(KEEP)).alias("kept"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; texts without a possible copy are not shuffled."""
    rows = with_content(df, text_col)
    maybe = rows.filter(F.col(CONTENT).isNotNull())
    groups = _groups(maybe, id_col)
    kept = maybe.join(groups.select(F.col(LENGTH).alias("__x_l"), F.col(CONTENT).alias("__x_c"), KEEP),
                      (F.col(LENGTH) == F.col("__x_l")) & (F.col(CONTENT) == F.col("__x_c"))
                      & F.col(id_col).eqNullSafe(F.col(KEEP))).dropDuplicates([LENGTH, CONTENT])
    alone = rows.filter(F.col(CONTENT).isNull())
    return kept.select(*df.columns).unionByName(alone.select(*df.columns))
