"""A place on the hash line for every document, the same in Spark and in plain SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 60


def place(id_col: str, text_col: str) -> Column:
    """60 bits of a digest of id and text, as a long from 0.

    Rows alike in both share a place. The text counts, so that rows without an id spread too.
    """
    key = F.concat_ws(
        "/", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit("")))
    )
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


#: The same for DuckDB, over columns doc_id and text.
PLACE_SQL = (
    "cast('0x' || substr(md5(concat(coalesce(cast(doc_id as varchar), ''), '/', "
    "md5(coalesce(text, '')))), 1, 15) as bigint)"
)
