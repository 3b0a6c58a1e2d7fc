"""Business keys and hash keys.

History keys skip NULL parts together with their separator; snapshot keys keep the
separator and read a NULL part as empty text. The two are not interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def business_key_h(*parts: Column | str) -> Column:
    """`a_b_c`, NULL parts left out; all NULL gives the empty string."""
    return F.concat_ws(SEPARATOR, *[_col(p).cast("string") for p in parts])


def business_key_s(*parts: Column | str) -> Column:
    """`a_b_c` with a NULL part as empty text, so the number of separators is fixed."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(SEPARATOR))
        pieces.append(F.coalesce(_col(p).cast("string"), F.lit("")))
    return F.concat(*pieces)


def hash_key(*parts: Column | str) -> Column:
    """md5 hex digest of the history business key."""
    return F.md5(business_key_h(*parts))
