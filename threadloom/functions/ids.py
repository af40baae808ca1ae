"""Identifier normalisation: case and surrounding white space carry no meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with Unicode property White_Space, and the
# four information separators that text tools also strip.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def stripped(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE_SPACE))


def identifier(col: Column) -> Column:
    """Lower case without outer white space; null when nothing is left."""
    x = F.lower(stripped(col))
    return F.when(x != "", x)


def parent_identifier(col: Column) -> Column:
    """As ``identifier``; ``0`` also stands for no parent."""
    x = F.lower(stripped(col))
    return F.when((x != "") & (x != "0"), x)
