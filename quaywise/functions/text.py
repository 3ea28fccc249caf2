"""Text keys used to match names written in different ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Compares letters without case and accents, composed or not, in every alphabet.
COLLATION = "UNICODE_CI_AI"
#: Letters that the collation keeps apart from the letters they are written with. Fixed values.
LETTERS = (("œ", "oe"), ("æ", "ae"), ("ø", "o"), ("ł", "l"), ("đ", "d"))


def station_key(name: Column) -> Column:
    """Lower case with hyphens and apostrophes read as spaces."""
    return F.lower(F.translate(name, "-'", "  "))


def line_key(name: Column) -> Column:
    """Lower case without spaces."""
    return F.replace(F.lower(name), F.lit(" "), F.lit(""))


def folded(name: Column) -> Column:
    """The name as a key that is equal without case and accents; joins hash it as any other."""
    key = F.lower(name)
    for letter, plain in LETTERS:
        key = F.replace(key, F.lit(letter), F.lit(plain))
    return F.collate(key, COLLATION)
