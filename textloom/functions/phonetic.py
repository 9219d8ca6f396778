"""Sound keys as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Letter groups of the refined Soundex code.
REFINED_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
REFINED_CODES = "01360240043788015936020505"


def soundex(col: Column) -> Column:
    return F.soundex(col)


def refined_soundex(col: Column) -> Column:
    """First letter, then the code of every letter with equal neighbours merged."""
    letters = F.regexp_replace(F.upper(col), "[^A-Z]", "")
    codes = F.translate(letters, REFINED_LETTERS, REFINED_CODES)
    for digit in "0123456789":
        codes = F.regexp_replace(codes, digit + "+", digit)
    return F.when(letters != "", F.concat(F.substring(letters, 1, 1), codes)).otherwise(col)


ENCODERS = {"soundex": soundex, "refined_soundex": refined_soundex}
