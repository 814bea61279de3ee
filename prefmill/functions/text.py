"""String expressions with Python's notion of white space, and Unicode folding."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

#: Java class equal to Python's white space.
SPACE = r"[\s\x1c-\x1f]"
#: ASCII punctuation, as in Python's string.punctuation (fixed value).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Runs of either, in one pass.
SPACE_OR_PUNCTUATION = rf"(?U)[\s\x1c-\x1f{re.escape(PUNCTUATION)}]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python's str.strip(); Spark's trim removes spaces only."""
    return F.regexp_replace(col(c), rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def collapse(c: Column | str) -> Column:
    """Runs of white space become one space, ends are stripped."""
    return F.trim(F.regexp_replace(col(c), rf"(?U){SPACE}+", " "))


def blank(c: Column | str) -> Column:
    """True for null and for white space only."""
    return F.coalesce(strip(c) == "", F.lit(True))


@pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(c: Column | str) -> Column:
    """NFKC normal form; ASCII text stays in the JVM, only the rest crosses to Python."""
    c = col(c)
    ascii_only = c.rlike(r"\A\p{ASCII}*\z")
    return F.when(ascii_only, c).otherwise(_nfkc(F.when(~ascii_only, c)))


@pandas_udf(ArrayType(StringType()))
def _nfkc_each(s: pd.Series) -> pd.Series:
    return s.map(lambda a: [None if x is None else unicodedata.normalize("NFKC", x) for x in a], na_action="ignore")


def nfkc_each(c: Column | str) -> Column:
    """NFKC normal form of each text of an array; arrays of ASCII texts stay in the JVM."""
    c = col(c)
    ascii_only = F.forall(c, lambda x: F.coalesce(x.rlike(r"\A\p{ASCII}*\z"), F.lit(True)))
    return F.when(ascii_only, c).otherwise(_nfkc_each(F.when(~ascii_only, c)))


def dedup_key(c: Column | str, unicode: bool = True) -> Column:
    """Key under which candidate answers are the same: NFKC, white space collapsed, case kept."""
    return collapse(nfkc(c) if unicode else c)


def same_text(c: Column | str) -> Column:
    """Digest of ``dedup_key``: groups by it shuffle 64 characters a row, however long the texts are."""
    return F.sha2(dedup_key(c), 256)


def template_key(c: Column | str, strip_numbers: bool = False, unicode: bool = True) -> Column:
    """Key under which texts share a template: folded, without punctuation and, if asked, digits."""
    c = F.lower(nfkc(c) if unicode else col(c))
    if strip_numbers:
        c = F.regexp_replace(c, r"(?U)\d+", "")
    return F.trim(F.regexp_replace(c, SPACE_OR_PUNCTUATION, " "))


def base_category(c: Column | str) -> Column:
    """A category without a trailing remark in brackets."""
    return F.regexp_replace(col(c), r"\(.*\)$", "")
