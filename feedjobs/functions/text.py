"""Text functions over columns."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"^ | $", "")


def strip(text: Column) -> Column:
    """No white space of any kind at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


#: Beside ASCII, characters each of which is its own NFKC form, and none of which joins the one before it.
OWN_FORM = r"\u00A1-\u00A7\u00A9\u00AB-\u00AE\u00B0\u00B1\u00B6\u00B7\u00BB\u00BF-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u0400-\u045F\u2012-\u2016\u2018-\u2023\u20AC\u3001-\u3029\u3041-\u3096\u30A1-\u30FA\u30FC\u4E00-\u9FFF"


def normalize_title(title: Column, *, compose: bool = True) -> Column:
    """NFKC, lower case, everything but letters, digits and ``_`` a blank. ``compose=False`` skips NFKC, the one step in Python.

    Only texts with a character that is neither ASCII nor in OWN_FORM go to Python. White space is among what becomes a blank, and a run becomes one, so one pass does.
    """
    text = F.coalesce(nfkc(F.when(title.rlike(rf"[\x80-\x{{10FFFF}}&&[^{OWN_FORM}]]"), title)), title) if compose else title
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "))


def item_id(canonical_url: Column) -> Column:
    return F.sha1(canonical_url)


def title_hash(title: Column, *, compose: bool = True) -> Column:
    return F.sha1(normalize_title(title, compose=compose))


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


def excerpt(text: Column, size: int = 200) -> Column:
    return F.substring(squeeze(strip_tags(text)), 1, size)


def shorten(text: Column, size: int) -> Column:
    """Cut to ``size`` characters and mark the cut."""
    return F.when(F.char_length(text) > size, F.concat(F.substring(text, 1, size), F.lit("…"))).otherwise(text)


def clean_comment(text: Column, *, unescape: bool = True) -> Column:
    plain = squeeze(strip_tags(text))
    return shorten(html_unescape(plain) if unescape else plain, 300)


def redact(text: Column) -> Column:
    """Hide the values of query keys that hold secrets."""
    return F.regexp_replace(text, r"""(?i)([?&](token|apikey|api_key|access_token|auth|key)=)[^&\s'"]+""", "$1***")


def one_line(text: Column) -> Column:
    return strip(F.replace(text, F.lit("\n"), F.lit(" ")))


def parse_count(text: Column) -> Column:
    """``1,234`` or ``1.2k``; what is neither is 0."""
    bare = F.replace(strip(text), F.lit(","), F.lit(""))
    thousands = F.regexp_replace(bare, "k$", "").try_cast("decimal(18,4)") * 1000
    return F.coalesce(F.when(bare.endswith("k"), thousands.try_cast("bigint")).otherwise(bare.try_cast("bigint")), F.lit(0).cast("bigint"))


def shows_author(author: Column, handle: Column) -> Column:
    """An author is worth showing if it says more than the handle."""
    return (F.coalesce(author, F.lit("")) != "") & (author != F.ltrim(F.coalesce(handle, F.lit("")), F.lit("@")))


def error_name(error: Column) -> Column:
    return F.regexp_extract(error, r"^([A-Za-z_][A-Za-z0-9_.]*):", 1)


def error_status(error: Column) -> Column:
    return F.regexp_extract(error, r"\b([1-5]\d\d)\b", 1).try_cast("int")


def matches_any(text: Column, keywords: list[str]) -> Column:
    """Any keyword as a substring, whatever the case; no keywords match everything."""
    if not keywords:
        return F.lit(True)
    low = F.lower(text)
    return F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(low, k))
