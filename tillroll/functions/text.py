"""Text standardization: trimming, null tokens, title case, canonical labels, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cells a CSV reader with pandas defaults takes as missing.
READER_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# What still counts as missing once a text cell is trimmed.
TEXT_NULL_TOKENS = ["", "None", "nan"]

# The characters Python's str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Category labels that mean another one.
CANONICAL_CATEGORY = {
    "Electronic": "Electronics",
    "Beauty & Personal Care": "Beauty",
}

DEFAULT_CUSTOMER_NAME = "Unknown Customer"
DEFAULT_REGION = "Unspecified"

# Letters that have case. Title case starts anew wherever a run of these starts.
# The commonest come first, which the matcher tries in this order.
_CASED = r"a-zA-Z\p{IsLowercase}\p{IsUppercase}\p{Lt}"
# U+FDD0 is a Unicode noncharacter, reserved for internal marks and never part of interchanged text.
_WORD_MARK = "\ufdd0 "


def null_reader_tokens(c: Column) -> Column:
    """Exact match before any trimming, so a padded token stays text."""
    return F.when(~c.isin(READER_NULL_TOKENS), c)


def strip(c: Column) -> Column:
    """Trim every Unicode whitespace character, not only spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_text_tokens(c: Column) -> Column:
    """For cells already trimmed."""
    return F.when(~c.isin(TEXT_NULL_TOKENS), c)


def clean_text(c: Column) -> Column:
    """S2, C1 and C2 in the order the feed needs them."""
    return null_text_tokens(strip(null_reader_tokens(c)))


def title_case(c: Column) -> Column:
    """Upper-case after every character that has no case ("usb-c" -> "Usb-C", "500ml" -> "500Ml").

    ``initcap`` starts a word only after a space, so a marked space goes in after any other character
    that a word starts behind, and comes out again. All three steps are generated code.
    """
    marked = F.regexp_replace(c, f"([^{_CASED} ])([{_CASED}])", f"$1{_WORD_MARK}$2")
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def canonical_category(c: Column) -> Column:
    """C4: for labels already in title case."""
    first, *rest = CANONICAL_CATEGORY.items()
    label = F.when(c == first[0], first[1])
    for written, meant in rest:
        label = label.when(c == written, meant)
    return label.otherwise(c)


def impute(c: Column, default: str) -> Column:
    """C5."""
    return F.coalesce(c, F.lit(default))
