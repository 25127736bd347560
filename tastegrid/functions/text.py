"""Name and tag normalisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def squeeze(c: Column) -> Column:
    """Unicode white space to single blanks, none at the ends (``trim`` alone knows only the blank)."""
    return F.trim(F.regexp_replace(c, C.WHITESPACE, " "))


def normalize_text(c: Column) -> Column:
    """Lower-case, squeeze, and only then drop what is not printable ASCII.

    In that order: blanks around a dropped character both stay.
    """
    return F.regexp_replace(squeeze(F.lower(c)), C.NOT_PRINTABLE_ASCII, "")


def normalize_composer(c: Column) -> Column:
    """``"Last, First"`` becomes ``"first last"``; only the first comma counts."""
    name = normalize_text(c)
    parts = F.split(name, ",", 2)
    flipped = F.concat_ws(" ", parts.getItem(1), parts.getItem(0))
    return F.when(F.contains(name, F.lit(",")), F.trim(F.regexp_replace(flipped, " +", " "))).otherwise(name)


def normalize_tag(c: Column) -> Column:
    """Lower-case words of ``a-z 0-9 + -`` with single blanks; null becomes the empty text.

    ``&`` reads "and"; brackets, quotes, separators and all else part words, so one pattern does.
    """
    words = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(words, C.NOT_IN_TAG, " "))


def squeeze_ends(c: Column) -> Column:
    """Remove Unicode white space at both ends, inner runs stay."""
    return F.regexp_replace(c, f"^{C.WHITESPACE}|{C.WHITESPACE}$", "")


def cache_key(c: Column) -> Column:
    """Lookup key of an artist name in the fallback tag table."""
    return F.lower(squeeze_ends(c))


def token_of(word: Column) -> Column:
    """The term in a blank-free word: from its first letter or digit to its last."""
    return F.btrim(word, F.lit(C.TOKEN_EDGES))


def tokens(c: Column) -> Column:
    """Terms of a text in the form :func:`normalize_tag` gives; words without letter or digit have none."""
    return F.filter(F.transform(F.split(c, " "), token_of), lambda t: t != "")


def distinct_in_order(names: Column) -> Column:
    """Drop blanks and repeats from a list, first occurrence stays."""
    return F.array_distinct(F.filter(names, lambda x: x.isNotNull() & (x != "")))


def feature_names(terms: list[str]) -> dict[str, str]:
    """Column name of each term; two terms that would share a name are an error."""
    names = {t: "tfidf_" + t.replace("-", "_").replace("+", "plus") for t in terms}
    if len(set(names.values())) < len(names):
        raise ValueError("terms collide as column names: " + ", ".join(sorted(names)))
    return names
