"""Normalisation and token functions on columns; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C

POSTAL = r"\b\d{5,6}\b"


def _words(*values: str) -> Column:
    return F.array(*map(F.lit, values))


def _split(c: Column) -> Column:
    """Words between spaces; none for an empty string."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def norm_text(c: Column, amp_as_and: bool = True) -> Column:
    """Lower case, "&" as "and", runs of other than a-z and 0-9 as one space, trimmed; null is empty."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.trim(F.regexp_replace(F.replace(low, F.lit("&"), F.lit(" and ")) if amp_as_and else low, "[^a-z0-9]+", " "))


def norm_name(c: Column, legal_forms=C.LEGAL_FORMS, amp_as_and: bool = True) -> Column:
    """norm_text without legal forms."""
    return F.array_join(F.filter(_split(norm_text(c, amp_as_and)), lambda w: ~w.isin(*legal_forms)), " ")


def norm_address(c: Column) -> Column:
    """norm_text with abbreviations written out, token by token."""
    long = F.create_map(*(F.lit(x) for pair in C.ABBREVIATIONS.items() for x in pair))
    return F.array_join(F.transform(_split(norm_text(c)), lambda w: F.coalesce(F.element_at(long, w), w)), " ")


def norm_address_sequential(c: Column) -> Column:
    """norm_text with the replacements of the single-file variant, one after the other; adjacent repeats can be missed."""
    out = F.concat(F.lit(" "), norm_text(c), F.lit(" "))
    for short, long in C.REPLACEMENTS_SHORT.items():
        out = F.replace(out, F.lit(short), F.lit(long))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


norm_country = norm_text


def clean_text(c: Column) -> Column:
    """Lower case, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))


def tokens(c: Column) -> Column:
    """Distinct words, sorted."""
    return F.array_sort(F.array_distinct(_split(c)))


def by_length(array: Column) -> Column:
    """Longest first, then alphabetical."""
    return F.transform(F.array_sort(F.transform(array, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda s: s["w"])


def shortest(array: Column, n: int) -> Column:
    """The n first words by length, then alphabetical."""
    ordered = F.array_sort(F.transform(array, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    return F.transform(F.slice(ordered, 1, n), lambda s: s["w"])


def name_key(c: Column) -> Column:
    """The batch variant's name of a reference record: distinct words, longest first."""
    return F.array_join(by_length(F.array_distinct(_split(norm_name(c, amp_as_and=False)))), " ")


def salient(array: Column, generic=C.GENERIC_TOKENS) -> Column:
    """Words of four letters and more that are neither generic nor legal forms, longest first."""
    return by_length(F.filter(array, lambda w: (F.length(w) >= C.MIN_NAME_TOKEN) & ~w.isin(*generic) & ~w.isin(*C.LEGAL_FORMS)))


def key_token(array: Column) -> Column:
    """The longest word of four letters and more that is no legal form, first by alphabet; null if there is none."""
    return F.get(by_length(F.filter(array, lambda w: (F.length(w) >= 4) & ~w.isin(*C.LEGAL_FORMS))), F.lit(0))


def prefix_key(c: Column) -> Column:
    """The first four characters of a name of at least three."""
    return F.when(F.length(c) >= 3, F.substring(c, 1, 4))


def address_words(array: Column, least: int = C.MIN_ADDRESS_TOKEN, stop=C.ADDRESS_STOP_WORDS) -> Column:
    return F.filter(array, lambda w: (F.length(w) >= least) & ~w.isin(*stop))


def postal_codes(c: Column, unicode_digits: bool = False) -> Column:
    """All five- or six-digit codes, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(("(?U)" if unicode_digits else "") + POSTAL), F.lit(0))))


def first_postal(c: Column) -> Column:
    """The first code, or an empty string."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), POSTAL, 0)


def char_grams(c: Column, n: int = 3, pad: bool = True) -> Column:
    """Distinct character n-grams, sorted; a short string is one gram, an empty one has none."""
    s = F.concat(F.lit(" "), c, F.lit(" ")) if pad else c
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substring(s, i, F.lit(n)))
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(grams)))


def parse_ids(c: Column) -> Column:
    """Ids of a comma list, trimmed, in order, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def format_ids(array: Column) -> Column:
    """Comma list in order, each id once."""
    return F.array_join(F.array_distinct(array), ",")


def feed_of(entity_id: Column) -> Column:
    """S1, S2, S3 or other, by prefix."""
    known = [F.when(entity_id.startswith(f"{feed}-"), feed) for feed in ("S1", "S2", "S3")]
    return F.coalesce(*known, F.lit("other"))
