"""Edit-based similarities as vectorised functions, and the token features as expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import text as T


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the characters of b."""
    if a == b:
        return len(a)
    if not a or not b:
        return 0
    mask: dict[str, int] = {}
    for i, c in enumerate(b):
        mask[c] = mask.get(c, 0) | 1 << i
    full = (1 << len(b)) - 1
    v = full
    for c in a:
        hit = v & mask.get(c, 0)
        v = (v + hit | v - hit) & full
    return len(b) - v.bit_count()


def indel(a: str, b: str) -> float:
    """2 * LCS / (len a + len b); two empty strings are equal."""
    total = len(a) + len(b)
    return 2 * lcs(a, b) / total if total else 1.0


def partial(a: str, b: str) -> float:
    """Best indel similarity of the shorter string with the windows of its length in the longer, cut ones at the edges included.

    Characters that a window shares with the string, counted while it slides, bound its similarity: most windows are
    passed over.
    """
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if not n:
        return 1.0 if not m else 0.0
    if a in b:
        return 1.0
    best = _best_window(a, b)
    return max(best, _best_window(b, a)) if n == m else best


def _best_window(a: str, b: str) -> float:
    n, m, best, common = len(a), len(b), 0.0, 0
    free: dict[str, int] = {}  # characters of a that the window does not have
    for c in a:
        free[c] = free.get(c, 0) + 1
    for i in range(1 - n, m):
        if i + n <= m:
            c = b[i + n - 1]
            if c in free:
                common += free[c] > 0
                free[c] -= 1
        if i > 0:
            c = b[i - 1]
            if c in free:
                free[c] += 1
                common -= free[c] > 0
        size = min(m, i + n) - max(0, i)
        if 2 * common > best * (n + size):
            best = max(best, indel(a, b[max(0, i) : i + n]))
    return best


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best similarity among the common words, these with a's own words, and these with b's own words."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 1.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    found = [indel(one, two)]
    if both:
        found += [indel(both, one), indel(both, two)]
    return max(found)


def partial_token(a: str, b: str) -> float:
    """1 with a common word; else the better partial similarity of the sorted words and of the words that differ."""
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 1.0
    whole = partial(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    return max(whole, partial(" ".join(sorted(x - y)), " ".join(sorted(y - x))))


def weighted(a: str, b: str) -> float:
    """The weighted ratio: direct, token and, for lengths that differ by half and more, partial similarities."""
    if not a or not b:
        return 0.0
    ratio, straight = max(len(a), len(b)) / min(len(a), len(b)), indel(a, b)
    if ratio < 1.5:
        return max(straight, 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.9 if ratio <= 8 else 0.6
    return max(straight, scale * partial(a, b), 0.95 * scale * partial_token(a, b))


def _each_pair_once(f, a: pd.Series, b: pd.Series) -> pd.Series:
    """f over pairs of strings; pairs that repeat in the batch are computed once."""
    pairs = list(zip(a.fillna(""), b.fillna(""), strict=True))
    found = {p: f(*p) for p in dict.fromkeys(pairs)}
    return pd.Series([found[p] for p in pairs], dtype="float64")


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _each_pair_once(indel, a, b)


@F.pandas_udf(DoubleType())
def wratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _each_pair_once(weighted, a, b)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct words; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def containment(a: Column, b: Column) -> Column:
    """Length of the contained string by that of the other; 0 if neither contains the other or one is empty."""
    contained = F.when(F.contains(b, a), F.length(a) / F.length(b)).when(F.contains(a, b), F.length(b) / F.length(a)).otherwise(0.0)
    return F.when((a == "") | (b == ""), 0.0).otherwise(contained)


def overlap(a: Column, b: Column) -> Column:
    """Common words by the smaller number of words."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.least(F.size(a), F.size(b)))


def token_features(a: str = "a", b: str = "b") -> dict[str, Column]:
    """The features that are expressions of the prepared records a (reference) and b (target)."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    codes = F.arrays_overlap(T.postal_codes(x("addr_n")), T.postal_codes(y("addr_n")))
    return {
        "country_exact": ((x("country_n") != "") & (x("country_n") == y("country_n"))).cast("double"),
        "name_jaccard": jaccard(x("name_tokens"), y("name_tokens")),
        "name_containment": containment(x("name_n"), y("name_n")),
        "name_len_diff": F.abs(F.length(x("name_n")) - F.length(y("name_n"))).cast("double"),
        "name_token_overlap": overlap(x("name_tokens"), y("name_tokens")),
        "addr_jaccard": jaccard(x("addr_tokens"), y("addr_tokens")),
        "addr_containment": containment(x("addr_n"), y("addr_n")),
        "addr_len_diff": F.abs(F.length(x("addr_n")) - F.length(y("addr_n"))).cast("double"),
        "addr_token_overlap": overlap(x("addr_tokens"), y("addr_tokens")),
        "same_postal_like": codes.cast("double"),
    }


def lexical_score(name_ratio: Column, addr_ratio: Column) -> Column:
    return 0.65 * name_ratio + 0.35 * addr_ratio


def fallback_probability(name_ratio: Column, addr_ratio: Column, country_exact: Column) -> Column:
    """Used where no model is at hand; 0.65 and more counts as a match."""
    return 0.60 * name_ratio + 0.30 * addr_ratio + 0.10 * country_exact
