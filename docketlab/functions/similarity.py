"""Similarity of strings and vectors."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .text import _col, _text


def jaro(a: str, b: str) -> float:
    """Jaro similarity: agreement of characters no further apart than half the longer string."""
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    used = [False] * len(b)
    hits = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    other = [c for c, u in zip(b, used) if u]
    swaps = sum(x != y for x, y in zip(hits, other)) // 2
    m = len(hits)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler_value(a: str, b: str) -> float:
    """Jaro, raised for a common beginning of up to four characters if it is above 0.7."""
    value = jaro(a, b)
    if value <= 0.7:
        return value
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return value + prefix * 0.1 * (1 - value)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler of two strings, 0 if either is null or empty; equal pairs of a batch are computed once."""
    seen: dict[tuple, float] = {}
    out = []
    for pair in zip(a, b):
        if pair not in seen:
            seen[pair] = jaro_winkler_value(*pair) if all(isinstance(x, str) and x for x in pair) else 0.0
        out.append(seen[pair])
    return pd.Series(out, dtype="float64")


def ratio_value(a: str, b: str) -> int:
    return round(100 * SequenceMatcher(None, a, b).ratio()) if a or b else 0


def token_sort_value(a: str, b: str) -> int:
    key = lambda s: " ".join(sorted("".join(c.lower() if c.isalnum() else " " for c in s).split()))
    return ratio_value(key(a), key(b))


def keep_distinct(values: list[str], threshold: int = 85) -> list[str]:
    """Strings from the longest on that are less than ``threshold`` per cent alike to all kept before."""
    kept: list[str] = []
    for v in sorted({v for v in values if v}, key=lambda v: (-len(v), v)):
        if all(ratio_value(v.lower(), k.lower()) < threshold for k in kept):
            kept.append(v)
    return kept


@F.pandas_udf(T.ArrayType(T.StringType()))
def distinct_strings(values: pd.Series) -> pd.Series:
    return values.map(lambda x: keep_distinct(list(x)) if x is not None else [])


def string_features(a, b) -> Column:
    """Struct of Jaro-Winkler, one less normalised edit distance, and ratio of lengths, in lower case.

    With a null the edit distance counts as none; of two empty strings the lengths are alike.
    """
    x, y = F.lower(_text(a)), F.lower(_text(b))
    longest, shortest = F.greatest(F.length(x), F.length(y)), F.least(F.length(x), F.length(y))
    null = _col(a).isNull() | _col(b).isNull()
    edit = F.when(null | (longest == 0), 1.0).otherwise(1 - F.levenshtein(x, y) / longest)
    ratio = F.when(null, 0.0).when(longest == 0, 1.0).otherwise(shortest / longest)
    return F.struct(F.when(null, 0.0).otherwise(jaro_winkler(x, y)).alias("jaro"), edit.alias("levenshtein"), ratio.alias("length_ratio"))


def levenshtein_similarity(a, b) -> Column:
    x, y = F.lower(_text(a)), F.lower(_text(b))
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(_col(a).isNull() | _col(b).isNull() | (longest == 0), 1.0).otherwise(1 - F.levenshtein(x, y) / longest)


def component_similarity(a, b, initials: bool = False) -> Column:
    """Struct of similarity and whether it counts: both parts must be there; an initial equals what it begins."""
    x, y = F.lower(F.trim(_text(a))), F.lower(F.trim(_text(b)))
    counts = (x != "") & (y != "")
    initial = ((F.length(x) == 1) & F.startswith(y, x)) | ((F.length(y) == 1) & F.startswith(x, y))
    value = F.when(initial, 1.0).otherwise(jaro_winkler(x, y)) if initials else jaro_winkler(x, y)
    return F.struct(F.when(counts, value).otherwise(0.0).alias("value"), counts.alias("counts"))


#: Weights of first, last and middle name and suffix.
NAME_WEIGHTS = {"first": 0.45, "last": 0.45, "middle": 0.5, "suffix": 0.5}


def weighted_similarity(parts: dict[str, Column]) -> Column:
    """Mean of the similarities that count, by weight; 0 if none does."""
    top = sum((F.when(p["counts"], p["value"] * NAME_WEIGHTS[k]).otherwise(0.0) for k, p in parts.items()), F.lit(0.0))
    bottom = sum((F.when(p["counts"], NAME_WEIGHTS[k]).otherwise(0.0) for k, p in parts.items()), F.lit(0.0))
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a, b) -> Column:
    """Cosine of two vectors; 0 if either has no length."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def unit(a) -> Column:
    """The vector at length one; one without length stays."""
    n = F.sqrt(dot(a, a))
    return F.when(n > 0, F.transform(_col(a), lambda x: x.cast("double") / n)).otherwise(F.transform(_col(a), lambda x: x.cast("double")))


def rescaled(similarity) -> Column:
    return (_col(similarity) + 1) / 2


def luhn_ok(c) -> Column:
    return F.coalesce(F.call_function("luhn_check", _col(c)), F.lit(False))
