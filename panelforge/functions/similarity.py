"""Similarity of short texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Texts up to so many letters are compared as matrices, so many pairs at a time.
LETTERS, PAIRS = 64, 4096


def _letters(texts: list[str], width: int) -> np.ndarray:
    """A row of code points per text, filled up with zeros."""
    return np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width)


def _in_front(matrix: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen entries of each row, in order, before the others."""
    return np.take_along_axis(matrix, np.argsort(~chosen, axis=1, kind="stable"), axis=1)


def jaro_winkler_texts(left: list[str], right: list[str]) -> np.ndarray:
    """Jaro similarity of each pair, raised by up to four equal first letters where it is above 0.7."""
    n_left, n_right = (np.array([len(x) for x in side], dtype=np.int64) for side in (left, right))
    width = max(1, int(n_left.max(initial=0)), int(n_right.max(initial=0)))
    a, b = _letters(left, width), _letters(right, width)
    place = np.arange(width)
    reach = np.maximum(np.maximum(n_left, n_right) // 2 - 1, 0)
    free = place < n_right[:, None]
    paired = np.zeros_like(free)
    for i in range(int(n_left.max(initial=0))):
        here = free & (b == a[:, i : i + 1]) & (np.abs(place - i) <= reach[:, None]) & (i < n_left)[:, None]
        rows = np.flatnonzero(here.any(axis=1))
        free[rows, here[rows].argmax(axis=1)] = False
        paired[rows, i] = True
    used = ~free & (place < n_right[:, None])
    m = paired.sum(axis=1)
    swapped = ((_in_front(a, paired) != _in_front(b, used)) & (place < m[:, None])).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / n_left + m / n_right + (m - swapped) / m) / 3, 0.0)
    first = (a[:, :4] == b[:, :4]) & (place[:4] < np.minimum(n_left, n_right)[:, None])
    raised = jaro + first.cumprod(axis=1).sum(axis=1) * 0.1 * (1 - jaro)
    same = np.array([x == y for x, y in zip(left, right, strict=True)], dtype=bool)
    return np.where(same, 1.0, np.where(jaro > 0.7, raised, jaro))


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(a), np.nan)
    known = a.notna().to_numpy() & b.notna().to_numpy()
    pairs = pd.DataFrame({"a": a[known].to_numpy(dtype=object), "b": b[known].to_numpy(dtype=object)})
    code = pairs.groupby(["a", "b"], sort=False).ngroup().to_numpy()
    first = np.unique(code, return_index=True)[1]
    left, right = pairs["a"].to_numpy()[first], pairs["b"].to_numpy()[first]
    size = np.array([max(len(x), len(y)) for x, y in zip(left, right, strict=True)], dtype=np.int64)
    scores = np.empty(len(first))
    short = np.flatnonzero(size <= LETTERS)
    for at in [*np.array_split(short, -(-len(short) // PAIRS) or 1), *[[i] for i in np.flatnonzero(size > LETTERS)]]:
        if len(at):
            scores[at] = jaro_winkler_texts([left[i] for i in at], [right[i] for i in at])
    out[known] = scores[code]
    return pd.Series(out).astype(object).where(known, None)


def one_edit(a: Column, b: Column) -> Column:
    """Equal up to one insertion, deletion, change or swap of neighbours."""
    tail = lambda c, i: F.substr(c, i + 2, F.length(c))
    swapped = lambda i: (F.left(a, i - 1) == F.left(b, i - 1)) & (F.substr(a, i, F.lit(2)) == F.reverse(F.substr(b, i, F.lit(2)))) & (tail(a, i) == tail(b, i))
    swap = (F.length(a) == F.length(b)) & (F.length(a) > 1) & F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), swapped)
    # the parts before and after an edit have all but two letters of the shorter text, so half of these are equal in front or at the end
    half = F.greatest((F.least(F.length(a), F.length(b)) - 2).cast("int") / 2, F.lit(0)).cast("int")
    apart = (F.left(a, half) != F.left(b, half)) & (F.right(a, half) != F.right(b, half))
    # a swap is two changes; the look for it goes letter by letter, so it is for few pairs
    return F.when(a.isNull() | b.isNull(), None).when(apart, False).when(F.levenshtein(a, b, 1) >= 0, True).when(F.levenshtein(a, b, 2) < 0, False).otherwise(swap)
