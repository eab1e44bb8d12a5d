"""Comparisons of two values, from 0 to 1; null where one isn't observed."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Strings of more bytes are compared one by one.
_WIDE = 64


def _jaro(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Jaro similarity of pairs of strings of bytes, all pairs at once, byte by byte of the first."""
    n = len(a)
    la, lb = (np.array([len(x) for x in s], np.int64) for s in (a, b))
    wide_a, wide_b = int(la.max(initial=1)) or 1, int(lb.max(initial=1)) or 1
    x = np.frombuffer(b"".join(s.ljust(wide_a, b"\0") for s in a), np.uint8).reshape(n, wide_a)
    y = np.frombuffer(b"".join(s.ljust(wide_b, b"\0") for s in b), np.uint8).reshape(n, wide_b)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    place = np.arange(wide_b)
    taken = place[None] >= lb[:, None]
    matched_a = np.zeros((n, wide_a), bool)
    free = ~taken
    for i in range(wide_a):
        can = free & (y == x[:, i : i + 1]) & (np.abs(place[None] - i) <= window[:, None]) & (i < la)[:, None]
        hit = can.any(1)
        first = can.argmax(1)
        rows = np.flatnonzero(hit)
        free[rows, first[rows]] = False
        matched_a[rows, i] = True
    matched_b = ~free & ~taken
    m = matched_a.sum(1)
    # The matched bytes of each side, in their order, at the left.
    order_a, order_b = np.argsort(~matched_a, axis=1, kind="stable"), np.argsort(~matched_b, axis=1, kind="stable")
    k = min(wide_a, wide_b)
    seq_a, seq_b = np.take_along_axis(x, order_a, 1)[:, :k], np.take_along_axis(y, order_b, 1)[:, :k]
    t = ((seq_a != seq_b) & (np.arange(k)[None] < m[:, None])).sum(1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        j = (m / la + m / lb + (m - t) / m) / 3
    return np.where(m > 0, j, 0.0)


def jaro_winkler_pairs(a: list[str], b: list[str]) -> np.ndarray:
    """Jaro-Winkler similarity over UTF-8 bytes; the common beginning counts where Jaro's is over 0.7."""
    x, y = [s.encode() for s in a], [s.encode() for s in b]
    out = np.zeros(len(x))
    size = np.array([max(len(p), len(q)) for p, q in zip(x, y, strict=True)], np.int64)
    small = np.flatnonzero(size <= _WIDE)
    if len(small):
        out[small] = _jaro([x[i] for i in small], [y[i] for i in small])
    for i in np.flatnonzero(size > _WIDE):
        out[i] = _jaro([x[i]], [y[i]])[0]
    for i in np.flatnonzero(out > 0.7):
        p = 0
        while p < 4 and p < len(x[i]) and p < len(y[i]) and x[i][p] == y[i][p]:
            p += 1
        out[i] += 0.1 * p * (1 - out[i])
    return out


@F.pandas_udf(T.DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    ok = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    if ok.any():
        out[ok] = jaro_winkler_pairs(a[ok].tolist(), b[ok].tolist())
    return pd.Series(out).astype("object").where(ok, None)


def with_jaro_winkler(pairs: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """pairs with, for each new name, the Jaro-Winkler similarity of two columns; null where either is null or ''."""
    return pairs.withColumns({k: _jaro_winkler(observed(F.col(a)), observed(F.col(b))) for k, (a, b) in columns.items()})


def observed(c: Column) -> Column:
    """The text, null where it is ''."""
    return F.nullif(c, F.lit(""))


def exact(a: Column, b: Column) -> Column:
    return F.when(observed(a).isNotNull() & observed(b).isNotNull(), F.when(a == b, 1.0).otherwise(0.0))


def exact_number(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, 1.0).otherwise(0.0))


def token_jaccard(a: Column, b: Column) -> Column:
    """Common words by all words."""
    x, y = F.split(a, " "), F.split(b, " ")
    return F.when((F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != ""), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def middle_compatible(a: Column, b: Column) -> Column:
    """1 for equal middle names, or one letter that begins the other's."""
    starts = ((F.length(a) == 1) & b.startswith(a)) | ((F.length(b) == 1) & a.startswith(b))
    return F.when(observed(a).isNotNull() & observed(b).isNotNull(), F.when((a == b) | starts, 1.0).otherwise(0.0))


def postcode_level(a: Column, b: Column) -> Column:
    """1 for equal postcodes, 0.5 for equal outward codes."""
    out = [F.split_part(x, F.lit(" "), F.lit(1)) for x in (a, b)]
    return F.when(observed(a).isNotNull() & observed(b).isNotNull(), F.when(a == b, 1.0).when(out[0] == out[1], 0.5).otherwise(0.0))
