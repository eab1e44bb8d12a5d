"""Statements of control: kind, band of per cent and capacity, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkgraph import vocab

# How a holding's capacity and band are written.
CAPACITY = r"-(as-(?:trust|firm)(?:-limited-liability-partnership)?|limited-liability-partnership)$"
BAND = r"([0-9]+)-to-([0-9]+)-percent"


def parse_nature(n: Column, capacity: str = CAPACITY) -> Column:
    """struct(kind, min, max, capacity) of one statement; kind is UNKNOWN for '' and OTHER if no kind is its beginning."""
    raw = F.lower(F.trim(F.coalesce(n, F.lit(""))))
    how = F.regexp_extract(raw, capacity, 1)
    body = F.regexp_replace(raw, capacity, "")
    low, high = (F.nullif(F.regexp_extract(body, BAND, k), F.lit("")).cast("double") for k in (1, 2))
    rest = F.when(low.isNotNull(), F.rtrim(F.substring_index(F.regexp_replace(body, BAND, "\u0001"), "\u0001", 1), F.lit("-"))).otherwise(body)
    exact = reduce(lambda w, kv: w.when(rest == kv[0], kv[1]), vocab.CONTROL_KINDS.items(), F.when(raw == "", "UNKNOWN"))
    kind = reduce(lambda w, kv: w.when(rest.startswith(kv[0]), kv[1]), vocab.CONTROL_KINDS.items(), exact).otherwise("OTHER")
    return F.struct(kind.alias("kind"), low.alias("min"), high.alias("max"), F.when(how.contains("trust"), "TRUST").when(how.contains("firm"), "FIRM").when(how != "", "LLP").alias("capacity"))


def summarise(natures: Column, capacity: str = CAPACITY) -> Column:
    """struct(kinds, min_percent, max_percent, has_hard_control, via_fiduciary, capacities) of a filing's statements.

    Bands of shares count before bands of votes; of several the widest. Null or empty lists have none of all.
    """
    said = F.transform(F.filter(F.coalesce(natures, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), lambda x: parse_nature(x, capacity))
    equity = F.filter(said, lambda s: (s["kind"] == "SHARES") & s["min"].isNotNull())
    votes = F.filter(said, lambda s: (s["kind"] == "VOTING") & s["min"].isNotNull())
    banded = F.when(F.size(equity) > 0, equity).otherwise(votes)
    return F.struct(
        F.array_sort(F.array_distinct(F.transform(said, lambda s: s["kind"]))).alias("kinds"),
        F.array_min(F.transform(banded, lambda s: s["min"])).alias("min_percent"),
        F.array_max(F.transform(banded, lambda s: s["max"])).alias("max_percent"),
        F.exists(said, lambda s: s["kind"].isin(vocab.HARD_KINDS) | F.coalesce(s["max"].isNotNull() & (s["min"] >= 50), F.lit(False))).alias("has_hard_control"),
        F.exists(said, lambda s: s["capacity"].isNotNull()).alias("via_fiduciary"),
        F.array_sort(F.array_distinct(F.array_compact(F.transform(said, lambda s: s["capacity"])))).alias("capacities"),
    )
