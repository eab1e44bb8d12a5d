"""Suffix-array dedup: bytes in long strings that occur more than once anywhere.

Bundles of windows (see repeats) tell which strings can repeat at all. Those of equal content do; those
of different content under one anchor are gathered by content and judged by a suffix array: suffixes
smaller than their successors are sorted directly, the rest is induced by one scan of the buckets, and
windows whose common prefix with a neighbour reaches the window's length repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import BYTE, U64, doc_key, mix, prefix_sums, range_hash, remove, saved, scratch, small_batches
from linkgraph.llm.repeats import Bundles, Symbols, Unit, anchors, cover, occurrences, with_wanted

WINDOW = 200
UNIT = Unit("byte", WINDOW, 48)
#: A shard's suffix array is begun anew after so many bytes, at a change of the routing key.
SHARD_BYTES = 1 << 20
#: Contents under one anchor beyond which they part by a second one, so that a shard stays small.
FREQUENT = 500
_PACK = 7


def packed(t: np.ndarray) -> np.ndarray:
    """The next seven symbols at each place, as one number in their order."""
    padded = np.concatenate([t, np.zeros(_PACK, t.dtype)]).astype(U64)
    key = np.zeros(len(t), U64)
    for k in range(_PACK):
        key = (key << U64(9)) | padded[k : k + len(t)]
    return key


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that begins after its first symbol."""
    step = np.sign(np.diff(t.astype(np.int64), append=-1))
    at = np.where(step != 0, np.arange(len(t)), len(t))
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def sort_directly(places: np.ndarray, key: np.ndarray, depth: int) -> np.ndarray:
    """places in the order of the suffixes there, by their first depth symbols; key has the next seven of each place."""
    rank = np.unique(key, return_inverse=True)[1].astype(U64) + U64(1)
    bits = U64(int(len(key) + 1).bit_length())
    padded = np.concatenate([rank, np.zeros(2 * _PACK, U64)])
    n = len(key)
    wide = ((padded[:n] << (bits + bits)) | (padded[_PACK : n + _PACK] << bits) | padded[2 * _PACK : n + 2 * _PACK]) if bits <= 21 else rank
    step = 3 * _PACK if bits <= 21 else _PACK
    order = places[np.argsort(wide[places], kind="stable")]
    group = np.concatenate([[True], wide[order[1:]] != wide[order[:-1]]]) if len(order) else np.zeros(0, bool)
    done = step
    while done < depth and len(order):
        tied = np.flatnonzero(~(group & np.append(group[1:], True)))
        if not len(tied):
            break
        own = order[tied]
        of = np.cumsum(group)[tied]
        nxt = own + done
        more = np.where(nxt < n, wide[np.minimum(nxt, n - 1)], U64(0))
        again = np.argsort(more, kind="stable")
        again = again[np.argsort(of[again], kind="stable")]
        order[tied] = own[again]
        more, of = more[again], of[again]
        group[tied] |= np.concatenate([[True], (more[1:] != more[:-1]) | (of[1:] != of[:-1])])
        done += step
    return order


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of t (its last symbol 0, the others 0 to 256) in the order of at least their first depth symbols, by two-stage sorting."""
    if not len(t):
        return np.zeros(0, np.int64)
    small = smaller_than_next(t)
    direct = sort_directly(np.flatnonzero(small), packed(t), depth)
    heads = t[direct]
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    waiting[0].append(np.array([len(t) - 1]))  # its successor is empty
    out = []
    for c in range(257):
        part = []
        new = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(new):  # a run of one symbol is induced from its own bucket
            part.append(new)
            new = new[new > 0] - 1
            new = new[(t[new] == c) & ~small[new]]
        part.append(direct[np.searchsorted(heads, c) : np.searchsorted(heads, c, side="right")])
        bucket = np.concatenate(part)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before] & (t[before] > c)]
        before = before[np.argsort(t[before], kind="stable")]
        edges = np.flatnonzero(np.diff(t[before])) + 1
        for group in np.split(before, edges):
            if len(group):
                waiting[int(t[group[0]])].append(group)
    return np.concatenate(out)


def reach(t: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Whether the common prefix of each suffix and the one before it has depth symbols, none of them 0; seven are compared at a time."""
    key = packed(t)
    ends = np.flatnonzero(t == 0)
    room = (ends[np.searchsorted(ends, sa)] - sa >= depth) if len(ends) else np.zeros(len(sa), bool)
    live = np.flatnonzero(room[1:] & room[:-1]) + 1
    for at in [*range(0, max(1, depth - _PACK), _PACK), depth - _PACK] if depth >= _PACK else range(depth):
        x, y = sa[live - 1] + at, sa[live] + at
        live = live[key[x] == key[y] if depth >= _PACK else t[x] == t[y]]
    out = np.zeros(len(sa), bool)
    out[live] = True
    return out


def may_repeat(pieces: list[bytes], window: int) -> list[tuple[int, int, int]]:
    """Runs (piece, first, last) of places where a string of window bytes begins whose hash occurs again among the pieces; no others can repeat."""
    lengths = np.array([len(p) + 1 for p in pieces])
    begin = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"".join(p + b"\0" for p in pieces), np.uint8)
    own = np.repeat(np.arange(len(pieces)), lengths)
    at = np.arange(max(0, len(raw) - window))
    at = at[own[at] == own[at + window]]  # the byte behind the string is still the piece's, its end included
    h = range_hash(prefix_sums(BYTE[raw]), at, at + window)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = at[again]
    if not len(at):
        return []
    of = own[at]
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of) != 0)]))
    last = np.append(edge[1:], len(at)) - 1
    return list(zip(of[edge].tolist(), (at[edge] - begin[of[edge]]).tolist(), (at[last] - begin[of[edge]]).tolist(), strict=True))


def repeated_windows(pieces: list[bytes], window: int) -> np.ndarray:
    """Places in the pieces, one after the other with a gap of 1 behind each, where a string of window bytes begins that begins elsewhere too."""
    joined = np.zeros(sum(len(p) + 1 for p in pieces), np.int16)
    at = 0
    for p in pieces:
        joined[at : at + len(p)] = np.frombuffer(p, np.uint8)
        joined[at : at + len(p)] += 1
        at += len(p) + 1
    sa = suffix_array(joined, window)
    long = reach(joined, sa, window)
    return np.sort(sa[long | np.append(long[1:], False)])


def judge(pieces: DataFrame, unit: Unit) -> DataFrame:
    """Windows that repeat among pieces (route, _id, _key, first, bytes) of one route: _id, _key, first, last."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        # Equal runs are sorted once; a run that occurs again is settled by that.
        runs: dict[bytes, list[tuple[int, int, int]]] = {}
        for k, first, last in may_repeat([r[4] for r in rows], unit.window):
            runs.setdefault(rows[k][4][first : last + unit.window], []).append((k, first, last))
        start = np.concatenate([[0], np.cumsum([len(r) + 1 for r in runs])]).astype(np.int64)
        at = repeated_windows(list(runs), unit.window)
        of = np.searchsorted(start, at, side="right") - 1
        edge = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of) != 0)])) if len(at) else np.zeros(0, np.int64)
        until = np.append(edge[1:], len(at)) - 1
        places = list(runs.values())
        out = [(k, first, last) for p in places if len(p) > 1 for k, first, last in p]
        for o, lo, hi in zip(of[edge].tolist(), (at[edge] - start[of[edge]]).tolist(), (at[until] - start[of[edge]]).tolist(), strict=True):
            if len(places[o]) == 1:
                k, first, _ = places[o][0]
                out.append((k, first + lo, first + hi))
        return pa.RecordBatch.from_arrays([pa.array([rows[k][1] for k, _, _ in out], id_type), pa.array([rows[k][2] for k, _, _ in out], pa.int64()), pa.array([rows[k][3] + a for k, a, _ in out], pa.int32()), pa.array([rows[k][3] + b for k, _, b in out], pa.int32())], names=["_id", "_key", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size > SHARD_BYTES and r[0] != rows[-1][0]:
                    yield flush(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[4])
        if rows:
            yield flush(rows)

    small_batches(pieces.sparkSession)
    kind = dict(pieces.dtypes)["_id"]
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    return pieces.select("route", "_id", "_key", "first", "bytes").repartition("route").sortWithinPartitions("route").mapInArrow(run, f"_id {kind}, _key long, first int, last int")


def repeated(rows: DataFrame, unit: Unit = UNIT) -> DataFrame:
    """The windows of rows (_id, _text, _key) whose string starts anywhere else, as ranges (_id, _key, first, last)."""
    spark = rows.sparkSession
    path = scratch(spark, "bundles")
    occ = saved(occurrences(rows, unit), path)
    counted = saved(occ.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min("_key").alias("_key")), scratch(spark, "contents"))
    whole = saved(occ.join(counted.filter("n > 1").select("anchor", "digest"), ["anchor", "digest"]).select("_id", "_key", "first", "last"), scratch(spark, "whole"))
    remove(spark, path)
    # Where every content occurs again, all windows are settled.
    mixed = counted.groupBy("anchor").agg(F.count("*").alias("k"), F.min("n").alias("n")).filter("k > 1 and n = 1").select("anchor", (F.col("k") > FREQUENT).alias("cut"))
    wanted = counted.drop("n").join(mixed, "anchor").select("_key", "anchor", "digest", "cut")

    def pieces(s: Symbols, b: Bundles, row: np.ndarray, part: np.ndarray) -> list[pa.Array]:
        # A frequent anchor's bundle is cut where the anchor of another choice changes.
        if part.any():
            second, hashes = anchors(s, unit, seed=0x2545F491)
        else:
            second, hashes = np.zeros(max(0, len(s.hashes) - unit.window + 1), np.int64), np.zeros(max(0, len(s.hashes) - unit.window + 1), U64)
        change = np.zeros(len(second), bool)
        change[1:] = second[1:] != second[:-1]
        inside = np.zeros(len(second) + 1, np.int64)
        np.add.at(inside, b.first[part], 1)
        np.add.at(inside, b.last[part] + 1, -1)
        change &= np.cumsum(inside[:-1]) > 0
        change[b.first] = True
        cuts = np.append(np.flatnonzero(change), len(second))
        lo, hi = np.searchsorted(cuts, b.first), np.searchsorted(cuts, b.last, side="right")
        n = hi - lo
        c = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first, last = cuts[c] if len(c) else c, np.minimum(cuts[np.minimum(c + 1, len(cuts) - 1)] - 1, np.repeat(b.last, n))
        rows_of = np.repeat(row, n)
        route = mix(np.repeat(b.anchor, n) ^ np.where(np.repeat(part, n), mix(hashes[first]), U64(0)))
        return [pa.array(rows_of), pa.array(route.view(np.int64)), pa.array((first - s.first[rows_of]).astype(np.int32)), pa.array([s.data[i:j] for i, j in zip(first.tolist(), (last + unit.window).tolist(), strict=True)], pa.binary())]

    found = with_wanted(rows, wanted, "_key", pieces, "route long, first int, bytes binary", unit)
    return whole.unionByName(saved(judge(found, unit), scratch(spark, "judged")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """What each document keeps without bytes in strings of WINDOW bytes that also start anywhere else.

    Columns: the id, n_bytes, n_removed, n_spans (maximal removed runs), kept or kept_sha256. Null and
    empty texts have no bytes. A string that occurs twice is removed at both places, in one document as
    in two; rows of one id, equal or not, and rows without id, are documents like any other.
    """
    return cover(doc_key(docs, id_col, text_col), repeated(doc_key(docs, id_col, text_col)), UNIT, id_col, digests)
