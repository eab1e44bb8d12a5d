"""Windows that repeat anywhere in a corpus: what substring and suffix-array dedup share.

A window is W consecutive symbols (words or bytes) of one document. Of the grams inside a window the one
of smallest hash, the leftmost of equals, is its anchor; it depends on the window's content alone, so
equal windows have equal anchors at equal places. Neighbouring windows mostly share an anchor: such a
run of windows is a bundle, and a text has about 2 / (W - gram + 2) of them for each symbol. Equal windows
are found by moving bundles, not windows, with no loss:

- bundles of equal content hold equal windows: one row of digests for each settles them;
- bundles of different content under one anchor may share windows at their ends ("mixed" anchors); only
  of these are the windows themselves looked at, from the text of one document for each content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import BYTE, U64, KeyFilter, arrow_map, mix, prefix_sums, range_hash, sliding_min, text_bytes, word_hashes, words_of

_PLACE = U64((1 << 24) - 1)
_BLOCK = 1 << 22


@dataclass(frozen=True)
class Unit:
    """What a window is made of: 'word' (`[^\\x20\\x09-\\x0D]+`, joined by single spaces) or 'byte'."""

    kind: str
    window: int
    gram: int


@dataclass
class Symbols:
    """Symbols of a slice of texts: their hashes and documents, and the bytes of each from start to end in data."""

    hashes: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    data: bytes
    start: np.ndarray
    end: np.ndarray


def symbols(col: pa.Array, unit: Unit) -> Symbols:
    n = len(col)
    if unit.kind == "word":
        col = pa.array([b" ".join(t.encode().split()) if t else b"" for t in col.to_pylist()], pa.binary())
        raw, off = text_bytes(col)
        start, end, doc = words_of(raw, off)
        hashes = word_hashes(raw, start, end)
    else:
        raw, off = text_bytes(col)
        start = np.arange(len(raw))
        end, doc, hashes = start + 1, np.repeat(np.arange(n), np.diff(off)), BYTE[raw]
    return Symbols(hashes, doc, np.searchsorted(doc, np.arange(n + 1)), raw.tobytes(), start, end)


@dataclass
class Bundles:
    """Anchor hash and place, and the first and last window start, of each bundle."""

    anchor: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchors(s: Symbols, unit: Unit, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Of each window the place of its anchor, or -1 if it crosses documents, and the anchor's hash; seed chooses other anchors."""
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    for b in range(0, max(0, len(s.hashes) - unit.window + 1), _BLOCK):
        h, d = s.hashes[b : b + _BLOCK + unit.window - 1], s.doc[b : b + _BLOCK + unit.window - 1]
        at = np.arange(len(h) - unit.gram + 1)
        grams = range_hash(prefix_sums(h), at, at + unit.gram)
        if seed:
            grams = mix(grams ^ U64(seed))
        least = sliding_min((grams & ~_PLACE) | at.astype(U64), unit.window - unit.gram + 1)
        place = (least & _PLACE).astype(np.int64)
        hashes.append(grams[place])
        place += b
        place[d[: len(least)] != d[unit.window - 1 :]] = -1
        places.append(place)
    return np.concatenate(places), np.concatenate(hashes)


def bundles(s: Symbols, unit: Unit) -> Bundles:
    place, grams = anchors(s, unit)
    new = place >= 0
    new[1:] &= place[1:] != place[:-1]
    first = np.flatnonzero(new)
    stops = np.append(np.flatnonzero(new | (place < 0)), len(place))
    return Bundles(grams[first], place[first], first, stops[np.searchsorted(stops, first, side="right")] - 1)


def digests(s: Symbols, b: Bundles, unit: Unit) -> np.ndarray:
    """64 bits of BLAKE2b over each bundle's bytes and its anchor's place in it."""
    lo, hi, shift = s.start[b.first].tolist(), s.end[b.last + unit.window - 1].tolist(), (b.place - b.first).tolist()
    view, blake = memoryview(s.data), hashlib.blake2b
    raw = b"".join([blake(view[i:j], digest_size=8, key=k.to_bytes(4, "little")).digest() for i, j, k in zip(lo, hi, shift, strict=True)])
    return np.frombuffer(raw, np.int64)


def occurrences(docs: DataFrame, unit: Unit) -> DataFrame:
    """All bundles of docs (_id, _text, _key): anchor, digest, _id, _key, and their first and last window start."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = symbols(batch.column(1), unit)
        b = bundles(s, unit)
        d = s.doc[b.first]
        rows = pa.array(d)
        return pa.RecordBatch.from_arrays([pa.array(b.anchor.view(np.int64)), pa.array(digests(s, b, unit)), batch.column(0).take(rows), batch.column(2).take(rows), pa.array((b.first - s.first[d]).astype(np.int32)), pa.array((b.last - s.first[d]).astype(np.int32))], names=["anchor", "digest", "_id", "_key", "first", "last"])

    return arrow_map(docs.select("_id", "_text", "_key"), run, f"anchor long, digest long, _id {dict(docs.dtypes)['_id']}, _key long, first int, last int")


def with_wanted(docs: DataFrame, wanted: DataFrame, on: str, f: Callable[[Symbols, Bundles, np.ndarray, np.ndarray], list[pa.Array]], columns: str, unit: Unit) -> DataFrame:
    """f's rows for the bundles that wanted (on, anchor, digest, cut) names, from the texts of the documents whose column `on` it names.

    f gets the slice's symbols, its wanted bundles, and the row and cut of each; its arrays have a row for each
    of its results, the first being the row of docs. Other documents' texts don't move.
    """
    listed = wanted.groupBy(on).agg(F.collect_list(F.struct("anchor", "digest", "cut")).alias("wanted"))
    few = docs.select("_id", "_key", "_text")
    if on == "_key":
        few = KeyFilter(wanted, "_key").keep(few, "_key")
    else:
        few = KeyFilter(wanted.select(F.xxhash64("_id").alias("_h")), "_h").keep(few.withColumn("_h", F.xxhash64("_id")), "_h")
    joined = few.join(listed, on).select("_id", "_key", "_text", "wanted")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = symbols(batch.column(2), unit)
        b = bundles(s, unit)
        lists = batch.column(3)
        off = lists.offsets.to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(off))
        anchor, digest = (lists.values.field(k).to_numpy()[off[0] : off[-1]].view(U64) for k in range(2))
        own = s.doc[b.first]
        near = np.flatnonzero(np.isin(b.anchor ^ mix(own.astype(U64)), anchor ^ mix(row.astype(U64))))
        b, own = Bundles(b.anchor[near], b.place[near], b.first[near], b.last[near]), own[near]
        same = np.flatnonzero(np.isin(mix(b.anchor ^ mix(own.astype(U64))) ^ digests(s, b, unit).view(U64), mix(anchor ^ mix(row.astype(U64))) ^ digest))
        cut = lists.values.field(2).to_numpy(zero_copy_only=False)[off[0] : off[-1]]
        cut_of = np.isin(b.anchor[same] ^ mix(own[same].astype(U64)), (anchor ^ mix(row.astype(U64)))[cut])
        of, *cols = f(s, Bundles(b.anchor[same], b.place[same], b.first[same], b.last[same]), own[same], cut_of)
        return pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), *cols], names=["_id", "_key", *(c.split()[0] for c in columns.split(", "))])

    return arrow_map(joined, run, f"_id {dict(docs.dtypes)['_id']}, _key long, {columns}")


def cover(docs: DataFrame, spans: DataFrame, unit: Unit, id_col: str, digests_only: bool) -> DataFrame:
    """What is left of each of docs (_id, _text, _key) without the symbols in windows starting in spans (_id, _key, first, last).

    A row for each row of docs: its id, the number of symbols, of removed symbols and of maximal removed
    runs, and kept_sha256 or, unless digests_only is set, kept (words joined by one space; bytes
    concatenated, so that a character may be cut).
    """
    listed = spans.groupBy("_id", "_key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    listed = listed.withColumnRenamed("_id", "_i").withColumnRenamed("_key", "_k")
    there = KeyFilter(spans, "_key")
    some = there.keep(docs.select("_id", "_key", "_text"), "_key").join(listed, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")), "left").select("_id", "_text", "spans")
    word = unit.kind == "word"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        lists = batch.column(2)
        off = lists.offsets.to_numpy()
        first, last = lists.values.field(0).to_numpy(), lists.values.field(1).to_numpy()
        n_all, n_gone, n_runs, out = [], [], [], []
        for k, t in enumerate(texts):
            raw = (t or "").encode()
            words = raw.split() if word else raw
            n, gone, runs = len(words), 0, 0
            a, b = off[k], off[k + 1]
            if b > a:
                edge = np.zeros(n + 1, np.int32)
                np.add.at(edge, first[a:b], 1)
                np.add.at(edge, last[a:b] + unit.window, -1)
                inside = np.cumsum(edge[:n]) > 0
                gone = int(inside.sum())
                change = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
                runs = len(change) // 2
                cut = [0, *change.tolist(), n]
                pieces = [words[cut[i] : cut[i + 1]] for i in range(0, len(cut), 2)]
                words = [w for p in pieces for w in p] if word else b"".join(pieces)
            left = b" ".join(words) if word else words
            n_all.append(n)
            n_gone.append(gone)
            n_runs.append(runs)
            out.append(hashlib.sha256(left).hexdigest() if digests_only else left)
        cols = [pa.array(x, pa.int64()) for x in (n_all, n_gone, n_runs)]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols, pa.array(out, pa.string() if digests_only else pa.binary())], names=names)

    def rest(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        batch = batch.filter(pa.array(~there.may(batch.column(2))))
        return run(pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.nulls(batch.num_rows, span_type)], names=["_id", "_text", "spans"])) if batch.num_rows else None

    span_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    names = [id_col, f"n_{unit.kind}s", "n_removed", "n_spans", "kept_sha256" if digests_only else "kept"]
    schema = f"{id_col} {dict(docs.dtypes)['_id']}, n_{unit.kind}s long, n_removed long, n_spans long, {names[-1]} {'string' if digests_only else 'binary'}"
    # The texts that lose nothing don't move.
    return arrow_map(some, run, schema).unionByName(arrow_map(docs.select("_id", "_text", KeyFilter.bucket("_key").alias("_bucket")), rest, schema))


def window_hashes(s: Symbols, first: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each window: two hashes over independent symbols."""
    one = range_hash(prefix_sums(s.hashes), first, first + unit.window)
    two = range_hash(prefix_sums(mix(s.hashes ^ U64(0x5851F42D4C957F2D))), first, first + unit.window)
    return one.view(np.int64), two.view(np.int64)
