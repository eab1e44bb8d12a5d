"""Benchmark decontamination by suffix arrays of the training texts.

The training texts of a task are shards of SHARD_BYTES. A shard's word suffixes are sorted by prefix
doubling, no deeper than the longest benchmark item, as no match is longer; then every suffix of every
item is found by binary search, which gives its longest verbatim match, and the places of those that
reach a window. Words are compared by their 64-bit hashes.

The benchmark is written to the shared folder in blocks of about BLOCK_BYTES, by tasks, and each shard
is held against one block after the other; a worker holds few of them, however large the benchmark is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import cut, fresh, gathered, give_back, scratch, small_batches, text_bytes, word_hashes, words_of
from linkgraph.llm.warc import file_system

WINDOW = 10
HIT = "_n_hit"
BLOCK_BYTES = 4 << 20
#: Text of one suffix array; a longer document is a shard of its own.
SHARD_BYTES = 6 << 20


@dataclass
class Block:
    """Items without words are left out. words: hashes, item after item; off: where each item begins."""

    ids: list[str]
    words: np.ndarray
    off: np.ndarray


def make_block(ids: list[str], texts: list[str]) -> Block:
    raw, off = text_bytes(pa.array(texts, pa.string()))
    starts, ends, item = words_of(raw, off, "alnum")
    n = np.bincount(item, minlength=len(ids))
    return Block([i for i, k in zip(ids, n, strict=True) if k], word_hashes(raw, starts, ends, lower=True), np.concatenate([[0], np.cumsum(n[n > 0])]))


def write_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Files of the benchmark's blocks, of about BLOCK_BYTES of text each (a longer item has its own). The driver gets their names only."""
    folder = scratch(benchmark.sparkSession, "benchmark")
    limit = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(folder)
        fs.create_dir(at, recursive=True)
        for k, part in enumerate(gathered(batches, limit)):
            name = f"{at}/block-{TaskContext.get().taskAttemptId()}-{k}.arrow"
            block = make_block(part.column(0).to_pylist(), part.column(1).to_pylist())
            off = pa.array(block.off, pa.int64())
            lists = pa.LargeListArray.from_arrays(off, pa.array(block.words.view(np.int64)))
            table = pa.table([pa.array(block.ids, pa.string()), lists], names=["id", "words"])
            with fs.open_output_stream(name, compression=None) as f, pa.ipc.new_file(f, table.schema) as w:
                w.write_table(table)
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name.rpartition('/')[2]}"])], names=["file"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).na.drop()
    tasks = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // limit))
    small_batches(benchmark.sparkSession)
    # A lost task's file has another name when it is written again, so names come from what has ended.
    return sorted(r.file for r in cut(rows.coalesce(tasks).mapInArrow(run, "file string")).collect())


@lru_cache(maxsize=4)
def block_in(file: str) -> Block:
    fs, at = file_system(file)
    with fs.open_input_file(at) as f:
        t = pa.ipc.open_file(f).read_all().combine_chunks()
    if not t.num_rows:
        return Block([], np.zeros(0, np.uint64), np.zeros(1, np.int64))
    lists = t["words"].chunk(0)
    return Block(t["id"].to_pylist(), lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy())


class Shard:
    """A suffix array of words; 0 ends each document, words are 1 and up."""

    def __init__(self, words: np.ndarray, doc: np.ndarray, depth: int) -> None:
        self.vocab, codes = np.unique(words, return_inverse=True)
        self.at = np.arange(len(words)) + doc  # place of each word among the symbols, with an end after each document
        self.symbols = np.zeros((self.at[-1] + 2 if len(words) else 1) + 3, np.int64)
        self.symbols[self.at] = codes + 1
        s, bits = self.symbols, int(len(self.vocab) + 1).bit_length()
        step = max(1, min(3, 63 // bits))
        key = s[self.at]
        for k in range(1, step):
            key = (key << bits) | s[np.minimum(self.at + k, len(s) - 1)] if k == 1 else (key << bits) | np.where(s[self.at + k - 1] == 0, 0, s[self.at + k])
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(len(order), bool)
        new[:1] = True
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.zeros(len(s) + 1, np.int64)
        rank[self.at[order]] = np.maximum.accumulate(np.where(new, np.arange(1, len(order) + 1), 0))
        while step < depth and len(order):
            last = np.empty(len(order), bool)
            last[-1] = True
            last[:-1] = new[1:]
            slots = np.flatnonzero(~(new & last))  # only those that are still equal are sorted on
            if not len(slots):
                break
            tied = self.at[order[slots]]
            # A suffix that ended within the first part has no second.
            second = np.where(self.ended(tied, step), 0, rank[np.minimum(tied + step, len(rank) - 1)])
            both = rank[tied] * (len(rank) + 1) + second
            again = np.argsort(both, kind="stable")
            order[slots] = order[slots][again]
            both = both[again]
            fresh = np.empty(len(slots), bool)
            fresh[0] = True
            fresh[1:] = both[1:] != both[:-1]
            new[slots] |= fresh
            rank[self.at[order]] = np.maximum.accumulate(np.where(new, np.arange(1, len(order) + 1), 0))
            step *= 2
        self.sa = self.at[order]

    def ended(self, places: np.ndarray, step: int) -> np.ndarray:
        """Whether a document ends within step symbols from there."""
        if not hasattr(self, "next_end"):
            ends = np.flatnonzero(self.symbols == 0)
            self.next_end = ends[np.searchsorted(ends, np.arange(len(self.symbols)))]
        return self.next_end[places] < places + step

    def coded(self, words: np.ndarray) -> np.ndarray:
        """Symbols of other words; those that the shard lacks get -1, less than all."""
        if not len(self.vocab):
            return np.full(len(words), -1)
        i = np.minimum(np.searchsorted(self.vocab, words), len(self.vocab) - 1)
        return np.where(self.vocab[i] == words, i + 1, -1)

    def common(self, places: np.ndarray, t: np.ndarray, frm: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of the common prefix of each suffix and t[frm:frm+most]; and the sign of their comparison after it."""
        n, sign, live = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64), np.flatnonzero(most > 0)
        while len(live):
            a, b = self.symbols[np.minimum(places[live] + n[live], len(self.symbols) - 1)], t[frm[live] + n[live]]
            same = a == b
            sign[live[~same]] = np.sign(a - b)[~same]
            live = live[same]
            n[live] += 1
            live = live[n[live] < most[live]]
        return n, sign

    def bisect(self, t: np.ndarray, frm: np.ndarray, most: np.ndarray, right: bool) -> np.ndarray:
        lo, hi = np.zeros(len(frm), np.int64), np.full(len(frm), len(self.sa))
        while len(live := np.flatnonzero(lo < hi)):
            mid = (lo[live] + hi[live]) // 2
            _, sign = self.common(self.sa[mid], t, frm[live], most[live])
            up = sign <= 0 if right else sign < 0
            lo[live[up]], hi[live[~up]] = mid[up] + 1, mid[~up]
        return lo


def search(shard: Shard, block: Block, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of windows as (place, item, words), and longest matches as (place, item, words)."""
    t = shard.coded(block.words)
    item = np.repeat(np.arange(len(block.ids)), np.diff(block.off))
    frm, most = np.arange(len(t)), block.off[item + 1] - np.arange(len(t))
    keep = t > 0
    frm, most, item = frm[keep], most[keep], item[keep]
    if not len(shard.sa) or not len(frm):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z, z
    at = shard.bisect(t, frm, most, right=False)
    best, place = np.zeros(len(frm), np.int64), np.zeros(len(frm), np.int64)
    for near in (at - 1, at):
        ok = np.flatnonzero((near >= 0) & (near < len(shard.sa)))
        n, _ = shard.common(shard.sa[near[ok]], t, frm[ok], most[ok])
        more = n > best[ok]
        best[ok[more]], place[ok[more]] = n[more], shard.sa[near[ok[more]]]
    need = np.minimum(window, block.off[item + 1] - block.off[item])
    hit = np.flatnonzero(best >= need)
    lo, hi = shard.bisect(t, frm[hit], need[hit], right=False), shard.bisect(t, frm[hit], need[hit], right=True)
    count = hi - lo
    slot = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return shard.sa[slot], np.repeat(item[hit], count), np.repeat(need[hit], count), place, item, best


def measure(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, keep: bool = False) -> DataFrame:
    """One row per row of docs with what it shares with the benchmark.

    Words are ASCII letters and digits, A-Z lowered, and all characters beyond ASCII. A window is
    `window` consecutive words of one item, or all words of a shorter item. Columns: the id, n_words,
    n_hit (words inside an occurrence of a window), n_items (different ids of items with occurring
    windows), items_sha256 (of those ids, sorted as strings, comma-joined), contaminated, and
    longest_match (most consecutive words of one item found verbatim), longest_item, longest_at (its
    first word in the document). Null and empty texts have no words; items without id, text or words
    are left out; a benchmark without items finds nothing. With keep, all columns of docs come first,
    under their own names, and n_hit alone behind them, under HIT or a name like it that docs doesn't have.
    """
    files = write_blocks(benchmark, item_col, text_col)
    id_kind, hit_name = dict(docs.dtypes)[id_col], fresh(docs, HIT)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = text_bytes(batch.column(batch.num_columns - 1))
        starts, ends, doc = words_of(raw, off, "alnum")
        words, n = word_hashes(raw, starts, ends, lower=True), batch.num_rows
        first = np.searchsorted(doc, np.arange(n + 1))
        hit, items, longest = np.zeros(len(words) + 1, np.int64), [set() for _ in range(n)], [(0, None, None)] * n
        shard, depth = None, 0
        for file in files:
            block = block_in(file)
            most = int(np.diff(block.off).max(initial=0))
            if shard is None or depth < most:
                shard, depth = Shard(words, doc, most), most
            place, item, length, best_at, best_item, best = search(shard, block, window)
            at = np.searchsorted(shard.at, place)
            np.add.at(hit, at, 1)
            np.add.at(hit, np.minimum(at + length, len(words)), -1)
            for d, i in {*zip(doc[at].tolist(), item.tolist(), strict=True)}:
                items[d].add(block.ids[i])
            top = np.flatnonzero(best > 0)
            top = top[np.argsort(best[top], kind="stable")]
            where = np.searchsorted(shard.at, best_at[top])
            last = {d: k for k, d in enumerate(doc[where].tolist())}
            for d, k in last.items():
                if best[top[k]] > longest[d][0]:
                    longest[d] = (int(best[top[k]]), block.ids[best_item[top[k]]], int(where[k] - first[d]))
        inside = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
        n_hit = inside[first[1:]] - inside[first[:-1]]
        if keep:
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n_hit)], names=[*batch.schema.names[:-1], hit_name])
        named = [",".join(sorted(x)) for x in items]
        cols = [batch.column(0), pa.array(np.diff(first)), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in named]), pa.array(n_hit > 0), pa.array([x[0] for x in longest], pa.int64()), pa.array([x[1] for x in longest], pa.string()), pa.array([x[2] for x in longest], pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=[id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match", "longest_item", "longest_at"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, SHARD_BYTES):
            yield run(part)
            give_back()

    small_batches(docs.sparkSession)
    if keep:
        held = docs.withColumn(fresh(docs, "_shard_text"), F.col(text_col).cast("string"))
        return held.mapInArrow(shards, f"{', '.join(f'`{c}` {k}' for c, k in docs.dtypes)}, {hit_name} long")
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(shards, f"{id_col} {id_kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, longest_item string, longest_at long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """docs without the documents in which a window of the benchmark occurs; all their columns stay."""
    return measure(docs, benchmark, text_col=text_col, item_col=item_col, window=window, keep=True).filter(F.col(fresh(docs, HIT)) == 0).select(*docs.columns)
