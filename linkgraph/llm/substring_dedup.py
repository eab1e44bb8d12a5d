"""Substring dedup over a log-structured fingerprint index.

Documents come in batches of rising ids. A batch's fingerprints (anchor and digest of each bundle of
windows, see repeats) become a sorted immutable run, a file for each part of the anchors' hashes. A task
for each part streams the older runs' files of that part past the batch's fingerprints and merges them:
contents that an earlier document has are settled, and where the batch brings a new content under an
anchor that has others, the windows of all of these are verified against one another. Runs are merged,
part by part, when a level has FAN_OUT of them. A run keeps the smallest document of a content, so it
never outgrows the different contents seen. What lies in the index stays where it is: only a batch's own
fingerprints are dealt out. A manifest names the runs, so that an index can be opened again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.llm.common import doc_key, give_back, remove, saved, scratch, small_batches
from linkgraph.llm.repeats import Bundles, Symbols, Unit, cover, occurrences, window_hashes, with_wanted
from linkgraph.llm.warc import file_system

WINDOW = 50
UNIT = Unit("word", WINDOW, 10)
FAN_OUT = 4
BATCHES = 4
#: Rows of a run's file that are read at a time.
READ_ROWS = 1 << 16
_RUN = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("_id", pa.int64())])

Columns = tuple[np.ndarray, np.ndarray, np.ndarray]


def run_file(path: str, run: str, part: int) -> str:
    return f"{path}/{run}/part-{part:06d}.parquet"


def write_part(path: str, run: str, part: int, columns: Columns) -> None:
    """A part of a run, sorted by anchor and digest; complete under its name or not there. A repeated attempt writes the same."""
    fs, name = file_system(run_file(path, run, part))
    fs.create_dir(name.rpartition("/")[0], recursive=True)
    draft = f"{name}.{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(draft, compression=None) as f:
        pq.write_table(pa.table(list(columns), schema=_RUN), f, row_group_size=READ_ROWS, compression="zstd")
    fs.move(draft, name)


def read_part(path: str, run: str, part: int) -> Iterator[Columns]:
    """The rows of a part of a run, in order, some at a time; a part without rows has no file."""
    fs, name = file_system(run_file(path, run, part))
    if fs.get_file_info(name).is_file:
        with fs.open_input_file(name) as f:
            for b in pq.ParquetFile(f).iter_batches(READ_ROWS):
                yield tuple(b.column(k).to_numpy() for k in range(3))


def contents(columns: list[Columns], extra: list[np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """Different (anchor, digest) in their order, each with its smallest document and, if given, the sum of extra."""
    anchor, digest, ids = (np.concatenate(c) for c in zip(*columns, strict=True))
    order = np.lexsort((digest, anchor))
    anchor, digest, ids = anchor[order], digest[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])])) if len(anchor) else np.zeros(0, np.int64)
    out = (anchor[first], digest[first], np.minimum.reduceat(ids, first) if len(first) else ids)
    return out if extra is None else (*out, np.add.reduceat(np.concatenate(extra)[order], first) if len(first) else np.zeros(0, np.int64))


class FingerprintIndex:
    """Levels of runs of (anchor, digest, _id: the smallest document with them) below path, in `parts` files each."""

    def __init__(self, spark: SparkSession, path: str, unit: Unit = UNIT, parts: int | None = None) -> None:
        """Opens the index at path, or begins one there, by default of as many parts as the session has shuffle partitions."""
        self.spark, self.path, self.unit = spark, path, unit
        self.parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.written, self.last = 0, None
        fs, name = file_system(f"{path}/manifest.json")
        if fs.get_file_info(name).is_file:
            with fs.open_input_file(name) as f:
                kept = json.loads(f.read())
            if kept["unit"] != [unit.kind, unit.window, unit.gram]:
                raise ValueError(f"the index holds windows of {kept['unit']}")
            self.parts, self.levels, self.written, self.last = kept["parts"], kept["levels"], kept["written"], kept["last"]

    def commit(self) -> None:
        """From here on the index is what it is now, also for those who open it later."""
        fs, name = file_system(f"{self.path}/manifest.json")
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(f"{name}.new", compression=None) as f:
            f.write(json.dumps({"unit": [self.unit.kind, self.unit.window, self.unit.gram], "parts": self.parts, "levels": self.levels, "written": self.written, "last": self.last}).encode())
        fs.move(f"{name}.new", name)

    def append(self, batch: DataFrame, texts: DataFrame) -> DataFrame:
        """Adds a batch (_id, _text, _key) and returns its windows that start in a document of smaller id, as (_id, _key, first, last).

        Ids are long and above those before; rows without id are left out. texts has the documents of the
        batch and those before it, of which only those with a content to verify are read.
        """
        batch = batch.filter("_id is not null")
        least, most = batch.agg(F.min("_id"), F.max("_id")).first()
        if least is None:
            return self.spark.createDataFrame([], "_id long, _key long, first int, last int")
        if self.last is not None and least <= self.last:
            raise ValueError(f"document {least} comes after document {self.last}")
        run, work = f"run-{self.written}", scratch(self.spark, "substring-batch")
        remove(self.spark, f"{self.path}/{run}")  # what an append that wasn't committed has left
        occ = saved(occurrences(batch, self.unit), f"{work}/windows")
        prints = occ.groupBy("anchor", "digest").agg(F.min("_id").alias("_id"), F.count("*").alias("n"))
        found = saved(self.merged(prints, run), f"{work}/merged")
        known = found.filter("settled").select("anchor", "digest", F.col("_id").alias("_min"))
        hits = saved(occ.join(known, ["anchor", "digest"]).filter("_min < _id").select("_id", "_key", "first", "last"), scratch(self.spark, "substring-hits"))
        hits = hits.unionByName(self.verified(found.filter("mixed").select("anchor", "digest", "_id", F.lit(False).alias("cut")), texts, least))
        self.levels[0].append(run)
        self.written, self.last = self.written + 1, most
        old = self.compact()
        self.commit()
        for name in old:
            remove(self.spark, f"{self.path}/{name}")
        remove(self.spark, work)
        return hits

    def merged(self, prints: DataFrame, run: str) -> DataFrame:
        """Writes prints (anchor, digest, _id, n occurrences) as a run and merge-joins them with the runs before.

        Returns contents with their smallest document: `settled` ones are of the batch and were met before or
        more than once, `mixed` ones lie under an anchor for which the batch has a content that is new, with others.
        """
        path, runs = self.path, [r for level in self.levels for r in level]

        def merge(part: int, own: Columns, n: np.ndarray) -> pa.RecordBatch:
            write_part(path, run, part, own)
            anchors = np.unique(own[0])
            columns, weights = [own], [n]
            for r in runs:
                for rows in read_part(path, r, part):
                    if rows[0][-1] >= anchors[0] and rows[0][0] <= anchors[-1]:
                        there = anchors[np.minimum(np.searchsorted(anchors, rows[0]), len(anchors) - 1)] == rows[0]
                        columns.append(tuple(c[there] for c in rows))
                        weights.append(np.full(int(there.sum()), 1 << 32))
            # Occurrences in the batch count once each, those in history 2**32.
            anchor, digest, ids, weight = contents(columns, weights)
            new, history = weight < 1 << 32, weight >= 1 << 32
            settled = ((weight & 0xFFFFFFFF) > 0) & (history | (weight > 1))
            group = np.cumsum(np.concatenate([[True], anchor[1:] != anchor[:-1]])) - 1
            mixed = ((np.bincount(group) > 1) & (np.bincount(group, new) > 0))[group]
            keep = settled | mixed
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (anchor, digest, ids, settled, mixed)], names=["anchor", "digest", "_id", "settled", "mixed"])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []

            def done() -> pa.RecordBatch:
                t = pa.Table.from_batches(held)
                return merge(t["part"][0].as_py(), tuple(t[c].to_numpy() for c in ("anchor", "digest", "_id")), t["n"].to_numpy())

            for batch in batches:
                part = batch.column(0).to_numpy()
                edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
                for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                    if held and hi > lo and held[0].column(0)[0].as_py() != part[lo]:
                        yield done()
                        held = []
                    if hi > lo:
                        held.append(batch.slice(lo, hi - lo))
            if held:
                yield done()
            give_back()

        part = F.pmod(F.xxhash64("anchor"), F.lit(self.parts)).cast("int")
        dealt = prints.select(part.alias("part"), "anchor", "digest", "_id", "n").repartitionById(self.parts, "part").sortWithinPartitions("part", "anchor", "digest")
        return dealt.mapInArrow(task, "anchor long, digest long, _id long, settled boolean, mixed boolean")

    def verified(self, wanted: DataFrame, texts: DataFrame, least: int) -> DataFrame:
        """Windows of documents from `least` on that wanted contents (anchor, digest, _id) of different bundles share, by 128 bits of the window itself.

        Each content is looked at in its smallest document only: its other documents have all its windows removed already.
        """
        unit = self.unit

        def windows(s: Symbols, b: Bundles, row: np.ndarray, _: np.ndarray) -> list[pa.Array]:
            n = b.last - b.first + 1
            starts = np.repeat(b.first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rows = np.repeat(row, n)
            one, two = window_hashes(s, starts, unit)
            return [pa.array(rows), pa.array(one), pa.array(two), pa.array((starts - s.first[rows]).astype(np.int32))]

        path = scratch(self.spark, "substring-windows")
        found = saved(with_wanted(texts, wanted, "_id", windows, "one long, two long, first int", unit), path)
        first = found.groupBy("one", "two").agg(F.min("_id").alias("_min"), F.max("_id").alias("_max")).filter("_min < _max").select("one", "two", "_min")
        out = saved(found.join(first, ["one", "two"]).filter((F.col("_min") < F.col("_id")) & (F.col("_id") >= least)).select("_id", "_key", "first", F.col("first").alias("last")), scratch(self.spark, "substring-verified"))
        remove(self.spark, path)
        return out

    def compact(self) -> list[str]:
        """Merges the runs of each full level into one of the next; returns the runs that are no longer needed."""
        old, k = [], 0
        while k < len(self.levels):
            if len(self.levels[k]) >= FAN_OUT:
                run, path, runs = f"run-{self.written}", self.path, list(self.levels[k])
                self.written += 1
                remove(self.spark, f"{path}/{run}")

                def task(batches: Iterator[pa.RecordBatch], run: str = run, path: str = path, runs: list[str] = runs) -> Iterator[pa.RecordBatch]:
                    for batch in batches:
                        for part in batch.column(0).to_pylist():
                            columns = [rows for r in runs for rows in read_part(path, r, part)]
                            if columns:
                                write_part(path, run, part, contents(columns))
                    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64())], names=["id"])

                self.spark.range(0, self.parts, 1, self.parts).mapInArrow(lambda batches, task=task: task(batches), "id long").count()
                old += runs
                self.levels[k] = []
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(run)
            k += 1
        return old


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, batches: int = BATCHES) -> DataFrame:
    """What each document keeps without words in windows that also start in a document of smaller id.

    Columns: the id, n_words, n_removed, n_spans (maximal removed runs), kept or kept_sha256. Null and
    empty texts have no words. Ids are integers of any size up to 64 bits; others are an error. Documents
    without id keep all and are compared with nothing; rows of one id don't remove each other's words,
    and each gets its own row. The documents are indexed in `batches` ranges of ids of about as many
    documents each; the result doesn't depend on their number.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"ids must be integers, not {kind}")
    rows = doc_key(docs.withColumn(id_col, F.col(id_col).cast("long")), id_col, text_col)
    small_batches(spark)
    cuts = rows.agg(F.percentile_approx("_id", [k / batches for k in range(1, batches + 1)], 1000)).first()[0] or []
    path = scratch(spark, "fingerprints")
    index, spans, below = FingerprintIndex(spark, path), None, None
    for top in [*sorted({*cuts[:-1]}), None] if cuts else []:
        part = rows if below is None else rows.filter(F.col("_id") > below)
        hits = index.append(part if top is None else part.filter(F.col("_id") <= top), rows)
        spans, below = hits if spans is None else spans.unionByName(hits), top
    remove(spark, path)
    if spans is None:
        spans = spark.createDataFrame([], "_id long, _key long, first int, last int")
    return cover(rows, spans, UNIT, id_col, digests).withColumn(id_col, F.col(id_col).cast(kind))
