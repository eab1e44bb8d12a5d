"""Candidate pairs from a union of equality keys.

A key is an expression over records, with a cap: a block (records of one type with one value) of one
record, or of more than the cap, makes no pairs. Blocks beyond their caps are reported, never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CAP = 250


@dataclass(frozen=True)
class BlockingKey:
    """value gives the key of a record; null and '' leave it out."""

    name: str
    entity_type: str
    value: Callable[[], Column]
    cap: int = DEFAULT_CAP


def both(*names: str) -> Callable[[], Column]:
    """The columns' values joined by |, if all are observed."""

    def value() -> Column:
        ok = F.lit(True)
        for n in names:
            ok &= F.coalesce(F.col(n).cast("string"), F.lit("")) != ""
        return F.when(ok, F.concat_ws("|", *(F.col(n).cast("string") for n in names)))

    return value


def _initial_postcode() -> Column:
    return F.when((F.col("last_name") != "") & (F.col("first_name") != "") & (F.col("postcode") != ""), F.concat_ws("|", "last_name", F.substring("first_name", 1, 1), "postcode"))


def _head_postcode() -> Column:
    return F.when((F.col("name_fp") != "") & (F.col("postcode") != ""), F.concat_ws("|", F.split_part("name_fp", F.lit(" "), F.lit(1)), "postcode"))


def _address_head() -> Column:
    return F.when((F.col("address_blk") != "") & (F.col("name_fp") != ""), F.concat_ws("|", "address_blk", F.substring("name_fp", 1, 4)))


KEYS = (
    BlockingKey("p_fp_dob", "Person", both("name_fp", "birth_year"), 200),
    BlockingKey("p_fp", "Person", both("name_fp"), 300),
    BlockingKey("p_phon_dob", "Person", both("name_phonetic", "birth_year"), 200),
    BlockingKey("p_last_dob", "Person", both("last_name", "birth_year"), 200),
    BlockingKey("p_first_dob", "Person", both("first_name", "birth_year"), 200),
    BlockingKey("p_last_init_pc", "Person", _initial_postcode, 100),
    BlockingKey("p_dob_pc", "Person", both("birth_year", "postcode"), 100),
    BlockingKey("c_reg", "Company", both("reg_number"), 50),
    BlockingKey("c_fp", "Company", both("name_fp"), 300),
    BlockingKey("c_phon", "Company", both("name_phonetic"), 300),
    BlockingKey("c_head_pc", "Company", _head_postcode, 100),
    BlockingKey("c_addr", "Company", _address_head, 100),
)


def blocking_keys(records: DataFrame, keys: Sequence[BlockingKey] = KEYS) -> DataFrame:
    """record_id, key_name, key_value, entity_type: all keys in one pass over records."""
    made = F.array(*(F.struct(F.lit(k.name).alias("key_name"), F.when(F.col("entity_type") == k.entity_type, k.value()).alias("key_value")) for k in keys))
    return records.select("record_id", F.explode(made).alias("k"), "entity_type").select("record_id", "k.key_name", "k.key_value", "entity_type").filter("key_value <> ''")


def _cap(keys: Sequence[BlockingKey]) -> Column:
    caps = F.create_map(*[F.lit(x) for k in keys for x in (k.name, k.cap)])
    return F.coalesce(F.try_element_at(caps, F.col("key_name")), F.lit(DEFAULT_CAP))


def block_sizes(made: DataFrame, keys: Sequence[BlockingKey] = KEYS) -> DataFrame:
    """key_name, key_value, n, usable."""
    return made.groupBy("key_name", "key_value").agg(F.count("*").alias("n")).withColumn("usable", (F.col("n") > 1) & (F.col("n") <= _cap(keys)))


def candidate_pairs(made: DataFrame, keys: Sequence[BlockingKey] = KEYS) -> DataFrame:
    """left_id < right_id, the names of the keys that they share (sorted), and their number.

    Usable blocks are found by partial counts and only their rows go on to the join, so that no block
    has more than a cap's rows: a frequent value is gone before anything is paired.
    """
    usable = block_sizes(made, keys).filter("usable").select("key_name", "key_value")
    rows = made.join(usable, ["key_name", "key_value"]).select("key_name", "key_value", "record_id")
    a, b = rows.withColumnRenamed("record_id", "left_id"), rows.withColumnRenamed("record_id", "right_id")
    pairs = a.join(b, ["key_name", "key_value"]).filter("left_id < right_id")
    return pairs.groupBy("left_id", "right_id").agg(F.array_sort(F.collect_set("key_name")).alias("block_keys")).withColumn("n_keys", F.size("block_keys"))


def report(made: DataFrame, keys: Sequence[BlockingKey] = KEYS) -> DataFrame:
    """Per key its blocks, usable and oversized ones, the largest, and the pairs that the usable make."""
    s = block_sizes(made, keys)
    return s.groupBy("key_name").agg(
        F.count("*").alias("blocks"),
        F.count_if("usable").alias("usable_blocks"),
        F.count_if(F.col("n") > _cap(keys)).alias("oversized_blocks"),
        F.max("n").alias("largest_block"),
        F.coalesce(F.sum(F.when(F.col("usable"), F.expr("n * (n - 1) div 2"))), F.lit(0)).cast("long").alias("pairs"),
    )


def completeness(made: DataFrame, truth: DataFrame, keys: Sequence[BlockingKey] = KEYS) -> DataFrame:
    """Per key the part of true pairs (left_id, right_id) that its usable blocks hold."""
    usable = block_sizes(made, keys).filter("usable").select("key_name", "key_value")
    rows = made.join(usable, ["key_name", "key_value"]).select("key_name", "key_value", "record_id")
    left = truth.join(rows.withColumnRenamed("record_id", "left_id"), "left_id")
    found = left.join(rows.withColumnRenamed("record_id", "right_id"), ["right_id", "key_name", "key_value"]).select("key_name", "left_id", "right_id").distinct()
    total = truth.agg(F.count("*").alias("total"))
    return found.groupBy("key_name").agg(F.count("*").alias("found")).crossJoin(F.broadcast(total)).select("key_name", "found", (F.col("found") / F.col("total")).alias("completeness"))


def reduction(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """records, naive_pairs (of all records), candidate_pairs and reduction_ratio, in one row."""
    n = records.agg(F.count("*").alias("records"))
    p = pairs.agg(F.count("*").alias("candidate_pairs"))
    return n.crossJoin(p).withColumn("naive_pairs", F.expr("records * (records - 1) div 2")).withColumn("reduction_ratio", F.when(F.col("naive_pairs") > 0, 1 - F.col("candidate_pairs") / F.col("naive_pairs")).otherwise(0.0))


def skipped(made: DataFrame, keys: Sequence[BlockingKey] = KEYS) -> DataFrame:
    """The blocks beyond their caps, with their size."""
    w = Window.partitionBy("key_name")
    return block_sizes(made, keys).filter(F.col("n") > _cap(keys)).select("key_name", "key_value", "n").withColumn("blocks_of_key", F.count("*").over(w))
