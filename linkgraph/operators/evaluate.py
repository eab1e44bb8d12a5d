"""Measures of pairs and clusters against known truth. Sets without members measure 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def f1(p: str, r: str) -> Column:
    return ratio(2 * F.col(p) * F.col(r), F.col(p) + F.col(r))


def truth_pairs(truth: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """left_id < right_id of records with one truth_id; of those in records only, if given.

    Aliases of one upstream entity (ids that differ in their #n) are one member.
    """
    members = truth.select("truth_id", F.regexp_replace("record_id", "#[0-9]+$", "").alias("record_id")).distinct()
    if records is not None:
        members = members.join(records.select("record_id"), "record_id", "left_semi")
    a, b = members.withColumnRenamed("record_id", "left_id"), members.withColumnRenamed("record_id", "right_id")
    return a.join(b, "truth_id").filter("left_id < right_id").select("left_id", "right_id").distinct()


def pairwise(scores: DataFrame, truth: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """Precision, recall and F1 of accepted pairs; blocking_recall and recall_within_candidates."""
    cand = (candidates if candidates is not None else scores).select("left_id", "right_id").distinct()
    true = truth.withColumn("_t", F.lit(1))
    all_true = truth.agg(F.count("*").alias("true_pairs"))
    blocked = cand.join(true, ["left_id", "right_id"]).agg(F.count("*").alias("true_candidates"))
    got = scores.filter("decision = 'accept'").join(true, ["left_id", "right_id"], "left").agg(F.count("*").alias("accepted"), F.count("_t").alias("true_positives"))
    row = got.crossJoin(all_true).crossJoin(blocked)
    row = row.withColumns({"precision": ratio(F.col("true_positives"), F.col("accepted")), "recall": ratio(F.col("true_positives"), F.col("true_pairs")), "blocking_recall": ratio(F.col("true_candidates"), F.col("true_pairs")), "recall_within_candidates": ratio(F.col("true_positives"), F.col("true_candidates"))})
    return row.withColumn("f1", f1("precision", "recall"))


def bcubed(clusters: DataFrame, truth: DataFrame) -> DataFrame:
    """B-cubed precision, recall and F1 over labelled records, from counts of records by predicted and true cluster."""
    cells = clusters.select("record_id", "canonical_id").join(truth.select("record_id", "truth_id"), "record_id").groupBy("canonical_id", "truth_id").agg(F.count("*").alias("n"))
    pred = cells.groupBy("canonical_id").agg(F.sum("n").alias("np"), F.count("*").alias("kp"))
    true = cells.groupBy("truth_id").agg(F.sum("n").alias("nt"), F.count("*").alias("kt"))
    both = cells.join(pred, "canonical_id").join(true, "truth_id")
    out = both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.count_distinct("canonical_id").alias("predicted_clusters"), F.count_distinct("truth_id").alias("true_clusters"),
        F.coalesce(F.sum(F.col("n") * F.col("n") / F.col("np")), F.lit(0.0)).alias("_p"), F.coalesce(F.sum(F.col("n") * F.col("n") / F.col("nt")), F.lit(0.0)).alias("_r"),
        F.coalesce(F.sum(F.when(F.col("kp") > 1, F.col("n"))), F.lit(0)).alias("over_merged"), F.coalesce(F.sum(F.when(F.col("kt") > 1, F.col("n"))), F.lit(0)).alias("under_merged"),
        F.coalesce(F.max("np"), F.lit(0)).alias("largest_predicted"), F.coalesce(F.max("nt"), F.lit(0)).alias("largest_true"),
    )
    return out.withColumns({"precision": ratio(F.col("_p"), F.col("records")), "recall": ratio(F.col("_r"), F.col("records"))}).withColumn("f1", f1("precision", "recall")).drop("_p", "_r")


def sweep(scores: DataFrame, truth: DataFrame, steps: int = 40) -> DataFrame:
    """threshold i / steps, accepted, precision, recall, f1 for i from 0 to steps; one pass counts, the steps are summed from above."""
    total = truth.agg(F.count("*").alias("true_pairs"))
    marked = scores.select("left_id", "right_id", "score").join(truth.withColumn("_t", F.lit(1)), ["left_id", "right_id"], "left")
    counts = marked.groupBy(F.least(F.floor(F.col("score") * steps), F.lit(steps)).alias("i")).agg(F.count("*").alias("n"), F.count("_t").alias("t"))
    grid = scores.sparkSession.range(steps + 1).select(F.col("id").alias("i"))
    w = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)  # steps + 1 rows
    rows = grid.join(counts, "i", "left").fillna(0, ["n", "t"]).select("i", F.sum("n").over(w).alias("accepted"), F.sum("t").over(w).alias("tp")).crossJoin(total)
    out = rows.select((F.col("i") / steps).alias("threshold"), "accepted", ratio(F.col("tp"), F.col("accepted")).alias("precision"), ratio(F.col("tp"), F.col("true_pairs")).alias("recall"))
    return out.withColumn("f1", f1("precision", "recall"))


def errors(scores: DataFrame, truth: DataFrame, candidates: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """True pairs that weren't accepted, by stage (blocking, matching) and by the corruptions of either record."""
    missed = truth.join(scores.select("left_id", "right_id", "decision"), ["left_id", "right_id"], "left").filter(~F.col("decision").eqNullSafe("accept"))
    missed = missed.join(candidates.select("left_id", "right_id", F.lit(True).alias("_c")), ["left_id", "right_id"], "left").select("left_id", "right_id", F.when(F.col("_c"), "matching").otherwise("blocking").alias("stage"))
    if labels is None:
        return missed.groupBy("stage").agg(F.count("*").alias("missed"))
    own = labels.select("record_id", "corruptions")
    none = F.array().cast("array<string>")
    both = missed.join(own.select(F.col("record_id").alias("left_id"), F.col("corruptions").alias("_l")), "left_id", "left").join(own.select(F.col("record_id").alias("right_id"), F.col("corruptions").alias("_r")), "right_id", "left")
    return both.select("stage", F.explode_outer(F.array_union(F.coalesce("_l", none), F.coalesce("_r", none))).alias("corruption")).groupBy("stage", "corruption").agg(F.count("*").alias("missed"))


def held_out(links: DataFrame, clusters: DataFrame, candidates: DataFrame) -> DataFrame:
    """Of true links (a, b), whichever way round, the parts whose ends share a cluster, and that blocking kept."""
    c = clusters.select("record_id", "canonical_id")
    ends = links.join(c.select(F.col("record_id").alias("a"), F.col("canonical_id").alias("_a")), "a", "left").join(c.select(F.col("record_id").alias("b"), F.col("canonical_id").alias("_b")), "b", "left")
    kept = candidates.select(F.least("left_id", "right_id").alias("_x"), F.greatest("left_id", "right_id").alias("_y")).distinct()
    both = ends.withColumns({"_l": F.least("a", "b"), "_g": F.greatest("a", "b")}).join(kept, (F.col("_l") == F.col("_x")) & (F.col("_g") == F.col("_y")), "left")
    out = both.agg(F.count("*").alias("links"), F.count_if(F.col("_a") == F.col("_b")).alias("resolved"), F.count("_x").alias("blocked"))
    return out.withColumns({"recall": ratio(F.col("resolved"), F.col("links")), "blocking_recall": ratio(F.col("blocked"), F.col("links"))})
