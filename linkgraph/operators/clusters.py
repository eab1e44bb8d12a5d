"""Clusters of accepted pairs under constraints, and the entity that each stands for."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.operators.components import connected_components


@dataclass(frozen=True)
class ConflictRule:
    """A cluster may have at most so many different observed values of the column."""

    entity_type: str
    column: str
    max_distinct: int


RULES = (ConflictRule("Person", "birth_year", 1), ConflictRule("Person", "nationality", 2), ConflictRule("Company", "reg_number", 1), ConflictRule("Company", "jurisdiction", 2))


def observed(name: str) -> Column:
    return F.nullif(F.col(name).cast("string"), F.lit(""))


def conflicts(members: DataFrame, rules: Sequence[ConflictRule]) -> DataFrame:
    """Of members (component and the rules' columns) the components that break a rule, with the numbers of different values."""
    counts = members.groupBy("component").agg(*(F.count_distinct(observed(r.column)).alias(f"n_{r.column}") for r in rules))
    broken = F.lit(False)
    for r in rules:
        broken |= F.col(f"n_{r.column}") > r.max_distinct
    return counts.filter(broken)


def split_component(members: pd.DataFrame, edges: pd.DataFrame, rules: Sequence[ConflictRule]) -> dict[str, str]:
    """Cluster (its smallest member) of each member: the strongest edges first, each merging two groups unless the union breaks a rule.

    Edges of equal score go by left_id, right_id.
    """
    group = {m: m for m in members["record_id"]}
    held = {m: [m] for m in group}
    values = {m: [{v} if v is not None and v == v and str(v) != "" else set() for v in row] for m, *row in members[["record_id", *(r.column for r in rules)]].itertuples(index=False)}
    for a, b in edges.sort_values(["score", "left_id", "right_id"], ascending=[False, True, True])[["left_id", "right_id"]].itertuples(index=False):
        x, y = group[a], group[b]
        if x == y:
            continue
        union = [p | q for p, q in zip(values[x], values[y], strict=True)]
        if any(len(u) > r.max_distinct for u, r in zip(union, rules, strict=True)):
            continue
        if len(held[x]) < len(held[y]):
            x, y = y, x
        for m in held[y]:
            group[m] = x
        held[x] += held.pop(y)
        values[x] = union
    return {m: min(ms) for ms in held.values() for m in ms}


def build_clusters(records: DataFrame, scores: DataFrame, matcher: str = "rules", rules: Sequence[ConflictRule] = RULES, split_conflicts: bool = True, include_uncertain: bool = False) -> DataFrame:
    """record_id, canonical_id, cluster_size, split_round, matcher of every record.

    Records of all types are clustered, those without accepted pairs alone. Only components that break a
    rule are split, each in a task of its own; such a component is as large as a wrong merge lets it grow.
    """
    good = ["accept", "uncertain"] if include_uncertain else ["accept"]
    edges = scores.filter(F.col("decision").isin(good) & (F.col("matcher") == matcher)).select("left_id", "right_id", "score")
    types = records.select("record_id", "entity_type")
    edges = edges.join(types.select(F.col("record_id").alias("left_id"), F.col("entity_type").alias("_l")), "left_id").join(types.select(F.col("record_id").alias("right_id"), F.col("entity_type").alias("_r")), "right_id").filter("_l = _r").drop("_l", "_r")
    parts = connected_components(edges, "left_id", "right_id").withColumnRenamed("node", "record_id")
    slim = records.select("record_id", "entity_type", *sorted({r.column for r in rules}))
    members = slim.join(parts, "record_id")
    clusters = parts.select("record_id", F.col("component").alias("cluster"), F.lit(0).alias("split_round"))
    if split_conflicts:
        split: DataFrame | None = None
        broken_all: DataFrame | None = None
        for kind in sorted({r.entity_type for r in rules}):
            own = [r for r in rules if r.entity_type == kind]
            broken = conflicts(members.filter(F.col("entity_type") == kind), own).select("component")
            m = members.filter(F.col("entity_type") == kind).join(broken, "component").select("component", "record_id", *(F.col(r.column).cast("string").alias(r.column) for r in own))
            e = edges.join(parts.select(F.col("record_id").alias("left_id"), F.col("component").alias("part")), "left_id").join(broken.select(F.col("component").alias("part")), "part").select(F.col("part").alias("component"), "left_id", "right_id", "score")

            def run(left: pd.DataFrame, right: pd.DataFrame, *, own: list[ConflictRule] = own) -> pd.DataFrame:  # of three positional ones Spark would make the first the key
                got = split_component(left, right, own)
                return pd.DataFrame({"record_id": pd.Series(list(got), dtype=object), "cluster": pd.Series(list(got.values()), dtype=object)})

            done = m.groupBy("component").cogroup(e.groupBy("component")).applyInPandas(run, "record_id string, cluster string").withColumn("split_round", F.lit(1))
            split = done if split is None else split.unionByName(done)
            broken_all = broken if broken_all is None else broken_all.unionByName(broken)
        if split is not None and broken_all is not None:
            whole = parts.join(broken_all, "component", "left_anti").select("record_id", F.col("component").alias("cluster"), F.lit(0).alias("split_round"))
            clusters = whole.unionByName(split)
    found = types.join(clusters, "record_id", "left").select("record_id", F.coalesce("cluster", "record_id").alias("cluster"), F.coalesce("split_round", F.lit(0)).alias("split_round"))
    sizes = found.groupBy("cluster").agg(F.count("*").cast("int").alias("cluster_size"))
    return found.join(sizes, "cluster").select("record_id", F.concat(F.lit("ent:"), "cluster").alias("canonical_id"), "cluster_size", "split_round", F.lit(matcher).alias("matcher"))


def _mode(name: str) -> Column:
    """The most frequent observed value, of equals the smallest; '' if none."""
    return F.mode(observed(name), True)


def canonical_entities(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row per cluster: most frequent values, and all names, topics, sources and records, sorted."""
    text = ["name", "nationality", "country", "jurisdiction", "reg_number", "postcode"]
    joined = records.join(clusters.select("record_id", "canonical_id"), "record_id")
    return joined.groupBy("canonical_id").agg(
        F.min("entity_type").alias("entity_type"),
        *(F.coalesce(_mode(c), F.lit("")).alias(c) for c in text),
        F.mode("birth_year", True).alias("birth_year"),
        F.array_sort(F.collect_set(observed("name"))).alias("all_names"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("topics", F.array().cast("array<string>")))))).alias("topics"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.array_sort(F.collect_set("record_id")).alias("record_ids"),
        F.count("*").alias("n_records"),
    )
