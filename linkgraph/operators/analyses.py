"""Questions about control: who ultimately owns, what is exposed, where chains go dark.

closure is graph.control_closure of active edges; entities has canonical_id, name, entity_type, nationality,
jurisdiction, reg_number, topics, n_records. Top lists end their order with an id, so that they are the same every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph import vocab
from linkgraph.operators.graph import is_flagged, walk


def tops(closure: DataFrame) -> DataFrame:
    """The closure's rows whose root nothing controls."""
    return closure.join(closure.select(F.col("asset_id").alias("root_id")).distinct(), "root_id", "left_anti")


def _of_root(rows: DataFrame, entities: DataFrame) -> DataFrame:
    return rows.join(entities.withColumnRenamed("canonical_id", "root_id"), "root_id")


def percent(c: Column) -> Column:
    return F.round(F.max(c) * 100, 2)


def beneficial_owners(closure: DataFrame, entities: DataFrame, limit: int = 1000) -> DataFrame:
    """Persons whom nothing controls, with what they control."""
    rows = _of_root(tops(closure), entities.filter("entity_type = 'Person'").select("canonical_id", "name", "nationality"))
    out = rows.groupBy(F.col("root_id").alias("owner_id"), F.col("name").alias("owner_name"), "nationality").agg(
        F.count_distinct("asset_id").alias("companies_controlled"), F.max("hops").alias("deepest_chain"), percent(F.col("max_share")).alias("max_indirect_percent"), F.bool_or("via_fiduciary").alias("any_fiduciary_layer")
    )
    return out.orderBy(F.desc("companies_controlled"), F.desc("deepest_chain"), "owner_id").limit(limit)


def sanctions_exposure(closure: DataFrame, entities: DataFrame, limit: int = 1000) -> DataFrame:
    """Companies that a flagged entity reaches; of its names the first three."""
    risky = entities.filter(is_flagged(F.col("topics"))).select(F.col("canonical_id").alias("root_id"), F.col("name").alias("risk_name"))
    target = entities.filter("entity_type <> 'Person'").select(F.col("canonical_id").alias("asset_id"), "name", "reg_number", "jurisdiction")
    out = closure.join(risky, "root_id").join(target, "asset_id").groupBy(F.col("asset_id").alias("company_id"), F.col("name").alias("company_name"), F.col("reg_number").alias("company_number"), "jurisdiction").agg(
        F.min("hops").alias("shortest_hops"), F.count_distinct("root_id").alias("n_sanctioned_owners"), F.slice(F.array_sort(F.collect_set("risk_name")), 1, 3).alias("sanctioned_owners"),
        percent(F.col("max_share")).alias("max_indirect_percent"), F.bool_or("control_only").alias("control_without_equity"), F.bool_or("via_fiduciary").alias("via_fiduciary"),
    )
    return out.orderBy("shortest_hops", F.desc("n_sanctioned_owners"), "company_id").limit(limit)


def opacity(closure: DataFrame, entities: DataFrame) -> DataFrame:
    """Where chains end, in one row of counts."""
    roots = _of_root(tops(closure).select("root_id", "asset_id", "via_fiduciary").distinct(), entities.select("canonical_id", "entity_type", "jurisdiction"))
    company = F.col("entity_type") != "Person"
    ends = roots.agg(
        F.count_distinct(F.when(~company, F.col("asset_id"))).alias("resolves_to_natural_person"),
        F.count_distinct(F.when(company & F.col("jurisdiction").isin(vocab.SECRECY), F.col("asset_id"))).alias("terminates_in_secrecy_jurisdiction"),
        F.count_distinct(F.when(company & ~F.col("jurisdiction").isin(vocab.SECRECY), F.col("asset_id"))).alias("terminates_in_company"),
        F.count_distinct(F.when(F.col("via_fiduciary"), F.col("asset_id"))).alias("chain_via_fiduciary"),
    )
    totals = entities.agg(F.count_if(company).alias("total_companies"), F.count_if(~company).alias("total_people"))
    alone = entities.filter(company).join(closure.select(F.col("asset_id").alias("canonical_id")).distinct(), "canonical_id", "left_anti").agg(F.count("*").alias("companies_without_any_control_edge"))
    return totals.crossJoin(alone).crossJoin(ends)


def opacity_by_jurisdiction(closure: DataFrame, entities: DataFrame, limit: int = 40) -> DataFrame:
    """Jurisdictions in which chains end at a company."""
    last = entities.filter("entity_type <> 'Person' and jurisdiction <> ''").select("canonical_id", "jurisdiction")
    rows = _of_root(tops(closure).select("root_id", "asset_id", "hops").distinct(), last)
    out = rows.groupBy(F.col("jurisdiction").alias("terminal_jurisdiction"), F.col("jurisdiction").isin(vocab.SECRECY).alias("is_secrecy_jurisdiction")).agg(
        F.count_distinct("asset_id").alias("companies_controlled"), F.count_distinct("root_id").alias("controlling_entities"), F.round(F.avg("hops"), 2).alias("mean_hops")
    )
    return out.orderBy(F.desc("companies_controlled"), "terminal_jurisdiction").limit(limit)


def hubs(closure: DataFrame, entities: DataFrame, min_controlled: int = 5, limit: int = 200) -> DataFrame:
    """Entities that control many others, directly or not."""
    rows = _of_root(closure, entities.select("canonical_id", "name", "entity_type", "n_records"))
    out = rows.groupBy(F.col("root_id").alias("entity_id"), F.col("name").alias("entity_name"), "entity_type", F.col("n_records").alias("source_records")).agg(F.count_distinct("asset_id").alias("companies_controlled"), F.max("hops").alias("deepest_chain"))
    return out.filter(F.col("companies_controlled") >= min_controlled).orderBy(F.desc("companies_controlled"), "entity_id").limit(limit)


def direct_hubs(edges: DataFrame, min_controlled: int = 5, limit: int = 200) -> DataFrame:
    """Owners of many active edges."""
    out = edges.filter("is_active").groupBy(F.col("owner_id").alias("entity_id")).agg(F.count_distinct("asset_id").alias("companies_controlled"))
    return out.filter(F.col("companies_controlled") >= min_controlled).orderBy(F.desc("companies_controlled"), "entity_id").limit(limit)


def owners_of(closure: DataFrame, entities: DataFrame, reg_number: str) -> DataFrame:
    """Persons who reach the company of that number, with percentages where every hop has them."""
    target = entities.filter(F.col("reg_number") == reg_number).select(F.col("canonical_id").alias("asset_id"))
    rows = _of_root(closure.join(target, "asset_id"), entities.filter("entity_type = 'Person'").select("canonical_id", "name"))
    return rows.select("root_id", "name", "asset_id", "hops", *(F.when(~F.col("control_only"), F.round(F.col(f"{k}_share") * 100, 4)).alias(f"{k}_percent") for k in ("min", "max")), "control_only", "via_fiduciary", "path")


def flagged_paths(closure: DataFrame, entities: DataFrame, asset: str, limit: int = 10) -> DataFrame:
    """The shortest paths from flagged entities to one."""
    risky = entities.filter(is_flagged(F.col("topics"))).select(F.col("canonical_id").alias("root_id"))
    return closure.filter(F.col("asset_id") == asset).join(risky, "root_id").orderBy("hops", F.array_join("path", "|")).limit(limit)


def nearest_flagged(edges: DataFrame, entities: DataFrame, max_hops: int, owners: int = 5, limit: int = 50) -> DataFrame:
    """Companies that flagged entities reach within max_hops over active edges, with the names of the nearest of these; walks start from the flagged only."""
    if not 1 <= max_hops <= 10:
        raise ValueError("max_hops is from 1 to 10")
    risky = entities.filter(is_flagged(F.col("topics"))).select(F.col("canonical_id").alias("root_id"), F.col("name").alias("risk_name"))
    near = walk(edges.filter("is_active"), risky, max_hops).groupBy("asset_id", "root_id").agg(F.min("hops").alias("hops"), F.max("max_share").alias("share"))
    target = entities.filter("entity_type <> 'Person'").select(F.col("canonical_id").alias("asset_id"), "name")
    listed = F.slice(F.array_sort(F.collect_list(F.struct("hops", "root_id", "risk_name"))), 1, owners)
    out = near.join(risky, "root_id").join(target, "asset_id").groupBy(F.col("asset_id").alias("company_id"), F.col("name").alias("company_name")).agg(
        F.min("hops").alias("shortest_hops"), F.round(F.max("share") * 100, 2).alias("max_percent"), F.count("*").alias("n_owners"), F.transform(listed, lambda x: x["risk_name"]).alias("owners")
    )
    return out.orderBy("shortest_hops", F.desc("n_owners"), "company_id").limit(limit)


def opaque_structures(closure: DataFrame, entities: DataFrame, limit: int = 1000) -> DataFrame:
    """Chains from a company that nothing controls, in a secrecy jurisdiction or through a fiduciary."""
    rows = _of_root(tops(closure), entities.filter("entity_type <> 'Person'").select("canonical_id", "name", "jurisdiction"))
    return rows.filter(F.col("jurisdiction").isin(vocab.SECRECY) | F.col("via_fiduciary")).select("root_id", "name", "jurisdiction", "asset_id", "hops", "via_fiduciary", "path").orderBy(F.desc("hops"), "root_id", F.array_join("path", "|")).limit(limit)


def cross_border(closure: DataFrame, entities: DataFrame, home: str = "GB") -> DataFrame:
    """Foreign jurisdictions in which chains end, with the companies and the mean length."""
    last = entities.filter((F.col("jurisdiction") != "") & (F.col("jurisdiction") != home)).select("canonical_id", "jurisdiction")
    return _of_root(tops(closure), last).groupBy("jurisdiction").agg(F.count_distinct("asset_id").alias("companies"), F.count("*").alias("chains"), F.round(F.avg("hops"), 2).alias("mean_hops"))


def cycle_report(found: DataFrame, entities: DataFrame, limit: int = 100) -> DataFrame:
    named = found.join(entities.select(F.col("canonical_id").alias("root_id"), F.col("name").alias("entity_name")), "root_id", "left")
    return named.select(F.col("root_id").alias("entity_id"), "entity_name", F.col("hops").alias("cycle_length"), F.col("path").alias("cycle")).orderBy("cycle_length", F.array_join("cycle", "|")).limit(limit)


def resolution_impact(records: DataFrame, clusters: DataFrame, closure: DataFrame, entities: DataFrame) -> DataFrame:
    """What resolution changed, in one row."""
    merged = clusters.agg(F.count("*").alias("source_records"), F.count_distinct("canonical_id").alias("canonical_entities"), F.count_if(F.col("cluster_size") > 1).alias("records_in_merged_clusters"), F.max("cluster_size").alias("largest_cluster"))
    crossing = clusters.join(records.select("record_id", "source"), "record_id").groupBy("canonical_id").agg(F.count_distinct("source").alias("n")).agg(F.count_if(F.col("n") > 1).alias("cross_source_entities"))
    indirect = F.col("hops") > 1
    paths = closure.agg(F.count_if(F.col("hops") == 1).alias("one_hop_control_paths"), F.count_if(indirect).alias("multi_hop_control_paths"), F.count_distinct(F.when(indirect, F.col("asset_id"))).alias("companies_with_indirect_owner"))
    risky = closure.join(entities.filter(is_flagged(F.col("topics"))).select(F.col("canonical_id").alias("root_id")), "root_id")
    exposed = risky.agg(F.count_distinct(F.when(~indirect, F.col("asset_id"))).alias("sanctions_direct_exposure"), F.count_distinct(F.when(indirect, F.col("asset_id"))).alias("sanctions_indirect_exposure"))
    return merged.withColumn("records_absorbed_by_merging", F.col("source_records") - F.col("canonical_entities")).crossJoin(crossing).crossJoin(paths).crossJoin(exposed)
