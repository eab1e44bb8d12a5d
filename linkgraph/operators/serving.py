"""Tables that answer questions about entities, and the questions.

The tables are written once by batch; a question is a filter and a small join over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.functions.text import search_form
from linkgraph.operators import graph

TABLES = ("entities", "edges", "name_index", "sanctions_exposure", "meta")
TIERS = {3: "exact", 2: "prefix", 1: "contains"}


def name_index(entities: DataFrame) -> DataFrame:
    """canonical_id, variant, variant_norm, is_primary of every name of every entity."""
    names = F.array_distinct(F.array_compact(F.concat(F.coalesce("all_names", F.array().cast("array<string>")), F.array("name"))))
    rows = entities.select("canonical_id", "name", F.explode(names).alias("variant")).filter(F.trim("variant") != "")
    return rows.select("canonical_id", "variant", search_form(F.col("variant")).alias("variant_norm"), (F.col("variant") == F.col("name")).alias("is_primary"))


def build(entities: DataFrame, relationships: DataFrame, clusters: DataFrame | None, path: str | None = None) -> dict[str, DataFrame]:
    """The five tables, written as Parquet below path if it is given."""
    ents = graph.nodes(entities)
    merged = graph.edges(relationships, clusters, merge_before_filter=True)
    exposure = graph.flagged_exposure(ents, merged)
    out = {"entities": ents, "edges": merged, "name_index": name_index(ents), "sanctions_exposure": exposure}
    counts = [t.agg(F.count("*").cast("string").alias("value")).select(F.lit(k).alias("key"), "value") for k, t in out.items()]
    meta = counts[0]
    for c in counts[1:]:
        meta = meta.unionByName(c)
    out["meta"] = meta.unionByName(exposure.agg(F.count_distinct("asset_id").cast("string").alias("value")).select(F.lit("companies_exposed").alias("key"), "value"))
    if path:
        for k, t in out.items():
            t.write.mode("overwrite").parquet(f"{path}/{k}")
        return load(entities.sparkSession, path)
    return out


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {k: spark.read.parquet(f"{path}/{k}") for k in TABLES}


def search(index: dict[str, DataFrame], question: str, limit: int = 20, raw: bool = False) -> DataFrame:
    """Entities by name: an equal name before one that begins so before one that contains it, then primary names, flagged entities, those of more records, name and id.

    The question is normalised as names are; raw only lowers it and joins its spaces.
    """
    spark = index["entities"].sparkSession
    needle = F.lit(" ".join(question.lower().split())) if raw else search_form(F.lit(question))
    asked = spark.range(1).select(needle.alias("q"))
    hits = index["name_index"].crossJoin(F.broadcast(asked)).filter(F.contains("variant_norm", F.col("q")) & (F.col("q") != ""))
    tier = F.when(F.col("variant_norm") == F.col("q"), 3).when(F.startswith("variant_norm", F.col("q")), 2).otherwise(1)
    best = hits.groupBy("canonical_id").agg(F.max(tier).alias("tier"), F.max(F.col("is_primary").cast("int")).alias("primary_hit"), F.min("variant").alias("matched_on"))
    links = index["sanctions_exposure"].groupBy(F.col("asset_id").alias("canonical_id")).agg(F.count("*").alias("exposure_links"))
    out = index["entities"].join(best, "canonical_id").join(links, "canonical_id", "left").fillna(0, ["exposure_links"])
    return out.orderBy(F.desc("tier"), F.desc("primary_hit"), F.desc("is_sanctioned"), F.desc("n_records"), "name", "canonical_id").limit(limit)


def entity(index: dict[str, DataFrame], canonical_id: str) -> DataFrame:
    """One entity with the number of its owners, assets and exposure links; no row if there is none."""
    e = index["edges"].filter("is_active")
    counts = e.agg(F.count_if(F.col("asset_id") == canonical_id).alias("n_owners"), F.count_if(F.col("owner_id") == canonical_id).alias("n_assets")).crossJoin(index["sanctions_exposure"].agg(F.count_if(F.col("asset_id") == canonical_id).alias("exposure_links")))
    return index["entities"].filter(F.col("canonical_id") == canonical_id).crossJoin(counts)


def ownership(index: dict[str, DataFrame], canonical_id: str, direction: str = "down", max_hops: int = graph.MAX_HOPS) -> DataFrame:
    return graph.ownership(index["edges"].filter("is_active"), canonical_id, direction, max_hops)


def exposure_of(index: dict[str, DataFrame], canonical_id: str) -> DataFrame:
    """The exposure paths to one entity, with the names along them, shortest first."""
    own = index["sanctions_exposure"].filter(F.col("asset_id") == canonical_id)
    steps = own.select("asset_id", "risk_id", F.posexplode("path_ids").alias("pos", "canonical_id")).join(index["entities"].select("canonical_id", "name"), "canonical_id", "left")
    names = steps.groupBy("asset_id", "risk_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("name", F.col("canonical_id")).alias("name")))), lambda x: x["name"]).alias("path_names"))
    return own.join(names, ["asset_id", "risk_id"]).orderBy("hops", F.desc_nulls_last("max_percent"), "risk_id")


def exposed(index: dict[str, DataFrame], min_hops: int = 1, limit: int = 50) -> DataFrame:
    """Exposed entities, those whose shortest path of at least min_hops is longest first."""
    near = index["sanctions_exposure"].filter(F.col("hops") >= min_hops).groupBy(F.col("asset_id").alias("canonical_id")).agg(F.min("hops").alias("shortest"), F.count("*").alias("n_owners"))
    return index["entities"].join(near, "canonical_id").orderBy(F.desc("shortest"), F.desc("n_owners"), "name", "canonical_id").limit(limit)


def overview(index: dict[str, DataFrame]) -> DataFrame:
    """Totals in one row. companies_exposed counts each company once; exposed_by_level sums it over path lengths."""
    totals = index["entities"].agg(
        F.count("*").alias("entities"), F.count_if(F.col("entity_type") == "Company").alias("companies"), F.count_if(F.col("entity_type") == "Person").alias("people"), F.coalesce(F.sum("n_records"), F.lit(0)).alias("source_records"),
        F.count_if(F.size("sources") > 1).alias("cross_source"), F.count_if(F.col("n_records") > 1).alias("merged"), F.count_if("is_sanctioned").alias("sanctioned"), F.count_if("is_pep").alias("peps"),
    )
    links = index["edges"].agg(F.count("*").alias("edges"), F.count_if("is_active").alias("active_edges"))
    by_asset = index["sanctions_exposure"].groupBy("asset_id").agg(F.min("hops").alias("h"), F.count_distinct("hops").alias("levels")).agg(F.count("*").alias("companies_exposed"), F.count_if(F.col("h") >= 2).alias("indirect_only"), F.coalesce(F.sum("levels"), F.lit(0)).alias("exposed_by_level"))
    return totals.crossJoin(links).crossJoin(by_asset)


def exposure_histogram(index: dict[str, DataFrame]) -> DataFrame:
    return index["sanctions_exposure"].groupBy("hops").agg(F.count_distinct("asset_id").alias("companies"))


def merge_histogram(index: dict[str, DataFrame]) -> DataFrame:
    return index["entities"].groupBy("n_records").agg(F.count("*").alias("entities"))


def top_controllers(index: dict[str, DataFrame], limit: int = 8) -> DataFrame:
    n = index["edges"].filter("is_active").groupBy(F.col("owner_id").alias("canonical_id")).agg(F.count_distinct("asset_id").alias("controls"))
    return index["entities"].join(n, "canonical_id").select("canonical_id", "name", "controls").orderBy(F.desc("controls"), "canonical_id").limit(limit)
