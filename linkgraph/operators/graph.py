"""The control graph: merged edges, and walks over them.

Walks are bounded loops of joins, a level at a time, each level checkpointed; paths are arrays. A walk
may be refused (max_rows) but is never cut short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph import vocab
from linkgraph.operators.components import checkpointed

MAX_HOPS = 6


def edges(relationships: DataFrame, clusters: DataFrame | None = None, merge_before_filter: bool = False) -> DataFrame:
    """Active control edges between entities, one for each owner and asset.

    Ends that no cluster has keep their record's id as an entity. Of several filings the widest band
    and any flag count. By default only filings that haven't ceased are merged; with merge_before_filter all
    are, and an edge is active if any of its filings is.
    """
    rows = relationships if merge_before_filter else relationships.filter("ceased_on is null")
    owner, asset = F.concat(F.lit("ent:"), F.col("source_record_id")), F.concat(F.lit("ent:"), F.col("target_record_id"))
    if clusters is not None:
        named = clusters.select("record_id", "canonical_id")
        rows = rows.join(named.select(F.col("record_id").alias("source_record_id"), F.col("canonical_id").alias("_o")), "source_record_id", "left").join(named.select(F.col("record_id").alias("target_record_id"), F.col("canonical_id").alias("_a")), "target_record_id", "left")
        owner, asset = F.coalesce("_o", owner), F.coalesce("_a", asset)
    out = rows.withColumns({"owner_id": owner, "asset_id": asset}).groupBy("owner_id", "asset_id").agg(
        F.min("min_percent").alias("min_percent"), F.max("max_percent").alias("max_percent"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("control_kinds")))).alias("control_kinds"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("capacities")))).alias("capacities"),
        F.bool_or("has_hard_control").alias("has_hard_control"), F.bool_or("via_fiduciary").alias("via_fiduciary"), F.count("*").alias("n_filings"),
        F.min("notified_on").alias("first_notified"), F.max("ceased_on").alias("last_ceased"), F.bool_or(F.col("ceased_on").isNull()).alias("is_active"),
    )
    return out


def _share(name: str, absent: float) -> Column:
    return F.coalesce(F.col(name), F.lit(absent)) / 100.0


def _step(front: DataFrame, links: DataFrame, back_to_root: bool) -> DataFrame:
    out = front.join(links, front["asset_id"] == links["owner_id"]).drop("owner_id")
    fresh = ~F.array_contains(F.col("path"), F.col("next_id"))
    out = out.filter(fresh | (F.col("next_id") == F.col("root_id")) if back_to_root else fresh)
    return out.select(
        "root_id", F.col("next_id").alias("asset_id"), (F.col("hops") + 1).alias("hops"), (F.col("min_share") * F.col("_min")).alias("min_share"), (F.col("max_share") * F.col("_max")).alias("max_share"),
        (F.col("control_only") | F.col("_control")).alias("control_only"), (F.col("via_fiduciary") | F.col("_fiduciary")).alias("via_fiduciary"), F.array_append("path", F.col("next_id")).alias("path"),
    )


def walk(active: DataFrame, roots: DataFrame | None = None, max_hops: int = MAX_HOPS, back_to_root: bool = False, max_rows: int | None = None) -> DataFrame:
    """All walks of 1 to max_hops edges, from roots (root_id) or from everyone: root_id, asset_id, hops, min_share, max_share, control_only, via_fiduciary, path.

    A walk meets no entity twice, but that its first edge may be a loop; with back_to_root it may return to
    its root, and go on. Shares multiply; an edge without a band counts as 0 to 100 % and marks the
    walk control_only.
    """
    links = checkpointed(active.select("owner_id", F.col("asset_id").alias("next_id"), _share("min_percent", 0).alias("_min"), _share("max_percent", 100).alias("_max"), F.col("min_percent").isNull().alias("_control"), F.coalesce("via_fiduciary", F.lit(False)).alias("_fiduciary")))
    first = links if roots is None else links.join(roots.select(F.col("root_id").alias("owner_id")).distinct(), "owner_id")
    front = first.select(
        F.col("owner_id").alias("root_id"), F.col("next_id").alias("asset_id"), F.lit(1).alias("hops"), F.col("_min").alias("min_share"), F.col("_max").alias("max_share"), F.col("_control").alias("control_only"), F.col("_fiduciary").alias("via_fiduciary"),
        F.array("owner_id", "next_id").alias("path"),
    )
    out = front = checkpointed(front)
    for _ in range(max_hops - 1):
        front = checkpointed(_step(front, links, back_to_root))
        if front.isEmpty():
            break
        out = out.unionByName(front)
        if max_rows is not None and (n := out.count()) > max_rows:
            raise ValueError(f"more than {max_rows} walks ({n}); lower max_hops or start from fewer roots")
    return out


def control_closure(active: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """All control paths of up to max_hops edges that meet no entity twice."""
    return walk(active, max_hops=max_hops)


def cycles(active: DataFrame, max_hops: int = MAX_HOPS, min_hops: int = 1, simple_only: bool = False) -> DataFrame:
    """root_id, hops and path of the walks that end where they began.

    A walk that came back may have gone on, so that figures of eight are found; simple_only leaves them out.
    """
    back = walk(active, max_hops=max_hops, back_to_root=True).filter((F.col("asset_id") == F.col("root_id")) & (F.col("hops") >= min_hops))
    if simple_only:
        back = back.filter(F.size(F.filter("path", lambda x: x == F.col("root_id"))) == 2)
    return back.select("root_id", "hops", "path").distinct()


def chains(active: DataFrame, source: str, target: str, max_hops: int = 8, limit: int = 25) -> DataFrame:
    """The shortest control paths from one entity to another."""
    root = active.sparkSession.createDataFrame([(source,)], "root_id string")
    return walk(active, root, max_hops).filter(F.col("asset_id") == target).orderBy("hops", F.array_join("path", "|")).limit(limit)


def ownership(active: DataFrame, entity: str, direction: str = "down", max_hops: int = MAX_HOPS) -> DataFrame:
    """What an entity controls ('down') or is controlled by ('up'): the shortest path to each, of equals the first by path.

    Percentages are null where a hop has none; rounded to three places. The path begins at the entity.
    """
    rows = active if direction == "down" else active.select(F.col("asset_id").alias("owner_id"), F.col("owner_id").alias("asset_id"), "min_percent", "max_percent", "via_fiduciary")
    found = walk(rows, active.sparkSession.createDataFrame([(entity,)], "root_id string"), max_hops).filter(F.col("asset_id") != F.col("root_id"))
    return _shortest(found, ["asset_id"], 3).select("asset_id", "hops", "min_percent", "max_percent", "control_only", "via_fiduciary", "path")


def _shortest(walks: DataFrame, keys: list[str], digits: int) -> DataFrame:
    """The first walk by (hops, path) of each key; by partial aggregation, so that a frequent key doesn't gather its walks."""
    rest = [c for c in walks.columns if c not in (*keys, "hops", "path")]
    best = walks.groupBy(*keys).agg(F.min(F.struct("hops", "path", *rest)).alias("b")).select(*keys, "b.*")
    return best.withColumns({f"{k}_percent": F.when(~F.col("control_only"), F.round(F.col(f"{k}_share") * 100, digits)) for k in ("min", "max")})


def flagged_exposure(entities: DataFrame, merged: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """asset_id, risk_id, hops, min_percent, max_percent, control_only, via_fiduciary, path_ids: the shortest path from each flagged entity to each that it reaches over active edges."""
    risky = entities.filter(is_flagged(F.col("topics"))).select(F.col("canonical_id").alias("root_id"))
    best = _shortest(walk(merged.filter("is_active"), risky, max_hops), ["asset_id", "root_id"], 4)
    return best.select("asset_id", F.col("root_id").alias("risk_id"), "hops", "min_percent", "max_percent", "control_only", "via_fiduciary", F.col("path").alias("path_ids"))


def is_flagged(topics: Column, of: list[str] = vocab.SANCTION_TOPICS) -> Column:
    return F.exists(F.coalesce(topics, F.array().cast("array<string>")), lambda t: t.isin(of))


def nodes(entities: DataFrame) -> DataFrame:
    """Entities with absent values filled in, and the flags is_sanctioned and is_pep."""
    text = ["name", "nationality", "country", "jurisdiction", "reg_number", "postcode"]
    lists = ["all_names", "topics", "sources"]
    out = entities.withColumns({c: F.coalesce(c, F.lit("")) for c in text} | {c: F.coalesce(c, F.array().cast("array<string>")) for c in lists} | {"entity_type": F.coalesce("entity_type", F.lit("LegalEntity"))})
    return out.withColumns({"is_sanctioned": is_flagged(F.col("topics")), "is_pep": is_flagged(F.col("topics"), vocab.PEP_TOPICS)})
