"""The stages from wire formats to answers; each hands over Parquet below one folder, so that each can be run again alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.operators import analyses, blocking, clusters, fellegi_sunter, graph, matching, serving
from linkgraph.sources import registers

TYPES = ("Person", "Company")


class Store:
    """Tables as Parquet below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def put(self, name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        w = df.write.mode("overwrite")
        (w.partitionBy(by) if by else w).parquet(f"{self.folder}/{name}")
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def normalize(store: Store, companies: str | None = None, filings: str | None = None, sanctions: str | None = None, retrieved_at: str = "") -> DataFrame:
    """records, relationships and kinds (the tally of filings); returns the tally."""
    spark, records = store.spark, []
    if companies:
        records.append(registers.read_companies(spark, companies, retrieved_at))
    if sanctions:
        records.append(registers.read_sanctions(spark, sanctions, retrieved_at))
    rows = registers.read_filings(spark, filings) if filings else registers.filing_rows(spark.createDataFrame([], "value string"))
    records.append(registers.filing_records(rows, retrieved_at))
    every = records[0]
    for r in records[1:]:
        every = every.unionByName(r)
    store.put("records", every.dropDuplicates(["record_id"]), by="entity_type")
    store.put("relationships", registers.filing_relationships(rows).dropDuplicates(["rel_id"]))
    return store.put("kinds", registers.kinds(rows))


def block(store: Store) -> DataFrame:
    keys = store.put("blocking_keys", blocking.blocking_keys(store.get("records")))
    store.put("blocking_report", blocking.report(keys))
    return store.put("candidate_pairs", blocking.candidate_pairs(keys))


def _scores(store: Store, one: Callable[[DataFrame, DataFrame, str], DataFrame]) -> DataFrame:
    records, pairs = store.get("records"), store.get("candidate_pairs")
    out = [one(pairs, records, t) for t in TYPES]
    return out[0].unionByName(out[1])


def match(store: Store, matcher: str = "rules") -> DataFrame:
    """pair_scores of one matcher: 'rules', over candidate_pairs, or 'fellegi_sunter', over pairs of its own rules; the other's stay."""
    if matcher == "rules":
        made = _scores(store, lambda p, r, t: matching.score(matching.features(p, r, t), matching.WEIGHTS[t]))
    else:
        made = _scores(store, lambda _, r, t: fellegi_sunter.score(fellegi_sunter.blocked_pairs(r, t), r, t, fellegi_sunter.train(r, t)))
    return store.put(f"pair_scores_{matcher}", made)


def cluster(store: Store, matcher: str = "rules", split_conflicts: bool = True, include_uncertain: bool = False) -> DataFrame:
    records = store.get("records")
    found = store.put("clusters", clusters.build_clusters(records, store.get(f"pair_scores_{matcher}"), matcher, split_conflicts=split_conflicts, include_uncertain=include_uncertain))
    return store.put("canonical_entities", clusters.canonical_entities(records, found))


def analyse(store: Store) -> dict[str, DataFrame]:
    records, found, entities = store.get("records"), store.get("clusters"), store.get("canonical_entities")
    edges = store.put("edges", graph.edges(store.get("relationships"), found))
    closure = store.put("control_closure", graph.control_closure(edges))
    made = {
        "beneficial_owners": analyses.beneficial_owners(closure, entities, 200), "sanctions_exposure_report": analyses.sanctions_exposure(closure, entities, 200), "opacity": analyses.opacity(closure, entities), "opacity_by_jurisdiction": analyses.opacity_by_jurisdiction(closure, entities),
        "hubs": analyses.hubs(closure, entities, 3, 100), "cycles": analyses.cycle_report(graph.cycles(edges), entities, 50), "resolution_impact": analyses.resolution_impact(records, found, closure, entities),
    }
    return {k: store.put(k, v) for k, v in made.items()}


def serve(store: Store) -> dict[str, DataFrame]:
    return serving.build(store.get("canonical_entities"), store.get("relationships"), store.get("clusters"), f"{store.folder}/serving")


def run_all(store: Store, matcher: str = "rules", **inputs: str) -> DataFrame:
    """Every stage; returns what resolution changed."""
    normalize(store, **inputs)
    block(store)
    match(store, matcher)
    cluster(store, matcher)
    out = analyse(store)
    serve(store)
    return out["resolution_impact"]


def truth(store: Store, path: str) -> tuple[DataFrame, DataFrame]:
    """(truth_id, record_id) and (a, b) of registration links, of a corpus' truth."""
    t = store.spark.read.schema("person_clusters map<string, array<string>>, corporate_links map<string, string>").json(path, multiLine=True)
    people = t.select(F.explode("person_clusters").alias("truth_id", "ids")).select("truth_id", F.explode("ids").alias("record_id"))
    return people, t.select(F.explode("corporate_links").alias("a", "b"))
