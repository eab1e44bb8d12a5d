import datetime
import random

import pandas as pd
from pyspark.sql import functions as F

from linkgraph.operators import analyses, blocking, clusters, evaluate, graph, matching, serving
from linkgraph.operators.components import connected_components

RULES = [r for r in clusters.RULES if r.entity_type == "Person"]


def split(values, edges):
    members = pd.DataFrame(values, columns=["record_id", "birth_year", "nationality"])
    got = clusters.split_component(members, pd.DataFrame(edges, columns=["left_id", "right_id", "score"]), RULES)
    groups = {}
    for k, v in got.items():
        groups.setdefault(v, set()).add(k)
    return sorted(map(sorted, groups.values()))


def test_split_follows_the_strongest_edge():
    members = [("a", "1970", ""), ("b", None, ""), ("c", "1985", "")]
    assert split(members, [("a", "b", 0.97), ("b", "c", 0.94)]) == [["a", "b"], ["c"]]
    assert split(members, [("a", "b", 0.70), ("b", "c", 0.99)]) == [["a"], ["b", "c"]]
    assert split([("a", "", "GB"), ("b", "", "IE"), ("c", "", "FR")], [("a", "b", 0.9), ("b", "c", 0.8)]) == [["a", "b"], ["c"]]


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, k) for k in range(400, 460)] + [(k, k + 1) for k in range(500, 560)] + [(7, 7), (999, 999)]
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    df = spark.createDataFrame([*edges, (None, 3)], "a int, b int")
    assert {r.node: r.component for r in connected_components(df, "a", "b").collect()} == {x: top(x) for x in root}
    assert connected_components(df.limit(0), "a", "b").count() == 0


def people(spark):
    rows = [("r1", "Person", "ann lee", "ann", "lee", 1970, "EC1V 9NR"), ("r2", "Person", "ann lee", "ann", "lee", 1970, "EC1V 9NR"), ("r3", "Person", "ann leigh", "ann", "leigh", 1970, ""), ("r4", "Company", "ann lee", "", "", None, "")]
    base = spark.createDataFrame(rows, "record_id string, entity_type string, name_fp string, first_name string, last_name string, birth_year int, postcode string")
    text = {c: F.lit("") for c in ("name_phonetic", "reg_number", "address_blk", "middle_name", "nationality", "country", "jurisdiction", "address_norm", "legal_form")}
    return base.withColumns(text | {"name": F.col("name_fp"), "name_norm": F.col("name_fp"), "source": F.lit("s"), "birth_month": F.lit(None).cast("int"), "incorporation_date": F.lit(None).cast("date"), "topics": F.array(F.lit("t"))})


def test_blocking_matching_clustering(spark):
    records = people(spark)
    made = blocking.blocking_keys(records)
    pairs = blocking.candidate_pairs(made)
    got = {(r.left_id, r.right_id): r.block_keys for r in pairs.collect()}
    assert got[("r1", "r2")] == sorted(["p_fp", "p_fp_dob", "p_last_dob", "p_first_dob", "p_last_init_pc", "p_dob_pc"]) and got[("r1", "r3")] == ["p_first_dob"]
    assert not any("r4" in p for p in got)
    described = matching.features(pairs, records, "Person")
    scores = {(r.left_id, r.right_id): r for r in matching.score(described, matching.PERSON_WEIGHTS).collect()}
    assert scores[("r1", "r2")].decision == "accept" and all(0 <= s.score <= 1 for s in scores.values())
    assert '"middle_compat":null' in scores[("r1", "r2")].features and scores[("r1", "r2")].rationale.startswith("name_fp_jw=1.00(+2.60)")
    found = clusters.build_clusters(records, matching.score(described, matching.PERSON_WEIGHTS))
    by = {r.record_id: r for r in found.collect()}
    assert len(by) == 4 and by["r1"].canonical_id == by["r2"].canonical_id == "ent:r1" and by["r4"].cluster_size == 1
    canonical = {r.canonical_id: r for r in clusters.canonical_entities(records, found).collect()}
    assert canonical["ent:r1"].record_ids[:2] == ["r1", "r2"] and canonical["ent:r1"].topics == ["t"]


def test_caps_leave_out_whole_blocks(spark):
    key = blocking.BlockingKey("k", "Person", blocking.both("name_fp"), 2)
    records = people(spark).filter("entity_type = 'Person'").withColumn("name_fp", F.lit("same"))
    made = blocking.blocking_keys(records, [key])
    assert blocking.candidate_pairs(made, [key]).count() == 0
    assert [tuple(r) for r in blocking.report(made, [key]).collect()] == [("k", 1, 0, 1, 3, 0)]
    assert blocking.skipped(made, [key]).collect()[0].n == 3


def test_calibration_learns_the_useful_feature(spark):
    rows = [(float(k % 2), 0.5 if k % 3 else None, k % 2) for k in range(200)]
    weights, _ = matching.calibrate(spark.createDataFrame(rows, "a double, b double, label int"), [matching.Weight("a", 0.0, 0.0), matching.Weight("b", 0.0, 0.0)], prior=0.0)
    assert weights[0].agree > 1 and weights[0].disagree < -1 and abs(weights[1].agree) < 0.5


def rels(spark, rows):
    made = [(f"r{k}", a, b, lo, hi, cease) for k, (a, b, lo, hi, cease) in enumerate(rows)]
    df = spark.createDataFrame(made, "rel_id string, source_record_id string, target_record_id string, min_percent double, max_percent double, ceased_on date")
    return df.withColumns({"has_hard_control": F.lit(False), "via_fiduciary": F.col("rel_id") == "r1", "control_kinds": F.array(F.lit("SHARES")), "capacities": F.array().cast("array<string>"), "notified_on": F.lit("2020-01-01").cast("date")})


GRAPH = [("a", "b", 25.0, 50.0, None), ("b", "c", 50.0, 75.0, None), ("c", "a", None, None, None), ("c", "d", 50.0, 75.0, datetime.date(2020, 1, 1)), ("b", "b", 25.0, 50.0, None), ("x", "d", 75.0, 100.0, None)]


def test_walks(spark):
    active = graph.edges(rels(spark, GRAPH))
    closure = graph.control_closure(active)
    paths = {tuple(r.path): r for r in closure.collect()}
    abc = paths[("ent:a", "ent:b", "ent:c")]
    assert (abc.hops, abc.min_share, abc.max_share, abc.control_only, abc.via_fiduciary) == (2, 0.125, 0.375, False, True)
    assert ("ent:c", "ent:d") not in paths and ("ent:b", "ent:b") in paths and paths[("ent:c", "ent:a", "ent:b")].control_only
    assert all(len(p) == r.hops + 1 and r.hops <= 6 for p, r in paths.items())
    simple = {tuple(r.path) for r in graph.cycles(active, simple_only=True, min_hops=2).collect()}
    assert ("ent:a", "ent:b", "ent:c", "ent:a") in simple
    assert {tuple(r.path) for r in graph.cycles(active).collect()} > simple
    merged = {(r.owner_id, r.asset_id): r.is_active for r in graph.edges(rels(spark, GRAPH), merge_before_filter=True).collect()}
    assert merged[("ent:c", "ent:d")] is False
    assert [tuple(r.path) for r in graph.chains(active, "ent:a", "ent:c").collect()] == [("ent:a", "ent:b", "ent:c")]


def test_serving_equals_live_walk(spark):
    ents = spark.createDataFrame([(f"ent:{k}", f"Name {k.upper()}", "Company" if k != "a" else "Person", ["sanction"] if k == "a" else [], 1) for k in "abcdx"], "canonical_id string, name string, entity_type string, topics array<string>, n_records int")
    ents = ents.withColumns({c: F.lit("") for c in ("nationality", "country", "jurisdiction", "reg_number", "postcode")} | {"all_names": F.array("name"), "sources": F.array(F.lit("s"))})
    index = serving.build(ents, rels(spark, GRAPH), None)
    exposure = {r.asset_id: r for r in index["sanctions_exposure"].collect()}
    live = {r.asset_id: r.hops for r in graph.ownership(graph.edges(rels(spark, GRAPH)), "ent:a", "down").collect()}
    assert {k: v.hops for k, v in exposure.items()} == live == {"ent:b": 1, "ent:c": 2}
    assert exposure["ent:c"].min_percent == 12.5
    assert [r.canonical_id for r in serving.search(index, "NAME b").collect()] == ["ent:b"] and serving.search(index, "%").count() == 0
    assert serving.exposure_of(index, "ent:c").collect()[0].path_names == ["Name A", "Name B", "Name C"]
    assert serving.entity(index, "ent:b").collect()[0].n_owners == 2 and serving.entity(index, "none").count() == 0
    assert serving.overview(index).collect()[0].companies_exposed == 2
    closure = graph.control_closure(graph.edges(rels(spark, GRAPH)))
    assert analyses.sanctions_exposure(closure, ents).collect()[0].company_id == "ent:b"
    assert analyses.opacity(closure, ents).collect()[0].total_people == 1


def test_measures(spark):
    truth = spark.createDataFrame([("t1", "a"), ("t1", "b"), ("t1", "b#1"), ("t2", "c")], "truth_id string, record_id string")
    pairs = evaluate.truth_pairs(truth)
    assert [tuple(r) for r in pairs.collect()] == [("a", "b")]
    scores = spark.createDataFrame([("a", "b", 0.95, "accept"), ("a", "c", 0.94, "accept")], "left_id string, right_id string, score double, decision string")
    m = evaluate.pairwise(scores, pairs).collect()[0]
    assert (m.precision, m.recall, m.blocking_recall) == (0.5, 1.0, 1.0)
    sweep = evaluate.sweep(scores, pairs).orderBy("threshold").collect()
    assert len(sweep) == 41 and sweep[0].accepted == 2 and sweep[-1].accepted == 0 and sweep[-1].precision == 0.0
    got = evaluate.bcubed(spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "record_id string, canonical_id string"), truth.filter("record_id <> 'b#1'")).collect()[0]
    assert abs(got.precision - 5 / 9) < 1e-9 and got.recall == 1.0
    assert evaluate.pairwise(scores.limit(0), pairs.limit(0)).collect()[0].f1 == 0.0
