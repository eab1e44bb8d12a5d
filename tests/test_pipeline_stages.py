import numpy as np
import pytest
from pyspark.sql import functions as F

from linkgraph.operators import adjudicator, evaluate, fellegi_sunter, graph
from linkgraph.plans import pipeline
from linkgraph.sources import synth


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    paths = synth.generate(folder / "in", companies=200, people=100, sanctioned=20)
    s = pipeline.Store(spark, f"{folder}/out")
    s.truth = paths.pop("truth")
    pipeline.run_all(s, **paths)
    return s


def test_invariants(store):
    records, found, scores = store.get("records"), store.get("clusters"), store.get("pair_scores_rules")
    assert records.count() == records.select("record_id").distinct().count() == found.count()
    assert scores.filter("left_id >= right_id or score < 0 or score > 1").count() == 0
    joined = found.join(records.select("record_id", "entity_type", "birth_year"), "record_id").groupBy("canonical_id")
    assert joined.agg(F.count_distinct("entity_type").alias("n")).filter("n > 1").count() == 0
    assert joined.agg(F.count_distinct("birth_year").alias("n")).filter("n > 1").count() == 0
    closure = store.get("control_closure")
    assert closure.filter("hops > 6 or size(path) <> hops + 1 or min_share > max_share").count() == 0
    impact = store.get("resolution_impact").collect()[0]
    assert impact.records_absorbed_by_merging > 0 and impact.cross_source_entities > 0


def test_quality_floors(store):
    people, links = pipeline.truth(store, store.truth)
    truth = evaluate.truth_pairs(people, store.get("records"))
    m = evaluate.pairwise(store.get("pair_scores_rules"), truth, store.get("candidate_pairs")).collect()[0]
    # Alias and sanctions records aren't labelled, so precision is of labelled pairs only.
    assert m.recall >= 0.80 and m.blocking_recall >= 0.85
    b = evaluate.bcubed(store.get("clusters"), people).collect()[0]
    assert b.f1 >= 0.92
    assert evaluate.held_out(links, store.get("clusters"), store.get("candidate_pairs")).collect()[0].recall >= 0.85


def test_clusters_are_the_same_again(store):
    before = sorted(map(tuple, store.get("clusters").select("record_id", "canonical_id").collect()))
    pipeline.cluster(store)
    assert sorted(map(tuple, store.get("clusters").select("record_id", "canonical_id").collect())) == before


def test_serving_exposure_equals_closure(store):
    index = pipeline.serve(store)
    edges = index["edges"].filter("is_active")
    risky = index["entities"].filter("is_sanctioned").select(F.col("canonical_id").alias("root_id"))
    live = graph.walk(edges, risky).select("asset_id", "root_id").distinct().count()
    assert index["sanctions_exposure"].count() == live > 0


def test_em(store):
    p = fellegi_sunter.train(store.get("records"), "Person")
    assert all(b >= a - 1e-6 for a, b in zip(p.likelihood, p.likelihood[1:], strict=False))
    assert all(abs(m.sum() - 1) < 1e-9 for m in p.m) and p.m[0][0] > p.u[0][0]
    scored = fellegi_sunter.score(store.get("candidate_pairs"), store.get("records"), "Person", p)
    people, _ = pipeline.truth(store, store.truth)
    m = evaluate.pairwise(scored, evaluate.truth_pairs(people, store.get("records")), store.get("candidate_pairs")).collect()[0]
    assert m.recall > 0.5 and scored.filter("score < 0.41").count() == 0


def test_em_finds_planted_parameters():
    rng = np.random.default_rng(1)
    m, u, prior = [np.array([0.9, 0.1]), np.array([0.8, 0.2]), np.array([0.95, 0.05])], [np.array([0.1, 0.9]), np.array([0.2, 0.8]), np.array([0.05, 0.95])], 0.3
    match = rng.random(60000) < prior
    g = np.stack([np.where(rng.random(60000) < np.where(match, a[0], b[0]), 0, 1) for a, b in zip(m, u, strict=True)], 1)
    patterns, counts = np.unique(g, axis=0, return_counts=True)
    p = fellegi_sunter.expectation_maximisation(patterns, counts.astype(float), u, 0.1, 500)
    assert abs(p.prior - prior) < 0.02 and all(abs(a[0] - b[0]) < 0.03 for a, b in zip(p.m, m, strict=True))


@pytest.mark.parametrize("answer, verdict", [('{"verdict": "same", "confidence": 2}', "same"), ('```json\n{"verdict": "DIFFERENT"}\n```', "different"), ('Sure: {"verdict": "same", "confidence": "x"} ok', "unclear"), ("no json", "unclear"), (None, "unclear"), ('{"verdict": "maybe"}', "unclear"), ("[1]", "unclear")])
def test_verdicts(answer, verdict):
    got = adjudicator.parse_verdict(answer)
    assert got[0] == verdict and 0 <= got[1] <= 1


def test_adjudication(store):
    scores = store.get("pair_scores_rules").withColumn("decision", F.when(F.pmod(F.xxhash64("left_id", "right_id"), F.lit(10)) == 0, "uncertain").otherwise(F.col("decision")))
    scores = scores.withColumn("score", F.when(F.col("decision") == "uncertain", 0.7).otherwise(F.col("score")))
    judged, cache = adjudicator.adjudicate(scores, store.get("records"), adjudicator.offline_judge, ceiling=1.0)
    assert judged.count() == scores.count() and cache.count() > 0

    def broken(_: str) -> str:
        raise OSError

    again, kept = adjudicator.adjudicate(scores, store.get("records"), broken, cache=cache, ceiling=1.0)
    assert sorted(map(tuple, again.select("left_id", "right_id", "score").collect())) == sorted(map(tuple, judged.select("left_id", "right_id", "score").collect()))
    _, nothing = adjudicator.adjudicate(scores, store.get("records"), broken, ceiling=1.0)
    assert nothing.count() == 0  # failures aren't cached
    with pytest.raises(ValueError):
        adjudicator.adjudicate(scores, store.get("records"), adjudicator.offline_judge, ceiling=0.0001)
