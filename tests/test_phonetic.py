"""Queries over records with phonetic keys: what the plain ones' SQL leaves out. test_oracle holds them against SQL with Soundex."""

import duckdb
import pytest
from pyspark.sql import functions as F

from linkgraph.functions import text
from linkgraph.operators import blocking, matching
from linkgraph.plans import bridge, queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three parts: two whose names only sound alike, and one like neither."""
    out = tmp_path_factory.mktemp("tables")
    names = [(7, "smith robert"), (14, "smyth rupert"), (21, "azure khaki")]
    spark.createDataFrame([(k, n, "Brand#1", "STEEL", k) for k, n in names], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{out}/part.parquet")
    spark.createDataFrame([(k, f"c{k}", 1, "BUILDING", 0.0) for k in (60, 120, 180, 61)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double").write.parquet(f"{out}/customer.parquet")
    return str(out)


def test_sounding_names_are_blocked_and_weighed(spark, folder):
    keys = queries.QUERIES["block_keys_phonetic"](spark, folder).filter("key_name = 'c_phon'").collect()
    assert {(k.record_id, k.key_value) for k in keys} == {("part:7", "R163 S530"), ("part:14", "R163 S530"), ("part:21", "A260 K200")}
    found = queries.QUERIES["candidate_pairs_phonetic"](spark, folder).filter("contains(block_keys, 'c_phon')").collect()
    assert [(p.left_id, p.right_id) for p in found] == [("part:14", "part:7")]
    f = queries.QUERIES["company_features_phonetic"](spark, folder).filter("left_id = 'part:14' and right_id = 'part:7'").first()
    assert f.ph == 1.0


def test_agreement_adds_its_weight(spark, folder):
    records = bridge.companies(spark, folder)
    pairs = spark.createDataFrame([("part:14", "part:7")], "left_id string, right_id string")
    said = matching.score(matching.features(pairs, records, "Company"), matching.COMPANY_WEIGHTS).first()
    assert "phonetic_exact=1.00(+0.90)" in said.rationale


def test_people_have_phonetic_keys(spark, folder):
    made = blocking.blocking_keys(bridge.people(spark, folder)).filter("key_name = 'p_phon_dob'")
    assert made.count() == 4


def test_soundex_in_sql(spark):
    words = "ashcraft tymczak pfister honeyman rupert hhw jackson o'brien d7d 7up gutierrez vandeusen whhite bbb aa lloyd scharf müller w".split()
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("soundex(w)").collect()]
    want = [duckdb.connect().execute(f"SELECT {queries._SOUNDEX} FROM (SELECT ? AS name_fp)", [w]).fetchone()[0] for w in words]
    assert got == want
    assert spark.createDataFrame([("ashcraft 7up",)], "n string").select(text.phonetic_key(F.col("n"))).first()[0] == "A261 7up"


def test_conflicted_components_are_split(spark):
    from linkgraph.operators import clusters

    records = spark.createDataFrame([("a", "Company", "1"), ("b", "Company", "2"), ("c", "Company", "2")], "record_id string, entity_type string, reg_number string").selectExpr("*", "'' AS jurisdiction", "CAST(NULL AS INT) AS birth_year", "CAST(NULL AS INT) AS birth_month", "'' AS nationality")
    scores = spark.createDataFrame([("a", "b", "rules", 0.93, "accept"), ("b", "c", "rules", 0.99, "accept")], "left_id string, right_id string, matcher string, score double, decision string")
    got = {r.record_id: r.canonical_id for r in clusters.build_clusters(records, scores).collect()}
    assert got == {"a": "ent:a", "b": "ent:b", "c": "ent:b"}
