"""Pairs and training of the Fellegi-Sunter matcher."""

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from linkgraph.operators import fellegi_sunter as fs
from linkgraph.operators.matching import _USED

TEXT = [c for c in _USED if c not in ("birth_year", "birth_month", "incorporation_date")]


def companies(spark, rows):
    """rows: (record_id, name_fp, reg_number, postcode)."""
    df = spark.createDataFrame(rows, "record_id string, name_fp string, reg_number string, postcode string").withColumn("entity_type", F.lit("Company"))
    df = df.withColumns({c: F.lit("") for c in TEXT if c not in df.columns})
    return df.withColumns({"birth_year": F.lit(None).cast("int"), "birth_month": F.lit(None).cast("int"), "incorporation_date": F.lit(None).cast("date")})


def test_large_blocks_are_paired_whole(spark):
    rows = [(f"c{k:03}", f"n{k}", "", "AB1 1CD") for k in range(60)] + [("x1", "same", "", ""), ("x2", "same", "", ""), ("x3", "alone", "", "")]
    want = {*combinations([r[0] for r in rows[:60]], 2), ("x1", "x2")}
    got = [tuple(r) for r in fs.blocked_pairs(companies(spark, rows), "Company", tile=7).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_prior_and_what_a_rule_compares(spark):
    rows = [(f"c{k:02}", f"name {k // 2}", f"r{k // 2}" if k < 16 else "", f"p{k % 5}") for k in range(40)]
    records = companies(spark, rows)
    assert abs(fs.deterministic_prior(records, "Company") - 8 / 0.8 / 780) < 1e-12
    p = fs.train(records, "Company", rules=[("name_fp",)])
    first = np.linspace(0.9, 0.02, 5) / np.linspace(0.9, 0.02, 5).sum()
    assert np.allclose(p.m[0], first) and p.prior == fs.deterministic_prior(records, "Company")
    assert not np.allclose(p.m[1], np.linspace(0.9, 0.02, 2) / 0.92)
