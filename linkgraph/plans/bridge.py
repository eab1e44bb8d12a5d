"""The driver's tables seen as records, relationships and entities.

parts are company records, customers person records; customers control suppliers, and suppliers one
another. Everything is made from whole tables by rules that SQL can state as well; BRIDGE_SQL states them,
with table names in braces, for Spark and DuckDB alike. Nobody controls the suppliers whose number is 2
more than a multiple of 4, so that some chains end at companies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.functions import places, text

FIRST = "james,olga,ivan,maria,peter,anna,paul,elena,george,sofia,victor,nina".split(",")
LAST = "whitfield,petrov,kowalczyk,shevchenko,sokolov,zielinski,abramov,keller,marchetti,dubois,larsen,novak,horvat,popescu,lindgren".split(",")
SUFFIX = [" Ltd", " Limited", "", " GmbH", " PLC"]
TAG = ["LTD", "LTD", "", "GMBH", "PLC"]
PLACES = ["GB", "CY", "VG", "LU", "US", "DE", ""]
COUNTRY_WORDS = ["British", "Cyprus", "BVI", "German, French", "usa", "Ruritania", "United Kingdom", "fr", ""]


def pick(values: list[str], index: str) -> str:
    """SQL for the value at an index."""
    return f"CASE {index} {' '.join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values))} END"


BRIDGE_SQL = {
    "companies": f"""
        SELECT 'part:' || CAST(p_partkey AS STRING) AS record_id, 'register' AS source, 'Company' AS entity_type,
               p_name || {pick(SUFFIX, 'p_partkey % 5')} AS name, {pick(TAG, 'p_partkey % 5')} AS legal_form,
               CASE WHEN p_partkey % 3 = 0 THEN p_brand || CAST(p_size AS STRING) ELSE '' END AS raw_number,
               {pick(PLACES, 'p_partkey % 7')} AS jurisdiction, {pick(PLACES, 'p_partkey % 7')} AS country,
               CASE WHEN p_partkey % 2 = 0 THEN 'AB' || CAST(p_partkey % 9 + 1 AS STRING) || ' ' || CAST(p_size % 10 AS STRING) || 'CD' ELSE '' END AS postcode,
               CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS STRING) || '|AB' || CAST(p_partkey % 9 + 1 AS STRING) || ' ' || CAST(p_size % 10 AS STRING) || 'CD' ELSE '' END AS address_blk,
               lower(p_type) AS address_norm, p_name AS truth_name, p_brand AS truth_brand
        FROM {{part}}""",
    "people": f"""
        SELECT 'cust:' || CAST(c_custkey AS STRING) AS record_id, CASE WHEN c_custkey % 4 = 0 THEN 'sanctions' ELSE 'filings' END AS source, 'Person' AS entity_type,
               {pick(FIRST, 'c_custkey % 12')} AS first_name, CASE WHEN c_custkey % 3 = 0 THEN 'lee' WHEN c_custkey % 3 = 1 THEN 'l' ELSE '' END AS middle_name,
               {pick(LAST, 'c_custkey % 15')} AS last_name, CAST(1945 + c_custkey % 57 AS INT) AS birth_year, CAST(1 + c_custkey % 11 AS INT) AS birth_month,
               {pick(PLACES, 'c_nationkey % 7')} AS nationality, {pick(PLACES, 'c_nationkey % 6')} AS country,
               'EH' || CAST(1 + c_custkey % 20 AS STRING) || ' 1AA' AS postcode, lower(c_mktsegment) AS address_norm, CAST(c_custkey % 30 AS STRING) AS address_blk
        FROM {{customer}}""",
    "relationships": """
        SELECT 'rel:cust:' || CAST(c_custkey AS STRING) AS rel_id, 'cust:' || CAST(c_custkey AS STRING) AS source_record_id, 'sup:' || CAST(c_custkey % n AS STRING) AS target_record_id,
               CASE WHEN c_acctbal < 2000 THEN 25.0 WHEN c_acctbal < 6000 THEN 50.0 END AS min_percent, CASE WHEN c_acctbal < 2000 THEN 50.0 WHEN c_acctbal < 6000 THEN 75.0 END AS max_percent,
               c_acctbal >= 6000 AS has_hard_control, c_mktsegment = 'HOUSEHOLD' AS via_fiduciary, CASE WHEN c_mktsegment = 'MACHINERY' THEN DATE '2020-01-01' END AS ceased_on
        FROM {customer}, (SELECT count(*) AS n FROM {supplier}) AS s WHERE c_custkey % n % 4 <> 2
        UNION ALL
        SELECT 'rel:sup:' || CAST(s_suppkey AS STRING), 'sup:' || CAST(s_suppkey AS STRING), 'sup:' || CAST((s_suppkey * 7 + 3) % n AS STRING),
               CASE WHEN s_acctbal < 2000 THEN 25.0 WHEN s_acctbal < 6000 THEN 50.0 END, CASE WHEN s_acctbal < 2000 THEN 50.0 WHEN s_acctbal < 6000 THEN 75.0 END,
               s_acctbal >= 6000, s_nationkey % 5 = 0, CASE WHEN s_nationkey % 8 = 0 THEN DATE '2021-06-30' END
        FROM {supplier}, (SELECT count(*) AS n FROM {supplier}) AS s WHERE (s_suppkey * 7 + 3) % n % 4 <> 2
        UNION ALL
        SELECT 'rel:debt:' || CAST(s_suppkey AS STRING), 'sup:' || CAST((s_suppkey * 3 + 1) % n AS STRING), 'sup:' || CAST(s_suppkey AS STRING),
               50.0, 75.0, true, false, CAST(NULL AS DATE)
        FROM {supplier}, (SELECT count(*) AS n FROM {supplier}) AS s WHERE s_acctbal < 0 AND s_suppkey % 4 <> 2""",
    "entities": f"""
        SELECT 'ent:cust:' || CAST(c_custkey AS STRING) AS canonical_id, c_name AS name, 'Person' AS entity_type, {pick(PLACES, 'c_nationkey % 7')} AS nationality, '' AS jurisdiction,
               '' AS reg_number, CASE c_nationkey WHEN 3 THEN 'sanction' WHEN 7 THEN 'role.pep' ELSE '' END AS topic, c_custkey % 3 + 1 AS n_records
        FROM {{customer}}
        UNION ALL
        SELECT 'ent:sup:' || CAST(s_suppkey AS STRING), s_name, 'Company', '', {pick(PLACES, 's_nationkey % 7')}, CAST(s_suppkey AS STRING), CASE s_nationkey WHEN 3 THEN 'export.risk' ELSE '' END, s_suppkey % 2 + 1
        FROM {{supplier}}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of BRIDGE_SQL's."""
    sql = BRIDGE_SQL[name]
    used = {t: table(spark, sf_dir, t) for t in ("part", "customer", "supplier") if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company records, their text normalised by the library."""
    c = view(spark, sf_dir, "companies")
    none = F.array().cast("array<string>")
    return c.select(
        "record_id", "source", "entity_type", "name", text.normalize_text(F.col("name")).alias("name_norm"), text.company_fingerprint(F.col("name")).alias("name_fp"), text.phonetic_key(text.company_fingerprint(F.col("name"))).alias("name_phonetic"), *(F.lit("").alias(k) for k in ("first_name", "middle_name", "last_name", "nationality")),
        F.lit(None).cast("int").alias("birth_year"), F.lit(None).cast("int").alias("birth_month"), "country", "jurisdiction", places.company_number(F.col("raw_number")).alias("reg_number"), "address_norm", places.postcode(F.col("postcode")).alias("postcode"), "address_blk",
        text.legal_form(F.col("name"))["tag"].alias("legal_form"), F.lit(None).cast("date").alias("incorporation_date"), none.alias("topics"), "truth_name", "truth_brand",
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person records."""
    c = view(spark, sf_dir, "people").withColumn("name", F.concat_ws(" ", "first_name", F.nullif("middle_name", F.lit("")), "last_name"))
    parts = F.struct(F.col("first_name").alias("first"), F.col("last_name").alias("last"))
    none = F.array().cast("array<string>")
    return c.select(
        "record_id", "source", "entity_type", "name", text.normalize_text(F.col("name")).alias("name_norm"), text.person_fingerprint(parts).alias("name_fp"), text.phonetic_key(text.person_fingerprint(parts)).alias("name_phonetic"), "first_name", "middle_name", "last_name", "nationality", "birth_year", "birth_month", "country",
        F.lit("").alias("jurisdiction"), F.lit("").alias("reg_number"), "address_norm", "postcode", "address_blk", F.lit("").alias("legal_form"), F.lit(None).cast("date").alias("incorporation_date"), none.alias("topics"),
    )


def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("min_percent").isNull(), F.array(F.lit("APPOINT_DIRECTORS"))).otherwise(F.array(F.lit("SHARES")))
    r = view(spark, sf_dir, "relationships")
    return r.withColumns({"min_percent": F.col("min_percent").cast("double"), "max_percent": F.col("max_percent").cast("double"), "control_kinds": kind, "capacities": F.when(F.col("via_fiduciary"), F.array(F.lit("TRUST"))).otherwise(F.array().cast("array<string>")), "notified_on": F.lit("2015-01-01").cast("date")})


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "entities")
    return e.withColumns({"topics": F.filter(F.array("topic"), lambda t: t != ""), "all_names": F.array("name", F.upper("name")), "sources": F.when(F.col("n_records") > 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))), "country": F.lit(""), "postcode": F.lit(""), "birth_year": F.lit(None).cast("int")}).drop("topic")
