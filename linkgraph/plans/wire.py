"""Queries of the readers and of the export: wire files are written from the driver's tables into the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph import vocab
from linkgraph.functions import places, text
from linkgraph.operators import evaluate, graph
from linkgraph.plans import bridge
from linkgraph.plans.queries import ENT, REL, query
from linkgraph.sources import export, registers
from linkgraph.storage import scratch

ISO = ["GB", "CY", "VG", "DE", "US", "", "GB", "FR", ""]


def _str(c: str) -> Column:
    return F.col(c).cast("string")


# The company register


_NUMBER = "CASE WHEN p_partkey % 4 = 0 THEN 'SC' || lpad(p_partkey::VARCHAR, greatest(6, length(p_partkey::VARCHAR))::INT, '0') ELSE lpad(p_partkey::VARCHAR, greatest(8, length(p_partkey::VARCHAR))::INT, '0') END"
_REGISTER = f"""register AS (SELECT p_partkey, {_NUMBER} AS reg_number, p_name || {bridge.pick(bridge.SUFFIX, 'p_partkey % 5')} AS name, {bridge.pick(bridge.TAG, 'p_partkey % 5')} AS tag, {bridge.pick(ISO, 'p_partkey % 9')} AS iso,
    CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'AB' || (p_partkey % 9 + 1) || ' ' || (p_size % 10) || 'CD' END AS postcode, p_size, p_type, p_partkey % 28 + 1 AS day, p_partkey % 9 + 1 AS month FROM part WHERE p_partkey % 11 <> 0)"""


def _register_file(spark: SparkSession, sf_dir: str) -> str:
    """CSV with headers that begin with blanks, quoted commas, quotes and line ends, and rows without number."""
    part = bridge.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    postcode = F.concat(F.lit("ab"), (k % 9 + 1).cast("string"), (F.col("p_size") % 10).cast("string"), F.lit("cd"))
    date = F.concat(F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("/0"), (k % 9 + 1).cast("string"), F.lit("/2003"))
    rows = part.select(
        F.concat("p_name", F.expr(bridge.pick(bridge.SUFFIX, "p_partkey % 5"))).alias("CompanyName"), F.when(k % 11 == 0, " ").when(k % 4 == 0, F.concat(F.lit("sc "), k.cast("string"))).otherwise(k.cast("string")).alias(" CompanyNumber"),
        F.lit('The "Old" Mill,\nYard 2').alias("RegAddress.AddressLine1"), F.lit("Leeds").alias("RegAddress.PostTown"), F.expr(bridge.pick(bridge.COUNTRY_WORDS, "p_partkey % 9")).alias(" RegAddress.Country"), F.when(k % 3 == 0, "").otherwise(postcode).alias("RegAddress.PostCode"),
        F.lit("Private Limited Company").alias("CompanyCategory"), F.when(k % 7 == 0, "Dissolved").otherwise("Active").alias("CompanyStatus"), F.when(k % 7 == 0, "2020-02-30").otherwise("").alias("DissolutionDate"), date.alias("IncorporationDate"),
        F.concat(_str("p_size"), F.lit(" - "), F.col("p_type")).alias("SICCode.SicText_1"), F.lit("None Supplied").alias("SICCode.SicText_2"), F.concat(F.lit("http://r.example/"), k.cast("string")).alias("URI"),
    )
    path = scratch(spark, "register")
    rows.write.csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


@query(f"""WITH {_REGISTER} SELECT 'ch:company:' || reg_number AS record_id, 'companies_house' AS source, 'Company' AS entity_type, name, CASE WHEN tag <> '' THEN tag ELSE 'Private Limited Company' END AS legal_form,
    CASE WHEN iso = '' THEN 'GB' ELSE iso END AS country, 'GB' AS jurisdiction, reg_number, postcode, '2003-0' || month || '-' || lpad(day::VARCHAR, 2, '0') AS incorporation_date, NULL::VARCHAR AS dissolution_date,
    CASE WHEN p_partkey % 7 = 0 THEN 'Dissolved' ELSE 'Active' END AS status, p_size || ',None Supplied' AS sic_codes, 'http://r.example/' || p_partkey AS source_url FROM register""")
def register_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01, SRC-02, SRC-11: the company register from CSV."""
    r = registers.read_companies(spark, _register_file(spark, sf_dir))
    return r.select("record_id", "source", "entity_type", "name", "legal_form", "country", "jurisdiction", "reg_number", "postcode", _str("incorporation_date").alias("incorporation_date"), _str("dissolution_date").alias("dissolution_date"), "status", F.array_join("sic_codes", ",").alias("sic_codes"), "source_url")


# Control filings

_KINDS = ["individual-person-with-significant-control", "corporate-entity-person-with-significant-control", "persons-with-significant-control-statement", "legal-person-person-with-significant-control", "individual-person-with-significant-control"]
_FILED = f"""filed AS (SELECT c_custkey AS k, {bridge.pick(_KINDS, 'c_custkey % 5')} AS kind, lpad(c_custkey::VARCHAR, greatest(8, length(c_custkey::VARCHAR))::INT, '0') AS number, c_nationkey AS nation, c_acctbal FROM customer WHERE c_custkey % 13 NOT IN (0, 1)),
    named AS (SELECT *, 'ch:psc:' || number || ':f' || k AS record_id, kind LIKE 'individual%' AS person FROM filed WHERE kind NOT LIKE '%statement')"""


def _filings_file(spark: SparkSession, sf_dir: str, name: str = "filings") -> str:
    """JSON lines; of thirteen one is cut off and one has no company number."""
    c = bridge.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    kind = F.expr(bridge.pick(_KINDS, "c_custkey % 5"))
    person = F.startswith(kind, F.lit("individual"))
    nature = F.when(F.col("c_acctbal") < 2000, "ownership-of-shares-25-to-50-percent").when(F.col("c_acctbal") < 6000, "voting-rights-50-to-75-percent-as-trust").otherwise("right-to-appoint-and-remove-directors")
    data = F.struct(
        kind.alias("kind"), F.when(person, "Dr James Lee Novak").otherwise(F.concat(F.lit("Firm "), k.cast("string"), F.lit(" GmbH"))).alias("name"),
        F.when(person, F.struct(F.lit("Dr").alias("title"), F.lit("James").alias("forename"), F.lit("Lee").alias("middle_name"), F.lit("Novak").alias("surname"))).alias("name_elements"),
        F.struct(F.lit("12").alias("premises"), F.lit("High Street").alias("address_line_1"), F.lit("eh1 1aa").alias("postal_code"), F.lit("Scotland").alias("country")).alias("address"),
        F.when(person, F.struct((k % 12 + 1).cast("int").alias("month"), (1940 + k % 50).cast("int").alias("year"))).alias("date_of_birth"), F.when(person, F.expr(bridge.pick(bridge.COUNTRY_WORDS, "c_custkey % 9"))).alias("nationality"),
        F.when(~person, F.struct(F.concat(F.lit("hrb "), k.cast("string")).alias("registration_number"), F.lit("Germany").alias("country_registered"))).alias("identification"),
        F.array(nature).alias("natures_of_control"), F.lit("2016-04-06").alias("notified_on"), F.when(k % 4 == 0, "2019-01-31").alias("ceased_on"), F.struct(F.concat(F.lit("/company/x/f"), k.cast("string"), F.lit("/")).alias("self")).alias("links"),
    )
    line = F.to_json(F.struct(F.when(k % 13 == 1, "").otherwise(k.cast("string")).alias("company_number"), data.alias("data")))
    path = scratch(spark, name)
    c.select(F.when(k % 13 == 0, F.substring(line, 1, 60)).otherwise(line).alias("value")).unionByName(spark.createDataFrame([("",), ("   ",)], "value string")).write.text(path, compression="gzip")
    return path


@query(f"""SELECT CASE WHEN c_custkey % 13 = 0 THEN 'malformed' WHEN c_custkey % 13 = 1 THEN 'no_company_number' ELSE {bridge.pick(_KINDS, 'c_custkey % 5')} END AS kind, count(*) AS rows FROM customer GROUP BY 1""")
def filing_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03: filings by kind, malformed lines and those without company number counted."""
    return registers.kinds(registers.read_filings(spark, _filings_file(spark, sf_dir)))


@query(f"""WITH {_FILED} SELECT record_id, CASE WHEN person THEN 'Person' WHEN kind LIKE 'corporate%' THEN 'Company' ELSE 'LegalEntity' END AS entity_type, CASE WHEN person THEN 'Dr James Lee Novak' ELSE 'Firm ' || k || ' GmbH' END AS name,
    CASE WHEN person THEN 'james lee novak' ELSE 'firm ' || k || ' gmbh' END AS name_norm, CASE WHEN person THEN 'james novak' ELSE k || ' firm' END AS name_fp, CASE WHEN person THEN 'james|lee|novak' ELSE '||' END AS parts,
    CASE WHEN person THEN (1940 + k % 50)::VARCHAR END AS birth_year, CASE WHEN person THEN (k % 12 + 1)::VARCHAR END AS birth_month, CASE WHEN person THEN {bridge.pick(ISO, 'k % 9')} ELSE '' END AS nationality, CASE WHEN person THEN 'GB' ELSE 'DE' END AS country,
    CASE WHEN person THEN '' ELSE 'DE' END AS jurisdiction, CASE WHEN person THEN '' ELSE 'hrb ' || k END AS reg_number, 'EH1 1AA' AS postcode, CASE WHEN person THEN '' ELSE 'GMBH' END AS legal_form, number AS context_company_number FROM named""")
def filing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-04, SRC-06: persons, companies and other bodies that filings name."""
    r = registers.filing_records(registers.read_filings(spark, _filings_file(spark, sf_dir)))
    return r.select("record_id", "entity_type", "name", "name_norm", "name_fp", F.concat_ws("|", "first_name", "middle_name", "last_name").alias("parts"), _str("birth_year").alias("birth_year"), _str("birth_month").alias("birth_month"), "nationality", "country", "jurisdiction", "reg_number", "postcode", "legal_form", "context_company_number")


@query(f"""WITH {_FILED} SELECT 'rel:' || record_id || '->' || number AS rel_id, CASE WHEN c_acctbal < 6000 THEN 'OWNS' ELSE 'CONTROLS' END AS rel_type, record_id AS source_record_id, 'ch:company:' || number AS target_record_id,
    CASE WHEN c_acctbal < 2000 THEN 25.0 WHEN c_acctbal < 6000 THEN 50.0 END::DOUBLE AS min_percent, CASE WHEN c_acctbal < 2000 THEN 50.0 WHEN c_acctbal < 6000 THEN 75.0 END::DOUBLE AS max_percent,
    CASE WHEN c_acctbal < 2000 THEN 'SHARES' WHEN c_acctbal < 6000 THEN 'VOTING' ELSE 'APPOINT_DIRECTORS' END AS control_kinds, c_acctbal >= 2000 AND c_acctbal < 6000 AS via_fiduciary, '2016-04-06' AS notified_on, CASE WHEN k % 4 = 0 THEN '2019-01-31' END AS ceased_on FROM named""")
def filing_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05: what filings say about control."""
    r = registers.filing_relationships(registers.read_filings(spark, _filings_file(spark, sf_dir)))
    return r.select("rel_id", "rel_type", "source_record_id", "target_record_id", "min_percent", "max_percent", F.array_join("control_kinds", ",").alias("control_kinds"), "via_fiduciary", _str("notified_on").alias("notified_on"), _str("ceased_on").alias("ceased_on"))


# The sanctions feed

_BORN = "CASE s_suppkey % 3 WHEN 0 THEN '1975-06-30' WHEN 1 THEN '1980-02' ELSE '1990' END"
_FEED = f"""feed AS (SELECT s_suppkey AS k, 'Q' || s_suppkey AS id, s_nationkey AS nation, {bridge.pick(['Person', 'Company', 'Vessel', 'Organization', 'Person'], 's_suppkey % 5')} AS schema_, {_BORN} AS born FROM supplier),
    variants AS (SELECT *, unnest([{{'i': 0, 'n': 'Ivan Petrov ' || k}}, {{'i': 1, 'n': 'Petrov Holding ' || k}}]) AS v FROM feed WHERE schema_ <> 'Vessel')"""


def _feed_file(spark: SparkSession, sf_dir: str) -> str:
    """FollowTheMoney JSON lines, gzipped; a line is broken, names repeat in other spellings."""
    k = F.col("s_suppkey").cast("string")
    name, other = F.concat(F.lit("Ivan Petrov "), k), F.concat(F.lit("Petrov Holding "), k)
    properties = F.map_from_arrays(
        F.array(*map(F.lit, ["name", "alias", "weakAlias", "birthDate", "nationality", "country", "jurisdiction", "registrationNumber", "topics"])),
        F.array(F.array(name), F.array(F.upper(name), other), F.array(F.lit("")), F.array(F.expr(_BORN)), F.array(F.lit("ru"), F.lit("ua")), F.array(F.lit("Cyprus")), F.array(F.lit("cy")), F.array(F.lit("he 12")), F.when(F.col("s_nationkey") == 3, F.array(F.lit("sanction"), F.lit("role.pep"), F.lit("sanction"))).otherwise(F.array().cast("array<string>"))),
    )
    row = F.struct(F.concat(F.lit("Q"), k).alias("id"), name.alias("caption"), F.expr(bridge.pick(["Person", "Company", "Vessel", "Organization", "Person"], "s_suppkey % 5")).alias("schema"), properties.alias("properties"), F.array(F.lit("eu"), F.lit("un")).alias("datasets"), F.array(F.lit("x")).alias("referents"))
    path = scratch(spark, "feed")
    bridge.table(spark, sf_dir, "supplier").select(F.to_json(row).alias("value")).unionByName(spark.createDataFrame([('{"id": "Q1", "schema',)], "value string")).write.text(path, compression="gzip")
    return path


@query(f"""WITH {_FEED} SELECT 'os:' || id || CASE WHEN v.i = 0 THEN '' ELSE '#' || v.i END AS record_id, CASE schema_ WHEN 'Person' THEN 'Person' ELSE 'Company' END AS entity_type, v.n AS name, CASE WHEN schema_ = 'Person' THEN substr(born, 1, 4) END AS birth_year,
    CASE WHEN schema_ = 'Person' AND length(born) > 4 THEN substr(born, 6, 2)::INT::VARCHAR END AS birth_month, 'RU' AS nationality, 'CY' AS country, 'CY' AS jurisdiction, 'he 12' AS reg_number, CASE WHEN nation = 3 THEN 'role.pep,sanction' ELSE '' END AS topics, 'eu,un' AS datasets FROM variants""")
def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08, SRC-09, SRC-10: a record for each different name of a feed's entities."""
    r = registers.read_sanctions(spark, _feed_file(spark, sf_dir))
    return r.select("record_id", "entity_type", "name", _str("birth_year").alias("birth_year"), _str("birth_month").alias("birth_month"), "nationality", "country", "jurisdiction", "reg_number", F.array_join("topics", ",").alias("topics"), F.array_join("datasets", ",").alias("datasets"))


# Export


@query(f"""WITH {REL}, {ENT}, e AS (SELECT 'ent:' || source_record_id AS o, 'ent:' || target_record_id AS a, min(min_percent)::INT AS lo, max(max_percent)::INT AS hi, bool_or(ceased_on IS NULL) AS act, max(ceased_on)::VARCHAR AS ceased FROM rel GROUP BY 1, 2)
    SELECT canonical_id AS id, entity_type AS schema, name AS name, upper(name) AS alias, CASE WHEN entity_type = 'Person' THEN nationality ELSE jurisdiction END AS place, topic AS topics, '' AS percentage, '' AS ended FROM ent
    UNION ALL SELECT 'own:' || o || '->' || a, 'Ownership', o, a, '', '', CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN lo || '-' || hi || '%' ELSE '' END, CASE WHEN act THEN '' ELSE ceased END FROM e""")
def ftm_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-03, SNK-04: entities and ownerships as FollowTheMoney JSON lines, read back; nothing of them is invalid."""
    rows = export.entities(bridge.entities(spark, sf_dir)).unionByName(export.ownerships(graph.edges(bridge.relationships(spark, sf_dir), merge_before_filter=True)))
    path = scratch(spark, "ftm")
    export.write(rows, path)
    back = spark.read.schema("id string, schema string, properties map<string, array<string>>").json(path)
    good = back.join(export.invalid(back).select("id"), "id", "left_anti")

    def of(name: str) -> Column:
        return F.array_join(F.coalesce(F.try_element_at("properties", F.lit(name)), F.array().cast("array<string>")), ",")

    own = F.col("schema") == "Ownership"
    return good.select("id", "schema", F.when(own, of("owner")).otherwise(of("name")).alias("name"), F.when(own, of("asset")).otherwise(of("alias")).alias("alias"), F.concat(of("nationality"), of("jurisdiction")).alias("place"), of("topics").alias("topics"), of("percentage").alias("percentage"), of("endDate").alias("ended"))


@query("""SELECT DISTINCT least(a.r, b.r) AS left_id, greatest(a.r, b.r) AS right_id FROM (SELECT DISTINCT 'part:' || p_partkey AS r, p_name || p_size AS t FROM part WHERE p_size % 2 = 0) a
    JOIN (SELECT DISTINCT 'part:' || p_partkey AS r, p_name || p_size AS t FROM part WHERE p_size % 2 = 0) b ON a.t = b.t AND a.r < b.r""")
def known_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-06, FLT-06: true pairs of parsed records; aliases (#n) are their entity."""
    part = bridge.table(spark, sf_dir, "part")
    truth = part.select(F.concat("p_name", _str("p_size")).alias("truth_id"), F.explode(F.array(F.concat(F.lit("part:"), _str("p_partkey")), F.concat(F.lit("part:"), _str("p_partkey"), F.lit("#2")))).alias("record_id"))
    return evaluate.truth_pairs(truth, part.filter("p_size % 2 = 0").select(F.concat(F.lit("part:"), _str("p_partkey")).alias("record_id")))


# Vocabularies


def _values(rows: list[tuple[str, str]]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


_COUNTRY_ROWS = sorted([*vocab.country_aliases().items(), *((iso, iso) for iso in vocab.COUNTRIES), *((iso.lower(), iso) for iso in vocab.COUNTRIES)])


@query(f"SELECT DISTINCT w AS word, iso, iso IN ({', '.join(repr(x) for x in vocab.SECRECY)}) AS secrecy FROM (VALUES {_values(_COUNTRY_ROWS)}, ('Ruritania', ''), ('zz', '')) AS t(w, iso)")
def country_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CTY-01, CTY-02 over every name, demonym and code."""
    words = spark.createDataFrame([(w,) for w in sorted({w for w, _ in _COUNTRY_ROWS})] + [("Ruritania",), ("zz",)], "word string")
    iso = places.country_code(F.when(F.length("word") > 2, F.concat(F.lit("  "), F.initcap("word"), F.lit("."))).otherwise(F.col("word")))
    return words.select("word", iso.alias("iso"), places.is_secrecy(iso).alias("secrecy"))


_FORMS = [(form, tag) for form, (_, tag) in vocab.legal_form_ranks().items()]


@query(f"SELECT f AS form, 'acme' AS base, tag FROM (VALUES {_values(_FORMS)}) AS t(f, tag)")
def legal_form_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-04 over every legal form."""
    found = text.legal_form(F.concat(F.lit("ACME "), F.upper("form")))
    return spark.createDataFrame([(f,) for f, _ in _FORMS], "form string").select("form", found["base"].alias("base"), found["tag"].alias("tag"))
