import gzip
import json
import zipfile

from pyspark.sql import functions as F

from linkgraph.operators import graph
from linkgraph.sources import export, registers
from linkgraph.streaming import ingest

HEAD = " CompanyName, CompanyNumber,RegAddress.AddressLine1,RegAddress.PostTown,RegAddress.Country,RegAddress.PostCode,CompanyCategory,CompanyStatus,IncorporationDate,SICCode.SicText_1,SICCode.SicText_2,URI"
FILING = {"company_number": "1234567", "data": {"kind": "individual-person-with-significant-control", "name": "Mr Ivan Petrov", "name_elements": {"forename": "Ivan", "surname": "Petrov"}, "date_of_birth": {"month": 5, "year": 1970}, "nationality": "Russian", "address": {"postal_code": "EC1V 9NR", "premises": "12", "address_line_1": "High Street"}, "natures_of_control": ["ownership-of-shares-25-to-50-percent"], "notified_on": "2016-04-06", "links": {"self": "/company/01234567/psc/individual/abc/"}}}
PARENT = {"company_number": "SC123456", "data": {"kind": "corporate-entity-person-with-significant-control", "name": "Acme Ltd", "identification": {"registration_number": "1234567", "country_registered": "England"}, "natures_of_control": ["right-to-appoint-and-remove-directors-as-trust"], "notified_on": "2017-01-01"}}
STATEMENT = {"company_number": "1", "data": {"kind": "persons-with-significant-control-statement", "statement": "none"}}


def test_companies(spark, tmp_path):
    (tmp_path / "c.csv").write_text(f'{HEAD}\n"ACME, LIMITED",1234567,12 High Street,London,,EC1V 9NR,Private Limited Company,Active,05/03/2001,62012 - Software,, http://x\nNo Number,,,,,,,,,,,\n')
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.write(tmp_path / "c.csv", "c.csv")
    rows = registers.read_companies(spark, str(tmp_path / "c.csv")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.record_id, r.name_fp, r.legal_form, r.reg_number, r.country, r.postcode, str(r.incorporation_date), r.sic_codes, r.address_blk) == ("ch:company:01234567", "acme", "LTD", "01234567", "GB", "EC1V 9NR", "2001-03-05", ["62012"], "12|EC1V 9NR")
    folder = registers.unzip(spark, str(tmp_path / "c.zip"), ".csv", str(tmp_path / "out"))
    assert registers.read_companies(spark, folder).count() == 1


def test_filings(spark, tmp_path):
    lines = [json.dumps(FILING), json.dumps(PARENT), json.dumps(STATEMENT), "{broken", "", json.dumps({"data": {"kind": "exemptions"}})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.jsonl").write_text("\n".join(lines))
    f = registers.read_filings(spark, str(tmp_path / "in"))
    assert {r.kind: r.rows for r in registers.kinds(f).collect()} == {"individual-person-with-significant-control": 1, "corporate-entity-person-with-significant-control": 1, "persons-with-significant-control-statement": 1, "malformed": 1, "no_company_number": 1}
    recs = {r.entity_type: r for r in registers.filing_records(f).collect()}
    p, c = recs["Person"], recs["Company"]
    assert (p.record_id, p.name_fp, p.birth_year, p.nationality, p.postcode, p.first_name) == ("ch:psc:01234567:abc", "ivan petrov", 1970, "RU", "EC1V 9NR", "ivan")
    assert c.record_id.startswith("ch:psc:SC123456:") and len(c.record_id.split(":")[3]) == 12 and (c.reg_number, c.jurisdiction, c.legal_form) == ("01234567", "GB", "LTD")
    e = {r.rel_type: r for r in registers.filing_relationships(f).collect()}
    assert (e["OWNS"].rel_id, e["OWNS"].min_percent, e["OWNS"].target_record_id) == ("rel:ch:psc:01234567:abc->01234567", 25.0, "ch:company:01234567")
    assert e["CONTROLS"].has_hard_control and e["CONTROLS"].capacities == ["TRUST"]
    records, _ = ingest.filings(spark, str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        ingest.append(records, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sanctions(spark, tmp_path):
    ent = {"id": "Q1", "schema": "Person", "properties": {"name": ["Иван Петров"], "alias": ["Ivan Petrov", "Vanya Petrov"], "birthDate": ["1970-05"], "topics": ["sanction"], "nationality": ["ru"]}, "datasets": ["d"]}
    many = {"id": "Q2", "schema": "Company", "properties": {"name": ["Acme Ltd"], "alias": [f"Alias {k}" for k in range(20)]}}
    with gzip.open(tmp_path / "s.json.gz", "wt") as f:
        f.write("\n".join([json.dumps(ent), "{broken", json.dumps(many), json.dumps({"id": "Q3", "schema": "Vessel", "properties": {}})]))
    rows = registers.read_sanctions(spark, str(tmp_path / "s.json.gz")).collect()
    q1 = {r.record_id: r for r in rows if r.record_id.startswith("os:Q1")}
    assert set(q1) == {"os:Q1", "os:Q1#1"} and q1["os:Q1"].name == "Иван Петров" and q1["os:Q1#1"].name_fp == "petrov vanya"
    assert (q1["os:Q1"].birth_year, q1["os:Q1"].birth_month, q1["os:Q1"].nationality, q1["os:Q1"].topics) == (1970, 5, "RU", ["sanction"])
    assert sum(r.record_id.startswith("os:Q2") for r in rows) == registers.MAX_NAMES


def test_dates(spark):
    df = spark.createDataFrame([("05/03/2001",), ("2001-03-05",), ("2001",), ("31/02/2001",), ("",), (None,)], "d string")
    got = [r[0] for r in df.select(registers.parse_date(F.col("d")).cast("string")).collect()]
    assert got == ["2001-03-05", "2001-03-05", None, None, None, None]


def test_export(spark, tmp_path):
    ents = spark.createDataFrame([("ent:a", "Person", "Ann", ["Ann", "Anna"], 1975, 6, "GB", "", "", "", ["sanction"])], "canonical_id string, entity_type string, name string, all_names array<string>, birth_year int, birth_month int, nationality string, country string, jurisdiction string, reg_number string, topics array<string>")
    out = export.entities(ents)
    p = out.collect()[0].properties
    assert p == {"name": ["Ann"], "alias": ["Anna"], "birthDate": ["1975-06"], "nationality": ["GB"], "topics": ["sanction"]}
    assert export.entities(ents.drop("birth_month")).collect()[0].properties["birthDate"] == ["1975"]
    rel = spark.createDataFrame([("r", "a", "b", 25.0, 50.0)], "rel_id string, source_record_id string, target_record_id string, min_percent double, max_percent double").withColumns({"has_hard_control": F.lit(False), "via_fiduciary": F.lit(False), "control_kinds": F.array(F.lit("SHARES")), "capacities": F.array().cast("array<string>"), "notified_on": F.lit("2020-01-01").cast("date"), "ceased_on": F.lit(None).cast("date")})
    own = export.ownerships(graph.edges(rel))
    assert own.collect()[0].properties["percentage"] == ["25-50%"]
    both = out.unionByName(own)
    assert export.invalid(both).count() == 0 and export.invalid(both.withColumn("schema", F.lit("Vessel"))).count() == 2
    export.write(both, str(tmp_path / "ftm"))
    assert spark.read.json(str(tmp_path / "ftm")).count() == 2
