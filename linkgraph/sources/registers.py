"""Readers of the wire formats: company register (CSV), control filings (nested JSON lines), sanctions feed (FollowTheMoney JSON lines).

Each gives DataFrames of schemas.RECORD or schemas.RELATIONSHIP; malformed lines are counted, not lost.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph import schemas, vocab
from linkgraph.functions import control, places, text

#: A feed entity makes a record for each of its first so many different names.
MAX_NAMES = 12
# Kinds of filings that name someone, and those that only state something.
FILING_KINDS = {
    "individual-person-with-significant-control": "Person",
    "corporate-entity-person-with-significant-control": "Company",
    "legal-person-person-with-significant-control": "LegalEntity",
}
STATEMENT_KINDS = ["persons-with-significant-control-statement", "super-secure-person-with-significant-control", "exemptions"]
SCHEMATA = {"Person": "Person", "Company": "Company", "Organization": "Company", "PublicBody": "Company", "LegalEntity": "LegalEntity"}


def _none() -> Column:
    return F.array().cast("array<string>")


def parse_date(c: Column) -> Column:
    """DD/MM/YYYY or YYYY-MM-DD at the beginning; else null."""
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.coalesce(F.when(t.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(t, "dd/MM/yyyy")), F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")))


def unzip(spark: SparkSession, path: str, suffix: str, folder: str) -> str:
    """Writes the lines of the archives' members as text below folder, which all executors must reach; a member is read as a stream, an archive by one task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content in f["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(n for n in z.namelist() if n.endswith(suffix)):
                        with z.open(name) as member:
                            lines: list[str] = []
                            for line in io.TextIOWrapper(member, "utf-8", "replace"):
                                lines.append(line.rstrip("\r\n"))
                                if len(lines) == 20_000:
                                    yield pd.DataFrame({"value": lines})
                                    lines = []
                            if lines:
                                yield pd.DataFrame({"value": lines})

    spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "value string").write.mode("overwrite").text(folder)
    return folder


def _record(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """df as schemas.RECORD; columns that values lacks are absent."""
    out = []
    for part in schemas.RECORD.split(", "):
        name, kind = part.split(" ", 1)
        absent = F.lit("") if kind == "string" else _none() if kind.startswith("array") else F.lit(None)
        out.append(values.get(name, absent).cast(kind).alias(name))
    return df.select(*out)


def company_records(rows: DataFrame, retrieved_at: str = "") -> DataFrame:
    """Records of register rows (all columns strings); rows without number are left out."""
    rows = rows.toDF(*[c.strip() for c in rows.columns]).filter(F.coalesce(F.trim("CompanyNumber"), F.lit("")) != "")

    def at(name: str) -> Column:
        return F.trim(F.coalesce(F.col(f"`{name}`"), F.lit(""))) if name in rows.columns else F.lit("")

    address = [at(f"RegAddress.{k}") for k in ("CareOf", "POBox", "AddressLine1", "AddressLine2", "PostTown", "County", "Country", "PostCode")]
    name, number = at("CompanyName"), places.company_number(at("CompanyNumber"))
    form = text.legal_form(name)
    country = places.country_code(at("RegAddress.Country"))
    sic = F.filter(F.array(*(F.trim(F.split_part(at(f"SICCode.SicText_{k}"), F.lit(" - "), F.lit(1))) for k in range(1, 5))), lambda x: x != "")
    return _record(rows, {
        "record_id": F.concat(F.lit("ch:company:"), number), "source": F.lit("companies_house"), "entity_type": F.lit("Company"), "name": name, "name_norm": text.normalize_text(name), "name_fp": text.sorted_tokens(form["base"]), "name_phonetic": text.phonetic_key(form["base"]),
        "country": F.when(country != "", country).otherwise("GB"), "jurisdiction": F.lit("GB"), "reg_number": number, "address_full": F.concat_ws(", ", *(F.nullif(a, F.lit("")) for a in address)), "address_norm": places.join_address(*address),
        "postcode": places.postcode(at("RegAddress.PostCode")), "address_blk": places.address_key(*address), "incorporation_date": parse_date(at("IncorporationDate")), "dissolution_date": parse_date(at("DissolutionDate")), "status": at("CompanyStatus"),
        "legal_form": F.when(form["tag"] != "", form["tag"]).otherwise(at("CompanyCategory")), "sic_codes": sic, "source_url": at("URI"), "retrieved_at": F.lit(retrieved_at),
    })


def read_companies(spark: SparkSession, path: str, retrieved_at: str = "") -> DataFrame:
    return company_records(spark.read.csv(path, header=True, multiLine=True, encoding="UTF-8", escape='"'), retrieved_at)


def read_filings(spark: SparkSession, path: str) -> DataFrame:
    """Filings with their kind: 'malformed', 'no_company_number', or what data.kind says."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return filing_rows(lines)


def filing_rows(lines: DataFrame) -> DataFrame:
    """Filings of lines (value), which may be a stream."""
    parsed = lines.select(F.from_json("value", schemas.FILING + ", _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("f"))
    rows = parsed.select("f.company_number", "f.data", "f._corrupt_record")
    bad = F.col("_corrupt_record").isNotNull() | F.col("data").isNull() & F.col("company_number").isNull()
    kind = F.when(bad, "malformed").when(F.coalesce(F.trim("company_number"), F.lit("")) == "", "no_company_number").otherwise(F.coalesce("data.kind", F.lit("")))
    return rows.select("company_number", "data", kind.alias("kind"))


def filing_id(company: Column) -> Column:
    """Last part of the filing's own link, or twelve digits of a hash of its name, date and kind."""
    link = F.regexp_replace(F.coalesce(F.col("data.links.self"), F.lit("")), "/+$", "")
    tail = F.element_at(F.split(link, "/"), -1)
    made = F.substring(F.sha1(F.concat_ws("|", *(F.coalesce(F.col(f"data.{k}"), F.lit("")) for k in ("name", "notified_on", "kind")))), 1, 12)
    return F.concat(F.lit("ch:psc:"), company, F.lit(":"), F.when(tail != "", tail).otherwise(made))


def filing_records(filings: DataFrame, retrieved_at: str = "") -> DataFrame:
    """Records of the persons and companies that filings name."""
    named = filings.filter(F.col("kind").isin(list(FILING_KINDS)))
    number = places.company_number(F.col("company_number"))
    kind = F.create_map(*[F.lit(x) for kv in FILING_KINDS.items() for x in kv])[F.col("kind")]
    person = kind == "Person"

    def d(name: str) -> Column:
        return F.trim(F.coalesce(F.col(f"data.{name}").cast("string"), F.lit("")))

    address = [d(f"address.{k}") for k in ("care_of", "po_box", "premises", "address_line_1", "address_line_2", "locality", "region", "postal_code", "country")]
    e = [d(f"name_elements.{k}") for k in ("forename", "middle_name", "surname")]
    joined = F.concat_ws(" ", *(F.nullif(x, F.lit("")) for x in e))
    name = F.when(d("name") != "", d("name")).otherwise(joined)
    parts = text.person_parts(name, *e)
    form = text.legal_form(name)
    stated = d("identification.country_registered")
    country = places.country_code(F.when(stated != "", stated).otherwise(d("address.country")))
    fp = F.when(person, text.person_fingerprint(parts)).otherwise(text.sorted_tokens(form["base"]))
    raw_number = d("identification.registration_number")
    return _record(named, {
        "record_id": filing_id(number), "source": F.lit("psc"), "entity_type": kind, "name": name, "name_norm": F.when(person, text.strip_titles(name)).otherwise(text.normalize_text(name)), "name_fp": fp, "name_phonetic": text.phonetic_key(fp),
        **{f"{k}_name": F.when(person, parts[k]).otherwise("") for k in ("first", "middle", "last")}, "birth_year": F.when(person, F.col("data.date_of_birth.year")), "birth_month": F.when(person, F.col("data.date_of_birth.month")),
        "nationality": F.when(person, places.country_code(d("nationality"))).otherwise(""), "country": F.when(person, places.country_code(F.when(d("country_of_residence") != "", d("country_of_residence")).otherwise(d("address.country")))).otherwise(country),
        "jurisdiction": F.when(person, "").otherwise(country), "reg_number": F.when(person, "").otherwise(F.when(country.isin("GB", ""), places.company_number(raw_number)).otherwise(raw_number)),
        "address_full": F.concat_ws(", ", *(F.nullif(a, F.lit("")) for a in address)), "address_norm": places.join_address(*address), "postcode": places.postcode(d("address.postal_code")), "address_blk": places.address_key(*address),
        "legal_form": F.when(person, "").otherwise(form["tag"]), "context_company_number": number, "source_url": d("links.self"), "retrieved_at": F.lit(retrieved_at),
    })


def filing_relationships(filings: DataFrame) -> DataFrame:
    """Control edges that filings assert, to companies that the register may lack."""
    named = filings.filter(F.col("kind").isin(list(FILING_KINDS)))
    number = places.company_number(F.col("company_number"))
    rows = named.select(filing_id(number).alias("f"), F.concat(F.lit("ch:company:"), number).alias("t"), control.summarise(F.col("data.natures_of_control")).alias("s"), "data.notified_on", "data.ceased_on")
    return rows.select(
        F.concat(F.lit("rel:"), "f", F.lit("->"), F.substring("t", 12, 100)).alias("rel_id"), F.when(F.col("s.min_percent").isNotNull(), "OWNS").otherwise("CONTROLS").alias("rel_type"), F.col("f").alias("source_record_id"), F.col("t").alias("target_record_id"),
        F.lit("psc").alias("source"), "s.min_percent", "s.max_percent", F.col("s.kinds").alias("control_kinds"), "s.capacities", "s.has_hard_control", "s.via_fiduciary", parse_date(F.col("notified_on")).alias("notified_on"), parse_date(F.col("ceased_on")).alias("ceased_on"),
    )


def kinds(filings: DataFrame) -> DataFrame:
    return filings.groupBy("kind").agg(F.count("*").alias("rows"))


def birth_parts(c: Column) -> Column:
    """struct(year, month) of a date of any precision."""
    t = F.coalesce(c, F.lit(""))
    month = F.when(t.rlike(r"^\d{4}-\d{2}"), F.substring(t, 6, 2).try_cast("int"))
    return F.struct(F.when(t.rlike(r"^\d{4}"), F.substring(t, 1, 4).try_cast("int")).alias("year"), F.when(month.between(1, 12), month).alias("month"))


def sanction_records(rows: DataFrame, retrieved_at: str = "") -> DataFrame:
    """A record for each different name of feed entities (schemas.SANCTIONED), up to MAX_NAMES: the first spelling of each normalised name, in the order of the feed.

    Entities of other schemata are left out.
    """
    table = F.create_map(*[F.lit(x) for kv in SCHEMATA.items() for x in kv])
    ents = rows.withColumn("entity_type", F.try_element_at(table, F.col("schema"))).filter("entity_type is not null and id is not null")

    def all_of(name: str) -> Column:
        return F.coalesce(F.try_element_at("properties", F.lit(name)), _none())

    def first(name: str) -> Column:
        return F.trim(F.coalesce(F.get(all_of(name), 0), F.lit("")))

    names = F.filter(F.concat(*(all_of(k) for k in ("name", "alias", "previousName", "weakAlias"))), lambda x: x.isNotNull() & (x != ""))
    listed = F.transform(names, lambda x, i: F.struct(text.normalize_text(x).alias("norm"), i.alias("pos"), x.alias("raw")))
    # Of each normalised name the first spelling; then in the order of the feed.
    firsts = F.filter(listed, lambda x: (x["norm"] != "") & (F.size(F.filter(F.slice(F.transform(listed, lambda y: y["norm"]), 1, x["pos"]), lambda y: y == x["norm"])) == 0))
    ents = ents.withColumn("v", F.slice(firsts, 1, MAX_NAMES)).select("*", F.posexplode("v").alias("i", "name_variant"))
    person = F.col("entity_type") == "Person"
    name = F.col("name_variant.raw")
    parts, form = text.person_parts(name), text.legal_form(name)
    fp = F.when(person, text.person_fingerprint(parts)).otherwise(text.sorted_tokens(form["base"]))
    born = birth_parts(first("birthDate"))
    return _record(ents, {
        "record_id": F.when(F.col("i") == 0, F.concat(F.lit("os:"), "id")).otherwise(F.concat(F.lit("os:"), "id", F.lit("#"), F.col("i").cast("string"))), "source": F.lit("opensanctions"), "entity_type": F.col("entity_type"), "name": name,
        "name_norm": F.when(person, text.strip_titles(name)).otherwise(F.col("name_variant.norm")), "name_fp": fp, "name_phonetic": text.phonetic_key(fp), **{f"{k}_name": F.when(person, parts[k]).otherwise("") for k in ("first", "middle", "last")},
        "birth_year": F.when(person, born["year"]), "birth_month": F.when(person, born["month"]), "nationality": places.country_code(first("nationality")), "country": places.country_code(first("country")), "jurisdiction": places.country_code(first("jurisdiction")),
        "reg_number": F.when(places.country_code(first("jurisdiction")).isin("GB", ""), places.company_number(first("registrationNumber"))).otherwise(first("registrationNumber")), "address_full": first("address"), "address_norm": places.join_address(first("address")),
        "postcode": places.postcode(first("postalCode")), "address_blk": places.address_key(first("address"), first("postalCode")), "incorporation_date": parse_date(first("incorporationDate")), "dissolution_date": parse_date(first("dissolutionDate")), "status": first("status"),
        "legal_form": F.when(person, "").otherwise(F.when(form["tag"] != "", form["tag"]).otherwise(first("legalForm"))), "topics": F.array_sort(F.array_distinct(all_of("topics"))), "datasets": F.coalesce("datasets", _none()), "source_url": first("sourceUrl"), "retrieved_at": F.lit(retrieved_at),
    })


def read_sanctions(spark: SparkSession, path: str, retrieved_at: str = "") -> DataFrame:
    """Records of a feed, plain or gzipped; malformed lines have no id and are left out."""
    return sanction_records(spark.read.schema(schemas.SANCTIONED).json(path), retrieved_at)


def has_topic(of: list[str] = vocab.SANCTION_TOPICS) -> Column:
    return F.exists("topics", lambda t: t.isin(of))
