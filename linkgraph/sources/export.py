"""FollowTheMoney entities of canonical entities and control edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Properties that each schema may have.
PROPERTIES = {
    "Person": ["name", "alias", "birthDate", "nationality", "country", "topics", "address"],
    "Company": ["name", "alias", "jurisdiction", "country", "registrationNumber", "topics", "legalForm", "address"],
    "LegalEntity": ["name", "alias", "jurisdiction", "country", "registrationNumber", "topics", "legalForm", "address"],
    "Ownership": ["owner", "asset", "percentage", "startDate", "endDate", "role"],
}


def _values(c: Column) -> Column:
    """Sorted different values that aren't empty."""
    return F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isNotNull() & (x != ""))))


def _ftm(df: DataFrame, id_: Column, schema: Column, properties: dict[str, Column]) -> DataFrame:
    made = F.map_from_entries(F.array(*(F.struct(F.lit(k).alias("key"), _values(v).alias("value")) for k, v in properties.items())))
    allowed = F.create_map(*[x for k, v in PROPERTIES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    kept = F.map_filter(made, lambda k, v: (F.size(v) > 0) & F.array_contains(F.coalesce(F.try_element_at(allowed, schema), F.array().cast("array<string>")), k))
    return df.select(id_.alias("id"), schema.alias("schema"), kept.alias("properties"))


def birth_date(year: Column, month: Column | None = None) -> Column:
    """'YYYY-MM', or 'YYYY' without month; null without year."""
    if month is None:
        return F.lpad(year.cast("string"), 4, "0")
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.coalesce(F.concat(F.lit("-"), F.lpad(month.cast("string"), 2, "0")), F.lit("")))


def entities(canonical: DataFrame) -> DataFrame:
    """id, schema, properties of canonical entities."""
    def one(name: str) -> Column:
        return F.array(F.col(name).cast("string"))

    month = F.col("birth_month") if "birth_month" in canonical.columns else None
    return _ftm(canonical, F.col("canonical_id"), F.col("entity_type"), {
        "name": one("name"), "alias": F.filter(F.col("all_names"), lambda x: x != F.col("name")), "birthDate": F.array(birth_date(F.col("birth_year"), month)), "nationality": one("nationality"), "country": one("country"), "jurisdiction": one("jurisdiction"),
        "registrationNumber": one("reg_number"), "topics": F.col("topics"),
    })


def ownerships(edges: DataFrame) -> DataFrame:
    """id, schema, properties of merged edges; a band is 'lo-hi%'."""
    def n(c: str) -> Column:
        return F.regexp_replace(F.col(c).cast("string"), r"\.0$", "")

    share = F.when(F.col("min_percent").isNotNull() & F.col("max_percent").isNotNull(), F.concat(n("min_percent"), F.lit("-"), n("max_percent"), F.lit("%")))
    return _ftm(edges, F.concat(F.lit("own:"), "owner_id", F.lit("->"), "asset_id"), F.lit("Ownership"), {
        "owner": F.array("owner_id"), "asset": F.array("asset_id"), "percentage": F.array(share), "startDate": F.array(F.col("first_notified").cast("string")), "endDate": F.array(F.when(~F.col("is_active"), F.col("last_ceased").cast("string"))), "role": F.col("control_kinds"),
    })


def write(rows: DataFrame, path: str) -> None:
    """JSON lines."""
    rows.select(F.to_json(F.struct("id", "schema", "properties")).alias("value")).write.mode("overwrite").text(path)


def invalid(rows: DataFrame) -> DataFrame:
    """Entities without id or name (or, of ownerships, an end), of unknown schema, or with properties that it lacks."""
    allowed = F.create_map(*[x for k, v in PROPERTIES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    known = F.try_element_at(allowed, F.col("schema"))
    needed = F.when(F.col("schema") == "Ownership", F.map_contains_key("properties", "owner") & F.map_contains_key("properties", "asset")).otherwise(F.map_contains_key("properties", "name"))
    return rows.filter(F.col("id").isNull() | known.isNull() | ~needed | (F.size(F.array_except(F.map_keys("properties"), F.coalesce(known, F.array().cast("array<string>")))) > 0))
