"""A query for each operator over the driver's tables, and DuckDB's SQL for it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkgraph import vocab
from linkgraph.functions import control, places, similarity, text
from linkgraph.operators import analyses, blocking, clusters, evaluate, graph, matching, serving
from linkgraph.operators.components import checkpointed, connected_components
from linkgraph.plans import bridge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def with_phonetic(*more: tuple[str, str]) -> Callable[[Query], Query]:
    """Registers NAME_phonetic beside a query whose SQL knows no phonetic keys: the same over records that have them, and SQL that states Soundex; more: further replacements in it."""

    def add(f: Query) -> Query:
        QUERIES[f"{f.__name__}_phonetic"] = partial(f, phonetic=True)
        ORACLE[f"{f.__name__}_phonetic"] = reduce(lambda sql, x: sql.replace(*x), (*_PHONETIC, *more), ORACLE[f.__name__])
        return f

    return add


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_T = {t: t for t in ("part", "customer", "supplier")}
COMPANIES = f"""co AS (
    SELECT record_id, source, name, trim(regexp_replace(lower(name), '[^a-z0-9_]+', ' ', 'g')) AS name_norm, array_to_string(list_sort(string_split(truth_name, ' ')), ' ') AS name_fp, legal_form,
           CASE WHEN raw_number = '' THEN '' ELSE 'BRAND' || lpad(regexp_replace(raw_number, '[^0-9]', '', 'g'), greatest(length(regexp_replace(raw_number, '[^0-9]', '', 'g')), 3)::INT, '0') END AS reg_number,
           jurisdiction, country, postcode, address_blk, address_norm, truth_name, truth_brand
    FROM ({bridge.BRIDGE_SQL['companies'].format(**_T)}) )"""
PEOPLE = f"""pe AS (
    SELECT *, array_to_string(list_sort([first_name, last_name]), ' ') AS name_fp, first_name || CASE WHEN middle_name = '' THEN '' ELSE ' ' || middle_name END || ' ' || last_name AS name_norm
    FROM ({bridge.BRIDGE_SQL['people'].format(**_T)}) )"""
COMPANY_KEYS = """keys AS (
    SELECT record_id, k.n AS key_name, k.v AS key_value FROM (SELECT record_id, unnest([
        {'n': 'c_reg', 'v': reg_number}, {'n': 'c_fp', 'v': name_fp},
        {'n': 'c_head_pc', 'v': CASE WHEN postcode <> '' THEN split_part(name_fp, ' ', 1) || '|' || postcode ELSE '' END},
        {'n': 'c_addr', 'v': CASE WHEN address_blk <> '' THEN address_blk || '|' || substr(name_fp, 1, 4) ELSE '' END}]) AS k FROM co) WHERE k.v <> ''),
    sizes AS (SELECT key_name, key_value, count(*) AS n, CASE key_name WHEN 'c_reg' THEN 50 WHEN 'c_fp' THEN 300 ELSE 100 END AS cap FROM keys GROUP BY ALL),
    cand AS (SELECT a.record_id AS left_id, b.record_id AS right_id, a.key_name FROM keys a JOIN sizes s ON s.key_name = a.key_name AND s.key_value = a.key_value AND s.n > 1 AND s.n <= s.cap
             JOIN keys b ON a.key_name = b.key_name AND a.key_value = b.key_value AND a.record_id < b.record_id)"""
COMPANY_SCORES = """feat AS (
    SELECT p.left_id, p.right_id, jaro_winkler_similarity(a.name_fp, b.name_fp) AS jw,
           len(list_intersect(string_split(a.name_norm, ' '), string_split(b.name_norm, ' '))) / len(list_distinct(list_concat(string_split(a.name_norm, ' '), string_split(b.name_norm, ' '))))::DOUBLE AS tj,
           CASE WHEN a.reg_number <> '' AND b.reg_number <> '' THEN (a.reg_number = b.reg_number)::INT::DOUBLE END AS reg,
           CASE WHEN a.jurisdiction <> '' AND b.jurisdiction <> '' THEN (a.jurisdiction = b.jurisdiction)::INT::DOUBLE END AS ju,
           CASE WHEN a.country <> '' AND b.country <> '' THEN (a.country = b.country)::INT::DOUBLE END AS cc,
           CASE WHEN a.postcode <> '' AND b.postcode <> '' THEN CASE WHEN a.postcode = b.postcode THEN 1.0 WHEN split_part(a.postcode, ' ', 1) = split_part(b.postcode, ' ', 1) THEN 0.5 ELSE 0.0 END END AS pc,
           len(list_intersect(string_split(a.address_norm, ' '), string_split(b.address_norm, ' '))) / len(list_distinct(list_concat(string_split(a.address_norm, ' '), string_split(b.address_norm, ' '))))::DOUBLE AS aj,
           CASE WHEN a.legal_form <> '' AND b.legal_form <> '' THEN (a.legal_form = b.legal_form)::INT::DOUBLE END AS lf
    FROM (SELECT DISTINCT left_id, right_id FROM cand) p JOIN co a ON a.record_id = p.left_id JOIN co b ON b.record_id = p.right_id),
    sc AS (SELECT left_id, right_id, 1 / (1 + exp(-(-2.2 + coalesce(jw * 2.8 + (1 - jw) * -3.2, 0) + coalesce(tj * 1.2 + (1 - tj) * -1.0, 0) + coalesce(reg * 5.0 + (1 - reg) * -2.5, 0) + coalesce(ju * 0.9 + (1 - ju) * -2.0, 0)
        + coalesce(cc * 0.5 + (1 - cc) * -0.8, 0) + coalesce(pc * 1.1 + (1 - pc) * -0.4, 0) + coalesce(aj * 0.6 + (1 - aj) * -0.3, 0) + coalesce(lf * 0.5 + (1 - lf) * -0.7, 0)))) AS score FROM feat),
    dec AS (SELECT *, CASE WHEN score >= 0.92 THEN 'accept' WHEN score < 0.62 THEN 'reject' ELSE 'uncertain' END AS decision FROM sc)"""
REL = f"rel AS ({bridge.BRIDGE_SQL['relationships'].format(**_T)})"
ENT = f"ent AS ({bridge.BRIDGE_SQL['entities'].format(**_T)})"
EDGES = """edges AS (SELECT 'ent:' || source_record_id AS owner_id, 'ent:' || target_record_id AS asset_id, min(min_percent)::DOUBLE AS min_percent, max(max_percent)::DOUBLE AS max_percent, bool_or(has_hard_control) AS has_hard_control, bool_or(via_fiduciary) AS via_fiduciary, count(*) AS n_filings,
    array_to_string(list_sort(list(DISTINCT CASE WHEN min_percent IS NULL THEN 'APPOINT_DIRECTORS' ELSE 'SHARES' END)), ',') AS control_kinds, CASE WHEN bool_or(via_fiduciary) THEN 'TRUST' ELSE '' END AS capacities
    FROM rel WHERE ceased_on IS NULL GROUP BY 1, 2)"""
WALK = """walk AS (
    SELECT owner_id AS root_id, asset_id, 1 AS hops, coalesce(min_percent, 0.0) / 100 AS min_share, coalesce(max_percent, 100.0) / 100 AS max_share, min_percent IS NULL AS control_only, via_fiduciary, [owner_id, asset_id] AS path FROM edges
    UNION ALL
    SELECT w.root_id, e.asset_id, w.hops + 1, w.min_share * (coalesce(e.min_percent, 0.0) / 100), w.max_share * (coalesce(e.max_percent, 100.0) / 100), w.control_only OR e.min_percent IS NULL, w.via_fiduciary OR e.via_fiduciary, list_append(w.path, e.asset_id)
    FROM walk w JOIN edges e ON e.owner_id = w.asset_id WHERE w.hops < 6 AND NOT list_contains(w.path, e.asset_id)),
    tops AS (SELECT * FROM walk w WHERE NOT EXISTS (SELECT 1 FROM walk u WHERE u.asset_id = w.root_id))"""
GRAPH = f"WITH RECURSIVE {REL}, {ENT}, {EDGES}, {WALK}"
FLAGGED = f"topic IN {_in(vocab.SANCTION_TOPICS)}"
SECRET = _in(vocab.SECRECY)


def _closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.control_closure(graph.edges(bridge.relationships(spark, sf_dir)))


_CODES = "translate(regexp_replace(lower(w), '[^a-z]', 'a', 'g'), 'abcdefghijklmnopqrstuvwxyz', '01230127022455012623017202')"
#: Equal codes in a row count once, with h and w (7) between them too, and the first letter's own code is dropped.
_RUNS = reduce(lambda x, d: f"regexp_replace({x}, '{d}+', '{d}', 'g')", "123456", f"(substr({_CODES}, 1, 1) || replace(substr({_CODES}, 2), '7', ''))")
_SOUNDEX = f"array_to_string([CASE WHEN regexp_matches(w, '^[a-z]') THEN upper(substr(w, 1, 1)) || rpad(substr(replace(substr({_RUNS}, 2), '0', ''), 1, 3), 3, '0') ELSE w END FOR w IN string_split(name_fp, ' ')], ' ') AS name_phonetic"


def _sounding(sql: str, name: str) -> str:
    return f"{sql.replace(f'{name} AS (', f'{name}_mute AS (', 1)}, {name} AS (SELECT *, {_SOUNDEX} FROM {name}_mute)"


_PHONETIC = [
    (COMPANIES, _sounding(COMPANIES, "co")), (PEOPLE, _sounding(PEOPLE, "pe")),
    ("{'n': 'c_fp', 'v': name_fp},", "{'n': 'c_fp', 'v': name_fp}, {'n': 'c_phon', 'v': name_phonetic},"), ("WHEN 'c_fp' THEN 300", "WHEN 'c_fp' THEN 300 WHEN 'c_phon' THEN 300"),
    ("{'n': 'p_fp', 'v': name_fp},", "{'n': 'p_fp', 'v': name_fp}, {'n': 'p_phon_dob', 'v': name_phonetic || '|' || birth_year},"),
    ("END AS reg,", "END AS reg, CASE WHEN a.name_phonetic <> '' AND b.name_phonetic <> '' THEN (a.name_phonetic = b.name_phonetic)::INT::DOUBLE END AS ph,"), ("coalesce(reg * 5.0", "coalesce(ph * 0.9 + (1 - ph) * -0.2, 0) + coalesce(reg * 5.0"),
]


def _companies(spark: SparkSession, sf_dir: str, phonetic: bool) -> DataFrame:
    """Without phonetic as the plain queries' SQL has them: c_phon makes no keys and phonetic_exact is null."""
    c = bridge.companies(spark, sf_dir)
    return c if phonetic else c.withColumn("name_phonetic", F.lit(""))


def _people(spark: SparkSession, sf_dir: str, phonetic: bool) -> DataFrame:
    c = bridge.people(spark, sf_dir)
    return c if phonetic else c.withColumn("name_phonetic", F.lit(""))


def _company_pairs(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> tuple[DataFrame, DataFrame]:
    records = checkpointed(_companies(spark, sf_dir, phonetic))  # names are normalised once, not in each join
    return records, blocking.candidate_pairs(blocking.blocking_keys(records))


def _company_scores(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    records, pairs = _company_pairs(spark, sf_dir, phonetic)
    return records, pairs, matching.score(matching.features(pairs, records, "Company"), matching.COMPANY_WEIGHTS)


# Text and places


@query(f"WITH {COMPANIES} SELECT record_id, name_norm, name_fp, legal_form FROM co")
def company_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-02..04: normalised name, fingerprint and legal form."""
    c = bridge.view(spark, sf_dir, "companies")
    return c.select("record_id", text.normalize_text(F.col("name")).alias("name_norm"), text.company_fingerprint(F.col("name")).alias("name_fp"), text.legal_form(F.col("name"))["tag"].alias("legal_form"))


@query("""SELECT doc_id, md5(trim(regexp_replace(strip_accents(replace(replace(lower(text), 'ß', 'ss'), 'ø', 'o')), '[^a-z0-9_]+', ' ', 'g'))) AS folded FROM documents""")
def fold_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-01: whole texts folded and normalised."""
    return bridge.table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalize_text(F.col("text"))).alias("folded"))


@query("""SELECT c_custkey, 'james' AS first, CASE WHEN c_custkey % 2 = 0 THEN 'lee' ELSE '' END AS middle, lower(c_mktsegment) AS last,
          array_to_string(list_sort(['james', lower(c_mktsegment)]), ' ') AS fingerprint FROM customer""")
def person_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-05..07: titles off, parts and fingerprint."""
    name = F.concat(F.lit("Dr Sir James "), F.when(F.col("c_custkey") % 2 == 0, "Lee ").otherwise(""), F.col("c_mktsegment"), F.lit(" PhD III"))
    p = text.person_parts(name)
    return bridge.table(spark, sf_dir, "customer").select("c_custkey", p["first"].alias("first"), p["middle"].alias("middle"), p["last"].alias("last"), text.person_fingerprint(p).alias("fingerprint"))


@query(f"SELECT p_partkey, name_phonetic AS phonetic FROM (SELECT p_partkey, {_SOUNDEX.replace('name_fp', 'lower(p_name)')} FROM part)")
def phonetic_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-08: Soundex of each word."""
    return bridge.table(spark, sf_dir, "part").select("p_partkey", text.phonetic_key(F.col("p_name")).alias("phonetic"))


@query("""SELECT c_custkey, 'AB' || (c_custkey % 90 + 1) || ' ' || (c_custkey % 10) || 'CD' AS postcode, 'AB' || (c_custkey % 90 + 1) AS district, 'AB' AS area,
          c_custkey || '|AB' || (c_custkey % 90 + 1) || ' ' || (c_custkey % 10) || 'CD' AS address_key, lower(c_mktsegment) || ' lane 7' AS loose_norm, CASE WHEN c_mktsegment = 'BUILDING' THEN '7' ELSE lower(c_mktsegment) || ' 7' END AS loose_key FROM customer""")
def postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ADR-01..04: postcodes and address keys."""
    raw = F.concat(F.lit(" ab"), (F.col("c_custkey") % 90 + 1).cast("string"), F.lit("  "), (F.col("c_custkey") % 10).cast("string"), F.lit("cd "))
    parts = [F.concat(F.col("c_custkey").cast("string"), F.lit(", High Street")), F.lit(""), raw]
    loose = [F.col("c_mktsegment"), F.lit("Lane 7.")]
    return bridge.table(spark, sf_dir, "customer").select(
        "c_custkey", places.postcode(raw).alias("postcode"), places.postcode_district(raw).alias("district"), places.postcode_area(raw).alias("area"), places.address_key(*parts).alias("address_key"), places.join_address(*loose).alias("loose_norm"), places.address_key(*loose).alias("loose_key")
    )


@query(f"SELECT s_suppkey, {bridge.pick(['GB', 'CY', 'VG', 'DE', 'US', '', 'GB', 'FR', ''], 's_suppkey % 9')} AS iso, s_suppkey % 9 IN (1, 2) AS secrecy FROM supplier")
def country_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CTY-01, CTY-02: names and demonyms to codes."""
    word = F.expr(bridge.pick(bridge.COUNTRY_WORDS, "s_suppkey % 9"))
    iso = places.country_code(word)
    return bridge.table(spark, sf_dir, "supplier").select("s_suppkey", iso.alias("iso"), places.is_secrecy(iso).alias("secrecy"))


@query("""SELECT s_suppkey, lpad(s_suppkey::VARCHAR, greatest(length(s_suppkey::VARCHAR), 8)::INT, '0') AS plain, 'SC' || lpad(s_suppkey::VARCHAR, greatest(length(s_suppkey::VARCHAR), 6)::INT, '0') AS prefixed, '' AS nothing FROM supplier""")
def company_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-01: registration numbers padded."""
    k = F.col("s_suppkey").cast("string")
    return bridge.table(spark, sf_dir, "supplier").select("s_suppkey", places.company_number(k).alias("plain"), places.company_number(F.concat(F.lit("sc "), k)).alias("prefixed"), places.company_number(F.lit(" -")).alias("nothing"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity < 30 THEN 25.0 WHEN l_quantity < 45 THEN 50.0 END AS min_percent, CASE WHEN l_quantity < 30 THEN 50.0 WHEN l_quantity < 45 THEN 75.0 END AS max_percent,
          CASE WHEN l_quantity < 45 THEN 'SHARES,VOTING' ELSE 'APPOINT_DIRECTORS' END AS kinds, l_quantity >= 45 OR l_quantity >= 30 AS hard, l_linestatus = 'F' AS fiduciary, CASE WHEN l_linestatus = 'F' THEN 'TRUST' ELSE '' END AS capacities FROM lineitem""")
def control_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CTL-01, CTL-02: statements of control, shares before votes."""
    q = F.col("l_quantity")
    band = F.when(q < 30, "25-to-50-percent").otherwise("50-to-75-percent")
    how = F.when(F.col("l_linestatus") == "F", "-as-trust").otherwise("")
    natures = F.when(q < 45, F.array(F.concat(F.lit("ownership-of-shares-"), band, how), F.lit("voting-rights-75-to-100-percent-").substr(1, 24))).otherwise(F.array(F.concat(F.lit("right-to-appoint-and-remove-directors"), how)))
    s = control.summarise(natures)
    return bridge.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", s["min_percent"].alias("min_percent"), s["max_percent"].alias("max_percent"), F.array_join(s["kinds"], ",").alias("kinds"), s["has_hard_control"].alias("hard"), s["via_fiduciary"].alias("fiduciary"), F.array_join(s["capacities"], ",").alias("capacities"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03's reading of nested JSON; malformed text gives null."""
    return bridge.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


# Similarities


@query("""WITH n AS (SELECT DISTINCT p_name FROM part) SELECT a.p_name AS a, b.p_name AS b, round(jaro_winkler_similarity(a.p_name, b.p_name), 6) AS jw,
          round(len(list_intersect(string_split(a.p_name, ' '), string_split(b.p_name, ' '))) / len(list_distinct(list_concat(string_split(a.p_name, ' '), string_split(b.p_name, ' ')))), 6) AS jaccard, levenshtein(a.p_name, b.p_name) AS edits
          FROM n a JOIN n b ON a.p_name < b.p_name""")
def name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIM-01, SIM-02, SIM-08 between all different part names (a list that doesn't grow with the table)."""
    n = bridge.table(spark, sf_dir, "part").select("p_name").distinct()
    pairs = n.select(F.col("p_name").alias("a")).join(n.select(F.col("p_name").alias("b")), F.col("a") < F.col("b"))
    out = similarity.with_jaro_winkler(pairs, {"jw": ("a", "b")})
    return out.select("a", "b", F.round("jw", 6).alias("jw"), F.round(similarity.token_jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"), F.levenshtein("a", "b").alias("edits"))


# Blocking


@with_phonetic()
@query(f"WITH {COMPANIES}, {COMPANY_KEYS} SELECT record_id, key_name, key_value, 'Company' AS entity_type FROM keys")
def block_keys(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """BLK-01, PRJ-01, SET-01."""
    return blocking.blocking_keys(_companies(spark, sf_dir, phonetic))


@with_phonetic()
@query(f"WITH {COMPANIES}, {COMPANY_KEYS} SELECT key_name, key_value, n, n > 1 AND n <= cap AS usable FROM sizes")
def block_sizes(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """AGG-01."""
    return blocking.block_sizes(blocking.blocking_keys(_companies(spark, sf_dir, phonetic)))


@with_phonetic()
@query(f"WITH {COMPANIES}, {COMPANY_KEYS} SELECT left_id, right_id, array_to_string(list_sort(list(DISTINCT key_name)), ',') AS block_keys, count(DISTINCT key_name)::INT AS n_keys FROM cand GROUP BY ALL")
def candidate_pairs(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """BLK-02, JOIN-01, AGG-02."""
    _, pairs = _company_pairs(spark, sf_dir, phonetic)
    return pairs.withColumn("block_keys", F.array_join("block_keys", ","))


_PEOPLE_KEYS = """keys AS (SELECT record_id, k.n AS key_name, k.v AS key_value FROM (SELECT record_id, unnest([
        {'n': 'p_fp_dob', 'v': name_fp || '|' || birth_year}, {'n': 'p_fp', 'v': name_fp}, {'n': 'p_last_dob', 'v': last_name || '|' || birth_year}, {'n': 'p_first_dob', 'v': first_name || '|' || birth_year},
        {'n': 'p_last_init_pc', 'v': last_name || '|' || substr(first_name, 1, 1) || '|' || postcode}, {'n': 'p_dob_pc', 'v': birth_year || '|' || postcode}]) AS k FROM pe)),
    sizes AS (SELECT key_name, key_value, count(*) AS n, CASE key_name WHEN 'p_fp' THEN 300 WHEN 'p_last_init_pc' THEN 100 WHEN 'p_dob_pc' THEN 100 ELSE 200 END AS cap FROM keys GROUP BY ALL),
    cand AS (SELECT a.record_id AS left_id, b.record_id AS right_id, a.key_name FROM keys a JOIN sizes s ON s.key_name = a.key_name AND s.key_value = a.key_value AND s.n > 1 AND s.n <= s.cap
             JOIN keys b ON a.key_name = b.key_name AND a.key_value = b.key_value AND a.record_id < b.record_id)"""


@with_phonetic()
@query(f"WITH {PEOPLE}, {_PEOPLE_KEYS} SELECT left_id, right_id, array_to_string(list_sort(list(DISTINCT key_name)), ',') AS block_keys FROM cand GROUP BY ALL")
def candidate_pairs_people(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """BLK-02 with the keys of persons."""
    pairs = blocking.candidate_pairs(blocking.blocking_keys(_people(spark, sf_dir, phonetic)))
    return pairs.select("left_id", "right_id", F.array_join("block_keys", ",").alias("block_keys"))


@with_phonetic()
@query(f"""WITH {COMPANIES}, {COMPANY_KEYS} SELECT key_name, count(*) AS blocks, count(*) FILTER (WHERE n > 1 AND n <= cap) AS usable_blocks, count(*) FILTER (WHERE n > cap) AS oversized_blocks, max(n) AS largest_block,
           coalesce(sum(n * (n - 1) // 2) FILTER (WHERE n > 1 AND n <= cap), 0)::BIGINT AS pairs FROM sizes GROUP BY 1""")
def blocking_report(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """BLK-03, AGG-03."""
    return blocking.report(blocking.blocking_keys(_companies(spark, sf_dir, phonetic)))


_TRUTH = """truth AS (SELECT a.record_id AS left_id, b.record_id AS right_id FROM co a JOIN co b ON a.truth_name = b.truth_name AND a.truth_brand = b.truth_brand AND a.record_id < b.record_id)"""


def _truth(records: DataFrame) -> DataFrame:
    return evaluate.truth_pairs(records.select(F.concat_ws("|", "truth_name", "truth_brand").alias("truth_id"), "record_id"))


@with_phonetic()
@query(f"""WITH {COMPANIES}, {COMPANY_KEYS}, {_TRUTH} SELECT key_name, count(*) AS found, round(count(*) / (SELECT count(*) FROM truth), 6) AS completeness
           FROM (SELECT DISTINCT key_name, left_id, right_id FROM cand) JOIN truth USING (left_id, right_id) GROUP BY 1""")
def pair_completeness(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """AGG-04, JOIN-08."""
    records = _companies(spark, sf_dir, phonetic)
    return blocking.completeness(blocking.blocking_keys(records), _truth(records)).withColumn("completeness", F.round("completeness", 6))


@with_phonetic()
@query(f"""WITH {COMPANIES}, {COMPANY_KEYS}, c AS (SELECT count(*) AS n FROM co), p AS (SELECT count(*) AS m FROM (SELECT DISTINCT left_id, right_id FROM cand))
           SELECT n AS records, m AS candidate_pairs, n * (n - 1) // 2 AS naive_pairs, round(1 - m / (n * (n - 1) // 2), 9) AS reduction_ratio FROM c, p""")
def reduction_ratio(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """AGG-05."""
    records, pairs = _company_pairs(spark, sf_dir, phonetic)
    return blocking.reduction(records, pairs).withColumn("reduction_ratio", F.round("reduction_ratio", 9))


# Matching


@with_phonetic((", lf FROM feat", ", lf, ph FROM feat"))
@query(f"""WITH {COMPANIES}, {COMPANY_KEYS}, {COMPANY_SCORES} SELECT left_id, right_id, round(jw, 6) AS jw, round(tj, 6) AS tj, reg, ju, cc, pc, round(aj, 6) AS aj, lf FROM feat""")
def company_features(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """PRJ-02, JOIN-02, SIM-03, SIM-05."""
    records, pairs = _company_pairs(spark, sf_dir, phonetic)
    f = matching.features(pairs, records, "Company")
    shown = f.select("left_id", "right_id", F.round("name_fp_jw", 6).alias("jw"), F.round("name_token_jaccard", 6).alias("tj"), F.col("reg_number_match").alias("reg"), F.col("jurisdiction_match").alias("ju"), F.col("country_match").alias("cc"), F.col("postcode_level").alias("pc"), F.round("address_jaccard", 6).alias("aj"), F.col("legal_form_match").alias("lf"), F.col("phonetic_exact").alias("ph"))
    return shown if phonetic else shown.drop("ph")


@with_phonetic((" AS mid\n", " AS mid, (a.name_phonetic = b.name_phonetic)::INT::DOUBLE AS ph\n"))
@query(f"""WITH {PEOPLE}, {_PEOPLE_KEYS} SELECT left_id, right_id, round(jaro_winkler_similarity(a.name_fp, b.name_fp), 6) AS fp, round(jaro_winkler_similarity(a.last_name, b.last_name), 6) AS l, round(jaro_winkler_similarity(a.first_name, b.first_name), 6) AS f,
    round(greatest((jaro_winkler_similarity(a.first_name, b.first_name) + jaro_winkler_similarity(a.last_name, b.last_name)) / 2, (jaro_winkler_similarity(a.first_name, b.last_name) + jaro_winkler_similarity(a.last_name, b.first_name)) / 2), 6) AS x,
    (a.birth_year = b.birth_year)::INT::DOUBLE AS y, (a.birth_month = b.birth_month)::INT::DOUBLE AS m,
    CASE WHEN a.middle_name = '' OR b.middle_name = '' THEN NULL WHEN a.middle_name = b.middle_name OR (length(a.middle_name) = 1 AND starts_with(b.middle_name, a.middle_name)) OR (length(b.middle_name) = 1 AND starts_with(a.middle_name, b.middle_name)) THEN 1.0 ELSE 0.0 END AS mid
    FROM (SELECT DISTINCT left_id, right_id FROM cand) p JOIN pe a ON a.record_id = left_id JOIN pe b ON b.record_id = right_id""")
def person_features(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """PRJ-02 of persons, SIM-04, SIM-06."""
    records = _people(spark, sf_dir, phonetic)
    f = matching.features(blocking.candidate_pairs(blocking.blocking_keys(records)), records, "Person")
    shown = f.select("left_id", "right_id", F.round("name_fp_jw", 6).alias("fp"), F.round("last_jw", 6).alias("l"), F.round("first_jw", 6).alias("f"), F.round("cross_name_jw", 6).alias("x"), F.col("birth_year_match").alias("y"), F.col("birth_month_match").alias("m"), F.col("middle_compat").alias("mid"), F.col("phonetic_exact").alias("ph"))
    return shown if phonetic else shown.drop("ph")


@with_phonetic()
@query(f"WITH {COMPANIES}, {COMPANY_KEYS}, {COMPANY_SCORES} SELECT left_id, right_id, 'rules' AS matcher, round(score, 6) AS score, decision FROM dec")
def rule_scores(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """MAT-01, PRJ-03."""
    s = _company_scores(spark, sf_dir, phonetic)[2]
    return s.select("left_id", "right_id", "matcher", F.round("score", 6).alias("score"), "decision")


@query()
def rule_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAT-02, PRJ-05, PRJ-06: features as JSON, rationale and ranked contributions."""
    records, pairs = _company_pairs(spark, sf_dir, phonetic=True)
    f = matching.features(pairs, records, "Company")
    said = matching.score(f, matching.COMPANY_WEIGHTS).select("left_id", "right_id", "features", "rationale")
    return said.join(matching.explain(f, matching.COMPANY_WEIGHTS).select("left_id", "right_id", F.to_json("contributions").alias("contributions")), ["left_id", "right_id"])


@with_phonetic()
@query(f"WITH {COMPANIES}, {COMPANY_KEYS}, {COMPANY_SCORES} SELECT 'rules' AS matcher, decision, count(*) AS pairs FROM dec GROUP BY ALL")
def decision_histogram(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """AGG-12."""
    return matching.histogram(_company_scores(spark, sf_dir, phonetic)[2])


@with_phonetic()
@query(f"WITH {COMPANIES}, {COMPANY_KEYS}, {COMPANY_SCORES} SELECT left_id, right_id, round(score, 6) AS score FROM dec WHERE decision = 'uncertain' ORDER BY round(score, 9) DESC, left_id, right_id LIMIT 50")
def uncertain_topn(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """SRT-04."""
    s = _company_scores(spark, sf_dir, phonetic)[2].withColumn("score", F.round("score", 9))
    return matching.uncertain_band(s, 50).select("left_id", "right_id", F.round("score", 6).alias("score"))


# Clusters

_CC = f"""WITH RECURSIVE {COMPANIES}, {COMPANY_KEYS}, {COMPANY_SCORES}, e AS (SELECT left_id AS u, right_id AS v FROM dec WHERE decision = 'accept' UNION SELECT right_id, left_id FROM dec WHERE decision = 'accept'),
    reach AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM reach r JOIN e ON e.u = r.v), comp AS (SELECT u AS record_id, least(u, min(v)) AS component FROM reach GROUP BY u)"""


@with_phonetic()
@query(f"{_CC} SELECT record_id AS node, component FROM comp")
def components(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """CLU-01."""
    return connected_components(_company_scores(spark, sf_dir, phonetic)[2].filter("decision = 'accept'"), "left_id", "right_id")


@with_phonetic()
@query(f"""{_CC}, n AS (SELECT component, count(DISTINCT nullif(reg_number, '')) AS n_reg_number, count(DISTINCT nullif(jurisdiction, '')) AS n_jurisdiction FROM comp JOIN co USING (record_id) GROUP BY 1)
           SELECT * FROM n WHERE n_reg_number > 1 OR n_jurisdiction > 2""")
def cluster_conflicts(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """CLU-02."""
    records, _, s = _company_scores(spark, sf_dir, phonetic)
    parts = connected_components(s.filter("decision = 'accept'"), "left_id", "right_id").withColumnRenamed("node", "record_id")
    return clusters.conflicts(records.join(parts, "record_id"), [r for r in clusters.RULES if r.entity_type == "Company"])


@query()
def split_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLU-03, CLU-04: clusters after conflicted components are split along their weakest links."""
    records, _, s = _company_scores(spark, sf_dir, phonetic=True)
    return clusters.build_clusters(records, checkpointed(s))


@with_phonetic()
@query(f"""{_CC}, m AS (SELECT c.*, coalesce(p.component, c.record_id) AS cl FROM co c LEFT JOIN comp p USING (record_id))
           SELECT 'ent:' || cl AS canonical_id, count(*) AS n_records, array_to_string(list_sort(list(DISTINCT name)), '|') AS all_names, array_to_string(list_sort(list(record_id)), ',') AS record_ids, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources,
           {", ".join(f"coalesce(list_sort(list_transform(map_entries(histogram(nullif({c}, ''))), lambda e: {{{{'n': -e.value::BIGINT, 'v': e.key}}}}))[1].v, '') AS {c}".replace("{{", "{").replace("}}", "}") for c in ("name", "country", "jurisdiction", "reg_number", "postcode"))} FROM m GROUP BY cl""")
def canonical_entities(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """CLU-05, AGG-07 over unsplit clusters."""
    records, _, s = _company_scores(spark, sf_dir, phonetic)
    made = clusters.canonical_entities(records, clusters.build_clusters(records, checkpointed(s), split_conflicts=False))
    return made.select("canonical_id", "n_records", F.array_join("all_names", "|").alias("all_names"), F.array_join("record_ids", ",").alias("record_ids"), F.array_join("sources", ",").alias("sources"), "name", "country", "jurisdiction", "reg_number", "postcode")


@query(f"""WITH {COMPANIES}, k AS (SELECT name_fp, v, count(*) AS n FROM (SELECT name_fp, nullif(jurisdiction, '') AS v FROM co) WHERE v IS NOT NULL GROUP BY ALL),
           r AS (SELECT name_fp, v, row_number() OVER (PARTITION BY name_fp ORDER BY n DESC, v) AS i FROM k) SELECT n.name_fp, v AS jurisdiction FROM (SELECT DISTINCT name_fp FROM co) n LEFT JOIN r ON r.name_fp = n.name_fp AND i = 1""")
def modal_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-06: the most frequent observed value, of equals the smallest."""
    return bridge.companies(spark, sf_dir).groupBy("name_fp").agg(F.mode(F.nullif("jurisdiction", F.lit("")), True).alias("jurisdiction"))


# The control graph


def _flat(edges: DataFrame) -> DataFrame:
    return edges.withColumns({k: F.array_join(k, ",") for k in ("control_kinds", "capacities")} | {k: F.col(k).cast("string") for k in ("first_notified", "last_ceased")})


@query(f"WITH {REL}, {EDGES} SELECT *, '2015-01-01' AS first_notified, NULL::VARCHAR AS last_ceased, true AS is_active FROM edges")
def edge_merge_pre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08: active filings merged."""
    return _flat(graph.edges(bridge.relationships(spark, sf_dir)))


#: Every ten suppliers are one entity.
_GROUPED = "CASE WHEN starts_with({0}, 'sup:') THEN 'ent:group:' || (substr({0}, 5)::BIGINT % 10) ELSE 'ent:' || {0} END"


@query(f"""WITH {REL} SELECT {_GROUPED.format('source_record_id')} AS owner_id, {_GROUPED.format('target_record_id')} AS asset_id, min(min_percent)::DOUBLE AS min_percent, max(max_percent)::DOUBLE AS max_percent,
           bool_or(has_hard_control) AS has_hard_control, bool_or(via_fiduciary) AS via_fiduciary, count(*) AS n_filings, max(ceased_on)::VARCHAR AS last_ceased, bool_or(ceased_on IS NULL) AS is_active FROM rel GROUP BY 1, 2""")
def edge_merge_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-03: ends re-pointed to the clusters of their records; those without one keep their record."""
    records = bridge.table(spark, sf_dir, "supplier").select(F.concat(F.lit("sup:"), F.col("s_suppkey")).alias("record_id"), F.concat(F.lit("ent:group:"), F.col("s_suppkey") % 10).alias("canonical_id"))
    return _flat(graph.edges(bridge.relationships(spark, sf_dir), records, merge_before_filter=True)).select("owner_id", "asset_id", "min_percent", "max_percent", "has_hard_control", "via_fiduciary", "n_filings", "last_ceased", "is_active")


@query(f"""WITH {REL} SELECT 'ent:' || source_record_id AS owner_id, 'ent:' || target_record_id AS asset_id, min(min_percent)::DOUBLE AS min_percent, max(max_percent)::DOUBLE AS max_percent, count(*) AS n_filings, bool_or(ceased_on IS NULL) AS is_active FROM rel GROUP BY 1, 2""")
def edge_merge_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08, D2: all filings merged, then judged."""
    return graph.edges(bridge.relationships(spark, sf_dir), merge_before_filter=True).select("owner_id", "asset_id", "min_percent", "max_percent", "n_filings", "is_active")


@query(f"{GRAPH} SELECT root_id, asset_id, hops, round(min_share, 9) AS min_share, round(max_share, 9) AS max_share, control_only, via_fiduciary, array_to_string(path, '>') AS path FROM walk")
def control_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-01."""
    return _closure(spark, sf_dir).withColumns({"min_share": F.round("min_share", 9), "max_share": F.round("max_share", 9), "path": F.array_join("path", ">")})


@query(f"""WITH RECURSIVE {REL}, {EDGES}, walk AS (SELECT owner_id AS root_id, asset_id, 1 AS hops, [owner_id, asset_id] AS path FROM edges
           UNION ALL SELECT w.root_id, e.asset_id, w.hops + 1, list_append(w.path, e.asset_id) FROM walk w JOIN edges e ON e.owner_id = w.asset_id WHERE w.hops < 6 AND (e.asset_id = w.root_id OR NOT list_contains(w.path, e.asset_id)))
           SELECT DISTINCT root_id, hops, array_to_string(path, '>') AS path FROM walk WHERE asset_id = root_id""")
def control_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-02."""
    return graph.cycles(graph.edges(bridge.relationships(spark, sf_dir))).withColumn("path", F.array_join("path", ">"))


@query(f"""{GRAPH} SELECT array_to_string(path, '>') AS path, hops FROM walk WHERE root_id = 'ent:cust:3' AND asset_id = (SELECT asset_id FROM walk WHERE root_id = 'ent:cust:3' ORDER BY hops DESC, asset_id LIMIT 1)""")
def chain_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-02: the chains to the farthest entity below one."""
    active = graph.edges(bridge.relationships(spark, sf_dir))
    reach = graph.walk(active, spark.createDataFrame([("ent:cust:3",)], "root_id string"))
    far = reach.orderBy(F.desc("hops"), "asset_id").select(F.col("asset_id").alias("_far")).limit(1)
    return reach.join(F.broadcast(far), F.col("asset_id") == F.col("_far")).select(F.array_join("path", ">").alias("path"), "hops")


_NEAR = """SELECT {other} AS entity, hops, CASE WHEN NOT control_only THEN round(min_share * 100, 3) END AS min_percent, CASE WHEN NOT control_only THEN round(max_share * 100, 3) END AS max_percent, control_only, via_fiduciary, array_to_string({path}, '>') AS path
    FROM (SELECT *, row_number() OVER (PARTITION BY {other} ORDER BY hops, {path}) AS i FROM walk WHERE {one} = '{id}' AND root_id <> asset_id) WHERE i = 1"""


def _named(found: DataFrame) -> DataFrame:
    return found.withColumnRenamed("asset_id", "entity").withColumn("path", F.array_join("path", ">"))


@query(f"{GRAPH} {_NEAR.format(other='asset_id', one='root_id', id='ent:cust:5', path='path')}")
def walk_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-10 downwards, WIN-01."""
    return _named(graph.ownership(graph.edges(bridge.relationships(spark, sf_dir)), "ent:cust:5", "down"))


@query(f"{GRAPH} {_NEAR.format(other='root_id', one='asset_id', id='ent:sup:5', path='list_reverse(path)')}")
def walk_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-10 upwards."""
    return _named(graph.ownership(graph.edges(bridge.relationships(spark, sf_dir)), "ent:sup:5", "up"))


_LONG = GRAPH.replace("w.hops < 6", "w.hops < 8")


@query(f"{_LONG} SELECT array_to_string(path, '>') AS path, hops, round(max_share, 9) AS max_share FROM walk WHERE root_id = 'ent:cust:5' AND asset_id = 'ent:sup:5' ORDER BY hops, array_to_string(path, '|') LIMIT 25")
def shortest_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-02: up to 25 chains of up to 8 hops from one entity to another."""
    found = graph.chains(graph.edges(bridge.relationships(spark, sf_dir)), "ent:cust:5", "ent:sup:5")
    return found.select(F.array_join("path", ">").alias("path"), "hops", F.round("max_share", 9).alias("max_share"))


@query(f"""WITH RECURSIVE {REL}, {EDGES}, walk AS (SELECT owner_id AS root_id, asset_id, 1 AS hops, [owner_id, asset_id] AS path FROM edges
           UNION ALL SELECT w.root_id, e.asset_id, w.hops + 1, list_append(w.path, e.asset_id) FROM walk w JOIN edges e ON e.owner_id = w.asset_id WHERE w.asset_id <> w.root_id AND w.hops < 6 AND (e.asset_id = w.root_id OR NOT list_contains(w.path, e.asset_id)))
           SELECT root_id AS entity_id, name AS entity_name, hops AS cycle_length, array_to_string(path, '>') AS cycle FROM (SELECT DISTINCT root_id, hops, path FROM walk WHERE asset_id = root_id AND hops >= 2) LEFT JOIN ent_ ON ent_.canonical_id = root_id
           ORDER BY cycle_length, cycle LIMIT 100""".replace(", walk AS", f", {ENT.replace('ent AS', 'ent_ AS', 1)}, walk AS", 1))
def circular_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-03: cycles of 2 to 6 hops that meet their root once."""
    found = graph.cycles(graph.edges(bridge.relationships(spark, sf_dir)), min_hops=2, simple_only=True)
    return analyses.cycle_report(found, bridge.entities(spark, sf_dir)).withColumn("cycle", F.array_join("cycle", ">"))


@query(f"""{GRAPH}, x AS (SELECT asset_id, root_id, r.name AS risk_name, min(hops) AS hops, max(max_share) AS share FROM walk w JOIN ent r ON r.canonical_id = w.root_id AND r.{FLAGGED} WHERE hops <= 3 GROUP BY ALL)
           SELECT asset_id AS company_id, t.name AS company_name, min(hops) AS shortest_hops, round(max(share) * 100, 2) AS max_percent, count(*) AS n_owners, array_to_string(list(risk_name ORDER BY hops, root_id)[1:5], '|') AS owners
           FROM x JOIN ent t ON t.canonical_id = asset_id AND t.entity_type <> 'Person' GROUP BY 1, 2 ORDER BY shortest_hops, n_owners DESC, company_id LIMIT 50""")
def nearest_flagged_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-04: of each exposed company the five nearest flagged owners within three hops."""
    active = graph.edges(bridge.relationships(spark, sf_dir))
    return analyses.nearest_flagged(active, bridge.entities(spark, sf_dir), 3, limit=50).withColumn("owners", F.array_join("owners", "|"))


@query(f"""{GRAPH} SELECT root_id, hops, array_to_string(path, '>') AS path, round(max_share, 9) AS max_share FROM walk w JOIN ent r ON r.canonical_id = w.root_id AND r.{FLAGGED} WHERE asset_id = 'ent:sup:7' ORDER BY hops, array_to_string(path, '|') LIMIT 10""")
def flagged_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-05: the ten shortest paths from flagged entities to a company."""
    found = analyses.flagged_paths(_closure(spark, sf_dir), bridge.entities(spark, sf_dir), "ent:sup:7")
    return found.select("root_id", "hops", F.array_join("path", ">").alias("path"), F.round("max_share", 9).alias("max_share"))


@query(f"""{GRAPH} SELECT t.root_id AS owner_id, e.name AS owner_name, e.nationality, count(DISTINCT asset_id) AS companies_controlled, max(hops) AS deepest_chain, round(max(max_share) * 100, 2) AS max_indirect_percent, bool_or(via_fiduciary) AS any_fiduciary_layer
           FROM tops t JOIN ent e ON e.canonical_id = t.root_id WHERE e.entity_type = 'Person' GROUP BY 1, 2, 3 ORDER BY companies_controlled DESC, deepest_chain DESC, owner_id LIMIT 200""")
def beneficial_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-03, JOIN-05."""
    return analyses.beneficial_owners(_closure(spark, sf_dir), bridge.entities(spark, sf_dir), 200)


@query(f"""{GRAPH} SELECT t.canonical_id AS company_id, t.name AS company_name, t.reg_number AS company_number, t.jurisdiction, min(hops) AS shortest_hops, count(DISTINCT r.canonical_id) AS n_sanctioned_owners,
           array_to_string(list_sort(list(DISTINCT r.name))[1:3], '|') AS sanctioned_owners, round(max(max_share) * 100, 2) AS max_indirect_percent, bool_or(control_only) AS control_without_equity, bool_or(via_fiduciary) AS via_fiduciary
           FROM walk w JOIN ent r ON r.canonical_id = w.root_id AND r.{FLAGGED} JOIN ent t ON t.canonical_id = w.asset_id AND t.entity_type <> 'Person' GROUP BY 1, 2, 3, 4 ORDER BY shortest_hops, n_sanctioned_owners DESC, company_id LIMIT 200""")
def flagged_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-04, FLT-03, SRT-05."""
    return analyses.sanctions_exposure(_closure(spark, sf_dir), bridge.entities(spark, sf_dir), 200).withColumn("sanctioned_owners", F.array_join("sanctioned_owners", "|"))


@query(f"""{GRAPH}, r AS (SELECT DISTINCT root_id, asset_id, via_fiduciary FROM tops) SELECT (SELECT count(*) FROM ent WHERE entity_type <> 'Person') AS total_companies, (SELECT count(*) FROM ent WHERE entity_type = 'Person') AS total_people,
           (SELECT count(*) FROM ent e WHERE entity_type <> 'Person' AND NOT EXISTS (SELECT 1 FROM walk w WHERE w.asset_id = e.canonical_id)) AS companies_without_any_control_edge,
           count(DISTINCT asset_id) FILTER (WHERE entity_type = 'Person') AS resolves_to_natural_person, count(DISTINCT asset_id) FILTER (WHERE entity_type <> 'Person' AND jurisdiction IN {SECRET}) AS terminates_in_secrecy_jurisdiction,
           count(DISTINCT asset_id) FILTER (WHERE entity_type <> 'Person' AND jurisdiction NOT IN {SECRET}) AS terminates_in_company, count(DISTINCT asset_id) FILTER (WHERE via_fiduciary) AS chain_via_fiduciary
           FROM r JOIN ent e ON e.canonical_id = r.root_id""")
def opacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-05, AGG-09, FLT-04."""
    return analyses.opacity(_closure(spark, sf_dir), bridge.entities(spark, sf_dir))


@query(f"""{GRAPH}, r AS (SELECT DISTINCT root_id, asset_id, hops FROM tops) SELECT jurisdiction AS terminal_jurisdiction, jurisdiction IN {SECRET} AS is_secrecy_jurisdiction, count(DISTINCT asset_id) AS companies_controlled, count(DISTINCT root_id) AS controlling_entities, round(avg(hops), 2) AS mean_hops
           FROM r JOIN ent e ON e.canonical_id = r.root_id WHERE entity_type <> 'Person' AND jurisdiction <> '' GROUP BY 1, 2 ORDER BY companies_controlled DESC, terminal_jurisdiction LIMIT 40""")
def opacity_by_jurisdiction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-05's list."""
    return analyses.opacity_by_jurisdiction(_closure(spark, sf_dir), bridge.entities(spark, sf_dir))


@query(f"""{GRAPH} SELECT root_id AS entity_id, name AS entity_name, entity_type, n_records AS source_records, count(DISTINCT asset_id) AS companies_controlled, max(hops) AS deepest_chain FROM walk w JOIN ent e ON e.canonical_id = w.root_id
           GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT asset_id) >= 5 ORDER BY companies_controlled DESC, entity_id LIMIT 200""")
def hubs_transitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-06, AGG-10."""
    return analyses.hubs(_closure(spark, sf_dir), bridge.entities(spark, sf_dir))


@query(f"WITH {REL}, {EDGES} SELECT owner_id AS entity_id, count(DISTINCT asset_id) AS companies_controlled FROM edges GROUP BY 1 HAVING count(DISTINCT asset_id) >= 2 ORDER BY 2 DESC, 1 LIMIT 200")
def hubs_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-07."""
    return analyses.direct_hubs(graph.edges(bridge.relationships(spark, sf_dir)), 2)


@query(f"{GRAPH} SELECT jurisdiction, count(DISTINCT asset_id) AS companies, count(*) AS chains, round(avg(hops), 2) AS mean_hops FROM tops t JOIN ent e ON e.canonical_id = t.root_id WHERE jurisdiction NOT IN ('', 'GB') GROUP BY 1")
def cross_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-08."""
    return analyses.cross_border(_closure(spark, sf_dir), bridge.entities(spark, sf_dir))


@query(f"{GRAPH} SELECT root_id, name, hops, CASE WHEN NOT control_only THEN round(max_share * 100, 4) END AS max_percent, array_to_string(path, '>') AS path FROM walk w JOIN ent e ON e.canonical_id = w.root_id AND e.entity_type = 'Person' WHERE asset_id = 'ent:sup:7'")
def owners_of_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-01."""
    return analyses.owners_of(_closure(spark, sf_dir), bridge.entities(spark, sf_dir), "7").select("root_id", "name", "hops", "max_percent", F.array_join("path", ">").alias("path"))


@query(f"""{GRAPH} SELECT root_id, name, jurisdiction, asset_id, hops, via_fiduciary, array_to_string(path, '>') AS path FROM tops t JOIN ent e ON e.canonical_id = t.root_id WHERE entity_type <> 'Person' AND (jurisdiction IN {SECRET} OR via_fiduciary)
           ORDER BY hops DESC, root_id, array_to_string(path, '|') LIMIT 1000""")
def opaque_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYP-06."""
    return analyses.opaque_structures(_closure(spark, sf_dir), bridge.entities(spark, sf_dir)).withColumn("path", F.array_join("path", ">"))


# Serving


def _index(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return serving.build(bridge.entities(spark, sf_dir), bridge.relationships(spark, sf_dir), None)


_ALL_EDGES = """all_edges AS (SELECT 'ent:' || source_record_id AS owner_id, 'ent:' || target_record_id AS asset_id, min(min_percent)::DOUBLE AS min_percent, max(max_percent)::DOUBLE AS max_percent, bool_or(via_fiduciary) AS via_fiduciary, bool_or(ceased_on IS NULL) AS is_active FROM rel GROUP BY 1, 2),
    edges AS (SELECT * FROM all_edges WHERE is_active)"""
_EXPOSURE = f"""WITH RECURSIVE {REL}, {ENT}, {_ALL_EDGES}, {WALK}, exposure AS (SELECT asset_id, root_id AS risk_id, hops, CASE WHEN NOT control_only THEN round(min_share * 100, 4) END AS min_percent, CASE WHEN NOT control_only THEN round(max_share * 100, 4) END AS max_percent, control_only, via_fiduciary, path
    FROM (SELECT w.*, row_number() OVER (PARTITION BY asset_id, root_id ORDER BY hops, path) AS i FROM walk w JOIN ent e ON e.canonical_id = w.root_id AND e.{FLAGGED}) WHERE i = 1)"""


@query(f"{_EXPOSURE} SELECT asset_id, risk_id, hops, min_percent, max_percent, control_only, via_fiduciary, array_to_string(path, '>') AS path FROM exposure")
def exposure_shortest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-09, WIN-01."""
    return _index(spark, sf_dir)["sanctions_exposure"].withColumn("path", F.array_join("path_ids", ">")).drop("path_ids")


@query(f"{_EXPOSURE} SELECT e.canonical_id, e.name, min(hops) AS shortest, count(*) AS n_owners FROM exposure x JOIN ent e ON e.canonical_id = x.asset_id WHERE hops >= 2 GROUP BY 1, 2 ORDER BY shortest DESC, n_owners DESC, name, canonical_id LIMIT 50")
def exposed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRV-05."""
    return serving.exposed(_index(spark, sf_dir), 2).select("canonical_id", "name", "shortest", "n_owners")


@query(f"""{_EXPOSURE}, a AS (SELECT asset_id, min(hops) AS h, count(DISTINCT hops) AS levels FROM exposure GROUP BY 1)
    SELECT (SELECT count(*) FROM ent) AS entities, (SELECT count(*) FROM ent WHERE entity_type = 'Company') AS companies, (SELECT count(*) FROM ent WHERE entity_type = 'Person') AS people, (SELECT sum(n_records)::BIGINT FROM ent) AS source_records,
    (SELECT count(*) FROM ent WHERE n_records > 1) AS merged, (SELECT count(*) FROM ent WHERE {FLAGGED}) AS sanctioned, (SELECT count(*) FROM ent WHERE topic = 'role.pep') AS peps, (SELECT count(*) FROM all_edges) AS edges, (SELECT count(*) FROM edges) AS active_edges,
    (SELECT count(*) FROM a) AS companies_exposed, (SELECT count(*) FROM a WHERE h >= 2) AS indirect_only, (SELECT coalesce(sum(levels), 0)::BIGINT FROM a) AS exposed_by_level""")
def overview_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRV-06."""
    return serving.overview(_index(spark, sf_dir)).drop("cross_source")


@query(f"""WITH {ENT}, i AS (SELECT canonical_id, name, unnest([name, upper(name)]) AS variant FROM ent), n AS (SELECT *, trim(regexp_replace(lower(variant), '[^a-z0-9]+', ' ', 'g')) AS v FROM i),
    h AS (SELECT canonical_id, max(CASE WHEN v = 'supplier 00000001' THEN 3 WHEN starts_with(v, 'supplier 00000001') THEN 2 ELSE 1 END) AS tier FROM n WHERE contains(v, 'supplier 00000001') GROUP BY 1)
    SELECT canonical_id, e.name, tier FROM h JOIN ent e USING (canonical_id) ORDER BY tier DESC, {FLAGGED} DESC, n_records DESC, e.name, canonical_id LIMIT 20""")
def name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRV-01, SRT-02, TXT-10, FLT-05."""
    return serving.search(_index(spark, sf_dir), "Supplier#00000001").select("canonical_id", "name", "tier")


@query(f"""{_EXPOSURE} SELECT e.canonical_id, e.name, e.entity_type, e.jurisdiction, e.n_records, (SELECT count(*) FROM edges WHERE asset_id = 'ent:sup:7') AS n_owners, (SELECT count(*) FROM edges WHERE owner_id = 'ent:sup:7') AS n_assets,
           (SELECT count(*) FROM exposure WHERE asset_id = 'ent:sup:7') AS exposure_links FROM ent e WHERE canonical_id = 'ent:sup:7'""")
def entity_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRV-02, JOIN-10: an entity with counts of what is linked to it."""
    return serving.entity(_index(spark, sf_dir), "ent:sup:7").select("canonical_id", "name", "entity_type", "jurisdiction", "n_records", "n_owners", "n_assets", "exposure_links")


@query(f"WITH RECURSIVE {REL}, {_ALL_EDGES}, {WALK} {_NEAR.format(other='root_id', one='asset_id', id='ent:sup:7', path='list_reverse(path)')}")
def owners_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRV-03: who controls an entity, over the served edges."""
    return _named(serving.ownership(_index(spark, sf_dir), "ent:sup:7", "up"))


@query(f"""{_EXPOSURE}, steps AS (SELECT risk_id, unnest(path) AS canonical_id, unnest(range(len(path))) AS pos FROM exposure WHERE asset_id = 'ent:sup:7'),
    names AS (SELECT risk_id, string_agg(coalesce(name, canonical_id), '>' ORDER BY pos) AS path_names FROM steps LEFT JOIN ent USING (canonical_id) GROUP BY 1)
    SELECT risk_id, hops, min_percent, max_percent, control_only, via_fiduciary, path_names, row_number() OVER (ORDER BY hops, max_percent DESC NULLS LAST, risk_id) AS place FROM exposure JOIN names USING (risk_id) WHERE asset_id = 'ent:sup:7'""")
def exposure_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRV-04, SRT-03: the exposure paths of an entity, those without percentages last."""
    rows = serving.exposure_of(_index(spark, sf_dir), "ent:sup:7").select("risk_id", "hops", "min_percent", "max_percent", "control_only", "via_fiduciary", F.array_join("path_names", ">").alias("path_names"))
    # The place of each row in what is served: one entity's rows, in their order.
    return rows.withColumn("place", F.row_number().over(Window.orderBy("hops", F.desc_nulls_last("max_percent"), "risk_id")).cast("long"))


@query(f"{_EXPOSURE} SELECT 'exposure' AS list, hops::VARCHAR AS entry, count(DISTINCT asset_id) AS n FROM exposure GROUP BY 2 UNION ALL SELECT 'merged', n_records::VARCHAR, count(*) FROM ent GROUP BY 2 "
       "UNION ALL (SELECT 'controllers', canonical_id, count(DISTINCT asset_id) FROM edges JOIN ent ON canonical_id = owner_id GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 8)")
def overview_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRV-06: exposed companies by path length, entities by records, and the eight largest controllers."""
    index = _index(spark, sf_dir)
    lists = [("exposure", serving.exposure_histogram(index).select(F.col("hops").cast("string").alias("entry"), F.col("companies").alias("n"))), ("merged", serving.merge_histogram(index).select(F.col("n_records").cast("string").alias("entry"), F.col("entities").alias("n"))), ("controllers", serving.top_controllers(index).select(F.col("canonical_id").alias("entry"), F.col("controls").alias("n")))]
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("list"), "entry", "n") for name, rows in lists])


# Measures


@with_phonetic()
@query(f"""WITH {COMPANIES}, {COMPANY_KEYS}, {COMPANY_SCORES}, {_TRUTH}, x AS (SELECT count(*) AS accepted, count(t.left_id) AS true_positives FROM dec d LEFT JOIN truth t USING (left_id, right_id) WHERE decision = 'accept'),
    y AS (SELECT (SELECT count(*) FROM truth) AS true_pairs, (SELECT count(*) FROM (SELECT DISTINCT left_id, right_id FROM cand) JOIN truth USING (left_id, right_id)) AS true_candidates)
    SELECT accepted, true_positives, true_pairs, true_candidates, round(true_positives / accepted, 6) AS precision, round(true_positives / true_pairs, 6) AS recall, round(true_candidates / true_pairs, 6) AS blocking_recall, round(true_positives / true_candidates, 6) AS recall_within_candidates, round(2 * true_positives / (accepted + true_pairs), 6) AS f1 FROM x, y""")
def pairwise_metrics(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """AGG-14, JOIN-04."""
    records, pairs, s = _company_scores(spark, sf_dir, phonetic)
    m = evaluate.pairwise(s, _truth(records), pairs)
    return m.select("accepted", "true_positives", "true_pairs", "true_candidates", *(F.round(k, 6).alias(k) for k in ("precision", "recall", "blocking_recall", "recall_within_candidates", "f1")))


@with_phonetic()
@query(f"""{_CC}, m AS (SELECT truth_name || '|' || truth_brand AS t, coalesce(p.component, c.record_id) AS p FROM co c LEFT JOIN comp p USING (record_id)), k AS (SELECT p, t, count(*) AS n FROM m GROUP BY ALL),
    s AS (SELECT *, sum(n) OVER (PARTITION BY p) AS np, sum(n) OVER (PARTITION BY t) AS nt, count(*) OVER (PARTITION BY p) AS kp, count(*) OVER (PARTITION BY t) AS kt FROM k),
    r AS (SELECT sum(n)::BIGINT AS records, sum(n * n / np) / sum(n) AS pr, sum(n * n / nt) / sum(n) AS re, count(DISTINCT p) AS predicted_clusters, count(DISTINCT t) AS true_clusters, coalesce(sum(n) FILTER (WHERE kp > 1), 0)::BIGINT AS over_merged, coalesce(sum(n) FILTER (WHERE kt > 1), 0)::BIGINT AS under_merged, max(np)::BIGINT AS largest_predicted, max(nt)::BIGINT AS largest_true FROM s)
    SELECT * EXCLUDE (pr, re), round(pr, 6) AS precision, round(re, 6) AS recall, round(2 * pr * re / (pr + re), 6) AS f1 FROM r""")
def bcubed(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """AGG-13."""
    records, _, s = _company_scores(spark, sf_dir, phonetic)
    found = clusters.build_clusters(records, checkpointed(s), split_conflicts=False)
    out = evaluate.bcubed(found, records.select("record_id", F.concat_ws("|", "truth_name", "truth_brand").alias("truth_id")))
    return out.withColumns({k: F.round(k, 6) for k in ("precision", "recall", "f1")})


@with_phonetic()
@query(f"""WITH {COMPANIES}, {COMPANY_KEYS}, {COMPANY_SCORES}, {_TRUTH} SELECT i / 40 AS threshold, count(*) FILTER (WHERE round(score, 9) >= i / 40) AS accepted, round(count(t.left_id) FILTER (WHERE round(score, 9) >= i / 40) / (SELECT count(*) FROM truth), 6) AS recall,
    CASE WHEN count(*) FILTER (WHERE round(score, 9) >= i / 40) = 0 THEN 0.0 ELSE round(count(t.left_id) FILTER (WHERE round(score, 9) >= i / 40) / count(*) FILTER (WHERE round(score, 9) >= i / 40), 6) END AS precision,
    round(2 * count(t.left_id) FILTER (WHERE round(score, 9) >= i / 40) / (count(*) FILTER (WHERE round(score, 9) >= i / 40) + (SELECT count(*) FROM truth)), 6) AS f1
    FROM (SELECT unnest(range(41)) AS i) CROSS JOIN dec LEFT JOIN truth t USING (left_id, right_id) GROUP BY i""")
def threshold_sweep(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """AGG-15."""
    records, _, s = _company_scores(spark, sf_dir, phonetic)
    return evaluate.sweep(s.withColumn("score", F.round("score", 9)), _truth(records)).select("threshold", "accepted", *(F.round(k, 6).alias(k) for k in ("precision", "recall", "f1")))


@with_phonetic()
@query(f"""WITH {COMPANIES}, {COMPANY_KEYS}, {COMPANY_SCORES}, {_TRUTH} SELECT CASE WHEN d.left_id IS NULL THEN 'blocking' ELSE 'matching' END AS stage, count(*) AS missed FROM truth t LEFT JOIN dec d USING (left_id, right_id) WHERE decision IS DISTINCT FROM 'accept' GROUP BY 1""")
def error_taxonomy(spark: SparkSession, sf_dir: str, phonetic: bool = False) -> DataFrame:
    """AGG-16, FLT-02."""
    records, pairs, s = _company_scores(spark, sf_dir, phonetic)
    return evaluate.errors(s, _truth(records), pairs)


_UNNUMBERED = _CC.replace("{'n': 'c_reg', 'v': reg_number}, ", "").replace("coalesce(reg * 5.0 + (1 - reg) * -2.5, 0) + ", "")


@query(f"""{_UNNUMBERED}, l AS (SELECT b.record_id AS a, a.record_id AS b FROM co a JOIN co b ON a.reg_number = b.reg_number AND a.reg_number <> '' AND a.record_id < b.record_id), k AS (SELECT DISTINCT left_id, right_id FROM cand),
    n AS (SELECT count(*) AS links, count(k.left_id) AS blocked, count(*) FILTER (WHERE x.component = y.component) AS resolved FROM l LEFT JOIN k ON k.left_id = least(l.a, l.b) AND k.right_id = greatest(l.a, l.b) LEFT JOIN comp x ON x.record_id = l.a LEFT JOIN comp y ON y.record_id = l.b)
    SELECT *, CASE WHEN links > 0 THEN round(blocked / links, 6) ELSE 0.0 END AS blocking_recall, CASE WHEN links > 0 THEN round(resolved / links, 6) ELSE 0.0 END AS recall FROM n""")
def heldout_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-17, JOIN-07, D3: registration numbers as truth, with their key and feature left out."""
    records = _companies(spark, sf_dir, phonetic=False)
    numbered = records.filter("reg_number <> ''").select("reg_number", "record_id")
    links = numbered.withColumnRenamed("record_id", "b").join(numbered.withColumnRenamed("record_id", "a"), "reg_number").filter("b < a").select("a", "b")
    keys = [k for k in blocking.KEYS if k.name != "c_reg"]
    pairs = blocking.candidate_pairs(blocking.blocking_keys(records, keys), keys)
    s = matching.score(matching.features(pairs, records, "Company"), [w for w in matching.COMPANY_WEIGHTS if w.feature != "reg_number_match"])
    found = clusters.build_clusters(records, checkpointed(s), split_conflicts=False)
    return evaluate.held_out(links, found, pairs).select("links", "blocked", "resolved", F.round("blocking_recall", 6).alias("blocking_recall"), F.round("recall", 6).alias("recall"))


@query(f"""WITH RECURSIVE {PEOPLE}, {REL}, {ENT}, {EDGES}, {WALK}, c AS (SELECT first_name || last_name || birth_year AS c, count(*) AS n, count(DISTINCT source) AS s FROM pe GROUP BY 1)
    SELECT (SELECT sum(n)::BIGINT FROM c) AS source_records, (SELECT count(*) FROM c) AS canonical_entities, (SELECT sum(n - 1)::BIGINT FROM c) AS records_absorbed_by_merging, (SELECT coalesce(sum(n), 0)::BIGINT FROM c WHERE n > 1) AS records_in_merged_clusters,
    (SELECT max(n) FROM c) AS largest_cluster, (SELECT count(*) FROM c WHERE s > 1) AS cross_source_entities,
    (SELECT count(*) FROM walk WHERE hops = 1) AS one_hop_control_paths, (SELECT count(*) FROM walk WHERE hops > 1) AS multi_hop_control_paths, (SELECT count(DISTINCT asset_id) FROM walk WHERE hops > 1) AS companies_with_indirect_owner,
    (SELECT count(DISTINCT asset_id) FROM walk w JOIN ent e ON e.canonical_id = w.root_id AND e.{FLAGGED} WHERE hops = 1) AS sanctions_direct_exposure, (SELECT count(DISTINCT asset_id) FROM walk w JOIN ent e ON e.canonical_id = w.root_id AND e.{FLAGGED} WHERE hops > 1) AS sanctions_indirect_exposure""")
def resolution_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-07, AGG-11: what it changes that persons of one name and birth year are one entity."""
    records = bridge.people(spark, sf_dir)
    named = records.select("record_id", F.concat("first_name", "last_name", F.col("birth_year").cast("string")).alias("canonical_id"))
    found = named.join(named.groupBy("canonical_id").agg(F.count("*").alias("cluster_size")), "canonical_id")
    return analyses.resolution_impact(records, found, _closure(spark, sf_dir), bridge.entities(spark, sf_dir))
