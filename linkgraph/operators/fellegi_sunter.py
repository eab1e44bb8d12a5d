"""Probabilistic matching (Fellegi and Sunter 1969) with parameters by EM (Dempster et al. 1977).

Each comparison has levels, from equal down to else; a null level says nothing. u, the chance of a
level among pairs that don't match, comes from random pairs; m, among pairs that do, from EM over the
patterns of blocked pairs. Only patterns and their counts reach the driver: there are at most as many
as combinations of levels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.functions.similarity import observed, token_jaccard, with_jaro_winkler
from linkgraph.operators import blocking
from linkgraph.operators.matching import ACCEPT, REJECT, decision, paired

#: Pairs that u is estimated from, about.
RANDOM_PAIRS = 1_000_000


@dataclass(frozen=True)
class Comparison:
    """levels: conditions tried in their order, the first that holds counts; the last level is 'else'. frequency: weigh agreement by how rare the value is."""

    name: str
    column: str
    kind: str = "exact"
    frequency: bool = False

    @property
    def n_levels(self) -> int:
        return {"exact": 2, "jaro_winkler": 5, "edits": 4, "words": 4}[self.kind]

    def level(self) -> Column:
        """0 for equal, up to n_levels - 1 for else, null where a value isn't observed."""
        a, b = F.col(f"a_{self.column}").cast("string"), F.col(f"b_{self.column}").cast("string")
        steps = {
            "exact": [a == b],
            "jaro_winkler": [a == b, *(F.col(f"_jw_{self.column}") >= t for t in (0.95, 0.88, 0.80))],
            "edits": [a == b, F.levenshtein(a, b) <= 1, F.levenshtein(a, b) <= 2],
            "words": [a == b, *(token_jaccard(a, b) >= t for t in (0.8, 0.5))],
        }[self.kind]
        out = F.when(observed(a).isNull() | observed(b).isNull(), F.lit(None).cast("int"))
        for k, s in enumerate(steps):
            out = out.when(s, k)
        return out.otherwise(len(steps))


PERSON = (
    Comparison("last", "last_name", "jaro_winkler", True), Comparison("first", "first_name", "jaro_winkler", True), Comparison("year", "birth_year", "edits", True), Comparison("month", "birth_month"), Comparison("nationality", "nationality", "exact", True),
    Comparison("postcode", "postcode"), Comparison("address", "address_norm", "words"),
)
COMPANY = (Comparison("name", "name_fp", "jaro_winkler", True), Comparison("number", "reg_number", "exact", True), Comparison("jurisdiction", "jurisdiction"), Comparison("postcode", "postcode"), Comparison("form", "legal_form"), Comparison("address", "address_norm", "words"))
COMPARISONS = {"Person": PERSON, "Company": COMPANY}
#: Columns that are equal in pairs to score; a pair needs one rule, and no block is too large.
RULES = {
    "Person": (("name_fp", "birth_year"), ("last_name", "birth_year"), ("first_name", "birth_year"), ("name_phonetic", "birth_year"), ("name_fp",), ("last_name", "postcode")),
    "Company": (("reg_number",), ("name_fp",), ("name_phonetic",), ("postcode",)),
}
#: EM runs once for each, over the rule's pairs, with what the rule compares held out.
TRAINING = {"Person": (("last_name", "birth_year"), ("name_fp",)), "Company": (("name_fp",), ("postcode",))}
#: Pairs that this rule finds are RECALL of all that match: the prior of two random records.
DETERMINISTIC, RECALL = {"Person": ("name_fp", "birth_year"), "Company": ("reg_number",)}, 0.8
#: Rows of a tile; larger blocks are paired tile by tile.
TILE = 1000


@dataclass
class Parameters:
    """prior: chance that a pair matches; m and u by comparison and level; likelihood: log likelihood after each round, of the last training rule."""

    prior: float
    m: list[np.ndarray]
    u: list[np.ndarray]
    likelihood: list[float] = field(default_factory=list)


def compared(pairs: DataFrame, records: DataFrame, entity_type: str, comparisons: Sequence[Comparison]) -> DataFrame:
    """left_id, right_id, a level column g_* for each comparison, and the left value of those weighed by frequency."""
    both = paired(pairs, records, entity_type)
    both = with_jaro_winkler(both, {f"_jw_{c.column}": (f"a_{c.column}", f"b_{c.column}") for c in comparisons if c.kind == "jaro_winkler"})
    return both.select("left_id", "right_id", *(c.level().alias(f"g_{c.name}") for c in comparisons), *(F.col(f"a_{c.column}").cast("string").alias(f"v_{c.name}") for c in comparisons if c.frequency))


def blocked_pairs(records: DataFrame, entity_type: str, rules: Sequence[Sequence[str]] | None = None, tile: int = TILE) -> DataFrame:
    """left_id < right_id of all pairs that a rule finds, each once.

    A block's rows fall into tiles by hash; two rows meet in the one cell of their tiles, so that no task pairs more than two tiles at a time.
    """
    rules = rules or RULES[entity_type]
    keys = [blocking.BlockingKey("_".join(r), entity_type, blocking.both(*r)) for r in rules]
    made = blocking.blocking_keys(records, keys).select("record_id", "key_name", "key_value")
    sizes = made.groupBy("key_name", "key_value").agg(F.count("*").alias("n")).filter("n > 1").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    rows = made.join(sizes, ["key_name", "key_value"]).withColumn("t", F.pmod(F.xxhash64("record_id"), F.col("tiles")).cast("int"))
    cells = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("key_name", "key_value", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "t", "record_id")
    a, b = (cells.withColumnRenamed("record_id", f"{x}_id").withColumnRenamed("t", f"{x}_t") for x in ("left", "right"))
    both = a.join(b, ["key_name", "key_value", "i", "j"]).filter("left_id < right_id and (i = j or left_t <> right_t)")
    return both.select("left_id", "right_id").distinct()


def random_pairs(records: DataFrame, entity_type: str, n: int = RANDOM_PAIRS) -> DataFrame:
    """About n pairs of records that a hash puts in one bucket; they are as good as random."""
    ids = records.filter(F.col("entity_type") == entity_type).select("record_id")
    total = ids.count()
    buckets = max(1, (total * total) // (2 * n))
    rows = ids.withColumn("bucket", F.pmod(F.xxhash64(F.lit("u"), "record_id"), F.lit(buckets)))
    a, b = rows.withColumnRenamed("record_id", "left_id"), rows.withColumnRenamed("record_id", "right_id")
    return a.join(b, "bucket").filter("left_id < right_id").select("left_id", "right_id")


def level_shares(levels: DataFrame, comparisons: Sequence[Comparison]) -> list[np.ndarray]:
    """The parts of the levels of each comparison, with a little added to each."""
    row = levels.agg(*(F.count_if(F.col(f"g_{c.name}") == k).alias(f"{c.name}_{k}") for c in comparisons for k in range(c.n_levels))).first()
    out = []
    for c in comparisons:
        n = np.array([row[f"{c.name}_{k}"] for k in range(c.n_levels)], float) + 0.5
        out.append(n / n.sum())
    return out


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, u: list[np.ndarray], prior: float, rounds: int = 50, tolerance: float = 1e-6) -> Parameters:
    """m and the prior from patterns (a column for each comparison, -1 for null) and their counts; u stays."""
    m = [np.linspace(0.9, 0.02, len(x)) / np.linspace(0.9, 0.02, len(x)).sum() for x in u]
    p = Parameters(prior, m, u)
    for _ in range(rounds):
        yes, no = np.full(len(counts), p.prior), np.full(len(counts), 1 - p.prior)
        for k, (mk, uk) in enumerate(zip(p.m, p.u, strict=True)):
            seen = patterns[:, k] >= 0
            yes[seen] *= mk[patterns[seen, k]]
            no[seen] *= uk[patterns[seen, k]]
        w = yes / (yes + no)
        p.likelihood.append(float((counts * np.log(yes + no)).sum()))
        new = []
        for k, mk in enumerate(p.m):
            seen = patterns[:, k] >= 0
            n = np.bincount(patterns[seen, k], (w * counts)[seen], len(mk)) + 1e-4
            new.append(n / n.sum())
        change = max(np.abs(a - b).max() for a, b in zip(new, p.m, strict=True))
        p.m, p.prior = new, float(np.clip((w * counts).sum() / counts.sum(), 1e-6, 1 - 1e-6))
        if change < tolerance:
            break
    return p


def deterministic_prior(records: DataFrame, entity_type: str) -> float:
    """Pairs that agree on the deterministic rule, by its recall, of all pairs of the type."""
    n = records.filter(F.col("entity_type") == entity_type).count()
    key = blocking.BlockingKey("sure", entity_type, blocking.both(*DETERMINISTIC[entity_type]))
    sizes = blocking.blocking_keys(records, [key]).groupBy("key_value").agg(F.count("*").alias("n"))
    found = sizes.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0))).first()[0]
    return float(np.clip(found / RECALL / max(1, n * (n - 1) / 2), 1e-9, 1 - 1e-6))


def train(records: DataFrame, entity_type: str, comparisons: Sequence[Comparison] | None = None, rules: Sequence[Sequence[str]] | None = None) -> Parameters:
    """u from random pairs, the prior from the deterministic rule, m from one run of EM for each training rule.

    A run leaves out comparisons of columns that its rule has, as all its pairs agree there. Of comparisons that more than one
    run estimates, the mean counts; what none does keeps the values that EM begins with.
    """
    comparisons, rules = comparisons or COMPARISONS[entity_type], rules or TRAINING[entity_type]
    u = level_shares(compared(random_pairs(records, entity_type), records, entity_type, comparisons), comparisons)
    prior = deterministic_prior(records, entity_type)
    first = [np.linspace(0.9, 0.02, len(x)) / np.linspace(0.9, 0.02, len(x)).sum() for x in u]
    runs: list[list[np.ndarray]] = [[] for _ in u]
    likelihood: list[float] = []
    for rule in rules:
        free = [k for k, c in enumerate(comparisons) if c.column not in rule]
        names = [comparisons[k].name for k in free]
        levels = compared(blocked_pairs(records, entity_type, [rule]), records, entity_type, comparisons)
        rows = levels.groupBy(*(F.coalesce(f"g_{n}", F.lit(-1)).alias(n) for n in names)).agg(F.count("*").alias("n_pairs")).toPandas()
        if not len(rows):
            continue
        odds = prior / (1 - prior) * float(np.prod([first[k][0] / u[k][0] for k in range(len(u)) if k not in free]))
        p = expectation_maximisation(rows[names].to_numpy(int), rows["n_pairs"].to_numpy(float), [u[k] for k in free], float(np.clip(odds / (1 + odds), 1e-6, 1 - 1e-6)))
        for k, m in zip(free, p.m, strict=True):
            runs[k].append(m)
        likelihood = p.likelihood
    return Parameters(prior, [np.mean(r, axis=0) if r else f for r, f in zip(runs, first, strict=True)], u, likelihood)


def score(pairs: DataFrame, records: DataFrame, entity_type: str, p: Parameters, comparisons: Sequence[Comparison] | None = None, matcher: str = "fellegi_sunter", accept: float = ACCEPT, reject: float = REJECT) -> DataFrame:
    """left_id, right_id, matcher, score, decision of pairs; pairs whose score is far below reject stay out.

    Where a comparison is weighed by frequency and its values are equal, the value's own frequency among
    the records of the type takes the place of the level's u.
    """
    comparisons = comparisons or COMPARISONS[entity_type]
    levels = compared(pairs, records, entity_type, comparisons)
    odds = F.lit(float(np.log(p.prior / (1 - p.prior))))
    for c, m, u in zip(comparisons, p.m, p.u, strict=True):
        weights = F.array(*(F.lit(float(np.log(a / b))) for a, b in zip(m, u, strict=True)))
        w = F.get(weights, F.col(f"g_{c.name}"))
        if c.frequency:
            values = records.filter(F.col("entity_type") == entity_type).select(observed(F.col(c.column).cast("string")).alias(f"v_{c.name}")).na.drop()
            shares = values.groupBy(f"v_{c.name}").agg(F.count("*").alias("_k")).crossJoin(values.agg(F.count("*").alias("_all"))).select(f"v_{c.name}", (F.col("_k") / F.col("_all")).alias(f"f_{c.name}"))
            levels = levels.join(shares, f"v_{c.name}", "left")
            w = F.when((F.col(f"g_{c.name}") == 0) & F.col(f"f_{c.name}").isNotNull(), F.lit(float(np.log(m[0]))) - F.log(F.col(f"f_{c.name}"))).otherwise(w)
        odds = odds + F.coalesce(w, F.lit(0.0))
    s = 1 / (1 + F.exp(-odds))
    return levels.select("left_id", "right_id", F.lit(matcher).alias("matcher"), s.alias("score")).filter(F.col("score") >= reject - 0.2).withColumn("decision", decision(F.col("score"), accept, reject))


def weights(p: Parameters, comparisons: Sequence[Comparison]) -> list[tuple[str, int, float]]:
    """log2 of m by u for each comparison and level."""
    return [(c.name, k, float(np.log2(a / b))) for c, m, u in zip(comparisons, p.m, p.u, strict=True) for k, (a, b) in enumerate(zip(m, u, strict=True))]
