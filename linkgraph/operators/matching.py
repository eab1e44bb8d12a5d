"""Features of candidate pairs and the additive scorer: log odds with an explanation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.functions import similarity as sim

ACCEPT, REJECT, PRIOR = 0.92, 0.62, -2.2


@dataclass(frozen=True)
class Weight:
    """A feature and what full agreement and full disagreement add to the log odds."""

    feature: str
    agree: float
    disagree: float


# Default weights.
PERSON_WEIGHTS = (
    Weight("name_fp_jw", 2.6, -3.0), Weight("name_token_jaccard", 1.1, -0.8), Weight("last_jw", 1.4, -1.6), Weight("first_jw", 0.9, -0.9), Weight("cross_name_jw", 1.0, -0.4), Weight("phonetic_exact", 1.2, -0.2), Weight("birth_year_match", 2.2, -4.5),
    Weight("birth_month_match", 0.9, -1.4), Weight("middle_compat", 0.6, -1.0), Weight("nationality_match", 0.8, -1.5), Weight("country_match", 0.5, -0.5), Weight("postcode_level", 1.3, -0.6), Weight("address_jaccard", 0.7, -0.3), Weight("address_blk_match", 0.6, -0.2),
)
COMPANY_WEIGHTS = (
    Weight("name_fp_jw", 2.8, -3.2), Weight("name_token_jaccard", 1.2, -1.0), Weight("phonetic_exact", 0.9, -0.2), Weight("reg_number_match", 5.0, -2.5), Weight("jurisdiction_match", 0.9, -2.0), Weight("country_match", 0.5, -0.8), Weight("postcode_level", 1.1, -0.4),
    Weight("address_jaccard", 0.6, -0.3), Weight("legal_form_match", 0.5, -0.7), Weight("incorporation_match", 1.4, -1.2),
)
WEIGHTS = {"Person": PERSON_WEIGHTS, "Company": COMPANY_WEIGHTS}

_USED = ["name_fp", "name_norm", "name_phonetic", "first_name", "middle_name", "last_name", "birth_year", "birth_month", "nationality", "country", "jurisdiction", "reg_number", "postcode", "address_norm", "address_blk", "legal_form", "incorporation_date"]


def paired(pairs: DataFrame, records: DataFrame, entity_type: str) -> DataFrame:
    """pairs with both records' columns as a_* and b_*, of those with both records of the type."""
    slim = records.filter(F.col("entity_type") == entity_type).select("record_id", *_USED)
    a = slim.select(F.col("record_id").alias("left_id"), *(F.col(c).alias(f"a_{c}") for c in _USED))
    b = slim.select(F.col("record_id").alias("right_id"), *(F.col(c).alias(f"b_{c}") for c in _USED))
    return pairs.select("left_id", "right_id").join(a, "left_id").join(b, "right_id")


def distinct_jaro_winkler(both: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """both with the similarities; each different pair of values is compared once, however many pairs of records have it."""
    out = both
    for new, (a, b) in names.items():
        values = sim.with_jaro_winkler(both.select(F.col(a).alias("_x"), F.col(b).alias("_y")).distinct(), {new: ("_x", "_y")})
        out = out.join(values, F.col(a).eqNullSafe(F.col("_x")) & F.col(b).eqNullSafe(F.col("_y")), "left").drop("_x", "_y")
    return out


def features(pairs: DataFrame, records: DataFrame, entity_type: str) -> DataFrame:
    """left_id, right_id and the type's features, from 0 to 1, null where a value isn't observed."""
    both = paired(pairs, records, entity_type)

    def of(f: Callable[[Column, Column], Column], name: str) -> Column:
        return f(F.col(f"a_{name}"), F.col(f"b_{name}"))

    common = {
        "name_token_jaccard": of(sim.token_jaccard, "name_norm"), "phonetic_exact": of(sim.exact, "name_phonetic"), "country_match": of(sim.exact, "country"), "postcode_level": of(sim.postcode_level, "postcode"), "address_jaccard": of(sim.token_jaccard, "address_norm"),
    }
    if entity_type == "Person":
        both = sim.with_jaro_winkler(both, {"name_fp_jw": ("a_name_fp", "b_name_fp"), "last_jw": ("a_last_name", "b_last_name"), "first_jw": ("a_first_name", "b_first_name"), "_fl": ("a_first_name", "b_last_name"), "_lf": ("a_last_name", "b_first_name")})
        all_four = F.col("first_jw").isNotNull() & F.col("last_jw").isNotNull()
        own = {
            "cross_name_jw": F.when(all_four, F.greatest((F.col("first_jw") + F.col("last_jw")) / 2, (F.col("_fl") + F.col("_lf")) / 2)), "birth_year_match": of(sim.exact_number, "birth_year"), "birth_month_match": of(sim.exact_number, "birth_month"),
            "middle_compat": of(sim.middle_compatible, "middle_name"), "nationality_match": of(sim.exact, "nationality"), "address_blk_match": of(sim.exact, "address_blk"),
        }
    else:
        both = sim.with_jaro_winkler(both, {"name_fp_jw": ("a_name_fp", "b_name_fp")})
        own = {"reg_number_match": of(sim.exact, "reg_number"), "jurisdiction_match": of(sim.exact, "jurisdiction"), "legal_form_match": of(sim.exact, "legal_form"), "incorporation_match": of(sim.exact_number, "incorporation_date")}
    return both.withColumns(common | own).select("left_id", "right_id", *(w.feature for w in WEIGHTS[entity_type]))


def contribution(w: Weight) -> Column:
    v = F.col(w.feature)
    return v * w.agree + (1 - v) * w.disagree


def decision(score: Column, accept: float = ACCEPT, reject: float = REJECT) -> Column:
    return F.when(score >= accept, "accept").when(score < reject, "reject").otherwise("uncertain")


def score(described: DataFrame, weights: Sequence[Weight], matcher: str = "rules", prior: float = PRIOR, accept: float = ACCEPT, reject: float = REJECT, store_features: bool = True) -> DataFrame:
    """left_id, right_id, matcher, score, decision, features (JSON, nulls kept) and rationale of described pairs.

    The score is the logistic function of the prior and the contributions, added in the order of weights.
    """
    z = F.lit(prior)
    for w in weights:
        z = z + F.coalesce(contribution(w), F.lit(0.0))
    s = 1 / (1 + F.exp(-z))
    said = F.array_compact(F.array(*(F.when(F.col(w.feature).isNotNull(), F.format_string(f"{w.feature}=%.2f(%+.2f)", F.col(w.feature), contribution(w))) for w in weights)))
    values = F.to_json(F.struct(*(w.feature for w in weights)), {"ignoreNullFields": "false"}) if store_features else F.lit(None).cast("string")
    return described.select("left_id", "right_id", F.lit(matcher).alias("matcher"), s.alias("score"), decision(s, accept, reject).alias("decision"), values.alias("features"), F.array_join(said, ", ").alias("rationale"))


def explain(described: DataFrame, weights: Sequence[Weight]) -> DataFrame:
    """described with contributions: (feature, value, contribution) by weight of what they add or take."""
    parts = F.array_compact(F.array(*(F.when(F.col(w.feature).isNotNull(), F.struct(F.lit(w.feature).alias("feature"), F.col(w.feature).alias("value"), contribution(w).alias("contribution"))) for w in weights)))
    return described.withColumn("contributions", F.array_sort(parts, lambda x, y: F.when(F.abs(x["contribution"]) > F.abs(y["contribution"]), -1).when(F.abs(x["contribution"]) < F.abs(y["contribution"]), 1).when(x["feature"] < y["feature"], -1).otherwise(1)))


def histogram(scores: DataFrame) -> DataFrame:
    """Pairs by matcher and decision."""
    return scores.groupBy("matcher", "decision").agg(F.count("*").alias("pairs"))


def uncertain_band(scores: DataFrame, limit: int) -> DataFrame:
    """The most likely of the uncertain pairs: by score, then ids."""
    return scores.filter("decision = 'uncertain'").orderBy(F.desc("score"), "left_id", "right_id").limit(limit)


def calibrate(labelled: DataFrame, weights: Sequence[Weight], l2: float = 1.0, iterations: int = 300, rate: float = 0.15, prior: float = PRIOR, label: str = "label") -> tuple[list[Weight], float]:
    """Weights fitted to labelled pairs (features and a 0/1 label) by full-batch gradient descent on log loss.

    Each feature is two inputs, v and 1 - v, both 0 where it is null; the bias isn't penalised. Rows are
    grouped by equal inputs on the executors; each step is a sum over those groups.
    """
    names = [w.feature for w in weights]
    groups = labelled.groupBy(*names, label).agg(F.count("*").alias("_n")).toPandas()
    n, y = groups["_n"].to_numpy(float), groups[label].to_numpy(float)
    v = groups[names].to_numpy(float)
    seen = ~np.isnan(v)
    x = np.concatenate([np.where(seen, v, 0), np.where(seen, 1 - v, 0)], 1)
    w, b, total = np.array([*(k.agree for k in weights), *(k.disagree for k in weights)]), prior, n.sum()
    for _ in range(iterations if total else 0):
        err = (1 / (1 + np.exp(-(x @ w + b))) - y) * n
        w, b = w - rate * ((x.T @ err) + l2 * w) / total, b - rate * err.sum() / total
    k = len(names)
    return [Weight(f, round(float(w[i]), 3), round(float(w[k + i]), 3)) for i, f in enumerate(names)], round(float(b), 3)
