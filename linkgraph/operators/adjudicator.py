"""Adjudication of uncertain pairs by a judge: any callable from a question to an answer in JSON.

Verdicts are cached by a hash of the question; failed calls aren't. Pairs outside the uncertain band keep
their first matcher's score, and so do pairs beyond the budget: nothing is left out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.operators.matching import ACCEPT, REJECT, decision

BUDGET = 5000
CEILING = 0.35
SCORES = {"same": 0.97, "different": 0.05, "unclear": None}
VERDICTS = tuple(SCORES)
_FIELDS = ["name", "birth_year", "birth_month", "nationality", "country", "jurisdiction", "reg_number", "postcode", "legal_form"]
Judge = Callable[[str], str]


def parse_verdict(answer: str | None) -> tuple[str, float, str]:
    """verdict, confidence and reason of an answer: the outermost braces of it, fenced or not; what can't be read is unclear."""
    body = re.sub(r"^```\w*|```$", "", (answer or "").strip(), flags=re.M)
    lo, hi = body.find("{"), body.rfind("}")
    try:
        got = json.loads(body[lo : hi + 1]) if 0 <= lo < hi else {}
        confidence = min(1.0, max(0.0, float(got.get("confidence", 0) or 0)))
    except (ValueError, TypeError, AttributeError):
        return "unclear", 0.0, ""
    verdict = str(got.get("verdict", "")).strip().lower()
    return (verdict if verdict in VERDICTS else "unclear"), confidence, str(got.get("reason", ""))


def question() -> Column:
    """What the judge is asked about a pair with both records' columns a_* and b_*."""
    sides = [F.to_json(F.struct(*(F.col(f"{s}_{f}").cast("string").alias(f) for f in _FIELDS))) for s in "ab"]
    return F.concat(F.lit('Do these two records name the same entity? Answer as JSON: {"verdict": "same|different|unclear", "confidence": 0..1, "reason": "..."}\nA: '), sides[0], F.lit("\nB: "), sides[1])


def ask(asked: DataFrame, judge: Judge, tries: int = 2) -> DataFrame:
    """key, verdict, confidence, reason of asked (key, question); a question whose calls all fail has no row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for key, text in zip(f["key"], f["question"], strict=True):
                for _ in range(tries):
                    try:
                        out.append((key, *parse_verdict(judge(text))))
                        break
                    except Exception:  # noqa: BLE001 - whatever a judge raises, the call failed
                        continue
            yield pd.DataFrame(out, columns=["key", "verdict", "confidence", "reason"]).astype({"confidence": float})

    return asked.mapInPandas(run, "key string, verdict string, confidence double, reason string")


def adjudicate(scores: DataFrame, records: DataFrame, judge: Judge, cache: DataFrame | None = None, budget: int = BUDGET, ceiling: float = CEILING, accept: float = ACCEPT, reject: float = REJECT) -> tuple[DataFrame, DataFrame]:
    """All pairs of scores with matcher 'judge', and the verdicts to cache (key, verdict, confidence, reason), old and new.

    Refuses if the band is more than `ceiling` of all pairs. 'unclear' keeps the score.
    """
    from linkgraph.operators.components import checkpointed

    n, uncertain = scores.agg(F.count("*"), F.count_if(F.col("decision") == "uncertain")).first()
    if n and uncertain / n > ceiling:
        raise ValueError(f"{uncertain} of {n} pairs are uncertain, more than {ceiling:.0%}: mend the matcher first")
    band = scores.filter("decision = 'uncertain'").orderBy(F.desc("score"), "left_id", "right_id").limit(budget).select("left_id", "right_id")
    sides = [records.select(F.col("record_id").alias(i), *(F.col(f).alias(f"{s}_{f}") for f in _FIELDS)) for i, s in (("left_id", "a"), ("right_id", "b"))]
    asked = checkpointed(band.join(sides[0], "left_id").join(sides[1], "right_id").select("left_id", "right_id", question().alias("question")).withColumn("key", F.substring(F.sha2("question", 256), 1, 16)))
    new = asked.select("key", "question").dropDuplicates(["key"])
    if cache is not None:
        new = new.join(cache.select("key"), "key", "left_anti")
    fresh = checkpointed(ask(new, judge))
    known = fresh if cache is None else cache.select(*fresh.columns).dropDuplicates(["key"]).unionByName(fresh)
    table = F.create_map(*[F.lit(x) for v, s in SCORES.items() if s is not None for x in (v, s)])
    judged = asked.join(known, "key").select("left_id", "right_id", F.try_element_at(table, F.col("verdict")).alias("_s"), F.col("reason").alias("_r"))
    out = scores.join(judged, ["left_id", "right_id"], "left")
    new_score = F.coalesce("_s", "score")
    return out.select("left_id", "right_id", F.lit("judge").alias("matcher"), new_score.alias("score"), decision(new_score, accept, reject).alias("decision"), F.coalesce("_r", F.lit("")).alias("rationale")), known


def offline_judge(text: str) -> str:
    """A judge without a model: equal names and no contradicting year or number are the same."""
    a, b = (json.loads(line[3:]) for line in text.split("\n")[1:3])
    clash = any(a.get(k) and b.get(k) and a[k] != b[k] for k in ("birth_year", "reg_number"))
    same = sorted((a.get("name") or "").lower().split()) == sorted((b.get("name") or "").lower().split())
    return json.dumps({"verdict": "different" if clash else "same" if same else "unclear", "confidence": 0.9 if clash or same else 0.3, "reason": "offline"})
