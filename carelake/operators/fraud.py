"""Rule-based claim scoring.

F1 same procedure more than twice in seven days (+3), F2 amount over the limit (+2), F3 submitted within an
hour of a discharge (+2), F4 physician over the daily procedure limit (+2), F5 diagnosis does not fit the
procedure (+3). Claims with a score of five or more are flagged.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.aggregates import trailing_days
from carelake.operators.joins import join_dimension, literal_table, recent_event_flag, reused, settled

SCORES = {"f1": 3, "f2": 2, "f3": 2, "f4": 2, "f5": 3}
FLAG_SCORE = 5
PROCEDURE_REPEATS = 2
AMOUNT_LIMIT = 200000
PHYSICIAN_DAILY_LIMIT = 30
DISCHARGE_SECONDS = 3600

# Diagnosis and procedure codes that do not go together.
INVALID_PAIRS = [("J06.9", "27447"), ("E11.9", "93000")]


def amount_points(amount: Column, limit: float = AMOUNT_LIMIT) -> Column:
    return F.when(amount > limit, SCORES["f2"]).otherwise(0)


def repeated_procedures(claims: DataFrame, repeats: int = PROCEDURE_REPEATS, days: int = 7) -> DataFrame:
    """(patient, procedure, day) with more than `repeats` claims in the trailing `days` days."""
    counts = trailing_days(claims, ["patient_id", "procedure_code"], "claim_date", days, "proc_count_7d")
    return counts.filter(F.col("proc_count_7d") > repeats)


def busy_physicians(claims: DataFrame, limit: int = PHYSICIAN_DAILY_LIMIT) -> DataFrame:
    """(physician, day) with more than `limit` claims."""
    daily = claims.groupBy("physician_id", "claim_date").agg(F.count("claim_id").alias("daily_proc_count"))
    return daily.filter(F.col("daily_proc_count") > limit)


def pair_table(df: DataFrame, pairs: Sequence[tuple]) -> DataFrame:
    """Literal table of mismatching pairs, typed like the claim columns."""
    types = f"diagnosis_code {df.schema['diagnosis_code'].dataType.simpleString()}, " \
            f"procedure_code {df.schema['procedure_code'].dataType.simpleString()}"
    return literal_table(df.sparkSession, list(dict.fromkeys(pairs)), types)


def flag_rules(claims: DataFrame, discharges: DataFrame, amount_limit: float = AMOUNT_LIMIT,
               physician_limit: int = PHYSICIAN_DAILY_LIMIT, pairs: Sequence[tuple] = tuple(INVALID_PAIRS),
               at_least: int | None = None) -> DataFrame:
    """Add 0/1 columns f1..f5 and the score to every claim; with `at_least`, to every claim that reaches this score.

    `discharges` holds (patient_id, discharge_ts). The claims are read three times; `reused` writes those of large tables
    once. F1 and F4 settle the breaching groups first: they are few, and while they stay under the size check the claims
    are not shuffled for them. F5 replicates a pair table written in code. What remains is one shuffle of the claims, for
    F3, which comes last: columns only the other rules need are not moved, nor are claims that would miss `at_least`
    even with F3.
    """
    claims = reused(claims)
    hot_procedures = settled(repeated_procedures(claims).select(
        "patient_id", "procedure_code", "claim_date", F.lit(1).alias("f1")))
    hot_physicians = settled(busy_physicians(claims, physician_limit).select(
        "physician_id", "claim_date", F.lit(1).alias("f4")))
    mismatch = pair_table(claims, pairs).withColumn("f5", F.lit(1))
    scored = join_dimension(claims, hot_procedures, ["patient_id", "procedure_code", "claim_date"])
    scored = join_dimension(scored, hot_physicians, ["physician_id", "claim_date"])
    scored = (
        join_dimension(scored, mismatch, ["diagnosis_code", "procedure_code"])
        .withColumn("f2", (amount_points(F.col("claim_amount"), amount_limit) > 0).cast("int"))
        .fillna(0, subset=["f1", "f2", "f4", "f5"])
    )
    if at_least is not None:
        scored = scored.filter(_points(r for r in SCORES if r != "f3") + SCORES["f3"] >= at_least)
    scored = recent_event_flag(scored, discharges, "patient_id", "submission_ts", "discharge_ts", DISCHARGE_SECONDS, "f3")
    scored = scored.withColumn("fraud_score", _points(SCORES))
    return scored if at_least is None else scored.filter(F.col("fraud_score") >= at_least)


def _points(rules: Iterable[str]) -> Column:
    return sum((F.col(r) * SCORES[r] for r in rules), F.lit(0))


def flags(scored: DataFrame, threshold: int = FLAG_SCORE) -> DataFrame:
    """Flagged claims with the rules that fired."""
    return scored.filter(F.col("fraud_score") >= threshold).select(
        "claim_id", "fraud_score", *[F.col(r).alias(f"rule_{r}_triggered") for r in SCORES],
        F.col("claim_date").alias("flag_date"))


def flags_of_day(claims: DataFrame, discharges: DataFrame, day: str, **limits) -> DataFrame:
    """Flagged claims of one day. Only that day and the six before, which F1 looks back on, are read."""
    at = F.lit(day).cast("date")
    recent = claims.filter(F.col("claim_date").between(F.date_sub(at, 6), at))
    return flags(flag_rules(recent, discharges, at_least=FLAG_SCORE, **limits)).filter(F.col("flag_date") == at)
