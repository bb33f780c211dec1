"""Score tables: tiers, the score-table layout, and a deterministic rule scorer.

The forest models (``model.py``) are not reproducible across engines, so
everything downstream of scoring (views, alerts, explanation queue, merges,
evaluation) is also exercised on a transparent rule-based score with the
same table layout.  The rule scorer is a stand-in for checking, not a
clinical model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.functions.risk import clip01, round_dec, tier
from clinrisk.operators.features import VITAL_MEASURES
from clinrisk.operators.ids import dense_ids
from clinrisk.operators.star import as_of_ts

RULE_VERSION = "rule_v1"
#: Total order of feature rows (an admission can have several vitals readings).
def feature_row_order() -> list:
    return ["admission_id"] + [F.col(m).asc_nulls_first() for m in VITAL_MEASURES]
RISKS = ["readmission", "deterioration", "mortality"]
SCORE_COLUMNS = ["score_id", "patient_id", "admission_id", "scored_at", "model_version",
                 "readmission_risk", "deterioration_risk", "mortality_risk",
                 "readmission_tier", "deterioration_tier", "mortality_tier",
                 "top_features", "ai_explanation"]


def rule_probabilities(features: DataFrame) -> DataFrame:
    """Unrounded rule scores: shock index, temperature excess, oxygen deficit."""
    shock = F.col("heart_rate") / F.nullif(F.col("systolic_bp"), F.lit(0.0))
    keep = ["feature_row_id"] if "feature_row_id" in features.columns else []
    return features.select(
        *keep, "patient_id", "admission_id", *VITAL_MEASURES,
        clip01(shock).alias("p_readmission"),
        clip01((F.col("temperature") - 36.0) / 3.0).alias("p_deterioration"),
        clip01((F.lit(100.0) - F.col("spo2")) / 10.0).alias("p_mortality"),
    )


def score_table(probs: DataFrame, version: str, scored_at=None, first_id: int = 1, keep_row: bool = False) -> DataFrame:
    """Tiers from the unrounded probability, stored risks rounded to
    4 places, ids in feature-row order from ``first_id`` (a later run goes on
    where the last one ended), empty top-features, no explanation."""
    if "feature_row_id" in probs.columns:
        numbered = probs.withColumn("score_id", F.col("feature_row_id") + F.lit(first_id - 1))
    else:
        numbered = dense_ids(probs, feature_row_order(), "score_id", start=first_id)
    ts = as_of_ts() if scored_at is None else scored_at
    return numbered.select(
        "score_id", "patient_id", "admission_id", ts.alias("scored_at"), F.lit(version).alias("model_version"),
        *[round_dec(F.col(f"p_{r}"), 4).alias(f"{r}_risk") for r in RISKS],
        *[tier(F.col(f"p_{r}")).alias(f"{r}_tier") for r in RISKS],
        F.lit(C.EMPTY_TOP_FEATURES).alias("top_features"),
        F.lit(None).cast("string").alias("ai_explanation"),
        *(["feature_row_id"] if keep_row else []),
    )


def rule_scores(features: DataFrame, **run) -> DataFrame:
    return score_table(rule_probabilities(features), RULE_VERSION, **run)
