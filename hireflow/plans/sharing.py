"""Views derived for sharing: skill bridge and masked candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hireflow.functions.hashing import salted_hash


def candidate_skill(candidates: DataFrame) -> DataFrame:
    """One row per candidate and distinct skill."""
    return candidates.select(
        "candidate_id", F.explode(F.array_distinct("skills_array")).alias("skill")
    )


def masked_candidates(candidates: DataFrame, salt: str) -> DataFrame:
    """Candidates without readable contact data; tokens still match across tables."""
    return candidates.select(
        "candidate_id",
        F.mask("first_name").alias("first_name"),
        F.mask("last_name").alias("last_name"),
        salted_hash(F.col("email"), salt).alias("email_token"),
        salted_hash(F.col("phone"), salt).alias("phone_token"),
        F.mask("email").alias("email_masked"),
        F.mask("phone").alias("phone_masked"),
        "skills_normalized",
        "skills_count",
    )
