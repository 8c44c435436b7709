"""Publication: what each layer may and must show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that a published message layer must not have, what stands for them, and what it must have. Fixed values.
RAW_TO_SAFE = {"sender_phone": "sender_phone_masked", "sender_name": "sender_name_masked", "message_body": "message_body_masked"}
FORBIDDEN = (*RAW_TO_SAFE, "lead_name_raw", "conversation_lead_name", "conversation_agent_name", "conversation_lead_phone", "sender_name_normalized", "lead_phone_raw")


def sanitize(df: DataFrame) -> DataFrame:
    return df.drop(*FORBIDDEN)


def safe_keys(keys: tuple[str, ...]) -> tuple[str, ...]:
    """Raw key columns replaced by their masked ones."""
    return tuple(RAW_TO_SAFE.get(k, k) for k in keys)


def column_audit(df: DataFrame, required: tuple[str, ...] = tuple(RAW_TO_SAFE.values())) -> DataFrame:
    """One row: rows, forbidden columns that are there, required safe ones that are missing."""
    there = ",".join(c for c in df.columns if c in FORBIDDEN)
    missing = ",".join(c for c in required if c not in df.columns)
    return df.agg(F.count("*").alias("rows")).select("rows", F.lit(there).alias("forbidden_present"), F.lit(missing).alias("safe_missing"))
