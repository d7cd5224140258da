"""Catalogue of instruments: which stored instrument a manifest's entry means, and whether a provider agrees with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.temporal import valid_at

#: What an entry's two identifiers say about it.
CREATE, KNOWN, RENAME, SYMBOL_ONLY, DIFFERENT, UNANNOUNCED = "CREATE", "KNOWN", "RENAME", "SYMBOL_WITHOUT_ISIN", "TWO_INSTRUMENTS", "RENAME_NOT_ANNOUNCED"


def owners(entries: DataFrame, identifiers: DataFrame, kind: str, value: str, name: str) -> DataFrame:
    """entries with the instrument that holds their identifier at their valid_from, null without one."""
    i = identifiers.where(F.col("identifier_type") == kind).select(F.col("identifier_value").alias("_v"), F.col("instrument_id").alias(name), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
    return entries.join(i, (F.col(value) == F.col("_v")) & valid_at(F.col("_from"), F.col("_to"), F.col("valid_from")), "left").drop("_v", "_from", "_to")


def identity_outcomes(entries: DataFrame, identifiers: DataFrame) -> DataFrame:
    """entries (isin, symbol, previous_symbol, valid_from) with isin_owner, symbol_owner and outcome.

    The ISIN decides before the symbol, nothing is merged silently, and a new symbol of a known ISIN needs an announced
    rename."""
    out = owners(owners(entries, identifiers, "ISIN", "isin", "isin_owner"), identifiers, "SYMBOL", "symbol", "symbol_owner")
    isin, symbol = F.col("isin_owner"), F.col("symbol_owner")
    outcome = (
        F.when(isin.isNull() & symbol.isNull(), CREATE).when(isin.isNull(), SYMBOL_ONLY).when(symbol.isNotNull() & (symbol != isin), DIFFERENT)
        .when(symbol.isNotNull(), KNOWN).when(F.col("previous_symbol").isNull(), UNANNOUNCED).otherwise(RENAME)
    )
    return out.withColumn("outcome", outcome)


def provider_mismatches(entries: DataFrame, metadata: DataFrame) -> DataFrame:
    """entries (stable_key, symbol, isin, venue) whose provider metadata (symbol, isin, venue by requested symbol) are absent or differ; the first difference counts."""
    m = metadata.select(F.col("requested_symbol").alias("symbol"), F.col("symbol").alias("_symbol"), F.col("isin").alias("_isin"), F.col("venue").alias("_venue"))
    code: Column = (
        F.when(F.col("_symbol").isNull(), "NO_METADATA").when(F.col("_symbol") != F.col("symbol"), "SYMBOL_MISMATCH")
        .when(~F.col("_isin").eqNullSafe(F.col("isin")), "ISIN_MISMATCH").when(~F.col("_venue").eqNullSafe(F.col("venue")), "MARKET_MISMATCH")
    )
    return entries.join(m, "symbol", "left").withColumn("mismatch", code).where("mismatch IS NOT NULL").select("stable_key", "mismatch")
