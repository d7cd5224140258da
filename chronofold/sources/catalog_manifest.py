"""Catalogue manifests: strict JSON documents of the sections below, and the tables that they are merged into."""

from __future__ import annotations

import re
import unicodedata
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from chronofold.errors import ContractError
from chronofold.functions.text import normalize_symbol_text
from chronofold.operators import merge
from chronofold.sources.manifests import decimal, document, fields_of, instant

MOST_CHARS = 2048


def _text(v: object) -> str:
    if not isinstance(v, str) or not v.strip() or len(v) > MOST_CHARS or "\r" in v or "\n" in v:
        raise ContractError(f"{v!r} is no single line of text")
    return v


def _symbol(v: object) -> str:
    out = normalize_symbol_text(_text(v))
    if not out:
        raise ContractError("an empty symbol")
    return out


def _isin(v: object) -> str:
    out = normalize_symbol_text(unicodedata.normalize("NFKC", _text(v))).upper()
    if not re.fullmatch(r"[A-Z]{2}[A-Z0-9]{9}[0-9]", out):
        raise ContractError(f"{v!r} is no ISIN")
    return out


def _whole(v: object) -> int:
    if type(v) is not int:
        raise ContractError(f"{v!r} is no whole number")
    return v


def _flag(v: object) -> bool:
    if type(v) is not bool:
        raise ContractError(f"{v!r} is neither true nor false")
    return v


KINDS = {"text": _text, "symbol": _symbol, "isin": _isin, "whole": _whole, "flag": _flag, "decimal": decimal, "instant": lambda v: instant(v).replace(tzinfo=None)}
TYPES = {"text": "string", "symbol": "string", "isin": "string", "whole": "int", "flag": "boolean", "decimal": "decimal(38,18)", "instant": "timestamp_ntz"}

#: The sections of a manifest; a field is named with its kind, with a question mark if it may be left out or null. The key stands first.
SECTIONS = {
    "providers": "provider_code:text display_name:text provider_kind:text base_url:text? default_timezone:text?",
    "feeds": "feed_code:text provider_code:text display_name:text data_kind:text native_timezone:text? parser_version:text? active_from:instant? active_to:instant?",
    "currencies": "currency_code:text display_name:text minor_unit:whole is_fiat:flag",
    "asset_types": "asset_type_code:text display_name:text description:text?",
    "venues": "venue_code:text display_name:text mic_code:text? country_code:text? timezone_name:text base_currency_code:text?",
    "timeframes": "timeframe_code:text display_name:text duration_seconds:whole? calendar_unit:text session_aligned:flag",
    "provider_market_mappings": "provider_market:text provider_code:text venue_code:text",
    "instruments": "stable_key:text provider_code:text provider_symbol:symbol isin:isin name_fa:text name_en:text asset_type_code:text venue_code:text currency_code:text status:text active_from:instant? active_to:instant? identifier_valid_from:instant spec_effective_from:instant previous_symbol:symbol? rename_effective_from:instant? price_tick:decimal? quantity_step:decimal? lot_size:decimal? contract_multiplier:decimal price_scale:whole? quantity_scale:whole? lower_price_limit:decimal? upper_price_limit:decimal? shares_outstanding:decimal?",
}
PARENTS = {
    "feeds": {"provider_code": "providers"}, "venues": {"base_currency_code": "currencies"}, "provider_market_mappings": {"provider_code": "providers", "venue_code": "venues"},
    "instruments": {"provider_code": "providers", "asset_type_code": "asset_types", "venue_code": "venues", "currency_code": "currencies"},
}


def _fields(section: str) -> list[tuple[str, str, bool]]:
    """(name, kind, whether it must be given) of a section's fields."""
    out = []
    for part in SECTIONS[section].split():
        name, kind = part.split(":")
        out.append((name, kind.rstrip("?"), not kind.endswith("?")))
    return out


#: Names of the columns of each section's table, as DDL, and the tables in the order of their dependencies.
SCHEMAS = {s: ", ".join(f"{n} {TYPES[k]}" for n, k, _ in _fields(s)) for s in SECTIONS}
ORDER = ("providers", "currencies", "asset_types", "timeframes", "feeds", "venues", "provider_market_mappings", "instruments")
KEYS = {"provider_market_mappings": 2}
TABLES = [merge.Table(s, tuple(n for n, _, _ in _fields(s)[: KEYS.get(s, 1)]), tuple(n for n, _, _ in _fields(s)[KEYS.get(s, 1) :]), PARENTS.get(s, {})) for s in ORDER]

#: What the fields of one row owe each other: a section, a rule and what it says.
RULES = (
    ("feeds", lambda r: r["active_from"] is None or r["active_to"] is None or r["active_to"] > r["active_from"], "active_to is not after active_from"),
    ("timeframes", lambda r: r["duration_seconds"] is None or r["duration_seconds"] > 0, "duration_seconds is not positive"),
    ("timeframes", lambda r: r["calendar_unit"] != "FIXED" or r["duration_seconds"] is not None, "a FIXED timeframe has no duration"),
    ("instruments", lambda r: (r["previous_symbol"] is None) == (r["rename_effective_from"] is None), "previous_symbol and rename_effective_from come together"),
    ("instruments", lambda r: r["rename_effective_from"] is None or r["rename_effective_from"] > r["identifier_valid_from"], "rename_effective_from is not after identifier_valid_from"),
    ("instruments", lambda r: r["active_from"] is None or r["active_to"] is None or r["active_to"] > r["active_from"], "active_to is not after active_from"),
    ("instruments", lambda r: r["contract_multiplier"] > 0, "contract_multiplier is not positive"),
    ("instruments", lambda r: r["lower_price_limit"] is None or r["upper_price_limit"] is None or r["upper_price_limit"] >= r["lower_price_limit"], "upper_price_limit lies below lower_price_limit"),
)


def parse(body: bytes) -> tuple[str, dict[str, list[dict[str, str | int | bool | Decimal | datetime | None]]]]:
    """(manifest_id, rows of each section): all sections, no unknown fields, keys that differ, references within the document or to what is stored."""
    got = document(body, {"manifest_id", "generated_at", "source", *SECTIONS})
    _text(got["source"])
    instant(got["generated_at"])
    out = {}
    for section in SECTIONS:
        fields = _fields(section)
        if not isinstance(got[section], list):
            raise ContractError(f"{section} is no list")
        rows = []
        for i, raw in enumerate(got[section]):
            fields_of(raw, {n for n, _, must in fields if must}, {n for n, _, must in fields if not must} | {"metadata"})
            try:
                row = {n: KINDS[k](raw[n]) if must or raw.get(n) is not None else None for n, k, must in fields}
                for name, holds, what in RULES:
                    if name == section and not holds(row):
                        raise ContractError(what)
            except ContractError as e:
                raise ContractError(f"{section}[{i}]: {e}") from e
            rows.append(row)
        key = [n for n, _, _ in fields[: KEYS.get(section, 1)]]
        if len({tuple(r[k] for k in key) for r in rows}) != len(rows):
            raise ContractError(f"two {section} have one key")
        out[section] = rows
    if len({r["isin"] for r in out["instruments"]}) != len(out["instruments"]):
        raise ContractError("two instruments have one ISIN")
    return _text(got["manifest_id"]), out


def frames(spark: SparkSession, rows: dict[str, list[dict]]) -> dict[str, DataFrame]:
    """The sections that hold rows, as candidates of a merge."""
    return {s: spark.createDataFrame([tuple(r[n] for n, _, _ in _fields(s)) for r in rows[s]], SCHEMAS[s]) for s in ORDER if rows[s]}
