"""Provider responses from files: exact bytes, with an injected clock."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.errors import ContractError, NotFound
from chronofold.functions.text import normalize_symbol_text
from chronofold.operators.ingest import strict_json


@dataclass(frozen=True)
class Response:
    body: bytes
    requested_at: datetime
    received_at: datetime


class FixtureClient:
    """Answers every request with one file's bytes; clock gives the request's and the receipt's instants."""

    def __init__(self, path: str | Path, clock: Callable[[], datetime]):
        self.path, self.clock = Path(path), clock

    def fetch(self, symbol: str) -> Response:
        asked = self.clock()
        return Response(self.path.read_bytes(), asked, self.clock())


class IndexedFixtures:
    """A folder with index.json {"schema_version": 1, "symbols": {symbol: file}}; no file may lie outside it."""

    def __init__(self, folder: str | Path, clock: Callable[[], datetime]):
        self.clock, root = clock, Path(folder).resolve()
        index = strict_json((root / "index.json").read_bytes())
        if not isinstance(index, dict) or set(index) != {"schema_version", "symbols"} or type(index["schema_version"]) is not int or index["schema_version"] != 1:
            raise ContractError("not an index")
        self.files: dict[str, Path] = {}
        for symbol, name in index["symbols"].items():
            key, path = normalize_symbol_text(symbol), (root / name).resolve()
            if not key or key in self.files or not path.is_relative_to(root) or not path.is_file():
                raise ContractError(f"bad entry {symbol!r}")
            self.files[key] = path

    def fetch(self, symbol: str) -> Response:
        if (path := self.files.get(normalize_symbol_text(symbol))) is None:
            raise NotFound(f"no fixture for {symbol!r}")
        return FixtureClient(path, self.clock).fetch(symbol)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Many response files: path, body, body_sha256."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("content").alias("body"), F.sha2("content", 256).alias("body_sha256"))


def symbol_metadata(body: bytes) -> dict:
    """The required (l18, isin, m) and optional fields of a symbol response."""
    got = strict_json(body)
    if not isinstance(got, dict) or got.get("successful") is False:
        raise ContractError("no symbol metadata")
    out = {}
    for name in ("l18", "isin", "m"):
        if not isinstance(got.get(name), str) or not got[name].strip():
            raise ContractError(f"{name} is missing")
        out[name] = got[name].strip()
    for name in ("l30", "l30_en", "m_board", "cs", "date_update", "time", "state"):
        if got.get(name) is not None and not isinstance(got[name], str):
            raise ContractError(f"{name} is no text")
        out[name] = got.get(name)
    return out
