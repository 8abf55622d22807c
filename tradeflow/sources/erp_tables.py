"""ERP relations stored as Parquet tables (one folder per relation).

This is the production input of the reports: an extract lands each ERP relation
under ``root/<name>`` (or any mapping of names to paths). Reports read them
lazily in their declared schemas (``sources.schemas``), with Catalyst pruning
columns and pushing filters into each scan.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

from tradeflow.sources.parquet_io import path_exists, write_parquet
from tradeflow.sources.schemas import ERP_OPTIONAL, ERP_SCHEMAS, MissingInput, conform, empty

ERP_RELATIONS = tuple(ERP_SCHEMAS)


class ErpParquetTables:
    """Relations by name, each conformed to its declaration when it is first used.

    ``missing`` says what a relation without files is: ``"error"`` (MissingInput)
    or ``"empty"`` (no rows, the declared columns; S10). Drift is an error always.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, paths: Mapping[str, str] | None = None, missing: str = "error"):
        if missing not in ("error", "empty"):
            raise ValueError(f"missing must be 'error' or 'empty', not {missing!r}")
        self.spark, self.missing = spark, missing
        self.paths = dict(paths or {})
        if root:
            for name in ERP_RELATIONS:
                self.paths.setdefault(name, f"{root.rstrip('/')}/{name}")
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._read(name)
        return self._frames[name]

    def _read(self, name: str) -> DataFrame:
        path, schema = self.paths[name], ERP_SCHEMAS[name]
        if not path_exists(self.spark, path):
            if self.missing == "error":
                raise MissingInput(f"relation {name}: nothing at {path}")
            return empty(self.spark, schema)
        return conform(self.spark.read.parquet(path), schema, name, ERP_OPTIONAL.get(name))

    def __contains__(self, name: str) -> bool:
        return name in self.paths

    def keys(self):
        return self.paths.keys()


def land(tables: Mapping[str, DataFrame], root: str, names=ERP_RELATIONS) -> dict[str, str]:
    """Write relations to the landing zone in their declared schemas; returns the paths."""
    out = {}
    for name in names:
        out[name] = f"{root.rstrip('/')}/{name}"
        write_parquet(conform(tables[name], ERP_SCHEMAS[name], name, ERP_OPTIONAL.get(name)), out[name])
    return out
