"""Named sources and model references (the ``source()`` / ``ref()`` roles).

A ``Catalog`` maps names to storage (a folder of parquet or a catalog
table) and models to functions; ``ref`` calls the model function, so the
whole chain from scan to mart stays one lazy plan. Tables published through
the catalog are versioned (``versions``): a reader gets one whole version.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW_TABLES
from .versions import VersionedTable


@dataclass
class Catalog:
    spark: SparkSession
    root: str | None = None  # folder holding <layer>/<name>
    tables: dict[str, str] = field(default_factory=dict)  # name -> path or catalog table
    models: dict[str, Callable[[Catalog], DataFrame]] = field(default_factory=dict)

    def _place(self, layer: str, name: str) -> str:
        key = f"{layer}.{name}"
        if key in self.tables:
            return self.tables[key]
        if self.root is None:
            raise KeyError(f"no location for {key}")
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def versioned(self, layer: str, name: str) -> VersionedTable:
        """The table as versions: stage, commit, read as of, roll back."""
        return VersionedTable(self.spark, self._place(layer, name))

    def location(self, layer: str, name: str) -> str:
        """Where the table's files lie; of a versioned table, where those of its current version do."""
        place = self._place(layer, name)
        if "/" in place:
            table = VersionedTable(self.spark, place)
            if table.exists():
                return table.location()
        return place

    def source(self, name: str, layer: str = "raw") -> DataFrame:
        place = self._place(layer, name)
        if "/" not in place and "." in place:  # catalog table name
            return self.spark.table(place)
        table = VersionedTable(self.spark, place)
        if table.exists():
            found = table.read()
            if layer == "raw" and name in RAW_TABLES:
                return found.select(*[f.name for f in RAW_TABLES[name].schema.fields])
            return found
        reader = self.spark.read
        if layer == "raw" and name in RAW_TABLES:
            reader = reader.schema(RAW_TABLES[name].schema)
        return reader.parquet(place)

    def register(self, name: str, fn: Callable[[Catalog], DataFrame]) -> None:
        self.models[name] = fn

    def ref(self, name: str) -> DataFrame:
        return self.models[name](self)
