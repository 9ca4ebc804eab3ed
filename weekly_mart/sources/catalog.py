"""Layers as databases of Spark's own catalog, with bucketed tables.

A table's files stand at a location of the workspace, written by `saveAsTable`
with its bucket specification. Spark's built-in catalog lives as long as the
application; `attach` declares tables that an earlier one wrote again, with
schema and buckets, so any session over the same workspace can `SELECT` from
them. Tables with equal keys and bucket counts are joined on these keys without
a shuffle of either side.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame

from weekly_mart.sources.workspace import Workspace

LAYERS = ("bronze", "silver", "gold")
#: Bytes of landing files, as they are compressed, that one bucket stands for, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 32 * 1024 * 1024, 8


def buckets_for(nbytes: int) -> int:
    """Number of buckets for tables over an input: one for each ``BUCKET_BYTES``."""
    return max(LEAST_BUCKETS, -(-nbytes // BUCKET_BYTES))


class Catalog:
    """The databases ``{prefix}_{layer}``; their tables stand under ``{home}/{layer}/{table}``."""

    def __init__(self, ws: Workspace, home: str, prefix: str):
        self.ws, self.spark, self.home, self.prefix = ws, ws.spark, home.rstrip("/"), prefix

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        return f"{self.prefix}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def create_layers(self) -> list[str]:
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}")
        return [self.database(layer) for layer in LAYERS]

    def _target(self, layer: str, table: str) -> str:
        return f"{self.home}/{layer}/{table}"

    def replace(
        self, layer: str, table: str, df: DataFrame, keys: list[str] | None = None, buckets: int | None = None
    ) -> DataFrame:
        """Create or replace a table: its files are written to a new version, then the name is switched to it."""
        self.create_layers()
        spec = {"keys": keys or [], "buckets": buckets or 0, "columns": [(f.name, f.dataType.simpleString()) for f in df.schema]}

        def save(path: str) -> None:
            # the writer declares the table; under a name of its own until all files are there
            staged = f"{self.name(layer, table)}__{path.rsplit('-', 1)[-1]}"
            writer = df.write.format("parquet").option("path", path)
            if keys:
                writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
            writer.saveAsTable(staged)
            self.spark.sql(f"DROP TABLE {staged}")  # an external table: its files stay

        self.ws.write_with(save, self._target(layer, table), note=json.dumps(spec))
        return self.attach(layer, table)

    def attach(self, layer: str, table: str) -> DataFrame:
        """Declare the newest complete version of a table in this session's catalog and read it."""
        path = self.ws.current(self._target(layer, table))
        if path is None:
            raise FileNotFoundError(f"no complete version of {self._target(layer, table)}")
        spec = json.loads(self.ws.note(path))
        columns = ", ".join(f"`{name}` {kind}" for name, kind in spec["columns"])
        keys = ", ".join(f"`{k}`" for k in spec["keys"])
        clustered = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec['buckets']} BUCKETS" if keys else ""
        name = self.name(layer, table)
        self.create_layers()
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING PARQUET {clustered} LOCATION '{path}'")
        return self.spark.table(name)

    def keep(
        self, layer: str, table: str, build: Callable[[], DataFrame], keys: list[str] | None = None, buckets: int | None = None
    ) -> DataFrame:
        """The table, written from ``build()`` unless a complete version is there."""
        if self.ws.is_complete(self._target(layer, table)):
            return self.attach(layer, table)
        return self.replace(layer, table, build(), keys, buckets)

    def attach_all(self) -> list[str]:
        """Declare every table of the workspace's layers; returns their names."""
        found = []
        for layer in LAYERS:
            for table in self.ws.children(f"{self.home}/{layer}"):
                if self.ws.is_complete(self._target(layer, table)):
                    self.attach(layer, table)
                    found.append(self.name(layer, table))
        return found
