"""Write, audit, publish (W1 behind the blocking gate of the D-* rules).

A table is *staged* first: written to a folder of its own below the shared
checkpoint folder, with its metrics taken by ``observe`` while it is written,
so that no audit reads the data a second time.  Rules are evaluated on the
staged files.  *Publishing* replaces one catalog view per table, which carries
the lineage as properties; it happens only when no CRITICAL rule failed, so a
failing run leaves every published table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import gate
from ..session import checkpoint_dir, delete_folder, keep, remember
from .tables import _q

#: View property that names the folder of the published version.
VERSION = "publish.folder"


@dataclass
class Staged:
    """A written but unpublished table: its rows (read back), folder and metrics."""

    rows: DataFrame
    folder: str
    metrics: dict = field(default_factory=dict)


def watched(df: DataFrame, metrics: dict[str, Column], name: str | None = None) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates over its rows that whatever job reads it leaves
    in the observation (F3, F7 and U3 audits at any point of a plan)."""
    seen = Observation(name or f"metrics-{uuid.uuid4().hex}")
    return df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), seen


def stage(df: DataFrame, label: str, metrics: dict[str, Column] | None = None, observations: Iterable[Observation] = ()) -> Staged:
    """Write ``df`` once and read it back.

    ``metrics`` are aggregates over the written rows; ``observations`` are
    those that :func:`watched` put further up in the plan.  All are ready when
    the write is done: one job, one scan of the inputs.
    """
    folder = remember(df.sparkSession, f"{checkpoint_dir(df.sparkSession).rstrip('/')}/staged/{label}-{uuid.uuid4().hex}")
    own = None
    if metrics:
        df, own = watched(df, metrics)
    df.write.parquet(folder)
    found: dict = {}
    for seen in [*observations, *([own] if own else [])]:
        found |= seen.get
    return Staged(df.sparkSession.read.schema(df.schema).parquet(folder), folder, found)


def table_metrics(df: DataFrame) -> dict[str, Column]:
    """Rows and null cells of a table, as metrics of its write."""
    nulls = F.lit(0).cast("long")
    for c in df.columns:
        nulls = nulls + F.count_if(F.col(f"`{c}`").isNull())
    return {"rows": F.count(F.lit(1)), "null_cells": nulls}


def published_folder(spark: SparkSession, name: str) -> str | None:
    """Folder of the version that is published under a name."""
    if not spark.catalog.tableExists(name):
        return None
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(VERSION)


def publish(tables: dict[str, Staged], rules: DataFrame, props: dict[str, str] | None = None) -> DataFrame:
    """Publish staged tables under their names when the rules allow it.

    Raises, before any table is touched, when a CRITICAL rule failed.  Each
    name becomes a view of its staged folder, in one catalog operation with
    its lineage properties; versions published before stay on disk until
    :func:`retire`.  Returns the rules.
    """
    gate(rules)
    spark = rules.sparkSession
    for name, t in tables.items():
        own = {**(props or {}), VERSION: t.folder}
        body = ", ".join(f"{_q(k)} = {_q(v)}" for k, v in own.items())
        spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({body}) AS SELECT * FROM parquet.`{t.folder}`")
        keep(spark, t.folder)
    return rules


def discard(tables: Iterable[Staged]) -> None:
    """Delete staged tables that are not to be published."""
    for t in tables:
        delete_folder(t.rows.sparkSession, t.folder)


def retire(spark: SparkSession, folders: Iterable[str | None]) -> None:
    """Delete versions that are no longer published."""
    for folder in folders:
        if folder:
            delete_folder(spark, folder)


def layer_properties(spark: SparkSession, layer: str, names: dict[str, str]) -> DataFrame:
    """Properties of all tables of a layer, (layer, table, key, value), for R2,
    R3 and the cross-table contract.  ``names``: {logical name: catalog name};
    catalog metadata only, no table is read."""
    rows = [(layer, logical, r["key"], r["value"]) for logical, name in names.items() for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()]
    return spark.createDataFrame(rows, "layer string, table string, key string, value string")
