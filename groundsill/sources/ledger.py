"""Append-only ledgers to which a run adds its rows once, however often it is tried.

Layout: ``<path>/ledger_run=<run>/``. A run's rows are written to a folder that readers pass over, checked
there, and become visible by one rename. Whoever finds the run's folder in place adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundsill.schemas import enforce
from groundsill.sources import paths

RUN = "ledger_run"
STAGING = "_staging"


class DuplicateKeys(ValueError):
    """A run's rows hold a key twice; nothing was added."""


def run_path(path: str, run_id: str) -> str:
    if not run_id or any(c in run_id for c in "/=%\\") or run_id.startswith(("_", ".")):
        raise ValueError(f"not a folder name: {run_id!r}")
    return f"{path.rstrip('/')}/{RUN}={run_id}"


def append_run(rows: DataFrame, schema: T.StructType, path: str, run_id: str, keys: list[str],
               fmt: str = "parquet") -> bool:
    """Add the rows of a run, all or none; true if this call added them.

    Rows must keep ``schema`` and hold no key twice (null keys count like values). The check
    reads what was written, so it sees the same rows as later readers. A try that dies leaves a
    folder in the staging area at most; the next one starts anew. Of two that run at once one wins.
    """
    spark = rows.sparkSession
    target = run_path(path, run_id)
    if paths.exists(spark, target):
        return False
    staged = f"{path.rstrip('/')}/{STAGING}/{run_id}-{uuid.uuid4().hex}"
    try:
        enforce(rows, schema).write.format(fmt).save(staged)
        written = spark.read.format(fmt).schema(schema).load(staged)
        again = written.groupBy(*keys).count().where("count > 1").limit(1).collect()
        if again:
            raise DuplicateKeys(f"run {run_id}: {again[0].asDict()}")
        return paths.move(spark, staged, target)
    finally:
        paths.remove(spark, staged)


def read_ledger(spark: SparkSession, schema: T.StructType, path: str, runs: list[str] | None = None,
                fmt: str = "parquet") -> DataFrame:
    """All rows with their ``ledger_run``; of some runs only, their folders alone are read."""
    whole = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    if not any(n.startswith(f"{RUN}=") for n in paths.children(spark, path)):
        return spark.createDataFrame([], whole)
    found = spark.read.format(fmt).schema(whole).load(path)
    return found if runs is None else found.where(F.col(RUN).isin(runs))
