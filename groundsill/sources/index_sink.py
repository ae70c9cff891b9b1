"""A data source that index versions are published through.

``df.write.format("groundsill_index")`` writes the rows of an export. Tasks write Parquet files into a
staging folder of the version; what they report (file, rows, least and largest id, dimensions) reaches the
driver's commit step only if all of them succeeded. Commit keeps the reported files alone, so files of tasks
that died or ran twice do not count, checks that the ids are dense, moves the folder in place
and writes the manifest last. A version is there when its manifest is; abort removes the staging folder (a task that is
still being stopped then may make it anew, where no reader looks).
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from groundsill.policy import EmbeddingPin
from groundsill.session import ship_with_tasks
from groundsill.sources import paths
from groundsill.sources.index_store import version_path

ship_with_tasks(__name__)

FORMAT = "groundsill_index"


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote; no file if it had no rows."""

    name: str | None
    rows: int
    low: int
    high: int
    dimensions: tuple[int, ...]


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class IndexWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.manifest = json.loads(options["manifest"])
        self.path = options["path"].rstrip("/")
        self.schema = schema
        self.job = uuid.uuid4().hex
        system, root = _filesystem(self.path)
        if system.get_file_info(f"{root}/vectors").type != pafs.FileType.NotFound:
            raise ValueError(f"index version already exists: {self.path}")

    def staging(self, root: str) -> str:
        return f"{root}/_staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _filesystem(self.path)
        name, rows, low, high, dimensions = f"part-{uuid.uuid4().hex}.parquet", 0, 0, -1, set()
        writer = None
        for batch in iterator:
            if batch.num_rows == 0:
                continue
            if writer is None:
                system.create_dir(self.staging(root))
                writer = pq.ParquetWriter(f"{self.staging(root)}/{name}", batch.schema, filesystem=system)
            writer.write_batch(batch)
            ids = pc.min_max(batch.column("vector_id")).as_py()
            low, high = (ids["min"], ids["max"]) if not rows else (
                min(low, ids["min"]), max(high, ids["max"]))
            rows += batch.num_rows
            dimensions |= set(pc.unique(pc.list_value_length(batch.column("unit_vector"))).to_pylist())
        if writer is None:
            return Written(None, 0, 0, -1, ())
        writer.close()
        return Written(name, rows, low, high, tuple(sorted(d for d in dimensions if d is not None)))

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _filesystem(self.path)
        done = [m for m in messages if m is not None and m.name]
        rows = sum(m.rows for m in done)
        dimensions = {d for m in done for d in m.dimensions}
        if len(dimensions) > 1:
            self.abort(messages)
            raise ValueError(f"vectors of several dimensions: {sorted(dimensions)}")
        if done and (min(m.low for m in done) != 0 or max(m.high for m in done) != rows - 1):
            self.abort(messages)
            raise ValueError("vector ids do not run from 0 to the number of rows")
        staging = self.staging(root)
        system.create_dir(staging)
        if not done:
            empty = to_arrow_schema(self.schema).empty_table()
            pq.write_table(empty, f"{staging}/part-{uuid.uuid4().hex}.parquet", filesystem=system)
        else:
            reported = {m.name for m in done}
            for info in system.get_file_info(pafs.FileSelector(staging)):
                if posixpath.basename(info.path) not in reported:
                    system.delete_file(info.path)
        system.move(staging, f"{root}/vectors")
        told = {**self.manifest, "vector_count": rows}
        if dimensions:
            told["embedding_dim"] = dimensions.pop()
        system.create_dir(f"{root}/manifest")
        # Written under a name that readers pass over, then renamed: it is there whole or not at all.
        with system.open_output_stream(f"{root}/manifest/_part.json") as out:
            out.write(json.dumps(told).encode() + b"\n")
        system.move(f"{root}/manifest/_part.json", f"{root}/manifest/part.json")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _filesystem(self.path)
        if system.get_file_info(self.staging(root)).type != pafs.FileType.NotFound:
            system.delete_dir(self.staging(root))


class IndexSink(DataSource):
    """Write side only; a published version is read as the Parquet that it is."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> IndexWriter:
        if overwrite:
            raise ValueError("published versions are not overwritten")
        return IndexWriter(dict(self.options), schema)


def publish(export: DataFrame, root: str, index_name: str, index_version: str, pin: EmbeddingPin,
            export_run_id: str, built_at_utc: str) -> str:
    """Publish an export as a version, or nothing; fails if the version is there.

    ``root`` is a folder that pyarrow can reach as well (a path or a ``file:``, ``hdfs:``, ``s3:``
    address); through other stores ``index_store.publish`` publishes by Spark's own writers.
    """
    spark = export.sparkSession
    path = version_path(root, index_name, index_version)
    manifest = {
        "index_name": index_name, "index_version": index_version,
        "embedding_model_name": pin.model_name, "embedding_model_version": pin.model_version,
        "embedding_dim": pin.dimension, "similarity": "cosine", "vector_count": 0,
        "export_run_id": export_run_id, "built_at_utc": built_at_utc,
        "index_file": f"{path}/vectors", "id_map": f"{path}/vectors", "metadata": f"{path}/vectors",
    }
    spark.dataSource.register(IndexSink)
    export.write.format(FORMAT).mode("append").option("manifest", json.dumps(manifest)).save(path)
    return path


def load_published(spark: SparkSession, root: str, index_name: str, index_version: str) -> DataFrame:
    """A published version; one without a manifest is refused, whatever lies in its folder."""
    path = version_path(root, index_name, index_version)
    if not paths.files(spark, f"{path}/manifest"):
        raise ValueError(f"no such index version: {index_name} {index_version}")
    return spark.read.parquet(f"{path}/vectors")
