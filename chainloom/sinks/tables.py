"""Stored tables on plain Parquet directories with all-or-nothing commits.

Two shapes are enough. Facts are appended as ``batch_id=…`` partitions: a replayed batch rewrites
its own partition, and a batch counts once its manifest row exists. Small keyed tables and derived
views are rewritten as a new version directory; the newest version that has a commit marker is the
current one, so readers of an older version are not disturbed.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.operators.merge import insert_only_merge, upsert

_VERSION = re.compile(r"v=(\d+)(?:__(.+))?$")
_MARKER = "_SUCCESS"


class _Files:
    """The few file-system questions asked, answered by the file system of the path."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().toString() for s in self._fs.listStatus(self._path(path))]

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staging folder."""
    _Files(spark, path).delete(path)


class VersionedTable:
    """A small keyed table or a derived view, replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keep: int = 2):
        self.spark, self.path, self.schema, self.keep = spark, path, schema, keep

    def _committed(self) -> list[tuple[int, str, str]]:
        files = _Files(self.spark, self.path)
        found = []
        for child in files.children(self.path):
            hit = _VERSION.search(child)
            if hit and files.exists(f"{child}/{_MARKER}"):
                found.append((int(hit.group(1)), hit.group(2) or "", child))
        return sorted(found)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [v for v, _, _ in self._committed()]

    def tag(self) -> str:
        """Tag of the current version: the last batch folded in."""
        done = self._committed()
        return done[-1][1] if done else ""

    def read(self) -> DataFrame:
        """Current rows; an empty table before the first commit."""
        done = self._committed()
        if not done:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(done[-1][2])

    def replace(self, df: DataFrame, tag: str | None = None) -> int:
        """Write a new version from ``df``, which may read the current one; returns its number.

        Without ``tag`` the new version keeps the tag of the current one.
        """
        done = self._committed()
        version = (done[-1][0] if done else 0) + 1
        label = self.tag() if tag is None else tag
        suffix = f"__{label}" if label else ""
        df.write.mode("overwrite").parquet(f"{self.path}/v={version}{suffix}")
        files = _Files(self.spark, self.path)
        for _, _, old in done[: max(0, len(done) + 1 - self.keep)]:
            files.delete(old)
        return version

    def upsert(self, new: DataFrame, key: list[str]) -> int:
        """Insert or replace rows by key."""
        return self.replace(upsert(self.read(), new, key))


class BatchTable:
    """An append-only table whose batches become visible through a manifest."""

    def __init__(self, spark: SparkSession, path: str, schema: str, manifest: str | None = None):
        self.spark, self.path, self.schema = spark, path, schema
        self.manifest_path = manifest or f"{path}_manifest"

    def _load(self, path: str, schema: str) -> DataFrame:
        if not any("batch_id=" in c for c in _Files(self.spark, path).children(path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def manifest(self) -> DataFrame:
        return self._load(self.manifest_path, schemas.MANIFEST)

    def committed(self, batch_id: str) -> bool:
        target = f"{self.manifest_path}/batch_id={batch_id}"
        return _Files(self.spark, target).exists(f"{target}/{_MARKER}")

    def read_batch(self, batch_id: str) -> DataFrame:
        """Rows written for one batch, committed or not."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")

    def read_batches(self, batch_ids: list[str]) -> DataFrame:
        """Rows of some batches; only their folders are listed and read."""
        files = _Files(self.spark, self.path)
        paths = [p for b in batch_ids if files.exists(f"{(p := f'{self.path}/batch_id={b}')}/{_MARKER}")]
        schema = f"{self.schema}, batch_id string"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def written(self, batch_id: str) -> bool:
        """Whether the rows of a batch are complete, committed or not."""
        target = f"{self.path}/batch_id={batch_id}"
        return _Files(self.spark, target).exists(f"{target}/{_MARKER}")

    def batches(self) -> list[str]:
        """Ids of the batches written so far, committed or not."""
        return sorted(c.rsplit("batch_id=", 1)[1] for c in _Files(self.spark, self.path).children(self.path) if "batch_id=" in c)

    def write_batch(self, df: DataFrame, batch_id: str) -> None:
        """Write the rows of one batch; writing it again replaces exactly these rows."""
        # AQE splits or joins the output files by size
        target = f"{self.path}/batch_id={batch_id}"
        df.hint("rebalance").write.mode("overwrite").parquet(target)

    def commit(self, manifest: DataFrame, batch_id: str) -> None:
        """Make a written batch visible; always the last step of a batch."""
        row = manifest.drop("batch_id").coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.manifest_path}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        """Rows of committed batches, with their ``batch_id``."""
        rows = self._load(self.path, f"{self.schema}, batch_id string")
        return rows.join(self.manifest().select("batch_id").distinct(), "batch_id", "left_semi")

    def write_facts(
        self,
        df: DataFrame,
        batch_id: str,
        coverage: DataFrame,
        now: Column,
        key: list[str] | None = None,
        order: list[str] | None = None,
    ) -> None:
        """Write rows and coverage of a batch as one commit.

        ``coverage`` is ``(handler, from_height, to_height, blocks)``. With ``key`` rows stored by
        other batches are skipped, so overlapping batches stay free of duplicates.
        """
        rows = df
        if key:
            others = self.read().where(F.col("batch_id") != batch_id)
            rows = insert_only_merge(others, df, key, order or key)
        self.write_batch(rows, batch_id)
        total = self.read_batch(batch_id).agg(F.count(F.lit(1))).scalar()
        self.commit(
            coverage.select(
                "handler",
                "from_height",
                "to_height",
                F.col("blocks").cast("bigint").alias("blocks"),
                total.alias("rows"),
                now.alias("committed_at"),
            ),
            batch_id,
        )

    def coverage(self) -> DataFrame:
        """Covered ranges derived from the manifest, so rows and coverage cannot disagree."""
        return self.manifest().where("handler is not null").select("handler", "from_height", "to_height")


def refresh_view(table: VersionedTable, build) -> int:
    """Rebuild a derived table; readers keep the previous version until the commit."""
    return table.replace(build())


def apply_sql_dir(spark: SparkSession, directory: str) -> DataFrame:
    """Run every ``*.sql`` file of a directory in name order; returns ``(file, status, error)``.

    Empty files are skipped, and a failing file does not stop the later ones.
    """
    report = []
    names = sorted(n for n in os.listdir(directory) if n.endswith(".sql")) if os.path.isdir(directory) else []
    for name in names:
        with open(os.path.join(directory, name), encoding="utf-8") as f:
            text = f.read().strip()
        if not text:
            report.append((name, "skipped", None))
            continue
        try:
            for statement in _statements(text):
                spark.sql(statement)
            report.append((name, "applied", None))
        except Exception as e:  # noqa: BLE001 - a broken file is reported, not raised
            report.append((name, "failed", str(e).splitlines()[0][:250]))
    return spark.createDataFrame(report, "file string, status string, error string")


def _statements(text: str) -> list[str]:
    """Statements of a file, one per ``;`` at a line end."""
    return [s.strip() for s in re.split(r";[ \t]*(?:\n|\Z)", text) if s.strip()]
