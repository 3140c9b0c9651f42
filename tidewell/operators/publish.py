"""Staged, versioned publishing of tables on plain files.

A table is a folder of version folders and a small pointer file that names the
current one. A version is written beside the current, read back and validated, and
only then the pointer is replaced by an atomic rename; a reader sees either the
old version or the new one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


class VersionedTable:
    """Parquet table with versions under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.fs, self._p = _fs(spark, self.path)

    def versions(self) -> list[int]:
        root = self._p(self.path)
        if not self.fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(root)]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())

    def current(self) -> int | None:
        """Version the highest pointer names."""
        root = self._p(self.path)
        if not self.fs.exists(root):
            return None
        marks = [s.getPath().getName() for s in self.fs.listStatus(root)]
        done = [m for m in marks if m.startswith("CURRENT-")]
        if not done:
            return None
        return int(max(done, key=lambda m: int(m.split("-")[1])).split("-")[2])

    def _point(self, version: int) -> None:
        root = self._p(self.path)
        marks = [s.getPath().getName() for s in self.fs.listStatus(root)]
        n = 1 + max([int(m.split("-")[1]) for m in marks if m.startswith("CURRENT-")], default=0)
        draft = self._p(f"{self.path}/.draft-{n}")
        self.fs.create(draft, True).close()
        if not self.fs.rename(draft, self._p(f"{self.path}/CURRENT-{n}-{version}")):
            raise OSError(f"can't point {self.path} to version {version}")

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current() if version is None else version
        if v is None:
            raise FileNotFoundError(f"{self.path} has no published version")
        return self.spark.read.parquet(f"{self.path}/v{v}")

    def publish(self, df: DataFrame, validate: Callable[[DataFrame], None] | None = None, partition_by: list[str] | None = None) -> int:
        """Writes and validates a new version, then makes it the current one. If
        ``validate`` raises, the version is removed and the old one stays."""
        v = 1 + max(self.versions(), default=0)
        w = df.write.mode("errorifexists")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{self.path}/v{v}")
        try:
            if validate:
                validate(self.spark.read.parquet(f"{self.path}/v{v}"))
        except Exception:
            self.fs.delete(self._p(f"{self.path}/v{v}"), True)
            raise
        self._point(v)
        return v

    def log(self) -> DataFrame:
        """(step, version, is_current): every pointer that was set, in order; the
        table's history of publications and rollbacks."""
        root = self._p(self.path)
        names = [s.getPath().getName() for s in self.fs.listStatus(root)] if self.fs.exists(root) else []
        steps = sorted((int(m.split("-")[1]), int(m.split("-")[2])) for m in names if m.startswith("CURRENT-"))
        rows = [(n, v, (n, v) == steps[-1]) for n, v in steps]
        return self.spark.createDataFrame(rows, "step bigint, version bigint, is_current boolean")

    def rollback(self, version: int) -> None:
        if version not in self.versions():
            raise ValueError(f"{self.path} has no version {version}")
        self._point(version)

    def clean(self, keep: int = 2) -> list[int]:
        """Removes old versions but the current one and the newest ``keep``."""
        now = self.current()
        gone = [v for v in self.versions()[:-keep] if v != now]
        for v in gone:
            self.fs.delete(self._p(f"{self.path}/v{v}"), True)
        return gone


def overwrite_range(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Idempotent recomputation of a range: replaces exactly the partitions that
    ``df`` holds and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
