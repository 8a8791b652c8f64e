"""Named sources -> DataFrames and temp views.

A source is a Parquet location (local path or any Hadoop URI such as
``s3a://`` / ``gs://``) or a zero-argument callable returning a DataFrame
(used for derived views). Local paths are preferred over the remote base,
as the reference does, but only if they exist.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from shortbook.schemas import SOURCE_NAMES
from shortbook.session import hadoop_fs

log = logging.getLogger(__name__)

SourceSpec = str | Callable[[], DataFrame]


class Catalog:
    def __init__(
        self,
        spark: SparkSession,
        sources: dict[str, SourceSpec] | None = None,
        local_dir: str | None = None,
        remote_base: str | None = None,
    ):
        self.spark = spark
        self.sources: dict[str, SourceSpec] = dict(sources or {})
        self.local_dir = local_dir
        self.remote_base = remote_base

    def _exists(self, path: str) -> bool:
        try:
            fs, p = hadoop_fs(self.spark, path)
            return bool(fs.exists(p))
        except Exception:  # noqa: BLE001 - unreachable filesystem = absent
            return False

    def uri(self, name: str) -> str:
        """Location of a Parquet source: explicit, then local, then remote."""
        spec = self.sources.get(name)
        if isinstance(spec, str):
            return spec
        if self.local_dir:
            local = f"{self.local_dir.rstrip('/')}/{name}.parquet"
            if self._exists(local) or not self.remote_base:
                return local
        if self.remote_base:
            return f"{self.remote_base.rstrip('/')}/{name}.parquet"
        raise KeyError(f"unknown source {name!r}")

    def read(self, name: str) -> DataFrame:
        spec = self.sources.get(name)
        if callable(spec):
            return spec()
        from shortbook.sources.sinks import latest_version
        uri = self.uri(name)
        # a versioned publish folder resolves to its newest complete version
        return self.spark.read.parquet(latest_version(self.spark, uri) or uri)

    def register_sources(self, names: Iterable[str] | None = None) -> tuple[list[str], list[str]]:
        """Create a temp view per source; a failing source is logged and the
        rest continue. Returns (registered, failed)."""
        names = list(names) if names is not None else (list(self.sources) or list(SOURCE_NAMES))
        ok, failed = [], []
        for name in names:
            try:
                self.read(name).createOrReplaceTempView(name)
                ok.append(name)
            except (AnalysisException, KeyError, OSError) as e:
                log.warning("could not register %s: %s", name, e)
                failed.append(name)
        return ok, failed
