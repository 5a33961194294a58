"""A small table, such as a status ledger, whose every change is a new version that only one writer can make.

The rows of a version lie in a folder of their own; version n exists once its file ``versions/n`` does, and that file is
created only if it does not exist yet. Of two runs that change the same version one succeeds; the other reads the new
version, applies its change to that, and tries again. A run that is lost leaves the last version whole.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeshift.sources import storage

#: Tries to commit, and seconds between them, as drawn.
TRIES, PAUSES = 6, (0.2, 0.5, 1.0, 2.0)


class Conflict(Exception):
    """Another writer has committed the version first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _file(self, version: int) -> str:
        return f"{self.path}/versions/{version:010d}"

    def version(self) -> int:
        """The last version; 0 before the first."""
        return max((int(n) for n in storage.names(self.spark, f"{self.path}/versions") if n.isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, by default the last; before the first there are none."""
        version = self.version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        folder = storage.read_text(self.spark, self._file(version)).strip()
        if not folder:
            raise Conflict(f"version {version} of {self.path} is still being committed")
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows/{folder}")

    def commit(self, rows: DataFrame, after: int) -> int:
        """Make ``rows`` the version that follows ``after``; :class:`Conflict` when there is one already."""
        folder = uuid.uuid4().hex
        shaped = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields])
        shaped.write.parquet(f"{self.path}/rows/{folder}")
        if not storage.create_new(self.spark, self._file(after + 1), folder):
            storage.delete(self.spark, f"{self.path}/rows/{folder}")
            raise Conflict(f"version {after + 1} of {self.path} was committed by another writer")
        return after + 1

    def update(self, change: Callable[[DataFrame], DataFrame], tries: int = TRIES) -> int:
        """Commit ``change`` of the last version; after a conflict it is applied to the version that won."""
        for turn in range(tries):
            try:
                version = self.version()
                return self.commit(change(self.read(version)), version)
            except Conflict:
                if turn + 1 == tries:
                    raise
                time.sleep(random.choice(PAUSES))
        raise ValueError("tries must be positive")
