"""Tables that are replaced part by part (K9, Q3).

A part is a group of rows that are always rewritten together: a hash bucket of keys,
a day.  The table's commit (see ``tables.Commits``) names a folder for each part, so a
change writes the parts it touches and its commit takes over the folders of all
others: their files stay as they are, whatever the size of the table.  Publishing is
the same compare-and-swap as for whole tables.
"""

from __future__ import annotations

import json
from contextlib import contextmanager
from typing import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import Commits, Files, fresh_version

PART = "part__"


class Change:
    """What a change has made of the table's parts so far."""

    def __init__(self, table: "PartTable", base: tuple[int, dict]):
        self.table, self.base = table, base
        self.parts, self.schema = dict(base[1].get("parts", {})), base[1].get("schema")
        self.extra: dict = dict(base[1].get("extra", {}))
        self.version = fresh_version(base[0])

    def read(self, parts: Iterable[str] | None = None) -> DataFrame | None:
        """The rows of the given parts (default: all) before the change."""
        return self.table.rows(self.base[1], parts)

    def put(self, rows: DataFrame, touched: Iterable[str]) -> None:
        """``rows`` (with the column ``PART``) become the parts ``touched``; a touched
        part without rows goes."""
        rows.write.partitionBy(PART).parquet(f"{self.table.path}/{self.version}")
        made = {n.split("=", 1)[1] for n in Files.below(self.table.files, self.version).names() if n.startswith(f"{PART}=")}
        for part in [*map(str, touched)]:
            self.parts.pop(part, None)
        self.parts.update({p: f"{self.version}/{PART}={p}" for p in made})
        self.schema = StructType([f for f in rows.schema.fields if f.name != PART]).json()


class PartTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)
        self.commits = Commits(self.files)

    def state(self) -> dict:
        return self.commits.head()[1]

    def rows(self, state: dict, parts: Iterable[str] | None = None) -> DataFrame | None:
        """Rows of the parts under the table's last schema: columns that a part was
        written without are NULL."""
        if not state.get("schema"):
            return None
        wanted = [f for p, f in sorted(state["parts"].items()) if parts is None or p in set(map(str, parts))]
        schema = StructType.fromJson(json.loads(state["schema"]))
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in wanted])

    def read(self) -> DataFrame | None:
        """The table's rows; None if nothing was ever published."""
        return self.rows(self.state())

    @contextmanager
    def change(self) -> Iterator[Change]:
        """A change of some parts.  It is published when the block ends; if the block
        raises, or another change was published meanwhile (``ConcurrentReplace``), what
        it wrote is removed."""
        base = self.commits.head()
        change = Change(self, base)
        try:
            yield change
            state = {"parts": change.parts, "schema": change.schema, "extra": change.extra}
            self.commits.publish(base, state)
        except BaseException:
            self.files.delete(change.version)
            raise
        self.commits.clean(base, state)


def hash_part(key: str, buckets: int):
    """The part of a key: its hash bucket."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int").alias(PART)
