"""Lake refresh: crosswalk, then the views.

Order: files are ingested first, the crosswalk is rebuilt from the facility
table, then every view is materialised.  The crosswalk joined to the facility
projection (the *facility-by-program* dimension) is written once, partitioned
by program; the 17 crosswalk views read only their program's partition from
it instead of re-joining the 134-column facility table 17 times.  Writing it
also cuts the lineage, so a lost executor never recomputes the facility join.
"""

from __future__ import annotations

import uuid
from collections import deque
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import wraps
from threading import Condition
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_identifier_py
from ..operators import crosswalk as X
from ..operators import joins as J
from ..operators import quality as Q
from ..sources.footers import memory_by_column
from ..sources.tables import STORED, Files, Lake
from .views import VIEWS, ViewSpec, build_view, derivable_from, facility_columns_used

FACILITY = "ECHO_EXPORTER"
CROSSWALK = "EXP_PGM"
DIMENSION = "_FACILITY_BY_PROGRAM"


def rebuild_crosswalk(lake: Lake) -> int:
    """X2 + K3/K4: one scan of the facility table, idempotent overwrite.
    Returns the number of crosswalk rows written."""
    xw = X.build_crosswalk(lake.read(FACILITY))
    with lake.replace(CROSSWALK) as new:
        return Q.observed_write(xw, lambda d: new.write(d, ["PGM"]))


def dimension_columns(specs=VIEWS) -> list[str]:
    return facility_columns_used([s for s in specs if s.shape == "crosswalk"])


def write_dimension(lake: Lake, specs=VIEWS, buckets: int | None = None, skip_empty_ids: bool = False) -> DataFrame:
    """The crosswalk joined to the facility projection, stored once,
    partitioned by program.

    With ``buckets``, it is also bucketed and sorted by the join key as a
    catalog table at the same location: a view whose dimension is too large
    to broadcast then shuffles only its fact (to the same bucket count), the
    dimension side of every such join needs neither exchange nor sort.  Use
    at least ``spark.sql.shuffle.partitions`` buckets.

    Either way it is replaced like any table: a failed write leaves the dimension
    before it readable.  ``skip_empty_ids`` leaves out the crosswalk's empty ids,
    which otherwise match every fact row whose id is empty.
    """
    cols = dimension_columns(specs)
    crosswalk = lake.read(CROSSWALK)
    if skip_empty_ids:
        crosswalk = crosswalk.where("PGM_ID <> ''")
    dim = J.program_dimension(crosswalk, lake.read(FACILITY), None, cols)
    if not buckets:
        lake.write(dim, DIMENSION, partition_by=["PGM"])
        return lake.read(DIMENSION)
    spark, before = lake.spark, lake.current(DIMENSION)
    with lake.replace(DIMENSION) as new:
        table = dimension_table(lake, new.path.rsplit("/", 1)[1])
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
        try:
            # one task per bucket, so a program has at most one file in each
            (dim.repartition(buckets, J.KEY).write.format(lake.fmt).options(**STORED).partitionBy("PGM")
             .bucketBy(buckets, J.KEY).sortBy(J.KEY).option("path", new.path).saveAsTable(table))
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            raise
    # catalog entries of versions that are gone; their files are the lake's business
    kept = {table, dimension_table(lake, before) if before else None}
    for row in spark.sql(f"SHOW TABLES IN {table.split('.')[0]}").where("NOT isTemporary").collect():
        if f"{table.split('.')[0]}.{row.tableName}" not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {table.split('.')[0]}.{row.tableName}")
    return spark.table(table)


def dimension_table(lake: Lake, version: str | None = None) -> str:
    """Catalog name of a version (default: the current) of a lake's bucketed dimension."""
    import hashlib
    version = version or lake.current(DIMENSION) or "none"
    return f"faclake_{hashlib.sha1(lake.root.encode()).hexdigest()[:10]}.facility_by_program_{version.replace('-', '_')}"


def dimension_sizes(lake: Lake) -> dict[str, dict[str, int]]:
    """Bytes in memory of each column of each program's partition of the stored
    dimension, from its files' footers (at most programs x columns numbers)."""
    return memory_by_column(lake.read(DIMENSION), "PGM")


def view_dimension_bytes(spec: ViewSpec, sizes: dict[str, dict[str, int]]) -> int | None:
    """Bytes in memory of what a crosswalk view reads of the dimension; None if the
    dimension has no such partition (its size is then unknown)."""
    own = sizes.get(spec.program)
    if own is None:
        return None
    return sum(own.get(c, 0) for c in [J.KEY, *(J.side_name("e", c) for c in facility_columns_used([spec]))])


def dimension_signatures(lake: Lake) -> dict[str, str]:
    """Content of each program's partition of the stored dimension, as counts and
    order-free sums of row hashes: equal rows give equal signatures."""
    dim = lake.read(DIMENSION)
    row = F.xxhash64(*sorted(c for c in dim.columns if c != "PGM"))
    again = F.xxhash64(F.lit("again"), *sorted(c for c in dim.columns if c != "PGM"))
    sums = dim.groupBy("PGM").agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("a"),
                                  F.sum(again.cast("decimal(38,0)")).alias("b")).collect()      # a row a program
    return {r.PGM: f"{r.n}:{r.a}:{r.b}" for r in sums}


def broadcast_limit(spark: SparkSession) -> int:
    """In-memory bytes a broadcast side may take: the session's broadcast
    threshold when set, else 32 MB."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "32MB")
    try:
        n = int(raw)
    except ValueError:
        units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
        n = int(float(raw[:-2]) * units[raw[-2].lower()]) if raw.lower().endswith("b") else 32 << 20
    return n if n > 0 else 32 << 20


def materialise_view(lake: Lake, spec: ViewSpec, shared_dim: DataFrame | None,
                     skew: str = "aqe", broadcast_max_bytes: int | None = None,
                     base: ViewSpec | None = None, dim_bytes: int | None = None) -> Q.RunRecord:
    """One view: build, replace the stored table, check it is not empty.

    With the shared dimension, what the view reads of its program's partition is
    measured (``dim_bytes``, as rows in memory): only when that is under the
    broadcast limit is it broadcast; otherwise the join stays a shuffle join whose
    skewed partitions AQE splits.
    """
    _use_pool(lake.spark, f"view-{spec.name}")
    try:
        if base is not None:
            # a filter of an already stored view (pushed down to its scan)
            col, val = spec.fact_filter
            df = lake.read(base.name).where(F.col(col) == F.lit(val))
        else:
            tables = {t: lake.read(t) for t in spec.tables
                      if not (t == CROSSWALK and shared_dim is not None)}
            small = False
            if shared_dim is not None and spec.shape == "crosswalk":
                limit = broadcast_max_bytes or broadcast_limit(lake.spark)
                # an unknown size is not a small one
                small = dim_bytes is not None and dim_bytes <= limit
            df = build_view(spec, tables, skew=skew, shared_dim=shared_dim, broadcast_dim=small)
        written = Q.observed_write(df, lambda d: lake.write(d, spec.name))
        status = "ok" if written > 0 else "empty"
        return Q.RunRecord(spec.name, lake.path(spec.name), status, written, written, None,
                           None if written else "view has no rows")
    except Exception as e:  # noqa: BLE001 -- a failure skips this view only
        return Q.RunRecord(spec.name, lake.path(spec.name), "failed",
                           message=f"{type(e).__name__}: {e}")


def _use_pool(spark: SparkSession, pool: str) -> None:
    """Run this thread's jobs in their own scheduler pool: with the FAIR
    scheduler, concurrent views then share the executors evenly (under FIFO
    the property is ignored)."""
    try:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    except Exception:  # noqa: BLE001 -- no SparkContext (remote session)
        pass


# A statement's shuffle files go when it ends, not when the driver's JVM next collects
# garbage: else those of all views of a refresh lie on the executors' disks together.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """``FREE_SHUFFLES`` for the statements of this block, then as it was."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def _frees_shuffles(run):
    @wraps(run)
    def freed(spark: SparkSession, *args, **options):
        with shuffles_freed(spark):
            return run(spark, *args, **options)
    return freed


class Room:
    """Stored bytes that the views at work may read together; a view of more runs alone,
    and none overtakes another that waits.

    Small views side by side keep the executors busy.  A large one does so by itself:
    others beside it would end no sooner, but the shuffle files of all of them would lie
    on the executors' disks at once."""

    def __init__(self, lake: Lake, most: int = 256 << 20):
        self.lake, self.most, self.left = lake, most, most
        self.queue, self.changed = deque(), Condition()

    def bytes(self, tables) -> int:
        try:
            return sum(self.lake.bytes(t) or 0 for t in tables)
        except Exception:  # noqa: BLE001 -- the view that reads them reports it
            return 0

    def place(self, tables) -> list[int]:
        """A place in the queue, to be taken by a view that is submitted next."""
        place = [min(self.bytes(tables), self.most)]
        self.queue.append(place)
        return place

    @contextmanager
    def taken(self, place: list[int]) -> Iterator[None]:
        with self.changed:
            self.changed.wait_for(lambda: self.queue[0] is place and self.left >= place[0])
            self.queue.popleft()
            self.left -= place[0]
            self.changed.notify_all()
        try:
            yield
        finally:
            with self.changed:
                self.left += place[0]
                self.changed.notify_all()


# Of the isolated session of a SQL view only: a view's SQL leaves it to Spark to drop, before
# their shuffle, the facts whose id its program does not list.  Spark's runtime bloom filter
# does that, by default for scans over 10 GB and creation sides under 10 MB.
_BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
SQL_VIEW_CONF = {
    FREE_SHUFFLES: "true",
    f"{_BLOOM}.enabled": "true",
    f"{_BLOOM}.applicationSideScanSizeThreshold": "10MB",
    f"{_BLOOM}.creationSideThreshold": "1GB",
    # 8 MB a filter, the largest that Spark makes: enough for tens of millions of ids
    f"{_BLOOM}.expectedNumItems": "16000000", f"{_BLOOM}.maxNumItems": "16000000",
    f"{_BLOOM}.numBits": "67108864",
}


def run_sql_view(spark: SparkSession, lake: Lake, name: str, statements: list[str],
                 tables: list[str]) -> Q.RunRecord:
    """M1 for views given as SQL text (``{statements, tables}``): tables are
    registered under SQL-safe names in an isolated session, statements that
    create temp views run as they are, any other statement's result replaces
    the stored view table."""
    session = spark.newSession()
    _use_pool(spark, f"view-{name}")
    try:
        for key, value in SQL_VIEW_CONF.items():
            session.conf.set(key, value)
        for t in tables:
            lake.reader(t, session).createOrReplaceTempView(clean_identifier_py(t))
        written = None
        for st in statements:
            if "CREATE OR REPLACE TEMP VIEW" in st.upper():
                session.sql(st)
            else:
                written = Q.observed_write(session.sql(st), lambda d: lake.write(d, name))
        status = "ok" if written else "empty"
        return Q.RunRecord(name, lake.path(name), status, written, written)
    except Exception as e:  # noqa: BLE001
        return Q.RunRecord(name, lake.path(name), "failed", message=f"{type(e).__name__}: {e}")


STATE = "_REFRESH_STATE"


def table_versions(lake: Lake) -> dict[str, str]:
    """Version stamp (``Lake.version``) of every stored table.  Internal tables
    (names starting with ``_``) are left out."""
    root = lake.path("x").rsplit("x", 1)[0].rstrip("/")
    names = [n for n in Files(lake.spark, root).names() if not n.startswith(("_", "."))]
    found = {t: lake.version(t) for t in sorted(names)}
    return {t: v for t, v in found.items() if v != "absent"}


def _signature(tables, versions) -> str:
    """Of the tables' versions; a missing table never equals a missing one."""
    return "|".join(f"{t}={versions.get(t) or f'absent-{uuid.uuid4().hex}'}" for t in sorted(set(tables)))


def _read_state(lake: Lake) -> dict[str, str]:
    if not lake.exists(STATE):
        return {}
    return {r.name: r.signature for r in lake.read(STATE).collect()}   # one row per view


def _write_state(lake: Lake, state: dict[str, str]) -> None:
    rows = sorted(state.items())
    lake.write(lake.spark.createDataFrame(rows, "name string, signature string").coalesce(1), STATE)


def load_view_definitions(path: str) -> dict:
    """View definitions as SQL text: ``{name: {statements: [...], tables: [...]}}``.
    A small configuration file, read on the driver."""
    import json
    with open(path) as f:
        return json.load(f)


def refresh_sql_views(spark: SparkSession, lake: Lake, definitions: dict,
                      parallel: int = 4) -> DataFrame:
    """M1 for SQL-text definitions: each view in its own session, concurrently as far as
    there is ``Room``; the largest begin, while the fewest results are stored."""
    room = Room(lake)

    def run(name: str, place: list[int]) -> Q.RunRecord:
        with room.taken(place):
            return run_sql_view(spark, lake, name, definitions[name]["statements"], definitions[name]["tables"])
    order = sorted(definitions, key=lambda n: room.bytes(definitions[n]["tables"]), reverse=True)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {name: pool.submit(run, name, room.place(definitions[name]["tables"])) for name in order}
        records = [futures[name].result() for name in definitions]
    return Q.report(spark, records)


@_frees_shuffles
def refresh_views(spark: SparkSession, lake: Lake, specs=VIEWS, parallel: int = 4,
                  skew: str = "aqe", share_dimension: bool = True,
                  rebuild: bool = True, broadcast_max_bytes: int | None = None,
                  reuse_views: bool = True, dimension_buckets: int | None = None,
                  only_changed: bool = False, skip_empty_ids: bool = False) -> DataFrame:
    """M1: crosswalk (optional), shared dimension, then all views; the views
    are independent and run concurrently as far as there is ``Room``.  Returns the report.

    ``broadcast_max_bytes`` raises (or lowers) the in-memory size up to which
    a measured dimension is broadcast for this refresh only: star joins with a
    dimension of a few hundred MB are cheaper broadcast than shuffling a
    multi-terabyte fact, if the executors can hold it.  With ``reuse_views``,
    a view that is a filter of another (same join, same columns) is read from
    the stored base view instead of being joined again.  ``dimension_buckets``
    stores the shared dimension bucketed by the join key (see
    ``write_dimension``).

    With ``only_changed``, the crosswalk, the dimension and each view are
    rebuilt only when their inputs changed since the last refresh (kept in a small
    state table); the others are reported ``unchanged``.  Inputs are the versions of
    the tables, from one file listing of the lake; for a view over the shared
    dimension, the content of its program's partition instead of the facility and
    crosswalk tables, so a change in one program's facilities rebuilds that program's
    views only.  ``skip_empty_ids``: see ``write_dimension``.
    """
    records: list[Q.RunRecord] = []
    state = _read_state(lake) if only_changed else {}
    versions = table_versions(lake) if only_changed else {}
    if rebuild:
        sig = _signature([FACILITY], versions)
        if only_changed and state.get(CROSSWALK) == sig and lake.exists(CROSSWALK):
            records.append(Q.RunRecord(CROSSWALK, lake.path(CROSSWALK), "unchanged"))
        else:
            n = rebuild_crosswalk(lake)
            records.append(Q.RunRecord(CROSSWALK, lake.path(CROSSWALK), "ok" if n else "empty", n, n))
            state[CROSSWALK] = sig
            if only_changed:
                versions = table_versions(lake)
    specs = list(specs)
    all_specs = list(specs)
    with_dimension = share_dimension and any(s.shape == "crosswalk" for s in specs)

    def dimension() -> DataFrame | None:
        """The shared dimension, rewritten if its inputs changed."""
        sig = (_signature([CROSSWALK, FACILITY], versions) + "|cols=" + ",".join(dimension_columns(all_specs))
               + ("|no empty ids" if skip_empty_ids else ""))
        try:
            if only_changed and state.get(DIMENSION) == sig and lake.exists(DIMENSION) and not dimension_buckets:
                return lake.read(DIMENSION)
            out = write_dimension(lake, all_specs, dimension_buckets, skip_empty_ids)
            state[DIMENSION] = sig
            return out
        except Exception:  # noqa: BLE001 -- each view then joins on its own and reports
            return None

    shared, programs = None, {}
    if only_changed and with_dimension:
        shared = dimension()                 # before the views: its content says which of them changed
        programs = dimension_signatures(lake) if shared is not None else {}

    def signature(s: ViewSpec) -> str:
        if s.shape == "crosswalk" and shared is not None:
            own = [t for t in s.tables if t not in (CROSSWALK, FACILITY)]
            return f"{_signature(own, versions)}|{s.program}={programs.get(s.program, 'none')}|{dimension_columns([s])}"
        return _signature(s.tables, versions)

    unchanged = []
    if only_changed:
        unchanged = [s for s in specs if state.get(s.name) == signature(s) and lake.exists(s.name)]
        records += [Q.RunRecord(s.name, lake.path(s.name), "unchanged") for s in unchanged]
        specs = [s for s in specs if s not in unchanged]
    derived = {}
    if reuse_views:
        for s in specs:
            base = next((b for b in specs if derivable_from(s, b)), None)
            if base is not None:
                derived[s.name] = base
    first = [s for s in specs if s.name not in derived]
    room = Room(lake)

    def materialise(s: ViewSpec, place: list[int], *args) -> Q.RunRecord:
        with room.taken(place):
            return materialise_view(lake, s, *args)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        # views that do not read the shared dimension start right away, while
        # the dimension is being written
        futures = {s.name: pool.submit(materialise, s, room.place(s.tables), None, skew, broadcast_max_bytes)
                   for s in first if s.shape != "crosswalk"}
        crosswalk_views = [s for s in first if s.shape == "crosswalk"]
        if share_dimension and crosswalk_views and shared is None and not only_changed:
            shared = dimension()
        sizes = dimension_sizes(lake) if shared is not None and crosswalk_views and not dimension_buckets else {}
        futures.update({s.name: pool.submit(materialise, s, room.place(s.tables), shared, skew, broadcast_max_bytes,
                                            None, view_dimension_bytes(s, sizes)) for s in crosswalk_views})
        done = {name: f.result() for name, f in futures.items()}

        def second(s):
            if done[derived[s.name].name].status != "ok":   # base failed or empty: join directly
                return materialise_view(lake, s, shared, skew, broadcast_max_bytes, None, view_dimension_bytes(s, sizes))
            return materialise_view(lake, s, shared, skew, broadcast_max_bytes, base=derived[s.name])
        done.update({r.name: r for r in pool.map(second, [s for s in specs if s.name in derived])})
    records += [done[s.name] for s in specs]
    if only_changed:
        for s in specs:
            if done[s.name].status in ("ok", "empty"):
                state[s.name] = signature(s)
            else:
                state.pop(s.name, None)
        _write_state(lake, state)
    return Q.report(spark, records)
