"""Guarded SQL access to lake tables.

``run_query`` opens one table, optionally limits it *before* the user's SQL,
keeps the hot facility table cached, registers it under a SQL-safe name in
an isolated session and runs the guarded SQL.  Results can be reused from a
result store keyed by the table's version, and every query is logged.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import threading
import uuid
from collections import OrderedDict
from contextlib import contextmanager

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_identifier_py
from ..sources.footers import memory_bytes
from ..sources.parts import PART, PartTable
from ..sources.tables import ConcurrentReplace, Files, Lake, TableNotFound, first_rows  # noqa: F401  (re-exported)

HOT_TABLES = ("ECHO_EXPORTER",)
LOG_DDL = ("id string, ip_address string, timestamp timestamp, table_name string, "
           "query string, path string, result_key string")


class Forbidden(PermissionError):
    pass


def strip_final_semicolon(sql: str) -> str:
    """``sql`` without a ``;`` that only blanks, comments and further ``;`` follow.
    One pass: strings, quoted names and comments are stepped over."""
    i, n, cut = 0, len(sql), None
    while i < n:
        c = sql[i]
        if sql.startswith("--", i):
            end = sql.find("\n", i)
            i = n if end < 0 else end
            continue
        if sql.startswith("/*", i):
            end = sql.find("*/", i + 2)
            i = n if end < 0 else end + 2
            continue
        if c in "'\"`":
            i, cut = _after_quoted(sql, i), None
            continue
        if c == ";":
            cut = i if cut is None else cut
        elif not c.isspace():
            cut = None
        i += 1
    return sql if cut is None else sql[:cut]


def _after_quoted(sql: str, start: int) -> int:
    quote, i = sql[start], start + 1
    while i < len(sql):
        if sql[i] == "\\" and quote != "`":
            i += 2
            continue
        if sql[i] == quote:
            return i + 1
        i += 1
    return i


# What a query may be made of besides the registered view.
LEAVES = ("OneRowRelation", "UnresolvedInlineTable", "LocalRelation", "Range")
TABLE_FUNCTIONS = ("range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack")
REFUSED_FUNCTIONS = ("reflect", "java_method", "try_reflect")


_BUILTIN: set[str] = set()


def builtin_functions(spark: SparkSession) -> set[str]:
    """Names of the functions that come with Spark: those that a session, a catalogue
    or a qualified name adds are not among them."""
    if not _BUILTIN:
        found = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.functionSet()
        _BUILTIN.update(found.mkString("\n").lower().split("\n"))
    return _BUILTIN


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _check_plan(spark: SparkSession, plan, views: set[str]) -> None:
    """Walk the parsed, unresolved plan: nothing in it has been looked up or run."""
    forname = spark._jvm.java.lang.Class.forName
    holds_plan = forname("org.apache.spark.sql.catalyst.expressions.PlanExpression")
    todo = [("plan", plan, views)]
    while todo:
        kind, node, known = todo.pop()
        name = node.getClass().getSimpleName()
        if kind == "expression":
            if name == "UnresolvedFunction":
                function = ".".join(_items(node.nameParts())).lower()
                if function in REFUSED_FUNCTIONS or function not in builtin_functions(spark):
                    raise Forbidden(f"function {function} is not allowed")
            if "UnresolvedIdentifier" in name:
                raise Forbidden("IDENTIFIER() is not allowed")
            if holds_plan.isInstance(node):
                todo.append(("plan", node.plan(), known))
            todo += [("expression", e, known) for e in _items(node.children())]
            continue
        if name == "UnresolvedWith":
            # a table expression may name those before it, and itself
            own = set(known)
            for pair in _items(node.cteRelations()):
                own = own | {pair.productElement(0).lower()}
                todo.append(("plan", pair.productElement(1), own))
            known = own
        if "UnresolvedIdentifier" in name or "Transformation" in name or "Command" in name:
            raise Forbidden(f"{name} is not allowed")
        if name == "UnresolvedRelation":
            parts = _items(node.multipartIdentifier())
            if len(parts) != 1 or parts[0].lower() not in known:
                raise Forbidden(f"only the opened table can be read, not {'.'.join(parts)}")
        elif name == "UnresolvedTableValuedFunction":
            function = ".".join(_items(node.name())).lower()
            if function not in TABLE_FUNCTIONS:
                raise Forbidden(f"table function {function} is not allowed")
        elif not node.children().size() and name != "UnresolvedWith" and name not in LEAVES:
            raise Forbidden(f"{name} is not allowed")
        todo += [("expression", e, known) for e in _items(node.expressions())]
        todo += [("plan", p, known) for p in _items(node.children())]


def guard_select(sql: str | None, spark: SparkSession | None = None, views=()) -> str:
    """Accept one read-only query over the registered ``views`` only.

    The text is wrapped as a subquery, so that anything but a single query fails
    to parse (the line breaks keep a trailing ``--`` comment inside), and the
    parsed plan is checked before anything in it is resolved: its leaves are the
    given views, table expressions of the query itself, literals or harmless
    table functions, and its functions are Spark's own.  Paths, other tables, script
    transforms, functions of catalogues and calls into Java raise ``Forbidden``.
    """
    if not sql or not sql.strip():
        raise Forbidden("only SELECT queries are allowed")
    wrapped = f"SELECT * FROM (\n{strip_final_semicolon(sql)}\n)"
    spark = spark or SparkSession.getActiveSession()
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(wrapped)
    except ParseException as e:
        raise Forbidden("only a single SELECT query is allowed") from e
    _check_plan(spark, plan, {v.lower() for v in views})
    return wrapped


def open_table(session: SparkSession, lake: Lake, table: str, limit: int | None = None,
               hot_tables=HOT_TABLES) -> DataFrame:
    """The base table read in ``session``, limited first, and kept in
    memory when it is a hot table (the cache is shared by all sessions of the
    application, so every request after the first reads it from memory)."""
    df = lake.reader(table, session)
    if limit:
        return first_rows(df, int(limit))
    if table in hot_tables:
        return _HOT.get(lake, table, df)
    return df


class HotTables:
    """Q4: hot tables kept in memory, one version each, up to ``max_bytes`` together.

    A table's size is that of its rows in memory, measured from its files' footers.
    One that is over the bound alone is not kept: its queries scan it.  Otherwise
    the tables used longest ago make room.  The version is asked on every use; a new
    one releases the table held before."""

    def __init__(self, max_bytes: int | None = None):
        self.max_bytes = max_bytes
        self._held: OrderedDict[tuple, tuple[str, DataFrame, int]] = OrderedDict()     # last used last
        self._sizes: dict[tuple, tuple[str, int | None]] = {}
        self._lock = threading.Lock()

    def bound(self, spark: SparkSession) -> int:
        """``max_bytes``, by default the session's ``faclake.hotTables.maxBytes``, else a
        quarter of one executor's heap: that holds on any number of executors."""
        if self.max_bytes is not None:
            return self.max_bytes
        own = spark.conf.get("faclake.hotTables.maxBytes", None)
        if own:
            return int(own)
        heap = spark.sparkContext.getConf().get("spark.executor.memory", "")
        if heap and not spark.sparkContext.master.startswith("local["):
            return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(heap)) // 4
        return int(spark._jvm.java.lang.Runtime.getRuntime().maxMemory()) // 4

    def get(self, lake: Lake, table: str, df: DataFrame) -> DataFrame:
        key, version = (lake.spark.sparkContext.applicationId, lake.path(table)), lake.version(table)
        with self._lock:
            held = self._held.get(key)
            if held and held[0] == version:
                self._held.move_to_end(key)
                return df                       # the same plan: it reads the rows in memory
            known = self._sizes.get(key)
        size = known[1] if known and known[0] == version else memory_bytes(df)
        with self._lock:
            self._sizes[key] = (version, size)
            held = self._held.pop(key, None)
            if held:
                held[1].unpersist()
            bound = self.bound(lake.spark)
            if size is None or size > bound:
                return df
            while sum(n for _, _, n in self._held.values()) + size > bound:
                _, (_, oldest, _) = self._held.popitem(last=False)
                oldest.unpersist()
            self._held[key] = (version, df.cache(), size)
            return df

    def held(self) -> list[str]:
        """Paths of the tables in memory, the one used longest ago first."""
        with self._lock:
            return [path for _, path in self._held]

    def release(self) -> None:
        """Drop all tables held."""
        with self._lock:
            for _, df, _ in self._held.values():
                df.unpersist()
            self._held.clear()
            self._sizes.clear()


_HOT = HotTables()
release_hot_tables = _HOT.release


def run_query(spark: SparkSession, lake: Lake, table: str, sql: str,
              limit: int | None = None, hot_tables=HOT_TABLES) -> DataFrame:
    """Q1: run a guarded SELECT over one table.

    The table is registered in a fresh session (temp views are per session),
    so concurrent requests never see each other's views.  Its name has ``-``
    replaced by ``_`` so every table can be addressed.
    """
    alias = clean_identifier_py(table)
    session = spark.newSession()
    wrapped = guard_select(sql, session, [alias])
    open_table(session, lake, table, limit, hot_tables).createOrReplaceTempView(alias)
    return session.sql(wrapped)


# ------------------------------------------------------------------ Q2

def result_key(table: str, limit: int | None, sql: str, version: str) -> str:
    """Q2: the reuse key covers table, limit, SQL text and table version, so a
    refresh or another table never answers with a stale result."""
    raw = "\x1f".join([table, str(limit or ""), sql, version])
    return hashlib.sha256(raw.encode()).hexdigest()


class ResultStore:
    """Saved query results (parquet) under a shared folder, keyed by hash.  A result
    can be read when it is finished: it is published like a table (``Lake.replace``),
    so a failed or running computation is no hit.  Equal requests of one driver wait
    for the one that computes; of several drivers, the first to publish is kept."""

    _locks: dict[str, threading.Lock] = {}
    _guard = threading.Lock()

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.lake = Lake(spark, self.root, layout="{root}/{name}")

    def path(self, key: str) -> str:
        return self.lake.path(key)

    def get(self, key: str) -> DataFrame | None:
        return self.lake.read(key) if self.lake.current(key) else None

    def put(self, key: str, df: DataFrame) -> DataFrame:
        try:
            with self.lake.replace(key) as new:
                new.write(df)
        except ConcurrentReplace:            # another driver's result of the same request
            pass
        return self.lake.read(key)

    @contextmanager
    def computing(self, key: str):
        """One thread of this driver at a time for a key."""
        with self._guard:
            lock = self._locks.setdefault(self.path(key), threading.Lock())
        with lock:
            yield
        with self._guard:
            if not lock.locked():
                self._locks.pop(self.path(key), None)


class QueryLog:
    """Q3: the query log.  An append puts one small file into ``inbox``; it takes no
    Spark job and waits for nobody.  ``compact`` moves the inbox into a file a day:
    its commit names the day files and the inbox files that they cover, so at every
    moment a row is read from exactly one place.  Covered files are removed by the
    next compaction, when readers that listed them have ended.  The folder therefore
    holds at most the days, and the inbox files of two compactions.
    """

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 200):
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every
        self.days = PartTable(spark, f"{self.path}/days")
        self.inbox = Files(spark, f"{self.path}/inbox")

    def append(self, row: dict) -> None:
        at = row["timestamp"]
        line = json.dumps({**row, "timestamp": at.isoformat(timespec="microseconds")})
        name = f"{at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}.json"
        self.inbox.put(f".{name}", line)                   # listed only when it is whole
        self.inbox.rename(f".{name}", name)
        if self.compact_every and len(self._waiting(self.days.state())) >= self.compact_every:
            try:
                self.compact()
            except ConcurrentReplace:                      # another request is at it
                pass

    def _waiting(self, state: dict, listed: list[str] | None = None) -> list[str]:
        covered = set(state.get("extra", {}).get("covered", []))
        listed = self.inbox.names() if listed is None else listed
        return sorted(n for n in listed if n.endswith(".json") and not n.startswith(".") and n not in covered)

    def _rows(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], LOG_DDL)
        return self.spark.read.schema(LOG_DDL).json([f"{self.path}/inbox/{n}" for n in names])

    def read(self) -> DataFrame:
        """All rows.  The inbox is listed before the commit is read: a compaction in
        between makes its files covered, not missing."""
        listed = self.inbox.names()
        state = self.days.state()
        old, new = self.days.rows(state), self._rows(self._waiting(state, listed))
        return new if old is None else old.unionByName(new)

    def compact(self) -> int:
        """Move the inbox into the day files; returns the number of requests moved."""
        with self.days.change() as change:
            covered = change.extra.get("covered", [])
            waiting = self._waiting(change.base[1])
            new = self._rows(waiting).withColumn(PART, F.date_format("timestamp", "yyyy-MM-dd"))
            days = sorted({f"{n[:4]}-{n[4:6]}-{n[6:8]}" for n in waiting})
            if days:
                old = change.read(days)
                if old is not None:
                    new = old.withColumn(PART, F.date_format("timestamp", "yyyy-MM-dd")).unionByName(new)
                change.put(new.repartition(len(days), PART), days)
            change.extra["covered"] = waiting
        for name in covered:
            self.inbox.delete(name)
        return len(waiting)


def log_query(spark: SparkSession, log_path: str, table: str, sql: str, path: str | None,
              ip: str | None = None, key: str | None = None, compact_every: int = 200) -> None:
    """Q3: append one request to the query log."""
    QueryLog(spark, log_path, compact_every).append({
        "id": str(uuid.uuid4()), "ip_address": ip, "timestamp": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
        "table_name": table, "query": sql, "path": path, "result_key": key})


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return QueryLog(spark, log_path).read()


def cached_query(spark: SparkSession, lake: Lake, store: ResultStore, log_path: str,
                 table: str, sql: str, limit: int | None = None, ip: str | None = None):
    """Q1+Q2+Q3: answer from the store when the same (table, limit, SQL,
    version) ran before, else run, save, log.  Returns (DataFrame, hit)."""
    guard_select(sql, spark, [clean_identifier_py(table)])
    key = result_key(table, limit, sql, lake.version(table))
    with store.computing(key):
        hit = store.get(key)
        if hit is not None:
            return hit, True
        out = store.put(key, run_query(spark, lake, table, sql, limit))
    log_query(spark, log_path, table, sql, store.path(key), ip, key)
    return out, False


# ------------------------------------------------------------------ K7

def to_json_lines(df: DataFrame) -> DataFrame:
    """one JSON text per row (NULL fields omitted)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def export_json(df: DataFrame, path: str) -> None:
    """K7: distributed JSON-lines export; no rows pass through the driver."""
    df.write.mode("overwrite").json(path)
