"""Warehouse catalog: namespaces and tables registered in the Spark session.

Every table of a warehouse root is registered as an external Parquet table
``<namespace>.<table>`` pointing at its current version, so user SQL names
are resolved by Spark's analyzer.  A second root (the remote layer) can be
laid over the first: a remote table hides the local table of the same name,
and local tables without a remote twin stay visible.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.catalog.listing import folder_tables, listing, root_tables
from gleaner.sinks.partitioned import PART, PartitionedTable, partitioned_tables
from gleaner.sinks.table import (VersionedTable, _FS, bucketed_table_ddl, bucketing_at, catalog_db,
                                 list_tables)

MAX_ROWS = 500
_OWN = "gleaner.table"  # property of the catalog tables made here
_PARTS_DB = "gleaner_parts"

# Fixed value: first words of statements that change data or schema.
WRITE_WORDS = ("copy", "create", "insert", "drop", "delete", "update", "alter")
_WRITE = r"(?i)^\s*(" + "|".join(WRITE_WORDS) + r")\b"

_COPY = re.compile(r"^\s*copy\s*\((?P<q>.*)\)\s*to\s*'(?P<path>[^']+)'\s*(\((?P<opts>[^)]*)\))?\s*;?\s*$",
                   re.IGNORECASE | re.DOTALL)
_CTAS = re.compile(r"^\s*create\s+(or\s+replace\s+)?table\s+(?P<ns>\w+)\.(?P<t>\w+)\s+as\s+(?P<q>.*?);?\s*$",
                   re.IGNORECASE | re.DOTALL)
# In the text of a parsed plan: the relations it names, and nodes that change something.
_RELATION = re.compile(r"'UnresolvedRelation \[([^\]]*)\]")
_CHANGE = re.compile(r"^[\s:+\-|]*'?(Insert|Delete|Update|Merge|Drop|Truncate|Alter|Add|Rename|Replace|Create|Set|Unset|Load"
                     r"|Repair|Recover)\w*", re.MULTILINE)


def is_write_statement(sql: str) -> bool:
    return re.match(_WRITE, sql) is not None


def classify_statements(df: DataFrame, col: str = "sql") -> DataFrame:
    """Adds ``is_write``: the first word of each statement is a write word."""
    return df.withColumn("is_write", F.col(col).rlike(_WRITE))


@dataclass
class _Entry:
    namespace: str
    table: str
    location: str
    layer: str  # "local" | "remote"
    parts: bool = False  # one folder of partitions, not a version of its own


class Warehouse:
    def __init__(self, spark: SparkSession, root: str | None = None, remote_root: str | None = None,
                 flat: dict[str, str] | None = None, cap: int = MAX_ROWS):
        """``root``/``remote_root``: versioned warehouse roots (lower/upper layer).
        ``flat``: namespace -> folder whose ``<table>.parquet`` files are tables
        of that namespace (read-only lower layer)."""
        self.spark = spark
        self.root = root
        self.remote_root = remote_root
        self.flat = flat or {}
        self.cap = cap

    # Table name -> registered location, per session: the session catalog is
    # shared by every Warehouse object of that session.
    _SESSION_TABLES: dict[int, dict[str, str]] = {}

    @property
    def _registered(self) -> dict[str, str]:
        return Warehouse._SESSION_TABLES.setdefault(id(self.spark), {})

    # ---- discovery -------------------------------------------------------
    def _flat_entries(self) -> list[_Entry]:
        out = []
        for ns, folder in self.flat.items():
            fs = _FS(self.spark, folder)
            for name in sorted(fs.names(folder)):
                if name.endswith(".parquet"):
                    out.append(_Entry(ns, name[: -len(".parquet")], f"{folder.rstrip('/')}/{name}", "local"))
        return out

    def entries(self) -> list[_Entry]:
        """Visible tables after the overlay: remote first, local as fallback."""
        seen: dict[tuple[str, str], _Entry] = {}
        for e in self._flat_entries():
            seen[(e.namespace, e.table)] = e
        for root, layer in ((self.root, "local"), (self.remote_root, "remote")):
            if root is None:
                continue
            for t in list_tables(self.spark, root):
                seen[(t.namespace, t.name)] = _Entry(t.namespace, t.name, t.location(), layer)
            for t in partitioned_tables(self.spark, root):
                seen[(t.namespace, t.name)] = _Entry(t.namespace, t.name, t.location(), layer, parts=True)
        return [seen[k] for k in sorted(seen)]

    def versioned(self, namespace: str, table: str, remote: bool = False) -> VersionedTable:
        root = self.remote_root if remote else self.root
        if root is None:
            raise ValueError("this warehouse has no writable root")
        return VersionedTable(self.spark, root, namespace, table)

    # ---- session catalog ---------------------------------------------------
    def ensure_namespace(self, namespace: str) -> None:
        """The namespace as a session-catalog database; its folder is below the
        shared folder (tables are external, so it only holds catalog entries)."""
        catalog_db(self.spark, namespace)

    def drop_namespace(self, namespace: str) -> None:
        """Drops the namespace with its tables, from the catalog and the root.
        Catalog tables that others made stay, and then the database does."""
        if self.spark.catalog.databaseExists(namespace):
            names = [f"`{namespace}`.`{r.tableName}`" for r in
                     self.spark.sql(f"SHOW TABLES IN `{namespace}`").collect() if not r.isTemporary]
            own = [n for n in names if self._owns(n)]
            for n in own:
                self._drop(n)
            if len(own) == len(names):
                self.spark.sql(f"DROP DATABASE `{namespace}`")
        for k in [k for k in self._registered if k.startswith(namespace + ".")]:
            del self._registered[k]
        for root in (self.root, self.remote_root):
            if root is not None:
                _FS(self.spark, root).delete(f"{root.rstrip('/')}/{namespace}")

    def _owns(self, name: str) -> bool:
        """Whether a catalog table carries this library's mark."""
        return any(r["key"] == _OWN for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect())

    def find(self, namespace: str, table: str) -> _Entry | None:
        """The visible table of that name: the remote one, else the local one.
        Looks only at this name, however many tables the roots hold."""
        for root, layer in ((self.remote_root, "remote"), (self.root, "local")):
            if root is None:
                continue
            versions = VersionedTable(self.spark, root, namespace, table)
            if versions.exists():
                return _Entry(namespace, table, versions.location(), layer)
            parts = PartitionedTable(self.spark, root, namespace, table)
            if parts.exists():
                return _Entry(namespace, table, parts.location(), layer, parts=True)
        folder = self.flat.get(namespace)
        path = f"{folder.rstrip('/')}/{table}.parquet" if folder else None
        if path and _FS(self.spark, folder).exists(path):
            return _Entry(namespace, table, path, "local")
        return None

    def register(self) -> list[_Entry]:
        """(Re)register every visible table at its current location."""
        entries = self.entries()
        for e in entries:
            self._register(e)
        return entries

    def _register(self, e: _Entry) -> None:
        name = f"`{e.namespace}`.`{e.table}`"
        there = self.spark.catalog.tableExists(name)
        if there and not e.parts and self._registered.get(f"{e.namespace}.{e.table}") == e.location:
            return
        self.ensure_namespace(e.namespace)
        if there:
            if not self._owns(name):
                raise ValueError(f"catalog table {name} was made by others; it is neither used nor dropped")
            self._drop(name)
        b = None if e.parts else bucketing_at(self.spark, e.location)
        if e.parts:  # made anew each time: columns may have been added
            self._partitioned_view(name, e.location)
        elif b is not None:  # declared, so joins and aggregates on the key skip the shuffle
            self.spark.sql(bucketed_table_ddl(self.spark, name, e.location, b))
        else:
            self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{e.location}'")
        kind = "VIEW" if e.parts else "TABLE"
        self.spark.sql(f"ALTER {kind} {name} SET TBLPROPERTIES ('{_OWN}' = 'true')")
        self._registered[f"{e.namespace}.{e.table}"] = e.location

    def _partitioned_view(self, name: str, location: str) -> None:
        """A table over the folder, and the view without the partition column
        that users see; filters and column choice pass through it to the scan."""
        base = f"`{catalog_db(self.spark, _PARTS_DB)}`.`t_{hashlib.sha256(location.encode()).hexdigest()[:24]}`"
        self.spark.sql(f"DROP TABLE IF EXISTS {base}")
        self.spark.sql(f"CREATE TABLE {base} USING parquet OPTIONS (mergeSchema 'true') LOCATION '{location}'")
        self.spark.sql(f"ALTER TABLE {base} RECOVER PARTITIONS")
        columns = ", ".join("`" + c.replace("`", "``") + "`" for c in self.spark.table(base).columns if c != PART)
        self.spark.sql(f"CREATE VIEW {name} AS SELECT {columns} FROM {base}")

    def _drop(self, name: str) -> None:
        kind = "VIEW" if self.spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        self.spark.sql(f"DROP {kind} IF EXISTS {name}")

    def table(self, full_name: str) -> DataFrame:
        self._register_named(f"SELECT * FROM {full_name}")
        return self.spark.table(full_name)

    # ---- names in a statement ----------------------------------------------
    def _parsed(self, sql: str) -> str:
        """The plan as parsed, as text: no name is resolved, nothing is run."""
        return self.spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()

    def _register_named(self, sql: str) -> str:
        """Register the warehouse tables that a statement names, and no others:
        a table that cannot be read, or a name that others took in the catalog,
        only stands in the way of statements that use it."""
        plan = self._parsed(sql)
        for name in sorted(set(_RELATION.findall(plan))):
            parts = [p.strip() for p in name.split(",")]
            if len(parts) == 2 and (e := self.find(*parts)) is not None:
                self._register(e)
        return plan

    # ---- listing -----------------------------------------------------------
    def list_tables(self) -> DataFrame:
        """namespace, table, full_name, row_count, columns, location, layer, error.

        A table that cannot be read is listed with row_count -1 and the error.
        Made by Spark jobs over files and footers; the driver lists nothing."""
        sources = [folder_tables(self.spark, ns, folder) for ns, folder in self.flat.items()]
        sources += [root_tables(self.spark, root, layer, rank) for rank, (root, layer) in
                    enumerate(((self.root, "local"), (self.remote_root, "remote")), 1) if root is not None]
        return listing(self.spark, sources)

    def describe(self, full_name: str) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in self.table(full_name).schema.fields]

    # ---- SQL front -----------------------------------------------------------
    def _root_is_limit(self, sql: str) -> bool:
        """Whether the analyzed plan of ``sql`` ends in a LIMIT (below WITH, if any)."""
        text = self.spark.sql("EXPLAIN EXTENDED " + sql).first()[0]
        lines = text.split("== Analyzed Logical Plan ==", 1)[1].split("== Optimized", 1)[0].strip().splitlines()
        nodes = lines[1:]  # first line is the output schema
        if not nodes:
            return False
        root = nodes[0].strip()
        if root.startswith("WithCTE"):
            tops = [ln for ln in nodes[1:] if ln.startswith("+- ") or ln.startswith(":- ")]
            root = tops[-1][3:].strip() if tops else root
        return root.startswith(("GlobalLimit", "Limit", "LocalLimit"))

    def query(self, sql: str, cap: int | None = None) -> DataFrame | dict:
        """Run one statement.  Reads are capped at ``cap`` rows unless the
        statement itself ends in a LIMIT.  ``COPY (q) TO`` and ``CREATE TABLE
        ns.t AS q`` write; any other statement that changes something raises,
        as stored tables only change through the write strategies."""
        cap = self.cap if cap is None else cap
        if _COPY.match(sql) or _CTAS.match(sql):
            return self.execute_write(sql)
        plan = self._register_named(sql)
        if is_write_statement(sql) or _CHANGE.search(plan):
            raise ValueError("this statement would change stored tables: use COPY (query) TO 'path', CREATE TABLE "
                             "namespace.table AS query, or a collector's write strategy")
        df = self.spark.sql(sql)
        if cap and not self._root_is_limit(sql):
            df = df.limit(cap)
        return df

    def execute_write(self, sql: str) -> dict:
        m = _COPY.match(sql)
        if m:
            fmt, options = copy_options(m.group("opts"))
            return self.export(m.group("q"), m.group("path"), fmt, options)
        m = _CTAS.match(sql)
        if m:
            return self.materialize(m.group("q"), m.group("ns"), m.group("t"))
        raise ValueError("only COPY and CREATE TABLE AS write")

    def materialize(self, sql: str, namespace: str, table: str) -> dict:
        """Write a query result as a new version of ``namespace.table``."""
        if self.root is not None and PartitionedTable(self.spark, self.root, namespace, table).exists():
            raise ValueError(f"{namespace}.{table} is written by a collector; give the model another name")
        self._register_named(sql)
        t = self.versioned(namespace, table)
        t.replace(self.spark.sql(sql))
        self._register(self.find(namespace, table))
        return {"ok": True, "namespace": namespace, "table": table,
                "row_count": self.spark.read.parquet(t.location()).count(), "location": t.location()}

    def export(self, sql: str, path: str, fmt: str = "parquet", options: dict | None = None) -> dict:
        self._register_named(sql)
        writer = self.spark.sql(sql).write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.options(**(options or {})).save(path)
        return {"ok": True, "path": path, "format": fmt}


# Options of COPY and the writer options they stand for.
_FORMATS = ("parquet", "csv", "json")
_COPY_OPTIONS = {"header": "header", "delimiter": "sep", "delim": "sep", "sep": "sep", "quote": "quote", "escape": "escape",
                 "null": "nullValue", "nullstr": "nullValue", "compression": "compression", "codec": "compression",
                 "dateformat": "dateFormat", "timestampformat": "timestampFormat"}
_COPY_OPTION = re.compile(r"\s*(?P<name>\w+)(?:\s*=?\s*(?P<value>'(?:[^']|'')*'|\w+))?\s*(?:,|$)")


def copy_options(text: str | None) -> tuple[str, dict[str, str]]:
    """(format, writer options) of the list behind COPY; a name or a value
    that is not known raises, and is never passed over."""
    fmt, options, at = "parquet", {}, 0
    text = (text or "").strip()
    while at < len(text):
        m = _COPY_OPTION.match(text, at)
        if not m or m.end() == at:
            raise ValueError(f"COPY options could not be read at: {text[at:]}")
        at = m.end()
        name, value = m["name"].lower(), m["value"]
        value = value[1:-1].replace("''", "'") if value and value[0] == "'" else value
        if name == "format" or (name in _FORMATS and value is None):
            fmt = (value or name).lower()
            if fmt not in _FORMATS:
                raise ValueError(f"COPY format '{fmt}' is not known: use {', '.join(_FORMATS)}")
        elif name in _COPY_OPTIONS:
            options[_COPY_OPTIONS[name]] = "true" if value is None else value
        else:
            raise ValueError(f"COPY option '{name}' is not known")
    return fmt, options
