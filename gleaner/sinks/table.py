"""A warehouse table as a series of immutable Parquet versions.

Layout below the warehouse root::

    <ns>/<table>/data/v0000000003-<attempt>/part-*.parquet   one directory per attempt
    <ns>/<table>/_versions/0000000003                        marker, names the directory

Every attempt to write a version has a directory of its own.  It is committed
by renaming a finished marker file, which names the directory, to the
version's number where no such file may exist.  So of two writers of one
number one wins, and the other fails and removes only what it wrote itself.
The rename is atomic on HDFS; on a store without atomic renames (S3 without a
table service) use one writer per table.  Paths go through Hadoop's file
system classes, so the same code runs against any cluster storage.

A version may be **bucketed** by key columns (Spark's own bucketed Parquet
layout, written by ``bucketBy``); its ``_bucketing`` file names the columns
and the bucket count, and readers get it as a ``CLUSTERED BY`` catalog table,
so a join or aggregate on the key reads the stored side without a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from gleaner.functions.widening import fitted, widened

KEEP_VERSIONS = 2

BUCKETING_FILE = "_bucketing"  # in a version directory; Parquet readers skip "_" files
_WRITE_DB = "gleaner_bucketed_write"
_READ_DB = "gleaner_bucketed"


@dataclass(frozen=True)
class Bucketing:
    columns: tuple[str, ...]
    buckets: int

    def to_json(self) -> str:
        return json.dumps({"columns": list(self.columns), "buckets": self.buckets})

    @staticmethod
    def from_json(text: str) -> "Bucketing":
        d = json.loads(text)
        return Bucketing(tuple(d["columns"]), int(d["buckets"]))


class _FS:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._spark = spark
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.java.io
        self.fs = self._Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def p(self, path: str):
        return self._Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.p(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.p(path))]

    def dirs(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.p(path)) if s.isDirectory()]

    def size(self, path: str) -> int:
        """Bytes below ``path`` (a file or a folder tree)."""
        return int(self.fs.getContentSummary(self.p(path)).getLength())

    def write_text(self, path: str, text: str) -> None:
        out = self.fs.create(self.p(path), False)
        try:
            out.write(text.encode("utf-8"))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        reader = self._io.BufferedReader(self._io.InputStreamReader(self.fs.open(self.p(path)), "UTF-8"))
        try:
            lines = []
            while True:
                line = reader.readLine()
                if line is None:
                    return "\n".join(lines)
                lines.append(line)
        finally:
            reader.close()

    def create_new(self, path: str, text: str) -> bool:
        """Make a file with this text unless one exists; readers never see a
        part of it."""
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        self.write_text(draft, text)
        fs = self._spark._jvm.org.apache.hadoop.fs
        files = fs.FileContext.getFileContext(self.fs.getUri(), self._spark._jsc.hadoopConfiguration())
        keep = self._spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            files.rename(self.p(draft), self.p(path), keep)
            return True
        except Py4JJavaError as e:
            self.delete(draft)
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            return False

    def delete(self, path: str) -> None:
        self.fs.delete(self.p(path), True)

    def mkdirs(self, path: str) -> None:
        self.fs.mkdirs(self.p(path))


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, namespace: str, name: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace
        self.name = name
        self.path = f"{self.root}/{namespace}/{name}"
        self._fs = _FS(spark, self.root)

    @property
    def full_name(self) -> str:
        return f"{self.namespace}.{self.name}"

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self._fs.names(f"{self.path}/_versions") if n.isdigit())

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def data_path(self, version: int) -> str:
        """Directory of a committed version, as its marker names it."""
        return f"{self.path}/data/{self._fs.read_text(f'{self.path}/_versions/{version:010d}').strip()}"

    def new_data_path(self, version: int) -> str:
        """A directory for one attempt to write a version."""
        return f"{self.path}/data/v{version:010d}-{uuid.uuid4().hex[:12]}"

    def location(self) -> str | None:
        v = self.current_version()
        return None if v is None else self.data_path(v)

    def exists(self) -> bool:
        return self.current_version() is not None

    def bucketing(self) -> Bucketing | None:
        """Bucket layout of the current version (None: plain files)."""
        loc = self.location()
        return None if loc is None else bucketing_at(self.spark, loc)

    def read(self, version: int | None = None) -> DataFrame | None:
        """A version's rows (default: the current one's); None without one."""
        loc = self.location() if version is None else self.data_path(version)
        if loc is None:
            return None
        b = bucketing_at(self.spark, loc)
        if b is None:
            return self.spark.read.parquet(loc)
        return self.spark.table(bucketed_table(self.spark, loc, b))

    def replace(self, df: DataFrame, partition_by: list[str] | None = None,
                bucket_by: Bucketing | None = None, only_if_rows: bool = False,
                after: int | None = None) -> int | None:
        """Write ``df`` as the next version and commit it; returns the version.

        ``bucket_by`` writes Spark's bucketed layout: when ``df`` is already
        hash-partitioned by those columns into that many partitions, each
        task writes one bucket (one file).  ``only_if_rows``: a version with
        no rows is not committed (its folder is removed) and None returned;
        the rows are counted from the written files' footers, so ``df`` is
        computed once.  ``after``: the version that ``df`` was made from (0:
        none); the commit fails if another writer has committed since."""
        nxt = (after if after is not None else self.current_version() or 0) + 1
        path = self.new_data_path(nxt)
        if bucket_by is not None:
            self._write_bucketed(df, path, bucket_by)
        else:
            writer = df.write.mode("overwrite")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(path)
        if only_if_rows and self.spark.read.parquet(path).count() == 0:
            self._fs.delete(path)
            return None
        self._commit(nxt, path)
        return nxt

    def create_empty(self) -> None:
        """A first version without files, for a stream to write into."""
        path = self.new_data_path(1)
        self._fs.mkdirs(path)
        self._commit(1, path)

    def _write_bucketed(self, df: DataFrame, path: str, b: Bucketing) -> None:
        """``bucketBy`` only writes through a catalog table: a temporary
        external one over ``path`` is created and dropped (files stay)."""
        db = catalog_db(self.spark, _WRITE_DB)
        name = f"`{db}`.`w_{uuid.uuid4().hex}`"
        try:
            (df.write.mode("overwrite").format("parquet").option("path", path)
             .bucketBy(b.buckets, *b.columns).saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._fs.write_text(f"{path}/{BUCKETING_FILE}", b.to_json())

    def append(self, df: DataFrame) -> int:
        """Add files to the current version (creates version 1 if none).

        All files of a version share one schema: columns the batch lacks are
        added as typed NULLs; a batch with new columns or wider types is a
        schema change and writes a new version holding old and new rows.
        """
        cur = self.current_version()
        if cur is None:
            return self.replace(df)
        existing = self.read(cur)
        schema = widened(existing.schema, df.schema)
        b = self.bucketing()
        if b is not None or schema != StructType([StructField(f.name, f.dataType) for f in existing.schema.fields]):
            # plain files would break the bucket layout: a new version, same layout;
            # the new rows are hash-partitioned like the stored buckets, so the
            # union keeps one partition (one file) per bucket
            new = fitted(df, schema)
            new = new.repartition(b.buckets, *b.columns) if b is not None else new
            return self.replace(fitted(existing, schema).unionByName(new), bucket_by=b, after=cur)
        fitted(df, schema).write.mode("append").parquet(self.data_path(cur))
        return cur

    def _commit(self, version: int, path: str) -> None:
        self._fs.mkdirs(f"{self.path}/_versions")
        if not self._fs.create_new(f"{self.path}/_versions/{version:010d}", path.rsplit("/", 1)[1]):
            self._fs.delete(path)  # this attempt's own directory
            raise RuntimeError(f"{self.full_name}: version {version} was committed by another writer")
        for old in self.versions()[:-KEEP_VERSIONS]:
            gone = self.data_path(old)
            self._fs.delete(f"{self.path}/_versions/{old:010d}")
            self._fs.delete(gone)

    def drop(self) -> None:
        self._fs.delete(self.path)


def catalog_db(spark: SparkSession, db: str) -> str:
    """A session-catalog database kept below the shared folder (never the
    driver's working directory)."""
    from gleaner.session import shared_dir

    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{shared_dir(spark, 'catalog', db + '.db')}'")
    return db


def bucketing_at(spark: SparkSession, location: str) -> Bucketing | None:
    fs = _FS(spark, location)
    f = f"{location.rstrip('/')}/{BUCKETING_FILE}"
    return Bucketing.from_json(fs.read_text(f)) if fs.exists(f) else None


def bucketed_table_ddl(spark: SparkSession, name: str, location: str, b: Bucketing) -> str:
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(location).schema.fields)
    by = ", ".join(f"`{c}`" for c in b.columns)
    return (f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
            f"CLUSTERED BY ({by}) INTO {b.buckets} BUCKETS LOCATION '{location}'")


def bucketed_table(spark: SparkSession, location: str, b: Bucketing) -> str:
    """Name of a catalog table over a bucketed version (one per location)."""
    db = catalog_db(spark, _READ_DB)
    name = f"`{db}`.`t_{hashlib.sha1(location.encode()).hexdigest()[:24]}`"
    spark.sql(bucketed_table_ddl(spark, name, location, b))
    return name


def list_tables(spark: SparkSession, root: str) -> list[VersionedTable]:
    """Every committed table below a warehouse root, sorted by name."""
    fs = _FS(spark, root)
    out = []
    for ns in sorted(fs.dirs(root)):
        for name in sorted(fs.dirs(f"{root.rstrip('/')}/{ns}")):
            t = VersionedTable(spark, root, ns, name)
            if t.exists():
                out.append(t)
    return out
