"""Tables that change together: each commit is one manifest that names their files.

A commit writes its rows to new folders, ``<table>/_runs/run=<version>-<id>``,
and then publishes ``<log>/<version>.json``, which lists for every table the
folders it is made of. Readers take the last manifest, so all tables change at
once or not at all: folders of a run that stopped before are named by nobody.
Names that start with ``_`` are hidden from plain readers of a table's folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER, RUNS, LEGACY = "_store", "_runs", "."
# A key table's hash buckets, and folders after which a commit writes it as one.
BUCKETS, MOST_FOLDERS = 64, 16


class Conflict(RuntimeError):
    """Another run published this version first."""


# -- files of the driver, in any file system that Spark reaches -----------------------------------
def _path(spark: SparkSession, path: str):
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(sc._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str | None:
    place, files = _path(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a whole file or none; an error if it is there."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    place, files = _path(spark, path)
    part = hadoop.Path(f"{path}.{uuid.uuid4().hex}.part")
    stream = files.create(part, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    # Unlike a file system's own rename, that of a file context never replaces a file.
    context = hadoop.FileContext.getFileContext(files.getUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(part), files.makeQualified(place), sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as error:
        files.delete(part, False)
        if error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
            raise Conflict(f"{path} is there already") from None
        raise


def _names(spark: SparkSession, folder: str) -> list[str]:
    place, files = _path(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


# -- tables -----------------------------------------------------------------------------------
@dataclass(frozen=True)
class Table:
    """A stored table. Of rows with the same ``key`` the one of the highest
    version counts. ``bucket`` names a column by whose hash files are laid out, so that
    a search for few values opens few files. Readers see ``columns``. ``keys`` is
    the folder of the key table that lists what is stored."""

    path: str
    schema: str
    fmt: str = "parquet"
    key: tuple[str, ...] = ()
    bucket: str | None = None
    columns: tuple[str, ...] = ()
    keys: str = ""
    write: dict = field(default_factory=dict)
    read: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    version: int
    tables: dict[str, list[str]]


def bucket_of(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


class Store:
    """Several tables and the log of their commits."""

    def __init__(self, spark: SparkSession, log: str, tables: dict[str, Table]):
        self.spark, self.log, self.tables = spark, log.rstrip("/"), tables

    def versions(self) -> list[int]:
        return sorted(int(n[: -len(".json")]) for n in _names(self.spark, self.log) if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """A commit, by default the last. Before the first one, tables are what
        plain files lie in their folders, if any."""
        known = self.versions()
        if not known:
            plain = lambda t: any(not n.startswith(("_", ".")) for n in _names(self.spark, t.path))
            return Manifest(0, {n: [LEGACY] if plain(t) else [] for n, t in self.tables.items()})
        wanted = known[-1] if version is None else version
        found = json.loads(_read_text(self.spark, f"{self.log}/{wanted:012d}.json"))
        return Manifest(found["version"], {n: found["tables"].get(n, []) for n in self.tables})

    def read(self, name: str, manifest: Manifest | None = None, among: DataFrame | None = None) -> DataFrame:
        """All rows of a table, by default the last commit's; with ``among``, only
        those whose values in its columns stand there."""
        table = self.tables[name]
        folders = (manifest or self.manifest()).tables[name]
        parts = []
        reader = lambda: self.spark.read.schema(table.schema).format(table.fmt).options(**table.read)
        if LEGACY in folders:
            parts.append(reader().load(table.path))
        runs = [f"{table.path}/{f}" for f in folders if f != LEGACY]
        if runs:
            # The bucket is a folder's name, and so a column that prunes files.
            schema = f"{table.schema}, bucket int" if table.bucket else table.schema
            parts.append(reader().schema(schema).option("basePath", f"{table.path}/{RUNS}").load(runs).drop("run"))
        if not parts:
            return self.spark.createDataFrame([], table.schema)
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        rows = rows.fillna(-1, [k for k in table.key if dict(rows.dtypes)[k] == "bigint"])
        if among is not None:
            rows = rows.join(among, among.columns, "left_semi")
        if not table.key:
            return rows
        rest = [c for c in rows.columns if c not in table.key]
        last = F.max_by(F.struct(*rest), F.coalesce("version", F.lit(-1))).alias("last")
        return rows.groupBy(*table.key).agg(last).select(*table.key, "last.*").select(*rows.columns)

    def matching(self, name: str, candidates: DataFrame, manifest: Manifest | None = None) -> DataFrame:
        """The distinct rows of a key table whose values in the columns of
        ``candidates``, the bucket's among them, stand there. Only files of their
        buckets are opened, and only found rows move on; the driver gets at most
        one number per bucket."""
        table, rows = self.tables[name], self.read(name, manifest)
        if "bucket" in rows.columns:
            wanted = [r[0] for r in candidates.select(bucket_of(table.bucket)).distinct().collect()]
            rows = rows.where(F.col("bucket").isin(wanted)).drop("bucket")
        return rows.join(candidates, candidates.columns, "left_semi").distinct()

    def begin(self) -> Commit:
        return Commit(self)

    def vacuum(self) -> list[str]:
        """Delete folders and manifests that the last commit does not need: what
        it replaced, and what stopped runs left. Readers of earlier commits end;
        a run that has not published yet keeps its folders."""
        last = self.manifest()
        gone = []
        for name, table in self.tables.items():
            for run in _names(self.spark, f"{table.path}/{RUNS}"):
                version = run.removeprefix("run=").split("-")[0]
                if version.isdigit() and int(version) <= last.version and f"{RUNS}/{run}" not in last.tables[name]:
                    gone.append(f"{table.path}/{RUNS}/{run}")
        gone += [f"{self.log}/{v:012d}.json" for v in self.versions() if v < last.version]
        for path in gone:
            place, files = _path(self.spark, path)
            files.delete(place, True)
        return gone


class Commit:
    """Changes of one run. Nothing can be seen of them before ``publish``."""

    def __init__(self, store: Store):
        self.store, self.base = store, store.manifest()
        self.version = self.base.version + 1
        self.tables = {n: list(f) for n, f in self.base.tables.items()}
        self.written: dict[str, int] = {}

    def _write(self, name: str, rows: DataFrame) -> list[str]:
        table = self.store.tables[name]
        if table.key:
            rows = rows.withColumn("version", F.lit(self.version).cast("long"))
        wanted = self.store.spark.createDataFrame([], table.schema).schema
        count = Observation()
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
        if table.bucket:
            rows = rows.withColumn("bucket", bucket_of(table.bucket)).repartition("bucket").sortWithinPartitions("bucket", table.bucket)
        rows = rows.observe(count, F.count(F.lit(1)).alias("rows"))
        run = f"{RUNS}/run={self.version:012d}-{uuid.uuid4().hex[:8]}"
        writer = rows.write.format(table.fmt).options(**table.write)
        (writer.partitionBy("bucket") if table.bucket else writer).save(f"{table.path}/{run}")
        self.written[name] = self.written.get(name, 0) + count.get["rows"]
        return [run] if count.get["rows"] else []

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows. A key table of many folders is written as one."""
        if self.store.tables[name].bucket and len(self.tables[name]) >= MOST_FOLDERS:
            before = self.store.read(name, Manifest(self.version, self.tables)).drop("bucket")
            added, earlier = Observation(), self.written.get(name, 0)
            rows = rows.select(*before.columns).observe(added, F.count(F.lit(1)).alias("rows"))
            self.tables[name] = self._write(name, before.unionByName(rows))
            self.written[name] = earlier + added.get["rows"]
        else:
            self.tables[name] += self._write(name, rows)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Put rows in the place of all that are there."""
        self.tables[name] = self._write(name, rows)

    def staged(self, name: str) -> DataFrame:
        """What this commit has added to a table so far."""
        own = [f for f in self.tables[name] if f not in self.base.tables[name]]
        return self.store.read(name, Manifest(self.version, self.tables | {name: own}))

    def publish(self) -> None:
        """Make the changes of all tables seen at once; ``Conflict`` if another run was first."""
        store = self.store
        for name, table in store.tables.items():
            if _read_text(store.spark, f"{table.path}/{POINTER}") is None:
                kind = {k: v for k, v in asdict(table).items() if k != "path"}
                try:
                    _write_once(store.spark, f"{table.path}/{POINTER}", json.dumps({"log": store.log, "name": name, "table": kind}))
                except Conflict:
                    pass  # a run beside this one wrote the same
        text = json.dumps({"version": self.version, "tables": self.tables, "written": self.written}, indent=1)
        _write_once(store.spark, f"{store.log}/{self.version:012d}.json", text)


def open_table(spark: SparkSession, path: str, key: str | None = None) -> DataFrame | None:
    """A committed table by its folder; ``None`` if the folder is not one of a
    store. With ``key``, the key table of it, if it has one with that column."""
    path = path.rstrip("/")
    text = _read_text(spark, f"{path}/{POINTER}")
    if text is None:
        return None
    found = json.loads(text)
    table = Table(path, **{k: tuple(v) if isinstance(v, list) else v for k, v in found["table"].items()})
    if key is not None and table.keys:
        keys = open_table(spark, table.keys)
        if keys is not None and key in keys.columns:
            return keys
    rows = Store(spark, found["log"], {found["name"]: table}).read(found["name"])
    return rows.select(*table.columns) if table.columns else rows.drop("bucket")
