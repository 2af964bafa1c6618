"""An upsert table of parquet files with folding.

Writers append batches of versioned rows; the row with the greatest ``order``
stands for its ``keys``.  Layout under ``root``::

    <log>/stream=<name>/batch=<id>/<partition>=<value>/…   rows of one batch
    _base/<version>-<id>/<partition>=<value>/…             folded rows, sorted by key
    _history/<version>-<id>/<partition>=<value>/…          every folded row, if kept
    _manifest/<version>.json                               what readers merge

* A batch is written aside and becomes visible by one rename; a replayed batch
  replaces its whole folder, partitions that it no longer has included.
* ``fold`` merges the batches up to a given one into a new base, for the
  partitions they touch only, and publishes it by the rename of one manifest.
  Up to that rename readers see the old manifest and all batches; after it, the
  new base and the newer batches.  What a crash leaves behind is in no manifest
  and is removed by the next fold.  Only batches that can't be replayed any more
  may be folded: those before the one being written.
* Readers merge the base with the unfolded batches, so what they read doesn't
  grow with the number of batches ever written.

One writer folds a store at a time.  The manifest and the list of batches are
small (one entry a partition value and an unfolded batch); rows never pass the
driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.session import open_writers


class Files:
    """The file system of a path, whatever its scheme."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, name: str, to: str) -> None:
        target = self._path(to)
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target) or not self._fs.rename(self._path(name), target):
            raise OSError(f"could not rename {self.root}/{name} to {to}")

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(folder))

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


@dataclass(frozen=True)
class Store:
    root: str
    ddl: str                          # all columns
    keys: tuple[str, ...]
    order: tuple[str, ...]            # of two rows of one key the greater stands
    partition: str                    # a key of few values; files are laid out by it
    log: str = "_batches"
    history: bool = False             # keep every version, not the last one alone


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    base: dict = field(default_factory=dict)      # partition value -> folder
    history: list = field(default_factory=list)   # folders
    folded: dict = field(default_factory=dict)    # stream -> last batch folded


def merge(rows: DataFrame, keys, order) -> DataFrame:
    """The row with the greatest order of every key.  A combinable aggregate, so a
    hot key is reduced in every task before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("m"))
    return best.select(*[c if c in keys else F.col(f"m.{c}") for c in rows.columns])


def manifest(spark: SparkSession, store: Store) -> Manifest:
    files = Files(spark, store.root)
    versions = [int(n[:-5]) for n in files.names("_manifest") if n.endswith(".json")]
    if not versions:
        return Manifest()
    return Manifest(**json.loads(files.text(f"_manifest/{max(versions)}.json")))


def append(rows: DataFrame, store: Store, batch_id: int, stream: str = "main") -> None:
    """One batch of rows; a replay replaces all that the batch wrote before."""
    files = Files(rows.sparkSession, store.root)
    aside = f"_aside/{uuid.uuid4().hex}"
    cols = [f.name for f in _schema(rows.sparkSession, store.ddl)]
    with open_writers(rows.sparkSession):
        rows.select(*cols).write.partitionBy(store.partition).parquet(f"{files.root}/{aside}")
    target = f"{store.log}/stream={stream}/batch={batch_id}"
    files.remove(target)
    files.move(aside, target)


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


def batches(spark: SparkSession, store: Store, m: Manifest) -> list[tuple[str, int]]:
    """(stream, batch) of everything that no fold has taken yet."""
    files, found = Files(spark, store.root), []
    for folder in files.names(store.log):
        if folder.startswith(("_", ".")):
            continue
        if not folder.startswith("stream="):
            raise ValueError(f"{store.root}/{store.log} holds {folder}, which is no batch")
        name = folder.split("=", 1)[1]
        for b in files.names(f"{store.log}/{folder}"):
            number = int(b.split("=", 1)[1])
            if number > m.folded.get(name, -1):
                found.append((name, number))
    return found


def _read(spark: SparkSession, store: Store, folders: dict[str, list[str] | None]) -> DataFrame | None:
    """The rows of each folder, of the given partition values or of all (None)."""
    files, schema, rows = Files(spark, store.root), _schema(spark, store.ddl), None
    for folder, values in folders.items():
        path = f"{files.root}/{folder}"
        paths = [path]
        if values is not None:
            held = set(files.names(folder))
            paths = [f"{path}/{n}" for n in (f"{store.partition}={v}" for v in values) if n in held]
        if paths:
            some = spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.names)
            rows = some if rows is None else rows.unionByName(some)
    return rows


def _base(m: Manifest, value: str | None) -> dict[str, list[str]]:
    """folder -> the partition values for which it is the current base."""
    held: dict[str, list[str]] = {}
    for v, folder in m.base.items():
        if value in (None, v):
            held.setdefault(folder, []).append(v)
    return held


def _log(spark: SparkSession, store: Store, m: Manifest, value: str | None):
    one = None if value is None else [value]
    return {f"{store.log}/stream={s}/batch={b}": one for s, b in batches(spark, store, m)}


def read(spark: SparkSession, store: Store, value: str | None = None) -> DataFrame | None:
    """The current rows, of one partition value or of all; None where nothing has
    been written.  Reads the base and the unfolded batches, nothing else."""
    m = manifest(spark, store)
    rows = _read(spark, store, _base(m, value) | _log(spark, store, m, value))
    return None if rows is None else merge(rows, store.keys, store.order)


def read_history(spark: SparkSession, store: Store, value: str | None = None) -> DataFrame | None:
    """Every version ever written, of one partition value or of all."""
    if not store.history:
        raise ValueError("this store keeps no history")
    m = manifest(spark, store)
    one = None if value is None else [value]
    rows = _read(spark, store, {f: one for f in m.history} | _log(spark, store, m, value))
    return None if rows is None else rows.distinct()


def fold(spark: SparkSession, store: Store, upto: dict[str, int]) -> Manifest:
    """Folds the batches up to ``upto[stream]``, which must not be written again,
    into the base (and adds them to the history, if kept)."""
    m, files = manifest(spark, store), Files(spark, store.root)
    _sweep(spark, store, m)
    mine = [(s, b) for s, b in batches(spark, store, m) if b <= upto.get(s, -1)]
    new = _read(spark, store, {f"{store.log}/stream={s}/batch={b}": None for s, b in mine})
    if new is None:
        return m
    touched = [r[0] for r in new.select(store.partition).distinct().collect()]  # few by design
    old = _read(spark, store, {f: [v for v in vs if v in touched]
                               for f, vs in _base(m, None).items() if set(vs) & set(touched)})
    rows = merge(new if old is None else old.unionByName(new), store.keys, store.order)
    name = f"{m.version + 1}-{uuid.uuid4().hex}"
    rest = [k for k in store.keys if k != store.partition]
    _sorted(rows, store, rest).parquet(f"{files.root}/_base/{name}")
    history = list(m.history)
    if store.history:
        _sorted(new.distinct(), store, [*rest, *store.order]).parquet(f"{files.root}/_history/{name}")
        history.append(f"_history/{name}")
    folded = dict(m.folded)
    for s, b in mine:
        folded[s] = max(b, folded.get(s, -1))
    done = Manifest(m.version + 1, m.base | {v: f"_base/{name}" for v in touched}, history, folded)
    _publish(files, done)
    _sweep(spark, store, done)
    return done


def _sorted(rows: DataFrame, store: Store, by: list[str]):
    """Files ranged and sorted by key, so that footers narrow down a lookup."""
    order = [store.partition, *by]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .write.partitionBy(store.partition))


def _publish(files: Files, m: Manifest) -> None:
    aside = f"_manifest/{uuid.uuid4().hex}.tmp"
    files.write(aside, json.dumps(vars(m)))
    files.move(aside, f"_manifest/{m.version}.json")


def _sweep(spark: SparkSession, store: Store, m: Manifest) -> None:
    """Removes what readers of this manifest and of the one before don't need:
    folded batches, older bases, and what a crash left behind."""
    files = Files(spark, store.root)
    before = f"_manifest/{m.version - 1}.json"
    last = Manifest(**json.loads(files.text(before))) if files.exists(before) else Manifest()
    for n in files.names("_manifest"):
        if n.endswith(".tmp") or (n.endswith(".json") and int(n[:-5]) < m.version - 1):
            files.remove(f"_manifest/{n}")
    needed = {*m.base.values(), *m.history, *last.base.values(), *last.history}
    for folder in ("_base", "_history"):
        for n in files.names(folder):
            if f"{folder}/{n}" not in needed:
                files.remove(f"{folder}/{n}")
    for s, upto in last.folded.items():  # what the manifest before still reads stays
        for b in files.names(f"{store.log}/stream={s}"):
            if int(b.split("=", 1)[1]) <= upto:
                files.remove(f"{store.log}/stream={s}/{b}")
