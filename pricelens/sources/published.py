"""Logs published by manifest (A08, I01): a date changes wholly or not at all.

A published log is a folder of runs, ``run=<name>/date=<d>/part files``, and
of manifests, ``_manifest/<version>.json``.  A write first stages its run; no
reader looks at it.  It commits by creating the next manifest, which names the
live folders of each date, under a name that must be new.  A crash before leaves
the old dates, a crash after the new ones; never both or none.  Two writers who
commit at once can't overwrite each other: the later one finds the version
taken and commits again on top of it.

A plain log (``date=`` folders at the root) is taken over by its first
publication: its folders become live ones.  The driver handles names of dates
and runs only, no files; rows are read and written by Spark.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.sources.tables import write_parquet

MANIFESTS = "_manifest"
TRIES = 20


class _Folder:
    """The few file system calls that a manifest needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.root = self.hadoop.Path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def at(self, name: str):
        return self.hadoop.Path(self.root, name)

    def names(self, folder: str | None = None, start: str = "") -> list[str]:
        where = self.at(folder) if folder else self.root
        if not self.fs.exists(where):
            return []
        return sorted(n for n in (f.getPath().getName() for f in self.fs.listStatus(where)) if n.startswith(start))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Makes a whole file under a new name; False if the name is taken."""
        part = self.at(f"{MANIFESTS}/.{uuid.uuid4().hex}")
        stream = self.fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        files = self.hadoop.FileContext.getFileContext(self.root.toUri(), self.conf)
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(part, self.fs.makeQualified(self.at(name)), none)      # fails if the name is taken
            return True
        except Exception:       # py4j wraps FileAlreadyExistsException
            self.fs.delete(part, False)
            if not self.fs.exists(self.at(name)):
                raise
            return False

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _versions(folder: _Folder) -> list[int]:
    return [int(n[:-5]) for n in folder.names(MANIFESTS) if n.endswith(".json") and not n.startswith(".")]


def live_folders(spark: SparkSession, path: str, by: str = "date") -> dict[str, list[str]]:
    """The live folders of each date, as the last manifest (or a plain log) has them."""
    return _last(_Folder(spark, path), by)[1]


def _last(folder: _Folder, by: str) -> tuple[int, dict[str, list[str]]]:
    versions = _versions(folder)
    if versions:
        return max(versions), json.loads(folder.read(f"{MANIFESTS}/{max(versions):012d}.json"))
    return 0, {n[len(by) + 1:]: [n] for n in folder.names(start=f"{by}=")}


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(_versions(_Folder(spark, path)))


def stage(df: DataFrame, path: str, run: str, by: str = "date") -> list[str]:
    """Writes a run that is not live yet; returns its dates.  Staging it again replaces it."""
    write_parquet(df, f"{path}/run={run}", partition_by=[by])
    return [n[len(by) + 1:] for n in _Folder(df.sparkSession, path).names(f"run={run}", f"{by}=")]


def commit(spark: SparkSession, path: str, run: str, found: list[str], replace: list[str] | None, by: str = "date") -> None:
    """Makes the ``found`` dates of a staged run live.

    Dates in ``replace`` hold the run alone afterwards (nothing, if it has no
    rows for them); None adds the run to what its dates hold.
    """
    folder = _Folder(spark, path)
    for _ in range(TRIES):
        version, live = _last(folder, by)
        for d in {*found, *(replace or [])}:
            own = [f"run={run}/{by}={d}"] if d in found else []
            live[d] = own if replace is not None else sorted({*live.get(d, []), *own})
        if folder.create(f"{MANIFESTS}/{version + 1:012d}.json", json.dumps({d: f for d, f in sorted(live.items()) if f})):
            return
    raise RuntimeError(f"{path}: other writers took {TRIES} versions")


def publish_dates(df: DataFrame, path: str, dates: list[str] | None, by: str = "date", run: str | None = None) -> None:
    """Makes the given dates of the log hold the rows of ``df`` (dates that get no
    row become empty, others that get some are replaced, too); None adds rows."""
    run = run or uuid.uuid4().hex
    commit(df.sparkSession, path, run, stage(df, path, run, by), dates, by)


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   dates: list[str] | None = None, by: str = "date") -> DataFrame:
    """The live rows, of all dates or the given ones (others' folders are not opened)."""
    live = live_folders(spark, path, by)
    names = [f for d, fs in sorted(live.items()) if dates is None or d in dates for f in fs]
    parts = []
    for own in ([f for f in names if f.startswith("run=")], [f for f in names if not f.startswith("run=")]):
        if own:
            reader = spark.read.option("basePath", path)
            if schema is not None:
                reader = reader.schema(schema)
            parts.append(reader.parquet(*[f"{path}/{f}" for f in own]).drop("run"))
    if not parts:
        if schema is None:
            raise FileNotFoundError(f"{path}: no live date, and no schema given")
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact(spark: SparkSession, path: str, schema: T.StructType | None = None, most: int = 1, by: str = "date") -> list[str]:
    """Rewrites the dates that lie in more than ``most`` folders (the appends of a
    stream) as one run with balanced files; returns them."""
    dates = sorted(d for d, fs in live_folders(spark, path, by).items() if len(fs) > most)
    if dates:
        rows = read_published(spark, path, schema, dates, by)
        publish_dates(rows.withColumn(by, F.col(by).cast("string")), path, dates, by)
    return dates


def vacuum(spark: SparkSession, path: str, by: str = "date") -> list[str]:
    """Deletes what the last manifest doesn't name: staged runs of crashed writers,
    replaced dates, older manifests.  Run it when no reader or writer is at work."""
    folder = _Folder(spark, path)
    version, live = _last(folder, by)
    keep = {f for fs in live.values() for f in fs}
    gone = []
    for run in folder.names(start="run="):
        held = [f"{run}/{n}" for n in folder.names(run, f"{by}=")]
        dead = [run] if not keep & set(held) else [f for f in held if f not in keep]
        gone += dead
    gone += [n for n in folder.names(start=f"{by}=") if n not in keep]
    gone += [f"{MANIFESTS}/{v:012d}.json" for v in _versions(folder) if v != version]
    for name in gone:
        folder.delete(name)
    return gone
