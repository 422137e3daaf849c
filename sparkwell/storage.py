"""Where jobs write: the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folder: dict[str, str] = {}
_made: dict[tuple[str, str, str], tuple[str, dict[str, str]]] = {}
_reading: list[dict[str, str]] = []
_databases: dict[str, list[str]] = {}
_passing: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; whoever sets it answers for all executors seeing it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="sparkwell-")
    return _own_folder[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path no one has written to yet."""
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/sparkwell/{app}/{label}-{uuid.uuid4().hex}"
    for paths in _passing:
        paths.append(path)
    return path


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a table in the shared folder: what reads it several times doesn't make it several times."""
    path = new_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Size and time of a file, or names, sizes and times of the Parquet files below a folder, as one value; empty if there is nothing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return ""
    found = system.getFileStatus(place)
    if found.isFile():
        return f"{found.getLen()} {found.getModificationTime()}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    listed = files.load(path).select("path", "length", "modificationTime")
    return str(listed.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


def note_table(spark: SparkSession, path: str) -> None:
    """Tell the copies that are being made that they read this table."""
    for seen in _reading:
        if path not in seen:
            seen[path] = fingerprint(spark, path)


def once(spark: SparkSession, label: str, sf_dir: str, make: Callable[[], str]) -> str:
    """Do ``make`` once per application and state of the tables that it reads; later calls get its first answer.

    Only those tables are looked at again; where ``make`` names none, the whole folder is.
    """
    slot = (spark.sparkContext.applicationId, label, sf_dir)
    value, seen = _made.get(slot, ("", {}))
    if not seen or any(fingerprint(spark, path) != state for path, state in seen.items()):
        seen = {}
        _reading.append(seen)
        try:
            value = make()
        finally:
            _reading.pop()
        seen = seen or {sf_dir: fingerprint(spark, sf_dir)}
        _made[slot] = (value, seen)
    for outer in _reading:
        outer.update(seen)
    return value


def staged(spark: SparkSession, label: str, sf_dir: str, write: Callable[[str], None]) -> str:
    """The path of a copy that ``write`` has written, made once."""

    def make() -> str:
        path = new_path(spark, label)
        write(path)
        return path

    return once(spark, label, sf_dir, make)


def new_database(spark: SparkSession) -> str:
    """A fresh database whose managed tables live in the shared folder."""
    name = f"sparkwell_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark, 'db')}'")
    _databases.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def database_for(spark: SparkSession, label: str, sf_dir: str, fill: Callable[[str], None]) -> str:
    """A database that ``fill`` has put tables in, made once per application and state of its tables."""

    def make() -> str:
        name = new_database(spark)
        fill(name)
        return name

    return once(spark, f"database-{label}", sf_dir, make)


def delete(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that no DataFrame reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes at its end what has been written since its begin; take a path out of the list to keep it.

    Nothing made once per application (copies, databases) may be asked for inside.
    """
    paths: list[str] = []
    _passing.append(paths)
    try:
        yield paths
    finally:
        _passing.pop()
        for path in paths:
            delete(spark, path)


def drop_databases(spark: SparkSession) -> None:
    """Drop every database made in this application, with its tables; copies are made anew when asked for again."""
    app = spark.sparkContext.applicationId
    for name in _databases.pop(app, []):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    for slot in [s for s in _made if s[0] == app]:
        del _made[slot]


def clear(spark: SparkSession) -> None:
    """Leave nothing behind: drop the databases and delete every copy and intermediate table of this application.

    Call it when no DataFrame that reads them is needed any more.
    """
    drop_databases(spark)
    delete(spark, f"{shared_folder(spark)}/sparkwell/{spark.sparkContext.applicationId}")
