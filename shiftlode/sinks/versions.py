"""One version of several tables: readers see all of them as one refresh left them.

``versions/<number>.json`` in the folder of the tables names the data folder and schema of every table. An entry is
written whole and its number can be taken once, so a version exists for all tables or for none, and the second of two
writers notices. Data folders of :func:`refresh_together` have names of their own and are not written again; those of
:func:`publish` are the caller's, who keeps them as long as the version is the newest.

Taking a number is a hard link on a local file system and a rename that does not replace elsewhere, which is atomic
on HDFS; a store without such a rename allows one writer at a time.
"""

import json
import os
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Tables = dict[str, DataFrame]
ENTRY = "number long, tables map<string, struct<folder: string, schema: string>>"
ATTEMPTS = 5


class VersionConflict(RuntimeError):
    """Other writers were faster in every attempt."""


def _entries(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(ENTRY).json(f"{base}/versions")


def current_version(spark: SparkSession, base: str) -> tuple[int, dict[str, dict]]:
    """Number and tables of the newest version; 0 and none before the first."""
    try:
        newest = _entries(spark, base.rstrip("/")).agg(F.max_by("tables", "number"), F.max("number")).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0, {}
        raise
    return newest[1] or 0, {name: found.asDict() for name, found in (newest[0] or {}).items()}


def _opened(spark: SparkSession, base: str, tables: dict[str, dict]) -> Tables:
    found = {}
    for name, at in tables.items():
        fields = StructType.fromJson(json.loads(at["schema"]))
        found[name] = spark.read.schema(fields).parquet(f"{base}/{at['folder']}").select(*fields.names)
    return found


def read_version(spark: SparkSession, base: str, number: int | None = None) -> Tables:
    """All tables of the newest or of an earlier version that has not been removed."""
    base = base.rstrip("/")
    if number is None:
        return _opened(spark, base, current_version(spark, base)[1])
    found = _entries(spark, base).where(F.col("number") == number).first()
    if found is None:
        raise ValueError(f"there is no version {number}")
    return _opened(spark, base, {name: at.asDict() for name, at in found["tables"].items()})


def _take(spark: SparkSession, base: str, number: int, tables: dict[str, dict]) -> bool:
    """Write the entry of a version; False if its number is taken."""
    jvm = spark._jvm
    draft = f"{base}/drafts/{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps({"number": number, "tables": tables}),)], "value string").coalesce(1).write.text(draft)
    conf = spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{base}/versions")
    system = folder.getFileSystem(conf)
    system.mkdirs(folder)
    written = [
        status.getPath()
        for status in system.listStatus(jvm.org.apache.hadoop.fs.Path(draft))
        if status.getPath().getName().startswith("part-")
    ][0]
    target = jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}.json")
    if system.getScheme() == "file":
        try:
            os.link(urlparse(written.toString()).path, urlparse(target.toString()).path)
        except FileExistsError:
            return False
        return True
    return _renamed(spark, written, target)


def _renamed(spark: SparkSession, written, target) -> bool:
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(written.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(written, target, options)
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def refresh_together(
    spark: SparkSession,
    base: str,
    tables: Tables | Callable[[Tables], Tables],
    partition_by: dict[str, Sequence[str]] | None = None,
    attempts: int = ATTEMPTS,
) -> Tables:
    """Replace several tables at once and return all tables of the new version.

    ``tables`` may be a function of the tables of the newest version; if another writer was faster, it is called
    again with what that one left, so no change is lost. Given tables are written once and published over
    whatever version is the newest. Tables that are not named stay as they are. A failure leaves the old version.
    """
    base, folders = base.rstrip("/"), None
    for _ in range(attempts):
        number, before = current_version(spark, base)
        if folders is None or callable(tables):
            wanted = tables(_opened(spark, base, before)) if callable(tables) else tables
            folders = {name: _stored(df, base, name, (partition_by or {}).get(name, ())) for name, df in wanted.items()}
        if _take(spark, base, number + 1, {**before, **folders}):
            return _opened(spark, base, {**before, **folders})
    raise VersionConflict(f"{attempts} versions were taken by others")


def publish(spark: SparkSession, base: str, tables: dict[str, tuple[str, StructType]], attempts: int = ATTEMPTS) -> int:
    """One version of tables that are stored already, as folder below ``base`` and schema; returns its number."""
    base = base.rstrip("/")
    named = {name: {"folder": folder, "schema": schema.json()} for name, (folder, schema) in tables.items()}
    for _ in range(attempts):
        number, before = current_version(spark, base)
        if _take(spark, base, number + 1, {**before, **named}):
            return number + 1
    raise VersionConflict(f"{attempts} versions were taken by others")


def _stored(df: DataFrame, base: str, name: str, parts: Sequence[str]) -> dict[str, str]:
    folder = f"{name}/data-{uuid.uuid4().hex}"
    rows = df.hint("rebalance", *parts) if parts else df
    rows.write.partitionBy(*parts).parquet(f"{base}/{folder}")
    return {"folder": folder, "schema": df.schema.json()}


def remove_versions(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Delete the data that only versions before the newest ``keep`` name; returns the number of folders.

    Folders that no version names yet are left, as a writer may be at work on them.
    """
    base = base.rstrip("/")
    folders = F.transform(F.map_values("tables"), lambda at: at["folder"])
    last = _entries(spark, base).agg(F.max("number")).scalar()
    named = _entries(spark, base).select("number", F.explode(folders).alias("folder"))
    old = named.groupBy("folder").agg(F.max("number").alias("number")).where(F.col("number") <= last - keep)
    removed = 0
    for row in old.collect():  # one row per table and refresh
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{row['folder']}")
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed
