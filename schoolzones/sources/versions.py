"""Stored tables with versions: part files first, then one manifest that makes them count.

A table is a folder. Every commit writes its rows as Parquet to a folder of its own below ``data`` and then puts one
manifest, ``manifests/<number>.json``, which lists the data folders of that version. A manifest is put once: of two
writers that started from the same version, one gets the number and the other starts again from the winner's version.
Nothing that a manifest lists is ever changed, so a reader stays on the version it began with, and a job that ends
before its manifest leaves the last version as it was (``remove_unused`` deletes what it wrote).

The manifest appears whole or not at all: on local and network folders by a hard link, elsewhere by a rename that
refuses an existing name, which HDFS and its like do in one step. Stores that emulate renames by copies don't.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse
from urllib.request import url2pathname

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators import reshape

TRIES = 20


class NoSuchVersion(LookupError):
    pass


class Conflict(RuntimeError):
    """Other writers won every time."""


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...]
    schema: StructType


# ---- files


def _place(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """(name, time of the last change) of what a folder holds; nothing if there is none."""
    where, fs = _place(spark, folder)
    if not fs.exists(where):
        return []
    return [(x.getPath().getName(), x.getModificationTime() / 1000) for x in fs.listStatus(where)]


def _text(spark: SparkSession, path: str) -> str:
    where, fs = _place(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    where, fs = _place(spark, path)
    stream = fs.create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _link(source: str, target: str) -> bool:
    local = lambda uri: url2pathname(urlparse(uri).path)
    try:
        os.link(local(source), local(target))
    except FileExistsError:
        return False
    return True


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    jvm = spark.sparkContext._jvm
    where, _ = _place(spark, target)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        where.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_place(spark, source)[0], where, none)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
            return False
        raise
    return True


def _put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` with this content; False if it exists."""
    where, fs = _place(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    _write_text(spark, draft, text)
    draft_place = _place(spark, draft)[0]
    try:
        if fs.makeQualified(where).toUri().getScheme() == "file":
            return _link(fs.makeQualified(draft_place).toString(), fs.makeQualified(where).toString())
        return _rename(spark, draft, path)
    finally:
        fs.delete(draft_place, False)


# ---- versions


def _manifest(path: str, number: int) -> str:
    return f"{path}/manifests/{number:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all versions, in order."""
    return sorted(int(n[:-5]) for n, _ in _names(spark, f"{path}/manifests") if n.endswith(".json"))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """That version, or the last one; None if the table has none yet."""
    known = versions(spark, path)
    if number is None and not known:
        return None
    number = known[-1] if number is None else number
    if number not in known:
        raise NoSuchVersion(f"{path} has no version {number}")
    held = json.loads(_text(spark, _manifest(path, number)))
    return Version(number, tuple(held["folders"]), StructType.fromJson(held["schema"]))


def _frame(spark: SparkSession, path: str, of: Version, folders: Sequence[str] | None = None) -> DataFrame:
    folders = of.folders if folders is None else folders
    if not folders:
        return spark.createDataFrame([], of.schema)
    return spark.read.schema(of.schema).parquet(*[f"{path}/{x}" for x in folders])


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of one version, the last one if none is given; later commits don't change them."""
    found = version(spark, path, number)
    if found is None:
        raise NoSuchVersion(f"{path} has no version")
    return _frame(spark, path, found)


def _stage(df: DataFrame, path: str) -> str:
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return folder


def _commit(spark: SparkSession, path: str, new: Version) -> bool:
    held = {"folders": list(new.folders), "schema": new.schema.jsonValue()}
    return _put_once(spark, _manifest(path, new.number), json.dumps(held))


def commit(spark: SparkSession, path: str, change: Callable[[Version | None], Version], tries: int = TRIES) -> Version:
    """Put the version that ``change`` makes of the last one; again from the new last one if another writer was first."""
    for _ in range(tries):
        base = version(spark, path)
        new = change(base)
        if base is not None and new.folders == base.folders and new.schema == base.schema:
            return base  # nothing to do
        if _commit(spark, path, new):
            return new
    raise Conflict(f"{path}: {tries} other commits came first")


def _next(base: Version | None) -> int:
    return base.number + 1 if base else 0


def create(df: DataFrame, path: str) -> Version:
    """Make a table; one that exists is an error."""
    spark = df.sparkSession
    if versions(spark, path):
        raise FileExistsError(path)
    new = Version(0, (_stage(df, path),), df.schema)
    if not _commit(spark, path, new):
        raise FileExistsError(path)
    return new


def replace(df: DataFrame, path: str) -> Version:
    """Replace all rows; ``df`` may read the table itself. Written once, whoever else commits meanwhile."""
    folder = _stage(df, path)
    return commit(df.sparkSession, path, lambda base: Version(_next(base), (folder,), df.schema))


def insert_absent(new: DataFrame, path: str, key: str, tries: int = TRIES) -> Version:
    """Add the rows whose key the table lacks; of equal new keys the least row. Stored rows aren't rewritten.

    If another writer was first and only added rows, the staged rows are compared to those, and what is left of them
    counts; if it rewrote rows, all is done again.
    """
    spark = new.sparkSession
    staged: dict = {}

    def change(base: Version | None) -> Version:
        schema = base.schema if base else new.schema
        if base is not None:
            missing = sorted(set(schema.names) ^ set(new.columns))
            if missing:
                raise ValueError(f"columns differ: {missing}")
        if not set(staged.get("compared", ())) <= set(base.folders if base else ()):
            staged.clear()
        rows = _frame(spark, path, staged["version"]) if staged else new.select(*schema.names)
        since = [x for x in (base.folders if base else ()) if x not in staged.get("compared", ())]
        if not staged or since:
            known = _frame(spark, path, base, since) if base else spark.createDataFrame([], schema)
            fresh = reshape.absent_rows(known, rows, key)
            staged["version"] = Version(-1, (_stage(fresh.select(*schema.names), path),), schema)
            staged["compared"] = base.folders if base else ()
        (folder,) = staged["version"].folders
        if base is not None and _frame(spark, path, staged["version"]).isEmpty():
            return base
        return Version(_next(base), (*(base.folders if base else ()), folder), schema)

    return commit(spark, path, change, tries)


def update(metrics: DataFrame, path: str, key: str, tries: int = TRIES) -> Version:
    """Write the metric columns into the rows with the same key; other rows keep theirs. New columns are added.

    ``metrics`` should have one row per key. Done again from the new rows if another writer was first.
    """
    spark = metrics.sparkSession

    def change(base: Version | None) -> Version:
        if base is None:
            raise NoSuchVersion(f"{path} has no version")
        updated = reshape.update_columns(_frame(spark, path, base), metrics, key)
        return Version(_next(base), (_stage(updated, path),), updated.schema)

    return commit(spark, path, change, tries)


# ---- parts


def part_of(folder: str) -> str | None:
    """The part that a data folder holds; None if it was not written by parts."""
    _, found, value = folder.rpartition("/_part=")
    return unquote(value) if found else None


def read_parts(spark: SparkSession, path: str, wanted: Callable[[str], bool], of: Version) -> DataFrame:
    """The rows of the wanted parts of a version; the files of others aren't touched."""
    return _frame(spark, path, of, [x for x in of.folders if (part := part_of(x)) is not None and wanted(part)])


def replace_parts(df: DataFrame, path: str, part: str, gone: Callable[[str], bool], base: Version | None) -> Version:
    """Write the rows of ``df`` as parts by their column ``part``, in the place of those parts of ``base`` that go.

    All other parts stay where they are. The rows are what the caller made of ``base``, so if another writer has put a
    version since, this one is refused (Conflict) and the caller begins again.
    """
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    df.withColumn("_part", F.col(part)).write.partitionBy("_part").parquet(f"{path}/{folder}")
    new = [f"{folder}/{x}" for x, _ in _names(spark, f"{path}/{folder}") if x.startswith("_part=")]
    kept = [x for x in (base.folders if base else ()) if not gone(part_of(x) or "")]
    made = Version(_next(base), (*kept, *sorted(new)), df.schema)
    if not _commit(spark, path, made):
        raise Conflict(f"{path}: another writer put version {made.number}")
    return made


def remove_unused(spark: SparkSession, path: str, keep: int = 10, older_than_hours: float = 24 * 7) -> list[str]:
    """Delete all but the last ``keep`` versions, and the data folders that none of the rest lists.

    Folders younger than ``older_than_hours`` stay: their manifest may still come. A reader of a deleted version fails.
    """
    known = versions(spark, path)
    for number in known[: max(0, len(known) - max(1, keep))]:
        where, fs = _place(spark, _manifest(path, number))
        fs.delete(where, False)
    listed = [x for n in known[-max(1, keep) :] for x in version(spark, path, n).folders] if known else []
    used = {"/".join(x.split("/")[:2]) for x in listed}
    gone = []
    for name, changed in _names(spark, f"{path}/data"):
        if f"data/{name}" not in used and changed <= time.time() - 3600 * older_than_hours:
            where, fs = _place(spark, f"{path}/data/{name}")
            fs.delete(where, True)
            gone.append(name)
    return gone
