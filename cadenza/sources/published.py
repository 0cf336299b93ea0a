"""Joint commit of several tables.

A load writes its tables into a version folder of their own.  Only when all of
them are complete is a manifest that names them put in place, by one rename of
a small file to the next number; readers take the manifest with the highest
number.  So readers see all tables of one load or all of the former one; a
load that fails or is killed half way leaves the former tables readable.  Of
two loads that finish at once, one gets the number and the other fails.

    <base>/versions/<id>/<table>/...     data
    <base>/manifests/000000000007.json   what version 7 holds
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cadenza.session import delete_paths
from cadenza.sources.sinks import CSV_OPTIONS, write_tables

#: versions that stay readable beside the newest one
KEEP = 1
#: hours after which a folder that no manifest names counts as left behind
LEFT_BEHIND_HOURS = 48


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` with all of ``text`` at once; an existing one is not replaced."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, target = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    never_over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(
            fs.makeQualified(draft), fs.makeQualified(target), never_over)
    except Exception as e:
        fs.delete(draft, False)
        raise RuntimeError(f"{path} was put in place by another load") from e


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{base}/manifests") if n[0].isdigit() and n.endswith(".json"))


def manifest(spark: SparkSession, base: str, version: int | None = None) -> dict | None:
    """What a version (the newest one) holds: ``version``, ``folder`` and per
    table ``path``, ``format`` and ``rows``; None where nothing is published."""
    if version is None:
        known = versions(spark, base)
        if not known:
            return None
        version = known[-1]
    text = spark.read.option("wholetext", True).text(f"{base}/manifests/{version:012d}.json").first()[0]
    return json.loads(text)


def read_published(spark: SparkSession, base: str, names: list[str] | None = None, version: int | None = None,
                   schemas: dict | None = None) -> dict[str, DataFrame]:
    """The tables of one version.  ``schemas`` gives the columns of text formats."""
    held = manifest(spark, base, version)
    if held is None:
        raise FileNotFoundError(f"nothing is published in {base}")
    out = {}
    for name in names or held["tables"]:
        t = held["tables"][name]
        reader = spark.read.format(t["format"])
        if t["format"] == "csv":
            reader = reader.options(multiLine=True, **CSV_OPTIONS)
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        out[name] = reader.load(f"{base}/{t['path']}")
    return out


class Version:
    """A version that is being written: its folder, and the tables told so far."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.name = spark, base, f"versions/{uuid.uuid4().hex}"
        self.folder, self.tables = f"{base}/{self.name}", {}

    def add(self, rows: dict[str, int], fmt: str = "parquet", within: str = "") -> None:
        """Tell of written tables, each ``<folder>/<within>/<name>``."""
        for name, n in rows.items():
            self.tables[name] = {"path": "/".join(x for x in (self.name, within, name) if x), "format": fmt, "rows": n}

    def write(self, tables: dict, fmt: str = "parquet", within: str = "") -> dict[str, int]:
        rows = write_tables(tables, "/".join(x for x in (self.folder, within) if x), fmt)
        self.add(rows, fmt, within)
        return rows


@contextmanager
def new_version(spark: SparkSession, base: str, keep: int = KEEP):
    """A :class:`Version` that is published when the block ends well, and whose
    files are deleted when it fails.  Versions before the ``keep`` former ones go."""
    version = Version(spark, base)
    number = max(versions(spark, base), default=0) + 1
    try:
        yield version
        _put(spark, f"{base}/manifests/{number:012d}.json", json.dumps({"version": number, "folder": version.name, "tables": version.tables}))
    except BaseException:
        delete_paths(spark, [version.folder])
        raise
    prune(spark, base, keep)


def prune(spark: SparkSession, base: str, keep: int = KEEP, left_behind_hours: float = LEFT_BEHIND_HOURS) -> list[str]:
    """Delete versions before the newest and the ``keep`` former ones, manifests
    first, and folders of loads that were killed ``left_behind_hours`` ago."""
    known = versions(spark, base)
    old, kept = known[:-(keep + 1)], known[-(keep + 1):]
    gone = [manifest(spark, base, n)["folder"] for n in old]
    delete_paths(spark, [f"{base}/manifests/{n:012d}.json" for n in old])
    named = {manifest(spark, base, n)["folder"] for n in kept}
    fs, root = _fs(spark, f"{base}/versions")
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for s in fs.listStatus(root) if fs.exists(root) else []:
        folder = f"versions/{s.getPath().getName()}"
        if folder not in named and now - s.getModificationTime() > left_behind_hours * 3_600_000:
            gone.append(folder)
    delete_paths(spark, [f"{base}/{f}" for f in dict.fromkeys(gone)])
    return gone
