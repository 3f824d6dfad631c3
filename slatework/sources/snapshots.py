"""Snapshots with a published pointer, and the small manifest files behind it.

A snapshot is written to a folder of its own first. Then the manifest, one small
JSON file, is written beside the old one and moved over it in one step. Readers
follow the manifest, so they see the old state or the new one, never a part, and
finding the latest snapshot reads no data. A write that fails leaves the
manifest as it was. One writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Manifest:
    """A JSON file in any store that Spark reaches, replaced as a whole."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._path = self._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_manifest.json")
        self._fs = self._path.getFileSystem(self._conf)

    def read(self) -> dict:
        """The content; empty before the first ``replace``."""
        if not self._fs.exists(self._path):
            return {}
        stream = self._fs.open(self._path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def replace(self, content: dict) -> None:
        fresh = self._jvm.org.apache.hadoop.fs.Path(self._path.getParent(), f"_manifest-{uuid.uuid4().hex}.tmp")
        out = self._fs.create(fresh, False)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path.toUri(), self._conf)
        context.rename(context.makeQualified(fresh), context.makeQualified(self._path), how)


def folder_fingerprints(spark: SparkSession, folder: str, by: str) -> dict[str, str]:
    """Fingerprint of the files of every ``by=value`` folder: names, sizes and times; no data is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for part in fs.listStatus(path):
        name = part.getPath().getName()
        if part.isDirectory() and name.startswith(f"{by}="):
            files = [f for f in fs.listStatus(part.getPath()) if not f.getPath().getName().startswith(("_", "."))]
            listed = sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in files)
            found[name.removeprefix(f"{by}=")] = hashlib.sha256("\n".join(listed).encode()).hexdigest()
    return found


def publish(df: DataFrame, root: str, label: str) -> None:
    """Write ``df`` as the snapshot ``label`` and make it the latest; a label published again is replaced."""
    manifest = Manifest(df.sparkSession, root)
    folder = f"data/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{folder}")
    content = manifest.read()
    manifest.replace({"latest": label, "snapshots": {**content.get("snapshots", {}), label: folder}})


def labels(spark: SparkSession, root: str) -> list[str]:
    """Published labels, sorted."""
    return sorted(Manifest(spark, root).read().get("snapshots", {}))


def read_snapshot(spark: SparkSession, root: str, label: str | None = None) -> DataFrame:
    """The snapshot ``label``, or the latest published one."""
    content = Manifest(spark, root).read()
    wanted = content.get("latest") if label is None else label
    if wanted not in content.get("snapshots", {}):
        raise ValueError(f"no snapshot {label or 'at all'} in {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{content['snapshots'][wanted]}")
