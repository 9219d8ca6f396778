"""The list of a collection's versions: one small JSON file each, which appears whole or not at all.

A file is written under a name of its own and then renamed; renaming to a name that is taken fails. So
a version becomes visible at one moment, a writer that dies leaves no version behind, and of two
writers of one version exactly one succeeds. The file system is that of the path, as Hadoop knows it.
On local files Hadoop looks for the name first and renames later, the checksum by itself; there the
file gets its second name as a hard link, which the system makes only where the name is free.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class VersionExists(Exception):
    """Another writer has published this version; open the collection again and repeat the change."""


def _name(version: int) -> str:
    return f"{version:010d}.json"


def _folder(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/meta")
    return jvm, conf, folder, folder.getFileSystem(conf)


def newest(spark: SparkSession, path: str) -> int | None:
    """The number of the last published version, or None where there is none."""
    _, _, folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return max((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdecimal()), default=None)


def read(spark: SparkSession, path: str, version: int) -> dict:
    jvm, _, folder, fs = _folder(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, _name(version)))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, version: int, content: dict) -> None:
    jvm, conf, folder, fs = _folder(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".draft-{uuid.uuid4().hex}")
    data = json.dumps(content, ensure_ascii=False).encode("utf-8")
    if fs.getUri().getScheme() == "file":
        _link(fs, draft, jvm.org.apache.hadoop.fs.Path(folder, _name(version)), data, f"version {version} of {path} exists")
        return
    stream = fs.create(draft, False)
    stream.write(bytearray(data))
    stream.close()
    # the flag for "never overwrite"
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    never[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), conf)
    try:
        files.rename(draft, jvm.org.apache.hadoop.fs.Path(folder, _name(version)), never)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            raise VersionExists(f"version {version} of {path} exists") from None
        raise


def _link(fs, draft, name, data: bytes, taken: str) -> None:
    own, final = (fs.pathToFile(p).getPath() for p in (draft, name))
    os.makedirs(os.path.dirname(own), exist_ok=True)
    try:
        with open(own, "xb") as out:
            out.write(data)
            out.flush()
            os.fsync(out.fileno())
        os.link(own, final)
    except FileExistsError:
        raise VersionExists(taken) from None
    finally:
        if os.path.exists(own):
            os.remove(own)
