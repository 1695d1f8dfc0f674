"""Byte access to single files from inside tasks.

Spark's readers hand a task whole files or lines. Reading a part of a file (an
archive's directory, one of its members) needs a seekable handle, which comes
from ``pyarrow.fs`` for the storage schemes it knows. ``DIRECT`` lists them;
callers keep another way for the rest.
"""

from __future__ import annotations

import io
import re
from typing import BinaryIO

from pyarrow import fs

DIRECT = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")
_LIKE = {"s3a": "s3", "abfss": "abfs"}


def scheme_of(path: str) -> str:
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):/", path)
    return m.group(1).lower() if m else "file"


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    scheme = scheme_of(path)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:/*|^/+", "", path)
    if scheme not in DIRECT:
        raise ValueError(f"no byte access to {scheme} files")
    authority, _, rest = re.sub(r"^[^:]+:/+", "", path).partition("/")
    system, base = fs.FileSystem.from_uri(f"{_LIKE.get(scheme, scheme)}://{authority}/")
    return system, base.rstrip("/") + "/" + rest


def open_input(path: str, buffer: int = 1 << 20) -> BinaryIO:
    """A seekable, buffered handle; only the parts that are read are fetched."""
    system, name = _resolve(path)
    return io.BufferedReader(system.open_input_file(name), buffer)


class Output:
    """A file that appears under its name only when it is complete.

    It is written under a name of its own and moved at the end, so that a
    task which dies, or runs twice, leaves no half file under the name.
    """

    def __init__(self, path: str, attempt: str):
        self.system, self.name = _resolve(path)
        self.part = f"{self.name}.{attempt}.part"
        self.system.create_dir(self.name.rpartition("/")[0], recursive=True)
        self.stream = self.system.open_output_stream(self.part)

    def __enter__(self):
        return self.stream

    def __exit__(self, kind, value, trace) -> None:
        self.stream.close()
        if kind is None:
            self.system.move(self.part, self.name)
        else:
            self.system.delete_file(self.part)


def move_single(spark, folder: str, path: str) -> None:
    """Move the one data file of a written folder to ``path``, on the cluster's file system."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    source = make(folder)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    (part,) = [s.getPath() for s in system.listStatus(source) if s.getPath().getName().startswith("part-")]
    system.mkdirs(make(path).getParent())
    if not system.rename(part, make(path)):
        raise OSError(f"{path} could not be written")
