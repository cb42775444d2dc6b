"""Files in the cluster's shared folder, opened from tasks by the folder's address."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyarrow import fs


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path on it."""
    return fs.FileSystem.from_uri(root)


def put(root: str, name: str, write: Callable) -> None:
    """Write a file through `write(stream)` under a name of this attempt, then give it its own."""
    files, base = opened(root)
    files.create_dir(base, recursive=True)
    attempt = f"{base}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as stream:
        write(stream)
    files.move(attempt, f"{base}/{name}")


def get(root: str, name: str) -> bytes | None:
    """The whole of a file, or None where there is none."""
    files, base = opened(root)
    path = f"{base}/{name}"
    if files.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with files.open_input_file(path) as file:
        return file.read()


def release(spark, root: str) -> None:
    """Delete a folder and what is in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
