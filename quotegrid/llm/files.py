"""Streams of bytes in the shared folder, from inside tasks: no record is held in memory as a whole."""

from __future__ import annotations

import posixpath

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI that all executors reach (local or mounted, HDFS, S3, GCS), and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def join(folder: str, name: str) -> str:
    return posixpath.join(folder, name)
