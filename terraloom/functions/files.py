"""Paths as Spark names them, opened from tasks."""

from __future__ import annotations

import re

import pyarrow.fs as pafs
from pyspark.sql import Column, functions as F

LOCAL = "^file:/+"


def plain(path: str) -> str:
    """A local path without its scheme; other paths stay as they are."""
    return re.sub(LOCAL, "/", path)


def plain_column(path: Column | str) -> Column:
    return F.regexp_replace(path, LOCAL, "/")


def below(path: Column | str, root: str) -> Column:
    """The part of a path below ``root``."""
    return F.replace(plain_column(path), F.lit(plain(root).rstrip("/") + "/"), F.lit(""))


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path inside it."""
    return pafs.FileSystem.from_uri(plain(path).replace("s3a://", "s3://", 1))


def head(path) -> str | None:
    """What stands before a path inside its file system where Spark names it; None for what only Spark can open or several paths."""
    if not isinstance(path, str) or re.search(r"[*?\[\]{}]", path):
        return None
    try:
        fs, inner = filesystem(path)
    except (ValueError, NotImplementedError, OSError):  # an unknown scheme, or one whose library is not here
        return None
    if fs.type_name == "local":
        return "file:"
    whole = plain(path).rstrip("/")
    return whole[:-len(inner)] if inner and whole.endswith(inner) else None


def exists(path: str) -> bool:
    """Whether there is a file or a folder."""
    fs, inner = filesystem(path)
    return fs.get_file_info(inner).type != pafs.FileType.NotFound


def open_file(path: str):
    """Open a file for reading ranges."""
    fs, inner = filesystem(path)
    return fs.open_input_file(inner)
