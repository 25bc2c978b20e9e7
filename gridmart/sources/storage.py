"""Files opened by Python tasks: local paths and the stores that Arrow can open."""

from __future__ import annotations

from pyarrow import fs


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def readable(path: str) -> bool:
    """Whether Arrow knows the path's store; others are left to Spark's own readers."""
    try:
        filesystem(path)
    except (ValueError, NotImplementedError, OSError):
        return False
    return True
