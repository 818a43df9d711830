"""Files that tasks write to, and read from, the cluster's shared folder."""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(uri)


def attempt_stem() -> str:
    """A file stem no other attempt of any task of the application uses."""
    context = TaskContext.get()
    return f"{context.partitionId():06d}-{context.taskAttemptId()}"
