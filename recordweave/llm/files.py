"""Files that tasks write into a shared folder, on any file system PyArrow reaches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordweave.operators.lookup import broadcast_if_small


def partition_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def make_folder(folder: str) -> None:
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)


def write_file(folder: str, name: str, ending: str, chunks: Iterable[bytes]) -> tuple[str, int]:
    """Write a file whose name begins and ends as told and is this attempt's own; its name and its number of bytes.

    A file counts once its name is in the list that the job's tasks return.  A task that is run again, or twice at once, writes other
    files; those of attempts that were cut or not taken are in no list and are not read.
    """
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    own = f"{name}-{uuid.uuid4().hex}{ending}"
    size = 0
    with system.open_output_stream(f"{root}/{own}", compression=None) as out:  # by the name it would pack .gz once more
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    return own, size


def listed(found: DataFrame, files: DataFrame) -> DataFrame:
    """The files of a binary read (``path``) that are in the list their writer returned (``file``)."""
    name = F.element_at(F.split("path", "/"), -1)
    return found.join(broadcast_if_small(files.select("file")), name == F.col("file"), "left_semi")
