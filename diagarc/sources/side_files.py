"""Rows that a task puts beside its own output, so that one pass over the input gives both."""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa


def file_store(target: str):
    """(pyarrow file system, folder) of a qualified path."""
    from pyarrow import fs

    if target.startswith("file:"):
        return fs.LocalFileSystem(), "/" + target.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(target)


def put_once(target: str, table: pa.Table) -> str:
    """Write ``table`` as a Parquet file of the folder ``target``, named after its contents.

    The file is written under a hidden name and moved, so readers see it whole. A task that runs again, or
    twice at a time, writes the same rows under the same name: they are there once.
    """
    import pyarrow.parquet as pq

    digest = hashlib.sha256()
    for column in table.columns:
        for value in column.to_pylist():
            piece = repr(value).encode()
            digest.update(b"%d:" % len(piece) + piece)
    store, root = file_store(target)
    store.create_dir(root, recursive=True)
    name = f"part-{digest.hexdigest()}.parquet"
    hidden = f"{root}/_{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        pq.write_table(table, out)
    store.move(hidden, f"{root}/{name}")
    return name
