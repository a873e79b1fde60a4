"""Files that tasks write and read in the shared folder, by whatever store its path names."""

from __future__ import annotations

import mmap
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from powerflow.session import shared_folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` that exists when this returns."""
    folder = shared_folder(spark, purpose)
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    return folder


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; a path without a scheme is a mounted folder."""
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    if folder.startswith("file:"):
        folder = folder.removeprefix("file:")
    return fs.LocalFileSystem(), folder


def exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type == fs.FileType.File


def put(folder: str, name: str, parts: list) -> None:
    """Write a file whole or not at all. A repeated task writes the same bytes again."""
    store, path = open_store(folder)
    attempt = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(attempt, compression=None) as out:
        for part in parts:
            out.write(part)
    if not isinstance(store, fs.LocalFileSystem) and exists(store, f"{path}/{name}"):
        store.delete_file(attempt)
    else:
        store.move(attempt, f"{path}/{name}")


def mapped(folder: str, name: str) -> memoryview:
    """A file's bytes, memory-mapped.

    A mounted shared folder is mapped in place. From another store the file is copied first, and the copy's name is
    removed at once, so that it ends with the worker.
    """
    store, path = open_store(folder)
    if isinstance(store, fs.LocalFileSystem):
        with open(f"{path}/{name}", "rb") as file:
            return memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{path}/{name}", compression=None) as source:
        while data := source.read(1 << 20):
            copy.write(data)
        copy.flush()
        return memoryview(mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ))
