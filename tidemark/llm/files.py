"""Files in the shared folder that tasks write and read themselves."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs


@contextmanager
def new_file(uri: str) -> Iterator:
    """A stream whose content appears under ``uri`` when it is complete; a task that runs again replaces it whole."""
    system, path = pafs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"  # Spark's readers leave out names that begin so
    with system.open_output_stream(part) as stream:
        yield stream
    system.move(part, path)


def read_range(uri: str, offset: int, length: int) -> bytes:
    system, path = pafs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        return file.read_at(length, offset)


def as_uri(folder: str) -> str:
    """A folder without a scheme is a local one."""
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
