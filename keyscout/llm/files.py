"""Files that tasks write to and read from the shared folder, through whatever file system its path names."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_whole(path: str, data: bytes) -> None:
    """Writes a file under a temporary name and moves it into place, so a lost task leaves no half file."""
    system, name = opened(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    other = f"{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(other, compression=None) as out:
        out.write(data)
    system.move(other, name)


def mapped(path: str, dtype: str) -> np.ndarray:
    """A file as a read-only array that is mapped into memory.

    A file in a remote store is fetched to a local file, which is unlinked as soon as it is mapped.
    """
    system, name = opened(path)
    if isinstance(system, fs.LocalFileSystem) or system.type_name == "local":
        return np.memmap(name, dtype, "r") if os.path.getsize(name) else np.zeros(0, dtype)
    with tempfile.NamedTemporaryFile() as local:
        with system.open_input_stream(name, compression=None) as source:
            while chunk := source.read(1 << 24):
                local.write(chunk)
        local.flush()
        return np.memmap(local.name, dtype, "r") if os.path.getsize(local.name) else np.zeros(0, dtype)
