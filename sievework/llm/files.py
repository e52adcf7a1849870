"""Files that tasks write and read in the shared folder, named by a table of what was committed.

A task writes under a name of its own attempt and returns the name; only names in the landed table
count, so a task that ran twice or was lost leaves an unused file, never a wrong result.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def create(folder: str, prefix: str, suffix: str):
    """A stream for a new file, and its address."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    name = f"{prefix}-{uuid.uuid4().hex}{suffix}"
    return system.open_output_stream(f"{path}/{name}", compression=None), f"{folder}/{name}"


def opened(address: str):
    """A file for reads at any place."""
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_file(path)


def mapped(address: str):
    """The 64-bit words of a file, mapped into memory where the folder is mounted and read elsewhere."""
    import numpy as np

    system, path = fs.FileSystem.from_uri(address)
    if isinstance(system, fs.LocalFileSystem):
        return np.asarray(np.memmap(path, np.uint64, "r"))
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), np.uint64)
