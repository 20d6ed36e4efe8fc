"""Files that executors write to and read from the shared folder, on any file system pyarrow knows."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs as pafs


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a path without a scheme is a local one."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    system, path = locate(uri)
    system.create_dir(path, recursive=True)


def open_output(uri: str) -> pa.NativeFile:
    system, path = locate(uri)
    return system.open_output_stream(path)


def open_input(uri: str) -> pa.NativeFile:
    """For random access: a memory map where the file system is local, else a seekable file."""
    system, path = locate(uri)
    return pa.memory_map(path) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(path)
