"""Files that tasks write to and read from a folder all executors share.

A task names its file anew in each attempt and reports it in its output row. Only
files in those rows count, so what a lost or repeated attempt leaves is never read.
"""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(uri).path)
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """A new file below an existing or new folder, open for writing."""
    system, path = locate(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_file(uri: str):
    system, path = locate(uri)
    return system.open_input_file(path)
