"""Files that tasks and the driver read and write besides Spark's own formats."""

from __future__ import annotations

import uuid
from collections.abc import Callable


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI or plain path that every node can reach."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri.replace("file:", "file://", 1)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def names(folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist. Names that start with a dot
    are files still being written."""
    from pyarrow import fs as pafs
    fs, base = filesystem(folder)
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    return sorted(f.base_name for f in found if not f.base_name.startswith("."))


def put(uri: str, write: Callable) -> None:
    """Write one file under its final name only when it is complete: ``write(stream)`` fills a
    hidden file, which is then moved. A repeated attempt replaces it."""
    fs, path = filesystem(uri)
    folder, leaf = path.rsplit("/", 1)
    fs.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{leaf}-{uuid.uuid4().hex[:12]}"
    with fs.open_output_stream(hidden) as out:
        write(out)
    fs.move(hidden, path)


def remove(uri: str) -> None:
    """Delete one file if it is there."""
    from pyarrow import fs as pafs
    fs, path = filesystem(uri)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_file(path)


def read(uri: str) -> bytes:
    fs, path = filesystem(uri)
    with fs.open_input_stream(path) as f:
        return f.read()
