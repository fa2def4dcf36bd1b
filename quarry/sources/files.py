"""Files that tasks write into the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable


def arrow_store(uri: str):
    """The Arrow file system of a folder URI and the path in it."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_once(store, path: str, pieces: Iterable[bytes]) -> None:
    """Write under a name of its own and rename: a retried task replaces the file with the same
    bytes, a lost one leaves nothing under the final name."""
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    temp = f"{folder}/_{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(temp) as out:
        for p in pieces:
            out.write(p)
    store.move(temp, path)
