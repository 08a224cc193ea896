"""Raw files in the folder that driver and executors share.

``pyarrow.fs`` opens whatever store the folder is in (local or mounted path,
HDFS, object store); each file is written under a name of its own and moved to
its place once complete, so a task that is retried or runs twice leaves one whole file.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class Draft:
    """A file that gets its name when the ``with`` block ends well."""

    def __init__(self, folder: str, name: str):
        self.store, base = open_store(folder)
        self.store.create_dir(base, recursive=True)
        self.path, self.draft = f"{base}/{name}", f"{base}/.{uuid.uuid4().hex}-{name}"

    def __enter__(self):
        self.file = self.store.open_output_stream(self.draft)
        return self.file

    def __exit__(self, kind, *_):
        self.file.close()
        if kind is None:
            self.store.move(self.draft, self.path)
        else:
            self.store.delete_file(self.draft)


def read_bytes(folder: str, name: str) -> bytes:
    store, base = open_store(folder)
    with store.open_input_stream(f"{base}/{name}") as f:
        return f.read()


def open_random(folder: str, name: str):
    store, base = open_store(folder)
    return store.open_input_file(f"{base}/{name}")
