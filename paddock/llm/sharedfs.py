"""Files that tasks write and read by themselves, always below the shared folder.

``file:`` addresses are opened (and memory-mapped) directly; any other scheme goes through
pyarrow's file systems."""

from __future__ import annotations

import mmap
import os
import uuid
from urllib.parse import unquote, urlparse


def local_path(uri: str) -> str | None:
    """The path behind a ``file:`` address, None for other schemes."""
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def _remote(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class AtomicWriter:
    """Write ``uri`` under another name and rename at the end, so that a lost or repeated task
    never leaves half a file under the final name."""

    def __init__(self, uri: str):
        self.uri, self.part = uri, f"{uri}.{uuid.uuid4().hex}.part"

    def __enter__(self):
        if (path := local_path(self.part)) is not None:
            os.makedirs(os.path.dirname(path), exist_ok=True)
            self.out = open(path, "wb")
        else:
            self.fs, name = _remote(self.part)
            self.fs.create_dir(os.path.dirname(name), recursive=True)
            self.out = self.fs.open_output_stream(name)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if (path := local_path(self.part)) is not None:
            os.replace(path, local_path(self.uri)) if kind is None else os.unlink(path)
        elif kind is None:
            self.fs.move(_remote(self.part)[1], _remote(self.uri)[1])


def read_bytes(uri: str):
    """The whole file as a buffer: a read-only memory map where the address is a local path."""
    if (path := local_path(uri)) is not None:
        with open(path, "rb") as f:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) if os.fstat(f.fileno()).st_size else b""
    fs, name = _remote(uri)
    with fs.open_input_file(name) as f:
        return f.read()
