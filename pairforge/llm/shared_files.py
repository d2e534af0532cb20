"""Binary files that tasks write into a shared folder (any file system that
pyarrow can open): temporary name first, then a rename, and a manifest table
that names what counts."""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; ``file:/x``, ``file:///x`` and ``/x`` are local."""
    local = re.sub(r"^file:/+", "/", uri)
    if local.startswith("/"):
        return pafs.LocalFileSystem(), local
    return pafs.FileSystem.from_uri(uri)


class CommittedFile:
    """A file that appears under its final name only when complete. A second
    attempt of the same task writes the same bytes: its file takes the place of the
    first in one step, or, where a store does not rename onto a file, is dropped. At
    no time is a committed file missing."""

    def __init__(self, root: str, name: str):
        self.fs, base = locate(root)
        self.fs.create_dir(f"{base}/_tmp", recursive=True)
        self.tmp, self.final = f"{base}/_tmp/{name}.{uuid.uuid4().hex}", f"{base}/{name}"
        self.out = self.fs.open_output_stream(self.tmp, compression=None, buffer_size=1 << 20)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        try:
            self.fs.move(self.tmp, self.final)
        except OSError:
            if self.fs.get_file_info(self.final).type != pafs.FileType.File:
                raise


def drop_temporary(root: str) -> None:
    """Remove what failed or superseded attempts left."""
    fs, base = locate(root)
    if fs.get_file_info(f"{base}/_tmp").type == pafs.FileType.Directory:
        fs.delete_dir(f"{base}/_tmp")


def open_stream(root: str, name: str):
    fs, base = locate(root)
    return fs.open_input_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20)
