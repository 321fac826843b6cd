"""Binary files in the shared folder, written and read by tasks through their URI."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse


def open_fs(uri: str):
    """(file system, path) of a URI or a plain path."""
    from pyarrow import fs

    if urlparse(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)


class TempFile:
    """A file under a temporary name that gets its own name only when it is complete.

    Several attempts of a task write under different temporary names; the last to finish replaces the
    others' file by an equal one.
    """

    def __init__(self, uri: str):
        self.fs, self.path = open_fs(uri)
        folder, _, name = self.path.rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        self.temp = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
        self.stream = self.fs.open_output_stream(self.temp, compression=None)
        self.bytes = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def commit(self) -> None:
        from pyarrow.fs import FileType

        self.stream.close()
        try:
            self.fs.move(self.temp, self.path)
        except OSError:  # some stores do not replace on a move
            if self.fs.get_file_info(self.path).type == FileType.File:
                self.fs.delete_file(self.path)
            self.fs.move(self.temp, self.path)

    def abort(self) -> None:
        self.stream.close()
        self.fs.delete_file(self.temp)
