"""Reading and writing plain files in the shared folder from tasks, through pyarrow's file systems, so the folder may be
a mounted path, HDFS or an object store."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def opened(uri: str):
    """A file for random reads."""
    system, path = _located(uri)
    return system.open_input_file(path)


class Replacing:
    """Writes a file under a name of its own and moves it into place when it is whole, so a task that runs twice leaves
    one whole file."""

    def __init__(self, uri: str):
        self.system, self.path = _located(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.system.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.stream = self.system.open_output_stream(self.part)

    def finish(self) -> None:
        self.stream.close()
        self.system.move(self.part, self.path)
