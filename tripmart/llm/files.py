"""Files in the shared folder, reached from tasks by URI (local, HDFS or an object store)."""

from __future__ import annotations

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return fs.FileSystem.from_uri(uri)


class NewFile:
    """A file that appears under its name when the block ends well, and not otherwise."""

    def __init__(self, uri: str):
        self.store, self.path = opened(uri)
        self.hidden = f"{self.path}.part"
        self.size = 0

    def __enter__(self) -> NewFile:
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.store.open_output_stream(self.hidden)
        return self

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def __exit__(self, kind, *_) -> None:
        self.out.close()
        if kind is None:
            self.store.move(self.hidden, self.path)
        else:
            self.store.delete_file(self.hidden)
