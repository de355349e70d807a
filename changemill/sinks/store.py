"""Files of a shared store as Python data sources see them: tasks and the driver's worker alike."""

from __future__ import annotations

import json
import sys

from pyarrow import fs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def located(path: str):
    """The file system of a path as Spark names it, and the path in it; names aren't URL-encoded."""
    scheme, found, rest = path.partition("://")
    if path.startswith("file:") or not found:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path
    authority, _, name = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store, f"{base.rstrip('/')}/{name}"


def is_known(path: str) -> bool:
    """Can Python open this path, or only Spark?"""
    try:
        located(path)
    except (ValueError, OSError, NotImplementedError):
        return False
    return True


class Store:
    """A folder of a file system that pyarrow knows (local, HDFS, S3, GCS)."""

    def __init__(self, path: str) -> None:
        self.path = path
        self._fs = None

    def __getstate__(self):
        return {"path": self.path, "_fs": None}

    @property
    def fs(self):
        if self._fs is None:
            store, name = located(self.path)
            self._fs = fs.SubTreeFileSystem(name, store)
        return self._fs

    def names(self, folder: str) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == fs.FileType.File)

    def sizes(self, names: list[str]) -> list[int | None]:
        """The files' sizes; None where there is none."""
        return [f.size if f.type == fs.FileType.File else None for f in self.fs.get_file_info(names)] if names else []

    def exists(self, name: str) -> bool:
        return self.sizes([name])[0] is not None

    def read_json(self, name: str):
        with self.fs.open_input_stream(name) as f:
            return json.loads(f.read())

    def write_json(self, name: str, value) -> None:
        """Visible as a whole or not at all."""
        self.fs.create_dir(name.rpartition("/")[0])
        with self.fs.open_output_stream(f"{name}.part") as f:
            f.write(json.dumps(value).encode())
        self.fs.move(f"{name}.part", name)

    def delete(self, names: list[str]) -> None:
        for name in names:
            if self.exists(name):
                self.fs.delete_file(name)
