"""Binary arrays in a shared folder, mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np


class Folder:
    """Binary arrays in a folder that driver and workers share, by a path of the file system or any address Arrow can open."""

    def __init__(self, uri: str):
        self.uri = uri
        self.local = uri.removeprefix("file:").replace("///", "/") if uri.startswith("file:") else uri if "://" not in uri else None

    def _remote(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.uri)

    def write(self, name: str, array: np.ndarray) -> None:
        if self.local is not None:
            os.makedirs(self.local, exist_ok=True)
            temporary = f"{self.local}/.{name}-{uuid.uuid4().hex}"
            np.ascontiguousarray(array).tofile(temporary)
            os.replace(temporary, f"{self.local}/{name}")
            return
        system, path = self._remote()
        system.create_dir(path, recursive=True)
        temporary = f"{path}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as out:
            out.write(np.ascontiguousarray(array).tobytes())
        system.move(temporary, f"{path}/{name}")

    def map(self, name: str, dtype) -> np.ndarray:
        """The array, mapped; a copy beside the worker is mapped where the folder is no local path."""
        path = f"{self.local}/{name}"
        if self.local is None:
            system, top = self._remote()
            path = os.path.join(tempfile.mkdtemp(prefix="model-"), name)
            with system.open_input_stream(f"{top}/{name}") as source, open(path, "wb") as out:
                while block := source.read(8 << 20):
                    out.write(block)
        return np.memmap(path, dtype=dtype, mode="r")
