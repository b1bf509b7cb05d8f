"""Files that tasks write to and read from the folder all executors share.

Paths are URIs as Spark gives them. A local or mounted folder is memory-mapped; other
stores are read by ranges through Arrow's file systems.
"""

from __future__ import annotations

import os
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from gleanstar.session import staging_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, deleted with what else the session staged."""
    return os.path.join(staging_folder(spark), name)


@lru_cache(maxsize=64)
def _filesystem(scheme: str, host: str):
    return pafs.FileSystem.from_uri(f"{scheme}://{host}/")[0]


def locate(uri: str):
    """(file system, path) of a URI or a plain path."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    scheme, _, rest = uri.partition("://")
    if scheme == "file":
        return pafs.LocalFileSystem(), rest
    return pafs.FileSystem.from_uri(uri)


def write_file(folder: str, stem: str, chunks) -> str:
    """Write byte chunks to a new file under a temporary name, then rename it, so that a
    task that is lost or runs twice never leaves a partial file under the name returned."""
    fs, base = locate(folder)
    fs.create_dir(base, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}"
    with fs.open_output_stream(f"{base}/_{name}") as out:
        for chunk in chunks:
            out.write(chunk)
    fs.move(f"{base}/_{name}", f"{base}/{name}")
    return f"{folder}/{name}"


class RangeReader:
    """Reads byte ranges of one file."""

    def __init__(self, uri: str):
        fs, path = locate(uri)
        self._file = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)

    def size(self) -> int:
        return self._file.size()

    def read(self, offset: int, length: int):
        self._file.seek(offset)
        return self._file.read_buffer(length)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self._file.close()


def write_arrays(folder: str, stem: str, arrays: dict[str, np.ndarray]) -> str:
    """One file with several flat arrays, each aligned to 8 bytes, and a directory at its end."""
    directory, chunks, at = [], [], 0
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a)
        directory.append(f"{name},{raw.dtype.str},{at},{raw.size}")
        chunks += [raw.tobytes(), b"\0" * (-raw.nbytes % 8)]
        at += raw.nbytes + (-raw.nbytes % 8)
    tail = ";".join(directory).encode()
    return write_file(folder, stem, [*chunks, tail, len(tail).to_bytes(8, "little")])


def open_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of `write_arrays`, memory-mapped where the file system allows it."""
    with RangeReader(uri) as f:
        end = f.size()
        n = int.from_bytes(f.read(end - 8, 8).to_pybytes(), "little")
        out = {}
        for entry in f.read(end - 8 - n, n).to_pybytes().decode().split(";"):
            name, dtype, at, size = entry.split(",")
            kind = np.dtype(dtype)
            out[name] = np.frombuffer(f.read(int(at), int(size) * kind.itemsize), kind)
        return out


@lru_cache(maxsize=4)
def open_shards(uris: tuple[str, ...]) -> list[dict[str, np.ndarray]]:
    """Array files of one store, opened once per worker; only touched pages are loaded."""
    return [open_arrays(u) for u in uris]
