"""Binary files that tasks write to the shared folder."""

from __future__ import annotations

import os
import uuid

import pyarrow.fs as pafs


def make_folder(uri: str) -> None:
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path, recursive=True)


def put(uri: str, name: str, data: bytes) -> None:
    """Write a file under the folder ``uri`` whole or not at all: a retried task replaces it by the
    same bytes, and a task that is lost leaves only a hidden temporary file, which readers skip."""
    fs, path = pafs.FileSystem.from_uri(uri)
    tmp = os.path.join(path, f"_{name}.{uuid.uuid4().hex}")
    with fs.open_output_stream(tmp) as f:
        f.write(data)
    fs.move(tmp, os.path.join(path, name))
