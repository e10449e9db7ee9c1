"""Binary files on shared storage, written and read inside Spark tasks.

A task gives each file a name of its own and returns it in a row of a manifest only
once the file is complete. Readers go by the manifest, so what a lost executor or a
second attempt left behind is never read, and a repeated task disturbs nothing.
"""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs


def _resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    local = re.match(r"(?:file:)?(/.*)", uri)
    if local:
        return pafs.LocalFileSystem(), "/" + local[1].lstrip("/")
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def create(folder: str, suffix: str) -> tuple[str, object]:
    """A new file of a unique name in a folder: its path and a binary stream."""
    path = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, place = _resolve(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return path, system.open_output_stream(place, compression=None)


def open_file(path: str):
    """A binary stream of a file that :func:`create` made."""
    system, place = _resolve(path)
    return system.open_input_stream(place, compression=None)
