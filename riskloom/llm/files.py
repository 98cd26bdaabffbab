"""Files in the shared folder, opened by tasks through pyarrow so that any store it knows can hold them."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def publish(uri: str, data: bytes) -> None:
    """Write a whole file under another name and move it into place: readers never see a part of
    it, and a task that runs twice leaves one file."""
    store, path = opened(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part, compression=None) as out:
        out.write(data)
    store.move(part, path)


def fetch(uri: str) -> bytes:
    store, path = opened(uri)
    with store.open_input_stream(path, compression=None) as source:
        return source.read()
