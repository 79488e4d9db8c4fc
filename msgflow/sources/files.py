"""Small file operations on local paths and file system URIs."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    for scheme in ("s3a://", "s3n://"):  # Spark's names of the same store
        if path.startswith(scheme):
            path = "s3://" + path.removeprefix(scheme)
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def exists(path: str) -> bool:
    system, inner = open_fs(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def list_names(path: str) -> list[str]:
    """Names of the direct children of a folder, sorted; empty when it does not exist."""
    system, inner = open_fs(path)
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(info.base_name for info in found)


def write_bytes(path: str, data: bytes) -> None:
    """Write a whole file so that readers see either nothing or all of it."""
    system, inner = open_fs(path)
    folder, name = inner.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, inner)


def read_bytes(path: str) -> bytes:
    system, inner = open_fs(path)
    with system.open_input_stream(inner) as source:
        return source.read()


def write_json(path: str, value: object) -> None:
    write_bytes(path, json.dumps(value, sort_keys=True).encode())


def read_json(path: str, default: object = None) -> object:
    try:
        return json.loads(read_bytes(path))
    except FileNotFoundError:
        return default


def delete_folder(path: str) -> None:
    system, inner = open_fs(path)
    if system.get_file_info(inner).type == fs.FileType.Directory:
        system.delete_dir(inner)
