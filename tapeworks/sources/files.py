"""Small helpers over folders that the driver and all tasks share (URIs or absolute paths)."""

from __future__ import annotations

import fnmatch
import json
import posixpath
import uuid

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def listed(pattern: str) -> list[tuple[str, int]]:
    """(URI, bytes) of files that a path names: a file, a folder's files, or a pattern with * ? [ in any part; sorted."""
    files, path = place(pattern)
    scheme = pattern[: len(pattern) - len(path)] if pattern.endswith(path) else ""
    parts = path.rstrip("/").split("/")
    fixed = next((i for i, p in enumerate(parts) if any(c in p for c in "*?[")), None)
    if fixed is None:
        info = files.get_file_info(path.rstrip("/"))
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    else:
        found = files.get_file_info(fs.FileSelector("/".join(parts[:fixed]) or "/", recursive=True, allow_not_found=True))
        match = lambda p: len(p) == len(parts) and all(fnmatch.fnmatchcase(a, b) for a, b in zip(p, parts, strict=True))
        found = [f for f in found if match(f.path.split("/"))]
    return sorted((scheme + f.path, f.size) for f in found if f.type == fs.FileType.File)


def children(uri: str) -> list[str]:
    """Names in a folder, sorted; none where it is missing."""
    files, path = place(uri)
    return sorted(f.base_name for f in files.get_file_info(fs.FileSelector(path, allow_not_found=True)))


def exists(uri: str) -> bool:
    files, path = place(uri)
    return files.get_file_info(path).type != fs.FileType.NotFound


def new_name(uri: str) -> str:
    """A name of its own in a folder, which is made where it is missing."""
    files, path = place(uri)
    files.create_dir(path, recursive=True)
    return f"{uri.rstrip('/')}/{uuid.uuid4().hex}"


def move(source: str, target: str) -> None:
    """Puts a whole file in place at once, over what is there."""
    files, path = place(target)
    files.create_dir(posixpath.dirname(path), recursive=True)
    files.move(place(source)[1], path)


def remove(uri: str) -> None:
    """A file or a folder with all in it; nothing happens where it is missing."""
    files, path = place(uri)
    kind = files.get_file_info(path).type
    if kind == fs.FileType.Directory:
        files.delete_dir(path)
    elif kind == fs.FileType.File:
        files.delete_file(path)


def put_json(folder: str, name: str, value) -> None:
    """A file that is there whole or not at all."""
    tmp = new_name(folder)
    files, path = place(tmp)
    with files.open_output_stream(path) as f:
        f.write(json.dumps(value).encode())
    move(tmp, f"{folder.rstrip('/')}/{name}")


def get_json(folder: str, name: str):
    files, path = place(f"{folder.rstrip('/')}/{name}")
    try:
        with files.open_input_stream(path) as f:
            return json.loads(f.read())
    except FileNotFoundError:
        return None
