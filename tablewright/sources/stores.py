"""Files of a store that every executor reaches, opened inside tasks: local or mounted folders, s3, gs, abfs, hdfs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

#: Bytes that a copy holds at once.
CHUNK = 4 << 20


def located(path: str):
    """The Arrow file system of a path, and the path in it. Spark's file:/a is file:///a."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    from pyarrow import fs

    store, inner = located(path)
    return store.get_file_info(inner).type == fs.FileType.File


def remove(path: str) -> bool:
    """False when there is no such file."""
    store, inner = located(path)
    if not exists(path):
        return False
    store.delete_file(inner)
    return True


def remove_folder(path: str) -> None:
    from pyarrow import fs

    store, inner = located(path)
    if store.get_file_info(inner).type == fs.FileType.Directory:
        store.delete_dir(inner)


def move(source: str, target: str) -> None:
    """Put a file in another place of the same store, over a file that is there."""
    store, inner = located(source)
    _, other = located(target)
    store.create_dir(other.rsplit("/", 1)[0], recursive=True)
    store.move(inner, other)


def digest(path: str) -> tuple[int, str]:
    """Bytes and SHA-256 of a file."""
    store, inner = located(path)
    seen, size = hashlib.sha256(), 0
    with store.open_input_stream(inner) as stream:
        while chunk := stream.read(CHUNK):
            seen.update(chunk)
            size += len(chunk)
    return size, seen.hexdigest()


def save(packed, folder: str) -> None:
    """Write rows (path, content) as files of those names below a folder."""
    def written(frames):
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"]):
                store, inner = located(f"{folder.rstrip('/')}/{name}")
                store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(inner) as out:
                    out.write(content)
            yield frame[["path"]]

    packed.select("path", "content").mapInPandas(written, "path string").write.format("noop").mode("overwrite").save()


def join(sources: Iterable[str], target: str, skip: int = 0) -> tuple[int, str]:
    """Write the bytes of the files one after another, the first `skip` of each but the first left out. Bytes and SHA-256.

    The target appears whole: it is written beside its place first.
    """
    store, inner = located(target)
    folder, name = inner.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    seen, size, fresh = hashlib.sha256(), 0, f"{folder}/_{name}.{_own_number()}"
    with store.open_output_stream(fresh) as out:
        for number, source in enumerate(sources):
            origin, at = located(source)
            with origin.open_input_stream(at) as stream:
                left = skip if number else 0
                while left and (chunk := stream.read(min(left, CHUNK))):
                    left -= len(chunk)
                while chunk := stream.read(CHUNK):
                    out.write(chunk)
                    seen.update(chunk)
                    size += len(chunk)
    store.move(fresh, inner)
    return size, seen.hexdigest()


def put(archive, info, target: str) -> tuple[str, tuple[int, str]]:
    """Write a member of an open zip archive to a file: copied, present or differs, with bytes and SHA-256 of the file there."""
    seen, size = hashlib.sha256(), 0
    if exists(target):
        with archive.open(info) as member:
            while chunk := member.read(CHUNK):
                seen.update(chunk)
                size += len(chunk)
        there = digest(target)
        return ("present" if there == (size, seen.hexdigest()) else "differs"), there
    store, inner = located(target)
    folder, name = inner.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    fresh = f"{folder}/_{name}.{_own_number()}"
    with archive.open(info) as member, store.open_output_stream(fresh) as out:
        while chunk := member.read(CHUNK):
            out.write(chunk)
            seen.update(chunk)
            size += len(chunk)
    store.move(fresh, inner)
    return "copied", (size, seen.hexdigest())


def _own_number() -> str:
    """A number that no other attempt of a task has."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return "driver" if task is None else str(task.taskAttemptId())
