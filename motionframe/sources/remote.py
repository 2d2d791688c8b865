"""Files as workers see them: opened where they are, read by ranges, without the whole coming along."""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import fs as arrow_fs


def located(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path, which may be a URI as Spark writes it, and the path within it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    if path.startswith("file://"):  # a name may hold what a URI would escape
        return arrow_fs.LocalFileSystem(), path.removeprefix("file://")
    return arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)


class Ranges:
    """A file of which only what is asked for is read; counts the bytes that it has read."""

    def __init__(self, path: str):
        files, inner = located(path)
        self.file, self.taken = files.open_input_file(inner), 0
        self.size = self.file.size()

    def __call__(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        out = self.file.read(n)
        self.taken += len(out)
        return out

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def below(path: str, suffix: str = "") -> Iterator[tuple[str, int]]:
    """(path, size) of the files with the suffix at or below a path, in order; a missing path has none.

    Paths keep the form in which the folder was given.
    """
    files, inner = located(path)
    there = files.get_file_info(inner)
    if there.type == arrow_fs.FileType.NotFound:
        return
    every = [there] if there.is_file else files.get_file_info(arrow_fs.FileSelector(inner, recursive=True))
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    for info in sorted((i for i in every if i.is_file and i.path.endswith(suffix)), key=lambda i: i.path):
        yield prefix + info.path, info.size
