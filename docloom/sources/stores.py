"""Files of any store that Arrow opens, listed, read and written by tasks.

Paths are written as Spark's file scans report them: with their scheme, names
not escaped.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs

ENTRY = "path string, kind string, modificationTime timestamp, length bigint, hidden boolean"
CONTENT = "path string, modificationTime timestamp, length bigint, content binary"

#: Rows in a batch of a listing, and bytes after which a batch of contents ends.
LISTED_ROWS = 10_000
BATCH_BYTES = 16 * 1024 * 1024

_KINDS = {pafs.FileType.File: "file", pafs.FileType.Directory: "folder"}
_TIME = pa.timestamp("us", "UTC")


def _split(path: str) -> tuple[str, str]:
    """Scheme and authority of a path, and the name behind them.

    The name is never read as a URI, because a blank, ``#`` or ``%`` in it is
    not escaped.
    """
    local = re.match(r"file:/+", path)
    if local:
        return "file:", "/" + path[local.end() :]
    root = re.match(r"[^:/]+://[^/]*", path)
    if root is None:
        raise ValueError(f"a path needs a scheme: {path}")
    return root.group(), path[root.end() :]


def _connect(root: str) -> tuple[pafs.FileSystem, str]:
    if root == "file:":
        return pafs.LocalFileSystem(), ""
    store, base = pafs.FileSystem.from_uri(root + "/")
    return store, base.rstrip("/")


def _opened() -> Callable[[str], tuple[pafs.FileSystem, str]]:
    """``open_store`` that connects to a store once per task."""
    known: dict[str, tuple[pafs.FileSystem, str]] = {}

    def find(path: str) -> tuple[pafs.FileSystem, str]:
        root, tail = _split(path)
        if root not in known:
            known[root] = _connect(root)
        store, base = known[root]
        return store, base + tail

    return find


def _links_back(place: str) -> bool:
    """Whether a local folder is a link to one it lies in."""
    if not os.path.islink(place):
        return False
    target, above = os.path.realpath(place), os.path.dirname(place)
    while above != os.path.dirname(above):
        if os.path.realpath(above) == target:
            return True
        above = os.path.dirname(above)
    return False


def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies directly in each ``path``; names that start with ``.``, and
    all names in a ``hidden`` folder, are hidden.  Links to folders are followed, but
    for those that lead back to a folder they lie in; a folder that cannot be
    listed is an error."""
    find = _opened()
    for batch in batches:
        columns = (batch.column("path").to_pylist(), batch.column("hidden").to_pylist())
        for folder, hidden in zip(*columns, strict=True):
            store, place = find(folder)
            below = store.get_file_info(pafs.FileSelector(place, recursive=False))
            local = isinstance(store, pafs.LocalFileSystem)
            for start in range(0, len(below), LISTED_ROWS):
                yield _entries(folder, below[start : start + LISTED_ROWS], local, hidden)


def _entries(folder: str, infos: list[pafs.FileInfo], local: bool, hidden: bool) -> pa.RecordBatch:
    kinds = [_KINDS.get(info.type, "other") for info in infos]
    if local:
        kinds = [
            "loop" if kind == "folder" and _links_back(info.path) else kind
            for kind, info in zip(kinds, infos, strict=True)
        ]
    times = [None if info.mtime_ns is None else info.mtime_ns // 1000 for info in infos]
    return pa.record_batch(
        [
            pa.array([f"{folder.rstrip('/')}/{info.base_name}" for info in infos], pa.string()),
            pa.array(kinds, pa.string()),
            pa.array(times, pa.int64()).cast(_TIME),
            pa.array([info.size for info in infos], pa.int64()),
            pa.array([hidden or info.base_name.startswith(".") for info in infos], pa.bool_()),
        ],
        names=["path", "kind", "modificationTime", "length", "hidden"],
    )


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each ``path`` itself, as :func:`list_folders` gives it."""
    find = _opened()
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, place = find(path)
            yield _entries(path.rsplit("/", 1)[0], [store.get_file_info(place)], False, False)


def read_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each ``path``, a few files or one large one at a time.  A
    file that is gone since it was listed is an error, not a file less."""
    find = _opened()
    names = ["path", "modificationTime", "length", "content"]
    rows: list[tuple] = []

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        paths, times, sizes, contents = zip(*found, strict=True)
        columns = [pa.array(paths, pa.string()), pa.array(times, _TIME), pa.array(sizes, pa.int64())]
        return pa.record_batch([*columns, pa.array(contents, pa.binary())], names=names)

    held = 0
    for batch in batches:
        listed = (batch.column("path").to_pylist(), batch.column("modificationTime").to_pylist())
        for path, time in zip(*listed, strict=True):
            store, place = find(path)
            with store.open_input_stream(place) as stream:
                content = stream.read()
            if rows and held + len(content) > BATCH_BYTES:
                yield batch_of(rows)
                rows, held = [], 0
            rows.append((path, time, len(content), content))
            held += len(content)
    if rows:
        yield batch_of(rows)


def write_contents(base: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes each ``content`` to ``path`` below ``base``; a task that runs
    again writes the same bytes again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened()(base)
        made: set[str] = set()
        for batch in batches:
            paths, sizes = batch.column("path").to_pylist(), []
            for path, content in zip(paths, batch.column("content").to_pylist(), strict=True):
                if ".." in path.split("/"):
                    raise ValueError(f"a path leads out of its folder: {path}")
                place = f"{root.rstrip('/')}/{path.lstrip('/')}"
                folder = place.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(place) as stream:
                    stream.write(content or b"")
                sizes.append(len(content or b""))
            yield pa.record_batch(
                [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "length"]
            )

    return write
