"""Byte-level files in the shared folder, read and written inside tasks.

Only :mod:`pyarrow.fs` touches the files, so a folder may be on any file system it knows (local or
mounted, HDFS, S3, GCS). A task writes under a name of its own and hands the name on in its rows:
a task that is run again writes another file, and the rows of the attempt that counts name its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyarrow import fs


def at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class Sink:
    """Append-only file with a name no other attempt uses."""

    def __init__(self, folder: str, suffix: str):
        self.path = f"{folder}/{uuid.uuid4().hex}{suffix}"
        system, inside = at(self.path)
        system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        self._out = system.open_output_stream(inside, compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Offset at which ``data`` begins."""
        begin = self.size
        self._out.write(data)
        self.size += len(data)
        return begin

    def close(self) -> None:
        self._out.close()


def coalesced(
    ranges: Iterable[tuple[str, int, int]], gap: int = 64 << 10, most: int = 8 << 20
) -> Iterator[tuple[int, bytes]]:
    """Bytes of each (path, offset, length), in the order given.

    Neighbours of one file that lie at most ``gap`` bytes apart are fetched by one read of up to
    ``most`` bytes; one range longer than that is still read whole.
    """
    system = handle = open_path = None
    run: list[tuple[int, int, int]] = []

    def fetch():
        begin, end = run[0][1], max(o + n for _, o, n in run)
        data = handle.read_at(end - begin, begin)
        for k, o, n in run:
            yield k, data[o - begin : o - begin + n]

    try:
        for k, (path, offset, length) in enumerate(ranges):
            same = path == open_path and run and run[-1][1] <= offset
            if not same or offset > run[-1][1] + run[-1][2] + gap or offset + length - run[0][1] > most:
                if run:
                    yield from fetch()
                    run = []
            if path != open_path:
                if handle is not None:
                    handle.close()
                system, inside = at(path)
                handle, open_path = system.open_input_file(inside), path
            run.append((k, offset, length))
        if run:
            yield from fetch()
    finally:
        if handle is not None:
            handle.close()
