"""What a live feed said, kept before it counts as read.

A moment of a feed can't be asked for again, so a source writes each fetch as
one numbered file before it names the fetch in an offset; a replayed batch
reads the same files.  Files go once the batch after them is committed.
"""

from __future__ import annotations

import json

from pyarrow import fs


class Spool:
    """Numbered batches of text rows in a folder (any path or URI that driver restarts see again), or in memory without one."""

    def __init__(self, folder: str | None):
        self.memory: dict[int, list[list]] = {}
        self.fs = None
        if folder:
            self.fs, self.root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
            self.fs.create_dir(self.root, recursive=True)

    def _path(self, n: int) -> str:
        return f"{self.root}/{n:012d}.json"

    def numbers(self) -> list[int]:
        if self.fs is None:
            return sorted(self.memory)
        names = [f.base_name for f in self.fs.get_file_info(fs.FileSelector(self.root))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def put(self, n: int, rows: list[list]) -> None:
        """Keeps batch ``n``; it is whole or not there."""
        if self.fs is None:
            self.memory[n] = rows
            return
        with self.fs.open_output_stream(self._path(n) + ".part") as out:
            out.write(json.dumps(rows).encode())
        self.fs.move(self._path(n) + ".part", self._path(n))

    def get(self, start: int, end: int) -> list[list]:
        """Rows of the batches in [start, end); a missing batch is an error, never silently empty."""
        rows: list[list] = []
        for n in range(start, end):
            if self.fs is None:
                if n not in self.memory:
                    raise RuntimeError(f"batch {n} was held in memory by a source that is gone; give the source a spool folder")
                rows += self.memory[n]
            else:
                with self.fs.open_input_stream(self._path(n)) as f:
                    rows += json.loads(f.read())
        return rows

    def drop_before(self, n: int) -> None:
        for k in self.numbers():
            if k < n:
                if self.fs is None:
                    self.memory.pop(k)
                else:
                    self.fs.delete_file(self._path(k))
