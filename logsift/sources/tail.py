"""Streaming source that follows growing log files.

The offset of the stream is, per file, a number and the byte up to which it was
read, so lines appended to a file already read arrive in the next batch.  Each
line carries its own arrival time and an id made of the file's number and the
line's first byte, the same in every attempt of a batch.  Grown ranges are cut
into splits that executors read by themselves.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bits of a line id that hold the line's first byte; the others hold the file's number.
BYTE_BITS = 40
SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
BATCH_LINES = 10_000


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


class Split(InputPartition):
    """Lines of ``path`` that start in ``[start, end)``; ``limit`` is the end of
    the batch's range of this file, where its last line ends."""

    def __init__(self, path: str, number: int, first: int, start: int, end: int, limit: int):
        self.path, self.number, self.first, self.start, self.end, self.limit = path, number, first, start, end, limit


def _lines(f: pa.NativeFile, split: Split) -> Iterator[tuple[int, bytes]]:
    """``(first byte, line)`` of the lines that belong to ``split``."""
    at = split.start if split.start == split.first else split.start - 1
    f.seek(at)
    rest = b""  # bytes from ``at`` on
    inside = split.start == split.first  # else the line that runs into the split is the split before's
    while at < split.end:
        more = f.read(min(BLOCK_BYTES, split.limit - at - len(rest)))
        rest += more
        lines = rest.split(b"\n")
        rest = lines.pop()
        for line in lines:
            if inside and at < split.end:
                yield at, line
            inside = True
            at += len(line) + 1
        if not more:
            if rest and inside and at < split.end:
                yield at, rest  # an unfinished last line, taken as it is
            return


class LogTailReader(DataSourceStreamReader):
    """Options: ``path`` (folder or file), ``state`` (folder for the reader's
    position), ``maxBytes`` and ``maxFiles`` of a batch (0: no limit),
    ``unfinished`` (``true`` takes a last line without a line end as it is;
    otherwise it waits for its end).

    ``state`` holds the last planned position: Spark asks a restarted reader
    how far it can go without saying where it was.  It belongs to the query's
    checkpoint; keep or remove both together.
    """

    def __init__(self, options: dict[str, str]):
        self.root, self.state = options["path"].rstrip("/"), options["state"].rstrip("/")
        self.max_bytes, self.max_files = int(options.get("maxBytes") or 0), int(options.get("maxFiles") or 0)
        self.unfinished = (options.get("unfinished") or "").lower() == "true"
        self.known: dict[str, list[int]] | None = None

    # --- positions ----------------------------------------------------------

    def initialOffset(self) -> dict:
        self.known = {}
        return {"files": {}}

    def _position(self) -> dict[str, list[int]]:
        if self.known is None:
            files, folder = _open(self.state)
            try:
                with files.open_input_stream(f"{folder}/position.json") as f:
                    self.known = json.loads(f.read())
            except FileNotFoundError:  # nothing was planned yet
                self.known = {}
        return self.known

    def _planned(self, position: dict[str, list[int]]) -> None:
        self.known = position
        files, folder = _open(self.state)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/position.new") as f:
            f.write(json.dumps(position).encode())
        files.move(f"{folder}/position.new", f"{folder}/position.json")

    def _found(self, files: pafs.FileSystem, root: str) -> list[pafs.FileInfo]:
        info = files.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [info]
        found = files.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True))
        hidden = lambda p: any(x[:1] in "._" for x in p[len(root):].strip("/").split("/"))
        return [i for i in found if i.type == pafs.FileType.File and not hidden(i.path)]

    def _line_end(self, files: pafs.FileSystem, path: str, start: int, end: int) -> int:
        """The byte after the last line end in ``[start, end)``, or ``start``."""
        with files.open_input_file(path) as f:
            while end > start:
                a = max(start, end - BLOCK_BYTES)
                f.seek(a)
                at = f.read(end - a).rfind(b"\n")
                if at >= 0:
                    return a + at + 1
                end = a
        return start

    def _first_line_end(self, files: pafs.FileSystem, path: str, start: int, end: int) -> int:
        """The byte after the first line end in ``[start, end)``, or ``end``."""
        with files.open_input_file(path) as f:
            f.seek(start)
            while start < end:
                data = f.read(min(BLOCK_BYTES, end - start))
                if not data:
                    return end
                at = data.find(b"\n")
                if at >= 0:
                    return start + at + 1
                start += len(data)
        return end

    def latestOffset(self) -> dict:
        files, root = _open(self.root)
        start = self._position()
        out = dict(start)
        number = max((n for n, _ in out.values()), default=-1)
        bytes_left, files_left = self.max_bytes or 1 << 62, self.max_files or 1 << 62
        infos = {i.path: i for i in self._found(files, root)}
        # files known go first, then new ones by age
        for path in sorted(infos, key=lambda p: (p not in out, out.get(p, [0])[0], infos[p].mtime_ns or 0, p)):
            if bytes_left <= 0 or files_left <= 0:
                break
            size = infos[path].size
            own, at = out.get(path, (None, 0))
            if own is None or size < at:  # new, or begun anew under the same name
                own, at = None, 0
            end = size if self.unfinished else self._line_end(files, path, at, size)
            if end > at + bytes_left:
                end = self._line_end(files, path, at, at + bytes_left)
                if end == at and out == start:  # a line longer than the limit is a batch of its own
                    end = self._first_line_end(files, path, at, size)
            if end > at:
                if own is None:
                    own = number = number + 1
                out[path] = [own, end]
                bytes_left -= end - at
                files_left -= 1
        return {"files": out}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        old, out = start["files"], []
        for path, (number, limit) in end["files"].items():
            known, at = old.get(path, (number, 0))
            at = at if known == number else 0
            out += [Split(path, number, at, a, min(a + SPLIT_BYTES, limit), limit) for a in range(at, limit, SPLIT_BYTES)]
        self._planned(end["files"])
        return out

    # --- executors ------------------------------------------------------------

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.root)
        ids: list[int] = []
        lines: list[str] = []
        times: list[int] = []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lines, pa.string()), pa.array(times, pa.timestamp("us", "UTC")),
                 pa.array([split.path.rsplit("/", 1)[-1]] * len(ids), pa.string())], names=["line_id", "line", "ingested_at", "source_file"])
            for own in (ids, lines, times):
                own.clear()
            return made

        with files.open_input_file(split.path) as f:
            for at, line in _lines(f, split):
                ids.append(split.number << BYTE_BITS | at)
                lines.append(line.decode("utf-8", "ignore"))
                times.append(time.time_ns() // 1000)
                if len(ids) >= BATCH_LINES:
                    yield batch()
        if ids:
            yield batch()


class LogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "line_id bigint, line string, ingested_at timestamp, source_file string"

    def streamReader(self, schema) -> LogTailReader:
        return LogTailReader(self.options)


def follow(spark: SparkSession, path: str, state: str, max_bytes: int = 0, max_files: int = 0, unfinished: bool = False) -> DataFrame:
    """Unbounded ``(line_id, line, ingested_at, source_file)`` of the log files
    at ``path``, which must be readable under the same path on all executors."""
    spark.dataSource.register(LogTail)
    return (spark.readStream.format("log_tail").option("path", path).option("state", state).option("maxBytes", str(max_bytes))
            .option("maxFiles", str(max_files)).option("unfinished", str(unfinished).lower()).load())
