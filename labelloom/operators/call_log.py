"""Answers kept as they come: a log beside the call stage, in small files.

A task commits its rows when it ends, so an executor that is lost would take every answer of
its tasks with it. Therefore each task also writes its answers ahead, ``batch_rows`` at a time
and as they arrive, to files named by the row's file, version and positions. A row that finds
its answer there is not called for again, whoever does the work the second time: a retried
task, a later attempt of the job, or a run after the driver was lost. At most ``batch_rows``
answers and the calls under way are paid for twice.

Only files whose positions cover a row are read for it. Below a file's folder they lie by run
of the call stage and by its partition: what other partitions of the same run have logged is for
rows that this one never gets, and is not even listed. Of a file that was read a task keeps the
positions not yet given out and, for the files read last, the answers; so an earlier run's log,
however its rows were dealt out, is never held whole. Files are written under another name and
then moved, so none is ever seen half done. Once the answers are in the response table their log
is deleted.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileInfo, FileSelector, FileType
from pyarrow.ipc import RecordBatchFileReader, new_file
from pyspark import TaskContext

from labelloom.sources.files import delete_folder, file_system

Row = tuple[str, int, int]  # part, version, pos
LOGGED = pa.schema([("pos", pa.int64()), ("raw", pa.string())])
#: Answers that a task keeps of the files it read, beyond those it has just been asked for.
MOST_KNOWN = 10_000


def part_folder(root: str, part: str) -> str:
    return f"{root}/{hashlib.md5(part.encode()).hexdigest()}"


@dataclass(frozen=True)
class CallLog:
    """Where a job keeps the answers of one attempt, and how many make a file.

    ``run`` stands for one run of a call stage: its tasks share this object.
    """

    root: str
    batch_rows: int
    run: str = field(default_factory=lambda: uuid.uuid4().hex, compare=False)

    def forget(self, parts: list[str] | None = None) -> None:
        """Delete the log of some files, or of all."""
        for folder in [self.root] if parts is None else [part_folder(self.root, p) for p in parts]:
            delete_folder(folder)


@dataclass
class LoggedFile:
    first: int
    last: int
    path: str
    left: np.ndarray | None = None  # positions not yet given out, once it was read


class TaskLog:
    """A task's view of the log. Calls of a task end in several threads, which all add to it."""

    def __init__(self, log: CallLog):
        self.log = log
        self.system, self.root = file_system(log.root)
        context = TaskContext.get()
        self.partition = context.partitionId() if context else 0
        self.lock = threading.Lock()
        self.files: dict[tuple[str, int], list[LoggedFile]] = {}
        self.known: dict[Row, str | None] = {}
        self.news: list[tuple[Row, str | None]] = []

    def _folder(self, part: str, version: int) -> str:
        return f"{part_folder(self.root, part)}/{version}"

    def _entries(self, folder: str, recursive: bool = False) -> list[FileInfo]:
        return self.system.get_file_info(
            FileSelector(folder, allow_not_found=True, recursive=recursive))

    def _listed(self, part: str, version: int) -> list[LoggedFile]:
        if (part, version) not in self.files:
            found = self._entries(self._folder(part, version))
            for run in [info for info in found if info.type == FileType.Directory]:
                if run.base_name == self.log.run:
                    found += self._entries(f"{run.path}/{self.partition}")
                else:
                    found += self._entries(run.path, recursive=True)
            self.files[part, version] = [
                LoggedFile(*map(int, info.base_name.split("_")[:2]), info.path)
                for info in found if info.base_name.endswith(".arrow")
            ]
        return self.files[part, version]

    def find(self, row: Row) -> tuple[bool, str | None]:
        """Whether the row's answer is there, and the answer. It is given out once."""
        found = self.find_all([row])
        return (True, found[row]) if row in found else (False, None)

    def find_all(self, rows: Iterable[Row]) -> dict[Row, str | None]:
        """The answers that are there, of the rows asked for. Each is given out once.

        Ask for many rows at a time: a file is opened once for those it holds.
        """
        wanted, found = defaultdict(list), {}
        for part, version, pos in rows:
            wanted[part, version].append(pos)
        for key, asked in wanted.items():
            files = self._listed(*key)
            asked = np.unique(asked) if files else asked
            for file in files:
                low, high = np.searchsorted(asked, (file.first, file.last + 1))
                if low < high:
                    found |= self._taken(key, file, asked[low:high])
            self.files[key] = [file for file in files if file.left is None or len(file.left)]
        return found

    def _taken(
        self, key: tuple[str, int], file: LoggedFile, asked: np.ndarray
    ) -> dict[Row, str | None]:
        if file.left is None:
            file.left = self._read(key, file)
        held = np.isin(file.left, asked)
        rows = [(*key, pos) for pos in file.left[held].tolist()]
        if any(row not in self.known for row in rows):
            self._read(key, file)
        file.left = file.left[~held]
        taken = {row: self.known.pop(row) for row in rows}
        while len(self.known) > MOST_KNOWN:
            del self.known[next(iter(self.known))]
        return taken

    def _read(self, key: tuple[str, int], file: LoggedFile) -> np.ndarray:
        """Make the file's answers known, those aside that were given out; its positions."""
        with self.system.open_input_file(file.path) as source:
            table = RecordBatchFileReader(source).read_all()
        answers = dict(zip(*(c.to_pylist() for c in table.columns), strict=True))
        left = np.array(list(answers), np.int64) if file.left is None else file.left
        self.known |= {(*key, pos): answers[pos] for pos in left.tolist()}
        return left

    def add(self, row: Row, raw: str | None) -> None:
        """Other calls that end meanwhile wait, so no more than a batch is ever unwritten."""
        with self.lock:
            self.news.append((row, raw))
            if len(self.news) >= self.log.batch_rows:
                self._write()

    def flush(self) -> None:
        with self.lock:
            self._write()

    def _write(self) -> None:
        by_file: dict[tuple[str, int], list[tuple[int, str | None]]] = {}
        for (part, version, pos), raw in self.news:
            by_file.setdefault((part, version), []).append((pos, raw))
        for (part, version), answers in by_file.items():
            answers.sort(key=lambda a: a[0])
            folder = f"{self._folder(part, version)}/{self.log.run}/{self.partition}"
            name = uuid.uuid4().hex
            self.system.create_dir(folder, recursive=True)
            table = pa.table([list(c) for c in zip(*answers)], schema=LOGGED)
            with self.system.open_output_stream(f"{folder}/{name}.open") as sink:
                with new_file(sink, LOGGED) as writer:
                    writer.write_table(table)
            self.system.move(
                f"{folder}/{name}.open",
                f"{folder}/{answers[0][0]}_{answers[-1][0]}_{name}.arrow")
        self.news = []
