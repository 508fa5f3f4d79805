"""Files as they arrive, listed by tasks and remembered in a table instead of on the driver.

A listing is one micro-batch of a stream source: its tasks walk the sub-folders, and a sub-folder whose names are those of the
last listing gives nothing. What the others hold is anti-joined with the table of files taken before. The driver knows
sub-folders and lots, never files; no clock decides what is new, so late and restored files are taken like any other.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import hashlib
import math
import re
import sys
import uuid
from collections.abc import Iterable, Iterator, Sequence
from itertools import product

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from docmeld.config import INTAKE_GLOB, MAX_FILES_PER_TRIGGER, parse_bytes
from docmeld.sources.files import BINARY_FILE_SCHEMA
from docmeld.sources.logs import LogTable
from docmeld.workspace import Workspace, names, remove

# Executors get the code of these functions with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A file, or (without a path) the mark of a sub-folder: the number of its names and the sum of their hashes.
LISTING = "prefix string, path string, modificationTime timestamp, length long, files long, mark long"
SEEN = "prefix string, path string, modificationTime timestamp, length long"
MARKS = "prefix string, files long, mark long"
#: Lots that one task cuts, and sub-folders with news that are sent to the scan of the table of files taken before.
LOTS_PER_TASK, SENT_PREFIXES = 64, 10_000
#: Bytes of contents that a task hands on at once; a larger file goes alone.
HANDED_BYTES = 32 << 20


def located(uri: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system of a folder or file, its path there, and what stands before that path in Spark's name for it."""
    local = re.match(r"(?:file:(?://)?)?(?=/)", uri)
    if local:
        return pafs.LocalFileSystem(), uri[local.end() :].rstrip("/"), "file:"
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs, path.rstrip("/"), uri.rstrip("/").removesuffix(path.rstrip("/"))


def patterns(glob: str) -> list[str]:
    """The patterns that a pattern with braces stands for."""
    parts = [p[1:-1].split(",") if p.startswith("{") else [p] for p in re.split(r"(\{[^{}]*\})", glob)]
    return ["".join(p) for p in product(*parts)]


def entries(fs: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    """What a folder holds, without names that begin with a dot or an underscore; nothing if it is gone."""
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return [f for f in found if f.base_name[0] not in "._"]


def modified(entry: pafs.FileInfo) -> dt.datetime:
    """Whole milliseconds, as the file source has them; the epoch where the store keeps no time."""
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(milliseconds=(entry.mtime_ns or 0) // 1_000_000)


class Prefixes(InputPartition):
    """Folders to list (with what lies below them or without) and their last marks."""

    def __init__(self, folders: list[tuple[str, bool, tuple[int, int] | None]]):
        self.folders = folders


class Listing(DataSourceStreamReader):
    """Each offset is a new look at the folder; the marks that it is compared with are those of the last complete batch."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.state = options["path"], options["state"]
        self.globs, self.depth, self.tasks = patterns(options["glob"]), int(options["depth"]), int(options["tasks"])

    def initialOffset(self) -> dict:
        return {"listing": ""}

    def latestOffset(self) -> dict:
        return {"listing": uuid.uuid4().hex}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        fs, base, _ = located(self.folder)
        marks, level, folders = self.marks(), [base], []
        for _ in range(self.depth):
            folders += [(f, False) for f in level]
            level = [e.path for f in level for e in entries(fs, f) if e.type == pafs.FileType.Directory]
        folders = [(f, below, marks.get(f)) for f, below in [*folders, *((f, True) for f in level)]]
        return [Prefixes(folders[k :: self.tasks]) for k in range(min(self.tasks, len(folders)))]

    def marks(self) -> dict[str, tuple[int, int]]:
        fs, state, _ = located(self.state)
        batch = last_complete(e.base_name for e in entries(fs, f"{state}/seen") if fs.get_file_info(f"{e.path}/_SUCCESS").is_file)
        if batch is None:
            return {}
        files = [e.path for e in entries(fs, f"{state}/marks/{batch}") if e.path.endswith(".parquet")]
        rows = [r for f in files for r in pq.read_table(f, filesystem=fs).to_pylist()]
        return {r["prefix"]: (r["files"], r["mark"]) for r in rows}

    def walk(self, fs: pafs.FileSystem, folder: str, below: bool) -> Iterator[pafs.FileInfo]:
        left = [folder]
        while left:
            for e in entries(fs, left.pop()):
                if e.type == pafs.FileType.Directory and below:
                    left.append(e.path)
                elif e.type == pafs.FileType.File and any(fnmatch.fnmatchcase(e.base_name, g) for g in self.globs):
                    yield e

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fs, _, root = located(self.folder)
        for folder, below, known in partition.folders:
            if known:
                seen = (0, 0)
                for e in self.walk(fs, folder, below):
                    seen = counted(seen, e.path)
                if seen == known:
                    continue
            # listed once more if it has a mark, as the names are not held; the mark is of those handed on
            seen = (0, 0)
            for e in self.walk(fs, folder, below):
                seen = counted(seen, e.path)
                yield folder, root + e.path, modified(e), e.size or 0, None, None
            if known or seen != (0, 0):
                yield folder, None, None, None, *seen


def counted(mark: tuple[int, int], path: str) -> tuple[int, int]:
    """A mark with one more name; the order of names does not matter."""
    number, total = mark
    total += int.from_bytes(hashlib.blake2b(path.encode(), digest_size=8).digest(), "little")
    return number + 1, (total + 2**63) % 2**64 - 2**63


def last_complete(batches: Iterable[str]) -> str | None:
    return max((b for b in batches if b.isdigit()), default=None)


class FolderListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return LISTING

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return Listing(self.options)


class FileDiscovery:
    """Files of a folder, each taken once, with limits by number and by bytes for each micro-batch of the stream of contents.

    ``state`` is a shared folder of its own. Sub-folders down to ``depth`` are listed by a task each; a task holds the names of
    one folder at a time. A path is taken once, whatever happens to the file afterwards. A batch that runs again replaces what
    it wrote, unless that was complete; then it is left alone. Files at or above the limits' size make a lot of their own.
    Names that begin with a dot or an underscore are passed over, as by the file source. A folder that is missing or empty has
    no files; one of the files that is gone when its content is read fails the batch.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        state: str,
        glob: str = INTAKE_GLOB,
        max_files: int = MAX_FILES_PER_TRIGGER,
        max_bytes: int | str = "10g",
        depth: int = 1,
    ):
        self.spark, self.folder, self.state, self.glob = spark, folder.rstrip("/"), state.rstrip("/"), glob
        self.max_files, self.max_bytes, self.depth = max_files, parse_bytes(max_bytes), depth

    def arriving(self) -> DataFrame:
        """Look for new files, then give the stream of all that were found, as :func:`binary_file_stream` does."""
        self.discover()
        return self.stream()

    def discover(self) -> None:
        """One listing: new files are added to the table of files seen."""
        self.spark.dataSource.register(FolderListing)
        options = {"state": self.state, "glob": self.glob, "depth": self.depth, "tasks": 4 * self.spark.sparkContext.defaultParallelism}
        LogTable(self.spark, f"{self.state}/seen/created", SEEN).create_if_missing()
        listing = self.spark.readStream.format("folder_listing").options(**options).load(self.folder)
        query = listing.writeStream.foreachBatch(self._take).option("checkpointLocation", f"{self.state}/checkpoint")
        query.trigger(availableNow=True).start().awaitTermination()

    def seen(self, before: str | None = None) -> DataFrame:
        """Files found so far, or by batches before one."""
        folders = [n for n in names(self.spark, f"{self.state}/seen") if before is None or not n.isdigit() or n < before]
        reader = self.spark.read.schema(SEEN).option("recursiveFileLookup", "true")
        return reader.parquet(*[f"{self.state}/seen/{n}" for n in folders])

    def _complete(self) -> list[str]:
        return [n for n in names(self.spark, f"{self.state}/seen") if n.isdigit() and "_SUCCESS" in names(self.spark, f"{self.state}/seen/{n}")]

    def _take(self, listing: DataFrame, number: int) -> None:
        batch, done = f"{number:012d}", self._complete()
        if batch in done:
            return
        ws = Workspace(self.spark, f"{self.state}/work")
        try:
            listing = ws.store(listing, "listing")
            self._mark(listing, last_complete(done), batch)
            self._lots(ws.store(self._new(listing, batch), "new"), batch)
        finally:
            ws.remove()
        # marks of earlier batches are not read again
        for old in names(self.spark, f"{self.state}/marks"):
            if old < batch:
                remove(self.spark, f"{self.state}/marks/{old}")

    def _mark(self, listing: DataFrame, last: str | None, batch: str) -> None:
        """The marks of all sub-folders; they count once the files of the batch are written."""
        marks = listing.where("path IS NULL").select("prefix", "files", "mark")
        if last is not None:
            before = self.spark.read.schema(MARKS).parquet(f"{self.state}/marks/{last}")
            marks = marks.unionAll(before.join(marks, "prefix", "left_anti"))
        marks.write.mode("overwrite").parquet(f"{self.state}/marks/{batch}")

    def _new(self, listing: DataFrame, batch: str) -> DataFrame:
        changed, known = listing.where("path IS NULL").select("prefix"), self.seen(before=batch)
        if changed.count() <= SENT_PREFIXES:
            known = known.join(F.broadcast(changed), "prefix", "left_semi")
        # a file that was moved while its folder was listed may have been met twice
        found = listing.where("path IS NOT NULL").select("prefix", "path", "modificationTime", "length").dropDuplicates(["path"])
        return found.join(known.select("path"), "path", "left_anti").select("prefix", "path", "modificationTime", "length")

    def _lots(self, new: DataFrame, batch: str) -> None:
        """Write the files in lots, one Parquet file each, that keep both limits."""
        files, size = new.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        tasks = max(1, math.ceil(max(files / self.max_files, size / self.max_bytes) / LOTS_PER_TASK))
        most_files, most_bytes = self.max_files, self.max_bytes

        def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            part, lot, held, total = TaskContext.get().partitionId(), 0, 0, 0
            for frame in frames:
                lots = []
                for length in frame["length"]:
                    if held and (held + 1 > most_files or total + length > most_bytes):
                        lot, held, total = lot + 1, 0, 0
                    held, total = held + 1, total + length
                    lots.append(f"{part:06d}-{lot:06d}")
                yield frame.assign(lot=lots)

        dealt = new.repartition(tasks, "path").mapInPandas(cut, f"{SEEN}, lot string")
        dealt.write.mode("overwrite").partitionBy("lot").parquet(f"{self.state}/seen/{batch}")

    def stream(self) -> DataFrame:
        """Files found so far with their contents, a lot in each micro-batch; the checkpoint of the query knows which lots it had."""
        lots = self.spark.readStream.schema(SEEN).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
        lots = lots.option("maxFileAge", "36500d").parquet(f"{self.state}/seen")
        tasks = max(1, min(self.max_files, self.spark.sparkContext.defaultParallelism))
        return lots.drop("prefix").repartition(tasks, "path").mapInArrow(with_contents, BINARY_FILE_SCHEMA)


def with_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files with their bytes."""
    for batch in batches:
        contents, first, held = [], 0, 0
        for k, uri in enumerate(batch["path"].to_pylist()):
            fs, path, _ = located(uri)
            with fs.open_input_stream(path) as file:
                contents.append(file.read())
            held += len(contents[-1])
            if held >= HANDED_BYTES or k + 1 == batch.num_rows:
                rows = batch.slice(first, len(contents))
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in ("path", "modificationTime", "length")), pa.array(contents, pa.binary())],
                    names=["path", "modificationTime", "length", "content"])
                contents, first, held = [], k + 1, 0
