"""Landed pages as a Spark data source, in batch and as a stream.

``spark.read.format("paged")`` and ``spark.readStream.format("paged")`` give one row a page: its number (``pagina``) and
its body (``corpo``).  A partition is a range of page numbers of one landing folder, read where the task runs, in Arrow
batches of bounded size.

Offsets of the stream are page numbers: ``{"pagina": n}`` means that every page below ``n`` has been delivered.  A batch
takes at most ``pages_per_batch`` pages (admission control) and ends in front of the first page that has not landed yet,
so pages come in order and a late page is waited for, never skipped.  A page that lands again after it was delivered is
not read again.

Options: ``path``, the landing root; ``first`` and ``until``, the page range of a batch read (``until`` exclusive);
``pages_per_partition``; for streams ``pages_per_batch`` and ``position``, a folder beside the stream's checkpoint.  Spark
asks a restarted source for its newest offset before it says where the stream was; the position folder says it: one
empty file, named by the page up to which batches have been planned.

Defined results: an empty or missing root has no pages (a new stream runs one batch without rows); blank lines are
skipped; a line without a page number fails the
read and names its file.
"""

from __future__ import annotations

import io
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

PAGE_COL = "pagina"
BODY_COL = "corpo"
RANGE_FOLDER = "faixa="
PAGES_PER_RANGE = 256           # pages a landing folder holds, see landing.PAGES_PER_FILE
PAGES_PER_BATCH = 2048
BATCH_BYTES = 4 << 20           # text of one Arrow batch, or one page if that is longer


def _files(root: str):
    """(file system, path in it) of a root: a local path or a URI that pyarrow can open."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)", "file:///", root))


def _listed(system, folder: str, recursive: bool = False) -> list:
    from pyarrow import fs

    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=recursive))
    return sorted((f for f in found if not f.base_name.startswith(("_", "."))), key=lambda f: f.path)


def _lines(system, path: str):
    """(page number, body) of a landing file, streamed."""
    with system.open_input_stream(path) as stream:
        for line in io.TextIOWrapper(stream, encoding="utf-8", errors="replace"):
            head, tab, body = line.rstrip("\r\n").partition("\t")
            if not tab and not head.strip():
                continue
            if not tab or not head.isdecimal():
                raise ValueError(f"{path}: a line does not start with a page number and a tab")
            yield int(head), body


class PageRange(InputPartition):
    """Pages ``first`` to ``until`` (exclusive) of one landing folder."""

    def __init__(self, folder: str, first: int, until: int):
        super().__init__((folder, first, until))
        self.folder, self.first, self.until = folder, first, until


class _Pages:
    def __init__(self, options):
        self.root = options["path"]
        self.width = max(1, int(options.get("pages_per_partition", PAGES_PER_RANGE)))

    def ranges(self, first: int, until: int | None) -> list[PageRange]:
        """Partitions over the folders that meet the range; folders outside are not listed further."""
        system, root = _files(self.root)
        out = []
        for folder in _listed(system, root):
            if folder.base_name.startswith(RANGE_FOLDER):
                low = int(folder.base_name[len(RANGE_FOLDER):]) * PAGES_PER_RANGE
                high = low + PAGES_PER_RANGE if until is None else min(until, low + PAGES_PER_RANGE)
                out += [PageRange(folder.path, a, min(a + self.width, high)) for a in range(max(first, low), high, self.width)]
        return out

    def batches(self, part: PageRange | None):
        import pyarrow as pa

        if part is None:                # what Spark reads where there are no partitions
            return
        schema = pa.schema([(PAGE_COL, pa.int64()), (BODY_COL, pa.string())])
        system, _ = _files(self.root)
        numbers, bodies, size = [], [], 0
        for file in _listed(system, part.folder):
            for number, body in _lines(system, file.path):
                if part.first <= number < part.until:
                    numbers.append(number)
                    bodies.append(body)
                    size += len(body)
                    if size >= BATCH_BYTES:
                        yield pa.record_batch([numbers, bodies], schema=schema)
                        numbers, bodies, size = [], [], 0
        if numbers:
            yield pa.record_batch([numbers, bodies], schema=schema)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.pages = _Pages(options)
        self.first = int(options.get("first", 0))
        self.until = int(options["until"]) if options.get("until") is not None else None

    def partitions(self):
        return self.pages.ranges(self.first, self.until)

    def read(self, partition):
        return self.pages.batches(partition)


class PagedStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.pages = _Pages(options)
        self.limit = max(1, int(options.get("pages_per_batch", PAGES_PER_BATCH)))
        self.position = options.get("position")
        if not self.position:
            raise ValueError("the paged stream needs the option position, a folder beside its checkpoint")
        self.planned = None             # pages below this one belong to planned batches
        self.landed = {}                # file -> page numbers, for files of folders not yet passed

    # ------------------------------------------------------------------ where the stream is
    def _planned(self) -> int:
        if self.planned is None:
            system, folder = _files(self.position)
            self.planned = max((int(f.base_name) for f in _listed(system, folder)), default=0)
        return self.planned

    def _plan(self, until: int) -> None:
        if until > self._planned():
            system, folder = _files(self.position)
            system.create_dir(folder, recursive=True)
            system.open_output_stream(f"{folder}/{until:020d}").close()
            self.planned = until

    def commit(self, end: dict) -> None:
        """Position files below the committed page are no longer needed."""
        system, folder = _files(self.position)
        for f in _listed(system, folder)[:-1]:
            if int(f.base_name) < end[PAGE_COL]:
                system.delete_file(f.path)

    # ------------------------------------------------------------------ offsets
    def initialOffset(self) -> dict:
        return {PAGE_COL: 0}

    def latestOffset(self) -> dict:
        """The first page that has not landed, at most ``pages_per_batch`` pages from the last planned one.

        Reads the landed files of that range once (page numbers only are kept)."""
        at = self._planned()
        stop = at + self.limit
        system, root = _files(self.pages.root)
        folders = range(at // PAGES_PER_RANGE, (stop - 1) // PAGES_PER_RANGE + 1)
        held, self.landed = self.landed, {}
        here = set()
        for number in folders:
            before = len(here)
            for file in _listed(system, f"{root}/{RANGE_FOLDER}{number}"):
                key = file.path, file.size
                self.landed[key] = held[key] if key in held else [n for n, _ in _lines(system, file.path)]
                here.update(self.landed[key])
            if len(here) == before:     # a folder without pages ends what can be delivered
                break
        while at < stop and at in here:
            at += 1
        return {PAGE_COL: at}

    def partitions(self, start: dict, end: dict):
        self._plan(end[PAGE_COL])
        return self.pages.ranges(start[PAGE_COL], end[PAGE_COL])

    def read(self, partition):
        return self.pages.batches(partition)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return f"{PAGE_COL} bigint, {BODY_COL} string"

    def reader(self, schema):
        return PagedReader(self.options)

    def streamReader(self, schema):
        return PagedStreamReader(self.options)


def scan_pages(spark: SparkSession, root: str, first: int = 0, until: int | None = None, **options) -> DataFrame:
    """Batch read of pages ``first`` to ``until`` (exclusive)."""
    spark.dataSource.register(PagedSource)
    reader = spark.read.format("paged").option("first", first).options(**options)
    return (reader if until is None else reader.option("until", until)).load(root)


def stream_pages(spark: SparkSession, root: str, position: str, pages_per_batch: int = PAGES_PER_BATCH, **options) -> DataFrame:
    """Stream of pages in order, ``pages_per_batch`` pages a micro-batch at most."""
    spark.dataSource.register(PagedSource)
    return (spark.readStream.format("paged").option("position", position).option("pages_per_batch", pages_per_batch)
            .options(**options).load(root))
