"""Checkpointed paged loads (T1-T5) with Structured Streaming.

Landing files (see ``acadlake.sources.landing``) are consumed by a file stream,
``files_per_batch`` files of many pages per micro-batch (``maxFilesPerTrigger``),
more if a run would then need above ``MOST_BATCHES`` batches (each of them rewrites the
buckets it touches, so many small ones would cost the square of the table),
with ``trigger(availableNow=True)``; progress lives in the stream checkpoint, so a
restart resumes after the last committed file and a second run adds nothing.

A page that comes again as it was is dropped on arrival: the stream keeps one
digest a page in a RocksDB state store (``dropDuplicates``), so the state is as
large as the number of pages, not of rows.  What is left goes into a
``KeyedTable``, where of all rows of a key the one of the lowest page stays (T5):
the stored table has one row a key whatever order pages came in, and a batch that
is run again after a failure changes nothing.  Readers therefore shuffle nothing.

The first empty page ends the table.  Pages behind it are not stored; if they came
before it, their rows go when it comes.  The end, the last page and the largest
key are notes in the generation that a batch publishes, so they never disagree
with the rows (T2, T4).

A reset (T3) publishes a new state folder, for table and checkpoint, in the load's
own generations: every process looks it up, so nobody reads or resumes the old one.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.session import cut_lineage
from acadlake.sources.landing import LANDED, PAGE_COL, PAGES_PER_FILE, RANGE_COL, parse_pages, split_pages
from acadlake.sources.paged_source import BODY_COL, PAGES_PER_BATCH, stream_pages
from acadlake.tables.generations import Conflict, Generations
from acadlake.tables.keyed import KeyedTable

EMPTY_COL = "pagina_vazia"
DIGEST_COL = "impressao"
MOST_BATCHES = 8
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


class PagedLoad:
    def __init__(self, spark: SparkSession, landing: str, target: str, checkpoint: str,
                 schema: T.StructType, key: str, keep: Column | None = None, files_per_batch: int = 8, buckets: int = 8):
        self.spark, self.landing, self.target = spark, landing.rstrip("/"), target.rstrip("/")
        self.checkpoint, self.schema, self.key, self.keep = checkpoint.rstrip("/"), schema, key, keep
        self.files_per_batch = files_per_batch      # commit (checkpoint) granularity
        self.buckets = buckets
        self.resets = Generations(spark, self.target)

    # ------------------------------------------------------------------ state
    def _folder(self) -> str:
        """The state folder that counts now, for this process and all others."""
        number, content = self.resets.current()
        if not number:
            try:
                self.resets.publish(0, {"pasta": self.resets.new_folder("estado")})
            except Conflict:            # another process opened the load first: its folder counts
                pass
            content = self.resets.current()[1]
        return content["pasta"]

    def table(self) -> KeyedTable:
        """The stored rows, with their page numbers."""
        schema = T.StructType([T.StructField(PAGE_COL, T.LongType()), *self.schema.fields])
        return KeyedTable(self.spark, f"{self.target}/{self._folder()}", schema, [self.key], self.buckets)

    def reset(self) -> None:
        """Start over for good; Conflict if another process has reset the load meanwhile."""
        self._folder()
        number = self.resets.current()[0]
        self.resets.publish(number, {"pasta": self.resets.new_folder("estado")})

    def _process(self, pages: DataFrame, note: dict | None = None) -> None:
        """Pages -> stored rows; running the same pages again changes nothing."""
        rows = pages.select(PAGE_COL, (F.size("data") == 0).alias(EMPTY_COL), F.explode_outer("data").alias("r"))
        rows = rows.select(PAGE_COL, EMPTY_COL, "r.*")
        if self.keep is not None:
            rows = rows.where(F.col(EMPTY_COL) | self.keep)
        rows = cut_lineage(rows, "paged-batch")
        table = self.table()
        held = table.note()
        came = rows.where(EMPTY_COL).agg(F.min(PAGE_COL)).first()[0]
        ends = [x for x in (came, held.get("fim")) if x is not None]
        end = min(ends) if ends else None
        rows = rows.where(~F.col(EMPTY_COL)).drop(EMPTY_COL)
        if end is not None:
            rows = rows.where(F.col(PAGE_COL) < end)
        top = rows.agg(F.max(PAGE_COL).alias("p"), F.max(self.key).alias("k")).first()
        largest = lambda name, new: max((x for x in (held.get(name), new) if x is not None), default=None)
        notes = {"fim": end, "pagina": largest("pagina", top.p), "chave": largest("chave", top.k)} | (note or {})
        if top.p is not None:
            table.lowest_wins(rows, [PAGE_COL, *[c for c in self.schema.names if c != self.key]], notes)
        elif notes != held:
            table.add_note(notes)
        if end is not None and held.get("pagina") is not None and held["pagina"] >= end:
            self._cut(table, end)

    def _cut(self, table: KeyedTable, end: int) -> None:
        """Remove what was stored from pages behind the end; the notes are taken anew from the rows that stay."""
        behind = table.read().where(F.col(PAGE_COL) >= end).select(self.key)
        stay = table.read().where(F.col(PAGE_COL) < end)
        top = stay.agg(F.max(PAGE_COL).alias("p"), F.max(self.key).alias("k")).first()
        table.delete(behind, {"pagina": top.p, "chave": top.k})

    # ------------------------------------------------------------------ T1 / T3
    def _batch_files(self) -> int:
        """Files of a micro-batch: at least ``files_per_batch``, and all landed files are ``MOST_BATCHES`` batches at most."""
        landed = len(self.spark.read.schema(LANDED).text(self.landing).inputFiles())
        return max(self.files_per_batch, -(-landed // MOST_BATCHES))

    def run(self, reset: bool = False) -> int:
        """Consume every landed file not yet committed; returns the number of batches run."""
        if reset:
            self.reset()
        lines = (self.spark.readStream.format("text").option("maxFilesPerTrigger", self._batch_files())
                 .schema(LANDED).load(self.landing))
        digested = split_pages(lines, self.schema, F.sha2("value", 256).alias(DIGEST_COL))
        fresh = digested.dropDuplicates([PAGE_COL, DIGEST_COL])
        with _setting(self.spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
            query = (fresh.writeStream.foreachBatch(lambda df, _: self._process(df))
                     .option("checkpointLocation", f"{self.checkpoint}/{self._folder()}")
                     .trigger(availableNow=True).start())
            query.awaitTermination()
        return len([p for p in query.recentProgress if p.get("numInputRows", 0) > 0])

    def run_in_order(self, pages_per_batch: int = PAGES_PER_BATCH) -> int:
        """T1 through the ``paged`` data source: pages in order, ``pages_per_batch`` a batch at most, up to the first one
        that has not landed.  Offsets are page numbers; returns the number of batches run.

        A load keeps to one way of reading: its progress is not that of ``run``."""
        place = f"{self.checkpoint}/{self._folder()}"
        pages = stream_pages(self.spark, self.landing, f"{place}-posicao", pages_per_batch)
        ran = []

        def batch(df: DataFrame, number: int) -> None:
            if not df.isEmpty():                # page 0 has not landed
                self._process(parse_pages(df, self.schema, BODY_COL))
                ran.append(number)

        query = pages.writeStream.foreachBatch(batch).option("checkpointLocation", f"{place}-paginas").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return len(ran)

    # ------------------------------------------------------------------ T2
    def run_pages(self, count: int) -> int:
        """Bounded increment in batch mode: the next ``count`` pages after the stored state.

        The state is a note of the generation that holds the rows.  Only the folders of the page range are read.
        Returns the new last page.
        """
        last = self.table().note().get("ultima_pagina", -1)
        lines = self.spark.read.schema(LANDED).text(self.landing).where(
            F.col(RANGE_COL).between((last + 1) // PAGES_PER_FILE, (last + count) // PAGES_PER_FILE))
        page = F.substring_index("value", "\t", 1).cast("bigint")
        lines = lines.where((page > last) & (page <= last + count))
        top = lines.agg(F.max(page)).first()[0]
        if top is None:                      # nothing landed after the stored state
            return last
        when = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        self._process(split_pages(lines, self.schema), {"ultima_pagina": int(top), "atualizado_em": when})
        return int(top)

    def state(self) -> DataFrame:
        """The one-row state of the bounded loads: last page read, largest key, time."""
        note = self.table().note()
        kind = self.schema[self.key].dataType.simpleString()
        return self.spark.createDataFrame([(note.get("ultima_pagina"), note.get("chave"), note.get("atualizado_em"))],
                                          f"ultima_pagina bigint, ultima_chave {kind}, atualizado_em string")

    # ------------------------------------------------------------------ T4
    def high_water(self) -> DataFrame:
        """T4: the largest stored key, from the generation's notes: no row is read."""
        kind = self.schema[self.key].dataType.simpleString()
        return self.spark.createDataFrame([(self.table().note().get("chave"),)], f"ultima_chave {kind}")

    def result(self) -> DataFrame:
        return self.table().read()

    def expire(self, keep_seconds: float, now: float | None = None) -> list[str]:
        """Remove states that a reset superseded more than ``keep_seconds`` ago, and old versions of the current one."""
        gone = self.table().expire(keep_seconds, now)
        return gone + self.resets.expire(keep_seconds, "", lambda c: {c["pasta"], "_geracoes", "_rascunhos"}, now)
