"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from landfall.llm.common import Work
from landfall.paths import remove

STRIP = b" \t\n\x0b\f\r"


def keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """Per line: 128-bit hash of the stripped line with A-Z lower-cased; None for a key under ``min_chars`` code points."""
    found: list[bytes | None] = []
    for line in (text or "").encode().split(b"\n"):
        key = line.strip(STRIP).lower()
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        found.append(xxhash.xxh3_128_digest(key) if long else None)
    return found


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(h, doc_id, text_hash)``: each long line's hash once per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.binary()), ("doc_id", pa.int64()), ("text_hash", pa.int64())])
        for batch in batches:
            hashes, rows = [], []
            for row, text in enumerate(batch["text"]):
                own = set(keys(text.as_py(), min_chars))
                own.discard(None)
                hashes += own
                rows += [row] * len(own)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.binary()), batch["doc_id"].take(rows), batch["text_hash"].take(rows)], schema=schema
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInArrow(run, "h binary, doc_id bigint, text_hash bigint")


@contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """While it lasts, scans of buckets of one file each are known to be sorted, so a merge join sorts them no more."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Runs:
    """Levelled sorted runs of ``(h, n_docs, top_doc)``.

    A batch is added as one sorted run on level 0. ``fanout`` runs of a level are merged into one run of the next,
    so each entry is rewritten once per level and a lookup reads at most ``fanout`` - 1 runs a level. Batches come in
    descending order of document id and never share one, so the largest document of a hash is in the first batch that has it. A
    hash that a run already counts ``enough`` times is settled: later batches leave it out by a merge anti-join with the run.

    Runs are tables bucketed and sorted by hash, into as many buckets as the session shuffles into. A batch is shuffled once into
    these buckets; its anti-joins with all runs, and writing it, move no run and sort none. Only a merge shuffles its runs.
    Their files lie in the shared work folder; the catalogue knows them until ``drop``.
    """

    def __init__(self, work: Work, fanout: int = 4, enough: int = 5):
        if fanout < 2:
            raise ValueError("runs merge by two at least")
        self.work, self.fanout, self.enough, self.levels = work, fanout, enough, []
        self.buckets = int(work.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, df: DataFrame) -> str:
        """A new run; returns its table's name."""
        name = f"line_run_{uuid.uuid4().hex}"
        with sorted_buckets(self.work.spark):
            path = f"{self.work.root}/{name}"
            df.write.bucketBy(self.buckets, "h").sortBy("h").format("parquet").option("path", path).saveAsTable(name)
        return name

    def _total(self, names: list[str]) -> DataFrame:
        """Runs' sums. They are read as plain files: Spark 4.1 can take a union of bucketed scans for co-located and then not zip them."""
        schema = self.work.spark.table(names[0]).schema
        union = self.work.spark.read.schema(schema).parquet(*[f"{self.work.root}/{name}" for name in names])
        return union.groupBy("h").agg(F.sum("n_docs").alias("n_docs"), F.max("top_doc").alias("top_doc"))

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.work.spark.sql(f"DROP TABLE {name}")
            remove(self.work.spark, f"{self.work.root}/{name}")

    def all(self) -> list[str]:
        """The runs' tables, lower levels first."""
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Add the batch's ``(h, doc_id)``, less what the runs have settled."""
        once = lines.select("h", F.coalesce("doc_id", F.lit(-(2**63))).alias("doc")).distinct()
        own = once.groupBy("h").agg(F.count("*").alias("n_docs"), F.max(F.when(F.col("doc") > -(2**63), F.col("doc"))).alias("top_doc"))
        for name in self.all():
            settled = self.work.spark.table(name).filter(F.col("n_docs") >= self.enough)
            own = own.join(settled.select("h").hint("merge"), "h", "left_anti")
        self._put(0, self._write(own))

    def _put(self, level: int, run: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged, self.levels[level] = self.levels[level], []
            total = self._write(self._total(merged))
            self._drop(merged)
            self._put(level + 1, total)

    def frequent(self) -> DataFrame:
        """``(h, top_doc)`` of all hashes counted ``enough`` times."""
        return self._total(self.all()).filter(F.col("n_docs") >= self.enough).select("h", "top_doc")

    def drop(self) -> None:
        self._drop(self.all())
        self.levels = []


def batch_count(n_docs: int, fanout: int) -> int:
    """Two merged runs and one more batch at least, so lookups meet merged runs; one batch more each time the documents double from 2^20 on.

    Every batch reads the runs once, so a number of batches in proportion to the documents would read their square.
    """
    return 2 * fanout + 1 + int(math.log2(1 + n_docs / 2**20))


def dedup_lines(
    work: Work, docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int | None = None, fanout: int = 3
) -> DataFrame:
    """Every row of ``docs`` with its text less repeated lines, ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. Keys of ``min_chars`` code points or
    more that ``min_docs`` documents hold lose all their lines except in the largest doc_id. Counts cover all
    documents; documents enter in ``batches`` (by default as many as ``batch_count`` says) by descending id. Their ranges come from
    approximate quantiles, so only the batches' sizes are approximate. Hashes have 128 bits, so at 10^12 lines a collision is still
    unlikely (about 10^-15). A line on a third of all documents is one partial sum per task and, when lines
    are dropped, a skewed join that Spark splits.

    Null and empty texts are one empty line; a null text stays null. Rows of one doc_id count as one document, and
    all its rows keep or lose a line together; a null id is one more document, smaller than all. However many rows an id or the null id has, what
    a row loses is gathered per text. Columns of ``docs`` with the names of the added ones are replaced. Empty tables give no rows.
    """
    docs = docs.drop("n_lines", "n_dropped")
    n_batches = batch_count(docs.count(), fanout) if batches is None else batches
    shares = [i / n_batches for i in range(1, n_batches)]
    cuts = sorted({int(cut) for cut in docs.approxQuantile("doc_id", shares, 0.01)}) if shares else []
    # Of ids from the largest cut on, batch 0; of ids below all cuts and of the null id, the last.
    batch = F.lit(len(cuts))
    for i, cut in enumerate(cuts):
        batch = F.when(F.col("doc_id") >= F.lit(cut), F.lit(len(cuts) - 1 - i)).otherwise(batch)
    lines = work.keep(line_hashes(docs, min_chars).withColumn("batch", batch), "lines", by=("batch",))
    runs = Runs(work, fanout, min_docs)
    for i in range(len(cuts) + 1):
        runs.add(lines.filter(F.col("batch") == i))
    often = work.keep(runs.frequent(), "often")
    runs.drop()
    lost = lines.join(often, "h").filter(~F.col("doc_id").eqNullSafe(F.col("top_doc")))
    drops = lost.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text_hash")).agg(F.collect_set("h").alias("_drops"))
    same = docs.doc_id.eqNullSafe(drops["_id"]) & (F.xxhash64(docs["text"]) == drops["_text_hash"])
    joined = docs.join(drops, same, "left").drop("_id", "_text_hash")
    kept = [f for f in joined.schema if f.name != "_drops"]
    columns = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(batch["text"], batch["_drops"]):
                text, drop = text.as_py(), drop.as_py()
                n_lines.append((text or "").count("\n") + 1)
                n_dropped.append(0)
                if drop:
                    drop, lines = set(drop), text.split("\n")
                    stay = [line for line, key in zip(lines, keys(text, min_chars)) if key not in drop]
                    n_dropped[-1] = len(lines) - len(stay)
                    text = "\n".join(stay)
                texts.append(text)
            arrays = [pa.array(texts, batch.schema.field("text").type) if c == "text" else batch[c] for c in columns]
            arrays += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n_lines", "n_dropped"])

    schema = joined.select(*columns).schema.add("n_lines", LongType()).add("n_dropped", LongType())
    return joined.mapInArrow(run, schema)
