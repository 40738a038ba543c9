"""Exact row elements of XML files that are read in parallel, however large a file is.

Spark's text source cuts files at the row's end tag, ``</tag>``, so a split holds whole fragments. The same letters may
also stand in a comment, in CDATA, in a processing instruction, or end an inner element of the same name; which, no split can
tell from its own text. So each split is first read from every state it may begin in, which gives a map from the state
and depth at its start to those at its end. The maps of a file, one small row per split, are applied in order. Then each
split knows where it begins, and a second scan cuts it exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.session import importable

#: States between fragments. Tags and quoted attributes cannot hold a "<", so no fragment ends within one.
TEXT, COMMENT, CDATA, INSTRUCTION = range(4)
#: Within the internal part of a document type, whose quoted values may hold anything. It must end in a file's first split.
SUBSET, SUBSET_COMMENT, SUBSET_INSTRUCTION, DOUBLE, SINGLE = range(4, 9)
#: What ends a state, and what it leaves to.
CLOSING = {
    COMMENT: (b"-->", TEXT), CDATA: (b"]]>", TEXT), INSTRUCTION: (b"?>", TEXT),
    SUBSET_COMMENT: (b"-->", SUBSET), SUBSET_INSTRUCTION: (b"?>", SUBSET), DOUBLE: (b'"', SUBSET), SINGLE: (b"'", SUBSET),
}
OPENING = {b"<!--": COMMENT, b"<![CDATA[": CDATA, b"<?": INSTRUCTION}
IN_SUBSET = {b"]": TEXT, b"<!--": SUBSET_COMMENT, b"<?": SUBSET_INSTRUCTION, b'"': DOUBLE, b"'": SINGLE}
SUBSET_TOKEN = re.compile(rb"\]|<!--|<\?|\"|'")
DOCTYPE = rb"<!DOCTYPE(?:[^\[>\"']|\"[^\"]*\"|'[^']*')*[\[>]"
ENCODING = re.compile(rb"<\?xml[^>]*?encoding\s*=\s*[\"']([A-Za-z0-9._-]+)[\"']")
#: Encodings in which the markup's letters are single bytes as in ASCII.
ASCII_LIKE = re.compile(r"utf-?8|us-ascii|ascii|latin-?1|(iso|windows|cp)[-_]?(8859[-_]?\d+|125\d)", re.IGNORECASE)
#: Splits that may be broadcast (some 100 MB on an executor); beyond, the second scan's text is shuffled to them.
BROADCAST_SPLITS = 500_000


class Lexer:
    """Finds the row tag's elements in bytes that begin in a given state."""

    def __init__(self, tag: str):
        name = re.escape(tag.encode())
        self.end = f"</{tag}>".encode()
        self.token = re.compile(rb"<!--|<!\[CDATA\[|<\?|" + DOCTYPE + rb"|</" + name + rb"\s*>|<" + name + rb"(?=[\s/>])")
        self.rest = re.compile(rb"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")

    def events(self, data: bytes, state: int) -> Iterator[tuple[int, int, int]]:
        """``(step, start, end)`` of each tag: 1 for a start, -1 for an end, 0 for an empty element; last ``(2, state, 0)``.

        ``data`` is one fragment or several in a row, which gives the same as one by one.
        """
        at = 0
        while True:
            if state == SUBSET:
                token = SUBSET_TOKEN.search(data, at)
                if token is None:
                    break
                at, state = token.end(), IN_SUBSET[token[0]]
                continue
            if state != TEXT:
                closing, after = CLOSING[state]
                found = data.find(closing, at)
                if found < 0:
                    break
                at, state = found + len(closing), after
                continue
            token = self.token.search(data, at)
            if token is None:
                break
            if self.end in token[0][:-1] and token[0].startswith(b"<!"):
                at = token.start() + 1  # a document type beyond its fragment is none
                continue
            at = token.end()
            if token[0] in OPENING:
                state = OPENING[token[0]]
            elif token[0].startswith(b"</"):
                yield -1, token.start(), at
            elif token[0].startswith(b"<!"):
                state = SUBSET if token[0].endswith(b"[") else TEXT
            else:
                # A tag that is not closed within its fragment is broken, and takes the fragment with it.
                stop = data.find(self.end, at) + len(self.end)
                stop = stop if stop >= len(self.end) else len(data)
                rest = self.rest.match(data, at, stop)
                at = rest.end() if rest else stop
                yield int(not (rest and data[at - 2 : at] == b"/>")), token.start(), at
        yield 2, state, 0


class Map:
    """Where a run of fragments leads from one start state: the end state, and the depth ``d`` becomes ``max(d + add, floor)``.

    ``low`` is the least sum of steps on the way: an element open at the start closes if the depth gets to 0.
    """

    def __init__(self, state: int):
        self.state, self.add, self.floor, self.low = state, 0, 0, 0

    def then(self, other: Map) -> None:
        """Go on with the fragments of ``other``, which begins in this one's end state."""
        self.low = min(self.low, self.add + other.low)
        self.floor = max(self.floor + other.add, other.floor)
        self.add, self.state = self.add + other.add, other.state

    @classmethod
    def of(cls, lexer: Lexer, data: bytes, state: int) -> Map:
        found = cls(state)
        if state in CLOSING and CLOSING[state][0] not in data:
            return found
        for step, after, _ in lexer.events(data, state):
            if step == 2:
                found.state = after
            else:
                found.add += step
                found.floor = max(found.floor + step, 0)
                found.low = min(found.low, found.add)
        return found


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """The batch's fragments by split, in order: the first one's row, and the bytes of all."""
    path, block = pc.dictionary_encode(batch["path"]).indices.to_numpy(), batch["block"].to_numpy()
    cuts = np.flatnonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1])) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        if end > start:
            yield int(start), [v or b"" for v in batch["value"].slice(start, end - start).to_pylist()]


def split_maps(text: DataFrame, lexer: Lexer) -> DataFrame:
    """One row per split: bytes, declared encoding, and the map of each start state."""
    names = [f"{part}_{state}" for state in range(4) for part in ("state", "add", "floor", "low")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, maps, size, encoding = None, [], 0, None

        def row() -> pa.RecordBatch:
            values = [*key, size, encoding, *[v for m in maps for v in (m.state, m.add, m.floor, m.low)]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 16]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["path", "block", "file_size", "bytes", "encoding", *names])

        for batch in batches:
            for at, values in runs(batch):
                path, block, length = (batch[c][at].as_py() for c in ("path", "block", "file_size"))
                if key is None or key[:2] != (path, block):
                    if key is not None:
                        yield row()
                    key, maps, size, encoding = (path, block, length), [Map(s) for s in range(4)], 0, None
                    if block == 0:
                        first = values[0][:400]
                        declared = ENCODING.search(first)
                        encoding = declared[1].decode() if declared else "utf-8"
                        if first[:2] in (b"\xff\xfe", b"\xfe\xff") or b"\0" in first:
                            encoding = "utf-16"
                done = 0
                while done < len(values):
                    # From different states one fragment is read at a time: after a few, all lead to the same one.
                    states = {m.state for m in maps}
                    take = 1 if len(states) > 1 else len(values)
                    data = lexer.end.join(values[done : done + take]) + lexer.end
                    done, size = done + take, size + len(data)
                    single = {state: Map.of(lexer, data, state) for state in states}
                    for m in maps:
                        m.then(single[m.state])
        if key is not None:
            yield row()

    ddl = "path string, block bigint, file_size bigint, bytes bigint, encoding string, " + ", ".join(f"{n} bigint" for n in names)
    return text.select("path", "block", "file_size", "value").mapInArrow(run, ddl)


def split_starts(maps: DataFrame) -> DataFrame:
    """``(path, block, state, depth, owner, cut_off, encoding)``: how each split begins.

    ``owner`` is the split in which the element open at the start begins. ``cut_off`` marks the last split of a file
    that ends without the row's end tag, told by its size; of a compressed file, whose size tells nothing, it is false.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        state, depth, owner, found = TEXT, 0, -1, []
        ends = {s: rows[[f"{part}_{s}" for part in ("state", "add", "floor", "low")]].to_numpy() for s in range(4)}
        for n, block in enumerate(rows["block"]):
            found.append((block, state, depth, owner))
            after, add, floor, low = ends[state if state < SUBSET else TEXT][n]
            closed = depth + low <= 0
            depth, state = max(depth + add, floor), after
            owner = -1 if depth == 0 else block if closed else owner
        frame = pd.DataFrame(found, columns=["block", "state", "depth", "owner"])
        frame.insert(0, "path", rows["path"].to_numpy())
        over = rows["bytes"].sum() - rows["file_size"].iat[0]
        frame["cut_off"] = (np.arange(len(frame)) == len(frame) - 1) & (over > 0)
        frame["over"] = over
        frame["encoding"] = rows["encoding"].iat[0]
        return frame

    return maps.groupBy("path").applyInPandas(run, "path string, block long, state int, depth long, owner long, cut_off boolean, over long, encoding string")


class SplitsChanged(RuntimeError):
    """The second scan was cut into other splits than the first."""


def cut_elements(text: DataFrame, lexer: Lexer) -> DataFrame:
    """``(path, mtime, owner, block, whole, element)``: the elements a split holds entirely, and its share of others.

    Rows of ``text`` carry their split's start. A share has the split its element begins in as ``owner``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, depth, owner, held, late = None, TEXT, 0, -1, [], None
        schema = pa.schema([("path", pa.string()), ("mtime", pa.timestamp("us", "UTC")), ("owner", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("element", pa.binary())])

        def fragment(row: dict, data: bytes, out: list[tuple]) -> None:
            nonlocal state, depth, owner, held
            since = 0 if depth else None

            def take(end: int) -> None:
                text = b"".join([*held, data[since:end]])
                held.clear()
                out.append((row["path"], row["mtime"], owner, row["block"], owner == row["block"], encoded(text, row["encoding"])))

            for step, start, end in lexer.events(data, state):
                if step == 2:
                    state = start
                elif step == 0:
                    if depth == 0:
                        since, owner = start, row["block"]
                        take(end)
                        since = None
                elif step == 1:
                    if depth == 0:
                        since, owner = start, row["block"]
                    depth += 1
                elif depth:
                    depth -= 1
                    if depth == 0:
                        take(end)
                        since = None
            if depth:
                held.append(data[since:])

        def leave(row: dict, out: list[tuple]) -> None:
            """What is open at a split's end is this split's share of an element."""
            if held:
                out.append((row["path"], row["mtime"], owner, row["block"], False, encoded(b"".join(held), row["encoding"])))
                held.clear()

        def encoded(text: bytes, encoding: str) -> bytes:
            return text if encoding.lower() in ("utf-8", "utf8") else text.decode(encoding, "replace").encode()

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            out: list[tuple] = []
            for at, values in runs(batch):
                first = {c: batch[c][at].as_py() for c in ("path", "mtime", "block", "state", "depth", "owner", "cut_off", "over", "encoding")}
                path, block, start, at_depth, of = (first[c] for c in ("path", "block", "state", "depth", "owner"))
                row = {c: first[c] for c in ("path", "mtime", "block", "cut_off", "over", "encoding")}
                if late is not None:
                    last, data = late
                    same = key == (path, block)
                    fragment(last, data + lexer.end if same or not last["cut_off"] else (data + lexer.end)[: -last["over"]], out)
                    if not same:
                        leave(last, out)
                if key != (path, block):
                    if start is None:
                        raise SplitsChanged(f"{path} is read in other splits than before")
                    key, state, depth, owner = (path, block), start, at_depth, of
                late = row, lexer.end.join(values)
            yield batch_of(out)
        if late is not None:
            out, (last, data) = [], late
            fragment(last, (data + lexer.end)[: -last["over"]] if last["cut_off"] else data + lexer.end, out)
            leave(last, out)
            yield batch_of(out)

    return text.mapInArrow(run, "path string, mtime timestamp, owner bigint, block bigint, whole boolean, element binary")


def exact_elements(
    spark: SparkSession, path: str | list[str], tag: str, work: str, broadcast_splits: int = BROADCAST_SPLITS, **options: str
) -> tuple[DataFrame, int]:
    """``(element, SourceFileName, SourceFileTime)``, and how many files were listed: the text of each outermost ``tag`` element, staged below ``work``.

    Comments, CDATA, processing instructions, attributes with ">" and inner elements of the same name are told apart from
    row elements. In a broken document only the broken element is lost; one that a file ends in is returned as it is.
    Files may be in UTF-8 or a single-byte encoding they declare; others raise ``ValueError``, as does a
    document type that does not end in a file's first split. Compressed files are
    read whole by one task each. An end tag without a start is passed over.

    The files are scanned twice: once for the maps of their splits (four numbers per state), once to cut them. An
    element that lies across splits is put together from its shares, and must fit in a row, as any other.
    """
    importable(spark)
    lexer = Lexer(tag)
    scan = spark.read.format("text").schema("value string").option("lineSep", f"</{tag}>").options(**options).load(path)
    meta = F.col("_metadata")
    text = scan.select(
        meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), meta["file_size"].alias("file_size"),
        meta["file_modification_time"].alias("mtime"), F.col("value").cast("binary").alias("value"),
    )
    split_maps(text, lexer).write.parquet(f"{work}/maps")
    split_starts(spark.read.parquet(f"{work}/maps")).write.parquet(f"{work}/starts")
    starts = spark.read.parquet(f"{work}/starts")
    foreign = starts.filter(~F.col("encoding").rlike(f"(?i)^({ASCII_LIKE.pattern})$")).agg(F.min("path"), F.min("encoding")).first()
    late = starts.filter(F.col("state") >= SUBSET).agg(F.min("path")).first()[0]
    if late:
        raise ValueError(f"the document type of {late} is longer than a split; scan it whole")
    if foreign[0]:
        raise ValueError(f"{foreign[0]} is in {foreign[1]}, which cannot be split; scan it whole")
    if starts.count() <= broadcast_splits:
        placed = text.join(F.broadcast(starts), ["path", "block"], "left")
    else:
        numbered = text.withColumn("row", F.monotonically_increasing_id()).join(starts, ["path", "block"], "left")
        placed = numbered.repartition("path", "block").sortWithinPartitions("path", "block", "row")
    columns = ["path", "mtime", "block", "state", "depth", "owner", "cut_off", "over", "encoding", "value"]
    cut_elements(placed.select(columns), lexer).write.parquet(f"{work}/elements")
    cut = spark.read.parquet(f"{work}/elements")
    shares = cut.filter(~F.col("whole")).groupBy("path", "owner").agg(
        F.max("mtime").alias("mtime"), F.array_sort(F.collect_list(F.struct("block", F.col("element").cast("string").alias("text")))).alias("parts")
    )
    together = shares.select(F.concat_ws("", "parts.text").alias("element"), "path", "mtime")
    found = cut.filter("whole").select(F.col("element").cast("string").alias("element"), "path", "mtime").union(together)
    named = found.select("element", F.col("path").alias("SourceFileName"), F.col("mtime").alias("SourceFileTime"))
    return named, len(scan.inputFiles())
