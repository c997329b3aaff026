"""Block-compressed text (many small gzip blocks in one file), read by many tasks.

Spark reads a gzip file in one task. In a block-compressed file every block of up to 64 KB begins with the
same sixteen bytes and tells its size. Spark's text source is asked to end its rows at these bytes, so that
its own ranges of a file become tasks. It would still decompress by the ending of a file's name; so files are
read through a mount table of their own, in which they have names without endings. Each block is checked
for the size it tells, its length and its check sum. Lines reach over blocks and ranges: what a range has before its
first line end and after its last one is put together by the order of ranges.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.session import new_path

#: The head of every block up to its size, and the empty block that ends a file.
HEAD = bytes.fromhex("1f8b08040000000000ff060042430200")
EMPTY = HEAD + bytes.fromhex("1b0003000000000000000000")
#: Text of a block when writing, as bytes; the format allows 64 KB.
BLOCK_BYTES = 65_280
#: Blocks that go to Python at once: at most 64 KB of text each.
BATCH = 256

_WHOLE, _HEAD, _TAIL, _INNER = 0, 1, 2, 3


class BlockError(ValueError):
    """A file that is not made of blocks, or a damaged block."""


def inflate(block: bytes) -> bytes:
    """Text of a block without its head, which tells its size in the first two bytes."""
    if len(block) < 12:
        raise BlockError("a block is cut off")
    text = zlib.decompress(block[2:-8], -15)
    if zlib.crc32(text) != int.from_bytes(block[-8:-4], "little") or len(text) != int.from_bytes(block[-4:], "little"):
        raise BlockError("a block has another check sum or length than it tells")
    return text


class _Range:
    """The lines of one range of a file, block by block."""

    def __init__(self, file: str, start: int) -> None:
        self.file, self.start, self.place = file, start, 0
        self.rest, self.partial, self.began = [], b"", False

    def rows(self, text: bytes) -> list[tuple[int, int, bytes]]:
        """Complete lines of one more block, as ``(place, kind, line)``."""
        *lines, last = text.split(b"\n")
        if not lines:
            self.rest.append(last)
            return []
        lines[0] = b"".join([*self.rest, lines[0]])
        self.rest = [last]
        out = []
        for line in lines:
            out.append((self.place, _WHOLE if self.began else _HEAD, line))
            self.began, self.place = True, self.place + 1
        return out

    def block(self, raw: bytes) -> list[tuple[int, int, bytes]]:
        raw = self.partial + raw
        size = int.from_bytes(raw[:2], "little") + 1 - len(HEAD) if len(raw) > 1 else len(raw) + 1
        if len(raw) < size:
            # The head's bytes occurred inside a block.
            self.partial = raw + HEAD
            return []
        if len(raw) > size:
            raise BlockError(f"no block-compressed file, or a damaged one: {self.file}")
        self.partial = b""
        return self.rows(inflate(raw))

    def close(self) -> list[tuple[int, int, bytes]]:
        if self.partial:
            raise BlockError(f"a block is cut off: {self.file}")
        return [(self.place, _TAIL if self.began else _INNER, b"".join(self.rest))]


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Range | None = None

    def told(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        places, kinds, lines = zip(*rows, strict=True)
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([now.file] * n), pa.array([now.start] * n, pa.int64()), pa.array(places, pa.int64()), pa.array(kinds, pa.int32()), pa.array(lines, pa.binary())],
            ["file", "start", "place", "kind", "line"],
        )

    for batch in batches:
        rows: list[tuple[int, int, bytes]] = []
        for file, start, raw in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
            file, start, raw = file.as_py(), start.as_py(), raw.as_py()
            if now is None or (now.file, now.start) != (file, start):
                if now is not None:
                    yield told([*rows, *now.close()])
                    rows = []
                now = _Range(file, start)
                if start == 0:
                    # What stands before the first head.
                    if raw:
                        raise BlockError(f"no block-compressed file: {file}")
                    continue
            rows += now.block(raw)
        if rows:
            yield told(rows)
    if now is not None:
        yield told(now.close())


def _files(spark: SparkSession, path: str) -> list[str]:
    """Files that a path, folder or pattern names, by path; names with a leading dot or underscore do not count."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(place) or []:
        for one in system.listStatus(status.getPath()) if status.isDirectory() else [status]:
            if one.isFile() and not one.getPath().getName().startswith((".", "_")):
                found.append(one.getPath().toString())
    if not found:
        raise FileNotFoundError(path)
    return sorted(found)


def _raw_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, raw``: what stands between the heads of blocks, as bytes; ``file`` in the order of paths."""
    mount = f"blocks-{uuid.uuid4().hex}"
    names = {f"f{i:09d}": file for i, file in enumerate(_files(spark, path))}
    links = {f"fs.viewfs.mounttable.{mount}.link./{name}": file for name, file in names.items()}
    raw = spark.read.options(encoding="ISO-8859-1", lineSep=HEAD.decode("latin-1"), **links).text([f"viewfs://{mount}/{name}" for name in names])
    return raw.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("raw"))


def read_block_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines (``value``) of block-compressed files, numbered (``ROW_ID``) by file path and place.

    The result is the same as that of the plain scan of these files. Decoded lines are stored in the
    shared folder, as they are read twice: for their number in each range, and for themselves.
    """
    raw = _raw_blocks(spark, path)
    kept, limit = new_path(spark, "block-lines"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, str(BATCH))
    try:
        raw.mapInArrow(_decode, "file string, start bigint, place bigint, kind int, line binary").write.parquet(kept)
    finally:
        spark.conf.set(limit, usual)
    rows = spark.read.parquet(kept)

    # A line begins with the tail of a range and goes on to the first head after it.
    order = Window.partitionBy("file").orderBy("start", "place")
    parts = rows.filter(F.col("kind") != _WHOLE).withColumn("nth", F.count_if(F.col("kind") == _TAIL).over(order))
    ends = F.max(F.col("kind") == _HEAD)
    lines = parts.groupBy("file", "nth").agg(
        F.min(F.struct("start", "place")).alias("at"),
        F.array_sort(F.collect_list(F.struct("start", "place", "line")))["line"].alias("lines"),
        ends.alias("ended"),
    )
    text = F.aggregate("lines", F.lit(b""), lambda a, b: F.concat(a, b))
    # Text without an end of line is a line at the end of a file only.
    lines = lines.select("file", "at.start", "at.place", text.alias("line"), "ended").filter(F.col("ended") | (F.length("line") > 0)).drop("ended")
    # The first part of a range belongs to a line that began before it, but for the first range of a file.
    whole = rows.filter(F.col("kind") == _WHOLE).select("file", "start", "place", "line").unionByName(lines)
    own = F.col("place") - F.when(F.col("start") > 0, 1).otherwise(0)
    counts = whole.groupBy("file", "start").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("file", "start")) - F.col("n")
    placed = whole.join(counts.select("file", "start", before.alias("before")), ["file", "start"])
    # As the plain scan does, an end of line may have two characters.
    value = F.col("line").cast("string")
    return placed.select((F.col("before") + own).alias("ROW_ID"), F.when(F.endswith(value, F.lit("\r")), F.left(value, F.length(value) - 1)).otherwise(value).alias("value"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = bytearray()

    def block(text: bytes) -> bytes:
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(text) + packer.flush()
        ends = zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little")
        return HEAD + (len(HEAD) + 2 + len(body) + 8 - 1).to_bytes(2, "little") + body + ends

    def told(texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block(t) for t in texts], pa.binary())], ["block"])

    for batch in batches:
        full = []
        for line in batch.column(0):
            held += line.as_py() + b"\n"
            while len(held) >= BLOCK_BYTES:
                full.append(bytes(held[:BLOCK_BYTES]))
                del held[:BLOCK_BYTES]
        if full:
            yield told(full)
    if held:
        yield told([bytes(held)])


def write_block_lines(lines: DataFrame, path: str) -> None:
    """Write text lines (``value``) as block-compressed files, one per partition.

    Every block is followed by an empty one, which the format allows anywhere and asks for at the end.
    """
    packed = lines.select(F.coalesce("value", F.lit("")).cast("binary").alias("value")).mapInArrow(_blocks, "block binary").select(F.col("block").cast("string").alias("value"))
    packed.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("latin-1")).text(path)
