"""WARC archives written and read by Spark, with record boundaries verified as chains.

Archives are split wherever the record magic stands, inside payloads too, so that all byte ranges of a
file are read in parallel. Each piece is a candidate record: its header names the offset where the next
must begin. Pointer jumping from the start of each file (offsets reached after 1, 2, 4, ... records) keeps
the candidates that the chain reaches; the others are payload and are put back into their records.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm.common import store

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
#: Bytes of a file whose chains one task follows.
STRETCH = 4 << 20
DATE = "2024-01-01T00:00:00Z"
# RFC 4648 base32 alphabet: a fixed value.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(sha1: Column) -> Column:
    """Bare upper-case base32 of a hexadecimal SHA-1: eight groups of 20 bits give four letters each."""
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(sha1, group * 5 + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*letters)


def _printable(text: Column) -> Column:
    """Header values stay on their line: control characters are percent-coded."""
    done = text
    for char in ("\r", "\n", "\0"):
        done = F.replace(done, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return done


def with_record_types(pages: DataFrame, page_id: str, html: str, least_bytes: int) -> DataFrame:
    """Add ``payload, payload_bytes, sha, refers_to`` to the pages; ``refers_to`` is null for a response.

    Of payloads of at least ``least_bytes`` that are equal, the largest id is the response. Rows that
    repeat that id are responses too, and so is every row of a group without ids.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    base = pages.select(F.col(page_id).alias("page_id"), F.col("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"),
                        payload.alias("payload"))
    base = base.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1("payload"))
    large = base.filter(F.col("payload_bytes") >= least_bytes)
    groups = large.groupBy("sha", "payload_bytes").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).filter("n > 1")
    groups = store(groups.select(F.col("sha").alias("d"), F.col("payload_bytes").alias("b"), "largest"), "warc-groups")
    met = base.join(groups, (base.sha == groups.d) & (base.payload_bytes == groups.b), "left")
    other = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return met.withColumn("refers_to", F.when(other, F.col("largest"))).drop("d", "b", "largest")


def records(pages: DataFrame, page_id: str = "page_id", html: str = "html", least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """One column ``value``: a record per page as text, without the two line ends behind it."""
    rows = with_record_types(pages, page_id, html, least_bytes)
    revisit = F.col("refers_to").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _printable(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), payload_digest(F.col("sha"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")))),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
    ]
    header = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit(GAP))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    return rows.select(F.concat(header, body).alias("value"))


def write_warc(pages: DataFrame, path: str, compression: str = "gzip", most_records: int = 50_000, **settings) -> None:
    """Write a folder of archives, through Spark's committer.

    Compressed files are read by one task each, so a file holds at most ``most_records`` records;
    files without compression are read in ranges.
    """
    out = records(pages, **settings).write.option("lineSep", GAP).option("compression", compression)
    out.option("maxRecordsPerFile", most_records).text(path)


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """What stands behind each magic, and where: ``file, block, nth, bytes, jump, piece``.

    ``jump`` is the distance from the magic to that of the next record, by the header; null without one.
    """
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("value").alias("piece"),
    )
    header = F.substring_index("piece", GAP, 1)
    length = _field(header, "Content-Length").cast("long")
    jump = len(MAGIC) + F.octet_length(header) + len(GAP) + length + len(GAP)
    whole = F.instr("piece", GAP) > 0
    return raw.withColumn("bytes", F.octet_length("piece").cast("long") + len(MAGIC)).withColumn("jump", F.when(whole, jump))


def _placed(scanned: DataFrame) -> DataFrame:
    """Add ``offset``, where the magic of each piece begins (negative for what stands before the first).

    Lengths are summed per byte range, so a task needs the sums of the ranges and its own range only.
    """
    before = F.sum("all").over(Window.partitionBy("file").orderBy("block")) - F.col("all")
    blocks = scanned.groupBy("file", "block").agg(F.sum("bytes").alias("all")).withColumn("before", before)
    blocks = store(blocks.select(F.col("file").alias("f"), F.col("block").alias("b"), "before"), "warc-ranges")
    run = F.sum("bytes").over(Window.partitionBy("file", "block").orderBy("nth")) - F.col("bytes")
    met = scanned.withColumn("run", run).join(blocks, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return met.withColumn("offset", F.col("before") + F.col("run") - len(MAGIC)).drop("f", "b", "before", "run", "nth", "block")


def _leave(key: tuple[int, int], rows: pd.DataFrame, size: int) -> pd.DataFrame:
    """For each candidate of a stretch, where its chain leaves the stretch (null: it ends inside)."""
    rows = rows.sort_values("offset", ignore_index=True)
    place = {offset: i for i, offset in enumerate(rows.offset.tolist())}
    out: list[int | None] = [None] * len(rows)
    end = (key[1] + 1) * size
    for i in range(len(rows) - 1, -1, -1):
        after = rows.next[i]
        if not pd.isna(after):
            out[i] = int(after) if after >= end else (out[place[int(after)]] if int(after) in place else None)
    return pd.DataFrame({"file": rows.file, "offset": rows.offset, "next": pd.array(out, dtype="Int64")})


def _walk(key: tuple[int, int], rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a stretch on the chain from where it is entered."""
    after = dict(zip(rows.offset.tolist(), rows.next.tolist(), strict=True))
    found = set()
    for at in entries.entry.tolist():
        while at in after and at not in found:
            found.add(at)
            at = after[at] if not pd.isna(after[at]) else None
    return pd.DataFrame({"file": key[0], "offset": sorted(found)}, dtype="int64")


def reached(candidates: DataFrame, size: int | None = None) -> DataFrame:
    """Rows ``(file, offset)`` of ``candidates(file, offset, next)`` on the chains that begin at offset 0.

    Chains inside a stretch of a file are followed by one task, which leaves jumps from stretch to
    stretch. Rounds then double these jumps, so they grow with the logarithm of the size of a file.
    """
    size = size or STRETCH
    stretch = F.floor(F.col("offset") / size).alias("stretch")

    def leave(key: tuple[int, int], rows: pd.DataFrame) -> pd.DataFrame:
        return _leave(key, rows, size)

    leave = candidates.groupBy("file", stretch).applyInPandas(leave, "file long, offset long, next long")
    jump = store(leave.filter("next is not null"), "warc-jump")
    found = store(candidates.filter("offset = 0").select("file", "offset"), "warc-entries")
    while not jump.isEmpty():
        step = found.join(jump, ["file", "offset"]).select("file", "next")
        found = store(found.union(step).distinct(), "warc-entries")
        ahead = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        jump = store(jump.join(ahead, ["file", "next"]).select("file", "offset", F.col("far").alias("next")), "warc-jump")
    entries = found.select(F.col("file").alias("f"), F.col("offset").alias("entry"), F.floor(F.col("offset") / size).alias("s"))
    walked = candidates.groupBy("file", stretch).cogroup(entries.groupBy("f", "s")).applyInPandas(_walk, "file long, offset long")
    return walked


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``header, payload`` of every record of the archives under ``path``.

    The payload is binary and of exactly ``Content-Length`` bytes. A candidate without a length ends its
    chain; what lies behind it in that file is not returned. An empty folder gives no row.
    """
    scanned = _scan(spark, path)
    candidates = _placed(scanned.drop("piece")).filter("offset >= 0")
    candidates = store(candidates.select("file", "offset", (F.col("offset") + F.col("jump")).alias("next")), "warc-candidates")
    chain = reached(candidates)
    mine = chain.select(F.col("file").alias("f"), F.col("offset").alias("o"), F.col("offset").alias("record"))
    owner = candidates.join(mine, (F.col("file") == F.col("f")) & (F.col("offset") == F.col("o")), "left").select("file", "offset", "record")
    owner = store(owner, "warc-owner")
    # Where every candidate is a record the pieces are the records, as scanned. Only the other files are
    # put in order, and only their false candidates are joined to what stands before them.
    torn = store(owner.filter("record is null").select(F.col("file").alias("f")).distinct(), "warc-torn")
    clean = scanned.filter(F.col("jump").isNotNull()).join(torn, F.col("file") == F.col("f"), "left_anti").select("piece")
    order = Window.partitionBy("file").orderBy("offset")
    filled = owner.join(torn, F.col("file") == F.col("f"), "left_semi")
    filled = filled.withColumn("record", F.last("record", ignorenulls=True).over(order)).filter("record is not null")
    filled = store(filled.select(F.col("file").alias("f"), F.col("offset").alias("o"), "record"), "warc-filled")
    parts = _placed(scanned.join(torn, F.col("file") == F.col("f"), "left_semi"))
    parts = parts.join(filled, (F.col("file") == F.col("f")) & (F.col("offset") == F.col("o")))
    joined = F.array_join(F.array_sort(F.collect_list(F.struct("offset", "piece")))["piece"], MAGIC)
    mended = parts.groupBy("file", "record").agg(joined.alias("piece"), F.min_by("jump", "offset").alias("jump"))
    both = clean.unionByName(mended.filter(F.col("jump").isNotNull()).select("piece"))
    both = both.withColumn("header", F.substring_index("piece", GAP, 1))
    start = F.octet_length("header") + len(GAP) + 1
    body = F.col("piece").cast("binary").substr(start.cast("int"), _field(F.col("header"), "Content-Length").cast("int"))
    return both.select("header", body.alias("payload"))


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of archives of :func:`write_warc`.

    Bytes and digest of a revisit are those of the record it refers to.
    """
    number = lambda text: F.regexp_extract(text, r"<urn:page:(-?\d+)>", 1)
    named = lambda field: F.when(number(field) != "", number(field)).cast("long")
    rows = read_warc(spark, path).select(
        named(_field(F.col("header"), "WARC-Record-ID")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        payload_digest(F.sha1("payload")).alias("payload_digest"),
        _field(F.col("header"), "WARC-Type").alias("record_type"),
        named(_field(F.col("header"), "WARC-Refers-To")).alias("refers_to"),
        F.regexp_extract(_field(F.col("header"), "WARC-Payload-Digest"), "sha1:(.*)", 1).alias("said"),
    )
    rows = store(rows, "warc-records")
    responses = rows.filter("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("said"), F.col("payload_bytes").alias("full")
    )
    responses = store(responses.dropDuplicates(["refers_to", "said"]), "warc-responses")
    revisits = rows.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(responses, ["refers_to", "said"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    full = revisits.select(
        "page_id", F.col("full").alias("payload_bytes"), F.col("said").alias("payload_digest"), "record_type", "refers_to"
    )
    return rows.filter("record_type = 'response'").select(*columns).unionByName(full.select(*columns))
