"""WARC archives written and read by many tasks; records found by boundary chains.

Writing. A record is one line of Spark's text writer with CRLF as the line's end, so every task writes one archive file
and no payload passes through Python. Of records with equal payloads one holds the payload, the others revisit it.

Reading. Spark's text reader cuts the files wherever the magic stands, also inside payloads, and each task adds up the
bytes of its pieces, so a piece's place in its file is known once the tasks' sums are put together. Each piece is a
candidate: its header tells where its successor would begin. Starting with the piece at the start of the file, pointer
jumping doubles the stretch of the chain in each round; candidates it never reaches are payload and join the record
they stand in.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import query, stored, table
from tallyworks.session import shared_folder

#: Fixed value: what a record begins with.
MAGIC = "WARC/1.1\r\n"
#: A fixed day: archives of equal rows are equal.
DATE = "2026-01-01T00:00:00Z"
#: Repeated payloads or blocks of files that may be broadcast (about 100 MB), and pages in an archive file at most.
SMALL, PER_FILE = 1_000_000, 50_000
LENGTH, HEADER_END = re.compile(rb"(?:^|\r\n)Content-Length: (\d+)\r\n", re.I), b"\r\n\r\n"


def base32(sha1: Column) -> Column:
    """Base32 of a SHA-1 given in hexadecimal: ten digits are eight letters; the other alphabet's digits are replaced."""
    parts = [F.lpad(F.conv(F.substring(sha1, i * 10 + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def header_safe(value: Column) -> Column:
    """A header value in one line: control characters, percent signs and outer blanks as percent codes, null empty."""
    out = F.replace(F.coalesce(value, F.lit("")), F.lit("%"), F.lit("%25"))
    for c, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        out = F.replace(out, F.lit(c), F.lit(code))
    return out


def records(pages: DataFrame, key: str, url: str, html: str, least: int) -> DataFrame:
    """(line) of each page: its record without the last CRLF."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    # Only payloads that stand more than once are joined; where they are too many to broadcast, the join can split a hot
    # payload's rows, as its side is read from a table.
    firsts = stored(rows.groupBy("sha1", "bytes").agg(F.min("id").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times"), "firsts")
    if firsts.count() <= SMALL:
        firsts = F.broadcast(firsts)
    rows = rows.join(firsts, ["sha1", "bytes"], "left")
    revisit = (F.col("bytes") >= least) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def urn(id_: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), id_.cast("string"), F.lit(">"))

    head = F.concat(F.lit(MAGIC), line("WARC-Type", kind), F.coalesce(line("WARC-Record-ID", urn(F.col("id"))), F.lit("")),
                    line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", header_safe(F.col("url"))),
                    line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
                    F.when(revisit, line("WARC-Refers-To", urn(F.col("first")))).otherwise(F.lit("")),
                    line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))), F.lit("\r\n"))
    return rows.select(F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")), F.lit("\r\n")).alias("value"))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> None:
    """Writes the pages as compressed WARC files, at least one a task, to a new folder.

    Among pages with equal payloads of at least `least` bytes those with the smallest key are responses (rows that
    repeat it are one page), the others revisits without a payload. A null payload is empty, a null url an empty header;
    a null key has no record id, never is the smallest, and its page is a response where no other key is known.
    """
    (records(pages, key, url, html, least).write.option("lineSep", "\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", PER_FILE).text(folder))


PARSED = {"page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(),
          "payload_digest": pa.string(), "payload": pa.binary()}
PARSED_SQL = ("page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, payload binary")


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record in the files of a folder, compressed or not: file, start, page_id, record_type, refers_to, url,
    payload_bytes, payload (null if not asked for), and payload_digest: the SHA-1 of a response's payload as read, of a
    revisit the one it states.

    What the chain from a file's start does not reach is no record: bytes before it, and what follows a broken header.
    A record that is one piece is parsed where it is read. Only pieces that may be part of a longer record are kept as
    bytes until the chain is known: those that begin before the end that an earlier header asks for, and those of later
    blocks of a file that is read in blocks.
    """
    pieces = (spark.read.option("lineSep", MAGIC).text(folder)
              .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")))
    mark = len(MAGIC)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[tuple[str, int], list[int]] = {}  # end of the last piece of a block, and the end asked for so far
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("until", "size", "asks", "value")}
            found: dict[str, list] = {c: [] for c in PARSED}
            for f, block, value in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), b.column("value")):
                v = value.as_py()
                seen = at.setdefault((f, block), [0, 0])
                start = seen[0] - mark
                seen[0] += len(v) + mark
                end = v.find(HEADER_END)
                m = LENGTH.search(v, 0, end + 2) if end >= 0 else None
                asks = mark + end + 4 + int(m[1]) + 4 if m else None
                whole = asks == len(v) + mark
                if not whole:
                    seen[1] = max(seen[1], start + (asks or 0))
                for c, x in parsed(v, payloads).items() if whole else ((c, None) for c in PARSED):
                    found[c].append(x)
                for c, x in (("until", seen[0]), ("size", len(v)), ("asks", asks), ("value", v if not whole or block or start < seen[1] else None)):
                    out[c].append(x)
            types = {"value": pa.binary()}
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block")] + [pa.array(v, types.get(c, pa.int64())) for c, v in out.items()]
                                             + [pa.array(v, PARSED[c]) for c, v in found.items()], names=["file", "block", *out, *found])

    pieces = stored(pieces.mapInArrow(measure, f"file string, block long, until long, size long, asks long, value binary, {PARSED_SQL}"), "pieces")
    # A block begins where the pieces of the blocks before it end; the reader gives each piece to one block.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("file", "block").agg(F.max("until").alias("all")).withColumn("base", F.coalesce(F.sum("all").over(before), F.lit(0)))
    blocks = stored(blocks.select("file", "block", "base"), "blocks")
    if blocks.count() <= SMALL:
        blocks = F.broadcast(blocks)
    # The piece before the first magic is empty; a piece's record would start with the magic before it.
    start = F.col("base") + F.col("until") - F.col("size") - 2 * mark
    placed = pieces.join(blocks, ["file", "block"]).withColumn("start", start).where("start >= 0")
    slim = stored(placed.select("file", "start", (F.col("start") + F.col("asks")).alias("next"), (F.col("asks") == F.col("size") + mark).alias("whole")), "candidates")
    kept = chain(slim.select("file", "start", "next"))
    # A piece that the chain does not reach belongs to the record before it, found by running maxima over the small rows.
    owner = F.max("own").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    owners = (slim.join(kept.withColumn("own", F.col("start")), ["file", "start"], "left").withColumn("owner", owner).where("owner is not null"))
    one = placed.join(owners.where("whole and start = owner").select("file", "start"), ["file", "start"], "left_semi")
    broken = owners.where("not coalesce(whole, false) and start = owner").select("file", "owner")
    more = owners.join(broken, ["file", "owner"], "left_semi").select("file", "start", "owner")
    parts = (placed.where("value is not null").select("file", "start", "value").join(more, ["file", "start"])
             .groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts")))
    body = F.expr("aggregate(slice(parts, 2, size(parts)), parts[0].value, (a, p) -> concat(a, unhex('%s'), p.value))" % MAGIC.encode().hex())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [parsed(r.as_py(), payloads) for r in b.column("record")]
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("start")] + [pa.array([r[c] for r in rows], t) for c, t in PARSED.items()],
                                             names=["file", "start", *PARSED])

    joined = parts.select("file", F.col("owner").alias("start"), body.alias("record")).mapInArrow(parse, f"file string, start long, {PARSED_SQL}")
    return one.select("file", "start", *PARSED).union(joined)


def parsed(record: bytes, payloads: bool) -> dict:
    """Headers and payload of a record without its magic."""
    end = record.find(HEADER_END)
    head = dict(h.split(": ", 1) for h in record[:end].decode("utf-8", "replace").split("\r\n") if ": " in h)
    body = record[end + 4:end + 4 + int(LENGTH.search(record, 0, end + 2)[1])]
    kind = head.get("WARC-Type")
    digest = head.get("WARC-Payload-Digest", "").removeprefix("sha1:") if kind == "revisit" else base64.b32encode(hashlib.sha1(body).digest()).decode()
    return {"page_id": number(head.get("WARC-Record-ID")), "record_type": kind, "refers_to": number(head.get("WARC-Refers-To")),
            "url": plain(head.get("WARC-Target-URI", "")), "payload_bytes": len(body), "payload_digest": digest, "payload": body if payloads else None}


def number(urn: str | None) -> int | None:
    """The page's id in a record id that this module wrote; of other ids null."""
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def plain(url: str) -> str:
    """What header_safe made safe."""
    return re.sub("%(25|0D|0A|09|20)", lambda m: chr(int(m[1], 16)), url)


def resolved(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: revisits with the size of the payload they refer to."""
    found = stored(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "records")
    full = (found.where("record_type = 'response'").groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("full"))
            .withColumnRenamed("page_id", "refers_to"))
    again = found.where("record_type = 'revisit'").join(full, ["refers_to", "payload_digest"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return found.where("record_type = 'response'").select(columns).union(again.withColumn("payload_bytes", F.col("full")).select(columns))


def chain(candidates: DataFrame) -> DataFrame:
    """(file, start) of the candidates (file, start, next) that the chain from start 0 reaches, by pointer jumping.

    Each round knows the records reached in the first 2^i steps and every candidate's successor 2^i steps on; reached
    records' far successors join the reached ones, and the pointers are doubled.
    """
    reached = candidates.where("start = 0").select("file", "start")
    jump = candidates.where("next is not null").select("file", "start", "next")
    while True:
        more = (reached.join(jump, ["file", "start"]).select("file", F.col("next").alias("start"))
                .join(candidates.select("file", "start"), ["file", "start"], "left_semi"))
        reached = stored(reached.union(more).distinct(), "reached")
        onward = jump.select("file", F.col("start").alias("next"), F.col("next").alias("far"))
        jump = stored(jump.join(onward, ["file", "next"]).select("file", "start", F.col("far").alias("next")), "jump")
        if jump.isEmpty():
            return reached


@query("op9_warc_chain")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    to = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, folder, "pages"), to)
    return resolved(read_archives(spark, to, payloads=False))
