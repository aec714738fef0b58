"""WARC archives: writing pages with revisit records, and reading back only records that the chain from the file start reaches."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adloom.llm.common import stored

#: Fixed values of the format.
MAGIC, BLANK = "WARC/1.0\r\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Base32 of the SHA-1: five hexadecimal digits are four characters."""
    digits = F.sha1(payload)
    groups = [F.conv(F.substring(digits, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    chars = [F.substring(F.lit(BASE32), F.shiftright(g, s).bitwiseAND(31) + 1, F.lit(1)) for g in groups for s in (15, 10, 5, 0)]
    return F.concat(*chars)


def _wire(uri: Column) -> Column:
    """A target URI without line breaks and blanks that would end its header."""
    return F.replace(F.replace(F.replace(uri, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(" "), F.lit("%20"))


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", least_revisit: int = 0) -> None:
    """Writes a record for every row of `pages` (page_id, url, payload binary) into archives below `path`.

    Of rows with equal payloads of at least `least_revisit` bytes the one with the smallest page_id is a response and the others are
    revisits of it; smaller payloads are all responses. Null payloads are empty; a null url gives no target header; rows that repeat
    id and payload are written alike; a null page_id comes after all others. Which payloads are equal is decided by SHA-256 on a narrow
    table first. Only then are rows joined with the few groups that have copies; both sides are exchanged, so a hot payload can be split.
    """
    payload = F.coalesce(F.col("payload"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("same", F.sha2("payload", 256))
    groups = rows.select("page_id", "same", F.octet_length("payload").alias("size")).where(F.col("size") >= least_revisit)
    groups = groups.groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = stored(groups.select("same", "first"), "warc-groups")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda i: F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(">\r\n"))
    size = F.octet_length("payload")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(BLANK))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\nWARC-Date: " + date + "\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), _wire(F.col("url")), F.lit("\r\n"))).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(F.col("payload")), F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), urn(F.col("first")))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(BLANK),
    )
    # the line writer puts the blank line that ends a record
    rows.join(groups, "same", "left").select(F.concat(head, http, body).alias("value")).write.option("lineSep", BLANK).text(path)


CANDIDATE = "file string, block bigint, idx bigint, run bigint, local bigint, width bigint, size bigint, kind string, record_id string, refers_to string, target_uri string, digest string, payload_bytes bigint, real_digest string, raw binary"
LENGTH = re.compile(rb"(?i)(?:^|\r\n)content-length:[ \t]*(\d+)")


def record_fields(row: bytes) -> dict | None:
    """What a record says, from the bytes behind its magic: size (of these bytes), kind and so on; None if these are no headers.

    real_digest is null while bytes are missing. payload_bytes of a revisit is what its own HTTP header declares.
    """
    blank = row.find(b"\r\n\r\n")
    found = LENGTH.search(row, 0, blank) if blank >= 0 else None
    if not found:
        return None
    names = {}
    for line in row[:blank].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        names[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    body, size = blank + 4, int(found[1])
    whole = len(row) >= body + size + 4
    block = row[body : body + size]
    at = 0
    if names.get(b"content-type", "").startswith("application/http"):
        at = block.find(b"\r\n\r\n") + 4
        at = at if at >= 4 else len(block)
    payload, declared = block[at:], LENGTH.search(block, 0, at)
    kind = names.get(b"warc-type")
    return {
        "size": body + size + 4, "kind": kind, "record_id": names.get(b"warc-record-id"), "refers_to": names.get(b"warc-refers-to"),
        "target_uri": names.get(b"warc-target-uri"), "digest": names.get(b"warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_bytes": int(declared[1]) if kind == "revisit" and declared else len(payload),
        "real_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if whole else None, "payload": payload,
    }


def _scan(spark: SparkSession, path: str, keep_raw: bool) -> DataFrame:
    """Candidates: every piece of an archive that follows the magic, with its place in its block and the size its headers declare.

    Spark's line reader cuts archives at the magic, over byte ranges, so a large archive is read by many tasks. `local` counts bytes from
    the first piece of the byte range; `run` counts up after each piece that is not exactly one record, so in one run every record but
    the last is followed by the next. The first piece of a file is what stands before the first magic.
    """
    magic = len(MAGIC)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, idx, run_, local = None, 0, 0, 0
        for batch in batches:
            out = {f.split(" ")[0]: [] for f in CANDIDATE.split(", ")}
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != here:
                    here, idx, run_, local = (file, block), 0, 0, 0
                first = block == 0 and idx == 0
                fields = None if first else record_fields(value)
                width = len(value) + (0 if first else magic)
                row = (fields or {}) | {"file": file, "block": block, "idx": idx, "run": run_, "local": local, "width": width, "raw": value if keep_raw else None}
                if fields:
                    row["size"] = fields["size"] + magic
                for c, x in out.items():
                    x.append(row.get(c))
                idx, local = idx + 1, local + width
                run_ += row.get("size") != width
            text = {"file", "kind", "record_id", "refers_to", "target_uri", "digest", "real_digest"}
            yield pa.record_batch({c: pa.array(x, pa.string() if c in text else pa.binary() if c == "raw" else pa.int64()) for c, x in out.items()})

    rows = spark.read.option("lineSep", MAGIC).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    return rows.mapInArrow(run, CANDIDATE)


def _reached(found: DataFrame) -> DataFrame:
    """file, block, run, entry: the runs that the chain from the file start enters, and the first of their records on it.

    Pointer jumping: each run points to the run that its last record's end lies in. Every round doubles the length of all pointers and
    adds what the reached runs point to, until nothing is added. A pointer holds only if a candidate starts exactly there.
    """
    key = ["file", "block", "run"]
    ends = found.where("size IS NOT NULL").groupBy(*key).agg(F.max_by(F.col("at") + F.col("size"), "idx").alias("end"), F.max("idx").alias("last"))
    ends = ends.join(found.groupBy(*key).agg(F.max("idx").alias("final")), key).where("last = final")
    target = found.select("file", F.col("at").alias("end"), F.col("block").alias("to_block"), F.col("run").alias("to_run"), F.col("idx").alias("entry")).where("end > 0 OR entry > 0")
    jump = stored(ends.join(target, ["file", "end"]).select(*key, "to_block", "to_run", "entry"), "warc-jumps")
    starts = found.where("at = 0 AND size IS NOT NULL").select(*key, F.col("idx").alias("entry"))
    reached = stored(starts, "warc-reached")
    count, before = reached.count(), -1
    to = [F.col("to_block").alias("block"), F.col("to_run").alias("run"), "entry"]
    while count != before:
        further = reached.select(*key).join(jump, key).select("file", *to)
        reached = stored(reached.union(further).distinct(), "warc-reached")
        second = jump.select("file", F.col("block").alias("to_block"), F.col("run").alias("to_run"), F.col("to_block").alias("b"), F.col("to_run").alias("r"), F.col("entry").alias("e"))
        jump = stored(jump.drop("entry").join(second, ["file", "to_block", "to_run"]).select(*key, F.col("b").alias("to_block"), F.col("r").alias("to_run"), F.col("e").alias("entry")), "warc-jumps")
        count, before = reached.count(), count
    return reached


def _owned(found: DataFrame, chain: DataFrame, blocks: DataFrame) -> DataFrame:
    """file, block, idx, at, size, piece: the pieces (`found`) of records that are longer than their first piece, each with its record.

    A piece belongs to the last record that starts at or before it: a running maximum within its block, or else the last start of the blocks
    before, which is one row per block. No piece is compared with more than that.
    """
    starts = chain.select("file", "block", "idx", F.struct("at", "size", "width").alias("start"))
    inner = F.max("start").over(Window.partitionBy("file", "block").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0))
    last = blocks.select("file", "block").join(starts.groupBy("file", "block").agg(F.max("start").alias("last")), ["file", "block"], "left")
    carry = F.max("last").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    held = found.select("file", "block", "idx", "at").join(starts, ["file", "block", "idx"], "left").withColumn("own", inner)
    held = held.join(last.select("file", "block", carry.alias("carry")), ["file", "block"]).withColumn("own", F.coalesce("own", "carry"))
    part = (F.col("own.size") > F.col("own.width")) & (F.col("at") < F.col("own.at") + F.col("own.size"))
    return held.where(part).select("file", "block", "idx", F.col("own.at").alias("at"), F.col("own.size").alias("size"), F.col("at").alias("piece"))


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the archives below `path`: file, at (byte offset), length, kind, record_id, refers_to, target_uri, digest (declared),
    payload_bytes, real_digest (of the payload read; null for revisits) and, if asked for, payload.

    A record counts if the chain of declared lengths from the start of its file leads to it; magic inside payloads does not. Records cut
    off by the end of their file are left out, and so is whatever follows a broken link. A file without magic at its start has none.
    """
    scan = stored(_scan(spark, path, payloads), "warc-candidates")
    blocks = scan.groupBy("file", "block").agg(F.sum("width").alias("width"))
    before = F.coalesce(F.sum("width").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    based = stored(blocks.select("file", "block", before.alias("base")), "warc-blocks")
    found = scan.join(based, ["file", "block"]).withColumn("at", F.col("base") + F.col("local")).where("NOT (block = 0 AND idx = 0)")
    reached = _reached(found)
    chain = stored(found.join(reached, ["file", "block", "run"]).where("idx >= entry AND size IS NOT NULL"), "warc-chain")
    exact = chain.where("size <= width")

    # a payload with magic inside: the record goes on over the pieces that follow it
    longer = chain.where("size > width")
    columns = ["file", "at", F.col("size").alias("length"), "kind", "record_id", "refers_to", "target_uri", "digest", "payload_bytes", F.when(F.col("kind") != "revisit", F.col("real_digest")).alias("real_digest")]

    @F.udf("struct<kind:string,record_id:string,refers_to:string,target_uri:string,digest:string,payload_bytes:bigint,real_digest:string,payload:binary>")
    def fields_of(raw):
        return record_fields(bytes(raw))

    names = ["kind", "record_id", "refers_to", "target_uri", "digest", "payload_bytes", "real_digest", "payload"]
    if payloads:
        exact = exact.withColumn("payload", fields_of("raw")["payload"])
        columns = [*columns, "payload"]
    out = exact.select(*columns)
    if not longer.isEmpty():
        pieces = _owned(found, chain, based)
        texts = _scan(spark, path, True).select("file", "block", "idx", "raw").join(stored(pieces, "warc-pieces"), ["file", "block", "idx"])
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", F.col("raw").cast("string").alias("raw")))), lambda x: x["raw"]), MAGIC)
        whole = texts.groupBy("file", "at", "size").agg(joined.cast("binary").alias("raw")).where(F.octet_length("raw") + len(MAGIC) >= F.col("size"))
        parsed = whole.withColumn("got", fields_of("raw")).select("file", "at", "size", *[F.col(f"got.{n}").alias(n) for n in names])
        out = out.unionByName(parsed.select(*columns))
    return out
