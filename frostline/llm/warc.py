"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

A file is split at every magic ``WARC/1.1``, by byte ranges and in any number of tasks, so each piece begins at a
candidate. A candidate's header gives the offset of its successor. Pointers are doubled within each block of a file, then
from block to block, and only candidates that the chain from the file's start reaches are records; a magic inside a
payload isn't reached, whatever follows it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frostline.session import new_stage_path, stage

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
LEAST_BYTES = 100  # payloads below are never revisited
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for null; control characters are percent-coded."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\x00-\x1F\x7F]", "%0A"), F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``record``: the text of one WARC record per row of ``pages(page_id, url, html)``, without the end of record.

    Of rows with equal payloads of ``LEAST_BYTES`` or more, those with the smallest ``page_id`` are responses and all others
    revisit it. Rows without a ``page_id`` count as largest; if a payload has only such rows all are responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    alike = rows.where(F.octet_length("payload") >= LEAST_BYTES).select("digest", "page_id").groupBy("digest")
    first = stage(alike.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first"))
    both = rows.join(first, "digest", "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit(HTTP), size, F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(MAGIC),
        F.when(again, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), F.uuid(), F.lit(">\r\n")),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        F.when(again, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nX-Refers-To-Page: "), F.col("first").cast("string"), F.lit("\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    return both.select(F.concat(head, block).alias("record"))


def write(pages: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Write an archive folder; files are rolled after ``records_per_file`` records."""
    records(pages).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def _field(name: str) -> Column:
    """A header field's value, null without it."""
    found = F.regexp_extract(F.concat(F.lit("\r\n"), F.col("head")), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic, with its place: ``file, block, id`` in the order of the file, ``len`` in bytes."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.octet_length("value").cast("long").alias("len"),
        "value",
    )


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields of each piece, and ``span``: bytes from its magic to its successor (null without a readable header)."""
    at = F.instr("value", END)
    cut = pieces.withColumn("at", at).withColumn("head", F.when(F.col("at") > 0, F.substring_index("value", END, 1)))
    block_size = F.try_to_number(F.regexp_extract("head", r"(?i)(?:^|\r\n)Content-Length:[ \t]*(\d{1,15})[ \t]*(?:\r\n|$)", 1), F.lit("999999999999999")).cast("long")
    span = F.lit(len(MAGIC)) + F.octet_length("head") + 4 + block_size + 4
    return cut.withColumn("span", span.cast("long"))


def _payload(body: Column) -> Column:
    """Bytes after the HTTP header of a record's block, as a string of the same bytes."""
    at = F.instr(body, END)
    return F.when(at > 0, F.expr("substring(body, instr(body, '\\r\\n\\r\\n') + 4)")).otherwise(F.lit(""))


def _chains(pieces: DataFrame, spark: SparkSession) -> DataFrame:
    """``file, block, id, off, next, real``: each candidate's offset and successor, and whether the chain reaches it."""
    step = F.col("len") + len(MAGIC)
    blocks = pieces.groupBy("file", "block").agg(F.sum(step).alias("bytes"))
    order = Window.partitionBy("file").orderBy("block")
    base = blocks.select("file", "block", (F.sum("bytes").over(order) - F.col("bytes")).alias("base"))
    rows = pieces.select("file", "block", "id", "len", "span").join(base, ["file", "block"])

    def leave(next_at: np.ndarray) -> np.ndarray:
        """For each candidate the last one of its block on its chain, by pointer doubling."""
        jump = np.where(next_at < 0, np.arange(len(next_at)), next_at)
        while (jump[jump] != jump).any():
            jump = jump[jump]
        return jump

    def offsets(table: pa.Table) -> pa.Table:
        t = table.sort_by("id")
        size, span = t["len"].to_numpy() + len(MAGIC), t["span"].to_numpy(zero_copy_only=False)
        off = t["base"][0].as_py() + np.cumsum(size) - size - len(MAGIC)
        nxt = np.where(np.isnan(span.astype(np.float64)), -2, off + np.nan_to_num(span.astype(np.float64)).astype(np.int64))
        nxt = np.where(off < 0, -2, nxt)  # what stands before the first magic of a file
        at = np.searchsorted(off, nxt)
        inside = (at < len(off)) & (off[np.minimum(at, len(off) - 1)] == nxt)
        out = leave(np.where(inside, at, -1))
        return pa.table({"file": t["file"], "block": t["block"], "id": t["id"], "off": off, "next": nxt, "exit": nxt[out]})

    found = stage(rows.groupBy("file", "block").applyInArrow(offsets, "file string, block long, id long, off long, next long, exit long"))
    most = found.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 0
    reached = found.where("off = 0").select("file", "off")
    jump = found.where("off >= 0").select("file", "off", "exit")
    far = 1
    while far < most:  # reached holds the entries of the first ``far`` blocks; each round doubles them
        more = reached.join(jump, ["file", "off"]).select("file", F.col("exit").alias("off"))
        reached = stage(reached.unionByName(more.join(found.select("file", "off"), ["file", "off"], "left_semi")).distinct())
        on = jump.select("file", F.col("off").alias("exit"), F.col("exit").alias("then"))
        jump = stage(jump.join(on, ["file", "exit"], "left").select("file", "off", F.coalesce("then", "exit").alias("exit")))
        far *= 2
    entry = reached.join(found, ["file", "off"]).groupBy("file", "block").agg(F.min("off").alias("entry"))

    def mark(table: pa.Table) -> pa.Table:
        t = table.sort_by("off")
        off, nxt = t["off"].to_numpy(), t["next"].to_numpy()
        at = np.searchsorted(off, nxt)
        inside = (at < len(off)) & (off[np.minimum(at, len(off) - 1)] == nxt) & (nxt >= 0)
        jump = np.where(inside, at, np.arange(len(off)))
        real = off == t["entry"].to_numpy()
        while True:  # doubling: after each round twice as many of the first records are known
            known = real.copy()
            real[jump[known]] = True
            jump = jump[jump]
            if (known == real).all():
                break
        return pa.table({"file": t["file"], "block": t["block"], "id": t["id"], "off": off, "next": nxt, "real": real})

    real = found.join(entry, ["file", "block"]).groupBy("file", "block")
    marked = real.applyInArrow(mark, "file string, block long, id long, off long, next long, real boolean")
    rest = found.join(entry, ["file", "block"], "left_anti").select("file", "block", "id", "off", "next", F.lit(False).alias("real"))
    return stage(marked.unionByName(rest))


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives in ``path``, in no order.

    ``file, offset, record_type, page_id, url, refers_to, payload_bytes, payload_digest``, and ``payload`` (a string of
    the payload's bytes) if asked. Size and digest are taken of the payload read; a revisit record has none and gives
    what its header states. A record behind a broken one isn't reached; an empty folder gives no rows.
    """
    pieces = _parsed(_pieces(spark, path))
    body = F.expr("substring(value, length(head) + 5, length(value) - length(head) - 8)")
    whole = F.octet_length("value") + len(MAGIC) == F.col("span")
    stated_size = F.regexp_extract("body", r"(?i)\r\nContent-Length:[ \t]*(\d+)", 1)
    fields = [
        _field("WARC-Type").alias("record_type"),
        _field("X-Page-ID").cast("long").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("X-Refers-To-Page").cast("long").alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha256:", "").alias("stated_digest"),
    ]

    def content(rows: DataFrame) -> list[Column]:
        got = _payload(F.col("body"))
        revisit = F.col("record_type") == "revisit"
        return [
            F.when(revisit, stated_size.cast("long")).otherwise(F.octet_length(got)).cast("long").alias("payload_bytes"),
            F.when(revisit, F.col("stated_digest")).otherwise(F.sha2(got.cast("binary"), 256)).alias("payload_digest"),
            *([got.alias("payload")] if payloads else []),
        ]

    names = ["record_type", "page_id", "url", "refers_to"]
    cut = pieces.select("file", "block", "id", "len", "span", *fields, F.when(whole, body).alias("body"))
    light = stage(cut.select("file", "block", "id", "len", "span", *names, "stated_digest", *content(cut)))
    chain = _chains(light, spark)
    key = ["file", "block", "id"]
    real = light.join(chain.where("real"), key)
    done = real.where(F.col("span") == F.col("len") + len(MAGIC))
    result = ["file", F.col("off").alias("offset"), *names, "payload_bytes", "payload_digest", *(["payload"] if payloads else [])]
    torn = real.where(F.col("span") != F.col("len") + len(MAGIC)).select("file", "off", *names, "stated_digest", F.col("next").alias("end"), "span")
    # A payload that holds the magic is put together again from its pieces: those of the chain's gaps alone.
    in_block = Window.partitionBy("file", "block").orderBy("off")
    last = chain.withColumn("own", F.last(F.when(F.col("real"), F.col("off")), ignorenulls=True).over(in_block))
    carry = last.groupBy("file", "block").agg(F.max("own").alias("top"))
    carry = carry.withColumn("before", F.max("top").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    owned = last.join(carry.select("file", "block", "before"), ["file", "block"]).select(*key, F.col("off").alias("piece_off"), F.coalesce("own", "before").alias("off"))
    parts = stage(owned.join(torn.select("file", "off"), ["file", "off"], "left_semi"))
    joined = _pieces(spark, path).join(parts, key).groupBy("file", "off").agg(F.sort_array(F.collect_list(F.struct("piece_off", "value"))).alias("all"))
    glued = joined.select("file", "off", F.concat_ws(MAGIC, F.transform("all", lambda x: x["value"])).alias("value"))
    mended = torn.join(glued, ["file", "off"]).withColumn("head", F.substring_index("value", END, 1)).withColumn("body", body)
    mended = mended.where(F.octet_length("value") + len(MAGIC) == F.col("span"))
    return done.select(*result).unionByName(mended.select("file", "off", *names, *content(mended)).withColumnRenamed("off", "offset"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new staged archive and read it back, without payloads."""
    spark = pages.sparkSession
    path = new_stage_path(spark)
    write(pages, path)
    return read(spark, path, payloads=False)
