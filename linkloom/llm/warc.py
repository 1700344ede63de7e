"""WARC archives: writing pages as records, and reading archives back by boundary-chain verification.

Writing is a plain text sink whose line separator is the two line ends behind every WARC record. Of equal payloads one page is
stored in full (response), the others refer to it (revisit).

Reading splits archives anywhere. The scan's line separator is the record magic, so that every task emits its
candidates: places where the magic stands, in true records and inside payloads alike. Byte offsets follow from
running sums of segment lengths within an archive; the header in a candidate gives its successor's offset.
Only candidates that can be reached from the start of the archive are records. Reachability is found by pointer
jumping: in round k every pointer covers 2^k steps. Before it, candidates whose successor is the next
candidate are contracted to runs (cut where any other pointer lands), so that the rounds run over the odd places only.
Records whose payload holds the magic are put together again from their segments.

Defined results: null html counts as empty, a null url as no target; a null page_id never becomes the referred page unless
all ids of a payload are null; rows that repeat the response's page_id are responses; an empty table gives an
empty result; an archive that doesn't begin with a record has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import attach_facts, scratch_path, stored

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
#: Records an archive file holds at most.
FILE_RECORDS = 20_000
#: Referred payloads that are broadcast at most; beyond that the pages are shuffled by digest.
BROADCAST_ROWS = 200_000


# --- writing --------------------------------------------------------------------------------------------------------


def with_record_types(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload, bytes, digest, first_id (the page a revisit refers to, else null) of pages (page_id, url, html)."""
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    base = base.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    groups = base.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    facts = stored(groups.where("n > 1"), "warc-equal")
    if facts.count() <= BROADCAST_ROWS:
        told = base.join(F.broadcast(facts.select("digest", "first_id")), "digest", "left")
    else:
        told = attach_facts(base, facts, "digest", "n", pages.count(), ["first_id"])
    own = F.col("page_id").eqNullSafe(F.col("first_id"))
    return told.select("page_id", "url", "payload", "bytes", "digest", F.when(~own, F.col("first_id")).alias("first_id"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; line ends in values can't start a line of their own."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), "[\r\n]", "%0A"), F.lit("\r\n")), F.lit(""))


def record_id(page_id: Column, digest: Column) -> Column:
    """The id of a page's record: reruns agree on it, and a revisit can name the response it refers to."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), F.substring(digest, 1, 32), F.lit(">"))


def records(typed: DataFrame) -> DataFrame:
    """One column, value: the record of each row up to the two line ends that close it."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"), _line("Content-Length", F.col("bytes")), F.lit("\r\n"))
    revisit = F.col("first_id").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(revisit, record_id(F.col("first_id"), F.col("digest")))),
        _line("X-Page-Id", F.col("page_id")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
    )
    return typed.select(F.concat(head, _line("Content-Length", F.octet_length(block)), F.lit("\r\n"), block).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT, file_records: int = FILE_RECORDS) -> None:
    records(with_record_types(pages, least)).write.option("lineSep", END).option("maxRecordsPerFile", file_records).text(path)


# --- reading --------------------------------------------------------------------------------------------------------


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, raw): what stands between magics, in order of place within a file."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))
    return lines.select(F.col("_metadata.file_path").alias("file"), place.alias("place"), F.col("value").cast("binary").alias("raw"))


def _field(head: Column, name: str) -> Column:
    got = F.regexp_extract(head, f"(?im)^{name}:[ \\t]*([^\\r\\n]*)", 1)
    return F.when(got != "", got)


def _parsed(raw: Column) -> dict[str, Column]:
    """What a segment says of itself as a record; raw starts behind the magic."""
    text = raw.cast("string")
    head = F.when(F.contains(text, F.lit(END)), F.substring_index(text, END, 1))
    return {"head_bytes": F.octet_length(head).cast("long"), "block_bytes": F.try_to_number(_field(head, "Content-Length"), F.lit("9999999999999999")).cast("long"), "head": head}


def _content(raw: Column, head_bytes: Column, block_bytes: Column) -> Column:
    """HTTP head and payload of a whole record."""
    block = F.substr(raw, (head_bytes + len(END) + 1).cast("int"), block_bytes.cast("int"))
    http = F.substring_index(block.cast("string"), END, 1)
    payload = F.substr(block, F.octet_length(http) + len(END) + 1)
    return F.struct(_field(http, "Content-Length").cast("long").alias("said_bytes"), F.octet_length(payload).cast("long").alias("bytes"), F.sha2(payload, 256).alias("digest"))


def _offsets(segments: DataFrame, *more: str) -> DataFrame:
    """Adds start: the offset of the magic before a segment; the segment before the first magic of a file goes.

    Every byte of a file is in one segment or one magic, so running sums of lengths are offsets.
    """
    by_place = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("size") + len(MAGIC)).over(by_place), F.lit(0))
    # a segment begins behind its magic; the first of a file has none before it
    return segments.withColumn("start", before - len(MAGIC)).where("start >= 0").select("file", "start", "size", *more)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, size, next, succ, head, whole, content) of every place where the magic stands."""
    raw = _segments(spark, path)
    told = raw.withColumns(_parsed(F.col("raw"))).withColumn("size", F.octet_length("raw").cast("long"))
    need = F.col("head_bytes") + F.col("block_bytes") + 2 * len(END)
    whole = need == F.col("size")
    told = told.select(
        "file", "place", "size", need.alias("need"), "head", F.coalesce(whole, F.lit(False)).alias("whole"), F.when(whole, _content(F.col("raw"), F.col("head_bytes"), F.col("block_bytes"))).alias("content")
    )
    placed = _offsets(told, "need", "head", "whole", "content")
    following = F.lead("start").over(Window.partitionBy("file").orderBy("start"))
    return placed.withColumns({"next": following, "succ": F.col("start") + len(MAGIC) + F.col("need")})


def reachable(found: DataFrame) -> DataFrame:
    """The candidates (stored; file, start, next, succ, ...) on the chain from the start of their file."""
    nodes = found.select("file", "start", "next", "succ")
    # pointers to the next candidate, or to the end of the file, are regular; any other may land anywhere
    odd = nodes.where(F.col("succ").isNotNull() & F.col("next").isNotNull() & (F.col("succ") != F.col("next")))
    landed = odd.select(F.col("file").alias("f"), F.col("succ").alias("s")).distinct().withColumn("target", F.lit(True))
    marked = nodes.join(landed, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")), "left")
    by_start = Window.partitionBy("file").orderBy("start")
    regular = F.coalesce(F.lag(F.col("succ") == F.col("next")).over(by_start), F.lit(False))
    heads = marked.select("file", "start", "next", "succ", (F.coalesce("target", F.lit(False)) | ~regular).alias("is_head"))
    run = F.last(F.when(F.col("is_head"), F.col("start")), ignorenulls=True).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    runs_of = stored(heads.select("file", "start", "succ", run.alias("run")), "warc-runs")
    jumps = stored(runs_of.groupBy("file", "run").agg(F.max_by("succ", "start").alias("to")), "warc-jumps")
    reach = stored(jumps.where("run = 0").select("file", "run"), "warc-reach")
    n = reach.count()
    while True:
        moved = reach.join(jumps, ["file", "run"]).where("to IS NOT NULL").select("file", F.col("to").alias("run"))
        real = moved.join(jumps.select("file", "run"), ["file", "run"], "left_semi")
        more = stored(reach.union(real).distinct(), "warc-reach")
        m = more.count()
        if m == n:
            break
        reach, n = more, m
        twice = jumps.select("file", F.col("run").alias("to"), F.col("to").alias("then"))
        jumps = stored(jumps.join(twice, ["file", "to"], "left").select("file", "run", F.col("then").alias("to")), "warc-jumps")
    chain = runs_of.join(reach, ["file", "run"], "left_semi").select("file", "start")
    return found.join(chain, ["file", "start"], "left_semi")


def _spanning(spark: SparkSession, path: str, chain: DataFrame) -> DataFrame:
    """(file, start, content) of records that the magic in their payload cut: their segments, joined in order.

    ``chain`` has the records (file, start, succ, head, whole) of the files that hold such a one. A segment belongs to the last record that starts before it,
    which one walk over a file's segments carries along.
    """
    raw = _segments(spark, path).join(chain.select("file").distinct(), "file", "left_semi")
    placed = _offsets(raw.withColumn("size", F.octet_length("raw").cast("long")), "raw").select(F.col("file").alias("f"), F.col("start").alias("at"), "raw")
    own = F.struct("start", "succ", "head", "whole").alias("own")
    marked = placed.join(chain.select("file", F.col("start").alias("s"), own), (F.col("f") == F.col("file")) & (F.col("at") == F.col("s")), "left")
    so_far = Window.partitionBy("f").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    parts = marked.select("f", "at", "raw", F.last("own", ignorenulls=True).over(so_far).alias("own"))
    parts = parts.where(~F.col("own.whole") & (F.col("at") < F.col("own.succ"))).select("f", F.col("own.start").alias("start"), F.struct("at", "raw").alias("part"))
    together = parts.groupBy("f", "start").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    glue = F.lit(MAGIC).cast("binary")
    raw = F.aggregate("parts", F.lit(b""), lambda a, p: F.when(F.octet_length(a) == 0, p["raw"]).otherwise(F.concat(a, glue, p["raw"])))
    told = _parsed(F.col("raw"))
    return together.select("f", "start", raw.alias("raw")).select(F.col("f").alias("file"), "start", _content(F.col("raw"), told["head_bytes"], told["block_bytes"]).alias("content"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row a record: file, start, head, content (said_bytes, bytes, digest) of the archives under path."""
    found = stored(candidates(spark, path), "warc-candidates")
    chain = reachable(found)
    files = stored(chain.where("NOT whole").select("file").distinct(), "warc-split")
    whole = chain.where("whole").select("file", "start", "head", "content")
    if files.isEmpty():
        return whole
    near = stored(chain.join(files, "file", "left_semi").select("file", "start", "succ", "head", "whole"), "warc-chain")
    mended = near.where("NOT whole").join(_spanning(spark, path, near), ["file", "start"]).select("file", "start", "head", "content")
    return whole.union(mended)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, intact of every record written by write_archives."""
    head = F.col("head")
    said = F.regexp_extract(_field(head, "WARC-Payload-Digest"), "^sha256:(.*)$", 1)
    kind = _field(head, "WARC-Type")
    response = kind == "response"
    return read_archives(spark, path).select(
        _field(head, "X-Page-Id").cast("long").alias("page_id"),
        F.when(response, F.col("content.bytes")).otherwise(F.col("content.said_bytes")).alias("payload_bytes"),
        F.when(response, F.col("content.digest")).otherwise(said).alias("payload_digest"),
        kind.alias("record_type"),
        F.regexp_extract(_field(head, "WARC-Refers-To"), "^<urn:page:([^:>]*):", 1).cast("long").alias("refers_to"),
        F.when(response, (F.col("content.digest") == said) & (F.col("content.bytes") == F.col("content.said_bytes"))).otherwise(F.col("content.bytes") == 0).alias("intact"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return page_records(spark, path)


QUERIES = {"op5_warc": op5_warc}

ORACLE = {
    "op5_warc": """
WITH base AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM base)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, true AS intact
FROM first
"""
}
