"""WARC archives: written by Spark, read back in parts, with the chain of records verified.

Writing: records with equal payloads of at least ``min_bytes`` bytes are one response and revisits that name it.
A record's bytes are one value of Spark's text writer, whose line separator is the empty line that ends a record.

Reading: an archive is cut into byte ranges, one task each. A task lists every place of its range where a record
could begin (the magic, a header block, a length) with the place where that record would end. Inside a range each
candidate is followed to the first place beyond the range; from range to range, pointer jumping from the file's start keeps
only what the chain reaches. A magic inside a payload starts a candidate, but no chain from the start leads
to it. Each range is then read from its verified entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch
from graphloom.session import shuffle_partitions

# fixed values of the format (WARC 1.1)
MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 100
# bytes of an archive that one task scans
RANGE_BYTES = 8 << 20
# bytes asked for at a time where a header block goes on behind the range
HEADER_BYTES = 1 << 16
# payload bytes handed over at a time
HELD_BYTES = 4 << 20
NO_DATE = "1970-01-01T00:00:00Z"


def lookup(rows: DataFrame, name: str, table: DataFrame, total: int) -> DataFrame:
    """``rows`` with the columns of ``table`` but its ``name`` and ``n``; null where ``table`` has no such ``name``.

    ``table`` has one row per ``name`` and ``n``, the number of ``rows`` (``total`` in all) that have it. Names of more rows
    than an even share of a partition are joined by broadcast: there are fewer of them than partitions.
    """
    share = total / shuffle_partitions(rows.sparkSession)
    values = [c for c in table.columns if c not in (name, "n")]
    hot = table.where(F.col("n") > share).select(F.col(name).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    cold = table.where(F.col("n") <= share).select(F.col(name).alias("_cold"), *[F.col(c).alias(f"_cold_{c}") for c in values])
    marked = rows.join(F.broadcast(hot), F.col(name) == F.col("_hot"), "left")
    # rows of hot names and rows without a name meet nothing, each under a name of its own
    alone = F.concat(F.lit("alone "), F.uuid())
    marked = marked.withColumn("_name", F.when(F.col("_hot").isNull() & F.col(name).isNotNull(), F.col(name)).otherwise(alone))
    joined = marked.join(cold, F.col("_name") == F.col("_cold"), "left")
    return joined.select(*rows.columns, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in values])


def _one_line(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")


def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
                 min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``key, url, payload, digest, kind, refers_to`` per row of ``pages``: what the archive will say.

    ``body`` is text (written as UTF-8) or binary; null is an empty payload. Of rows with equal payloads of ``min_bytes``
    or more, those with the smallest key (null last) are responses, others revisits; rows that repeat the smallest key are
    responses too. Where all keys of a group are null, each is a response.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows = rows.withColumn("group", F.when(F.octet_length("payload") >= min_bytes, F.col("digest")))
    scratch, total = Scratch(pages.sparkSession, "warc-groups"), Observation()
    least = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key")))
    groups = rows.where("group is not null").groupBy("group").agg(F.count(F.lit(1)).alias("n"), least.alias("least"))
    groups = groups.observe(total, F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    groups = scratch.table(groups.where("n > 1").select("group", "n", F.col("least.key").alias("first")))
    told = lookup(rows, "group", groups, total.get["n"])
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    return told.select("key", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"),
                       F.when(revisit, F.col("first")).alias("refers_to"))


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(_one_line(key.cast("string")), F.lit("")), F.lit(">"))


def write_archives(records: DataFrame, folder: str, date: str = NO_DATE) -> None:
    """``records`` of ``page_records`` as archives below ``folder``, one file a partition. A revisit has no block."""
    revisit = F.col("kind") == "revisit"
    block = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.col("kind")),
        field("WARC-Record-ID", _urn(F.col("key"))),
        field("WARC-Date", F.lit(date)),
        F.coalesce(field("WARC-Target-URI", _one_line(F.col("url"))), F.lit("")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(field("WARC-Profile", F.lit(REVISIT_PROFILE)), field("WARC-Refers-To", _urn(F.col("refers_to"))))).otherwise(""),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    # a string of Spark is its bytes: a payload that is no UTF-8 is written as it is
    lines = records.select(F.concat(head.cast("binary"), block).cast("string").alias("value"))
    lines.write.option("lineSep", RECORD_END).text(folder)


def archive_ranges(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, size, part, low, high``: the byte ranges of the archives below ``folder``."""
    files = spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("size")).where("size > 0")
    parts = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(size - 1) div {range_bytes}"))).alias("part"))
    return parts.select("path", "size", "part", (F.col("part") * range_bytes).alias("low"),
                        F.least("size", (F.col("part") + 1) * range_bytes).alias("high"))


class _Archive:
    """Byte ranges of one file, through the file system its address names."""

    def __init__(self, path: str):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)
        self.low, self.data = 0, b""

    def _load(self, low: int, high: int) -> None:
        self.file.seek(low)
        self.low, self.data = low, self.file.read(high - low)

    def bytes(self, low: int, high: int) -> bytes:
        """[low, high), shorter at the file's end; the bytes held are kept for the next call."""
        if low < self.low or high > self.low + len(self.data):
            self._load(low, high)
        return self.data[low - self.low:high - self.low]

    def header(self, at: int, size: int) -> tuple[dict[bytes, bytes], int, int] | None:
        """Fields of the record at ``at``, where its block begins and its length; None where none can begin."""
        gap = HEADER_BYTES
        while True:
            if self.low <= at < self.low + len(self.data):
                found = self._fields(at - self.low)
                if found is not False:
                    return found
                if self.low + len(self.data) >= size:
                    return None
            self._load(at, min(size, at + gap))  # the header block goes on behind the bytes held
            gap *= 4

    def _fields(self, at: int) -> tuple[dict[bytes, bytes], int, int] | None | bool:
        """``header`` in the bytes held; False where they end before the header block does."""
        data, fields = self.data, {}
        if len(data) - at < len(MAGIC):
            return False
        if not data.startswith(MAGIC.encode(), at):
            return None
        at += len(MAGIC)
        while True:
            end = data.find(b"\r\n", at)
            if end < 0:
                return False
            if end == at:
                break
            name, colon, value = data[at:end].partition(b":")
            if not colon:
                return None
            fields[name.strip().lower()] = value.strip()
            at = end + 2
        length = fields.get(b"content-length", b"")
        return (fields, self.low + end + 2, int(length)) if length.isdigit() else None


def candidates(ranges: DataFrame) -> DataFrame:
    """``path, part, at, next, exit``: places where a record could begin, the place behind that record, and the
    first place beyond the range on the chain from ``at`` (null where the chain ends at no candidate).

    A candidate has the magic, a header block whose lines are all fields, a length, and the record's end where the
    length says, all within the file.
    """

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        magic, end = MAGIC.encode(), RECORD_END.encode()
        for part in parts:
            for row in part.to_pylist():
                archive, size, low, high = _Archive(row["path"]), row["size"], row["low"], row["high"]
                data = archive.bytes(low, min(size, high + len(magic) - 1))
                spots, at = [], data.find(magic)
                while at >= 0:
                    spots.append(low + at)
                    at = data.find(magic, at + 1)
                found = {}
                tails = _Archive(row["path"])
                for spot in spots:
                    head = archive.header(spot, size)
                    if head is None:
                        continue
                    close = head[1] + head[2]
                    if close + len(end) > size:
                        continue
                    inside = close >= low and close + len(end) <= low + len(data)
                    last = data[close - low:close - low + len(end)] if inside else tails.bytes(close, close + len(end))
                    if last == end:
                        found[spot] = close + len(end)
                exits = {}
                for spot in reversed(found):  # successors lie behind
                    to = found[spot]
                    exits[spot] = to if to >= high else exits.get(to)
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([row["path"]] * len(found), pa.string()), "part": pa.array([row["part"]] * len(found), pa.int64()),
                    "at": pa.array(list(found), pa.int64()), "next": pa.array(list(found.values()), pa.int64()),
                    "exit": pa.array([exits[s] for s in found], pa.int64())})

    return ranges.mapInArrow(scan, "path string, part bigint, at bigint, next bigint, exit bigint")


def reached(starts: DataFrame, jumps: DataFrame, scratch: Scratch) -> DataFrame:
    """``path, at`` of all places that the chains ``jumps (path, at, exit)`` lead to from ``starts (path, at)``,
    the starts included, by pointer jumping: round k doubles the length of every jump."""
    known, total = scratch.table(starts), None
    jumps = scratch.table(jumps.where("exit is not null"))
    while True:
        watch = Observation()
        step = known.join(jumps, ["path", "at"]).select("path", F.col("exit").alias("at"))
        more = scratch.table(known.unionByName(step).distinct().observe(watch, F.count(F.lit(1)).alias("n")))
        scratch.drop(known)
        known = more
        if watch.get["n"] == total:
            scratch.drop(jumps)
            return known
        total = watch.get["n"]
        beyond = jumps.select("path", F.col("at").alias("exit"), F.col("exit").alias("beyond"))
        # where the next jump is missing the chain has ended: such a jump is kept as it is
        double = jumps.join(beyond, ["path", "exit"], "left").select("path", "at", F.coalesce("beyond", "exit").alias("exit"))
        fresh = scratch.table(double)
        scratch.drop(jumps)
        jumps = fresh


def verified_entries(ranges: DataFrame, scratch: Scratch) -> DataFrame:
    """``path, size, high, entry``: for each range that a record begins in, the first such record's place.

    ``entry`` is null, in one row a file, where the chain from the file's start breaks before the file's end.
    """
    found = scratch.table(candidates(ranges))
    starts = ranges.where("part = 0").select("path", F.col("low").alias("at"))
    wanted = starts.unionByName(found.where("exit is not null").select("path", F.col("exit").alias("at"))).distinct()
    jumps = found.join(wanted, ["path", "at"], "left_semi").select("path", "at", "exit")
    places = reached(starts, jumps, scratch)
    scratch.drop(found)
    ends = ranges.groupBy("path", "size").agg(F.max("high").alias("high"))
    closed = places.select("path", F.col("at").alias("size"))
    broken = ends.join(closed, ["path", "size"], "left_anti").select("path", "size", "high", F.lit(None).cast("bigint").alias("entry"))
    inside = (places.withColumnRenamed("at", "entry").join(ranges, "path").where("entry >= low and entry < high")
              .select("path", "size", "high", "entry"))
    return inside.unionByName(broken)


def read_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, at, kind, record_id, url, digest, refers_to, payload`` of every record of the archives below ``folder``.

    ``refers_to`` and ``record_id`` are the names without ``<urn:record:`` and ``>``, ``digest`` is as the header says, without
    ``sha256:``. An archive whose records do not lead from its first byte to its last is an error: a record was cut
    off or damaged. Empty files and empty folders have no records.
    """
    scratch = Scratch(spark, "warc-read")
    ranges = scratch.table(archive_ranges(spark, folder, range_bytes))
    entries = scratch.table(verified_entries(ranges, scratch))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                path, at, size, high = row["path"], row["entry"], row["size"], row["high"]
                if at is None:
                    raise ValueError(f"{path}: the records do not lead to the end of the archive")
                archive, held, rows = _Archive(path), 0, []
                archive.bytes(at, high)
                while at < high:
                    head = archive.header(at, size)
                    if head is None:
                        raise ValueError(f"{path}: no record at byte {at}")
                    fields, begin, length = head
                    get = lambda name: (lambda v: None if v is None else v.decode("utf-8", "replace"))(fields.get(name))
                    rows.append((path, at, get(b"warc-type"), _plain(get(b"warc-record-id")), get(b"warc-target-uri"),
                                 (get(b"warc-payload-digest") or "").removeprefix("sha256:") or None,
                                 _plain(get(b"warc-refers-to")), archive.bytes(begin, begin + length)))
                    held += length + HEADER_BYTES // 64
                    at = begin + length + len(RECORD_END)
                    if held > HELD_BYTES:
                        yield _batch(rows)
                        held, rows = 0, []
                if rows:
                    yield _batch(rows)

    # the list of ranges is short and each is a task's work
    spread = entries.repartition(shuffle_partitions(spark), "path", "entry")
    return spread.mapInArrow(read, RECORDS)


RECORDS = "path string, at bigint, kind string, record_id string, url string, digest string, refers_to string, payload binary"


def _plain(name: str | None) -> str | None:
    return None if name is None else name.removeprefix("<urn:record:").removesuffix(">")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def resolved(records: DataFrame) -> DataFrame:
    """``record_id, kind, payload_bytes, payload_digest, refers_to`` of the records of archives: length and SHA-256 of the
    whole payload, a revisit's being those of the response that it names.

    A payload of another digest than its header says, and a revisit whose response is in none of the archives, are errors.
    """
    scratch, total = Scratch(records.sparkSession, "warc-resolved"), Observation()
    revisit = F.col("kind") == "revisit"
    own = F.sha2("payload", 256)
    wrong = F.raise_error(F.concat(F.lit("wrong payload digest in record "), F.col("record_id")))
    light = scratch.table(records.select(
        "record_id", "kind", "refers_to", F.when(~revisit, F.octet_length("payload").cast("bigint")).alias("own_bytes"),
        F.when(revisit | (own == F.col("digest")), F.col("digest")).when(F.col("digest").isNull(), own)
        .otherwise(wrong.cast("string")).alias("payload_digest"),
        # a record id may repeat with another payload: the digest tells which one is meant
        F.concat(F.coalesce(F.when(revisit, F.col("refers_to")).otherwise(F.col("record_id")), F.lit("")), F.lit(" "),
                 F.coalesce("digest", own)).alias("name")))
    named = light.groupBy("name").agg(F.count_if(revisit).alias("n"), F.max("own_bytes").alias("bytes")).where("n > 0")
    named = scratch.table(named.observe(total, F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
    revisits = lookup(light.where(revisit), "name", named, total.get["n"])
    missing = F.raise_error(F.concat(F.lit("no response for the revisit "), F.col("record_id")))
    sizes = F.coalesce("bytes", missing.cast("bigint"))
    columns = ["record_id", "kind", "payload_bytes", "payload_digest", "refers_to"]
    return (light.where(~revisit).withColumnRenamed("own_bytes", "payload_bytes").select(columns)
            .unionByName(revisits.withColumn("payload_bytes", sizes).select(columns)))


# what the archives of ``pages`` must say, by plain grouping
PAGES_SQL = f"""
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
ranked AS (
  SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS named FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN named IS NOT NULL AND page_id IS DISTINCT FROM named THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM named THEN named END AS refers_to
FROM ranked
"""
