"""WARC archives with revisit records, and a capture index merged from sorted runs.

``write`` stores one record per row in gzip WARC files.  Of the records with
equal payloads of ``LEAST`` bytes or more, that with the smallest id is a
response and the others are revisits that refer to it.  Each task writes its
records sorted by URL key and time, so a file's index is a sorted run.
``read`` parses the files again: Spark's reader cuts them at the record
separator, and a parser per file puts the stream together by Content-Length.
``merge_runs`` deals the index entries into key ranges of about ``RANGE_ROWS``
and merges the pieces of all runs in each range with a loser tree; ``part``
and ``place`` then order all captures by URL key and time.

Defined cases: a null payload is an empty one.  A null url has no
WARC-Target-URI and an empty URL key; line breaks in a url are percent-escaped.
A null id is never the smallest: such a record is a revisit if an equal
payload has an id, else a response.  Rows that repeat the smallest id are all
responses.  Records with equal keys and times are ordered by id (null first),
then file, then place in it.  Other columns are not read.
"""

from __future__ import annotations

import calendar
import hashlib
import re
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.storage import shared_dir, written

LEAST, RANGE_ROWS, FILE_RECORDS = 100, 200_000, 200_000
BREAK = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Host labels reversed, comma-joined, then ``)`` and the rest, in lower case; empty for null."""
    rest = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[^:/?#]*://", ""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest.substr(F.length(host) + 1, F.length(rest)))
    return F.when(rest == "", "").otherwise(key)


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, seconds: Column) -> DataFrame:
    """``id, key, seconds, value``: each row's whole record but for the final line breaks."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.coalesce(seconds, F.lit(0)).cast("bigint").alias("seconds"))
    rows = rows.withColumns({"n": F.octet_length("payload").cast("bigint"), "digest": F.sha2("payload", 256)})
    # one row for each payload that occurs again; its copies' payloads are joined to it, so it is written first
    again = written(rows.where(F.col("n") >= LEAST).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c"))
                    .where("c > 1 and first is not null").select("digest", "first"), "payloads")
    rows = rows.join(again, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    date = F.expr("replace(cast(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(seconds as decimal(18, 6))) as string), ' ', 'T') || 'Z'")
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(BREAK))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    value = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit\r\n").otherwise("response\r\n"), line("WARC-Record-ID", name(F.col("id"))),
        line("WARC-Date", date), F.coalesce(line("WARC-Target-URI", uri), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("first"))))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
    return rows.select("id", url_key(F.col("url")).alias("key"), "seconds", value.alias("value"))


def write(pages: DataFrame, path: str, seconds: Column, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Gzip WARC files at ``path``, each sorted by URL key, time and id."""
    (records(pages, id_col, url_col, payload_col, seconds).sortWithinPartitions("key", "seconds", "id").select("value")
     .write.option("lineSep", BREAK).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path))


HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


class Stream:
    """Puts one file together from its cut pieces and takes whole records off its front."""

    def __init__(self) -> None:
        self.held, self.need, self.place = bytearray(), 0, 0

    def feed(self, piece: bytes) -> Iterator[tuple[int, dict[bytes, bytes], bytes]]:
        self.held += piece + b"\r\n\r\n"
        at = 0
        while len(self.held) - at >= self.need:
            head = self.held.find(b"\r\n\r\n", at)
            if head < 0 or not self.held.startswith(b"WARC/", at):
                break
            fields = {k.lower(): v for k, v in HEADER.findall(self.held, at, head + 2)}
            end = head + 4 + int(fields[b"content-length"])
            if len(self.held) < end + 4:
                self.need = end + 4 - at                        # nothing is looked for again before that much is there
                break
            yield self.place, fields, bytes(self.held[head + 4:end])
            at, self.need, self.place = end + 4, 0, self.place + 1
        del self.held[:at]

    def end(self) -> None:
        if self.held.strip(b"\r\n"):
            raise ValueError("a WARC file ends inside a record")


def parse_record(fields: dict[bytes, bytes], block: bytes) -> tuple:
    """id, url, seconds, payload bytes, payload digest, type, id referred to, payload (None for a revisit)."""
    def number(name: bytes) -> int | None:
        said = fields.get(name, b"<urn:page:null>")[10:-1]
        return None if said == b"null" else int(said)

    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)[1])
    kind, said = fields[b"warc-type"].decode(), fields[b"warc-payload-digest"].decode().removeprefix("sha256:")
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != said):
        raise ValueError(f"the payload of record {fields[b'warc-record-id'].decode()} is not what its header says")
    uri = fields.get(b"warc-target-uri")
    when = calendar.timegm(time.strptime(fields[b"warc-date"].decode()[:19], "%Y-%m-%dT%H:%M:%S"))
    return (number(b"warc-record-id"), None if uri is None else uri.decode(), when, length, said, kind, number(b"warc-refers-to"),
            payload.decode() if kind == "response" else None)


_RECORD = pa.schema([("run", pa.string()), ("pos", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("seconds", pa.int64()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload", pa.string())])


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record: ``run`` (file) and ``pos`` in it, ids, url, seconds, payload facts and, if asked, the payload."""
    kind = "run string, pos bigint, page_id bigint, url string, seconds bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    schema = pa.schema(list(_RECORD)) if payload else pa.schema(list(_RECORD)[:-1])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, stream = None, Stream()
        for batch in batches:
            rows = []
            for name, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != run:                                 # gzip files are read whole, one after another
                    stream.end()
                    run, stream = name, Stream()
                for place, fields, block in stream.feed(piece):
                    rows.append((run, place, *parse_record(fields, block))[:len(schema)])
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)
        stream.end()

    pieces = spark.read.option("lineSep", BREAK).text(path).select(F.col("_metadata.file_name").alias("run"), F.col("value").cast("binary"))
    return pieces.mapInArrow(parse, kind + (", payload string" if payload else ""))


def merge(runs: list[list]) -> Iterator[tuple[int, int]]:
    """Run and place of each item in the order of all (sorted) runs together, by a loser tree; earlier runs first on ties.

    ``tree[1:]`` holds the loser of each match, ``tree[0]`` the winner; when
    the winner moves on, only the matches on its way up are played again.
    """
    k = len(runs)
    if not k:
        return
    heads, items = [0] * k, [r[0] if r else None for r in runs]

    def beats(a: int, b: int) -> bool:
        if items[a] is None or items[b] is None:
            return items[a] is not None or (items[b] is None and a < b)
        return items[a] < items[b] or (items[a] == items[b] and a < b)

    tree, won = [0] * k, [0] * (2 * k)
    for node in range(2 * k - 1, 0, -1):
        if node >= k:
            won[node] = node - k
        else:
            a, b = won[2 * node], won[2 * node + 1]
            won[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    top = won[1]
    while items[top] is not None:
        yield top, heads[top]
        heads[top] += 1
        items[top] = runs[top][heads[top]] if heads[top] < len(runs[top]) else None
        node = (top + k) // 2
        while node:
            if beats(tree[node], top):
                tree[node], top = top, tree[node]
            node //= 2


def merge_runs(index: DataFrame, rows: int = RANGE_ROWS) -> DataFrame:
    """``index`` (run, pos, key, seconds, page_id, ...) with ``part`` and ``place``: the global order of captures.

    Places within a run are distinct, so any range can be cut and no key,
    however common, has to stay in one task.
    """
    index = written(index, "index")
    ranges = max(1, -(-index.count() // rows))
    names = index.columns

    def of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        own = pa.Table.from_batches(held)
        runs: dict[str, list] = {}
        facts = (own.column(c).to_pylist() for c in ("run", "key", "seconds", "page_id", "pos"))
        for i, (run, key, seconds, page, pos) in enumerate(zip(*facts, strict=True)):
            runs.setdefault(run, []).append((key, seconds, page is not None, page or 0, pos, i))
        pieces = [runs[r] for r in sorted(runs)]
        for p in pieces:
            p.sort(key=lambda x: x[4])                          # shuffled blocks of a run may come in any order
        plain = [[x[:4] for x in p] for p in pieces]
        order = [pieces[r][k][5] for r, k in merge(plain)]
        out = own.take(pa.array(order, pa.int64()))
        out = out.append_column("part", pa.array([TaskContext.get().partitionId()] * len(order), pa.int32()))
        yield from out.append_column("place", pa.array(range(len(order)), pa.int64())).to_batches(50_000)

    kind = ", ".join(f"`{n}` {t}" for n, t in index.dtypes) + ", part int, place bigint"
    return index.repartitionByRange(ranges, "key", "seconds", "page_id", "run", "pos").select(*names).mapInArrow(of_range, kind)


ORACLE_SQL = f"""
with p as (select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as g from pages),
f as (select g, min(page_id) as m from p where n >= {LEAST} group by g)
select page_id, cast(n as bigint) as payload_bytes, g as payload_digest,
       case when m is not null and page_id is distinct from m then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from m then m end as refers_to
from p left join (select g, m, true as big from f) f using (g)
"""


@register("op2_warc", ORACLE_SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back in the order of the merged capture index.

    The table has no capture time; the id counts seconds within the year 2024.
    """
    path = shared_dir(spark, "warc")
    seconds = 1704067200 + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(31536000))
    write(table(spark, sf_dir, "pages"), path, seconds)
    index = read(spark, path).withColumn("key", url_key(F.col("url"))).drop("url")
    return merge_runs(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
