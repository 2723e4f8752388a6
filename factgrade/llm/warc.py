"""WARC archives: writing captures as request, response or revisit, and metadata records; reading; assembly.

Archives are written by Spark's own text writer, one record per row with the blank lines that end a record as the
separator, so that writing is committed as a whole and goes wherever Spark can write.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from factgrade.llm.common import counted_join

#: Shorter payloads are never written as revisits.
REVISIT_BYTES = 100
RECORDS_PER_FILE = 30_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
RECORD = (
    "type string, record_id string, date string, target_uri string, concurrent_to string, refers_to string, "
    "content_type string, fields map<string,string>, payload_bytes bigint, payload_digest string, payload binary"
)

NESTED = ("requests", "metadata_records", "request", "metadata")


def urn(*parts: Column | str) -> Column:
    """A record id made from the given values."""
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those with a null value are left out."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), value) for name, value in pairs])


def record(kind: Column, record_id: Column, uri: Column, content_type: str, block: Column, *more: tuple[str, Column]) -> Column:
    head = lines(
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", uri),
        *more,
        ("Content-Type", F.lit(content_type)),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(F.lit("WARC/1.1\r\n"), head, F.lit(END), block)


def plan_captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest, occurrence and ``owner``.

    ``owner`` is the page a row revisits: the smallest ``page_id`` with an equal payload of at least
    ``REVISIT_BYTES``; null for the owner's own rows, shorter payloads and rows without ``page_id``.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "digest": F.sha2("payload", 256)})
    owned = (F.octet_length("payload") >= REVISIT_BYTES) & F.col("page_id").isNotNull()
    counted = (
        pages.select("page_id", F.coalesce("html", F.lit("")).alias("payload"))
        .select(F.sha2("payload", 256).alias("digest"), F.when(owned, F.col("page_id")).alias("owner"))
        .groupBy("digest")
        .agg(F.min("owner").alias("owner"), F.count("*").alias("n"))
    )
    # Rows without an id are spread by their address; the piece then keeps their occurrences apart.
    no_id = F.col("page_id").isNull()
    joined = counted_join(rows, counted, "digest", [F.col("page_id"), F.when(no_id, F.col("url"))], piece=True)
    same = Window.partitionBy("digest", "_piece", "page_id").orderBy("url")
    owner = F.when(F.col("owner") < F.col("page_id"), F.col("owner"))
    apart = F.when(no_id, F.shiftleft(F.col("_piece").cast("bigint"), 32)).otherwise(0)
    return joined.withColumns({"occurrence": F.row_number().over(same) + apart, "owner": owner})


def write(pages: DataFrame, folder: str) -> None:
    """One capture per row of ``pages`` (page_id, url, html): a request, a response or revisit, and a metadata record.

    Null html is the empty payload; an absent or null url gives records without a target; line breaks in it are
    escaped.  Repeated rows get captures of their own.  Other columns are not read.  An empty table writes nothing
    but an empty folder.
    """
    plan = plan_captures(pages)
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    page = F.col("page_id").cast("string")
    own = urn(F.lit("capture"), page, F.col("digest"), F.col("occurrence").cast("string"))
    target = urn(F.lit("capture"), F.col("owner").cast("string"), F.col("digest"), F.lit("1"))
    revisit = F.col("owner").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    response = record(
        F.when(revisit, "revisit").otherwise("response"),
        own,
        uri,
        "application/http;msgtype=response",
        F.concat(http, F.when(revisit, "").otherwise(F.col("payload"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        ("WARC-Refers-To", F.when(revisit, target)),
        ("WARC-Profile", F.when(revisit, PROFILE)),
    )
    get = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1"), F.lit(END))
    request = record(F.lit("request"), urn(F.lit("request"), own), uri, "application/http;msgtype=request", get, ("WARC-Concurrent-To", own))
    facts = F.concat(lines(("page-id", page), ("refers-to-page-id", F.col("owner").cast("string"))), F.lit("\r\n"))
    metadata = record(F.lit("metadata"), urn(F.lit("metadata"), own), uri, "application/warc-fields", facts, ("WARC-Concurrent-To", own))
    records = plan.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.mode("overwrite").option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = fields(iter(stream.readline, b""))
        yield headers, stream.read(int(headers.get("content-length", 0)))


def fields(found: Iterator[bytes]) -> dict[str, str]:
    """Lines of ``name: value`` up to the first empty one; several records that one is concurrent to are all kept."""
    out: dict[str, str] = {}
    for line in found:
        line = line.rstrip(b"\r\n")
        if not line:
            break
        name, _, value = line.partition(b":")
        key, text = name.decode("utf-8", "replace").strip().lower(), value.decode("utf-8", "replace").strip()
        out[key] = f"{out[key]} {text}" if key == "warc-concurrent-to" and key in out else text
    return out


def row(headers: dict[str, str], block: bytes, payload: bool) -> tuple:
    kind = headers.get("warc-type", "")
    content = headers.get("content-type", "")
    inner, body = {}, None
    if content.startswith("application/http"):
        head, _, body = block.partition(b"\r\n\r\n")
        inner = fields(iter(head.split(b"\r\n")[1:]))
    elif content == "application/warc-fields":
        inner = fields(iter(block.splitlines()))
    size = digest = None
    if kind == "revisit":
        size, digest = int(inner.get("content-length", 0)), headers.get("warc-payload-digest", "").removeprefix("sha256:")
        body = None
    elif kind == "response":
        size, digest = len(body or b""), sha256(body or b"").hexdigest()
    return (
        kind, headers.get("warc-record-id"), headers.get("warc-date"), headers.get("warc-target-uri"), headers.get("warc-concurrent-to"),
        headers.get("warc-refers-to"), content, list(inner.items()), size, digest, body if payload and kind == "response" else None,
    )


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """All records of the archives in a folder, one row each; ``payload`` says whether bodies are kept."""
    schema = spark.createDataFrame([], RECORD).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    rows.append(row(headers, block, payload))
                    size += len(block)
                    if len(rows) >= 2000 or payload and size > 8_000_000:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with the requests and metadata concurrent to it.

    Either side may name the other, and ``concurrent_to`` may hold several ids, parted by blanks.  ``requests`` and
    ``metadata_records`` are in order of their ids, empty where there are none; ``request`` and ``metadata`` are the first
    of them or null.  Records that are concurrent to no known capture are left out; a capture that stands twice gives
    two rows, a record that stands twice is listed twice; null ids meet nothing.  All records that are concurrent to
    one capture are in its row.  Other columns stay, but for any of the four names.  ``records`` is read several times: give it as a written table.
    """
    others = F.array_distinct(F.split(F.trim("concurrent_to"), r"\s+"))
    is_capture = F.col("type").isin("response", "revisit")
    captures = records.where(is_capture).drop("concurrent_to", "fields", "content_type", *NESTED)
    beside = records.where(F.col("type").isin("request", "metadata")).select(
        "type", "record_id", others.alias("names"), F.struct("record_id", "date", "fields").alias("found")
    )
    forward = beside.select("type", F.explode("names").alias("capture"), "found")
    named = records.where(is_capture & F.col("concurrent_to").isNotNull() & F.col("record_id").isNotNull())
    named = named.select(F.col("record_id").alias("capture"), F.explode(others).alias("record_id")).distinct()
    # Pairs in which both name each other come from the first way.
    both = F.coalesce(F.array_contains("names", F.col("capture")), F.lit(False))
    backward = beside.join(named, "record_id").where(~both).select("type", "capture", "found")

    def listed(kind: str) -> Column:
        def order(a: Column, b: Column) -> Column:
            x, y = (F.coalesce(v["record_id"], F.lit("")) for v in (a, b))
            return F.when(x < y, -1).when(x > y, 1).otherwise(0)

        return F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.col("found"))), order)

    linked = forward.unionByName(backward).groupBy(F.col("capture").alias("record_id"))
    linked = linked.agg(listed("request").alias("requests"), listed("metadata").alias("metadata_records"))
    none = F.array().cast(linked.schema["requests"].dataType)
    out = captures.join(linked, "record_id", "left")
    out = out.withColumns({c: F.coalesce(c, none) for c in NESTED[:2]})
    return out.withColumns({"request": F.get("requests", F.lit(0)), "metadata": F.get("metadata_records", F.lit(0))})
