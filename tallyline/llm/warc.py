"""WARC archives: written once, indexed first, read by coalesced byte ranges.

Writing. Every task writes one archive of gzip members (one per record, so each can be read alone) to the shared
storage, and what Spark keeps of the task is its index: file, offset, length, URL, digest and type of each record. The
index is the commit: an attempt that is lost leaves a file that no index row names, and its repetition writes another one.

Payloads that occur again are written once. Of records with equal payloads of ``MIN_REVISIT`` bytes or more, that with the largest
page id is the response and the others are revisits that name it; revisits carry no payload and so never move one.

Reading. Wanted records come as index rows. They are dealt by stretch of archive, sorted by offset, and ranges closer than
``GAP`` bytes are read together, up to ``READ_BYTES`` at a time.

Scale. Only (page id, digest, length) is grouped to find equal payloads: a payload that a third of all pages share is one
sum per map task, then a join of narrow rows that adaptive joins split. Payloads are joined to their
record by page id, and a task holds one Arrow batch of pages while writing and one range while reading.

Defined results: a null payload is an empty one. A null URL gives a record without target; control characters and spaces in a
URL are percent-encoded in the header. Rows without a page id are never preferred; if all copies lack one they are all
responses. Rows that repeat the largest page id with the same payload are all responses. An empty table gives empty archives
and an empty index. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.files import address, file_system
from tallyline.session import scratch_dir

MIN_REVISIT = 1000
GAP = 64 << 10
READ_BYTES = 8 << 20
STRETCH = 64 << 20
FETCHED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, offset bigint, length bigint, page_id bigint, url string, digest string, record_type string, refers_to bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def header_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)


def url_of_header(value: str) -> str:
    return re.sub(r"%([01][0-9A-F]|20|7F|25)", lambda m: chr(int(m[1], 16)), value)


def base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def encode_record(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes) -> bytes:
    """One record. A revisit (``refers_to`` is set) keeps the HTTP headers, with the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", FETCHED)]
    if url is not None:
        fields.append(("WARC-Target-URI", header_url(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [
        ("WARC-Payload-Digest", f"sha1:{base32(digest)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def decode_record(record: bytes) -> tuple:
    """The fields of ``RECORD``. Of a response, length and digest are those of the payload that was read."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"not a whole WARC record: {record[:80]!r}")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    page = fields.get("X-Page-ID")
    url = fields.get("WARC-Target-URI")
    start = (page and int(page), None if url is None else url_of_header(url), fields["WARC-Type"])
    if fields["WARC-Type"] == "revisit":
        stated = re.search(rb"\r\nContent-Length: (\d+)", http)[1]
        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        return (*start, int(fields["X-Refers-To-Page-ID"]), digest, int(stated), None)
    return (*start, None, hashlib.sha1(payload).hexdigest(), len(payload), payload)


def choose_responses(pages: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """``page_id, digest, size, refers_to`` of every page; ``refers_to`` is null for responses."""
    shared = pages.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
    shared = shared.where("n > 1").select("digest", "response")
    # Small payloads are looked up under names that no digest has, which parts them; nulls would all meet in one task.
    alone = F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.col("digest")))
    large = F.when(F.col("size") >= least, F.col("digest")).otherwise(alone)
    rows = pages.withColumn("large", large).join(shared.withColumnRenamed("digest", "large"), "large", "left")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.select("page_id", "url", "digest", "size", F.when(revisit, F.col("response")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str | None = None, least: int = MIN_REVISIT, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Write a record for every page and return the index of all records, which is stored beside the archives."""
    spark = pages.sparkSession
    folder = address(spark, folder or scratch_dir(spark, "warc"))
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
        payload.alias("payload"),
    )
    chosen = choose_responses(rows.drop("payload"), least)
    revisits = chosen.where("refers_to is not null").withColumn("payload", F.lit(None).cast("string"))
    # which of the rows are revisits is told by few narrow rows; the others keep their payload and stay where they are
    gone = revisits.select("page_id", "digest").distinct().withColumn("gone", F.lit(True))
    same = F.col("r.page_id").eqNullSafe(F.col("g.page_id")) & (F.col("r.digest") == F.col("g.digest"))
    responses = rows.alias("r").join(gone.alias("g"), same, "left_anti").withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "url", "digest", "size", "refers_to", "payload"]
    records = responses.select(*columns).union(revisits.select(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        store.create_dir(f"{path}/archives", recursive=True)
        name, offset, out = f"archives/{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            if out is None and batch.num_rows:
                out = store.open_output_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20)
            index = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                page_id, url, digest, size, refers_to, text = row
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                record = encode_record(page_id, url, digest, size, refers_to, (text or "").encode())
                packed = packer.compress(record) + packer.flush()
                out.write(packed)
                kind = "response" if refers_to is None else "revisit"
                index.append((name, offset, len(packed), page_id, url, digest, kind, refers_to))
                offset += len(packed)
            if batch.num_rows:
                yield _rows(index, INDEX)
        if out is not None:
            out.close()

    records.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return read_index(pages, folder)


def read_index(pages: DataFrame, folder: str) -> DataFrame:
    index = pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")
    return index.withColumn("file", F.concat(F.lit(f"{folder}/"), F.col("file")))


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def coalesced(rows: list[tuple[str, int, int]], gap: int = GAP, most: int = READ_BYTES) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Joins sorted (file, offset, length) entries into ranges: file, start, end and the entries in it."""
    file, start, end, held = None, 0, 0, []
    for name, offset, length in rows:
        if held and (name != file or offset - end > gap or offset + length - start > most):
            yield file, start, end, held
            held = []
        if not held:
            file, start, end = name, offset, offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield file, start, end, held


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that the index rows name, columns as in ``RECORD`` (without the payload on request)."""
    dealt = index.select("file", "offset", "length", F.floor(F.col("offset") / STRETCH).alias("stretch"))
    dealt = dealt.repartition("file", "stretch").sortWithinPartitions("file", "offset")
    schema = RECORD if with_payload else RECORD.removesuffix(", payload binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for batch in batches:
            entries = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for file, start, end, held in coalesced(entries):
                if file != opened:
                    if source is not None:
                        source.close()
                    store, path = file_system(file)
                    opened, source = file, store.open_input_file(path)
                block = source.read_at(end - start, start)
                found = [decode_record(zlib.decompress(block[o - start : o - start + n], 31)) for o, n in held]
                yield _rows(found if with_payload else [row[:-1] for row in found], schema)
        if source is not None:
            source.close()

    return dealt.mapInArrow(run, schema)
