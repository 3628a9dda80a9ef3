"""Deterministic sharded WARC writer, and its reader.

Records are dealt to ranges of ids whose bounds come from a sample that a hash picks, so the same
records give the same files on any cluster. A task sorts its range, compresses each record as a
gzip member of its own and rolls to a new file once the compressed size is reached. Headers, record ids and
digests are made anew. Files appear under temporary names and are then renamed; a task that
runs twice writes the same bytes twice. The manifest, written when all files are in place, is what
readers go by, so nothing of a broken job is ever read.

Of records with equal payloads of at least ``REVISIT_BYTES``, the smallest id is the response and the others revisit it.

Ids are exact over all 64 bits, also beside null ids.

Defined results: a null payload is empty; a null address becomes ``urn:page:<id>``. A null id sorts
first and its record has no id field; it neither revisits nor is revisited. Rows repeated with the same
id are all written; each one's type goes by its own payload. An empty table gives no file and an empty manifest.
"""

from __future__ import annotations

import hashlib
import sys
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import HOT_SHARE, join_hot, new_folder, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string, file_offset long"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record, not compressed."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    address = urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": record_id(page_id, digest), "WARC-Date": date,
        "WARC-Target-URI": address, "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
    }
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "Page-Refers-To": str(refers_to)}
    if page_id is not None:
        head["Page-Id"] = str(page_id)
    head |= {"Page-Payload-Length": str(len(payload)), "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member without time or name."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def plan(pages: DataFrame, page_id: str = "page_id", payload: str = "html") -> DataFrame:
    """(id, digest, first): the payloads of an id that the smaller id ``first`` has already."""
    body = F.encode(F.coalesce(payload, F.lit("")), "UTF-8")
    own = pages.select(F.col(page_id).cast("long").alias("id"), F.octet_length(body).alias("size"), F.sha2(body, 256).alias("digest"))
    own = stage(own.where(F.col("id").isNotNull() & (F.col("size") >= REVISIT_BYTES)).drop("size"), "digests")
    groups = own.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    total = own.count()
    met = join_hot(own, stage(groups, "copies"), "digest", F.col("n") > max(1000, total * HOT_SHARE))
    return met.where("id > first").select("id", "digest", "first").distinct()


def bounds(ids: DataFrame, column: str, ranges: int, sample: int = 100_000) -> list[int]:
    """Cuts between ``ranges`` ranges of about equal counts: quantiles of the ids that a hash picks (about ``sample``)."""
    total = ids.count()
    every = max(1, total // sample)
    picked = sorted(r[0] for r in ids.where(F.col(column).isNotNull() & (F.pmod(F.xxhash64(column), F.lit(every)) == 0)).select(column).distinct().collect())
    return sorted({picked[len(picked) * k // ranges] for k in range(1, ranges)}) if picked else []


def write(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", roll_bytes: int = 256 << 20,
    range_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z", level: int = 6,
) -> DataFrame:
    """Write one record a row below ``folder`` (a folder that all executors share); returns the manifest."""
    spark = pages.sparkSession
    revisits = plan(pages, page_id, payload)
    size = pages.agg(F.sum(F.octet_length(payload).cast("long") + 500)).first()[0] or 0
    cuts = bounds(pages.select(F.col(page_id).cast("long").alias("id")), "id", max(1, -(-size // range_bytes)))
    # marks and pages meet by sorting, so payloads cross the network once
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first"),
        F.col(url).cast("string").alias("url"), F.encode(F.coalesce(payload, F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    marks = revisits.select("id", F.lit(0).alias("kind"), "first", "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    edges = F.array(*[F.lit(c).cast("long") for c in cuts]).cast("array<long>")
    dealt = rows.unionByName(marks).withColumn("range", F.coalesce(F.size(F.filter(edges, lambda c: c <= F.col("id"))), F.lit(0)))
    # equal ids: by payload (a mark stands before its rows) and address, so that the order is fixed
    ordered = dealt.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions("range", F.asc_nulls_first("id"), "digest", "kind", F.asc_nulls_first("url"))
    # ids travel as text: pandas makes whole numbers with nulls floats, which round them
    ordered = ordered.withColumns({c: F.col(c).cast("string") for c in ("id", "first")})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = pafs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        now, part, out, mark = None, 0, None, None

        def close() -> pd.DataFrame:
            out["stream"].close()
            store.move(out["temp"], f"{top}/{out['file']}")  # same bytes whenever this is done again
            return pd.DataFrame([{k: out[k] for k in ("file", "records", "bytes", "first_id", "last_id")} | {"sha256": out["sha"].hexdigest()}])

        for frame in frames:
            for r in frame.itertuples(index=False):
                own = None if pd.isna(r.id) else int(r.id)
                if r.kind == 0:
                    mark = (own, r.digest, int(r.first))
                    continue
                if out and (r.range != now or out["bytes"] >= roll_bytes):
                    part = part + 1 if r.range == now else 0
                    yield close()
                    out = None
                if not out:
                    now = r.range
                    name = f"pages-{now:06d}-{part:04d}.warc.gz"
                    temp = f"{top}/_tmp-{uuid.uuid4().hex}-{name}"
                    out = {"file": name, "temp": temp, "stream": store.open_output_stream(temp, compression=None), "sha": hashlib.sha256(), "records": 0, "bytes": 0, "first_id": own}
                first = mark[2] if mark and own is not None and mark[:2] == (own, r.digest) else None
                data = member(record(own, r.url, r.payload, first, date), level)
                out["stream"].write(data)
                out["sha"].update(data)
                out |= {"records": out["records"] + 1, "bytes": out["bytes"] + len(data), "last_id": own}
        if out:
            yield close()

    # Spark commits the manifest as a whole, after all files have their names
    ordered.mapInPandas(run, MANIFEST).write.json(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


def parse(stream, check: bool = True) -> Iterator[tuple[dict, bytes, int]]:
    """(header fields, block, offset) of each record of a ``.warc.gz`` stream, one member in memory at a time."""
    data, offset, done = b"", 0, False
    while True:
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not data:
                data = stream.read(1 << 20)
                if not data:
                    done = True
                    break
            parts.append(inflate.decompress(data))
            used += len(data) - len(inflate.unused_data)
            data = inflate.unused_data
        if done:
            if used:
                raise ValueError(f"record at {offset} is cut off")
            return
        whole = b"".join(parts)
        head, _, rest = whole.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block = rest[: int(fields["Content-Length"])]
        if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
            raise ValueError(f"record at {offset} is malformed")
        if check and fields["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
            raise ValueError(f"record at {offset} has another digest")
        yield fields, block, offset
        offset += used


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the files in the manifest; digests are checked."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = pafs.FileSystem.from_uri(folder)
        for frame in frames:
            for name in frame["file"]:
                rows = []
                with store.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for fields, block, offset in parse(stream):
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if fields["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(fields["Page-Payload-Length"])):
                            raise ValueError(f"{name}: payload at {offset} has another digest")
                        rows.append((
                            fields.get("Page-Id"), int(fields["Page-Payload-Length"]), digest, fields["WARC-Type"], fields.get("Page-Refers-To"),
                            fields["WARC-Target-URI"], name, offset,
                        ))
                        if len(rows) >= 5000:
                            yield _frame(rows)
                            rows = []
                if rows:
                    yield _frame(rows)

    files = read_manifest(spark, folder).select("file")
    found = files.repartition(max(1, files.count()), "file").mapInPandas(run, RECORDS.replace("_id long", "_id string").replace("refers_to long", "refers_to string"))
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def _frame(rows: list[tuple]) -> pd.DataFrame:
    """Ids stay text here, see ``write``."""
    return pd.DataFrame(rows, columns=[c.split()[0] for c in RECORDS.split(", ")])


def round_trip(pages: DataFrame, folder: str | None = None, **how) -> DataFrame:
    """Write ``pages`` and read the archives back."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    write(pages, folder, **how)
    return read(pages.sparkSession, folder)
