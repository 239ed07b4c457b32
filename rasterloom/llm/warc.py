"""WARC archives in seekable Zstandard bundles: independent frames of records, a footer seek table and a record index."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import fresh_folder, needs

# Fixed values of the Zstandard seekable format and of WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URI = "urn:page:"
INDEX = "record string, bundle string, frame int, frame_at long, frame_bytes int, offset_in_frame int, record_bytes int"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page: str | None, url: str | None, payload: bytes, digest: str, size: int, refers: str | None, date: str) -> bytes:
    """A response with the payload, or a revisit that refers to the response that has it."""
    headers = [("WARC-Record-ID", f"<{RECORD_URI}{'' if page is None else quote(page, safe='')}>"), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if refers is None:
        return warc_record("response", [*headers, ("Content-Type", "application/http; msgtype=response")], http + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{RECORD_URI}{quote(refers, safe='')}>")]
    return warc_record("revisit", [*headers, ("Content-Type", "application/http; msgtype=response")], http)


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each WARC record of the bytes, one after the other."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        size = int(headers["Content-Length"])
        yield headers | {"WARC-Version": version}, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


class BundleWriter:
    """Writes one bundle: frames that each decompress alone, then the seek table in a skippable frame."""

    def __init__(self, out, level: int = 3):
        self.out, self.at, self.frames = out, 0, []
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)

    def frame(self, data: bytes) -> tuple[int, int, int]:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data)))
        self.at += len(packed)
        return len(self.frames) - 1, self.at - len(packed), len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


def seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, packed bytes, unpacked bytes) of each frame, from the footer of an open bundle."""
    end = file.size()
    count, flags, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != SEEKABLE_MAGIC or flags & 0x80:
        raise ValueError("not a seekable bundle")
    out, at = [], 0
    for packed, size in struct.iter_unpack("<II", file.read_at(8 * count, end - 9 - 8 * count)):
        out.append((at, packed, size))
        at += packed
    return out


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_warc(
    pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    frame_bytes: int = 256_000, bundle_bytes: int = 64_000_000, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record for each page to bundles in ``folder``/bundles, and returns the record index in ``folder``/index.

    ``folder`` is one that all executors share. Of pages with equal payloads (SHA-1 and length) of at least
    ``least_bytes`` the one with the smallest id is a response and the others are revisits; the rest are responses.
    A task writes its bundles under names of its own attempt and moves them into place when they're whole; the index,
    which Spark commits, names the bundles that count, so a task that runs twice does no harm.

    Nulls: a null payload is empty; a null id takes part as an empty identifier, last in the choice of the response; a
    null url is left out. Repeated rows: each gets a record; those with the smallest id are all responses. An empty
    table gives an empty index. Other columns are not written.
    """
    needs(pages, id_col, url_col, payload_col)
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    firsts = (
        rows.filter(F.col("size") >= least_bytes).groupBy("sha1", "size")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    repeats = f"{folder.rstrip('/')}/repeats"
    firsts.write.parquet(repeats)  # its size is known before the join, so that payloads move only if it is large
    firsts = spark.read.parquet(repeats)
    marked = rows.join(firsts, ["sha1", "size"], "left").withColumn(
        "refers", F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    )
    ready = marked.select(
        F.col("id").cast("string").alias("id"), "url", F.when(F.col("refers").isNull(), F.col("payload")).alias("payload"), "sha1", "size", "refers"
    )
    where = f"{folder.rstrip('/')}/bundles"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = _files(where)
        task = TaskContext.get()
        files.create_dir(root, recursive=True)
        state: dict = {"n": 0, "writer": None}

        def finish() -> None:
            state["writer"].close()
            state["out"].close()
            files.move(f"{root}/.{state['name']}", f"{root}/{state['name']}")
            state["writer"] = None

        def flush(held: list[tuple[str | None, bytes]]) -> pd.DataFrame:
            if state["writer"] is None:
                state["name"] = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{state['n']:04d}.warc.zst"
                state["n"] += 1
                state["out"] = files.open_output_stream(f"{root}/.{state['name']}", compression=None)
                state["writer"] = BundleWriter(state["out"])
                info = warc_record("warcinfo", [("WARC-Record-ID", f"<urn:bundle:{state['name']}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                state["writer"].frame(info)
            frame, at, size = state["writer"].frame(b"".join(x for _, x in held))
            offset, out = 0, []
            for page, record in held:
                out.append((page, state["name"], frame, at, size, offset, len(record)))
                offset += len(record)
            if state["writer"].at >= bundle_bytes:
                finish()
            return pd.DataFrame(out, columns=["record", "bundle", "frame", "frame_at", "frame_bytes", "offset_in_frame", "record_bytes"])

        held: list[tuple[str | None, bytes]] = []
        gathered = 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                payload = bytes(r.payload) if r.payload is not None else b""
                digest = base64.b32encode(bytes.fromhex(r.sha1)).decode()
                record = page_record(r.id, r.url, payload, digest, r.size, r.refers, date)
                held.append((r.id, record))
                gathered += len(record)
                if gathered >= frame_bytes:
                    yield flush(held)
                    held, gathered = [], 0
        if held:
            yield flush(held)
        if state["writer"]:
            finish()

    ready.mapInPandas(write, INDEX).write.parquet(f"{folder.rstrip('/')}/index")
    return spark.read.parquet(f"{folder.rstrip('/')}/index")


PARSED = "id string, url string, record_type string, refers_to string, payload binary, payload_bytes long, payload_digest string"


def _parsed(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple | None:
    from urllib.parse import unquote

    if headers["WARC-Type"] not in ("response", "revisit"):
        return None
    of = lambda k: unquote(headers[k][len(RECORD_URI) + 1 : -1]) or None if k in headers else None
    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
    payload = None
    if headers["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if len(payload) != size or base32_sha1(payload) != digest:
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} isn't the one that was written")
    return of("WARC-Record-ID"), headers.get("WARC-Target-URI"), headers["WARC-Type"], of("WARC-Refers-To"), payload if with_payload else None, size, digest


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every page record of the bundles that the index names, checked against its digest. Revisits have a null payload."""
    folder = folder.rstrip("/")
    where, slots = f"{folder}/bundles", max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = spark.read.parquet(f"{folder}/index").select("bundle").distinct().repartition(slots)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = _files(where)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle in batch["bundle"]:
                held = []
                with files.open_input_file(f"{root}/{bundle}") as f:
                    for at, packed, size in seek_table(f):
                        for headers, block in read_records(unpack.decompress(f.read_at(packed, at), max_output_size=size)):
                            if row := _parsed(headers, block, with_payload):
                                held.append(row)
                        if len(held) >= 1000:
                            yield pd.DataFrame(held, columns=[x.split()[0] for x in PARSED.split(", ")])
                            held = []
                if held:
                    yield pd.DataFrame(held, columns=[x.split()[0] for x in PARSED.split(", ")])

    return named.mapInPandas(parse, PARSED)


def fetch_records(index: DataFrame, folder: str, wanted: DataFrame, id_col: str) -> DataFrame:
    """The records of the ids in ``wanted``, each read by a seek to its frame: no other frame is opened."""
    where = f"{folder.rstrip('/')}/bundles"
    places = index.join(wanted.select(F.col(id_col).cast("string").alias("record")).distinct(), "record", "left_semi")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = _files(where)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for bundle, places in batch.groupby("bundle"):
                with files.open_input_file(f"{root}/{bundle}") as f:
                    for (at, size), records in places.groupby(["frame_at", "frame_bytes"]):
                        frame = unpack.decompress(f.read_at(int(size), int(at)))
                        for r in records.itertuples():
                            headers, block = next(read_records(frame[r.offset_in_frame : r.offset_in_frame + r.record_bytes]))
                            rows.append(_parsed(headers, block, True))
            if rows:
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in PARSED.split(", ")])

    return places.repartition("bundle", "frame").mapInPandas(fetch, PARSED)


def op7_query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = fresh_folder(spark, "warc")
    write_warc(pages, folder)
    kind = dict(pages.dtypes)["page_id"]
    return read_warc(spark, folder, with_payload=False).select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
