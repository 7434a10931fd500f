"""WARC archives: writing with revisit records, reading, and resolving revisits.

Only headers are shuffled by payload digest: the record with the least id of
equal payloads of at least ``least`` bytes stays a response, the others become
revisits of it. Each task writes its own gzip archives (one member per record,
files of bounded size) into the shared folder under a name no other attempt
uses, and returns an index of what it wrote; files of lost attempts are never
in the index. Reading takes the files of an index, one at a time, member by member.

Null payloads are empty. Records with a null id are responses and nobody's
original. Rows that repeat the original's id are responses too. A null address
leaves the target header out. Control characters in an address are percent-encoded.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BYTES = 100
FILE_BYTES = 64_000_000
SALTS = 16
DATE = "2024-01-01T00:00:00Z"
# Fixed value: the profile that names revisits of equal payloads.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "cohortline/page")


def salted_join(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Join rows of ``many`` with the one row of their key; a hot key is dealt over several partitions."""
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = many.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]), F.lit(SALTS)).cast("int"))
    return dealt.join(copies, [key, "_salt"]).drop("_salt")


def headers_of(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, payload_bytes, payload_digest), the payload itself left behind."""
    data = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
    return pages.select(F.col(f"`{key}`").alias("id"), F.octet_length(data).cast("long").alias("payload_bytes"), F.sha2(data, 256).alias("payload_digest"))


def revisits_of(headers: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(id, refers_to, payload_digest) of the records that repeat an earlier payload."""
    large = headers.where((F.col("payload_bytes") >= least) & F.col("id").isNotNull()).select("id", "payload_digest")
    first = large.groupBy("payload_digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return salted_join(large, first, "payload_digest").where("id != refers_to").distinct()


def _clean(address: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), address)


def record_id(key) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(key))}>"


def record(key, address: str | None, payload: bytes, refers_to=None, digest: str | None = None) -> bytes:
    """One record. A revisit keeps the protocol header of its response and no payload."""
    digest = digest or hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(key) if key is not None else f'<urn:uuid:{uuid.uuid4()}>'}", f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if key is not None:
        lines.append(f"Page-Id: {key}")
    if address is not None:
        lines.append(f"WARC-Target-URI: {_clean(address)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def opened(uri: str):
    """File system and path of an address that Spark also understands."""
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


def write(pages: DataFrame, folder: str, key: str = "page_id", address: str = "url", payload: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Write archives; returns (file, records). Evaluate it once: each evaluation writes anew."""
    again = revisits_of(headers_of(pages, key, payload), least).select(F.col("id").alias("_id"), "refers_to", F.col("payload_digest").alias("_digest"))
    rows = pages.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{address}`").alias("_address"), F.col(f"`{payload}`").alias("_payload"))
    rows = rows.join(again, F.col("_key") == F.col("_id"), "left")
    small = F.octet_length(F.coalesce("_payload", F.lit(""))) < least  # a repeated id may also name a small page
    rows = rows.select("_key", "_address", "_payload", F.when(~small & (F.sha2(F.col("_payload").cast("binary"), 256) == F.col("_digest")), F.col("refers_to")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        state = {"out": None, "name": "", "size": 0, "records": 0}

        def close():
            if state["out"] is not None:
                state["out"].close()
                state["out"] = None
                return [(state["name"], state["records"])]
            return []

        done: list[tuple[str, int]] = []
        for batch in batches:
            for k, a, p, r in zip(*(batch.column(i) for i in range(4))):
                if state["out"] is None:
                    part = TaskContext.get().partitionId() if TaskContext.get() else 0
                    state.update(name=f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz", size=0, records=0)
                    state["out"] = system.open_output_stream(f"{base}/{state['name']}", compression=None)
                data = _member(record(k.as_py(), a.as_py(), (p.as_py() or "").encode("utf-8", "replace"), r.as_py()))
                state["out"].write(data)
                state["size"] += len(data)
                state["records"] += 1
                if state["size"] >= FILE_BYTES:
                    done += close()
        done += close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], names=["file", "records"])

    return rows.mapInArrow(run, "file string, records bigint")


def members(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """Records of one gzip archive, decompressed one after the other."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(step)
        rest = b""
        if not data:
            if parts or unpack.unconsumed_tail:
                raise EOFError("the archive ends inside a record")
            return
        parts.append(unpack.decompress(data))
        if unpack.eof:
            rest = unpack.unused_data
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    return fields, rest[: int(fields["content-length"])]


def read(files: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of the archives named in ``files.file``. Sizes and digests of
    responses come from the payload itself; a digest that differs from the header is an error."""
    names = ["page_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "target", *(["payload"] if with_payload else [])]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if with_payload else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for data in members(stream):
                        fields, block = parse(data)
                        kind, digest, payload, n = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:"), None, None
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            n = len(payload)
                            if hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"digest of a record in {name} does not fit")
                        key, back = fields.get("page-id"), fields.get("refers-to-page-id")
                        row = (int(key) if key else None, kind, digest, n, int(back) if back else None, fields.get("warc-target-uri"))
                        rows.append(row + ((payload,) if with_payload else ()))
                        size += len(payload or b"") if with_payload else 0
                        if len(rows) >= 10_000 or size > 8_000_000:
                            yield out(rows)
                            rows, size = [], 0
                if rows:
                    yield out(rows)

    schema = "page_id bigint, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, target string"
    return files.select("file").mapInArrow(run, schema + (", payload binary" if with_payload else ""))


def resolve(records: DataFrame) -> DataFrame:
    """Give each revisit what its response has: size, and the payload where it was read."""
    carried = [c for c in ("payload_bytes", "payload") if c in records.columns]
    responses, revisits = records.where("record_type = 'response'"), records.where("record_type = 'revisit'")
    wanted = revisits.select("payload_digest", F.col("refers_to").alias("page_id")).distinct()
    originals = responses.select("payload_digest", "page_id", *carried).dropDuplicates(["payload_digest", "page_id"])
    originals = originals.join(wanted, ["payload_digest", "page_id"]).withColumnRenamed("page_id", "refers_to").drop("payload_digest")
    found = salted_join(revisits.drop(*carried), originals, "refers_to").select(*records.columns)
    return responses.unionByName(found)
