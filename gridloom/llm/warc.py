"""WARC archives: a deterministic sharded writer and a reader.

Rows are sorted into shards by ranges of their key; the ranges follow from the
keys and sizes alone, so that the same rows always give the same files. A
shard's records, one gzip member each, fill files up to a compressed size.
Headers, record ids and digests are made anew from the rows. A file is written
under a temporary name that no other attempt uses and then renamed; a shard's
manifest follows in the same way, then the table of all files, and at last a
small file by which readers know that the archive is whole. An attempt that is lost or runs
twice leaves at most temporary files behind or writes the same bytes again.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import blobs
from gridloom.llm.common import bounded_batches, buffers, checkpointed

#: Payload bytes of a shard, and compressed bytes at which a file ends.
SHARD_BYTES, FILE_BYTES = 32 << 20, 16 << 20
#: Bytes that a record's headers are counted for.
RECORD_BYTES = 512
#: The table of all files, and the file that says that it is whole.
MANIFEST, DONE = "MANIFEST.parquet", "MANIFEST.json"
FILES = "file string, shard bigint, records bigint, bytes bigint, sha256 string"
_READ = 8 << 10
_SPACE = uuid.UUID("6f1d3a52-9a44-4e7b-8f7e-2f9f0b6c1d11")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{key} {digest}')}>"


def _field(value: str) -> str:
    """A header value on one line: other characters than visible ASCII are percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(key: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, date: str) -> bytes:
    """One record: a response with its payload, or a revisit that names the response with the same payload."""
    digest = base32_sha1(payload)
    block = _HTTP % len(payload) + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key, digest)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    if key is not None:
        head.append(f"X-Page-Id: {key}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Page-Id: {first}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _publish(store: fs.FileSystem, path: str, data: bytes) -> None:
    at = f"{path}.tmp-{uuid.uuid4().hex}"
    with store.open_output_stream(at) as f:
        f.write(data)
    store.move(at, path)


def cuts_of(facts: DataFrame, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where all shards but the first begin, as key, payload hash and url hash, so that a shard holds about `target` bytes.

    facts has those (k, h, u) and size. The rows are sorted over all partitions;
    sizes are summed in that order, by partition and then within each, and a
    shard begins at the first row behind each multiple of the target. So the
    cuts follow from the rows alone, and keys that lie close together or recur
    are parted like any other. Three numbers for each shard come to the driver.
    """
    own = facts.select("k", "h", "u", "size").repartitionByRange("k", "h", "u").sortWithinPartitions("k", "h", "u").withColumn("part", F.spark_partition_id())
    own = checkpointed(own)
    sums = sorted((r["part"], r["n"]) for r in own.groupBy("part").agg(F.sum("size").alias("n")).collect())  # a row for each partition
    ends = np.cumsum([n for _, n in sums])
    before = own.sparkSession.sparkContext.broadcast({part: int(end - n) for (part, n), end in zip(sums, ends, strict=True)})

    def begin(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = last = None
        for part in parts:
            if not part.num_rows:
                continue
            size = part.column(3).to_numpy(zero_copy_only=False)
            at = before.value[part.column(4)[0].as_py()] if at is None else at
            shard = (at + np.cumsum(size) - size) // target
            new = np.flatnonzero(np.append(shard[0] != last, shard[1:] != shard[:-1]))
            at, last = at + int(size.sum()), shard[-1]
            yield pa.RecordBatch.from_arrays([pa.array(shard[new]), *part.select(["k", "h", "u"]).take(pa.array(new)).columns], ["shard", "k", "h", "u"])

    firsts = own.mapInArrow(begin, "shard bigint, k bigint, h bigint, u bigint").groupBy("shard").agg(F.min(F.struct("k", "h", "u")).alias("c"))
    found = firsts.where("shard > 0").select("c.*").distinct().orderBy("k", "h", "u").toArrow()
    return tuple(found.column(c).to_numpy() for c in ("k", "h", "u"))


def shard_of(cuts: tuple[np.ndarray, np.ndarray, np.ndarray], k: np.ndarray, h: np.ndarray, u: np.ndarray) -> np.ndarray:
    """How many cuts do not lie behind each row."""
    low, high = np.searchsorted(cuts[0], k, "left"), np.searchsorted(cuts[0], k, "right")
    for r in np.flatnonzero(low < high).tolist():  # a shard begins within the rows of this key
        a, b = int(low[r]), int(high[r])
        own = list(zip(cuts[1][a:b].tolist(), cuts[2][a:b].tolist(), strict=True))
        high[r] = a + bisect.bisect_right(own, (int(h[r]), int(u[r])))
    return high


def write(pages: DataFrame, out: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z", least_revisit: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes an archive of all rows to the folder `out` (a URI) and returns its manifest: file, shard, records, bytes, sha256.

    Records are sorted by key, SHA-256 of the whole payload, and url. Of rows
    with equal payloads of at least `least_revisit` bytes those with the
    smallest key are responses, the others revisit it. Null payloads are empty.
    Rows with a null key come first, are responses always, and are never
    referred to. Repeated rows each get a record, in one shard. An empty table
    gives an archive without files; other columns are left out.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    body = F.coalesce(pages[payload].cast("binary"), F.lit(b""))
    rows = pages.select(pages[key].cast("long").alias("key"), pages[url].cast("string").alias("url"), body.alias("body"), F.sha2(body, 256).alias("sha"))
    place = {"k": F.coalesce("key", F.lit(-(1 << 63))), "h": F.conv(F.substring("sha", 1, 15), 16, 10).cast("long"), "u": F.xxhash64("url")}
    facts = checkpointed(rows.select("key", "sha", F.octet_length("body").cast("long").alias("length"), *(c.alias(n) for n, c in place.items())))
    shared = spark.sparkContext.broadcast(cuts_of(facts.withColumn("size", F.col("length") + RECORD_BYTES), shard_bytes))
    first = facts.where("key IS NOT NULL").groupBy("sha").agg(F.min("key").alias("first"))
    revisits = facts.where((F.col("length") >= least_revisit) & F.col("key").isNotNull()).join(first, "sha").where("first < key").select("key", "sha", "first", "k", "h", "u")

    def numbers(part: pa.RecordBatch, at: int) -> np.ndarray:
        return shard_of(shared.value, *(part.column(at + c).to_numpy(zero_copy_only=False) for c in range(3)))

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, off, _ = buffers(part.column(2))
            urls, uoff, has_url = buffers(part.column(1))
            has_key = part.column(0).is_valid().to_numpy(zero_copy_only=False)
            keys = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            slot = numbers(part, 3)
            order = np.argsort(slot, kind="stable")
            view, uview, out = data.tobytes(), urls.tobytes(), []
            start = np.flatnonzero(np.append(True, slot[order][1:] != slot[order][:-1])) if len(order) else []
            for a, b in zip(start, [*start[1:], len(order)], strict=True) if len(order) else ():
                own = order[a:b]
                texts = blobs.pack_text(keys[own], has_key[own] + 2 * has_url[own], np.diff(off)[own], b"".join(view[off[r] : off[r + 1]] for r in own))
                names = blobs.pack_text(keys[own], has_url[own], np.diff(uoff)[own], b"".join(uview[uoff[r] : uoff[r + 1]] for r in own))
                out.append((int(slot[own[0]]), texts, names))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary())], ["slot", "texts", "names"])

    def deal_revisits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array(numbers(part, 3)), *part.columns[:3]], ["slot", "key", "sha", "first"])

    def store_shard(slot: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        shard = slot[0].as_py()
        store, folder = fs.FileSystem.from_uri(out)
        refers = dict(zip(zip(right.column("key").to_pylist(), right.column("sha").to_pylist(), strict=True), right.column("first").to_pylist(), strict=True))
        found = []
        for texts, names in zip(left.column("texts").to_pylist(), left.column("names").to_pylist(), strict=True):
            keys, state, lengths, data = blobs.unpack_text(texts)
            _, _, ulengths, udata = blobs.unpack_text(names)
            off, uoff = np.append(0, np.cumsum(lengths)), np.append(0, np.cumsum(ulengths))
            for r in range(len(keys)):
                k = int(keys[r]) if state[r] & 1 else None
                u = udata[uoff[r] : uoff[r + 1]].tobytes().decode() if state[r] & 2 else None
                payload = data[off[r] : off[r + 1]]
                found.append((k is not None, k or 0, hashlib.sha256(payload).hexdigest(), u or "", u, payload))
        found.sort(key=lambda x: x[:4])
        files, held, size, count = [], [], 0, 0

        def roll() -> None:
            nonlocal held, size, count
            if held:
                name, whole = f"part-{shard:06d}-{len(files):04d}.warc.gz", b"".join(held)
                _publish(store, f"{folder}/{name}", whole)
                files.append({"file": name, "shard": shard, "records": count, "bytes": len(whole), "sha256": hashlib.sha256(whole).hexdigest()})
                held, size, count = [], 0, 0

        for has_key, k, sha, _, u, data in found:
            whole = data.tobytes()
            first = refers.get((k, sha)) if has_key else None
            piece = member(record(k if has_key else None, u, whole, first, first is not None, date))
            if held and size + len(piece) > file_bytes:
                roll()
            held.append(piece)
            size += len(piece)
            count += 1
        roll()
        _publish(store, f"{folder}/part-{shard:06d}.json", json.dumps(files, indent=1).encode())
        return pa.table({n: pa.array([f[n] for f in files], t) for n, t in (("file", pa.string()), ("shard", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()))})

    store, folder = fs.FileSystem.from_uri(out)
    store.create_dir(folder, recursive=True)
    if store.get_file_info(f"{folder}/{DONE}").type != fs.FileType.NotFound:
        store.delete_file(f"{folder}/{DONE}")  # from here on the archive is not whole
    left = rows.select("key", "url", "body", *(c.alias(n) for n, c in place.items())).mapInArrow(deal, "slot bigint, texts binary, names binary")
    right = revisits.mapInArrow(deal_revisits, "slot bigint, key bigint, sha string, first bigint")
    done = left.groupBy("slot").cogroup(right.groupBy("slot")).applyInArrow(store_shard, FILES)
    done.write.mode("overwrite").parquet(f"{out}/{MANIFEST}")  # written in tasks and committed by Spark: no list of files passes the driver
    files = spark.read.schema(FILES).parquet(f"{out}/{MANIFEST}")
    whole = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    _publish(store, f"{folder}/{DONE}", json.dumps(whole.asDict()).encode())
    return files


def records(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers and block of each record of a file, one gzip member after the other."""
    view, at = memoryview(data), 0
    while at < len(view):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            piece = view[at : at + _READ]  # what lies behind the member is copied, so pieces are small
            if not len(piece):
                raise ValueError("the file ends within a record")
            parts.append(z.decompress(piece))
            at += len(piece)
        at -= len(z.unused_data)
        whole = b"".join(parts)
        head, _, body = whole.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        yield fields, memoryview(body)[: int(fields["Content-Length"])]


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records of a whole archive: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits).

    Only files that the manifest names are read, each by the task that its row
    comes to; digests and sizes are checked against the bytes, and a file that
    is not whole raises an error.
    """
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{path}/{DONE}") as f:
        whole = json.loads(f.read())
    files = spark.read.schema(FILES).parquet(f"{folder}/{MANIFEST}").select("file", "sha256")

    def parse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for part in parts:
            for name, digest in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                with store.open_input_stream(f"{path}/{name}", compression=None) as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != digest:
                    raise ValueError(f"{name} is not the file of the manifest")
                held, size = [], 0
                for fields, block in records(data):
                    held.append(_parsed(fields, block))
                    size += len(block)
                    if size > 4 << 20:
                        yield _batch(held)
                        held, size = [], 0
                yield _batch(held)

    parts = max(1, min(whole["files"], -(-whole["bytes"] // FILE_BYTES) + int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return files.repartition(parts, "file").mapInArrow(parse, "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")


def _parsed(fields: dict[str, str], block: memoryview) -> tuple:
    head, _, payload = bytes(block).partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    stated = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    if f"sha1:{base32_sha1(bytes(block))}" != fields["WARC-Block-Digest"] or kind == "response" and (base32_sha1(payload) != digest or len(payload) != stated):
        raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
    number = lambda n: int(fields[n]) if n in fields else None
    return number("X-Page-Id"), fields.get("WARC-Target-URI"), kind, stated, digest, number("X-Refers-To-Page-Id"), payload if kind == "response" else None


_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_RECORDS.types)], schema=_RECORDS)
