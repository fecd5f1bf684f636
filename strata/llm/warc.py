"""Operator 1: deterministic sharded WARC writer and reader.

Records are range-sorted by id into shards whose bounds come from a size histogram of the ids (no
sampling, so the same input gives the same files), each shard is sorted and written by one task as
gzip members, one per record, rolled to a new file when the compressed size passes a limit. Headers
are generated anew (fixed WARC-Date, record ids and digests derived from the payload and the id).

Duplicates: of records with equal payloads of at least ``min_bytes`` bytes the one with the largest id
is the ``response``, the others are ``revisit`` records without payload. Which digests repeat is found
by a grouped aggregate over (digest, id) rows without payloads; the resulting short revisit rows travel
to the shards through the same range shuffle as the records and stand before them, so payloads are
shuffled once.

Commit: a task writes under a temporary name that holds its attempt, returns a manifest row for each
file and the rows are written as a table; then each listed file is renamed to its final name (a rename
that was done before is recognised by name and size), and the manifest table is published last. Files
of lost or repeated attempts are never listed. Files are opened by URI through Arrow's file systems, so
shared mounts and object stores work alike.

Addresses that no header can hold (line breaks, control characters, white space at their ends) are escaped in their
record and read back as they were, so no address can add or change a header.

Defined results: null payloads are empty payloads; rows with a null id are written to the first shard
and compare as smaller than every id; of repeated rows with the largest id one is the response, the
others revisit it; an empty table gives no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import posixpath
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import written

#: Fixed header values, so that equal input gives equal bytes.
DATE, IP = "2000-01-01T00:00:00Z", "0.0.0.0"
#: Payload bytes of a shard and compressed bytes after which a file is closed.
SHARD_BYTES, FILE_BYTES = 32 << 20, 16 << 20
#: Buckets of the id histogram that shard bounds are cut from.
BUCKETS = 1 << 14
#: Tasks that read archives or commit them, at most; fewer files take a task each.
READERS = 10_000
_CONTROL = re.compile(r"[\x00-\x1f\x7f\x85\u2028\u2029]")
_PLAIN = "!\"#$&'()*+,/:;<=>?@[\\]^`{|}~"
MANIFEST = "shard int, file int, temporary string, final string, bytes long, sha1 string, records long, first_id long, last_id long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(kind: str, key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{key}')}>"


def _header_value(url: str) -> tuple[str, bool]:
    """The address as a header can hold it. One with line breaks, other control characters or white space at its ends
    is percent-escaped, its percent signs too, and marked so that reading undoes it."""
    if url == url.strip() and not _CONTROL.search(url):
        return url, False
    return quote(url, safe=_PLAIN), True


def record(ident: int | None, url: str, payload: bytes, sha: str, refers_to: tuple[int | None, str] | None) -> bytes:
    """The bytes of one WARC record; ``refers_to``: id and address of the response it revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    target, escaped = _header_value(url)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {_name('record', f'{ident}/{sha}')}",
            f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}", f"WARC-IP-Address: {IP}",
            f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    if refers_to:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_name('record', f'{refers_to[0]}/{sha}')}", f"X-Refers-To-Id: {refers_to[0]}"]
    head += ["X-Target-URI-Escaped: 1" if escaped else "", "" if ident is None else f"X-Id: {ident}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(h for h in head if h).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a decompressed WARC stream."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().partition(":")
            headers.setdefault(key, value.strip())  # the first of a name counts
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("record end missing")
        yield headers, block


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def shards(records: DataFrame, shard_bytes: int) -> list[int]:
    """Ids at which a new shard begins, from payload bytes by bucket of the id (at most BUCKETS rows)."""
    low, high = records.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return []
    width = max(1, -(-(high - low + 1) // BUCKETS))
    sizes = records.where("id is not null").groupBy(F.expr(f"(id - {low}L) div {width}L").alias("bucket")).agg(
        F.sum(F.octet_length("payload") + 400).alias("n")).orderBy("bucket").collect()
    bounds, held = [], 0
    for bucket, n in sizes:
        if held and held + n > shard_bytes:
            bounds.append(low + bucket * width)
            held = 0
        held += n
    return bounds


def write(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records under ``out``; the manifest (one row per committed file)."""
    spark = pages.sparkSession
    records = pages.select(pages[id_col].cast("long").alias("id"), F.coalesce(pages[url_col], F.lit("")).alias("url"),
                           F.coalesce(pages[payload_col], F.lit("")).cast("binary").alias("payload"))
    bounds = shards(records, shard_bytes)
    starts = f"array({', '.join(f'{b}L' for b in bounds)})" if bounds else "array()"
    shard = F.expr(f"cast(size(filter({starts}, start -> start <= id)) as int)") if bounds else F.lit(0)

    # Payload-free rows decide who is a response. Repeated digests are written once: both sides of the join
    # are then plain shuffles, which adaptive execution can split where a digest is very common.
    slim = records.where(F.octet_length("payload") >= min_bytes).select("id", F.unhex(F.sha1("payload")).alias("sha"))
    repeated, _ = written(slim.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("to"))
                          .where("n > 1").select("sha", "to"), "warc-repeated")
    roles = slim.join(repeated, "sha").groupBy("id", "sha").agg(F.max("to").alias("to"), F.count(F.lit(1)).alias("n")) \
        .where("not (id <=> to) or n > 1").select("id", "sha", "to", (~F.col("id").eqNullSafe(F.col("to"))).alias("whole"))
    mixed = records.select("id", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("to"),
                           F.lit(None).cast("boolean").alias("whole")).unionByName(
        roles.select("id", F.lit(0).alias("kind"), F.lit("").alias("url"), F.col("sha").alias("payload"), "to", "whole"))
    n = len(bounds) + 1
    placed = mixed.withColumn("shard", shard.cast("int")).repartitionByRange(n, "shard").sortWithinPartitions(
        "shard", "id", "kind", "payload", "url")

    def save(batches):
        mark = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        sink, files, now, roles_now = None, [], None, {}

        def close():
            nonlocal sink
            if sink:
                sink["stream"].close()
                files.append({k: sink[k] for k in ("shard", "file", "temporary", "final", "bytes", "records", "first_id", "last_id")}
                             | {"sha1": sink["hash"].hexdigest()})
                sink = None

        for batch in batches:
            for row in batch.to_pylist():
                if (row["shard"], row["id"]) != now:
                    now, roles_now = (row["shard"], row["id"]), {}
                if row["kind"] == 0:
                    roles_now[row["payload"]] = [row["to"], row["whole"]]
                    continue
                payload, sha = row["payload"], hashlib.sha1(row["payload"]).digest()
                role = roles_now.get(sha)
                refers = (role[0], "") if role and role[1] else None
                if role and not role[1]:
                    role[1] = True  # the first of repeated rows is the response, the others revisit it
                data = gzip.compress(record(row["id"], row["url"], payload, base64.b32encode(sha).decode(), refers),
                                     compresslevel=6, mtime=0)
                if sink and (sink["shard"] != row["shard"] or sink["bytes"] + len(data) > file_bytes):
                    close()
                if not sink:
                    k = sum(f["shard"] == row["shard"] for f in files)
                    final = f"part-{row['shard']:06d}-{k:05d}.warc.gz"
                    sink = {"shard": row["shard"], "file": k, "temporary": f"_temporary/{mark}-{final}", "final": final,
                            "bytes": 0, "records": 0, "first_id": row["id"], "last_id": None, "hash": hashlib.sha1()}
                    store, at = _open(f"{out}/{sink['temporary']}")
                    store.create_dir(posixpath.dirname(at), recursive=True)
                    sink["stream"] = store.open_output_stream(at, compression=None)
                sink["stream"].write(data)
                sink["hash"].update(data)
                sink["bytes"] += len(data)
                sink["records"] += 1
                sink["last_id"] = row["id"]
        close()
        if files:
            yield pa.RecordBatch.from_pylist(files, schema=_MANIFEST)

    # Written files are listed in a table before anything reads the list: a re-run task can't change it.
    listed, _ = written(placed.mapInArrow(save, MANIFEST), "warc-manifest")

    def commit(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, final = _open(f"{out}/{row['final']}")
                temporary = posixpath.join(posixpath.dirname(final), row["temporary"])
                if store.get_file_info(temporary).type != fs.FileType.NotFound:
                    store.move(temporary, final)
                elif (done := store.get_file_info(final)).type == fs.FileType.NotFound or done.size != row["bytes"]:
                    raise OSError(f"{final} is neither written nor committed")
            yield batch

    _dealt(listed).mapInArrow(commit, MANIFEST).write.mode("overwrite").parquet(f"{out}/_manifest")
    return spark.read.schema(listed.schema).parquet(f"{out}/_manifest")


def _dealt(listed: DataFrame) -> DataFrame:
    """Manifest rows over tasks of their own: the table is tiny, so without a number they would meet in one task."""
    return listed.repartition(max(1, min(listed.count(), READERS)))


_MANIFEST = pa.schema([("shard", pa.int32()), ("file", pa.int32()), ("temporary", pa.string()), ("final", pa.string()),
                       ("bytes", pa.int64()), ("sha1", pa.string()), ("records", pa.int64()), ("first_id", pa.int64()),
                       ("last_id", pa.int64())])
READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
_READ = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]


def read(spark: SparkSession, out: str, payloads: bool = True) -> DataFrame:
    """Every record of the committed archives under ``out``, digests checked; revisits carry no payload."""
    listed = spark.read.schema(MANIFEST).parquet(f"{out}/_manifest").select("final", "records", "bytes")
    schema = pa.schema([f for f in _READ if payloads or f[0] != "payload"])

    def load(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _open(f"{out}/{row['final']}")
                rows, held, total = [], 0, 0
                with store.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for headers, block in parse(stream):
                        if "sha1:" + digest(block) != headers["WARC-Block-Digest"]:
                            raise ValueError(f"{path}: block digest differs")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind, sha = headers["WARC-Type"], headers["WARC-Payload-Digest"][5:]
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        if kind == "response" and (len(payload) != size or digest(payload) != sha):
                            raise ValueError(f"{path}: payload digest differs")
                        ident, to = headers.get("X-Id"), headers.get("X-Refers-To-Id")
                        rows.append({"page_id": ident and int(ident), "url": unquote(target) if (target := headers["WARC-Target-URI"]) and "X-Target-URI-Escaped" in headers else target, "payload": payload,
                                     "payload_bytes": size, "payload_digest": sha, "record_type": kind,
                                     "refers_to": int(to) if to not in (None, "None") else None})
                        held += len(payload)
                        total += 1
                        if len(rows) >= 2000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if total != row["records"]:
                    raise ValueError(f"{path}: {total} records, the manifest says {row['records']}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = READ if payloads else READ.replace("payload binary, ", "")
    return _dealt(listed).mapInArrow(load, kinds)
