"""WARC archives of web captures, and their index by external merge.

Writing: every task writes its captures as gzip members of one or more archive
files in the shared folder and yields the index entries of each file as a
sorted run. Captures with equal payloads become revisits of one of them.

Index: runs are dealt to ranges of (URL key, timestamp, id), so a URL with very
many captures is split too; inside a range the runs meet in a k-way merge by a
loser tree, which gives capture histories in global order.

Reading: entries of the merged index are followed into the archives, each
record is parsed, and payloads are hashed again.

A task that is run again writes files of another name; only entries of
attempts that ended are ever followed. Nulls: a null payload is empty, a null
URL an empty one, a null id is kept; among equal payloads the largest id is the
response and rows without id are revisits. Rows repeating the id of the
response are responses too. Columns not named are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut, scratch_path

FILE_BYTES = 256 << 20  # an archive file is closed beyond this size
OPEN_FILES = 64  # archives a reading task keeps open
INDEX = "url_key string, ts string, page_id long, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then path and query: captures of a site sort together."""
    plain = F.coalesce(url, F.lit(""))
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)([^#]*)"
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(plain, pattern, 1)), r"\.")), ",")
    known = F.concat(host, F.lit(")"), F.lower(F.regexp_extract(plain, pattern, 2)))
    return F.when(plain.rlike(pattern), known).otherwise(F.lower(plain))


def captures(pages: DataFrame, key: str, url: str, payload: str, ts: Column, min_bytes: int) -> DataFrame:
    """(page_id, url, url_key, ts, payload, digest, refers_to): equal payloads of `min_bytes` or more refer to the largest id."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        url_key(F.col(url)).alias("url_key"), ts.alias("ts"), body.alias("payload"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("size"),
    )
    shared = (
        rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
        .filter(F.col("n") > 1).select("digest", "size", "first")
    )
    # A written table has a known size, from which Spark chooses how to join.
    joined = rows.join(cut(shared, "shared-payloads"), ["digest", "size"], "left")
    refers = F.when(F.col("first") != F.coalesce(F.col("page_id"), F.col("first") - 1), F.col("first"))
    return joined.select("page_id", "url", "url_key", "ts", "payload", "digest", refers.alias("refers_to"))


def _header(value: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str, ts: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member. The HTTP header of a revisit keeps the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {ts}",
        f"WARC-Target-URI: {_header(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def parse(member: bytes) -> dict:
    """(page_id, record_type, refers_to, payload_bytes, payload_digest) of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda name: int(text) if (text := fields[name].removeprefix("<urn:x-page:").rstrip(">")) else None
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    return {
        "page_id": number("WARC-Record-ID"), "record_type": fields["WARC-Type"], "payload_bytes": size, "payload_digest": digest,
        "refers_to": number("WARC-Refers-To") if fields["WARC-Type"] == "revisit" else None, "url": fields["WARC-Target-URI"], "ts": fields["WARC-Date"],
    }


def _uri(folder: str) -> str:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder.removeprefix("file:")
    return folder if "://" in folder else f"file://{folder}"


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes `captures` under `folder` (any URI that pyarrow opens); returns the stored index, run after run."""

    def run(batches):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(_uri(folder))
        store.create_dir(path, recursive=True)
        task = TaskContext.get()
        name = f"{path}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, entries, number, at = None, [], 0, 0

        def close():
            out.close()
            entries.sort(key=lambda e: (e[0], e[1], e[2] is not None, e[2] or 0, e[4]))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*entries, strict=True), _INDEX_TYPES, strict=True)], _INDEX_NAMES)

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    file = f"{name}-{number:04d}.warc.gz"
                    out, entries, at = store.open_output_stream(file, compression=None), [], 0
                member = record(r["page_id"], r["url"], r["ts"], r["payload"].encode(), r["digest"], r["refers_to"])
                out.write(member)
                entries.append((r["url_key"], r["ts"], r["page_id"], file, at, len(member)))
                at += len(member)
                if at >= FILE_BYTES:
                    yield close()
                    out, number = None, number + 1
        if out is not None:
            yield close()

    return cut(rows.mapInArrow(run, INDEX), "capture-runs")


_INDEX_NAMES = ["url_key", "ts", "page_id", "file", "offset", "length"]
_INDEX_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


def loser_tree(runs: list[Iterator]) -> Iterator:
    """Merges sorted iterators of comparable items; every item costs one path of comparisons to the root."""
    k = len(runs)
    heads = [next(r, None) for r in runs]
    less = lambda a, b: heads[b] is None or (heads[a] is not None and heads[a] <= heads[b])
    losers = [-1] * max(k, 1)

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        losers[node], winner = (b, a) if less(a, b) else (a, b)
        return winner

    if k == 0:
        return
    winner = play(1) if k > 1 else 0
    while heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        node = (winner + k) // 2
        while node >= 1:
            if not less(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node //= 2


def merge_runs(index: DataFrame) -> DataFrame:
    """The index in order of (url_key, ts, page_id): ranges of it are partitions, each merged from its pieces of the runs."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["url_key", "ts", "page_id", "file", "offset"]
    dealt = index.repartitionByRange(n, *order).sortWithinPartitions("file", *order[:3], "offset")

    def run(batches):
        held = list(batches)  # entries of one range only
        if not held:
            return
        table = pa.Table.from_batches(held)
        columns = [table.column(c).to_pylist() for c in _INDEX_NAMES]
        entry = lambda i: (columns[0][i], columns[1][i], columns[2][i] is not None, columns[2][i] or 0, columns[3][i], columns[4][i], i)
        cuts = [i for i in range(1, table.num_rows) if columns[3][i] != columns[3][i - 1]]
        merged = loser_tree([map(entry, range(a, b)) for a, b in zip([0, *cuts], [*cuts, table.num_rows], strict=True)])
        yield from table.take(pa.array([e[-1] for e in merged], pa.int64())).to_batches(max_chunksize=10_000)

    return dealt.mapInArrow(run, INDEX)


_RECORD = {"page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "url": pa.string(), "ts": pa.string()}


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload_bytes, payload_digest, url, ts, url_key, n_capture) in index order.

    `n_capture` counts the captures of a URL key met so far inside one task.
    """

    def run(batches):
        from collections import OrderedDict

        from pyarrow import fs

        store, files, last, n = fs.FileSystem.from_uri(_uri(folder))[0], OrderedDict(), None, 0
        for batch in batches:
            made, captured = [], []
            for e in batch.to_pylist():
                name = e["file"]
                if name not in files:
                    files[name] = store.open_input_file(name)
                    if len(files) > OPEN_FILES:
                        files.popitem(last=False)[1].close()
                made.append(parse(files[name].read_at(e["length"], e["offset"])))
                n = n + 1 if e["url_key"] == last else 1
                last = e["url_key"]
                captured.append(n)
            arrays = [pa.array([m[c] for m in made], t) for c, t in _RECORD.items()]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("url_key"), pa.array(captured, pa.int64())], [*_RECORD, "url_key", "n_capture"])

    return index.mapInArrow(run, "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, url string, ts string, url_key string, n_capture long")


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", ts: Column | None = None, min_bytes: int = 1000, folder: str | None = None) -> DataFrame:
    """Writes the pages, merges the index and reads every capture back."""
    when = F.lit("1970-01-01T00:00:00Z") if ts is None else ts
    folder = folder or scratch_path(pages.sparkSession, "warc")
    runs = write_archives(captures(pages, key, url, payload, when, min_bytes), folder)
    return read_archives(cut(merge_runs(runs), "capture-index"), folder)
