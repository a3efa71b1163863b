"""WARC archives and their capture index: sorted runs merged by loser trees.

Writing tasks lay gzip members, one a record, into archives in the shared folder. Reading tasks parse an
archive from front to back, check its digests, and leave its captures as a run sorted by URL key, timestamp
and id. Runs are merged FAN at a time into longer ones until FAN are left; the last merge is cut into ranges
of the whole key, by a sample of the runs' keys, and each task merges its slice of every run. Merging reads
runs by batches, so its memory is FAN batches whatever the runs' length. Each task writes files under names of its own
and only those that a finished task reports are read, so a repeated task does no harm.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from .common import parallelism, scratch, small_side, stored

#: Least payload of which a repetition is a revisit (fixed by the contract).
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
FAN = 64
SAMPLES = 32  # keys of a run that are looked at for the cuts
ENTRY = pa.schema([
    ("url_key", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
])
ENTRY_SQL = "url_key string, timestamp string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, offset long, length long"
_EPOCH = datetime.datetime(2020, 1, 1)


def url_key(url: str) -> str:
    """The sort-friendly form of a URL: host reversed, lower case, no scheme, user, default port or fragment."""
    rest = url.strip().split("#", 1)[0]
    rest = rest.split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    host = host.rsplit("@", 1)[-1].lower().removesuffix(":80").removesuffix(":443").removeprefix("www.")
    return f"{','.join(reversed(host.split('.')))}){(slash + path).lower() or '/'}"


def _stamp(page: int | None) -> datetime.datetime:
    """Tables of pages have no capture time: the id counts seconds from an epoch."""
    return _EPOCH + datetime.timedelta(seconds=(page or 0) % (1 << 31))


def _id(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _page(record_id: str) -> int | None:
    number = record_id.rpartition(":")[2].rstrip(">")
    return int(number) if number else None


def record(page: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record (headers without payload) if refers_to is given."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {_id(page)}",
        f"WARC-Date: {_stamp(page):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {urllib.parse.quote(url, safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def _writer(folder: str):
    """(page_id, url, html, refers_to) -> (archive, records): writes archives."""

    def run(batches):
        fs, root = _place(folder)
        fs.create_dir(root, recursive=True)
        out, name, n, size = None, None, 0, 0
        for batch in batches:
            for page, url, html, ref in zip(*(batch.column(i).cast(pa.binary()).to_pylist() if i == 2 else batch.column(i).to_pylist() for i in range(4))):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = pack.compress(record(page, url or "", html or b"", ref)) + pack.flush()
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "records"])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "records"])

    return run


def members(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a stream."""
    held, at = b"", 0
    while True:
        unpack, content, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            if not held:
                held = stream.read(chunk)
                if not held:
                    if content or used:
                        raise ValueError("archive ends within a record")
                    return
            content.append(unpack.decompress(held))
            used += len(held) - len(unpack.unused_data)
            held = unpack.unused_data
        yield at, used, b"".join(content)
        at += used


def _headers(text: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in text.decode().split("\r\n")[1:] if ":" in line)}


def parsed(content: bytes) -> dict:
    """The index entry of a record; its digest is that of the payload read, checked against the header."""
    head, _, rest = content.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = warc["warc-type"]
    digest = base64.b32decode(warc["warc-payload-digest"].partition(":")[2]).hex()
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"digest of {warc['warc-record-id']} does not match its payload")
    stamp = datetime.datetime.strptime(warc["warc-date"], "%Y-%m-%dT%H:%M:%SZ")
    return {
        "url_key": url_key(urllib.parse.unquote(warc["warc-target-uri"])), "timestamp": f"{stamp:%Y%m%d%H%M%S}", "page_id": _page(warc["warc-record-id"]), "record_type": kind,
        "payload_bytes": len(payload) if kind == "response" else int(_headers(http)["content-length"]), "payload_digest": digest,
        "refers_to": _page(warc["warc-refers-to"]) if kind == "revisit" else None,
    }


def _key(entry: tuple) -> tuple:
    """The order of captures; entries are tuples in the order of ENTRY."""
    return entry[0], entry[1], -1 if entry[2] is None else entry[2], entry[7], entry[8]


def _write_run(fs, root: str, entries: Iterable[tuple]) -> tuple[str, int, list[str]]:
    """Writes sorted entries as a run; its name, length and some of its keys."""
    name, n, keys = f"{uuid.uuid4().hex}.run", 0, []
    with fs.open_output_stream(f"{root}/{name}") as out, pq.ParquetWriter(out, ENTRY, compression="zstd") as writer:
        for part in _chunks(entries, 4096):
            writer.write_table(pa.table(list(map(list, zip(*part))), schema=ENTRY))
            keys += [_text(e) for e in part[:: max(1, 4096 // SAMPLES)]]
            n += len(part)
    return name, n, keys[:: max(1, len(keys) // SAMPLES)]


def _chunks(entries: Iterable[tuple], n: int) -> Iterator[list[tuple]]:
    part = []
    for e in entries:
        part.append(e)
        if len(part) == n:
            yield part
            part = []
    if part:
        yield part


def _text(entry: tuple) -> str:
    """Where ranges may be cut: within a URL's history too, by its timestamps."""
    return f"{entry[0]}\x00{entry[1]}"


def _read_run(fs, path: str, low: str | None, high: str | None) -> Iterator[tuple]:
    """The entries of a run with low <= text < high; row groups outside are not read."""
    with fs.open_input_file(path) as source:
        found = pq.ParquetFile(source)
        for g in range(found.num_row_groups):
            stats = found.metadata.row_group(g).column(0).statistics
            if stats is not None and stats.has_min_max and ((low is not None and stats.max < low.partition("\x00")[0]) or (high is not None and stats.min > high.partition("\x00")[0])):
                continue
            for batch in found.iter_batches(1024, row_groups=[g]):
                for entry in zip(*(c.to_pylist() for c in batch.columns)):
                    text = _text(entry)
                    if (low is None or text >= low) and (high is None or text < high):
                        yield entry


def merged(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Loser-tree merge of sorted iterators: each step replays one path, log2(runs) comparisons."""
    k = len(runs)
    if not k:
        return
    heads = [next(r, None) for r in runs]
    keys = [None if h is None else _key(h) for h in heads]

    def less(i: int, j: int) -> bool:
        if keys[i] is None or keys[j] is None:
            return keys[j] is None and keys[i] is not None
        return keys[i] <= keys[j] if i < j else keys[i] < keys[j]

    losers = [0] * k  # losers[1:] are the inner nodes, leaf i hangs below node (i + k) // 2

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        won, lost = (a, b) if less(a, b) else (b, a)
        losers[node] = lost
        return won

    winner = play(1) if k > 1 else 0
    while keys[winner] is not None:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        keys[winner] = None if heads[winner] is None else _key(heads[winner])
        node = (winner + k) // 2
        while node >= 1:
            if less(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


_RUN_SQL = "run string, n long, keys array<string>"


def _run_row(row: tuple[str, int, list[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[0]]), pa.array([row[1]], pa.int64()), pa.array([row[2]], pa.list_(pa.string()))], names=["run", "n", "keys"])


def _indexer(folder: str):
    """(archive) -> (run, n, keys): reads an archive and leaves its captures as a sorted run."""

    def run(batches):
        fs, root = _place(folder)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                entries = []
                with fs.open_input_stream(f"{root}/{archive}", compression=None) as stream:
                    for offset, length, content in members(stream):
                        entries.append((*parsed(content).values(), archive, offset, length))
                yield _run_row(_write_run(fs, root, sorted(entries, key=_key)))

    return run


def _merger(folder: str):
    """(runs) -> (run, n, keys): merges each row's runs into one."""

    def run(batches):
        fs, root = _place(folder)
        for batch in batches:
            for names in batch.column(0).to_pylist():
                yield _run_row(_write_run(fs, root, merged([_read_run(fs, f"{root}/{n}", None, None) for n in names])))

    return run


def _range_merger(folder: str, names: list[str]):
    """(low, high) -> the entries of that range, merged from all runs."""

    def run(batches):
        fs, root = _place(folder)
        for batch in batches:
            for low, high in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in _chunks(merged([_read_run(fs, f"{root}/{n}", low, high) for n in names]), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, zip(*part)), ENTRY)], schema=ENTRY)

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages(page_id, url, html) as archives in folder; (archive, records) of each.

    Of records with equal payloads of at least REVISIT_BYTES bytes that with the largest page_id is the response, the
    others revisit it. Of repeated rows of that page_id all are responses. Rows with a null page_id are responses.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("html"), F.when(F.length(payload) >= REVISIT_BYTES, F.sha1(payload)).alias("d"))
    several = hashed.where("d is not null").groupBy("d").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("d", "last")
    ref = F.when(F.col("page_id") < F.col("last"), F.col("last"))
    # Small payloads have no digest here and need no join: as one key they would meet in one task.
    small = hashed.where("d is null").select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to"))
    marked = hashed.where("d is not null").join(small_side(stored(several, "repeated")), "d", "left").select("page_id", "url", "html", ref.alias("refers_to")).unionByName(small)
    return stored(marked.mapInArrow(_writer(folder), "archive string, records long"), "archives")


def capture_histories(archives: DataFrame, folder: str) -> DataFrame:
    """Reads the archives (archive) in folder back: their captures (ENTRY), globally ordered by URL key, timestamp and id."""
    spark = archives.sparkSession
    n = parallelism(spark)
    dealt = archives.select("archive").repartition(n)
    runs = stored(dealt.mapInArrow(_indexer(folder), _RUN_SQL), "runs")
    while (count := runs.count()) > FAN:
        sets = runs.select("run", F.pmod(F.xxhash64("run"), F.lit(-(-count // FAN) * 2)).alias("s")).groupBy("s").agg(F.sort_array(F.collect_list("run")).alias("runs"))
        runs = stored(sets.select("runs").repartition(n).mapInArrow(_merger(folder), _RUN_SQL), "runs")
    found = runs.select("run", "keys").collect()  # at most FAN runs, SAMPLES keys of each
    keys = sorted(k for r in found for k in r["keys"])
    cuts = sorted({keys[i * len(keys) // n] for i in range(1, n)}) if keys else []
    ranges = spark.createDataFrame(list(zip(range(len(cuts) + 1), [None, *cuts], [*cuts, None])), "i int, low string, high string").repartitionByRange(len(cuts) + 1, "i")
    return ranges.select("low", "high").mapInArrow(_range_merger(folder, sorted(r["run"] for r in found)), ENTRY_SQL)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages as archives, reads them back: the capture histories (ENTRY), one row a page.

    Null html is an empty payload, a null url an empty one; an empty table gives no rows; extra columns are ignored.
    """
    folder = scratch(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("/"):
        folder = f"/{folder}"
    return capture_histories(write_archives(pages, folder), folder)


SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
last AS (SELECT d, max(page_id) AS last, count(*) AS c FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
       CASE WHEN last.c > 1 AND p.page_id < last.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last.c > 1 AND p.page_id < last.last THEN last.last END AS refers_to
FROM p LEFT JOIN last ON p.d = last.d AND p.n >= 1000
"""
