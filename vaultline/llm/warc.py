"""WARC archives: a writer with revisit records and a salvage reader.

Writing: every row becomes one gzip member. Of rows with equal payloads (of at
least ``min_revisit`` bytes) the one with the largest page id is the response
and the others are revisits that refer to it. A task rolls to a new file after
``max_archive`` bytes. A manifest lists the files of the tasks that succeeded;
files of failed attempts are never read.

Reading: members are read as a stream, one record in memory at a time. A
record must have a version line, the announced length and, where its digest is
of a known algorithm (in hex or base32), the right block digest. After a failed check the reader
searches for the next version line, in the member's content as long as it decompresses, then for the next
gzip magic or version line of the archive from which a record passes; it goes on there
and logs the bytes between as a quarantined gap with the reason. Of a member that breaks
off or fails its own check, the records with a right digest are kept. ``offset`` and ``end``
are bytes of the archive (of the whole member); ``inner`` and ``inner_end`` are bytes of the member's content,
null for plain records and for gaps outside of members. A header of over 1 MiB is a gap.

Defined results: a null payload is empty; a null page id is left out of the
record and comes back null (it ranks below all others); repeated rows of the
largest id are all responses; a damaged or empty archive yields its valid
records and one gap per damaged stretch; a missing url is left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialize

DATE = "2024-01-01T00:00:00Z"
MAX_ARCHIVE = 32 << 20
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
BLOCK = 1 << 16
# Record format of WARC 1.1 and the profile for equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, records long, bytes long"
RECORDS = ("archive string, offset long, end long, status string, reason string, record_type string, page_id string, "
           "url string, refers_to string, payload_bytes long, payload_digest string, payload binary, inner long, inner_end long")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One uncompressed record. A revisit keeps the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest(payload)}')}>",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def open_store(path: str):
    """(file system, path in it) of a local path or a URI, on any executor."""
    from pyarrow import fs
    if re.match(r"file:/[^/]", path):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   min_revisit: int = 0, max_archive: int = MAX_ARCHIVE) -> DataFrame:
    """Write the archives under ``folder``; gives the manifest."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(payload), F.lit("")).alias("payload")).withColumn("sha", F.sha1("payload"))
    # The largest id per payload: summed up before the shuffle, so copies cost one row a task.
    last = rows.groupBy("sha").agg(F.max("page_id").alias("last"))
    refers = F.when((F.octet_length("payload") >= min_revisit) & F.col("last").isNotNull()
                    & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    rows = rows.join(last, "sha").select("page_id", "url", "payload", refers.alias("refers_to"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        out, name, size, count = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        system, base = open_store(folder)
        system.create_dir(base, recursive=True)
        try:
            for b in batches:
                for pid, u, text, ref in zip(*(b.column(i).to_pylist() for i in range(4))):
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"  # of this attempt only
                        out, size, count = system.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                    data = member(record(pid, u, text.encode("utf-8"), ref))
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= max_archive:
                        out.close()
                        done.append((name, count, size))
                        out = None
        finally:
            if out is not None:
                out.close()
                done.append((name, count, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder.rstrip('/')}/{x[0]}" for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()),
             pa.array([x[2] for x in done], pa.int64())], names=["archive", "records", "bytes"])

    return materialize(rows.mapInArrow(run, MANIFEST), "warc-manifest")


class Damage(Exception):
    """Why a member cannot be read on."""


class Salvage:
    """Records and gaps of one archive, read by offset."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.small: tuple[int, list[dict]] = (-1, [])  # the last member tried, if its content is small

    def at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(min(n, max(0, self.size - offset)))

    def __iter__(self) -> Iterator[dict]:
        at = 0
        while at < self.size:
            why, end = self.probe(at)
            if end is None:
                # Nothing sound starts here, or a member that breaks off: up to the next one that gives a record.
                if why is None:
                    # Behind its last record: a stored stretch holds records that are readable as plain ones, too.
                    last = max(r["inner_end"] for r in self.parts(at, at, False) if r["status"] == "record")
                    end = self.next_valid(self.reach(at, last))
                    yield from self.parts(at, end, False)
                else:
                    end = self.next_valid(at + 1)
                    yield {"status": "gap", "offset": at, "end": end, "reason": why}
            elif self.at(at, len(MAGIC)) == MAGIC:
                yield from self.parts(at, end, True)
            else:
                yield self.plain(at)[0] | {"status": "record", "offset": at, "end": end}
            at = end

    def parts(self, at: int, end: int, sound: bool) -> Iterator[dict]:
        """Records and gaps in the content of the member at ``at``."""
        for r in self.small[1] if self.small[0] == at else self.content(self.inflate(at), sound):
            yield r | {"offset": at, "end": end}

    def next_valid(self, start: int) -> int:
        """The first offset from ``start`` that gives a record; else the archive's end."""
        at, keep = start, len(VERSION) - 1
        while at < self.size:
            window = self.at(at, BLOCK + keep)
            for m in re.finditer(re.escape(MAGIC) + b"|" + re.escape(VERSION), window):
                why, _ = self.probe(at + m.start())
                if why is None:
                    return at + m.start()
            at += BLOCK
        return self.size

    def probe(self, at: int) -> tuple[str | None, int | None]:
        """(why no record starts at ``at``, or None; the end of the plain record or of the sound member
        there, or None)."""
        head = self.at(at, len(VERSION))
        if head == VERSION:
            got, size = self.plain(at)
            return (got, None) if isinstance(got, str) else (None, at + size)
        if not head.startswith(MAGIC):
            return "neither member nor version line", None
        end, why, pieces, size = None, None, [], 0
        try:
            for piece, end in self.inflate(at):
                size += len(piece)
                if size <= 16 * BLOCK:
                    pieces.append((piece, end))
        except Damage as exc:
            end, why = None, exc
        # A record in it makes it a member; in a large one the first record ends the search.
        if size <= 16 * BLOCK:
            self.small = at, list(self.content(self.again(pieces, why), end is not None))
            found = self.small[1]
        else:
            found = self.content(self.inflate(at), end is not None)
        if any(r["status"] == "record" for r in found):
            return None, end
        return str(why or "no record in member"), None

    @staticmethod
    def again(pieces: list[tuple[bytes, int | None]], why: Damage | None) -> Iterator[tuple[bytes, int | None]]:
        yield from pieces
        if why:
            raise why

    def reach(self, at: int, inner: int) -> int:
        """The archive's byte by which ``inner`` bytes of the member's content have come out."""
        unzip, pos, out = zlib.decompressobj(31), at, 0
        while out < inner:
            before, chunk = unzip.copy(), self.at(pos, BLOCK)
            try:
                n = len(unzip.decompress(chunk))
            except zlib.error:
                n = inner
            if out + n >= inner:  # in this block: byte by byte
                for k in range(len(chunk)):
                    out += len(before.decompress(chunk[k:k + 1]))
                    if out >= inner:
                        return pos + k + 1
            pos, out = pos + len(chunk), out + n
        return pos

    def inflate(self, at: int) -> Iterator[tuple[bytes, int | None]]:
        """The member's content in pieces; with the last one, the member's end."""
        unzip, pos = zlib.decompressobj(31), at
        while True:
            chunk = self.at(pos, BLOCK)
            if not chunk:
                raise Damage("truncated member")
            pos += len(chunk)
            while True:
                before = unzip.copy()
                try:
                    out = unzip.decompress(chunk, 4 * BLOCK)
                except zlib.error as exc:
                    # What comes out ahead of the damage, byte by byte.
                    try:
                        for k in range(len(chunk)):
                            yield before.decompress(chunk[k:k + 1]), None
                    except zlib.error:
                        pass
                    raise Damage(f"broken member: {exc}") from exc
                chunk = unzip.unconsumed_tail
                if unzip.eof:
                    yield out, pos - len(unzip.unused_data)
                    return
                yield out, None
                if not chunk and len(out) < 4 * BLOCK:
                    break

    def content(self, pieces: Iterator[tuple[bytes, int | None]], sound: bool) -> Iterator[dict]:
        """Records and gaps of a member's content, by inner offsets. Of a member
        that is not ``sound`` only records with a right digest are records."""
        data, base, i, done = bytearray(), 0, 0, None
        bad, why = None, ""

        def more() -> None:
            nonlocal done
            try:
                data.extend(next(pieces)[0])
            except StopIteration:
                done = "end of member"
            except Damage as exc:
                done = str(exc)

        while True:
            if i > 16 * BLOCK:  # what is read goes, now and then
                del data[:i]
                base, i = base + i, 0
            if i >= len(data):
                if done:
                    break
                more()
                continue
            got, n = parse(data, i)
            if isinstance(got, str) and n > len(data) - i and not done:
                while len(data) - i < n and not done:
                    more()
                continue
            if not isinstance(got, str) and not sound and not got["checked"]:
                got, n = "no digest in a damaged member", 0
            if isinstance(got, str):
                if bad is None:
                    bad, why = base + i, got
                keep = len(VERSION) - 1
                found = data.find(VERSION, i + 1)
                while found < 0 and not done:
                    start = max(i + 1, len(data) - keep)
                    more()
                    found = data.find(VERSION, start)
                i = found if found >= 0 else len(data)
                continue
            if bad is not None:
                yield {"status": "gap", "reason": why, "inner": bad, "inner_end": base + i}
                bad = None
            yield got | {"status": "record", "inner": base + i, "inner_end": base + i + n}
            i += n
        if done != "end of member" and bad is None:
            bad, why = base + i, done
        if bad is not None:
            yield {"status": "gap", "reason": why if done == "end of member" else f"{why}; {done}" if why != done else why,
                   "inner": bad, "inner_end": base + i}

    def plain(self, at: int) -> tuple[dict | str, int]:
        """The record outside of a member at ``at`` and its size, or why there is none.
        As much is read as its header announces."""
        n = BLOCK
        while True:
            data = self.at(at, n)
            got, used = parse(data)
            if not isinstance(got, str) or used <= len(data) or len(data) < n:
                return got, used
            n = max(used, 2 * n)


def parse(data: bytes | bytearray, start: int = 0) -> tuple[dict | str, int]:
    """The record at ``start`` and its size; or why there is none, and how many
    bytes it would take to tell."""
    cut = data.find(b"\r\n\r\n", start)
    there = len(data) - start
    if cut < 0:
        return "no end of header", there + BLOCK if there < 16 * BLOCK else 0
    lines = bytes(data[start:cut]).split(b"\r\n") if cut - start <= 16 * BLOCK else [b""]
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        return "no version line", 0
    fields = {}
    for line in lines[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            return "malformed header line", 0
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    if not re.fullmatch("[0-9]+", fields.get("content-length", "")):
        return "no length", 0
    block_at = cut + 4
    size = block_at - start + int(fields["content-length"])
    if there < size + 4:
        return "truncated block", size + 4
    block = bytes(data[block_at:start + size])
    if data[start + size:start + size + 4] != b"\r\n\r\n":
        return "wrong length", 0
    right = agrees(fields.get("warc-block-digest"), block)
    if right is False:
        return "wrong block digest", 0
    return _content(fields, block) | {"checked": bool(right)}, size + 4


def agrees(told: str | None, block: bytes) -> bool | None:
    """Whether ``algorithm:value`` is the block's digest, in hex or base32 of either case;
    None where there is none or the algorithm is not known."""
    name, _, value = (told or "").partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512"):
        return None
    raw = hashlib.new(name, block).digest()
    return value.strip().rstrip("=").lower() in (raw.hex(), base64.b32encode(raw).decode().rstrip("=").lower())


def _content(fields: dict, block: bytes) -> dict:
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank:
        http, payload = b"", block
    revisit = fields.get("warc-type") == "revisit"
    told = re.search(rb"(?im)^content-length:\s*([0-9]+)", http)
    uri = fields.get("warc-target-uri")
    return {
        "record_type": fields.get("warc-type"), "page_id": fields.get("x-page-id"),
        "url": uri and uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "refers_to": fields.get("x-refers-to-page"),
        # A revisit's payload is elsewhere: its HTTP header and digest still describe it.
        "payload_bytes": int(told[1]) if revisit and told else len(payload),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest(payload),
        "payload": None if revisit else payload}


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the files in column ``archive``. ``status`` is record
    or gap; ``offset`` and ``end`` are bytes of the archive."""
    spark = archives.sparkSession
    paths = archives.select("archive").filter(F.col("archive").isNotNull())
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), paths.count()))
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        kinds = {"payload": pa.binary(), **dict.fromkeys(("offset", "end", "payload_bytes", "inner", "inner_end"), pa.int64())}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema=schema)

        for b in batches:
            for path in b.column(0).to_pylist():
                system, inner = open_store(path)
                with system.open_input_file(inner) as f:
                    rows, weight = [], 0
                    for r in Salvage(f, f.size()):
                        weight += len(r.get("payload") or b"") if with_payload else 0
                        rows.append(r | {"archive": path} | ({} if with_payload else {"payload": None}))
                        if len(rows) >= 2000 or weight > 8 << 20:
                            yield batch(rows)
                            rows, weight = [], 0
                    if rows:
                        yield batch(rows)

    return paths.repartition(tasks).mapInArrow(run, RECORDS)
