"""WARC archives: a writer with one gzip member per record, and a reader that salvages damaged files.

Writing: tasks write files of about ``FILE_BYTES`` under names of their own into a folder all machines share, and return one
manifest row per record. Only files of the manifest count, so what a lost or repeated task has written is never read.
Records with equal payloads of ``REVISIT_BYTES`` or more are stored once: the one with the smallest id is a response, the others
are revisits that name it and its digest.

Reading: a file is read as a stream in pieces. A record is accepted when its gzip member is whole and passes its checksum (or,
in a plain file, stands between version line and end), its header is complete, its length fits and its block digest (md5, sha1, sha256 or sha512; hex, base32 or base64) agrees. A member may
hold several records: each that is sound counts, and all share the member's place. A member is held in memory whole.
After a failed check the reader searches, from the next byte on, for the next gzip member that begins a record, or the next version line,
and goes on there; the bytes in between are one quarantined gap with its place and the reason.

Nulls: a null payload is empty; a null id sorts last and is written as an empty id. Rows that repeat the smallest id of their
payload are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, packed, stage_table

FILE_BYTES = 16 << 20
REVISIT_BYTES = 100
PIECE = 1 << 16
#: A header in a plain file is read in this size first, then doubled while its lines are fields; neither headers nor payloads are bounded.
HEADER_BYTES = 1 << 16
VERSION = b"WARC/1.1"
_VERSION_LINE = re.compile(rb"WARC/1\.[0-9]\r\n")
_MAGIC = b"\x1f\x8b\x08"
#: A field name, a colon, and no control characters: binary data does not pass for a header.
_LINE = re.compile(rb"[!-9;-~]+:[^\x00-\x08\x0a-\x1f\x7f]*")
_FOLD = re.compile(rb"\r\n[ \t]+")
_LINE_BEGUN = re.compile(rb"[!-9;-~]*|" + _LINE.pattern)
_NO_END = "the header has no end"
#: What may not stand in a header line; in urls it is percent-encoded.
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"


def record(fields: list[tuple[str, str]], block: bytes, compressed: bool = True) -> bytes:
    """One record; the block's digest and length are added to ``fields``."""
    whole = [*fields, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in whole).encode() + b"\r\n"
    raw = head + block + b"\r\n\r\n"
    if not compressed:
        return raw
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _fields(page_id, url, kind: str, digest: str, refers_to) -> list[tuple[str, str]]:
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}")
    out = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", _DATE),
        ("WARC-Page-ID", "" if page_id is None else str(page_id)),
        ("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", (url or "").strip(" ")) or "about:blank"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "text/html"),
    ]
    if kind == "revisit":
        out += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>"), ("WARC-Refers-To-Page-ID", str(refers_to))]
    return out


def _written(folder: str):
    def run(batches):
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        sink, name, at, ids, places = None, "", 0, [], []
        for batch in batches:
            rows = batch.column("row")
            get = {f.name: rows.field(i) for i, f in enumerate(rows.type)}
            # Row by row: a batch may hold many long payloads.
            for i in range(batch.num_rows):
                if sink is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    sink, at = store.open_output_stream(f"{root}/{name}", compression=None), 0
                page, kind, refers = get["id"][i].as_py(), get["kind"][i].as_py(), get["refers_to"][i].as_py()
                payload = (get["payload"][i].as_py() or b"") if kind == "response" else b""
                raw = record(_fields(page, get["url"][i].as_py(), kind, get["digest"][i].as_py(), refers), payload)
                sink.write(raw)
                ids.append(page)
                places.append((name, at, len(raw)))
                at += len(raw)
                if at >= FILE_BYTES:
                    sink.close()
                    sink = None
                    yield _manifest(folder, ids, places)
                    ids, places = [], []
        if sink is not None:
            sink.close()
            yield _manifest(folder, ids, places)

    return run


def _manifest(folder: str, ids: list, places: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([f"{folder}/{n}" for n, _, _ in places]), pa.array([a for _, a, _ in places], pa.int64()), pa.array([n for _, _, n in places], pa.int64())],
        ["id", "path", "start", "bytes"],
    )


def write(pages: DataFrame, folder: str | None = None, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """Write one record per row; returns the manifest (id, path, start, bytes), itself a table in the shared folder."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_column).cast("bigint").alias("id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "long": F.octet_length("payload") >= REVISIT_BYTES})
    # Only digests that repeat have a first holder other than the row itself; they are few, and their rows meet them in a join
    # whose large partitions are split at run time.
    firsts = rows.where("long").groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    found = rows.join(firsts, "digest", "left")
    revisit = F.col("long") & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    planned = found.select(
        "id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("first")).alias("refers_to")
    )
    return stage_table(packed(planned).mapInArrow(_written(folder), "id bigint, path string, start bigint, bytes bigint"), "warc-manifest")


class _Window:
    """A stream with a look-ahead buffer; ``at`` is the place of the buffer's first byte in the file."""

    def __init__(self, stream):
        self.stream, self.buffer, self.at, self.ended = stream, bytearray(), 0, False

    def fill(self, n: int) -> bool:
        while len(self.buffer) < n and not self.ended:
            piece = self.stream.read(max(PIECE, n - len(self.buffer)))
            self.ended = not piece
            self.buffer += piece
        return len(self.buffer) >= n

    def skip(self, n: int) -> None:
        del self.buffer[:n]
        self.at += n


def _member(view: _Window) -> tuple[bytes, int] | str:
    """The content and the length of the gzip member at the front, or why there is none. The buffer grows with the member."""
    unpacker, out, done = zlib.decompressobj(31), [], 0
    while True:
        if not view.fill(done + 1):
            return "the file ends inside a gzip member"
        piece = bytes(view.buffer[done : done + PIECE])
        try:
            out.append(unpacker.decompress(piece))
        except zlib.error as problem:
            return f"bad gzip member: {problem}"
        done += len(piece) - len(unpacker.unused_data)
        if unpacker.eof:
            return b"".join(out), done
        if len(out) == 1 and not out[0].startswith(VERSION[:5]) and len(out[0]) >= 5:
            return "the gzip member holds no record"


def _header(raw: bytes) -> tuple[dict[str, str], int] | str:
    if not _VERSION_LINE.match(raw):
        return "no version line"
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return _NO_END
    fields: dict[str, str] = {}
    version, *lines = _FOLD.sub(b" ", raw[:end]).split(b"\r\n")
    if len(version) > len(VERSION):
        return "a header line is not a field"
    for line in lines:
        if not _LINE.fullmatch(line):
            return "a header line is not a field"
        name, _, value = line.partition(b":")
        fields[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch("[0-9]{1,18}", fields.get("content-length", "")) or "warc-type" not in fields:
        return "the header lacks type or length"
    return fields, end + 4


def _plain_header(view: _Window) -> tuple[dict[str, str], int] | str:
    """The header at the front of a plain file, however long."""
    n = HEADER_BYTES
    while True:
        more = view.fill(n)
        raw = bytes(view.buffer[:n])
        head = _header(raw)
        if head != _NO_END or not more:
            return head
        *lines, begun = _FOLD.sub(b" ", raw).split(b"\r\n")[1:]
        if not all(map(_LINE.fullmatch, lines)) or not _LINE_BEGUN.fullmatch(begun.removesuffix(b"\r")):
            return "a header line is not a field"
        n *= 2


def _block(fields: dict[str, str], block: bytes, tail: bytes) -> str | None:
    if len(block) != int(fields["content-length"]) or tail != b"\r\n\r\n":
        return "the length does not fit"
    kind, _, wanted = fields.get("warc-block-digest", "").partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind in ("md5", "sha1", "sha256", "sha512"):
        digest, wanted = hashlib.new(kind, block).digest(), wanted.strip().rstrip("=")
        forms = base64.b32encode(digest).decode().rstrip("="), base64.b64encode(digest).decode().rstrip("=")
        if wanted.lower() != digest.hex() and wanted.upper() != forms[0] and wanted != forms[1]:
            return "the block digest differs"
    return None


def _in_member(raw: bytes) -> list[tuple[dict[str, str], bytes] | str]:
    """The records of a member's content in order, and a reason for each stretch that is none."""
    out: list[tuple[dict[str, str], bytes] | str] = []
    at, view = 0, memoryview(raw)
    while at < len(raw) or not out:
        # The header ends where the first empty line stands; only that much is copied.
        end = raw.find(b"\r\n\r\n", at)
        found = _header(raw[at : end + 4 if end >= 0 else len(raw)])
        if not isinstance(found, str):
            fields, begin = found
            begin, n = at + begin, int(fields["content-length"])
            block = bytes(view[begin : begin + n])
            found = _block(fields, block, bytes(view[begin + n : begin + n + 4])) or (fields, block)
        if not isinstance(found, str):
            at = begin + n + 4
        else:
            following = _VERSION_LINE.search(raw, at + 1)
            at = following.start() if following else len(raw)
            if out and isinstance(out[-1], str):
                continue  # one gap
        out.append(found)
    return out


def _at_front(view: _Window) -> tuple[list[tuple[dict[str, str], bytes] | str], int] | str:
    """The records at the front, with reasons for what lies damaged between those of one member, and the bytes used; or why there is none."""
    view.fill(8)
    front = bytes(view.buffer[:8])
    if front.startswith(_MAGIC):
        got = _member(view)
        if isinstance(got, str):
            return got
        found = _in_member(got[0])
        return found[0] if all(isinstance(x, str) for x in found) else (found, got[1])
    elif front.startswith(b"WARC/1."):
        head = _plain_header(view)
        if isinstance(head, str):
            return head
        fields, at = head
        n = int(fields["content-length"])
        # A damaged length must not swallow the file: it is only believed if the end of the record is where it says.
        if not view.fill(at + n + 4):
            return "the length passes the end of the file"
        used, block, tail = at + n + 4, bytes(view.buffer[at : at + n]), bytes(view.buffer[at + n : at + n + 4])
    else:
        return "neither a gzip member nor a version line"
    problem = _block(fields, block, tail)
    return problem or ([(fields, block)], used)


def _next_start(view: _Window) -> int:
    """Skip to the next place, after the first byte, that may begin a record; returns the bytes skipped."""
    begun = view.at
    view.skip(1)
    while True:
        view.fill(PIECE)
        hits = [i for i in (view.buffer.find(_MAGIC), view.buffer.find(b"WARC/1.")) if i >= 0]
        if hits:
            view.skip(min(hits))
            return view.at - begun
        if view.ended:
            view.skip(len(view.buffer))
            return view.at - begun
        view.skip(len(view.buffer) - 6)  # a start may straddle the pieces


def records(stream) -> Iterator[tuple[str, int, int, dict[str, str] | None, bytes | str]]:
    """("record", start, bytes, fields, block) and ("gap", start, bytes, None, reason) in the order of the file."""
    view, gap, reason = _Window(stream), None, ""
    while view.fill(1):
        found = _at_front(view)
        if isinstance(found, str):
            if gap is None:
                gap, reason = view.at, found
            _next_start(view)
            continue
        if gap is not None:
            yield "gap", gap, view.at - gap, None, reason
            gap = None
        parts, used = found
        for part in parts:
            if isinstance(part, str):
                yield "gap", view.at, used, None, part
            else:
                yield "record", view.at, used, *part
        view.skip(used)
    if gap is not None:
        yield "gap", gap, view.at - gap, None, reason


_READ = "path string, what string, start bigint, bytes bigint, kind string, id string, refers_to string, url string, payload_digest string, payload binary, reason string"


def _read(batches):
    schema = pa.schema(
        [(c.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in _READ.split(", ")]
    )
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, name = pafs.FileSystem.from_uri(path)
            rows, held = [], 0
            with store.open_input_stream(name, compression=None) as stream:
                for what, start, n, fields, body in records(stream):
                    if what == "gap":
                        rows.append((path, what, start, n, None, None, None, None, None, None, body))
                    else:
                        get = fields.get
                        digest = get("warc-payload-digest", "").removeprefix("sha256:")
                        rows.append((path, what, start, n, get("warc-type"), get("warc-page-id") or None, get("warc-refers-to-page-id"), get("warc-target-uri"), digest, body, None))
                        held += len(body)
                    if held > 16 * PIECE or len(rows) >= 2000:
                        yield _rows(rows, schema)
                        rows, held = [], 0
            if rows:
                yield _rows(rows, schema)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read(paths: DataFrame) -> DataFrame:
    """Records and gaps of the files in the column ``path``, one file per task; ``what`` tells them apart."""
    files = paths.select("path").distinct()
    return files.repartition(max(1, files.count())).mapInArrow(_read, _READ)


def quarantine(read_rows: DataFrame) -> DataFrame:
    """The log of the gaps: path, start, bytes, reason."""
    return read_rows.where("what = 'gap'").select("path", "start", "bytes", "reason")


def resolved(read_rows: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest (of the full payload), record_type, refers_to. A revisit has size and digest
    from the response it names; where that was lost, the digest is the header's and the size null."""
    found = read_rows.where("what = 'record'").select(
        F.col("id").cast("bigint").alias("page_id"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast("bigint").alias("refers_to"),
        F.col("payload_digest").alias("named"),
        F.when(F.col("kind") != "revisit", F.octet_length("payload").cast("bigint")).alias("own_bytes"),
        F.when(F.col("kind") != "revisit", F.sha2("payload", 256)).alias("own_digest"),
    )
    found = stage_table(found, "warc-records")
    revisits = found.where("record_type = 'revisit'")
    wanted = revisits.select(F.col("refers_to").alias("r"), F.col("named").alias("d")).distinct()
    whole = found.where("record_type <> 'revisit'").select(F.col("page_id").alias("r"), F.col("own_digest").alias("d"), F.col("own_bytes").alias("b"))
    sizes = wanted.join(whole, ["r", "d"]).dropDuplicates(["r", "d"])
    joined = revisits.join(sizes, (revisits["refers_to"] == sizes["r"]) & (revisits["named"] == sizes["d"]), "left")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    again = joined.select("page_id", F.col("b").alias("payload_bytes"), F.col("named").alias("payload_digest"), "record_type", "refers_to")
    first = found.where("record_type <> 'revisit'").select("page_id", F.col("own_bytes").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"), "record_type", "refers_to")
    return first.select(*columns).unionByName(again.select(*columns))
