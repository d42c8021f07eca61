"""Token ids in binary files: documents in ascending id order, ids range coded in independent, checksummed blocks.

File: magic, block codes one after the other, footer, footer length and crc32, magic. The footer holds the documents (id, number of
ids), the order-0 table, and of each block of ``BLOCK`` ids the code's length and the crc32 of its ids as little-endian unsigned
32-bit integers. A block is decoded from its own code and the footer alone; if its checksum fails, only the documents that
touch it are reported as damaged, without ids.

Writing range-partitions the texts by id, so each task writes its own files of about ``FILE_IDS`` ids under names of their own and
returns manifest rows; only files of the manifest count. Equal ids are told apart by the hash of their text. The start of
a document is the running sum over the manifest's files plus its place in the file.

Nulls: a null text is empty (its end id only); a null id sorts first and is read back as null.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, new_folder, packed, row_slices, stage_table
from .idcoder import LANES, Order0, decode_blocks, encode_blocks

MAGIC = b"TMIDS01\n"
BLOCK = 1024
FILE_IDS = BLOCK * LANES
CACHE_PIECES = 1_200_000
SLICE = 8 << 20
_JOIN = 400
#: Latin letters whose lower case is one letter, and punctuation that begins neither a contraction nor a special token.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]"
_MARKS = r"[!-&(-/:;=>?@\[-`{}~]"
_PLAIN = f"^(?P<letters>{_LETTERS}+)(?P<marks>{_MARKS}*)$"
_RUN = re.compile(f"{_LETTERS}+|{_MARKS}+")
_SIGNS = "♥★♫✨☀♪❤"
#: Rules under which each such run of lower-case letters or of punctuation is one word, and nothing of it is rewritten.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = [
    {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _rules(step) -> dict:
    """A normalizer's or pre-tokenizer's settings."""
    return {} if step is None else json.loads(step.__getstate__())


class Encoder:
    """A tokenizer that drops white space, run on the distinct chunks between ASCII white space, which it never joins; of a plain
    word with punctuation after it, on its letters and on its marks."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = self.active = Tokenizer.from_file(path)
        # A sign that is one id of its own: where a chunk does not hold it, its id marks the gaps between chunks.
        coded = {sign: self._ids([sign])[0] for sign in _SIGNS}
        self.gap, self.gap_id = next(((sign, ids[0]) for sign, ids in coded.items() if len(ids) == 1), (None, None))
        # Ids that end a word, where the vocabulary marks them and the rules are the known ones: of a run, only spaces need be found.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.final = None
        if suffix and _rules(self.tokenizer.normalizer).get("normalizers") == _NORMAL and _rules(self.tokenizer.pre_tokenizer).get("pretokenizers") == _WORDS:
            words = self.tokenizer.get_vocab()
            self.final = np.zeros(max(words.values()) + 1, dtype=bool)
            self.final[[i for w, i in words.items() if w.endswith(suffix)]] = True
            self.runs = Tokenizer(self.tokenizer.model)  # shared, not copied
            self.runs.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[str, bytes] = {"": b""}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.active.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        runs = [p for p in new if self.final is not None and _RUN.fullmatch(p)]
        try:  # through the shorter rules
            self.active = self.runs if runs else self.tokenizer
            for part in (runs[i : i + _JOIN] for i in range(0, len(runs), _JOIN)):
                self._learn_runs(part)
        finally:
            self.active = self.tokenizer
        other = [p for p in new if p not in self.known]
        alone = [p for p in other if self.gap is None or self.gap in p]
        marked = [p for p in other if self.gap is not None and self.gap not in p]
        self.known.update(zip(alone, (np.array(x, dtype="<u4").tobytes() for x in self._ids(alone))))
        for part in (marked[i : i + _JOIN] for i in range(0, len(marked), _JOIN)):
            flat = np.array(self._ids([f" {self.gap} ".join(part)])[0], dtype="<u4")
            at = 4 * np.flatnonzero(flat == self.gap_id)
            data = flat.tobytes()
            self.known.update((p, data[a:b]) for p, a, b in zip(part, [0, *(at + 4).tolist()], [*at.tolist(), 4 * len(flat)]))

    def _learn_runs(self, part: list[str]) -> None:
        """A run of letters or of punctuation is one word to the tokenizer, whose last id says that it ends there."""
        flat = np.array(self._ids([" ".join(part)])[0], dtype="<u4")
        ends = (4 * (np.flatnonzero(self.final[flat]) + 1)).tolist()
        if len(ends) != len(part):
            self.known.update(zip(part, (np.array(x, dtype="<u4").tobytes() for x in self._ids(part))))
            return
        data = flat.tobytes()
        self.known.update((r, data[a:b]) for r, a, b in zip(part, [0, *ends[:-1]], ends))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.string()))  # with empty chunks at the ends of a text
        coded = cut.values.dictionary_encode()
        chunks = coded.dictionary
        if self.final is None:
            pieces = [chunks]
        else:
            plain = pc.extract_regex(chunks, _PLAIN)
            letters, marks = (pc.struct_field(plain, name) for name in ("letters", "marks"))
            pieces = [pc.coalesce(pc.utf8_lower(letters), chunks), pc.fill_null(marks, "")]
        named = pa.concat_arrays(pieces).dictionary_encode()
        ids = pa.array(self._held(named.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(named.indices)
        parts = [ids.slice(i * len(chunks), len(chunks)) for i in range(len(pieces))]
        flat = pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.large_binary())).take(coded.indices)
        _, ends, data = flat.buffers()
        bounds = np.frombuffer(ends, dtype=np.int64)[cut.offsets.to_numpy()] if len(flat) else np.zeros(len(texts) + 1, dtype=np.int64)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds), data or pa.py_buffer(b"")]).to_pylist()

    def _held(self, distinct: list[str]) -> list[bytes]:
        """Ids of distinct pieces; those not known yet are learned."""
        held = list(map(self.known.get, distinct))
        new = [p for p, x in zip(distinct, held) if x is None]
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known = {p: x for p, x in zip(distinct, held) if x is not None} | {"": b""}
        self._learn(new)
        return [self.known[p] if x is None else x for p, x in zip(distinct, held)]


def _encoder(path: str) -> Encoder:
    return kept("tokenfile", path, lambda: Encoder(path))


def pack(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """A file of the documents' ids."""
    sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    data = b"".join(ids)
    flat = np.frombuffer(data, dtype="<u4")
    table = Order0.of(flat)
    lookup = np.zeros(int(table.ids[-1]) + 1 if len(table.ids) else 1, dtype=np.uint16)
    lookup[table.ids] = np.arange(len(table.ids))
    n = -(-len(flat) // BLOCK)
    block_sizes = np.minimum(BLOCK, len(flat) - np.arange(n) * BLOCK)
    codes: list[bytes] = []
    for a in range(0, n, LANES):
        part = lookup[flat[a * BLOCK : (a + LANES) * BLOCK]]
        own = block_sizes[a : a + LANES]
        matrix = np.zeros((len(own), int(own[0])), dtype=np.uint16)
        matrix.reshape(-1)[: len(part)] = part
        codes += encode_blocks(matrix, own, table)
    crcs = [zlib.crc32(data[4 * BLOCK * i : 4 * BLOCK * (i + 1)]) for i in range(n)]
    arrays = [
        np.array([x or 0 for x in doc_ids], dtype="<i8"), np.array([x is None for x in doc_ids], dtype="u1"), sizes.astype("<i8"),
        np.array([len(c) for c in codes], dtype="<u4"), np.array(crcs, dtype="<u4"), table.ids.astype("<u4"), table.shares.astype("<u4"),
    ]
    head = json.dumps({"docs": len(ids), "blocks": n, "ids": len(flat), "block": BLOCK, "distinct": len(table.ids)}).encode() + b"\n"
    footer = zlib.compress(head + b"".join(a.tobytes() for a in arrays))
    tail = np.array([len(footer), zlib.crc32(footer)], dtype="<u4").tobytes()
    return b"".join([MAGIC, *codes, footer, tail, MAGIC])


def unpack(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, numbers of ids, all ids, whether each block is sound) of a file; a damaged footer is an error."""
    if raw[: len(MAGIC)] != MAGIC or raw[-len(MAGIC) :] != MAGIC:
        raise ValueError("not a token file")
    length, crc = np.frombuffer(raw[-len(MAGIC) - 8 : -len(MAGIC)], dtype="<u4").tolist()
    footer = raw[-len(MAGIC) - 8 - length : -len(MAGIC) - 8]
    if zlib.crc32(footer) != crc:
        raise ValueError("the footer's checksum fails")
    head, _, rest = zlib.decompress(footer).partition(b"\n")
    h, at, got = json.loads(head), 0, []
    for kind, n in (("<i8", "docs"), ("u1", "docs"), ("<i8", "docs"), ("<u4", "blocks"), ("<u4", "blocks"), ("<u4", "distinct"), ("<u4", "distinct")):
        got.append(np.frombuffer(rest, dtype=kind, count=h[n], offset=at))
        at += got[-1].nbytes
    docs, none, sizes, lengths, crcs, ids, shares = got
    table, size = Order0(ids, shares), h["block"]
    ends = len(MAGIC) + np.cumsum(lengths.astype(np.int64))
    flat, sound = np.zeros(h["ids"], dtype="<u4"), np.ones(h["blocks"], dtype=bool)
    for a in range(0, h["blocks"], LANES):
        own = np.minimum(size, h["ids"] - np.arange(a, min(a + LANES, h["blocks"])) * size)
        codes = [raw[e - n : e] for e, n in zip(ends[a : a + LANES].tolist(), lengths[a : a + LANES].tolist())]
        out = ids.take(decode_blocks(codes, own, table), mode="clip").reshape(-1)
        flat[a * size : a * size + own.sum()] = out[: own.sum()]
    for i in range(h["blocks"]):
        sound[i] = zlib.crc32(flat[i * size : (i + 1) * size].tobytes()) == crcs[i]
    return [None if x else int(d) for d, x in zip(docs, none)], sizes, flat, sound


_MANIFEST = "part int, nth int, path string, docs bigint, ids bigint, bytes bigint"


def _written(folder: str, tokenizer: str, end_id: int | None, file_ids: int):
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, nth, docs, ids, held = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            raw = pack(docs, ids)
            name = f"{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{root}/{name}", compression=None) as sink:
                sink.write(raw)
            columns = [[part], [nth], [f"{folder}/{name}"], [len(docs)], [held], [len(raw)]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in _MANIFEST.split(", ")])

        for batch, texts in row_slices(batches, limit=SLICE, operator="tokenfile"):
            rows = batch.column("row")
            numbers = rows.field(rows.type.get_field_index("id")).to_pylist()
            for number, x in zip(numbers, _encoder(tokenizer).encode(texts)):
                x += end
                if docs and held + len(x) // 4 > file_ids:
                    yield flush()
                    nth, docs, ids, held = nth + 1, [], [], 0
                docs.append(number)
                ids.append(x)
                held += len(x) // 4
            pa.default_memory_pool().release_unused()  # else kept by Arrow while numpy codes the file
        if docs:
            yield flush()

    return run


def write(docs: DataFrame, tokenizer: str, end_id: int | None = 1, folder: str | None = None, id_column: str = "doc_id", text_column: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Encode and write all rows; returns the manifest with one row per file: path, docs, ids, bytes, start, and its order."""
    folder = folder or new_folder(docs.sparkSession, "token-files")
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = stage_table(packed(dealt).mapInArrow(_written(folder, tokenizer, end_id, file_ids), _MANIFEST), "token-manifest")
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _read(batches):
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            store, name = pafs.FileSystem.from_uri(path)
            with store.open_input_stream(name, compression=None) as stream:
                docs, sizes, flat, sound = unpack(stream.read())
            begins = np.cumsum(sizes) - sizes
            good = np.concatenate([[0], np.cumsum(~sound)])
            size = BLOCK
            broken = good[np.minimum(-(-(begins + sizes) // size), len(sound))] > good[np.minimum(begins // size, len(sound))]
            data = flat.tobytes()
            for i in range(0, len(docs), 1000):
                part = slice(i, i + 1000)
                ids = [None if x else data[4 * a : 4 * (a + n)] for a, n, x in zip(begins[part].tolist(), sizes[part].tolist(), broken[part].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[part], pa.int64()), pa.array(start + begins[part]), pa.array(sizes[part]), pa.array(ids, pa.binary()), pa.array(broken[part])],
                    ["id", "start", "n_tokens", "ids", "damaged"],
                )


def read(manifest: DataFrame) -> DataFrame:
    """Per document: id, start, n_tokens, ids (bytes: little-endian unsigned 32-bit; null where damaged), damaged."""
    files = manifest.select("path", "start")
    n = files.count()
    return files.repartition(max(1, n)).mapInArrow(_read, "id bigint, start bigint, n_tokens bigint, ids binary, damaged boolean")
