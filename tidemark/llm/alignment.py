"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often over all documents.

The texts of a slice become lists of token ids; flattened, with parent indices and segmented running sums of token lengths, they are two
Arrow tables keyed by (document, end of the token). An Acero full outer hash join of these keys, sorted, has one row for every pair of
overlapping tokens: a row that only one side ends is filled with the other side's next token. Where both end, a group ends.
Arrow's ``group_by`` counts the distinct links per document and the documents per link of a task; Spark adds these partial counts up over
the corpus, takes the best count of each left id, and brings both back to the documents.

What travels is small: a document's distinct links are codes of its part (a task, or as much of it as has ``PART_LINKS`` different
links), and a part meets the counts of its own links only, each once, whatever the number of its documents. A link that every part
has is one row per part, and rows of a link are added up before and after the shuffle.

Nulls: a null or empty text, and one whose tokens do not spell a space and the text (U+2581 in it, for the right side), has no tokens:
all numbers are 0 and the digest is that of nothing written, an empty string. Repeated documents count each on their own. Ids are
carried as they are, null ids too; other columns are not looked at. Texts are taken whole.

Both tokenizers are libraries; they see runs of text between spaces, each distinct run once as long as it is remembered. A run starts at a space
after anything but white space, where no token of either can cross; this is checked for the given files, and others see whole texts.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, stage_table

#: Runs of text remembered by a worker, and different links of a part.
KNOWN_RUNS = 600_000
PART_LINKS = 1 << 21
#: New runs that are encoded as one text.
JOINED_RUNS = 256
#: Bits of a key or code below the number of its document or part.
_END_BITS = 36
_CODE_BITS = 24
_WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 ᠎           ​    　﻿"
_PAIRS = tuple(w + " " for w in _WHITE)
_MARK = "▁"


def byte_level_bytes() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _runs(text: str) -> list[str]:
    """The runs of a text, each without the space in front of it (the first one's is the added space)."""
    parts: list[str] = text.split(" ")
    if text[0] != " " and not [w for w in _PAIRS if w in text]:
        return parts
    held: list[str] = []
    out: list[str] = []
    for i, part in enumerate(parts):
        if held and not (held[-1] and held[-1][-1] not in _WHITE):
            held.append(part)
        else:
            if held:
                out.append(" ".join(held))
            held = [part]
    out.append(" ".join(held))
    return out


def _spelling(tokens: pa.LargeBinaryArray, ids) -> bytes:
    data = tokens.take(pa.array(ids, pa.int32())).buffers()[2]
    return data.to_pybytes() if data is not None else b""


class _Dictionary:
    """Runs by number, with the ids of both tokenizers as Arrow lists."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        n_a, n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        letters = byte_level_bytes()
        a_bytes = [b""] * n_a
        for token, i in self.a.get_vocab().items():
            a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(n_b)))]
        self.spelled = tuple(pa.array(side, pa.large_binary()) for side in (a_bytes, b_bytes))
        self.size = tuple(pa.array([len(x) for x in side], pa.int64()) for side in (a_bytes, b_bytes))
        self.n_b = n_b
        names = [t for ids, ends in ((n_a, ",|"), (n_b, ",;")) for i in range(ids) for t in (f"{i}{ends[0]}".encode(), f"{i}{ends[1]}".encode())]
        self.names = pa.array(names, pa.large_binary())
        self.b_offset = 2 * n_a
        step = spec.get("pre_tokenizer") or {}
        plain = spec.get("normalizer") is None and step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space")
        whole = all(_MARK not in self.b.id_to_piece(i).lstrip(_MARK) for i in range(n_b))
        kept = self.b.encode("a b", out_type=str) and "".join(self.b.encode(" a  b\n c ", out_type=str)) == f"{_MARK}{_MARK}a{_MARK}{_MARK}b<0x0A>{_MARK}c{_MARK}"
        self.cuts = bool(plain and whole and kept)
        self.mark = self.b.piece_to_id(_MARK)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.sound = np.zeros(0, bool)

    def _encoded(self, side: int, runs: list[str]) -> list[list[int]]:
        if side == 0:
            return [e.ids for e in self.a.encode_batch_fast([" " + r for r in runs], add_special_tokens=False)]
        return [ids if run else [self.mark] for run, ids in zip(runs, self.b.encode(runs, num_threads=1))]

    def learn(self, runs: list[str]) -> None:
        """Encode new runs; those that do not end in white space stand side by side in longer texts, which are cut by token lengths."""
        runs = sorted(runs, key=lambda r: bool(r) and r[-1] not in _WHITE)
        alone = next((i for i, r in enumerate(runs) if r and r[-1] not in _WHITE), len(runs)) if self.cuts else len(runs)
        sizes = np.array([1 + (len(r) if r.isascii() else len(r.encode())) for r in runs], dtype=np.int64)
        sound = np.ones(len(runs), bool)
        for side in (0, 1):
            spelled, size = self.spelled[side], self.size[side].to_numpy()
            found = self._encoded(side, runs[:alone])
            ids, counts = [np.array(x, np.int32) for x in found], [len(x) for x in found]
            sound[:alone] &= np.array([_spelling(spelled, x) == (" " + r).encode() for x, r in zip(found, runs)], bool)
            for i in range(alone, len(runs), JOINED_RUNS):
                part = runs[i : i + JOINED_RUNS]
                joined = self._encoded(side, [" ".join(part)])[0]
                joined = np.array(joined, np.int32)
                ends = np.cumsum(size[joined])
                if ends[-1] == sizes[i : i + len(part)].sum() and _spelling(spelled, joined) == (" " + " ".join(part)).encode():
                    ids.append(joined)
                    counts += np.diff(np.searchsorted(ends, np.cumsum(sizes[i : i + len(part)])) + 1, prepend=0).tolist()
                    continue
                for j, (run, one) in enumerate(zip(part, self._encoded(side, part)), i):
                    sound[j] &= _spelling(spelled, one) == (" " + run).encode()
                    ids.append(np.array(one, np.int32))
                    counts.append(len(one))
            self.ids[side] = np.concatenate([self.ids[side], *ids])
            self.ends[side] = np.concatenate([self.ends[side], self.ends[side][-1] + np.cumsum(counts)])
        self.sound = np.concatenate([self.sound, sound])
        self.known.update(zip(runs, range(len(self.known), len(self.known) + len(runs))))

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The runs of every text as numbers; an empty text has none."""
        cut = [(_runs(t) if self.cuts else [t]) if t else [] for t in texts]
        found = [list(map(self.known.get, runs)) for runs in cut]
        lacking = [i for i, x in enumerate(found) if None in x]
        if lacking:
            new = list({r for i in lacking for r, x in zip(cut[i], found[i]) if x is None})
            if self.known and len(self.known) + len(new) > KNOWN_RUNS:
                self.clear()
                lacking, new = range(len(cut)), list({r for runs in cut for r in runs})
            self.learn(new)
            for i in lacking:
                found[i] = list(map(self.known.__getitem__, cut[i]))
        return found

    def lists(self, side: int) -> pa.LargeListArray:
        return pa.LargeListArray.from_arrays(pa.array(self.ends[side]), pa.array(self.ids[side]))


_DICTIONARIES: dict[tuple[str, str], _Dictionary] = {}


def _dictionary(a_path: str, b_path: str) -> _Dictionary:
    if (a_path, b_path) not in _DICTIONARIES:
        _DICTIONARIES[a_path, b_path] = _Dictionary(a_path, b_path)
    return _DICTIONARIES[a_path, b_path]


def _tokens(words: _Dictionary, side: int, runs: pa.Array, doc_of_run: pa.Array, name: str) -> pa.Table:
    """The tokens of a slice in order: (key, name), the key being the document and where the token ends in it."""
    lists = words.lists(side).take(runs)
    ids, doc = lists.flatten(), doc_of_run.take(pc.list_parent_indices(lists))
    total = pc.cumulative_sum(words.size[side].take(ids))
    docs = doc.to_numpy()
    last = np.flatnonzero(np.diff(docs, append=-1))  # the last token of each document; the sum before a document is its base
    base = np.zeros(int(docs[-1]) + 1 if len(docs) else 0, dtype=np.int64)
    base[docs[last[1:]]] = total.to_numpy()[last[:-1]]
    end = pc.subtract(total, pa.array(base).take(doc))
    return pa.table({"key": pc.bit_wise_or(pc.shift_left(doc, _END_BITS), end), name: ids})


def align_slice(words: _Dictionary, texts: list[str]):
    """Per document: tokens of both sides, groups, links and digest; and the table of links (doc, pair), one row per overlap."""
    numbers = words.numbers(texts)
    n = len(texts)
    sizes = np.array([len(x) for x in numbers], dtype=np.int64)
    runs = np.array([r for x in numbers for r in x], dtype=np.int64)
    doc = np.repeat(np.arange(n), sizes)
    spoiled = np.zeros(n, bool)
    spoiled[doc[~words.sound[runs]]] = True
    fine = ~spoiled[doc]
    runs, doc = pa.array(runs[fine]), pa.array(doc[fine])
    sides = [_tokens(words, side, runs, doc, name) for side, name in enumerate(("a", "b"))]
    joined = sides[0].join(sides[1], "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    if not len(joined):
        zero = np.zeros(n, np.int64)
        return (zero, zero, zero, zero, [""] * n), pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64())})
    left, right = joined.column("a"), joined.column("b")
    of = pc.shift_right(joined.column("key"), _END_BITS)
    pair = pc.add(pc.multiply(pc.fill_null_backward(left).cast(pa.int64()), words.n_b), pc.fill_null_backward(right).cast(pa.int64()))
    links = pa.table({"doc": of, "pair": pair})

    # The written groups: a token's place is its own number and the other side's tokens of earlier groups, or of this one too.
    docs = of.to_numpy()
    ends_a, ends_b = (pc.is_valid(x).to_numpy() for x in (left, right))
    both = ends_a & ends_b
    group = np.cumsum(both) - both
    at = np.searchsorted(docs, np.arange(n + 1))
    per_doc = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at])
    n_a, n_b, n_groups, n_links = per_doc(ends_a), per_doc(ends_b), per_doc(both), np.diff(at)
    groups = int(both.sum())
    in_a, in_b = np.bincount(group[ends_a], minlength=groups), np.bincount(group[ends_b], minlength=groups)
    ids_a, ids_b = sides[0].column("a").to_numpy(), sides[1].column("b").to_numpy()
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[np.cumsum(in_a) - 1] = 1
    last_b[np.cumsum(in_b) - 1] = 1
    name = np.empty(len(ids_a) + len(ids_b), np.int64)
    name[np.arange(len(ids_a)) + (np.cumsum(in_b) - in_b)[group[ends_a]]] = 2 * ids_a.astype(np.int64) + last_a
    name[np.arange(len(ids_b)) + np.cumsum(in_a)[group[ends_b]]] = words.b_offset + 2 * ids_b.astype(np.int64) + last_b
    written = words.names.take(pa.array(name))
    offsets, data = np.frombuffer(written.buffers()[1], np.int64), memoryview(written.buffers()[2])
    cut = offsets[np.concatenate([[0], np.cumsum(n_a + n_b)])]
    digests = [hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(cut[:-1], cut[1:])]
    return (n_a, n_b, n_groups, n_links, digests), links


class _Part:
    """The codes of a part's links: 0, 1, ... in order of appearance, and the documents that hold each."""

    def __init__(self):
        self.keys, self.codes, self.held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, pairs: np.ndarray, n_docs: np.ndarray) -> np.ndarray:
        """Codes of the sorted, distinct ``pairs``."""
        place = np.searchsorted(self.keys, pairs)
        new = np.ones(len(pairs), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != pairs[inside]
        codes = np.empty(len(pairs), np.int64)
        codes[~new] = self.codes[place[~new]]
        codes[new] = len(self.keys) + np.arange(new.sum())
        self.held = np.concatenate([self.held, np.zeros(int(new.sum()), np.int64)])
        self.held[codes] += n_docs
        self.keys, self.codes = np.insert(self.keys, place[new], pairs[new]), np.insert(self.codes, place[new], codes[new])
        return codes

    def pairs(self) -> np.ndarray:
        return self.keys[np.argsort(self.codes)]


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four planes of bytes, compressed."""
    return pa.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _numbers(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return planes.reshape(4, n).T.copy().view("<u4").ravel().astype(np.int64)


_SLICE = "n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, digests array<string>, distinct array<bigint>, codes binary, times binary"
_PART = "pairs array<bigint>, held array<bigint>"


def _list(values, kind) -> pa.Array:
    flat = pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _aligned(docs: DataFrame, a_path: str, b_path: str, slice_bytes: int, part_links: int) -> DataFrame:
    """One row per slice of documents, and one per part with its links."""
    id_kind = docs.schema["id"].dataType
    schema = T._parse_datatype_string(f"part bigint, {_SLICE}, {_PART}").add("ids", T.ArrayType(id_kind))
    columns = schema.names

    def run(batches):
        words = _dictionary(a_path, b_path)
        task = TaskContext.get().partitionId()
        part, number = _Part(), 0

        def row(**values) -> pa.RecordBatch:
            kinds = out_kinds
            return pa.RecordBatch.from_arrays([values[c] if c in values else pa.nulls(1, kinds[c]) for c in columns], columns)

        out_kinds = None
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id"))
            if out_kinds is None:
                longs = pa.list_(pa.int64())
                out_kinds = {c: longs for c in columns} | {"part": pa.int64(), "digests": pa.list_(pa.string()), "codes": pa.binary(), "times": pa.binary()}
                out_kinds["ids"] = pa.list_(ids.type)
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            a = held = 0
            for b, text in enumerate(texts, 1):
                held += len(text or "")
                if held < slice_bytes and b - a < 4096 and b < len(texts):
                    continue
                facts, links = align_slice(words, [t or "" for t in texts[a:b]])
                per_doc = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
                per_pair = per_doc.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
                pairs = per_pair.column("pair").to_numpy()
                codes = part.encode(pairs, per_pair.column("count_all").to_numpy())
                doc = per_doc.column("doc").to_numpy()
                order = np.argsort(doc, kind="stable")
                of = codes[np.searchsorted(pairs, per_doc.column("pair").to_numpy()[order])] if len(pairs) else np.zeros(0, np.int64)
                yield row(
                    part=pa.array([(task << 16) + number], pa.int64()),
                    **{c: _list(x, pa.int64()) for c, x in zip(("n_a", "n_b", "n_groups", "n_links"), facts)},
                    digests=_list(facts[4], pa.string()),
                    distinct=_list(np.bincount(doc, minlength=b - a), pa.int64()),
                    codes=pa.array([_planes(of)], pa.binary()),
                    times=pa.array([_planes(per_doc.column("count_all").to_numpy()[order])], pa.binary()),
                    ids=pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.slice(a, b - a)),
                )
                a, held = b, 0
                if len(part.keys) >= part_links:
                    yield row(part=pa.array([(task << 16) + number], pa.int64()), pairs=_list(part.pairs(), pa.int64()), held=_list(part.held, pa.int64()))
                    part, number = _Part(), number + 1
        if len(part.keys):
            yield row(part=pa.array([(task << 16) + number], pa.int64()), pairs=_list(part.pairs(), pa.int64()), held=_list(part.held, pa.int64()))

    return docs.mapInArrow(run, schema)


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    slice_bytes: int = SLICE_BYTES,
    part_links: int = PART_LINKS,
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every document."""
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    stage = stage_table(_aligned(slim, a_path, b_path, slice_bytes, part_links), "alignment", "zstd")
    n_b = _piece_count(b_path)
    links = stage.where(F.col("pairs").isNotNull()).select("part", F.posexplode(F.arrays_zip("pairs", "held")).alias("code", "link"))
    links = links.select((F.shiftleft("part", _CODE_BITS) + F.col("code")).alias("place"), F.col("link.pairs").alias("pair"), F.col("link.held").cast("int").alias("held"))
    counts = stage_table(links.groupBy("pair").agg(F.sum("held").alias("n")), "alignment-counts", "zstd")
    left = F.expr(f"pair div {n_b}")
    top = counts.groupBy(left.alias("a")).agg(F.max("n").alias("top"))  # at most one row per id of the left vocabulary
    marked = counts.withColumn("a", left).join(F.broadcast(top), "a").select("pair", (F.col("n") * 2 + (F.col("n") == F.col("top")).cast("int")).alias("found"))
    found = links.select("place", "pair").join(marked, "pair").select(F.shiftright("place", _CODE_BITS).alias("part"), F.col("place").bitwiseAND((1 << _CODE_BITS) - 1).cast("int").alias("code"), "found")
    slices = stage.where(F.col("ids").isNotNull()).drop("pairs", "held")
    schema = T._parse_datatype_string("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), *schema.fields])

    def scored(own: pa.Table, lookup: pa.Table) -> pa.Table:
        value = np.zeros(len(lookup), np.int64)
        value[lookup.column("code").to_numpy()] = lookup.column("found").to_numpy()
        tables = []
        for i in range(len(own)):
            row = own.slice(i, 1)
            flat = lambda c: row.column(c).combine_chunks().flatten()  # noqa: E731, B023
            distinct = flat("distinct").to_numpy()
            total = int(distinct.sum())
            codes, times = (_numbers(row.column(c)[0].as_py(), total) for c in ("codes", "times"))
            ends = np.concatenate([[0], np.cumsum(distinct)])
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])  # noqa: E731, B023
            best, n = sums(times * (value[codes] & 1)), sums(times * (value[codes] >> 1))
            arrays = [flat("ids"), *[flat(c) for c in ("n_a", "n_b", "n_groups", "n_links")], pa.array(best), pa.array(n), flat("digests")]
            tables.append(pa.table(arrays, names=schema.names))
        return pa.concat_tables(tables) if tables else pa.table({f.name: pa.array([], k) for f, k in zip(schema.fields, empty)})

    empty = [pa.int64()] * 7 + [pa.string()]
    return slices.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(scored, schema)


def _piece_count(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
