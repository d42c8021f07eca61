"""Byte-level BPE in DuckDB, one connection per Python worker: recursive queries encode, an ordered aggregation decodes.

A text is cut by ``pattern``; every match is a word of its own. The distinct words of a slice become rows (word and
position, token), starting from single bytes. Each turn of the recursive query joins neighbours with the merge table, takes each
word's leftmost pair of minimum rank and contracts it, until no word has a pair left (the fixpoint). Ids of words are kept in a
cache of at most ``CACHE_WORDS`` entries per worker. Decoding joins (text, position, id) rows with the vocabulary and
concatenates them per text in the order of the positions.

Words longer than ``LONG_BYTES`` are cut first: every token that a merge makes is a vocabulary entry that stands in the word, so
no merge crosses a place that lies inside no entry standing there (an automaton of all entries finds them in one pass), and the
pieces between such places contract on their own. A piece that is still long would need a turn per merge over all its rows; for
it a turn contracts every occurrence of the minimum pair, from the left and without overlaps, where no merge with its result
has a smaller rank, which is the same sequence of single contractions. Elsewhere what follows such a contraction stays within
one entry around it, so occurrences more than three times the longest entry apart don't meet: it contracts the leftmost one of
every cluster of nearer ones. DuckDB works in memory alone: it has no folder to spill to.

Nulls: a null text is empty: no ids, empty bytes. Repeated rows are encoded like any other.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import kept, packed, row_slices

CACHE_WORDS = 300_000
TURN_WORDS = 20_000
LONG_BYTES = 64
#: What DuckDB may hold, and what it may hold while it contracts long pieces of more than ``LARGE_BYTES`` together.
MEMORY, LARGE_MEMORY, LARGE_BYTES = "300MB", "1GB", 200_000
_IDS = pa.list_(pa.int32())

_SHORT = """
WITH RECURSIVE step(g, tok, live) AS (
  SELECT g, tok, true FROM tokens
  UNION ALL
  (WITH best AS (
     SELECT a.g >> 32 AS word, min((m.rank << 32) | (a.g & 4294967295)) AS b
     FROM step a JOIN step n ON n.g = a.g + 1 JOIN merges m ON m.pair = (a.tok << 32) | n.tok
     WHERE a.live GROUP BY 1)
   SELECT s.g - CASE WHEN (s.g & 4294967295) > (b.b & 4294967295) THEN 1 ELSE 0 END,
          CASE WHEN (s.g & 4294967295) = (b.b & 4294967295) THEN b.b >> 32 ELSE s.tok END,
          b.b IS NOT NULL
   FROM step s LEFT JOIN best b ON s.g >> 32 = b.word
   WHERE s.live AND (b.b IS NULL OR (s.g & 4294967295) <> (b.b & 4294967295) + 1))
)
SELECT g >> 32 AS word, tok FROM step WHERE NOT live ORDER BY g
"""

_LONG = """
WITH RECURSIVE step(g, tok, spot, live) AS (
  SELECT g, tok, g & 4294967295, true FROM tokens
  UNION ALL
  (WITH pairs AS (
     SELECT a.g, a.g >> 32 AS word, a.spot, m.rank, m.safe
     FROM step a JOIN step n ON n.g = a.g + 1 JOIN merges m ON m.pair = (a.tok << 32) | n.tok WHERE a.live),
   least_ AS (SELECT word, min(rank) AS rank FROM pairs GROUP BY word),
   found AS (
     SELECT p.g, p.word, p.rank, p.safe, p.g - row_number() OVER w AS island, p.spot - lag(p.spot) OVER w AS gap
     FROM pairs p JOIN least_ USING (word, rank) WINDOW w AS (PARTITION BY p.word ORDER BY p.g)),
   ranked AS (SELECT g, word, rank, safe, gap, row_number() OVER (PARTITION BY word, island ORDER BY g) AS nth FROM found),
   picked AS (SELECT g, word, rank FROM ranked WHERE CASE WHEN safe THEN nth % 2 = 1 ELSE gap IS NULL OR gap > $reach END),
   merged AS (
     SELECT s.g, CASE WHEN p.g IS NULL THEN s.tok ELSE p.rank END AS tok, s.spot, l.word IS NOT NULL AS live
     FROM step s LEFT JOIN picked p ON p.g = s.g LEFT JOIN picked q ON q.g = s.g - 1 LEFT JOIN least_ l ON l.word = s.g >> 32
     WHERE s.live AND q.g IS NULL)
   SELECT ((g >> 32) << 32) + row_number() OVER (PARTITION BY g >> 32 ORDER BY g) - 1, tok, spot, live FROM merged)
)
SELECT g >> 32 AS word, tok FROM step WHERE NOT live ORDER BY g
"""

_DECODE = "SELECT d, unhex(string_agg(v.hex, '' ORDER BY t.p)) AS b FROM ids t JOIN vocabulary v ON v.id = t.id GROUP BY d ORDER BY d"


class Codec:
    """Merge table, vocabulary and the word cache of one worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        l, r, m = (np.array(x, dtype=np.int64) for x in (left, right, rank))
        lower = np.unique(np.concatenate([l[m < l], r[m < r]]))  # tokens that take part in a merge of a smaller rank
        self.words = regex.compile(pattern).findall
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if (self.byte_ids < 0).any():
            raise ValueError(f"{path} lacks single bytes")
        self.cache: dict[str, bytes] = {}
        self.entries = [token for token in ranks if len(token) > 1]
        self.finder = None
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self._table("merges", pair=(l << 32) | r, rank=m, safe=~np.isin(m, lower))
        ids = sorted(ranks.items(), key=lambda x: x[1])
        self._table("vocabulary", id=[r for _, r in ids], hex=[t.hex() for t, _ in ids])

    def _table(self, name: str, **columns) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _query(self, sql: str, name: str, **columns) -> pa.Table:
        self.con.register(name, pa.table(columns))
        try:
            return self.con.sql(sql).to_arrow_table()
        finally:
            self.con.unregister(name)

    def _contract(self, words: list[bytes], sql: str) -> list[bytes]:
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        tokens = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        out = self._query(sql, "tokens", g=(word << 32) | place, tok=tokens)
        of, ids = out["word"].to_numpy(), out["tok"].to_numpy().astype("<i4")
        ends = np.searchsorted(of, np.arange(len(words)), side="right") * 4
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def pieces(self, word: bytes) -> list[bytes]:
        """A word cut at the places that lie inside no vocabulary entry standing there."""
        if self.finder is None:
            import ahocorasick

            self.finder = ahocorasick.Automaton()
            for token in self.entries:
                self.finder.add_word(token.decode("latin-1"), len(token))
            self.finder.make_automaton()
        longest = 0
        covered = np.zeros(len(word) + 1, dtype=np.int64)  # +1 where the inside of an entry begins, -1 where it has ended
        for last, size in self.finder.iter(word.decode("latin-1")):
            covered[last - size + 2] += 1
            covered[last + 1] -= 1
            longest = max(longest, size)
        self.reach = max(self.reach, 3 * longest)
        cuts = np.flatnonzero(np.cumsum(covered)[1:-1] == 0) + 1
        return [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)])]

    def _contracted(self, words: list[bytes]) -> dict[bytes, bytes]:
        found: dict[bytes, bytes] = {}
        long = _LONG.replace("$reach", str(self.reach))
        for part, sql in (([w for w in words if len(w) <= LONG_BYTES], _SHORT), ([w for w in words if len(w) > LONG_BYTES], long)):
            for i in range(0, len(part), TURN_WORDS):
                turn = part[i : i + TURN_WORDS]
                large = sql is long and sum(map(len, turn)) > LARGE_BYTES
                if large:
                    self.con.execute(f"SET memory_limit = '{LARGE_MEMORY}'")
                found.update(zip(turn, self._contract(turn, sql)))
                if large:
                    self.con.execute(f"SET memory_limit = '{MEMORY}'")
        return found

    def _learn(self, words: set[str]) -> None:
        if len(self.cache) + len(words) > CACHE_WORDS:
            self.cache.clear()
        new = {w: w.encode() for w in words if w not in self.cache}
        self.reach = 0  # three times the longest entry that stands in a long word
        cut = {w: [b] if len(b) <= LONG_BYTES else self.pieces(b) for w, b in new.items()}
        known = self._contracted(list({p for ps in cut.values() for p in ps}))
        self.cache.update((w, b"".join([known[p] for p in ps])) for w, ps in cut.items())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.words(t) for t in texts]
        self._learn(set().union(*cut))
        known = self.cache
        return [np.frombuffer(b"".join([known[w] for w in ws]), dtype="<i4") for ws in cut]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        out = [b""] * len(ids)
        if sizes.sum():
            flat = np.concatenate(ids)
            got = self._query(_DECODE, "ids", d=np.repeat(np.arange(len(ids)), sizes), p=np.arange(len(flat)), id=flat.astype(np.int64))
            for d, b in zip(got["d"].to_pylist(), got["b"].to_pylist()):
                out[d] = b
        return out


def _codec(path: str, pattern: str) -> Codec:
    return kept("bpe", (path, pattern), lambda: Codec(path, pattern))


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, "<i4"), *ids]), pa.int32()))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x if x is not None else [], dtype=np.int64) for x in column.to_pylist()]


def _mapped(docs: DataFrame, text_column: str, extra: str, make: Callable) -> DataFrame:
    wide = packed(docs)

    def run(batches):
        for batch, texts in row_slices(batches, text_column, operator="bpe"):
            yield pa.RecordBatch.from_arrays([batch.column("row"), *make([t.decode() for t in texts])], ["row", *(c.split()[0] for c in extra.split(", "))])

    return wide.mapInArrow(run, f"row {wide.schema['row'].dataType.simpleString()}, {extra}")


def encode(docs: DataFrame, path: str, pattern: str, text_column: str = "text") -> DataFrame:
    """``row`` (all columns of the document) and its ``ids``."""
    return _mapped(docs, text_column, "ids array<int>", lambda texts: [_lists(_codec(path, pattern).encode(texts))])


def decode(encoded: DataFrame, path: str, pattern: str, ids_column: str = "ids") -> DataFrame:
    """``row`` (all columns of ``encoded``) and the bytes ``decoded`` from its ids; null ids are empty."""
    wide = packed(encoded)

    def run(batches):
        for batch in batches:
            rows = batch.column("row")
            for i in range(0, batch.num_rows, 500):
                part = rows.slice(i, 500)
                ids = _arrays(part.field(part.type.get_field_index(ids_column)))
                yield pa.RecordBatch.from_arrays([part, pa.array(_codec(path, pattern).decode(ids), pa.binary())], ["row", "decoded"])

    return wide.mapInArrow(run, f"row {wide.schema['row'].dataType.simpleString()}, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, text_column: str = "text") -> DataFrame:
    """``row``, ``ids`` and the bytes ``decoded`` from these ids, in one pass with one connection per worker."""

    def both(texts):
        codec = _codec(path, pattern)
        ids = codec.encode(texts)
        return [_lists(ids), pa.array(codec.decode(ids), pa.binary())]

    return _mapped(docs, text_column, "ids array<int>, decoded binary", both)
