"""A hidden Markov language model over word symbols, trained by Baum-Welch, scored by the scaled forward recursion.

Tokens are the words of a text (A-Z lower-cased, cut at white space) and one end. Words with at least one in ``SYMBOLS``
of all training tokens, which can be ``SYMBOLS`` words at most, and the end are symbols of their own; every other word,
known or not, belongs to one of ``BUCKETS`` symbols by its hash and has a smoothed chance within it, from counts over all
training texts: (c + 0.1) / (C + 0.1 (V + 1)), one of the V + 1 places being that of unknown words. The chance of a text is the
chance of its symbol sequence under the model, summed over all state paths, times the chances of its words within their symbols.

* Word counts: one pass, (hash of the word, count) rows added up by shuffle. Words are told apart by 64-bit hashes.
* Preparation: one pass turns texts into symbol sequences. Texts are grouped into slices of at most about ``GROUP_BYTES``;
  the counts of a slice's words come from one join of its distinct words with the count table, so a word costs one row per slice.
* Training: ``ROUNDS`` rounds; the tasks run forward-backward over their texts (in stretches of ``STRETCH`` tokens, which are as
  sequences to the model) and emit expected counts, which are added up across partitions. The model has a fixed size.
* Scoring: every text as one whole sequence.

Nulls: a null text is empty and has only its end; a null id counts as the empty text for the fold. Repeated rows count each time.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED_TABLE, mix, packed, row_slices, stage_table, word_hashes
from .langid import fold

STATES = 8
SYMBOLS = 8192
BUCKETS = 1024
ROUNDS = 4
STRETCH = 256
GROUP_BYTES = 24 << 20
CHUNK_TOKENS = 1 << 18
_FLUSH = 1 << 20
END = np.int64(0)  # the hash that stands for the end of a text


def _hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    h, owner = word_hashes(texts, SPACED_TABLE)
    h = h.view(np.int64)
    return np.where(h == END, np.int64(1), h), owner


def _bucket(h: np.ndarray) -> np.ndarray:
    """Bits of the hash that no other use looks at alone; the same in SQL is ``_BUCKET``."""
    return (h.view(np.uint64) >> np.uint64(40)).astype(np.int64) % BUCKETS


_BUCKET = f"CAST(shiftrightunsigned(h, 40) % {BUCKETS} AS SMALLINT)"


def _counted(batches):
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def flush():
        h = np.concatenate([x for x, _ in kept])
        n = np.concatenate([x for _, x in kept])
        distinct, at = np.unique(h, return_inverse=True)
        total = np.bincount(at, weights=n).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(total)], ["h", "n"])

    for _, texts in row_slices(batches):
        h, n = np.unique(_hashes(texts)[0], return_counts=True)
        kept += [(h, n), (np.array([END]), np.array([len(texts)]))]
        held += len(h) + 1
        if held > _FLUSH:
            yield flush()
            kept, held = [], 0
    if kept:
        yield flush()


def word_counts(train: DataFrame) -> DataFrame:
    """(h, c): the count of every distinct training token."""
    rows = packed(train.select("text")).mapInArrow(_counted, "h bigint, n bigint")
    return stage_table(rows.groupBy("h").agg(F.sum("n").alias("c")), "word-counts")


class Symbols:
    """What tasks need to know of the counts; its size is bounded by SYMBOLS and BUCKETS."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        self.tokens, self.distinct = int(total[0]), int(total[1])
        own = (F.col("c") * SYMBOLS >= self.tokens) | (F.col("h") == int(END))
        words = counts.where(own).select("h", "c").collect()  # at most SYMBOLS + 1 rows
        words = sorted((r["h"], r["c"]) for r in words) or [(int(END), 0)]
        if int(END) not in (h for h, _ in words):
            words = sorted([*words, (int(END), 0)])
        self.words = np.array([h for h, _ in words], dtype=np.int64)
        self.counts = np.array([c for _, c in words], dtype=np.int64)
        self.bucket_tokens = np.zeros(BUCKETS)
        self.bucket_words = np.zeros(BUCKETS)
        for r in counts.where(~own).groupBy(F.expr(_BUCKET).alias("bucket")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
            self.bucket_tokens[r["bucket"]], self.bucket_words[r["bucket"]] = r["c"], r["v"]
        self.size = len(self.words) + BUCKETS
        self.end = int(np.searchsorted(self.words, END))

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of word hashes, and whether they are words of their own."""
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        own = self.words[at] == h
        return np.where(own, at, len(self.words) + _bucket(h)), own

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


def _prepared(symbols):
    def run(batches):
        s: Symbols = symbols.value
        group: list[tuple] = []
        held = 0

        def flush():
            rows, syms, rare = [], [], []
            every = np.concatenate([g[3] for g in group])
            distinct, at = np.unique(every, return_inverse=True)
            at = at.astype("<i4")
            done = 0
            for row, sym, owner, h, rare_owner, n in group:
                a, b = np.searchsorted(owner, [np.arange(n), np.arange(n) + 1])
                c, d = np.searchsorted(rare_owner, [np.arange(n), np.arange(n) + 1])
                for i in range(n):
                    syms.append(sym[a[i] : b[i]].tobytes())
                    rare.append(at[done + c[i] : done + d[i]].tobytes())
                done += len(h)
                rows.append(row)
            whole = pa.concat_tables(rows)
            part = int.from_bytes(os.urandom(8), "little", signed=True)
            words = [distinct.tobytes()] + [None] * (len(syms) - 1)
            whole = whole.append_column("part", pa.array([part] * len(syms), pa.int64())).append_column("syms", pa.array(syms, pa.binary()))
            whole = whole.append_column("rare", pa.array(rare, pa.binary())).append_column("words", pa.array(words, pa.binary()))
            yield from whole.combine_chunks().to_batches()

        for batch, texts in row_slices(batches):
            h, owner = _hashes(texts)
            sym, own = s.of(h)
            # Only the id and the fold go on; the text stays behind.
            rows = batch.column("row")
            slim = pa.table({c: rows.field(rows.type.get_field_index(c)) for c in ("doc_id", "held_out")})
            owner = owner.astype(np.int32)
            group.append((slim, sym.astype("<u2"), owner, h[~own], owner[~own], len(texts)))
            held += sum(map(len, texts))
            if held >= GROUP_BYTES:
                yield from flush()
                group, held = [], 0
        if group:
            yield from flush()

    return run


def _stretches(syms: list[bytes], end: int):
    """Matrices (time, sequence) of stretches in falling order of length, with their lengths, of about CHUNK_TOKENS tokens."""
    cut = []
    for raw in syms:
        x = np.append(np.frombuffer(raw, dtype="<u2").astype(np.int64), end)
        cut += [x[i : i + STRETCH] for i in range(0, len(x), STRETCH)]
    cut.sort(key=len, reverse=True)
    a = 0
    while a < len(cut):
        width = len(cut[a])
        part = cut[a : a + max(1, CHUNK_TOKENS // width)]
        yield _matrix(part)
        a += len(part)


def _matrix(part: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in part])
    out = np.zeros((lengths[0], len(part)), dtype=np.int64)
    for j, x in enumerate(part):
        out[: len(x), j] = x
    return out, lengths


def _forward_backward(obs, lengths, model, size):
    """Expected counts of starts, moves and emissions over the sequences of ``obs``."""
    start, move, emit = model  # (K,), (K, K), (size, K)
    steps, n = obs.shape
    live = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(steps)]  # sequences longer than t
    alpha = np.zeros((steps, n, len(start)))
    scale = np.ones((steps, n))
    seen = emit[obs]
    for t in range(steps):
        m = live[t]
        a = (start if t == 0 else alpha[t - 1, :m] @ move) * seen[t, :m]
        scale[t, :m] = a.sum(axis=1)
        alpha[t, :m] = a / scale[t, :m, None]
    moves = np.zeros_like(move)
    gamma = np.zeros_like(alpha)
    beta = np.ones((n, len(start)))
    for t in range(steps - 1, -1, -1):
        m = live[t]
        if t + 1 < steps:
            q = live[t + 1]
            ahead = seen[t + 1, :q] * beta[:q] / scale[t + 1, :q, None]
            moves += alpha[t, :q].T @ ahead
            beta[:q] = ahead @ move.T
            beta[q:m] = 1.0
        gamma[t, :m] = alpha[t, :m] * beta[:m]
    on = np.arange(steps)[:, None] < lengths[None, :]
    g, o = gamma[on], obs[on]
    emits = np.stack([np.bincount(o, weights=g[:, k], minlength=size) for k in range(len(start))], axis=1)
    return gamma[0].sum(axis=0), moves * move, emits


def _expected(sent, end: int):
    def run(batches):
        model = sent.value
        size, states = model[2].shape
        starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((size, states))
        for batch in batches:
            for obs, lengths in _stretches(batch.column("syms").to_pylist(), end):
                a, b, c = _forward_backward(obs, lengths, model, size)
                starts, moves, emits = starts + a, moves + b, emits + c
        # One row per symbol and state row: the first rows are the starts and the moves.
        whole = np.concatenate([starts[None, :], moves, emits])
        at = np.flatnonzero(whole.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(whole[at, k]) for k in range(states))], ["i", *(f"s{k}" for k in range(states))])

    return run


def _first_model(symbols: Symbols, states: int):
    """Emissions around the unigram shares, each state off by fixed pseudo-random factors; moves that favour staying."""
    share = np.concatenate([symbols.counts, symbols.bucket_tokens]) + 0.1
    noise = mix(np.arange(symbols.size * states, dtype=np.uint64) + np.uint64(5)).astype(np.float64) / 2.0**64
    emit = share[:, None] * np.exp(2.0 * noise.reshape(symbols.size, states))
    move = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return np.full(states, 1.0 / states), move, emit / emit.sum(axis=0)


def train(prepared: DataFrame, symbols: Symbols, states: int = STATES, rounds: int = ROUNDS):
    """(start, move, emit) after ``rounds`` of Baum-Welch over the rows that are not held out."""
    model = _first_model(symbols, states)
    texts = prepared.where("not held_out").select("syms")
    names = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        sent = texts.sparkSession.sparkContext.broadcast(model)
        rows = texts.mapInArrow(_expected(sent, symbols.end), "i int, " + ", ".join(f"{n} double" for n in names))
        whole = np.zeros((1 + states + symbols.size, states))
        for r in rows.groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).collect():  # the size of the model
            whole[r["i"]] = [r[n] for n in names]
        start, move, emit = whole[0] + 1.0, whole[1 : 1 + states] + 1.0, whole[1 + states :] + 0.1
        model = start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
        sent.unpersist()
    return model


def log10_likelihoods(sequences: list[np.ndarray], model) -> np.ndarray:
    """Exact log10 probabilities of whole symbol sequences (at least one symbol each) by the scaled forward recursion."""
    start, move, emit = model
    out = np.zeros(len(sequences))
    order = np.argsort([-len(x) for x in sequences], kind="stable")
    i = 0
    while i < len(order):
        # Sequences of similar length run together; padding is at most as much as the tokens themselves.
        longest, j, held = len(sequences[order[i]]), i, 0
        while j < len(order) and (j == i or (held + longest <= 4 * CHUNK_TOKENS)):
            held += longest
            j += 1
        part = [sequences[k] for k in order[i:j]]
        obs, lengths = _matrix(part)
        total = np.zeros(len(part))
        a = None
        live = np.searchsorted(-lengths, -np.arange(len(obs)), side="left")
        for t in range(len(obs)):
            m = live[t]
            a = (start if t == 0 else a[:m] @ move) * emit[obs[t, :m]]
            scale = a.sum(axis=1)
            a = a / scale[:, None]
            total[:m] += np.log10(scale)
        out[order[i:j]] = total
        i = j
    return out


def _scored(sent):
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        symbols, model = sent.value
        place, c = words["place"].to_numpy(), words["c"].to_numpy()
        counts, bucket = np.zeros(len(place)), np.zeros(len(place), dtype=np.int64)
        counts[place], bucket[place] = c, words["bucket"].to_numpy()
        inside = np.log10((counts + 0.1) / (symbols.bucket_tokens[bucket] + 0.1 * (symbols.bucket_words[bucket] + 1)))
        base = symbols.base(counts)
        own_base = np.concatenate([symbols.base(symbols.counts), np.zeros(BUCKETS)])
        own_known = np.concatenate([symbols.counts > 0, np.zeros(BUCKETS, dtype=bool)]).astype(np.int64)
        out: dict[str, list] = {"n_tokens": [], "n_known": [], "train_tokens": [], "base_score": [], "score": []}
        syms = [np.append(np.frombuffer(x, dtype="<u2").astype(np.int64), symbols.end) for x in texts["syms"].to_pylist()]
        hidden = log10_likelihoods(syms, model)
        for s, raw, log in zip(syms, texts["rare"].to_pylist(), hidden):
            r = np.frombuffer(raw, dtype="<i4")
            out["n_tokens"].append(len(s))
            out["n_known"].append(int(own_known[s].sum() + (counts[r] > 0).sum()))
            out["train_tokens"].append(symbols.tokens)
            out["base_score"].append(float(own_base[s].sum() + base[r].sum()))
            out["score"].append(float(log + inside[r].sum()))
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"], **out})

    return run


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    folded = docs.select("doc_id", "text", (fold("doc_id", 10) == 0).alias("held_out"))
    counts = word_counts(folded.where("not held_out"))
    symbols = Symbols(counts)
    kind = folded.schema["doc_id"].dataType.simpleString()
    given = packed(folded).mapInArrow(
        _prepared(spark.sparkContext.broadcast(symbols)), f"doc_id {kind}, held_out boolean, part bigint, syms binary, rare binary, words binary"
    )
    prepared = stage_table(given, "symbol-texts", "zstd")
    model = train(prepared, symbols, states, rounds)
    listed = prepared.where("words is not null").select("part", "words").mapInArrow(_listed, "part bigint, place int, h bigint")
    found = listed.join(counts.select("h", "c"), "h", "left").select("part", "place", F.expr(_BUCKET).alias("bucket"), F.coalesce("c", F.lit(0)).alias("c"))
    texts = prepared.select("part", "doc_id", "held_out", "syms", "rare")
    # A part is one slice of the preparation, so both sides of a group are bounded by GROUP_BYTES of text.
    return (
        texts.groupBy("part")
        .cogroup(found.groupBy("part"))
        .applyInArrow(
            _scored(spark.sparkContext.broadcast((symbols, model))),
            f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        )
    )


def _listed(batches):
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("words").to_pylist()):
            h = np.frombuffer(raw, dtype="<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), part)), pa.array(np.arange(len(h)), pa.int32()), pa.array(h)], ["part", "place", "h"])
