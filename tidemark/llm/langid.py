"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, drawn from hashes of its code point. A run of three letters (a gap
between words counts as one) is bound into one vector: the product of the letters' vectors, permuted by two, one and no
places. A text is the bundle (the sum) of its run vectors; a language is the bundle of its training texts, each of which
counts the same. A text gets the language of the largest cosine; that cosine, 0 at least, is the score.

Training adds up the bundles per task and language; (language, dimension) sums are what is shuffled, and one vector per
language is what comes back.

``accepted`` decides whether a text is like any language, and does so by the text's own length. It takes ``WIDE`` signs, adds the
cosines of the single runs, and compares the sum with what a clean text of as many runs has on average: the level of the language,
learned from its distinct texts, each held against the others, so that many copies of one text do not set it. A text is only refused if its sum is below a share of that average and
farther below it than clean texts of its length stray. So one word is hardly ever refused, and many words of random letters always are.

Nulls and texts without a letter get ``und`` and score 0, as do all texts where nothing was learned. Ties go to the language that
sorts first. Where nothing was learned, ``accepted`` has nothing to hold a text against and keeps all that have a letter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, packed, row_slices

DIMENSIONS = 1024
#: Signs of the vectors that ``accepted`` compares; the chance of a cosine is 1/90.
WIDE = 8192
#: How far the sum of a clean text strays below its average: levels times the root of the summed squares of its run counts. Words
#: stray by 1.1 to 1.6 of these (one deviation), the farthest of 3,000 phrases by 3.9.
FAR = 4.0
UNKNOWN = "und"
_GAP = 0x20
_SLICE = 1 << 20
_ROWS = 256  # a slice is a matrix of its rows by its distinct runs
_BLOCK = 256  # runs whose wide vectors are held at once
_HELD = 1 << 20  # runs a task remembers
_TABLES: dict = {}


def _letters() -> np.ndarray:
    """Code point -> itself if it is a letter, else the gap."""
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.fromiter((c if chr(c).isalpha() else _GAP for c in range(0x110000)), dtype=np.int32, count=0x110000)
    return _TABLES["letters"]


def _vectors(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """(len(points), dimensions) signs."""
    word = mix(points.astype(np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(1, dimensions // 64 + 1, dtype=np.uint64))
    bits = np.unpackbits(np.ascontiguousarray(mix(word)).view(np.uint8), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct three-letter runs as (n, 3) code points, and for each occurrence its run and its text."""
    joined = np.frombuffer("".join(f"\x00{t.lower()}\x00" for t in texts).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.array([len(t.lower()) + 2 for t in texts], dtype=np.int64)
    points = _letters()[joined]
    owner = np.repeat(np.arange(len(texts)), sizes)
    start = np.zeros(len(points), dtype=bool)
    start[np.cumsum(sizes) - sizes] = True
    keep = (points != _GAP) | start
    keep[1:] |= points[:-1] != _GAP  # the first of several gaps
    points, owner = points[keep], owner[keep]
    a, b, c = points[:-2], points[1:-1], points[2:]
    whole = (owner[:-2] == owner[2:]) & (b != _GAP) | ((a != _GAP) & (c != _GAP) & (b == _GAP) & (owner[:-2] == owner[2:]))
    codes = (a[whole].astype(np.int64) << 42) | (b[whole].astype(np.int64) << 21) | c[whole]
    distinct, which = np.unique(codes, return_inverse=True)
    return np.stack([distinct >> 42, (distinct >> 21) & 0x1FFFFF, distinct & 0x1FFFFF], axis=1), which, owner[:-2][whole]


def _bound(distinct: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The vectors of the runs."""
    points, at = np.unique(distinct, return_inverse=True)
    at = at.reshape(distinct.shape)
    letters = _vectors(points, dimensions)
    return (np.roll(letters, 2, axis=1)[at[:, 0]] * np.roll(letters, 1, axis=1)[at[:, 1]] * letters[at[:, 2]]).astype(np.float32)


def _weights(which, owner, rows, n_rows, n_runs, weights=None) -> np.ndarray:
    return np.bincount(rows[owner] * n_runs + which, weights=weights, minlength=n_rows * n_runs).reshape(n_rows, n_runs)


def bundles(texts: list[str]) -> np.ndarray:
    """(len(texts), DIMENSIONS) bundles; zero where a text has no letter."""
    distinct, which, owner = runs(texts)
    if not len(distinct):
        return np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    counts = _weights(which, owner, np.arange(len(texts)), len(texts), len(distinct)).astype(np.float32)
    return counts @ _bound(distinct)


def _trained(batches):
    sums: dict[str, np.ndarray] = {}
    for batch, raw in row_slices(batches, limit=_SLICE, rows=_ROWS):
        rows = batch.column("row")
        names = rows.field(rows.type.get_field_index("lang")).to_pylist()
        distinct, which, owner = runs([t.decode() for t in raw])
        if not len(distinct):
            continue
        langs = sorted(set(names))
        row = np.array([langs.index(n) for n in names])
        share = 1.0 / np.maximum(np.bincount(owner, minlength=len(raw)), 1)
        counts = _weights(which, owner, row, len(langs), len(distinct), share[owner])
        for name, v in zip(langs, counts.astype(np.float32) @ _bound(distinct)):
            sums[name] = sums.get(name, 0) + v.astype(np.float64)
    for name, v in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * DIMENSIONS), pa.array(np.arange(DIMENSIONS), pa.int32()), pa.array(v)], ["lang", "i", "x"])


def train(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and their unit vectors, learned from all rows with a language."""
    given = docs.where(F.col(lang_column).isNotNull()).select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    sums = packed(given).mapInArrow(_trained, "lang string, i int, x double").groupBy("lang", "i").agg(F.sum("x").alias("x"))
    learned: dict[str, np.ndarray] = {}
    for r in sums.collect():  # one number per language and dimension
        learned.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["i"]] = r["x"]
    names = sorted(learned)
    vectors = np.array([learned[n] for n in names]).reshape(len(names), DIMENSIONS)
    return names, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_column: str = "text") -> DataFrame:
    """``row`` (all columns of the document), lang_pred and score."""
    wide = packed(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        names, prototypes = sent.value
        for batch, raw in row_slices(batches, text_column, _SLICE, _ROWS):
            v = bundles([t.decode() for t in raw]).astype(np.float64)
            norm = np.linalg.norm(v, axis=1)
            known = (norm > 0) & bool(names)
            best, score = np.zeros(len(raw), dtype=int), np.zeros(len(raw))
            if names:
                cosine = (v @ prototypes.T) / np.maximum(norm, 1e-12)[:, None]
                best, score = cosine.argmax(axis=1), np.clip(cosine.max(axis=1), 0.0, 1.0) * known
            picked = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(picked, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    return wide.mapInArrow(run, f"row {wide.schema['row'].dataType.simpleString()}, lang_pred string, score double")


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def _codes(distinct: np.ndarray) -> np.ndarray:
    return (distinct[:, 0].astype(np.int64) << 42) | (distinct[:, 1].astype(np.int64) << 21) | distinct[:, 2]


def _blocks(codes: np.ndarray):
    """Places and wide vectors of the runs, a block at a time."""
    for a in range(0, len(codes), _BLOCK):
        part = codes[a : a + _BLOCK]
        yield slice(a, a + len(part)), _bound(np.stack([part >> 42, (part >> 21) & 0x1FFFFF, part & 0x1FFFFF], axis=1), WIDE)


def _counted(owner: np.ndarray, which: np.ndarray, n_runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, run and count of every run of every text."""
    pair, count = np.unique(owner * np.int64(n_runs) + which, return_counts=True)
    return pair // n_runs, pair % n_runs, count.astype(np.float64)


def _learned(batches):
    """Sums per language: the wide bundle, and in places -1 and -2 the number of texts and the squared lengths of their own bundles."""
    sums: dict[str, np.ndarray] = {}
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def bundle():
        for name, (codes, share) in held.items():
            for at, vectors in _blocks(codes):
                sums[name][:WIDE] += share[at] @ vectors
        held.clear()

    for batch, raw in row_slices(batches, limit=_SLICE, rows=_ROWS):
        rows = batch.column("row")
        names = rows.field(rows.type.get_field_index("lang")).to_pylist()
        distinct, which, owner = runs([t.decode() for t in raw])
        if not len(distinct):
            continue
        text, run, count = _counted(owner, which, len(distinct))
        share = count / np.bincount(owner, minlength=len(raw))[text]
        lang, codes = np.array(names, dtype=object)[text], _codes(distinct)
        for name in set(lang):
            of = lang == name
            total = sums.setdefault(name, np.zeros(WIDE + 2))
            total[WIDE] += len(np.unique(text[of]))
            total[WIDE + 1] += WIDE * (share[of] ** 2).sum()
            known, weight = held.get(name, (codes[:0], share[:0]))
            both, at = np.unique(np.concatenate([known, codes[run[of]]]), return_inverse=True)
            held[name] = both, np.bincount(at, weights=np.concatenate([weight, share[of]]))
        if sum(len(known) for known, _ in held.values()) > _HELD:
            bundle()
    bundle()
    places = pa.array(np.concatenate([np.arange(WIDE), [-1, -2]]), pa.int32())
    for name, x in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(x)), places, pa.array(x)], ["lang", "i", "x"])


def profiles(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages, sorted, their wide unit vectors, and their levels: the mean cosine of a run of one text with the other texts.
    A language with a single text has level 0."""
    given = docs.where(F.col(lang_column).isNotNull()).select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    # Copies of a text are folded before and after the shuffle, so a text that very many rows repeat is one row per task.
    rows = packed(given.where(F.col("text").isNotNull()).dropDuplicates(["lang", "text"])).mapInArrow(_learned, "lang string, i int, x double").groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    learned: dict[str, np.ndarray] = {}
    for r in rows:  # one number per language and dimension
        learned.setdefault(r["lang"], np.zeros(WIDE + 2))[r["i"] if r["i"] >= 0 else WIDE - 1 - r["i"]] = r["x"]
    names = sorted(learned)
    sums = np.array([learned[n] for n in names]).reshape(len(names), WIDE + 2)
    bundle, texts, own = sums[:, :WIDE], sums[:, WIDE], sums[:, WIDE + 1]
    size = np.maximum(np.linalg.norm(bundle, axis=1), 1e-12)
    others = np.where(texts > 1, (size**2 - own) / np.maximum(texts - 1, 1), 0.0)
    return names, (bundle / size[:, None]).astype(np.float32), np.maximum(others, 0.0) / (size * np.sqrt(WIDE))


def _like(texts: list[str], model, known: list) -> np.ndarray:
    """Per text: the sum of its runs' cosines with the nearest language, that language's level, the number of its runs and the root
    of the summed squares of their counts. ``known`` holds the runs met so far, sorted, and their cosines."""
    _, unit, level = model
    distinct, which, owner = runs(texts)
    codes = _codes(distinct)
    fresh = codes[~np.isin(codes, known[0])] if known else codes
    if len(fresh):
        cosine = np.empty((len(fresh), len(unit)))
        for at, vectors in _blocks(fresh):
            cosine[at] = vectors @ unit.T / np.sqrt(WIDE)
        if known and len(known[0]) < _HELD:
            fresh, cosine = np.concatenate([known[0], fresh]), np.concatenate([known[1], cosine])
        elif known:  # start anew, with the runs of this slice
            old = np.isin(known[0], codes)
            fresh, cosine = np.concatenate([known[0][old], fresh]), np.concatenate([known[1][old], cosine])
        order = np.argsort(fresh)
        known[:] = fresh[order], cosine[order]
    text, run, count = _counted(owner, which, max(len(distinct), 1))
    of = known[1][np.searchsorted(known[0], codes)][run] if len(codes) else np.zeros((0, len(unit)))
    sums = np.stack([np.bincount(text, weights=count * of[:, k], minlength=len(texts)) for k in range(len(unit))], axis=1)
    best = sums.argmax(axis=1)
    n = np.bincount(owner, minlength=len(texts))
    return np.stack([sums.max(axis=1), level[best], n, np.sqrt(np.bincount(text, weights=count**2, minlength=len(texts)))])


def accepted(docs: DataFrame, least: float, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are like a language, learned from three of four rows: texts with a letter, but for those whose runs
    are below ``least`` of the language's level on average and farther below it than clean texts of that length. The result does not
    depend on how the rows are dealt to tasks. Without any ``lang`` all texts with a letter stay."""
    wide = packed(docs)
    sent = docs.sparkSession.sparkContext.broadcast(profiles(docs.where(fold(id_column, 4) != 2)))

    def run(batches):
        model, known = sent.value, []
        for batch, raw in row_slices(batches, limit=_SLICE, rows=_ROWS):
            if not model[0]:
                _, _, owner = runs([t.decode() for t in raw])
                yield batch.filter(pa.array(np.bincount(owner, minlength=len(raw)) > 0))
            else:
                total, level, n, spread = _like([t.decode() for t in raw], model, known)
                far = (total < least * level * n) & (level * n - total > FAR * level * spread)
                yield batch.filter(pa.array((n > 0) & ~(far & (level > 0))))

    return wide.mapInArrow(run, f"row {wide.schema['row'].dataType.simpleString()}").select("row.*")
