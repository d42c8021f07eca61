"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

The patterns find ``assign``, ``access`` and ``hex`` spans. What they find is the labelled sample of random strings; runs of
identifier characters outside these spans that are built like names (words, camel case, joined by separators) or numbers
are the labelled sample of ordinary identifiers. Both samples give counts of
neighbouring characters (a start and an end included), added up over all documents into two tables of fixed size. A run of
``RUN`` or more identifier characters that no pattern span touches is a ``markov`` span if the log-likelihood ratio of
the two models is at least ``total`` nats and at least ``mean`` nats per character.

Offsets are code points, ends exclusive. Nulls: a null text is empty and has no spans. Without samples no span is added.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, row_slices

KINDS = ("assign", "access", "hex", "markov")
RUN = 20
TOTAL = 12.0
MEAN = 0.5
# Fixed by the contract.
_PATTERNS = (
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 8),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    (re.compile(r"[0-9a-f]+"), 0, 32),
)
_HEX = re.compile(r"[0-9a-f]{32,}")  # the matches of the last pattern that can pass
_SAMPLE = re.compile(r"[A-Za-z0-9+/=_-]{8,}")
# Possessive throughout, so that a run is tried once whatever its length.
_ORDINARY = re.compile(r"(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[0-9]++)(?:[_/=+-]?[A-Z]?[a-z]{2,}+|[_/=+-][A-Z]{2,}+)*+(?:[_/=+-]?[0-9]++)*+[_/=+-]*+")
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_SIZE = len(_LETTERS) + 1  # the last code is the edge of a string
_CODE = np.full(256, _SIZE - 1, dtype=np.int64)
_CODE[np.frombuffer(_LETTERS, dtype=np.uint8)] = np.arange(len(_LETTERS))
_SPAN = "array<struct<kind:string,start:bigint,end:bigint,ratio:double>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the pattern spans, in that order."""
    out = []
    for k, (pattern, group, least) in enumerate(_PATTERNS):
        for m in (_HEX if k == 2 else pattern).finditer(text):
            value = m.group(group)
            if len(value) >= least:
                out.append((m.start(), k, m.end(), value))
    return sorted(out)


def _outside(text: str, spans) -> list[re.Match]:
    """Identifier runs that touch no span."""
    runs, out, at, reach = _SAMPLE.finditer(text), [], 0, 0
    if not spans:
        return list(runs)
    for m in runs:
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= m.start():
            out.append(m)
    return out


def _transitions(strings: list[str]) -> np.ndarray:
    """Codes of neighbouring characters as one number each, with an edge around every string."""
    data = _CODE[np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("ascii"), dtype=np.uint8)]
    return data[:-1] * _SIZE + data[1:]


def _counted(batches):
    counts = np.zeros((2, _SIZE * _SIZE), dtype=np.int64)
    for _, texts in row_slices(batches):
        samples: tuple[list[str], list[str]] = ([], [])
        for raw in texts:
            text = raw.decode()
            spans = base_spans(text)
            samples[1].extend(s[3] for s in spans)
            samples[0].extend(m.group() for m in _outside(text, spans) if _ORDINARY.fullmatch(m.group()))
        for label in (0, 1):
            if samples[label]:
                counts[label] += np.bincount(_transitions(samples[label]), minlength=_SIZE * _SIZE)
    label, pair = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(pair), pa.array(counts[label, pair])], ["label", "pair", "n"])


def train(docs: DataFrame, text_column: str = "text") -> np.ndarray | None:
    """The log ratio of the two models for every pair of characters; None without samples of both kinds."""
    given = packed(docs.select(F.col(text_column).alias("text")))
    rows = given.mapInArrow(_counted, "label bigint, pair bigint, n bigint").groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, _SIZE, _SIZE))
    for r in rows:  # at most two tables of _SIZE squared
        counts[r["label"], r["pair"] // _SIZE, r["pair"] % _SIZE] = r["n"]
    if not counts.sum(axis=(1, 2)).all():
        return None
    chance = (counts + 0.5) / (counts + 0.5).sum(axis=2, keepdims=True)
    return np.log(chance[1]) - np.log(chance[0])


def ratios(strings: list[str], model: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each string, its edges included."""
    if not strings:
        return np.zeros(0)
    steps = model.reshape(-1)[_transitions(strings)]
    sizes = np.array([len(s) + 1 for s in strings])
    return np.add.reduceat(steps, np.cumsum(sizes) - sizes)


def scan(docs: DataFrame, model: np.ndarray | None, text_column: str = "text", total: float = TOTAL, mean: float = MEAN) -> DataFrame:
    """``row`` (all columns of the document) and its ``spans`` by start, then kind: kind, start, end, ratio (of markov spans)."""
    wide = packed(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for batch, texts in row_slices(batches, text_column):
            spans, runs, owner = [], [], []
            for i, raw in enumerate(texts):
                text = raw.decode()
                spans.append([(a, k, b, None) for a, k, b, _ in base_spans(text)])
                if model is not None:
                    found = [m for m in _outside(text, spans[-1]) if m.end() - m.start() >= RUN]
                    runs += found
                    owner += [i] * len(found)
            scores = ratios([m.group() for m in runs], model) if runs else ()
            for i, m, score in zip(owner, runs, scores):
                if score >= total and score >= mean * (m.end() - m.start()):
                    spans[i].append((m.start(), 3, m.end(), float(score)))
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "ratio": r} for a, k, b, r in sorted(s, key=lambda x: x[:3])] for s in spans]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(rows, kind)], ["row", "spans"])

    return wide.mapInArrow(run, f"row {wide.schema['row'].dataType.simpleString()}, spans {_SPAN}")
