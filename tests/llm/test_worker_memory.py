"""What a Python worker holds while stages follow one another in it."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from tidemark.llm import bpe, common, idcoder, langid, near_dedup, tokenfile


def rows_of(texts, **columns):
    struct = pa.StructArray.from_arrays([pa.array(texts, pa.string()), *map(pa.array, columns.values())], ["text", *columns])
    return pa.RecordBatch.from_arrays([struct], ["row"])


def peak_of(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_one_slice_of_a_batch_is_copied_at_a_time():
    batch = rows_of(["x" * (1 << 20)] * 40)
    assert peak_of(lambda: [None for _ in common.row_slices([batch])]) < 8 << 20
    pairs = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(range(40)), *[pa.array(["a b " * 1000] * 40)] * 2], ["a", "b", "a_text", "b_text"])
    assert sum(x.num_rows for x in near_dedup._linked(0.8)([pairs])) == 40


def test_slices_are_whole_and_keep_their_bounds():
    texts = [None, "", "é" * 10, "x" * 300, None, "y", "z" * 99, ""]
    batch = rows_of(texts).slice(1)
    got = list(common.row_slices([batch], limit=100, rows=3))
    assert [t for _, part in got for t in part] == [(t or "").encode() for t in texts[1:]]
    assert [len(part) for _, part in got] == [b.num_rows for b, _ in got] == [3, 3, 1]
    assert list(common.row_slices([batch.slice(0, 0)])) == []


def test_language_profiles_hold_few_wide_vectors():
    """10,000 runs of 8,192 signs; 1,024 of them at once took 110 MB and more."""
    r = np.random.default_rng(5)
    texts = ["".join(map(chr, r.integers(0x61, 0x7B, 400))) for _ in range(40)]
    assert peak_of(lambda: list(langid._learned([rows_of(texts, lang=["a"] * 40)]))) < 50 << 20


def test_an_operator_drops_what_another_keeps():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = bpe._codec(path, public_tokenizers.PATTERN)
    list(common.row_slices([rows_of(["a b"])], operator="bpe"))
    assert bpe._codec(path, public_tokenizers.PATTERN) is codec
    list(langid._learned([rows_of(["a b"], lang=["a"])]))
    assert not common._KEPT and not common._POWERS


def test_words_are_learned_apart_from_their_marks():
    """Each word and each run of marks is given to the tokenizer once, whatever they stand beside."""
    encoder = tokenfile.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    given, ids = [], encoder._ids
    encoder._ids = lambda texts: given.extend(texts) or ids(texts)
    texts = ["Word$$$ wordé### word,&&& word", "WORD### wordé$$$ Wordé", " <|endoftext|>a a<|endoftext|> it's_ İ$$ ", "", "\x1c ♥\t1a"]
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert got == ids(texts)
    pieces = " ".join(given).split()
    assert [pieces.count(p) for p in ("word", "wordé", "$$$", "###")] == [1, 1, 1, 1]
    assert encoder.encode([]) == []


def test_a_full_cache_keeps_what_the_slice_holds(monkeypatch):
    """Pieces that are known when the cache is emptied are not given to the tokenizer again."""
    encoder = tokenfile.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    given, ids = [], encoder._ids
    encoder._ids = lambda texts: given.extend(texts) or ids(texts)
    encoder.encode([b"alpha beta, gamma"])
    monkeypatch.setattr(tokenfile, "CACHE_PIECES", 6)
    given.clear()
    assert np.frombuffer(encoder.encode([b"alpha, delta beta, epsilon"])[0], dtype="<u4").tolist() == ids(["alpha, delta beta, epsilon"])[0]
    assert " ".join(given).split() == ["delta", "epsilon"] and len(encoder.known) <= 6


def test_tables_of_few_ids_take_two_bytes_a_slot():
    for distinct, width in ((16_383, 2), (16_384, 4)):
        assert idcoder._Model(2, idcoder.Order0.of(np.arange(distinct))).slots.itemsize == width
