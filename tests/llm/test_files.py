"""WARC archives and token files: round trips, damage, edge cases."""

import base64
import gzip
import hashlib
import io
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import idcoder, tokenfile, warc

# --- WARC -----------------------------------------------------------------------------------------------------------


def archive(n=20, compressed=True, size=700):
    r = random.Random(n)
    blocks = [bytes(r.randrange(256) for _ in range(r.randrange(size))) for _ in range(n)]
    parts = [warc.record([("WARC-Type", "response"), ("WARC-Page-ID", str(i))], b, compressed) for i, b in enumerate(blocks)]
    return blocks, parts


def scan(raw):
    found = list(warc.records(io.BytesIO(raw)))
    covered = sorted((a, n) for _, a, n, _, _ in found)
    at = 0
    for a, n in covered:  # records and gaps tile the file
        assert a == at
        at += n
    assert at == len(raw)
    return {int(f["warc-page-id"]): b for what, _, _, f, b in found if what == "record"}, [(a, n, why) for what, a, n, _, why in found if what == "gap"]


@pytest.mark.parametrize("compressed", [True, False])
def test_sound_archives_read_back(compressed):
    blocks, parts = archive(compressed=compressed)
    got, gaps = scan(b"".join(parts))
    assert got == dict(enumerate(blocks)) and gaps == []


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("harm", ["flip", "cut", "junk", "zeros", "head"])
def test_records_after_damage_are_recovered(compressed, harm):
    blocks, parts = archive(compressed=compressed, size=3000)
    bad = bytearray(parts[7])
    if harm == "flip":
        bad[len(bad) * 2 // 3] ^= 0x55
    elif harm == "cut":
        bad = bad[: len(bad) // 2]
    elif harm == "junk":
        bad = bytearray(b"\x1f\x8b\x08 not a member WARC/1.1\r\nx") + bad
    elif harm == "zeros":
        bad[20:200] = bytes(180)
    else:
        bad[0] ^= 0xFF
    got, gaps = scan(b"".join([*parts[:7], bytes(bad), *parts[8:]]))
    lost = {7} if harm != "junk" else set()
    assert {i: b for i, b in got.items() if i != 7} == {i: b for i, b in enumerate(blocks) if i != 7}
    assert set(range(20)) - set(got) <= lost and len(gaps) >= 1 and all(n > 0 and why for _, n, why in gaps)


def test_damage_at_the_ends_and_nothing_but_damage():
    blocks, parts = archive()
    whole = b"".join(parts)
    got, gaps = scan(whole[: -len(parts[-1]) // 2])
    assert set(got) == set(range(19)) and len(gaps) == 1 and gaps[0][0] == len(whole) - len(parts[-1])
    got, gaps = scan(b"garbage" + whole)
    assert set(got) == set(range(20)) and gaps[0][:2] == (0, 7)
    assert scan(b"") == ({}, []) and scan(b"\x00" * 200_000)[1][0][:2] == (0, 200_000)


def test_a_wrong_length_does_not_swallow_the_file():
    blocks, parts = archive(compressed=False)
    bad = parts[5].replace(b"Content-Length: ", b"Content-Length: 9")
    got, gaps = scan(b"".join([*parts[:5], bad, *parts[6:]]))
    assert set(range(20)) - set(got) == {5} and gaps


def found_in(raw):
    found = list(warc.records(io.BytesIO(raw)))
    return {int(f["warc-page-id"]): b for what, _, _, f, b in found if what == "record"}, [x for x in found if x[0] == "gap"]


def test_one_member_with_all_records():
    blocks, parts = archive(compressed=False)
    assert found_in(gzip.compress(b"".join(parts))) == (dict(enumerate(blocks)), [])
    bad = parts[5].replace(b"Content-Length: ", b"Content-Length: 9")
    whole = gzip.compress(b"".join([*parts[:5], bad, *parts[6:], b"rest"])) + gzip.compress(parts[5])
    got, gaps = found_in(whole)
    assert got == dict(enumerate(blocks)) and [why for *_, why in gaps] == ["the length does not fit", "no version line"]


@pytest.mark.parametrize("compressed", [True, False])
def test_folded_lines_and_other_digests(compressed):
    block = b"some payload of a page"
    sha1 = base64.b32encode(hashlib.sha1(block).digest()).decode()
    close = (lambda raw: gzip.compress(raw)) if compressed else bytes
    make = lambda digest, body: close(
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Page-ID: 1\r\nX: a\r\n\t b\r\nWARC-Block-Digest: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (digest.encode(), len(body), body)
    )
    for digest in (f"sha1:{sha1}", f"sha1:{hashlib.sha1(block).hexdigest()}", f"SHA-256:{hashlib.sha256(block).hexdigest()}", "other:x"):
        assert found_in(make(digest, block)) == ({1: block}, [])
    got, gaps = found_in(make(f"sha1:{sha1}", block.replace(b"page", b"pagf")))
    assert got == {} and len(gaps) == 1


def test_members_are_plain_gzip():
    _, parts = archive(3)
    assert gzip.decompress(b"".join(parts)).count(b"WARC/1.1\r\n") == 3


PAGES = "page_id BIGINT, url STRING, html STRING"


def brute_pages(rows):
    first = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = h in first and i != first[h]
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    return sorted(out, key=repr)


def test_pages_round_trip(spark):
    long = "é" * 60
    rows = [(1, "u", "short"), (2, None, "short"), (3, "u", None), (4, "u\r\nX: y", ""), (9, "u", long), (5, "u", long), (7, "u", long), (6, "u", "x" * 99), (8, "u", "x" * 99)]
    rows += [(10, "u", "y" * 3_000_000), (11, "u", "y" * 3_000_000), (None, "u", long), (20, "u", long * 2), (20, "u", long * 2)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"kind": F.lit("k"), "digest": F.lit(1)}).repartition(3)
    manifest = warc.write(pages)
    read = warc.read(manifest)
    assert warc.quarantine(read).count() == 0
    got = warc.resolved(read).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute_pages(rows)


def test_pages_with_long_urls_and_control_characters(spark):
    long, data = "é" * 60, "data:text/html;base64," + "QUJD" * 50_000
    rows = [(1, data, long), (2, "u", long), (3, "http://x/\x00\x01\x7f", "y" * 200), (4, "u", "y" * 200), (5, "a\r\nContent-Length: 3\t ", "z"), (6, " ", "z")]
    read = warc.read(warc.write(spark.createDataFrame(rows, PAGES)))
    assert warc.quarantine(read).count() == 0
    got = warc.resolved(read).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute_pages(rows)
    urls = {r.id: r.url for r in read.collect()}
    assert urls == {"1": data, "2": "u", "3": "http://x/%00%01%7F", "4": "u", "5": "a%0D%0AContent-Length: 3%09", "6": "about:blank"}


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("size", [65_300, 65_400, 65_500, 131_000, 1_000_000])
def test_long_headers_are_read_and_damage_in_them_is_not(compressed, size):
    blocks, parts = archive(compressed=compressed)
    parts[3] = warc.record([("WARC-Type", "response"), ("WARC-Page-ID", "3"), ("WARC-Target-URI", "u" * size)], blocks[3], compressed)
    assert scan(b"".join(parts)) == (dict(enumerate(blocks)), [])
    if not compressed:
        bad = parts[3][: size // 2] + b"\x00" + parts[3][size // 2 :]
        got, gaps = scan(b"".join([*parts[:3], bad, *parts[4:]]))
        assert set(range(20)) - set(got) == {3} and len(gaps) == 1


def test_no_pages_and_a_damaged_file(spark, tmp_path):
    none = warc.write(spark.createDataFrame([], PAGES))
    assert warc.resolved(warc.read(none)).count() == 0
    blocks, parts = archive()
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(parts[:4]) + b"??" + b"".join(parts[4:]))
    rows = warc.read(spark.createDataFrame([(f"file://{path}",)], "path STRING"))
    assert rows.where("what = 'record'").count() == 20
    log = warc.quarantine(rows).collect()
    assert [(r.start, r.bytes) for r in log] == [(sum(map(len, parts[:4])), 2)] and log[0].path.endswith("a.warc.gz")


# --- token files ----------------------------------------------------------------------------------------------------


def coded(symbols, sizes, table):
    codes = idcoder.encode_blocks(symbols, sizes, table)
    assert np.array_equal(
        np.concatenate([r[:n] for r, n in zip(idcoder.decode_blocks(codes, sizes, table), sizes)] or [[]]),
        np.concatenate([r[:n] for r, n in zip(symbols, sizes)] or [[]]),
    )
    return sum(map(len, codes))


@pytest.mark.parametrize("kind", ["one", "random", "zipf", "repeat", "wide"])
def test_blocks_round_trip(kind):
    rng = np.random.default_rng(7)
    sizes = np.array([300, 300, 299, 17, 1])
    ids = {
        "one": np.zeros((5, 300), dtype=int),
        "random": rng.integers(0, 50_000, (5, 300)),
        "zipf": np.minimum(rng.zipf(1.3, (5, 300)), 40_000),
        "repeat": np.tile(rng.integers(0, 1000, 20), (5, 15)),
        "wide": np.arange(1500).reshape(5, 300),
    }[kind]
    table = idcoder.Order0.of(ids.reshape(-1))
    assert table.shares.sum() == idcoder.MAX_IDS and (table.shares > 0).all()
    size = coded(np.searchsorted(table.ids, ids), sizes, table)
    if kind == "repeat":
        assert size < 0.25 * sizes.sum()  # orders 1 and 2 learn the period


def test_all_share_extremes_round_trip():
    ids = np.concatenate([np.zeros(70_000, dtype=int), np.arange(60_000)])
    table = idcoder.Order0.of(ids)
    rng = np.random.default_rng(3)
    coded(rng.choice(60_000, (40, 500)), np.full(40, 500), table)
    assert idcoder.encode_blocks(np.zeros((0, 0)), np.zeros(0, dtype=int), table) == []


def plainly_coded(row, table):
    """The code of one block, id by id in whole numbers."""
    low, span, digits, last, before = 0, 1 << 48, [], 0, 0
    slots = ({}, {})
    first = [1, 1024, 2048, 3072]
    chances = {(c2, c1): [first[c2], first[c1]] for c2 in range(4) for c1 in range(4)}

    def narrow(begin, width, bits):
        nonlocal low, span
        low, span = low + (span >> bits) * begin, (span >> bits) * width

    for sym in row.tolist():
        at = (last * 40503 >> 4 & 511, last * 40503 + before * 52429 >> 3 & 1023)
        (g1, c1), (g2, c2) = (own.get(i, (None, 0)) for own, i in zip(slots, at))
        p2, p1 = chances[c2, c1]
        w1 = ((4094 - p2) * p1 >> 12) + 1
        if g2 == sym:
            narrow(0, p2, 12)
        elif g1 == sym:
            narrow(p2, w1, 12)
        else:
            narrow(p2 + w1, 4096 - p2 - w1, 12)
            narrow(int(table.starts[sym]), int(table.shares[sym]), 16)
        while span < 1 << 32:
            digits.append(low >> 32)
            low, span = (low & (1 << 32) - 1) << 16, span << 16
        kept = p1 if g2 == sym else p1 + (((g1 == sym) * 4062 - p1 + 17) >> 4)
        chances[c2, c1] = [p2 + (((g2 == sym) * 4062 - p2 + 17) >> 4), kept]
        for own, i, g, c in zip(slots, at, (g1, g2), (c1, c2)):
            own[i] = (sym, min(c + 1, 3) if g == sym else 1)
        last, before = sym, last
    digits.append(low + (1 << 32) - 1 >> 32)
    for i in range(len(digits) - 1, 0, -1):
        digits[i - 1] += digits[i] >> 16
    return np.array([d & 0xFFFF for d in digits], dtype=">u2").tobytes()


@pytest.mark.parametrize("distinct", [1, 40, 16_383, 16_384, 65_536])
def test_codes_are_those_of_plain_whole_numbers(distinct):
    rng = np.random.default_rng(distinct)
    table = idcoder.Order0.of(np.concatenate([np.arange(distinct), rng.zipf(1.4, 9000) % distinct]))
    rows = rng.zipf(1.2, (6, 1024)) % distinct
    rows[1] = np.tile(rows[1, :64], 16)
    rows[2] = distinct - 1 - rows[2] % 7 % distinct
    sizes = np.array([1024, 1024, 1024, 1024, 1024, 600])
    assert idcoder.encode_blocks(rows, sizes, table) == [plainly_coded(r[:n], table) for r, n in zip(rows, sizes)]
    coded(rows, sizes, table)


@pytest.mark.parametrize("distinct", [300, 20_000])
def test_any_damage_stays_in_its_block(distinct):
    rng = np.random.default_rng(distinct)
    ids = np.concatenate([np.arange(distinct), rng.zipf(1.3, 40_000) % distinct]).astype("<u4")
    raw = tokenfile.pack([1], [ids.tobytes()])
    for _ in range(20):
        bad, at = bytearray(raw), len(tokenfile.MAGIC) + int(rng.integers(0, 10_000))
        bad[at : at + 40] = rng.integers(0, 256, 40, dtype=np.uint8).tobytes()
        _, sizes, flat, sound = tokenfile.unpack(bytes(bad))
        assert sizes.tolist() == [len(ids)] and 1 <= (~sound).sum() <= 2
        same = np.repeat(sound, tokenfile.BLOCK)[: len(ids)]
        assert np.array_equal(flat[same], ids[same])


def test_files_round_trip_and_report_damage():
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 3000, n).astype("<u4").tobytes() for n in (5, 0, 3000, 1, 1024, 2000)]
    raw = tokenfile.pack([4, None, 6, 7, 8, 9], ids)
    docs, sizes, flat, sound = tokenfile.unpack(raw)
    assert docs == [4, None, 6, 7, 8, 9] and flat.tobytes() == b"".join(ids) and sound.all() and sizes.tolist() == [len(x) // 4 for x in ids]
    bad = bytearray(raw)
    bad[len(tokenfile.MAGIC) + 10] ^= 1
    *_, sound = tokenfile.unpack(bytes(bad))
    assert not sound[0] and sound[1:].all()
    bad = bytearray(raw)
    bad[-40] ^= 1
    with pytest.raises(ValueError):
        tokenfile.unpack(bytes(bad))
    assert tokenfile.unpack(tokenfile.pack([], []))[0] == [] and tokenfile.unpack(tokenfile.pack([1], [b""]))[1].tolist() == [0]


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello  World!\tdon't STOP", None, "", " \n\x0b", "naïve café ÉCOLE ﬁ é  x y\x1cz", "<|endoftext|> a<|startoftext|>b <|endoftext|>c", "́ combining ́x",
    "1234567 ٣٤ 漢字仮名 🙂👍🏽", "word " * 5000, "x" * 20_000, "ΣΑΣ ΟΔΟΣ. İI ſ",
]


def test_chunked_encoding_is_the_libraries():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    encoder = tokenfile.Encoder(TOKENIZER)
    for _ in range(2):  # the second time from the cache
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([(t or "").encode() for t in TEXTS])] == want


def test_every_plain_letter_and_mark_is_coded_as_by_the_library():
    tokenizer, encoder = Tokenizer.from_file(TOKENIZER), tokenfile.Encoder(TOKENIZER)
    every = [chr(c) for c in range(0x21, 0x250)]
    texts = [f"{c} {c}{c} x{c} {c}x {c}! a{c}b {c}{d}" for c, d in zip(every, every[7:] + every[:7])] + ["".join(every), " ".join(every)]
    assert encoder.final is not None
    for got, text in zip(encoder.encode([t.encode() for t in texts]), texts):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("change", ["case", "letters"])
def test_other_rules_are_the_librarys(tmp_path, change):
    """Words are cut and lower-cased by themselves only where the tokenizer does so."""
    rules = json.loads(Tokenizer.from_file(TOKENIZER).to_str())
    if change == "case":
        rules["normalizer"]["normalizers"].pop()
    else:
        rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}]{1,2}|[\p{N}]|[^\s\p{L}\p{N}]"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(rules))
    tokenizer, texts = Tokenizer.from_file(str(path)), ["Hello WORLD... word", "wordy?! Words", ""]
    got = [np.frombuffer(x, "<u4").tolist() for x in tokenfile.Encoder(str(path)).encode([t.encode() for t in texts])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("file_ids", [tokenfile.FILE_IDS, 50])
def test_documents_round_trip_in_id_order(spark, file_ids):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = [30, 2, 9, 4, 5, None, 7, 7, 80, -3, 11]
    docs = spark.createDataFrame(list(zip(ids, TEXTS)), "doc_id BIGINT, text STRING").withColumns({"id": F.lit("x"), "ids": F.lit(1)}).repartition(3)
    manifest = tokenfile.write(docs, TOKENIZER, end_id=1, file_ids=file_ids)
    got = sorted(tokenfile.read(manifest).collect(), key=lambda r: r.start)
    want = {}
    for i, t in zip(ids, TEXTS):
        want.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    assert [r.id for r in got] == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        x = np.frombuffer(r.ids, "<u4").tolist()
        want[r.id].remove(x)
        assert (r.start, r.n_tokens, r.damaged) == (at, len(x), False)
        assert zlib.crc32(bytes(r.ids)) == spark.range(1).select(F.crc32(F.lit(bytearray(r.ids)))).first()[0]
        at += len(x)


def test_no_documents(spark):
    manifest = tokenfile.write(spark.createDataFrame([], "doc_id BIGINT, text STRING"), TOKENIZER)
    assert tokenfile.read(manifest).count() == 0
