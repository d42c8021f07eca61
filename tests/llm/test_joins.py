"""Decontamination, exact and near deduplication against brute force on small fixtures."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, decontaminate, exact_dedup, near_dedup

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id BIGINT, text STRING, lang STRING"


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en") for i, t in zip(ids, texts)], DOCS)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}é" for _ in range(n)]


# --- words ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "É Ab-c 12_x y", "A\x00B\x7fC", "ﬀ ſ İ", "x" * 5000])
def test_words_are_those_of_the_pattern(text):
    assert [w.decode() for w in common.words(text.encode())] == WORD.findall(lower(text))


def test_word_hashes_depend_on_the_word_only():
    texts = [b"aa bb aa", b"", b"Bb\nCC aa", b"  "]
    h, owner = common.word_hashes(texts)
    words = [w for t in texts for w in common.words(t)]
    assert owner.tolist() == [0, 0, 0, 2, 2, 2]
    assert all((words[i] == words[j]) == (h[i] == h[j]) for i in range(len(words)) for j in range(len(words)))


def test_stages_are_deleted_on_release(spark):
    kept = common.stage_table(spark.range(3), "probe")
    path = kept.inputFiles()[0]
    assert kept.count() == 3
    common.release(spark)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


# --- decontamination ------------------------------------------------------------------------------------------------


def brute_hits(text, items, window=10):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        w = WORD.findall(lower(body))
        n = min(window, len(w))
        if item is None or not n:
            continue
        for k in range(len(w) - n + 1):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == w[k : k + n]:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(words), len(hit), found


def decontamination_fixture():
    a, b = prose(1, 30, 15), prose(2, 12, 15)
    items = [(7, " ".join(a)), (11, " ".join(b)), (3, "short Item!"), (4, None), (5, "..."), (None, "w1é w2é"), (9, " ".join(a[:12]))]
    clean = prose(3, 80)
    texts = [
        " ".join(clean),
        " ".join(clean[:20] + a[5:15] + clean[20:]),
        " ".join(a[5:14] + clean),
        " ".join(clean + a).upper(),
        "a short-item, twice: SHORT  item",
        "".join(f"{w}\t" for w in b + b[:10] + a),
        None,
        "",
        "!?",
        " ".join(clean + a + clean * 300 + b),
        " ".join(a[5:15]),
        "short",
    ]
    return texts, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_hits_equal_brute_force(spark, block_bytes):
    texts, items = decontamination_fixture()
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    clashing = frame(spark, texts).withColumns({"row": F.lit(1), "spans": F.lit("x"), "n_words": F.lit(0), "items": F.lit(None).cast("int")})
    rows = decontaminate.benchmark_hits(clashing.repartition(3), benchmark, block_bytes=block_bytes).withColumn("n_hit", decontaminate.n_hit()).collect()
    got = {r["row"]["doc_id"]: (r["n_words"], r["n_hit"], set(r["items"])) for r in rows}
    assert got == {i: brute_hits(t, items) for i, t in enumerate(texts)}
    assert got[1][1] == 10 and got[2][1] == 0 and got[4][2] == {"3"} and got[9][1] == 42


def test_repeated_rows_empty_tables_and_the_filter(spark):
    texts, items = decontamination_fixture()
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    docs = frame(spark, texts + texts, list(range(len(texts))) * 2)
    assert decontaminate.benchmark_hits(docs, benchmark).count() == 2 * len(texts)
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 2, 3, 6, 7, 8, 11}
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == docs.count()
    assert decontaminate.benchmark_hits(docs.limit(0), benchmark).count() == 0


# --- exact deduplication --------------------------------------------------------------------------------------------


def brute_groups(rows):
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(strip(t), []).append((i, t or ""))
    out = []
    for key, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(i, best[0], len(members), hashlib.sha256(key.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=repr)


def test_ids_at_the_ends_of_their_range(spark):
    ends = [-(2**63), 2**63 - 1, None]
    docs = frame(spark, ["same text"] * 3 + ["other"] * 2, [*ends, 2**63 - 1, None])
    got = {(r.id, r.digest): (r.keep_id, r.group_size) for r in exact_dedup.duplicates(docs).collect()}
    assert sorted(set(got.values())) == [(-(2**63), 3), (2**63 - 1, 2)]
    assert sorted(r.doc_id for r in exact_dedup.keep_first(docs).collect()) == [-(2**63), 2**63 - 1]


def test_no_light_group_is_larger_than_the_bound(spark):
    """1,000 equally frequent digests: the sketch holds them all."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id % 1000) AS text")
    keyed = exact_dedup.digests(docs)
    light = keyed.join(exact_dedup.heavy_winners(keyed), "digest", "left_anti").groupBy("digest").count()
    assert max((r["count"] for r in light.collect()), default=0) <= 4 * 20_000 / exact_dedup.TRACKED


@pytest.mark.parametrize("heavy, tracked", [(256, 4096), (2, 16), (1, 1)])
def test_groups_equal_brute_force_whatever_is_heavy(spark, heavy, tracked):
    texts = ["hot text"] * 40 + ["hot  text ", "hottext", None, "", " \t\n", " ", "é", "é ", "Hot text", "x" * 100_000, "x" * 99_999 + " x", "a b", "ab", "ab"]
    rows = list(enumerate(texts)) + [(None, "nul"), (None, "nul"), (5, "nul "), (77, "twice"), (77, "twice")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows]).withColumns({"digest": F.lit("d"), "rid": F.lit("r")}).repartition(4)
    got = exact_dedup.duplicates(docs, heavy=heavy, tracked=tracked).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.digest) for r in got), key=repr) == brute_groups(rows)
    kept = [r for r in got if r.kept]
    assert len({r.digest for r in kept}) == len(kept) and all(r.id == r.keep_id for r in kept)
    left = exact_dedup.keep_first(docs, heavy=heavy, tracked=tracked)
    assert left.columns == docs.columns and sorted(r.id or -1 for r in kept) == sorted(r.doc_id or -1 for r in left.collect())


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.duplicates(frame(spark, []).limit(0)).count() == 0
    assert exact_dedup.keep_first(frame(spark, []).limit(0)).count() == 0


def test_heavy_path_has_no_python(spark):
    plan = exact_dedup.duplicates(frame(spark, ["a", "a", "b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- near deduplication ---------------------------------------------------------------------------------------------


def shingles(text):
    w = WORD.findall(lower(text))
    bag = {}
    for s in [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []:
        bag[s] = bag.get(s, 0) + 1
    return bag


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / max(1, sum(max(a.get(k, 0), b.get(k, 0)) for k in keys))


def test_similarity_is_exact():
    words = prose(4, 60, 6)
    texts = [" ".join(words), " ".join(words[:50] + ["new"] + words[50:]), " ".join(words * 2), "w1é w2é", "", " ".join(words[:4])]
    pairs = [(a, b) for a in texts for b in texts]
    got = near_dedup.similarity([a.encode() for a, _ in pairs], [b.encode() for _, b in pairs])
    assert got == pytest.approx([jaccard(shingles(a), shingles(b)) for a, b in pairs])


def test_signatures_agree_as_often_as_texts_are_similar():
    """Weighted sets of known similarity: agreeing coordinates follow it, for short and long sets and repeated elements."""
    rng = np.random.default_rng(1)
    for size, shared, copies in ((20, 15, 1), (3000, 2400, 1), (50, 30, 4)):
        common_part = rng.integers(1, 2**62, shared).astype(np.uint64)
        sets = [np.repeat(np.concatenate([common_part, rng.integers(1, 2**62, size - shared).astype(np.uint64)]), copies) for _ in range(2)]
        owner = np.repeat([0, 1], [len(s) for s in sets])
        names = near_dedup.signatures(np.concatenate(sets), owner, 2, 2048)
        assert (names != 0).all()
        want = shared / (2 * size - shared)
        assert abs((names[0] == names[1]).mean() - want) < 4 * (want * (1 - want) / 2048) ** 0.5
        again = near_dedup.signatures(sets[1], np.zeros(len(sets[1]), dtype=int), 1, 2048)
        assert (again[0] == names[1]).all()


def near_fixture():
    """Copies, near copies, a chain whose ends are apart, texts that share half of their words, and texts without words."""
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append((n, " ".join(words) if words is not None else None))
        n += 1

    for k in range(6):
        base = prose(100 + k, 120)
        add(base)
        for j in range(5):
            changed = list(base)
            changed[10 + 20 * j] = f"new{j}"
            add(changed)
        add(base)
    chain = prose(50, 200)
    for j in range(8):
        add(chain[j * 10 : j * 10 + 120])
    passage = prose(60, 50)
    for j in range(30):
        add(passage + prose(1000 + j, 50))
    for w in ([], None, ["one"], ["one"], ["One", "two"], ["one", "two"]):
        add(w)
    rows.append((n, "!?"))
    rows.append((n + 1, " ".join(prose(70, 30_000, 5000))))
    rows.append((n + 2, " ".join(prose(70, 30_000, 5000)[:-3])))
    return rows


def brute_classes(rows, threshold=0.8):
    bags = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and len(bags[i]) < 10_000 > len(bags[j]) and jaccard(bags[i], bags[j]) >= threshold:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    big = [i for i, b in enumerate(bags) if len(b) >= 10_000]
    for i in big[1:]:
        if jaccard(bags[i], bags[big[0]]) >= threshold:
            parent[root(i)] = root(big[0])
    return {i: root(i) for i in range(len(rows))}


def test_classes_equal_brute_force(spark):
    rows = near_fixture()
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows]).withColumns({"node": F.lit(1), "class": F.lit("c"), "row": F.lit(2)}).repartition(5)
    got = {r["row"]["doc_id"]: (r["class_id"], r["kept"], r["class_size"]) for r in near_dedup.classes(docs).collect()}
    want = brute_classes(rows)
    assert {i: c for i, (c, _, _) in got.items()} == want
    assert {i for i, (_, kept, _) in got.items() if kept} == {i for i, c in want.items() if i == c}
    sizes = {}
    for c in want.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert all(n == sizes[c] for c, _, n in got.values())
    left = near_dedup.keep_one(docs)
    assert left.columns == docs.columns and left.count() == len(set(want.values()))


def test_near_dedup_of_repeated_rows_null_ids_and_nothing(spark):
    base = " ".join(prose(5, 100))
    docs = frame(spark, [base, base, base + " more", None, None, "", base], [4, 4, None, 8, None, 9, None])
    got = near_dedup.classes(docs).collect()
    assert [r["class_id"] for r in got if r["row"]["text"] and r["row"]["text"].startswith(base)] == [4] * 5 or all(
        r["class_id"] == 4 for r in got if (r["row"]["text"] or "").startswith(base)
    )
    assert sum(r["kept"] for r in got) == 4
    assert near_dedup.classes(frame(spark, []).limit(0)).count() == 0
    assert near_dedup.classes(frame(spark, [None, "", "."])).where("kept").count() == 3


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_the_prefix_join_loses_no_link(spark, threshold):
    """Every pair of different classes at the threshold is proposed, with repeated shingles, shared passages and short texts."""
    r = random.Random(6)
    passage = prose(8, 40, 30)
    texts = [" ".join(passage + prose(2000 + j, r.randrange(1, 30), 8)) for j in range(60)]
    base = prose(9, 80, 40)
    for j in range(40):
        changed = list(base)
        for _ in range(r.randrange(4)):
            changed[r.randrange(80)] = f"x{r.randrange(3)}"
        texts.append(" ".join(changed))
    texts += ["one two", "one two three", "a b c d e", "a b c d e f"]
    members = spark.createDataFrame([(i, i if i % 7 else 0) for i in range(len(texts))], "node BIGINT, class BIGINT")
    rows = spark.createDataFrame(list(enumerate(texts)), "node BIGINT, text STRING").repartition(3)
    got = {(x.a, x.b) for x in near_dedup._prefix_pairs(members, rows, threshold).collect()}
    bags = [shingles(t) for t in texts]
    kind = [i if i % 7 else 0 for i in range(len(texts))]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if kind[i] != kind[j] and jaccard(bags[i], bags[j]) >= threshold}
    assert want <= got and len(want) > 50
    if threshold == 0.8:
        assert len(got) < 3 * len(want)  # the shared passage alone proposes few


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, 200 + k) for k in range(1, 30)] + [(300, 301), (301, 302), (302, 300)] + [(k, k + 500) for k in range(400, 403)]
    random.Random(1).shuffle(links)
    got = {r["node"]: r["class"] for r in near_dedup.components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert {n: c for n, c in got.items() if n <= 60} == {n: 0 for n in range(61)}
    assert all(got[200 + k] == 200 for k in range(30)) and got[302] == 300 and got[902] == 402
