"""Sharding by bytes, the registered queries against their SQL, and the pipeline against brute force."""

import os
import random
import zlib

import pytest
from compare import DATA, connect
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import queries, sharding

DOCS = "doc_id BIGINT, text STRING"


def shards_of(docs, **options):
    rows = sharding.sharded(docs, **options).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    return rows, by


def check(rows, by, texts_by_id, shards):
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    assert all(0 <= s < shards for s in by)
    for members in by.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    loads = [sum(r["size"] for r in by.get(s, [])) for s in range(shards)]
    assert all(abs(x - total / shards) <= largest for x in loads)
    assert sorted((str(r["id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts_by_id
    )


@pytest.mark.parametrize("ranges, samples", [(1024, 16), (16, 2), (1, 1)])
def test_shards_are_even_whatever_the_splitters(spark, ranges, samples):
    r = random.Random(3)
    texts = ["hot copy " * 20] * 400 + ["é" * r.randrange(300) for _ in range(600)] + [None, "", "", "x" * 20_000]
    pairs = list(enumerate(texts)) + [(None, "n"), (None, "n"), (7, "seven"), (7, "seven")]
    docs = spark.createDataFrame(pairs, DOCS).withColumns({"size": F.lit(1), "hash": F.lit("h"), "range": F.lit(0)}).repartition(5)
    rows, by = shards_of(docs, ranges=ranges, samples=samples)
    check(rows, by, pairs, 24)
    again, _ = shards_of(docs, ranges=ranges, samples=samples)
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_equal_texts_are_neighbours(spark):
    pairs = list(enumerate([f"text {i % 50}" for i in range(1000)]))
    rows, _ = shards_of(spark.createDataFrame(pairs, DOCS))
    place = {(r["shard"], r["slot"]): r["text_crc32"] for r in rows}
    run = [place[k] for k in sorted(place)]
    assert sum(a != b for a, b in zip(run, run[1:])) == 49


def test_one_text_alone_and_identical_rows(spark):
    """All rows equal in id and text: no key can split them, the subdivision by row does."""
    rows, by = shards_of(spark.createDataFrame([(1, "same")] * 2400, DOCS).repartition(6))
    assert {s: len(m) for s, m in by.items()} == {s: 100 for s in range(24)}
    rows, by = shards_of(spark.createDataFrame([(1, "only")], DOCS))
    assert len(rows) == 1
    assert sharding.sharded(spark.createDataFrame([], DOCS)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = sharding.sharded(spark.createDataFrame([(1, "a"), (2, "b")], DOCS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- registered queries ---------------------------------------------------------------------------------------------

SF = f"{DATA}/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(r[i]).lower() for i in order) for r in rows)


@needs_data
@pytest.mark.parametrize("name", queries.SQL)
def test_query_matches_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cur = connect(SF).execute(queries.SQL[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


CONTRACT = {
    "op1_decontaminate": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op3_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op4_hmm_score": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op6_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op7_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op8_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op9_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
}


@needs_data
@pytest.mark.parametrize("name", CONTRACT)
def test_contract_columns(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert ", ".join(f"{c} {k}" for c, k in df.dtypes) == CONTRACT[name]
    n = spark.read.parquet(f"{SF}/{'pages' if name == 'op3_warc' else 'documents'}.parquet").count()
    assert df.count() == n


@needs_data
def test_held_out_accuracy_and_likelihood(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in queries.op7_language(spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    scored = [r for r in queries.op4_hmm_score(spark, SF).collect() if r.held_out]
    assert sum(r.score for r in scored) > sum(r.base_score for r in scored)


# --- pipeline -------------------------------------------------------------------------------------------------------


def pipeline_fixture(tmp_path, spark):
    from test_joins import prose
    from test_models import speech

    r = random.Random(8)
    texts = [speech(lang, k, 60) for k, lang in enumerate(["aa", "bb", "cc"] * 12)]
    item = " ".join(prose(77, 14, 60)).replace("é", "a")
    rows = [(i, t, ["aa", "bb", "cc"][i % 3], f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    add = lambda t, lang="aa": rows.append((len(rows), t, lang, "s", 0 if t is None else len(t)))
    add(texts[0] + " \n")  # an exact copy, longer: it stays
    add(texts[1])
    near = texts[2].split()
    near[30] = "xx"
    add(" ".join(near), "cc")
    add(texts[3] + " " + item)
    add(None), add(""), add("12 34 !"), add(None)
    r.shuffle(rows)
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    # 36 texts: 0 goes for its longer copy, 36; 37 copies 1; 38 is near 2; 39 holds the item, the last four have no letter.
    return set(range(1, 37))


def test_pipeline_equals_brute_force(spark, tmp_path):
    want = pipeline_fixture(tmp_path, spark)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want)
    assert all(r.round_trip and r.n_tokens == len(r.ids) > 0 for r in got)


def test_stages_keep_the_columns_and_survive_nothing(spark, tmp_path):
    pipeline_fixture(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0
