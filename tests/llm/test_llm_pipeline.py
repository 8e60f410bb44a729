"""The registered queries against their SQL, and the pipeline against its parts done by brute force."""

import os

import duckdb
import pytest
from llm_helpers import changed, documents, found, prose
from test_llm_dedup import brute_classes
from test_llm_text import brute_leaks

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare_oracle import TABLES, normalized
from duelmetrics.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_every_operator_has_its_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert "pipeline" not in oracle_sql() and len(corpus_pipeline.STAGES) == 5


@needs_tables
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = normalized(df.columns, [tuple(r) for r in df.collect()])
    assert got == normalized(columns, cursor.fetchall())


@needs_tables
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_returns_its_table(spark, name):
    df = QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns) and df.count() > 0


def test_pipeline_equals_brute_force(spark, tmp_path):
    letters = {"en": "", "xx": "жш"}
    speak = lambda lang, seed, n: " ".join(w + letters[lang] for w in prose(seed, n).split())
    rows = [(k, speak("xx" if k % 4 == 0 else "en", k, 40), "xx" if k % 4 == 0 else "en", f"s{k % 3}") for k in range(120)]
    rows += [(200 + k, rows[k][1], rows[k][2], "s1") for k in range(20)]  # exact copies
    rows += [(300 + k, changed(rows[30 + k][1], [0]), rows[30 + k][2], "s2") for k in range(20)]  # near copies
    items = [(k, prose(7000 + k, 30)) for k in range(8)]
    rows += [(400 + k, f"{prose(k + 50, 20)} {t}", "en", "s0") for k, t in items]  # leaks
    rows += [(500, None, "en", "s0"), (501, "?? 12", "en", None)]
    df = documents(spark, rows)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    texts = {r[0]: r[1] for r in rows if r[1] and any(map(str.isalpha, r[1]))}
    last = {}
    for doc_id, text in texts.items():
        last[text] = max(doc_id, last.get(text, doc_id))
    texts = {i: t for i, t in texts.items() if last[t] == i}
    classes = brute_classes(list(texts.items()))
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    leaked = {d for d, _ in brute_leaks(list(texts.items()), items)}
    texts = {i: t for i, t in texts.items() if i not in leaked}

    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == "mixing" or out.columns == df.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r["doc_id"] for r in found(docs)})
    assert kept[3] == set(texts) and len(texts) < len(rows) - 40
    assert kept[4] <= kept[3]
    mix = found(corpus_pipeline.run(spark, str(tmp_path)))
    assert {r["doc_id"] for r in mix} == kept[4]
    total = sum(len(t.split()) for t in texts.values())
    assert abs(sum(r["taken"] for r in mix) - 1.5 * total) <= 3


def test_pipeline_of_an_empty_table(spark, tmp_path):
    documents(spark, [(1, "a")]).filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(1, 9))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert found(corpus_pipeline.run(spark, str(tmp_path))) == []
