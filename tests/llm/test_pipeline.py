"""The pipeline stage by stage against brute force, and its queries against their SQL."""

import math
import os

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from test_dedup import GAP
from test_first_of_each import kept_pairs
from test_search_and_mix import size_of, targets
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(nasty, spark):
    return spark.createDataFrame(nasty.select("doc_id", "text", "lang", "source", "n_chars").collect(), COLUMNS).repartition(4)


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard", "mix_sources", "byte_bpe"]
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(QUERIES)


def test_stages(spark, docs):
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["language_id"](spark, docs, "")
    key = lambda r: (r.doc_id, r.text)
    rows = docs.collect()
    assert kept.columns == docs.columns
    assert Counter(map(key, kept.collect())) == Counter(key(r) for r in rows if any(c.isalpha() for c in r.text or ""))

    unique = stage["exact_dedup"](spark, kept, "")
    assert sorted(GAP.sub("", r.text) for r in unique.collect()) == sorted({GAP.sub("", r.text) for r in kept.collect()})

    single = stage["ngram_jaccard"](spark, unique, "")
    left = [key(r) for r in single.collect()]
    want = kept_pairs([key(r) for r in unique.collect()], 5, 80)
    assert len(left) == len(set(left)) == len(want) and all(len(own & set(left)) == 1 for own in want)

    mixed = stage["mix_sources"](spark, single, "")
    sizes, got = Counter(), Counter()
    for r in single.collect():
        sizes[r.source] += size_of(r.text)
    for r in mixed.collect():
        got[r.source] += size_of(r.text)
    assert mixed.columns == docs.columns
    assert got == Counter({s: math.floor(t + 0.5) for s, t in targets(dict(sizes)).items()})

    tokens = stage["byte_bpe"](spark, mixed, "").collect()
    import hashlib

    assert Counter((r.doc_id, r.decoded_sha256) for r in tokens) == Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())
    assert all(r.n_tokens == len(r.ids) > 0 for r in tokens)


def test_stages_keep_other_columns(spark, nasty, none):
    """Every stage but the last passes on columns whose names clash with those of the operators, and empty tables."""
    documents, empty = nasty, none
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = spark.createDataFrame(stage(spark, documents, "").collect(), nasty.schema)
        assert {(r.row, r["print"], r.kept) for r in made.collect()} <= {(r.row, r["print"], r.kept) for r in nasty.collect()}
        documents = made
        assert stage(spark, empty, "").columns == nasty.columns and stage(spark, empty, "").count() == 0


def test_predicted_language_is_passed_on(spark):
    rows = [(i, text * 9, lang, "s", 9) for i, (text, lang) in enumerate([("the tide came in over the wall ", "en"), ("der hund lief durch den wald und ", "de")] * 30)]
    rows += [(1000, rows[0][1], "de", "s", 9), (1001, rows[1][1], None, "s", 9), (1002, "123", "en", "s", 9)]
    kept = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, COLUMNS), "")
    assert {r.doc_id: r.lang for r in kept.collect()} == {i: "de" if "hund" in t else "en" for i, t, *_ in rows[:-1]}


def test_run(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert made.count() > 20 and "ids" in made.columns


def test_empty(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    made = QUERIES[name](spark, SF).select(*names)
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(want.fetchall(), key=repr)

