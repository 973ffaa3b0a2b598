"""The pipeline's stages on the smallest tables, and its registration."""

import re

import corpus_pipeline
from citypulse.llm import queries
from citypulse.llm.common import table, written
from citypulse.llm.decontaminate import split_words

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n.split()[0] for n, _ in corpus_pipeline.STAGES] == ["quality", "n-gram", "suffix-array", "benchmark", "packing"]
    docs = first = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, SF), "stage-test")
        assert after.dtypes == first.dtypes and 0 < after.count() <= docs.count()
        docs = after
    windows = {tuple(w[i:i + 10]) for r in table(spark, SF, "benchmark").collect() for w in [split_words(r["text"])] for i in range(len(w) - 9)}
    strings = {}
    for r in docs.collect():
        w = split_words(r["text"])
        assert not any(tuple(w[i:i + 10]) in windows for i in range(len(w) - 9))
        assert r["n_chars"] == len(r["text"])
        strings[r["doc_id"]] = r["text"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p["doc_id"] for p in packed} == set(strings)
    assert sum(p["length"] for p in packed) == sum({p["doc_id"]: p["doc_tokens"] for p in packed}.values())


def test_stages_on_odd_rows(spark, tmp_path):
    rows = [(1, "one two three " * 30, "en", "a", 3, "x"), (1, "one two three " * 30, "en", "a", 3, "x"), (2, None, None, None, None, None),
            (3, "", "en", "a", 0, "y"), (None, "free text " * 20, "en", "a", 1, "z"), (None, None, None, None, None, None),
            (4, "some words here", "de", "b", 9, "w"), (5, " \n", "en", "a", 2, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `match` string")
    docs = docs.selectExpr("*", "1 AS dedup", "'k' AS kept", "2 AS component_id")
    spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", "something else entirely"), (None, None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = sorted(repr((r["doc_id"], r["text"])) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        got, none = stage(spark, docs, str(tmp_path)), stage(spark, docs.limit(0), str(tmp_path))
        assert none.collect() == [] and none.columns == got.columns
        if name == "packing":
            assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(r[0]) for r in rows)
        else:
            assert got.dtypes == docs.dtypes
            assert sorted(repr((r["doc_id"], r["text"])) for r in got.collect()) == want


def test_near_copies_from_four_fifths_go(spark):
    def changed(words, times):  # each change costs five of the 996 shingles on both sides
        return [f"other{i}" if i % 10 == 5 and i < 10 * times else w for i, w in enumerate(words)]

    texts = {}
    for at, times in enumerate((0, 21, 23)):
        words = [f"w{at}x{i}" for i in range(1000)]
        texts[2 * at] = words
        texts[2 * at + 1] = changed(words, times) if times else words + [f"more{i}" for i in range(200)]
    shared = []
    for at in (0, 2, 4):
        a, b = ({tuple(texts[i][k:k + 5]) for k in range(len(texts[i]) - 4)} for i in (at, at + 1))
        shared.append(len(a & b) / len(a | b))
    assert 0.8 <= shared[1] < shared[0] < 0.85 and 0.79 < shared[2] < 0.8
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 4, 5]


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)
