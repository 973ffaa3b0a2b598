"""Merkle manifest, periodic runs and exact search against brute force, and their queries against SQL."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from citypulse.llm import common, exact_search, merkle, periodic_runs, queries
from conftest import SF_SMALL


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ------------------------------------------------------------------ op 11

def tree(leaves):
    """(root, the siblings' digests by level of each leaf)."""
    paths, level, where = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, w in enumerate(where):
            run = range(w // 3 * 3, min(w // 3 * 3 + 3, len(level)))
            paths[i].append(([level[j] for j in run if j < w], [level[j] for j in run if j > w]))
        level = [H(*level[i:i + 3]) for i in range(0, len(level), 3)]
        where = [w // 3 for w in where]
    return level[0] if level else None, paths


def leaf_of(doc, text):
    f = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*map(f, (doc["doc_id"], doc["source"], doc["lang"], doc["n_chars"], text)))


def manifest_of(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d["source"], []).append((d, leaf_of(d, d["text"])))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    trees = {s: tree([leaf for _, leaf in groups[s]]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    for s, top in zip(names, tops):
        for (d, leaf), path in zip(groups[s], trees[s][1]):
            tampered = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0
            node = leaf_of(d, d["text"].replace("\n", "") if tampered and d["text"] is not None else d["text"])
            siblings = []
            for before, after in path + top:
                siblings += before + after
                node = H(*before, node, *after)
            yield (d["doc_id"], leaf, trees[s][0], root, H(*siblings), node, node == root)


def folder(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("sizes", [(), (1,), (3,), (4, 1, 1, 10), (800, 2, 9, 1, 28)])
def test_merkle_equals_brute_force(spark, tmp_path, sizes):
    rnd = random.Random(len(sizes))
    rows = []
    for g, many in enumerate(sizes):
        source = [None, "", "a", "B", "é"][g]
        rows += [(rnd.choice([None, *range(3 * many)]), rnd.choice(["x\ny", "", None, "\n", "Éß漢 " * 50]),
                  rnd.choice([None, "en"]), source, rnd.choice([None, 7]), "clash") for _ in range(many)]
    rows += rows[:2]  # repeated rows are leaves of their own
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, leaf string").repartition(3)
    got = queries.op11_merkle(spark, folder(spark, tmp_path, documents=docs)).collect()
    want = list(manifest_of([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_merkle_spreads_a_group_over_ranges(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("source"), F.lit(5).alias("same"), F.lit("h").alias("g"))
    placed = merkle.placed(rows.select("g", "same"), ["same"]).collect()
    assert sorted(r["pos"] for r in placed) == list(range(20_000)) and {r["n"] for r in placed} == {20_000}


def test_merkle_level_takes_no_further_shuffle(spark):
    text = F.col("id").cast("string")
    nodes = spark.range(5000).select(F.substring(text, 1, 1).alias("g"), F.col("id").alias("pos"), (F.col("id") * 2).alias("n"), text.alias("h"))
    plan = merkle.climbed(nodes, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1 and plan.count("Window [") == merkle.LEVELS


# ------------------------------------------------------------------ op 12

def runs_of(w, least=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                out.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def words_of(text):
    return [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]


def made_of(rnd):
    t = [rnd.randrange(rnd.choice([1, 2, 3, 30])) for _ in range(rnd.choice([0, 1, 12, 60, 300]))]
    kind = rnd.randrange(4)
    if kind == 0 and t:
        t += t[:rnd.randrange(1, len(t) + 1)] * rnd.randrange(1, 5)
    if kind == 1:
        a, t = [0], [0, 1]
        for _ in range(9):
            a, t = t, t + a
    if kind == 2:
        t = [bin(i).count("1") % 2 for i in range(200)]
    return t


@pytest.mark.parametrize("least", [2, 5, 12, 20])
def test_runs_equal_brute_force(least):
    rnd = random.Random(least)
    for _ in range(30):
        texts = [made_of(rnd) for _ in range(rnd.randrange(1, 6))]
        word = common.mixed(np.array([x + 1 for t in texts for x in t], np.uint64))
        edges = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        got = [[] for _ in texts]
        for t, *run in zip(*(x.tolist() for x in periodic_runs.runs(word, edges, least))):
            got[t].append(tuple(run))
        assert got == [runs_of(t, least) for t in texts]


def test_grammar_derives_its_text():
    rnd = random.Random(4)
    for _ in range(20):
        texts = [made_of(rnd) for _ in range(3)]
        flat = [(i, x) for i, t in enumerate(texts) for x in t]
        if len(flat) < 2:
            continue
        names = sorted(set(flat))
        ids = np.array([names.index(x) for x in flat])
        doc = np.array([i for i, _ in flat])
        count = np.bincount(ids)
        rule, place, cut, size, tops = periodic_runs.repair(ids, count, doc)
        assert (np.diff(tops) > 0).all() and tops[0] == 0
        for r in np.unique(rule):  # all places of a rule have the same words, in one text
            stretch = {tuple(ids[p:p + size[r]].tolist()) for p in place[rule == r]}
            assert len(stretch) == 1 and 0 < cut[r] < size[r]
            assert all(doc[p] == doc[p + size[r] - 1] for p in place[rule == r])
        left = ids[tops]  # Re-Pair ends when no pair is left twice
        ends = np.append(tops[1:], len(ids))
        symbols = [tuple(ids[a:b].tolist()) for a, b in zip(tops, ends)]
        pairs = [(doc[a], x, y) for a, b, x, y in zip(tops, tops[1:], symbols, symbols[1:]) if doc[a] == doc[b]]
        same = [p for p in set(pairs) if pairs.count(p) > 1 and p[1] != p[2]]
        assert len(left) == len(tops) and not same


def test_with_runs_on_odd_texts(spark, docs):
    found = periodic_runs.with_runs(docs.withColumn("periodic", F.lit(1)), least=4)
    assert found.columns == [*docs.columns, "periodic", "_periodic"]
    seen = found.collect()
    assert len(seen) == docs.count()
    for r in seen:
        words = words_of(r["text"])
        got = [(x["start"], x["length"], x["period"]) for x in r["_periodic"]["runs"]]
        assert got == runs_of(words, 4) and r["_periodic"]["n_words"] == len(words)
        gone = {i for s, n, q in got for i in range(s + q, s + n)}
        assert r["_periodic"]["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic_runs.with_runs(docs.limit(0)).collect() == []


def test_long_text_in_small_slices(spark):
    text = "a b c d e f g " * 3000 + "\n" + " ".join(str(i) for i in range(5000))
    rows = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")
    for r in periodic_runs.with_runs(rows, slice_bytes=100).collect():
        assert [tuple(x) for x in r["periodic"]["runs"]] == ([] if r["text"] is None else [(0, 21000, 7)])


def test_runs_query_equals_brute_force(spark, docs, tmp_path):
    extra = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 97}" for j in range(i))) for i in range(200, 320)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(extra)
    got = {repr(tuple(r)) for r in queries.op12_periodic_runs(spark, folder(spark, tmp_path, documents=both)).collect()}
    want = set()
    for doc_id, text in both.collect():
        w = words_of(text)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        found = runs_of(w)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        want.add(repr((doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
                       H(*(f"{s},{n},{q}\n" for s, n, q in found)), H(" ".join(x for i, x in enumerate(w) if i not in gone)))))
    assert got == want


# ------------------------------------------------------------------ op 13

def ranked(rows, k, scale=256):
    ok = [(i, [math.floor(scale * x) if abs(x) < 1e15 else math.floor(x) * scale for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i in sorted({i for i, _ in ok if i % 50 == 0}):
        q = min((v for j, v in ok if j == i))
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
        yield from ((i, r, j, max(-2 ** 63, min(2 ** 63 - 1, -s))) for r, (s, j) in enumerate(best, 1))


def found_rows(spark, rows, k=5, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)
    return sorted(tuple(r) for r in exact_search.top_k(df, F.col("vec_id") % 50 == 0, k=k, **more).collect())


@pytest.mark.parametrize("spread", [0.2, 30.0, 1e4, 1e9])
def test_search_equals_brute_force(spark, spread):
    rnd = random.Random(int(spread))
    vectors = [[rnd.gauss(0, spread) for _ in range(20)] for _ in range(500)]
    vectors[100:160] = [vectors[100]] * 60  # ties, also with queries
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(-50, [0.0] * 20, 0), (-1, [-0.0] * 20, 0)]
    assert found_rows(spark, rows, group_bytes=1500) == sorted(ranked([r[:2] for r in rows], 5))


def test_search_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 0), (50, [], 0), (100, None, 0), (150, [nan, 1.0], 0), (200, [1.0, None], 0), (250, [inf], 0),
            (None, [1.0, 1.0], 0), (1, [3.0, -1.0, 9.0], 0), (2, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [0.5], 0)]
    got = found_rows(spark, rows, k=4)
    assert got == sorted(ranked([r[:2] if len(r[1] or []) >= 3 or r[1] is None else (r[0], r[1] + [0.0] * (3 - len(r[1]))) for r in rows], 4))
    assert found_rows(spark, rows[:1]) == [] and found_rows(spark, rows[2:6]) == []
    assert exact_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.lit(True)).collect() == []


def test_search_takes_blocks_as_whole(spark):
    """The same answer however candidates come, and however many pairs survive."""
    rng = np.random.default_rng(3)
    v = np.floor(rng.normal(0, 40, (3000, 64)) + (rng.integers(0, 4, (3000, 1)) == 0) * 60)
    want = None
    for step, rows in ((8, 3000), (1, 64), (64, 700)):
        s = exact_search.Search(np.arange(0, 3000, 50), v[::50], 5, step=step)
        for a in range(0, 3000, 1000):
            s._block(np.arange(a, a + 1000), v[a:a + 1000], 7) if rows == 3000 else s.add(np.arange(a, a + 1000), v[a:a + 1000], rows, 7)
        got = s.rows().to_pydict()
        want = want or got
        assert got == want


@pytest.mark.parametrize("name", ["op11_merkle", "op12_periodic_runs", "op13_exact_search"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    res = con.execute(queries.SQL[name])
    order = [d[0] for d in res.description]
    assert sorted(map(repr, map(tuple, df.select(*order).collect()))) == sorted(map(repr, res.fetchall()))
