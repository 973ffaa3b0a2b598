"""Each operator against brute force on a small fixture with odd rows."""

import base64
import gzip
import hashlib
import itertools
import math
import os
import random
import re
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from citypulse.llm import (chat, context_tree, cotraining, decontaminate, ngram_join, packing, queries, rules, suffix_dedup,
                           token_files, tokens, warc)
from citypulse.session import scratch_path
from conftest import SF_SMALL

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


# ------------------------------------------------------------ 1
def brute_hits(text, items, n=10):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    hit, names = set(), set()
    for name, item in items:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").translate(LOW))
        size = min(n, len(ws))
        wins = {tuple(ws[k:k + size]) for k in range(len(ws) - size + 1)} if ws else set()
        for k in range(len(w) - size + 1):
            if ws and tuple(w[k:k + size]) in wins:
                hit |= set(range(k, k + size))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [8 << 20, 50])
def test_decontaminate(spark, docs, texts, block_bytes):
    items = [(1, texts[42]), (22, "of the"), (3, ""), (4, None), (5, texts[-1]), (6, texts[-1].lower() + " more"), (7, "x" * 3000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matched(docs, bench, cleaned=True, block_bytes=block_bytes)
    name = got.columns[-1]
    assert name != "match" and got.columns[:-1] == docs.columns
    for r in got.collect():
        m = r[name]
        assert (m["n_words"], m["n_hit"], m["items"]) == brute_hits(r["text"], items)
        if r["text"] is not None:
            assert brute_hits(m["clean_text"], items)[1] == 0
    clean = decontaminate.decontaminated(docs, bench)
    assert clean.schema == docs.schema
    empty = decontaminate.matched(docs, bench.limit(0))
    assert empty.where(f"{name}.n_hit > 0").count() == 0
    assert decontaminate.matched(docs.limit(0), bench).count() == 0


def test_clean_text_is_the_same_for_any_blocks(spark):
    """Cuts let words meet: windows of earlier and later blocks appear and are cut too."""
    rnd = np.random.default_rng(8)
    some = lambda n: " ".join("abcd"[i] for i in rnd.integers(0, 4, n))
    docs = spark.createDataFrame([(i, some(60)) for i in range(40)] + [(None, None), (41, "")], "doc_id long, text string")
    items = [(i, some(int(n))) for i, n in enumerate(rnd.integers(3, 9, 12))]
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    out = []
    for block_bytes in (1 << 20, 40, 1):
        got = decontaminate.matched(docs, bench, window=5, cleaned=True, block_bytes=block_bytes)
        out.append(sorted(((r["doc_id"], r["match"]["n_hit"], tuple(r["match"]["items"]), r["match"]["clean_text"]) for r in got.collect()), key=str))
    assert out[0] == out[1] == out[2]
    assert sum(r[3] not in (None, "") for r in out[0]) > 3 and sum(r[1] > 0 for r in out[0]) > 20


def test_automaton_of_a_large_block_is_compact():
    rnd = np.random.default_rng(4)
    words = [f"w{i}".encode() for i in range(20_000)]
    items = [(str(i), [words[j] for j in (20_000 * rnd.random(200) ** 3).astype(int)]) for i in range(500)]
    tracemalloc.start()
    automaton = decontaminate.Automaton(items, 10)
    held, states = tracemalloc.get_traced_memory()[0], len(automaton.link)
    tracemalloc.stop()
    assert held < 80 * states
    assert automaton.match(items[7][1])[1] == {"7"}


def test_automaton_random():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        items = [(str(i), [bytes([97 + x]) for x in rnd.integers(0, 3, rnd.integers(1, 9))]) for i in range(4)]
        text = [bytes([97 + x]) for x in rnd.integers(0, 4, 40)]
        hit, names, _ = decontaminate.Automaton(items, 4).match(text)
        want, found = set(), set()
        for name, ws in items:
            size = min(4, len(ws))
            for j, k in itertools.product(range(len(ws) - size + 1), range(len(text) - size + 1)):
                if ws[j:j + size] == text[k:k + size]:
                    want |= set(range(k, k + size))
                    found.add(name)
        assert (set() if hit is None else set(np.flatnonzero(hit).tolist())) == want and names == found


# ------------------------------------------------------------ 2
def brute_removed(rows, size=50):
    key = lambda i: math.inf if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - size + 1):
            s = b[k:k + size]
            first[s] = min(first.get(s, math.inf), key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - size + 1):
            if first[b[k:k + size]] < key(i):
                gone[k:k + size] = [True] * size
        out.append((i, len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)),
                    bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes, part_bytes, most", [(8 << 20, 4 << 20, 50_000), (4000, 2000, 50_000), (4000, 1000, 2), (8 << 20, 4 << 20, 1)])
def test_suffix_dedup(docs, block_bytes, part_bytes, most):
    got = suffix_dedup.deduplicated(docs, block_bytes=block_bytes, part_bytes=part_bytes, most_segments=most)
    rows = sorted(((r["doc_id"], *(r["dedup"][c] for c in ("n_bytes", "n_removed", "n_spans")), bytes(r["dedup"]["kept"]))
                   for r in got.collect()), key=str)
    assert rows == brute_removed(pairs(docs))
    assert sum(r[2] for r in rows) > 500
    assert suffix_dedup.deduplicated(docs.limit(0)).count() == 0
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns and left.count() < docs.count()


def test_passage_with_other_text_next_to_it_everywhere(spark, monkeypatch):
    """A third of the documents share a passage between words of their own."""
    rnd = np.random.default_rng(2)
    own = lambda: " ".join("".join(rnd.choice(list("abcdefgh"), 9)) for _ in range(6))
    passage = "licensed to all who read this line, and to those who do not, for good. é漢"
    rows = [(i, own() + (f" {passage} " if i % 3 == 0 else " ") + own()) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for most in (1_000_000, 10):
        found = suffix_dedup.deduplicated(docs, block_bytes=3000, part_bytes=1500, most_segments=most).collect()
        got[most] = sorted((r["doc_id"], r["dedup"]["n_bytes"], r["dedup"]["n_removed"], r["dedup"]["n_spans"], bytes(r["dedup"]["kept"])) for r in found)
        assert sum(r[2] > 0 for r in got[most]) == 49
    assert got[10] == got[1_000_000] == sorted(brute_removed(rows))


def test_cut_characters_go_whole_and_others_stay(spark):
    passage = "漢字" * 20                          # 120 bytes
    rows = [(1, "a" + passage), (2, "keep \ufffd this " + passage + " é"), (3, "b" + passage[:-1] + "語"), (4, passage + "\ufffd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(docs).collect()}
    assert left[1] == rows[0][1] and left[2] == "keep \ufffd this  é" and left[4] == "\ufffd"
    assert left[3] in ("b語", "b")                 # 語 shares its first bytes with 字 or not: never half a character


def test_interval_expansion_random():
    rnd = np.random.default_rng(1)
    for size in (2, 3, 7, 12):
        segs = ["".join(rnd.choice(list("ab"), rnd.integers(size, 40))) for _ in range(12)]
        doc = np.arange(12)
        got = suffix_dedup.least_documents(np.array([len(s) for s in segs]), np.frombuffer("".join(segs).encode(), np.uint8), doc, size)
        least = {}
        for d, s in enumerate(segs):
            for k in range(len(s) - size + 1):
                least.setdefault(s[k:k + size], d)
        assert got.tolist() == [least[s[k:k + size]] for s in segs for k in range(len(s) - size + 1)]


# ------------------------------------------------------------ 3
@pytest.mark.parametrize("least,segment,chunk", [(0, 1 << 16, 1 << 16), (40, 64, 100)])
def test_warc_round_trip(spark, texts, least, segment, chunk):
    odd = ["WARC/1.1\r\nContent-Length: 5\r\n\r\nhallo\r\n\r\n", "a\n\nb\r\n\r\n", "\n", "é" * 500]
    rows = [(i, f"http://x/{i}\n", t) for i, t in enumerate(texts + odd)] + [(None, None, texts[0]), (2, "again", texts[2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write(pages, path, least_bytes=least, segment_bytes=segment)
    chunks = warc.read(spark, path, chunk_bytes=chunk)
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    want = []
    for i, _, t in rows:
        b = (t or "").encode()
        again = i is not None and len(b) >= least and first[t or ""] < i
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response",
                     first[t or ""] if again else None))
    got = warc.records(chunks).collect()
    assert sorted((tuple(r[c] for c in ("row_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=str) == sorted(want, key=str)
    assert all(r["intact"] is not False for r in got)
    whole = {r["row_id"]: b"".join(bytes(x["data"]) for x in sorted(r["c"], key=lambda x: x["chunk"])) for r in
             chunks.where("record_type = 'response' AND row_id > 2").groupBy("row_id").agg(F.collect_list(F.struct("chunk", "data")).alias("c")).collect()}
    assert all(v == (texts + odd)[k].encode() for k, v in whole.items() if (texts + odd)[k])
    assert chunks.agg(F.max(F.length("data"))).first()[0] <= chunk


def test_cut_and_malformed_archives(spark, tmp_dir):
    """Records that do not end are reported; those around them come back whole."""
    path = scratch_path(spark, "warc-cut")
    pages = spark.createDataFrame([(1, "http://x/1", "one " * 40), (2, "http://x/2", "one " * 40), (3, "http://x/3", "three\n" * 30)],
                                  "page_id long, url string, html string").coalesce(1)
    warc.write(pages, path, segment_bytes=64, date="2025-01-31T12:00:00Z")
    raw = gzip.decompress(b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()))
    heads = [h.split(b"\r\n\r\n")[0] for h in raw.split(b"WARC/1.1\r\n")[1:]]
    assert all(b"WARC-Date: 2025-01-31T12:00:00Z" in h for h in heads)
    assert all((b"Segment-Origin-ID: <urn:row:" in h) == (b"continuation" in h) for h in heads)
    assert [warc.SAME_PAYLOAD.encode() in h for h in heads if b": revisit" in h] == [True]
    whole = {1: True, 2: None, 3: True}

    def intact(name, data):
        os.makedirs(f"{tmp_dir}/{name}")
        with gzip.open(f"{tmp_dir}/{name}/a.gz", "wb") as f:
            f.write(data)
        chunks = warc.read(spark, f"{tmp_dir}/{name}", chunk_bytes=50)
        assert chunks.where("last").count() == warc.records(chunks).count()
        return sorted(((r["row_id"], r["intact"]) for r in warc.records(chunks).collect()), key=str)

    assert intact("whole", raw) == sorted(whole.items())
    last = raw.rindex(b"WARC/1.1")
    order = [int(h.split(b"X-Row-ID: ")[1].split(b"\r\n")[0]) for h in heads]
    others = sorted((k, v) for k, v in whole.items() if k != order[-1])
    for at in (len(raw) - 8, last + 400, last, raw.rindex(b"Content-Length")):  # in bytes, between segments, in a head
        got = dict(intact(f"at{at}", raw[:at]))
        if order.count(order[-1]) > 1:
            assert got[order[-1]] is False and sorted((k, v) for k, v in got.items() if k != order[-1]) == others
    bad = raw.replace(b"Content-Length: 64", b"Content-Length: many", 1)
    got = intact("bad", bad)
    assert (order[[b"Length: 64" in h for h in heads].index(True)], False) in got and len(got) >= 3


# ------------------------------------------------------------ 4
def test_ngram_join(docs):
    rows = [(i, t) for i, t in pairs(docs) if i is not None]
    sets = {}
    for i, t in rows:
        w = blank_words((t or "").translate(LOW))
        sets[i] = {tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    label = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = ngram_join.joined(docs).collect()
    assert sorted((r["doc"], r["n_shingles"], r["component_id"]) for r in got if r["doc"] is not None) == sorted((i, len(sets[i]), label[i]) for i, _ in rows)
    assert [r["component_id"] for r in got if r["doc"] is None] == [None]
    assert len(links) >= 15
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, *(i for i in sets if label[i] == i)}
    assert ngram_join.joined(docs.limit(0)).count() == 0


def test_size_bands_cover_all_links():
    bands = ngram_join.schemes(85, 3000)
    home = lambda s: next(j for j, b in enumerate(bands) if b[0] <= s <= b[1])
    for a in range(1, 1500):
        for b in (a, a + 1, 100 * a // 85 - 1, 100 * a // 85):
            if b >= a and 100 * a >= 85 * b:
                assert home(b) - home(a) in (0, 1)
                assert 15 * (a + b) // 185 <= bands[home(b)][3] < bands[home(b)][2]


# ------------------------------------------------------------ 5, 10
def test_pieces_encode_like_whole_texts(texts):
    whole = Tokenizer.from_file(tokens.default_vocabulary())
    whole.encode_special_tokens = True
    odd = ["", " ", "  a", "a  b", "x\n y", "x \ny", "it's I'LL", "a  b", "²³ ½", "\na b\n", "foo.\nBar", "a_b __ c", "'s 't"]
    rnd = random.Random(5)
    signs = [*"abZ'  \n\n19.,-!’“ \téàß×÷ŐЖя中。 \u0301\u0085\xa0½²ªº😀\x0b\x1c\r_$", "'s", "'ll", "<|endoftext|>"]
    odd += ["".join(rnd.choices(signs, k=rnd.randint(0, 25))) for _ in range(3000)]
    given = [t for t in texts if t is not None] + odd
    for enc in (tokens.Encoder(tokens.default_vocabulary()), tokens.Encoder(tokens.default_vocabulary(), 20)):
        for at in range(0, len(given), 9):
            got = enc.encode_each(pa.array(given[at:at + 9]))
            assert [g.tolist() for g in got] == [e.ids for e in whole.encode_batch(given[at:at + 9], add_special_tokens=False)]


def test_token_files_and_index(spark, docs):
    whole = Tokenizer.from_file(tokens.default_vocabulary())
    whole.encode_special_tokens = True
    path = scratch_path(spark, "shards-test")
    token_files.write_shards(docs, path, shard_bytes=5000)
    records = token_files.read_shards(spark, path).cache()
    rows = token_files.with_global_start(records, records).orderBy("start").collect()
    assert len({r["shard"] for r in rows}) > 2
    ids = [(r["key"], np.frombuffer(r["token_ids"], "<u4").tolist()) for r in rows]
    assert [k for k, _ in ids] == sorted((k for k, _ in ids), key=lambda k: (k is not None, k or 0))
    assert sorted(ids, key=str) == sorted(((i, whole.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in pairs(docs)), key=str)
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()
    index = token_files.build_index(records, part_keys=20)
    found = token_files.with_global_start(token_files.keyed_records(spark, path, index, docs, "doc_id"), records).collect()
    columns = lambda rows: sorted(((r["key"], r["start"], r["n_tokens"], bytes(r["token_ids"])) for r in rows), key=str)
    assert columns(found) == columns(rows)
    some = docs.where("doc_id % 7 = 3")
    assert {r["key"] for r in token_files.keyed_records(spark, path, index, some, "doc_id").collect()} == {
        r["doc_id"] for r in some.collect()}
    absent = spark.range(1000, 1400).withColumnRenamed("id", "key")
    assert token_files.lookup(index, absent).count() == 0
    heads = token_files.read_shards(spark, path, ids=False)
    assert heads.exceptAll(records.drop("token_ids")).count() == records.drop("token_ids").exceptAll(heads).count() == 0


def test_keyed_read_depends_on_the_offsets(spark):
    """Records of one key are read where the index says: the second of two, if it says so;
    a place without the key is an error."""
    path = scratch_path(spark, "shards-offsets")
    two = spark.createDataFrame([(1, "first text"), (1, "another one"), (2, "third")], "doc_id long, text string")
    token_files.write_shards(two, path)
    records = token_files.read_shards(spark, path).cache()
    later = records.groupBy("key").agg(F.max("offset").alias("offset"))
    moved = records.join(later, ["key", "offset"]).withColumn("run_offset", F.col("offset"))
    ask = spark.createDataFrame([(1,)], "key long")
    of = lambda index: token_files.keyed_records(spark, path, index, ask).collect()
    assert len(of(token_files.build_index(records))) == 2
    assert [bytes(r["token_ids"]) for r in of(token_files.build_index(moved))] == [
        bytes(r["token_ids"]) for r in moved.where("key = 1").collect()]
    wrong = records.withColumn("offset", F.col("offset") + 1).withColumn("run_offset", F.col("run_offset") + 1)
    with pytest.raises(Exception, match="no record of key"):
        of(token_files.build_index(wrong))


def test_hot_and_null_keys_fill_several_shards(spark):
    """Null keys and a key of many rows are dealt over shards, and read back whole."""
    rows = [(None, f"null row {i} " + "a b " * 20) for i in range(120)] + [(7, f"hot row {i} " + "a b " * 20) for i in range(120)]
    rows += [(i, f"row {i} " + "a b " * 20) for i in range(60)] + [(5, "x y " * 3000)]
    for given in (rows, rows[:120]):
        docs = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
        path = scratch_path(spark, "shards-hot")
        token_files.write_shards(docs, path, shard_bytes=2000)
        records = token_files.read_shards(spark, path).cache()
        of = {k: {r["shard"] for r in records.collect() if r["key"] == k} for k in (None, 7)}
        assert len(of[None]) > 3 and (len(given) == 120 or len(of[7]) > 2)
        by_place = records.orderBy("shard", "offset").collect()
        assert [r["key"] for r in by_place] == sorted((r["key"] for r in by_place), key=lambda k: (k is not None, k or 0))
        found = token_files.keyed_records(spark, path, token_files.build_index(records), docs, "doc_id")
        pick = ["key", "shard", "local_start", "token_ids"]
        assert found.count() == len(given) and found.select(pick).exceptAll(records.select(pick)).count() == 0


def test_added_tokens_as_in_the_library(spark, texts):
    path = tokens.default_vocabulary()
    whole = Tokenizer.from_file(path)
    sign = "<|endoftext|>"
    rnd = random.Random(6)
    signs = [*"abZ'  \n\n19.-!’\té中\u0301_", "'s", sign, sign, sign[:6], sign[6:]]
    given = ["a" + sign + "b", sign, sign * 3, "it" + sign + "'s", sign[:5], sign[5:], "a \n" + sign + "\n b", *[t for t in texts if t]]
    given += ["".join(rnd.choices(signs, k=rnd.randint(0, 20))) for _ in range(2000)]
    want = [e.ids for e in whole.encode_batch(given, add_special_tokens=False)]
    assert want[0] == [64, 50256, 65]
    for enc in (tokens.Encoder(path, added=True), tokens.Encoder(path, 20, added=True)):
        for at in range(0, len(given), 9):
            assert [g.tolist() for g in enc.encode_each(pa.array(given[at:at + 9]))] == want[at:at + 9]
    enc = tokens.Encoder(path, added=True)
    enc.alone = False  # texts with added tokens whole
    assert [g.tolist() for g in enc.encode_each(pa.array(given))] == want


def test_queries_encode_added_tokens(spark, tmp_dir):
    whole = Tokenizer.from_file(tokens.default_vocabulary())
    given = ["a<|endoftext|>b", "some <|endoftext|> words", "", None]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    ids = [whole.encode(t or "", add_special_tokens=False).ids for t in given]
    crc = lambda own, end: zlib.crc32(np.array([*own, end], "<u4").tobytes())
    for packed in (queries.op10_packing(spark, tmp_dir), corpus_pipeline.sequence_packing(spark, docs, tmp_dir)):
        assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packed.collect()} == {
            i: (len(own) + 1, crc(own, 1)) for i, own in enumerate(ids)}
    filed = {r["doc_id"]: (r["n_tokens"], r["start"]) for r in queries.op5_token_files(spark, tmp_dir).collect()}
    assert filed == {i: (len(own) + 1, sum(len(x) + 1 for x in ids[:i])) for i, own in enumerate(ids)}


def test_perfect_hash_is_minimal():
    for n in (1, 2, 3, 10, 1000):
        h = np.random.default_rng(n).integers(-2**62, 2**62, n)
        assert sorted(token_files.slots_of(h, token_files.perfect_seeds(h), n).tolist()) == list(range(n))


def test_packing(docs):
    whole = Tokenizer.from_file(tokens.default_vocabulary())
    whole.encode_special_tokens = True
    rows = packing.pack(docs, size=256).collect()
    want = Counter((i, tuple(whole.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in pairs(docs))
    windows = {}
    for r in rows:
        assert r["length"] * 4 == len(r["token_ids"])
        windows.setdefault(r["sequence_id"], []).append(r)
    for w in windows.values():
        ends = np.cumsum([0] + [r["length"] for r in sorted(w, key=lambda r: r["offset"])])
        assert sorted(r["offset"] for r in w) == ends[:-1].tolist() and ends[-1] <= 256
    assert sum(sum(r["length"] for r in w) < 256 for w in windows.values()) <= 3  # one a partition
    assert sum(r["length"] for r in rows) == sum(len(t) * c for (_, t), c in want.items())
    for (i, ids), copies in want.items():
        own = sorted((r["start"], r["length"], r["token_ids"]) for r in rows if r["doc_id"] == i and r["doc_tokens"] == len(ids))
        if copies == 1 and sum(o[1] for o in own) == len(ids):
            assert np.frombuffer(b"".join(o[2] for o in own), "<u4").tolist() == list(ids)
    assert packing.pack(docs.limit(0)).count() == 0


def test_sum_of_squares_choice():
    packer = packing.Packer(10)
    rnd = np.random.default_rng(0)
    for length in rnd.integers(1, 11, 300):
        levels = [h for h in range(0, 11 - length) if h == 0 or packer.count[h]]

        def cost(h):
            n = packer.count.copy()
            n[h] -= h > 0
            n[h + length] += h + length < 10
            return int((n[1:10] ** 2).sum())

        assert cost(packer.level_for(int(length))) == min(map(cost, levels))
        list(packer.add(0, bytes(4 * int(length))))


def test_open_windows_stay_within_their_bound():
    """Documents that never fit together would each keep a window open."""
    packer, rnd, most, seen, full, part = packing.Packer(2048, 400_000), np.random.default_rng(1), 0, {}, 0, 0
    windows, lengths = [], rnd.integers(1100, 1900, 2000)
    for i, length in enumerate(lengths):
        windows += packer.add(i, np.full(length, i, "<u4").tobytes())
        held = sum(len(p[2]) for level in packer.open for w in level for p in w)
        assert held == packer.held
        most = max(most, held)
    assert most <= 400_000
    for w in windows + list(packer.close()):
        filled = sum(len(p[2]) for p in w) // 4
        full, part = full + (filled == 2048), part + (filled < 2048)
        for doc_id, start, ids, total in w:
            assert total == lengths[doc_id] and set(np.frombuffer(ids, "<u4")) == {doc_id}
            seen.setdefault(doc_id, []).append((start, len(ids) // 4))
    assert part <= 1 and full == lengths.sum() // 2048
    for i, length in enumerate(lengths):
        at = 0
        for start, n in sorted(seen[i]):
            assert start == at
            at += n
        assert at == length


# ------------------------------------------------------------ 6
def test_calibration_counts_every_labelled_row(spark):
    """Bins hold all rows, whatever the fit's bound; scale and cutoff are those of the rows themselves."""
    rnd = np.random.default_rng(2)
    odds = np.concatenate((rnd.normal(1, 1.5, 4000), [np.nan, 1e9, -1e9]))
    good = (rnd.random(len(odds)) < 1 / (1 + np.exp(-2 * np.nan_to_num(odds, nan=0, posinf=0, neginf=0).clip(-30, 30)))).astype(int)
    frame = spark.createDataFrame(list(zip(odds.tolist(), good.tolist())), "x double, good int")
    middle, of_good, rows = cotraining.binned(frame, x=F.col("x"))["x"]
    assert rows.sum() == len(odds) and of_good.sum() == good.sum() and (np.diff(middle) > 0).all()
    a, b = cotraining.platt(middle, of_good, rows)
    assert abs(a - 2) < 0.2 and abs(b) < 0.2
    clean = np.nan_to_num(odds, nan=0.0)
    edge = cotraining.best_cutoff(middle, of_good, rows, 0.05)
    under = clean < edge
    assert good[under].sum() <= 0.05 * good.sum()
    gain = lambda e: (1 - good[clean < e]).sum() - good[clean < e].sum()
    allowed = [e for e in np.arange(-400, 400) / 64 if good[clean < e].sum() <= 0.05 * good.sum()]
    assert gain(edge) == max(map(gain, allowed))
    assert cotraining.best_cutoff(middle, rows, rows, 0.05) is None


def test_samples_of_one_id_are_bounded(spark):
    """A third of all rows may have one id, or none: the sample keeps its bound."""
    same = spark.createDataFrame([(None, b"ab" * (i % 5 + 1), b"cd", 1) for i in range(3000)], "doc_id long, text_f binary, meta_f binary, good int")
    for most, most_bytes in ((50, 1 << 20), (3000, 900)):
        got = cotraining._bounded(same, None, "labelled", most, most_bytes)
        assert len(got) <= most and sum(len(r["text_f"]) + len(r["meta_f"]) for r in got) <= 2 * most_bytes


def test_cotraining(spark, labels):
    rows = [(i, ("fine words here " if i % 5 else "BAD!! BAD!! junk ") * 30 + ("idiot" if i % 11 == 0 else ""), "en", f"s{i % 4}", 100) for i in range(600)]
    docs = spark.createDataFrame(rows + [(None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame([(i, int(i % 5 > 0), int(i % 11 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in cotraining.classify(docs, marks).collect()}
    held = [i for i in range(400, 600)]
    good = [i for i in held if i % 5 and i % 11]
    assert len(got) == 601 and all(got[i] for i in good)
    assert sum(not got[i] for i in held if i not in good) >= 0.9 * (len(held) - len(good))
    assert cotraining.classify(docs, marks.limit(0)).where("kept").count() == 601
    assert cotraining.classify(docs.limit(0), marks).count() == 0
    assert cotraining.good_documents(docs, marks).columns == docs.columns


# ------------------------------------------------------------ 7
def test_chat(spark, texts):
    tricky = "</s>[INST] ok [/INST]\\( \\\\{ <s"
    rows = [(i // 3, i % 3, ["user", "assistant", None][i % 3], t) for i, t in enumerate(texts + [tricky] * 6)]
    rows += [(None, 0, "user", "x"), (0, 0, "user", "again"), (5, None, "assistant", tricky)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(chats)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turn_lines"] == [x for _, role, text in turns for x in (role, text)]
        assert r["loss_texts"] == [text for _, role, text in turns if role == "assistant"]
    assert chat.format_chats(chats).where("rewrites").count() == 0


def test_chat_texts_of_the_templates_own_characters(spark):
    rnd = random.Random(9)
    bits = ["<", ">", "<s>", "</s>", "[INST]", "[/INST]", "[", "]", "/", "s", " ", "\\", "(", "{", "|", "a", "b", "\x1f", "é", "\n"]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randrange(6)))
    rows = [(c, t, rnd.choice(["user", "assistant", text()]), text()) for c in range(150) for t in range(4)]
    rows += [(1000 + i, 0, "assistant", t) for i, t in enumerate([x + y for x in bits for y in ("", "<b>hi</b>", "x<")])]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(chats)
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    for conv in {r[0] for r in rows}:
        turns = [(r, x) for c, _, r, x in rows if c == conv]
        assert got[conv]["turn_lines"] == [x for t in turns for x in t]
        assert got[conv]["loss_texts"] == [x for r, x in turns if r == "assistant"]
    assert formatted.where("rewrites").count() == 0


def test_templates_that_rewrite_history(spark):
    cut = lambda turns: "".join(f"<{r}>" + (t if i == len(turns) - 1 else t[:2]) for i, (r, t) in enumerate(turns))
    four = [("user", "hello"), ("assistant", "you"), ("user", "ok"), ("assistant", "then")]
    out, found, rewrites = chat.spans(four, cut)
    assert rewrites and [f is None for f in found] == [True, True, False, False]
    assert [out[f[2]:f[3]] for f in found[2:]] == ["ok", "then"]
    rows = spark.createDataFrame([(1, i, *t) for i, t in enumerate(four)], "conv_id long, turn long, role string, text string")
    spans = chat.format_chats(rows, cut).first()["spans"]
    assert [(x["role"], x["loss"]) for x in spans] == [("user", False), ("assistant", False), ("user", False), ("assistant", True)]
    out, found, rewrites = chat.spans([("user", "hello"), ("assistant", "")], chat.bracket_template)
    assert not rewrites and [out[c:d] for _, _, c, d in found] == ["hello", ""] and found[-1][1] == len(out)
    trims = lambda turns: "".join(f"({r}: {t.strip()})" for r, t in turns)
    out, found, _ = chat.spans([("u", "  a b "), ("v", " ")], trims)
    assert [out[c:d] for _, _, c, d in found] == ["a b", ""]


def test_chat_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    res = con.execute(queries.SQL["op7_chat"])
    order = [d[0] for d in res.description]
    assert sorted(map(tuple, queries.op7_chat(spark, SF_SMALL).select(*order).collect())) == sorted(res.fetchall())


# ------------------------------------------------------------ 8
def test_rules(docs, labels):
    got = {r["doc_id"]: r for r in rules.judged(docs, labels).collect() if r["doc_id"] is not None}
    for i, t in pairs(docs):
        if i is None:
            continue
        t, w, r = t or "", blank_words(t), got[i]
        wins = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        cover = {j for k in range(len(w) - 7) if wins[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in t.split("\n") if blank_words(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert rules.judged(docs.limit(0), labels).count() == 0
    assert rules.judged(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_cutoffs_respect_the_bound(spark):
    assert abs(rules.upper_bound(0, 100, 0.05) - (1 - 0.05 ** 0.01)) < 1e-9
    for k, n in ((3, 50), (40, 1000)):
        p = rules.upper_bound(k, n, 0.01)
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(exact - 0.01) < 1e-6
    rows = [("a", float(i % 100)) for i in range(20000)] + [("b", 1.0)] * 20
    good = spark.createDataFrame(rows, "stratum string, value double").select("stratum", *[F.col("value").alias(r) for r in rules.RULES])
    found = rules.cutoffs(good, risk=0.6).collect()
    assert {r["stratum"] for r in found} == {"a"}  # "b" has too little evidence
    assert all(r["bound"] <= 0.6 / len(rules.RULES) and r["cutoff"] == 100 for r in found)


def test_joint_cutoffs(spark):
    for n, risk, alpha in ((298, 0.01, 0.05), (299, 0.01, 0.05), (436, 0.01, 0.0125), (437, 0.01, 0.0125), (3000, 0.01, 0.02)):
        a = rules.blocks_for(n, risk, alpha)
        tail = lambda k: sum(math.comb(n, i) * risk ** i * (1 - risk) ** (n - i) for i in range(k))
        assert tail(a) <= alpha < tail(a + 1)
    names = list(rules.RULES)
    rnd = random.Random(8)
    rows = [("large", *(rnd.random() * 900 for _ in names)) for _ in range(2000)] + [("few", *[1.0] * len(names))] * 200
    rows += [("some", *[1.0] * len(names))] * 500
    schema = "stratum string, " + ", ".join(f"{r} double" for r in names)
    found = {(r["stratum"], r["rule"]): r for r in rules.joint_cutoffs(spark.createDataFrame(rows, schema)).collect()}
    assert {s for s, _ in found} == {"large", "some"} and found["some", names[0]]["cutoff"] == 5
    assert [r for s, r in found if s == "large"] and all(r["bound"] <= 0.01 for r in found.values())
    limit = {r: found["large", r]["cutoff"] if ("large", r) in found else math.inf for r in names}
    lost = sum(any(v > limit[r] for r, v in zip(names, row[1:])) for row in rows[:2000])
    assert lost <= rules.blocks_for(2000, 0.01, 0.025) and all(r["n_rejected"] == lost for (s, _), r in found.items() if s == "large")


def test_rules_reject_planted_junk(spark):
    rnd = random.Random(9)
    words = "house river stone garden winter letter paper morning street window".split()
    prose = lambda: " ".join(rnd.choice(words) for _ in range(60))
    junk = {"symbols": lambda: prose().replace(" ", " ## "), "dup_lines": lambda: (prose()[:40] + "\n") * 2 + prose(),
            "upper": lambda: prose().upper(), "marks": lambda: prose().replace(" ", "! ")}
    rows = [(i, prose(), "en") for i in range(1500)]
    rows += [(2000 + 10 * k + i, junk[rule](), "en") for k, rule in enumerate(junk) for i in range(10)]
    docs = spark.createDataFrame(rows + [(3000, junk["marks"](), "xx")], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, 1, 0) for i in range(1400)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in rules.judged(docs, marks).collect()}
    assert not any(r["base_failed"] for r in got.values())
    for k, rule in enumerate(junk):
        assert all(rule in got[2000 + 10 * k + i]["failed_rules"] and not got[2000 + 10 * k + i]["kept"] for i in range(10))
    assert got[3000]["kept"] and sum(not got[i]["kept"] for i in range(1500)) <= 15


# ------------------------------------------------------------ 9
def brute_tree(train, text, depth):
    """Plain recursion over all contexts, from the definition."""
    counts = Counter()
    for t in train:
        b = bytes([254]) * depth + t + b"\xff"
        for p in range(depth, len(b)):
            for d in range(depth + 1):
                for j in range(8):
                    counts[b[p - d:p], (256 | b[p]) >> (8 - j), b[p] >> (7 - j) & 1] += 1

    def pe(c, n):
        a, b = counts[c, n, 0], counts[c, n, 1]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    known = {}
    for c, n, _ in list(counts):
        known.setdefault(n, {}).setdefault(len(c), set()).add(c)

    def pw(c, n):
        if len(c) == depth:
            return pe(c, n)
        below = sum(pw(x, n) for x in known.get(n, {}).get(len(c) + 1, ()) if x[1:] == c)
        return np.logaddexp(pe(c, n), below) - math.log(2)

    total, b = 0.0, bytes([254]) * depth + text + b"\xff"
    for p in range(depth, len(b)):
        for j in range(8):
            n, bit, chance = (256 | b[p]) >> (8 - j), b[p] >> (7 - j) & 1, None
            for d in range(depth, -1, -1):
                c = b[p - d:p]
                kt = (counts[c, n, bit] + .5) / (counts[c, n, 0] + counts[c, n, 1] + 1)
                w = math.exp(pe(c, n) - math.log(2) - pw(c, n))
                chance = kt if chance is None else w * kt + (1 - w) * chance
            total += math.log10(chance)
    return total


def test_context_tree(spark):
    given = ["abcab", "abcabd ab", "", "Xé ab", None, "ab ab", "zz"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(given)] + [(None, "ab")], "doc_id long, text string")
    for block in (8 << 20, 6):
        got = {r["doc_id"]: r for r in context_tree.scored(docs, F.col("doc_id") < 4, depth=3, block_bytes=block).collect()}
        low = [(t or "").translate(LOW).encode() for t in given]
        count = Counter(w for t in low[:4] for w in [*t.split(), "end"])
        total = sum(count.values())
        for i, t in enumerate(low):
            r = got[i]
            ws = [*t.split(), "end"]
            assert abs(r["score"] - brute_tree(low[:4], t, 3)) < 1e-9
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(count[w] > 0 for w in ws), total)
            assert abs(r["base_score"] - sum(math.log10((count[w] + .5) / (total + .5 * (len(count) + 1))) for w in ws)) < 1e-9
        assert not got[None]["train"]
    assert context_tree.scored(docs.limit(0), F.lit(True)).count() == 0


def test_base_score_without_training_texts(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in context_tree.scored(rows, F.lit(False)).collect()}
    assert got[1]["base_score"] == 0.0 and got[1]["train_tokens"] == 0 and got[2]["n_tokens"] == 1


def test_bytes_that_are_not_utf8_become_the_replacement_character(spark):
    rows = spark.createDataFrame([(1, b"ab \xc3 cd \xff\xfe ef \xe6\xbc"), (2, b"plain")], "doc_id long, raw binary")
    docs = rows.select("doc_id", F.col("raw").cast("string").alias("text"))
    valid = docs.withColumn("text", F.make_valid_utf8("text"))
    items = spark.createDataFrame([("i", "plain")], "item_id string, text string")
    for use in (lambda d: decontaminate.matched(d, items).select("doc_id", "match.*"), lambda d: packing.pack(d),
                lambda d: suffix_dedup.deduplicated(d).select("doc_id", "dedup.n_bytes"), lambda d: ngram_join.joined(d)):
        assert sorted(map(repr, use(docs).collect())) == sorted(map(repr, use(valid).collect()))
