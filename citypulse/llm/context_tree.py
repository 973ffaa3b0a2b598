"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; the decision with a given prefix of bits has a
context tree of its own, whose nodes are the last 0, 1, ..., ``depth`` bytes. A node
with a zeros and b ones in training has the Krichevsky-Trofimov probability
    log Pe = lgamma(a + 1/2) + lgamma(b + 1/2) - lgamma(a + b + 1) - log(pi)
and the weighted probability Pw = (Pe + product of the children's Pw) / 2, Pw =
Pe at full depth. After training, the chance of a bit mixes the estimates
(a + 1/2) / (a + b + 1) along the path: p = w * estimate + (1 - w) * p(child), with
w = Pe / (2 Pw). Texts begin after ``depth`` start bytes and end with an end
byte (0xFE and 0xFF, which UTF-8 never has).

Work is split into blocks of documents. A block sends each of its distinct
windows (context and byte) and words once, packed by part; parts add the
training counts of all blocks, and build all subtrees below two bytes of
context, of which each part has whole ones. The nodes above (at most 256 + 256 *
256 contexts) are summed by Spark. Parts then answer each block with a value
per key, and blocks score their documents. What is sent grows with the input;
no model is collected or broadcast but the table of one byte of context (at
most 65,536 nodes).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm import common

U64 = np.uint64
START, END = 0xFE, 0xFF
WORD = U64(1 << 63)  # set in the keys of words; windows are shorter


def windows_of(low: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all positions, first position of each text). A key has the byte
    in its last 8 bits and the bytes before it above, nearest first."""
    rows = len(offsets) - 1
    at = offsets + (depth + 1) * np.arange(rows + 1)
    data = np.full(at[-1], START, np.uint8)
    spot = np.ones(at[-1], bool)
    for k in range(depth):
        spot[at[:-1] + k] = False
    data[at[1:] - 1] = END
    text = spot.copy()
    text[at[1:] - 1] = False
    data[text] = low
    key = np.zeros(len(data), U64)
    for k in range(depth + 1):
        key[k:] |= data[:len(data) - k].astype(U64) << U64(8 * k)
    return key[spot], offsets[:-1] + np.arange(rows)


def words_in(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all words, first word of each text and the end)."""
    start, end, first = common.words_of(low, offsets, common.NOT_BLANK)
    return common.word_hashes(low, start, end) | WORD, first


def _pieces(table: pa.Table):
    """(rows, lower-cased bytes, offsets) of slices of about 1 MB of text."""
    for batch in table.combine_chunks().to_batches():
        for part in common.by_bytes(batch, "text", 1 << 20):
            data, offsets = common.text_bytes(part.column("text"))
            yield part, common.LOWER[data], offsets


def block_counts(table: pa.Table, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys of a block, their counts in training texts)."""
    keys, counts = [], []
    for part, low, offsets in _pieces(table):
        train = part.column("train").to_numpy(zero_copy_only=False)
        for values, first, size in _both(low, offsets, depth):
            of_train = np.repeat(train, size)
            seen, many = np.unique(values[of_train], return_counts=True)
            other = np.unique(values[~of_train])
            keys += [seen, other]
            counts += [many, np.zeros(len(other), np.int64)]
    return added(np.concatenate(keys), np.concatenate(counts))


def _both(low: np.ndarray, offsets: np.ndarray, depth: int):
    values, first = windows_of(low, offsets, depth)
    yield values, first, np.diff(np.append(first, len(values)))
    values, first = words_in(low, offsets)
    yield values, first[:-1], np.diff(first)


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Windows by their last two context bytes to 0..parts-1, words to the
    ``parts`` after."""
    word = keys >= WORD
    near = np.where(word, keys, (keys >> U64(8)) & U64(0xFFFF))
    return (common.mixed(near) % U64(parts)).astype(np.int64) + parts * word


_SMALL = np.array([math.lgamma(i / 2) if i else 0.0 for i in range(4096)])


def lgamma_half(twice: np.ndarray) -> np.ndarray:
    """log Gamma(twice / 2): a table, then Stirling's series."""
    x = np.maximum(twice, 4000) / 2
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
    return np.where(twice < 4096, _SMALL[np.minimum(twice, 4095)], series)


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log Pe."""
    return lgamma_half(2 * zeros + 1) + lgamma_half(2 * ones + 1) - lgamma_half(2 * (zeros + ones) + 2) - math.log(math.pi)


def weighted(pe: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log Pw, w)."""
    pw = np.logaddexp(pe, children) - math.log(2)
    return pw, np.exp(pe - math.log(2) - pw)


def subtrees(keys: np.ndarray, counts: np.ndarray, depth: int, top: int = 2):
    """For whole subtrees below ``top`` bytes of context: (chance of each bit of
    each window, as mixed at depth ``top``; top nodes: key, zeros, ones, log Pw)."""
    chance, nodes = np.empty((8, len(keys))), []
    byte, context = keys & U64(255), keys >> U64(8)
    for j in range(8):
        prefix = (byte | U64(256)) >> U64(8 - j)
        bit = ((byte >> U64(7 - j)) & U64(1)).astype(np.int64)
        below = below_pw = p = None
        for d in range(depth, top - 1, -1):
            mine = ((context & U64((1 << (8 * d)) - 1)) << U64(8)) | prefix
            node, at = np.unique(mine, return_inverse=True)
            ones = np.bincount(at, counts * bit, len(node)).astype(np.int64)
            zeros = np.bincount(at, counts * (1 - bit), len(node)).astype(np.int64)
            pe = kt(zeros, ones)
            estimate = (np.where(bit, ones[at], zeros[at]) + 0.5) / (zeros + ones + 1)[at]
            if below is None:
                pw, p = pe, estimate
            else:
                parent = ((below >> U64(8)) & U64((1 << (8 * d)) - 1)) << U64(8) | (below & U64(255))
                pw, w = weighted(pe, np.bincount(np.searchsorted(node, parent), below_pw, len(node)))
                p = w[at] * estimate + (1 - w[at]) * p
            below, below_pw = node, pw
        chance[j] = p
        nodes.append((below, zeros, ones, below_pw))
    return chance, [np.concatenate(x) for x in zip(*nodes)]


class Top:
    """Estimates and weights of the nodes with one byte of context and with
    none, from sums (context byte, prefix, zeros, ones, children's log Pw)."""

    def __init__(self, rows: list):
        self.estimate = np.full((2, 1 << 16), 0.5)  # chance of a one
        self.weight = np.full((2, 1 << 16), 0.5)
        if not rows:
            return
        node, zeros, ones, children = (np.array(x) for x in zip(*rows))
        pw = self._level(1, node.astype(np.int64), zeros.astype(np.int64), ones.astype(np.int64), children)
        prefix, at = np.unique(node.astype(np.int64) & 255, return_inverse=True)
        self._level(0, prefix, *(np.bincount(at, x).astype(np.int64) for x in (zeros, ones)), np.bincount(at, pw))

    def _level(self, level, node, zeros, ones, children):
        pw, w = weighted(kt(zeros, ones), children)
        self.estimate[level, node], self.weight[level, node] = (ones + 0.5) / (zeros + ones + 1), w
        return pw

    def log10(self, keys: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """log10 probability of each window's byte."""
        byte, near = keys & U64(255), (keys >> U64(8)) & U64(255)
        total = np.zeros(len(keys))
        for j in range(8):
            prefix = ((byte | U64(256)) >> U64(8 - j)).astype(np.int64)
            bit = ((byte >> U64(7 - j)) & U64(1)).astype(bool)
            p = chance[j]
            for level, node in ((1, (near.astype(np.int64) << 8) | prefix), (0, prefix)):
                one, w = self.estimate[level, node], self.weight[level, node]
                p = w * np.where(bit, one, 1 - one) + (1 - w) * p
            total += np.log10(p)
        return total


def scored(docs: DataFrame, train, depth: int = 4, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = 8 << 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, train, n_bytes, n_tokens (words and
    the end), n_known, train_tokens, base_score (smoothed unigram, log10), score
    (log10 probability of the text and its end) and bits_per_byte.

    ``train``: a boolean column expression over ``docs``; null counts as false. Texts
    are lower-cased (A-Z); null texts are empty, and are an end alone. Words are told
    apart by 64-bit hashes. Rows with null or repeated ids are scored each for
    itself. Without training texts every bit has chance 1/2. An empty table
    gives no rows. Further columns are not read.
    """
    spark = docs.sparkSession
    common.workers_see_package(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_of(text_col).alias("text"),
                         F.coalesce(train, F.lit(False)).alias("train"))
    size, ends = source.agg(F.sum(F.octet_length("text") + 1), F.sum(F.col("train").cast("long"))).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = source.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = block_counts(table, depth)
        part = part_of(keys, parts)
        order = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[order], np.arange(2 * parts + 1))
        own = [(p, order[edge[p]:edge[p + 1]]) for p in np.flatnonzero(np.diff(edge)).tolist()]
        return pa.table({"part": pa.array([p for p, _ in own], pa.int32()), "block": pa.array([key[0].as_py()] * len(own), pa.int64()),
                         "keys": pa.array([keys[o].tobytes() for _, o in own], pa.binary()),
                         "counts": pa.array([counts[o].astype(np.int64).tobytes() for _, o in own], pa.binary())})

    asked = common.written(source.groupBy("block").applyInArrow(ask, "part int, block long, keys binary, counts binary"), "ctw-asked")
    common.release(spark)

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        joined = lambda c, kind: np.frombuffer(b"".join(table[c].to_pylist()), kind)
        keys, counts = added(joined("keys", U64), joined("counts", np.int64))
        row = {"part": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([keys.tobytes()], pa.binary())}
        if key[0].as_py() >= parts:
            values, nodes = counts, [np.empty(0, t) for t in (U64, np.int64, np.int64, np.float64)]
            tokens, distinct = int(counts.sum()), int((counts > 0).sum())
        else:
            values, nodes = subtrees(keys, counts, depth)
            tokens = distinct = 0
        packed = [pa.array([n.tobytes()], pa.binary()) for n in nodes]
        return pa.table(row | {"values": pa.array([values.tobytes()], pa.binary()), "tokens": [tokens], "distinct_words": [distinct],
                               "nodes": packed[0], "zeros": packed[1], "ones": packed[2], "pw": packed[3]})

    built = common.written(asked.groupBy("part").applyInArrow(
        build, "part int, keys binary, values binary, tokens long, distinct_words long, "
               "nodes binary, zeros binary, ones binary, pw binary"), "ctw-built")
    common.release(spark)

    def upper(batches_in):
        """Per part, the sums over its two-byte contexts by (last byte, prefix)."""
        for batch in batches_in:
            for row in batch.to_pylist():
                node, zeros, ones, pw = (np.frombuffer(row[c], t) for c, t in
                                         (("nodes", U64), ("zeros", np.int64), ("ones", np.int64), ("pw", np.float64)))
                if not len(node):
                    continue
                short, at = np.unique((node & U64(0xFFFF)).astype(np.int64), return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(short), *(pa.array(np.bincount(at, x, len(short))) for x in (zeros, ones, pw))],
                    names=["node", "zeros", "ones", "pw"])

    top = Top([tuple(r) for r in common.map_arrow(built.select("nodes", "zeros", "ones", "pw"), upper,
                                                  "node long, zeros double, ones double, pw double")
               .groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("pw")).collect()])
    tokens, distinct = built.agg(F.sum("tokens"), F.sum("distinct_words")).first()
    ends = ends or 0
    tokens, distinct = (tokens or 0) + ends, (distinct or 0) + (ends > 0)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            part = left["part"][0].as_py()
            keys, raw = np.frombuffer(right["keys"][0].as_py(), U64), right["values"][0].as_py()
            if part >= parts:
                values = np.frombuffer(raw, np.int64)
            else:
                values = top.log10(keys, np.frombuffer(raw).reshape(8, -1))
            for block, own in zip(left["block"].to_pylist(), left["keys"].to_pylist()):
                rows.append((block, own, values[np.searchsorted(keys, np.frombuffer(own, U64))].astype(
                    np.int64 if part >= parts else np.float64).tobytes(), part >= parts))
        columns = list(zip(*rows)) or [[], [], [], []]
        return pa.table({c: pa.array(list(v), t) for c, v, t in zip(
            ("block", "keys", "values", "words"), columns, (pa.int64(), pa.binary(), pa.binary(), pa.bool_()))})

    answers = (asked.select("part", "block", "keys").groupBy("part").cogroup(built.select("part", "keys", "values").groupBy("part"))
               .applyInArrow(answer, "block long, keys binary, values binary, words boolean"))
    unit = math.log10(tokens + 0.5 * (distinct + 1))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for words, kind in ((False, np.float64), (True, np.int64)):
            own = right.filter(pc.equal(right["words"], words))
            keys = np.frombuffer(b"".join(own["keys"].to_pylist()), U64)
            values = np.frombuffer(b"".join(own["values"].to_pylist()), kind)
            order = np.argsort(keys)
            found.append((keys[order], values[order]))
        out = [[] for _ in range(7)]
        for part, low, offsets in _pieces(left):
            windows, first = windows_of(low, offsets, depth)
            logs = found[0][1][np.searchsorted(found[0][0], windows)]
            words, begin = words_in(low, offsets)
            seen = found[1][1][np.searchsorted(found[1][0], words)] if len(words) else np.empty(0, np.int64)
            sums = lambda x: (lambda t: t[begin[1:]] - t[begin[:-1]])(np.concatenate(([0], np.cumsum(x))))
            count = np.diff(begin) + 1
            total = np.add.reduceat(logs, first)
            base = sums(np.log10(seen + 0.5)) + math.log10(ends + 0.5) - count * unit
            for column, x in zip(out, (part.column("doc_id"), part.column("train"), pa.array(np.diff(offsets)), pa.array(count),
                                       pa.array(sums(seen > 0).astype(np.int64) + (ends > 0)), pa.array(base), pa.array(total))):
                column.append(x)
        names = ("doc_id", "train", "n_bytes", "n_tokens", "n_known", "base_score", "score")
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({n: pa.chunked_array(c, t) for n, c, t in zip(names, out, kinds)})

    result = source.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id long, train boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double")
    return result.withColumn("train_tokens", F.lit(tokens).cast("long")).withColumn(
        "bits_per_byte", -F.col("score") / math.log10(2) / (F.col("n_bytes") + 1))
