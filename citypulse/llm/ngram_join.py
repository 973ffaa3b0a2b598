"""Near-duplicate documents by a parity-sketch join on word n-grams.

A document is the set of its distinct word n-grams. Two documents are linked
when 100 * |A and B| >= percent * |A or B|, which bounds the symmetric
difference D: with sizes a, b, D <= (100 - percent) * (a + b) / (100 + percent).

Sizes fall into bands such that linked documents are in one band or in
neighbours. For each band, n-grams are dealt by hash to m groups of 65,536 bits
and flip one bit of their group (a parity sketch, kept as its few set bits: the Hamming distance of two
sketches is at most D). As D <= d < m, at least m - d groups of two linked
documents are equal, so documents that share no (band, group, bits) key cannot
be linked (pigeonhole). A document writes keys for its own band and the next.
A document need not use all keys. Order group contents by how many documents
have the key, most first. If each document leaves out a first part, by this
order, of at most m - d - 1 groups, one equal group remains in both: the one
that leaves out more leaves out less than the m - d equal ones. So empty groups
and those that hold only a passage common to many documents cost nothing.

Keys that occur once are dropped in packed form. Members of each remaining key
are first compared with its most central member (the one whose keys are
shared most); then, only where a key's members are not all in one component
yet, across components, until nothing new is found. Candidates pass a
2048-bit parity sketch and are verified on the texts' own n-grams.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm import common
from citypulse.llm.components import components

U64 = np.uint64
GROUP_BITS = 1 << 16
BITS = common.mixed(np.arange(1, GROUP_BITS + 1, dtype=U64) * U64(0xA24BAED4963EE407))
FILTER_BITS = 2048


def schemes(percent: int, largest: int) -> list[tuple[int, int, int, int]]:
    """(least size, greatest size, groups m, d) of each band up to ``largest``."""
    found, low = [], 1
    while low <= largest or len(found) < 2 or found[-2][1] < largest:
        high = max(low, 100 * low // percent)
        d = 2 * (100 - percent) * high // (100 + percent)
        found.append((low, high, d + 2 + (3 * d + 9) // 10, d))
        low = high + 1
    return found


def ngram_sets(part: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text (lower-cased A-Z, words
    between ASCII blanks); a shorter text is one n-gram, no words are none."""
    data, offsets = common.text_bytes(part)
    data = common.LOWER[data]
    start, end, first = common.words_of(data, offsets, common.NOT_BLANK)
    words = common.word_hashes(data, start, end)
    grams = common.run_hashes(words, n)
    found = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            found.append(np.unique(grams[a:b - n + 1]))
        else:
            found.append(common.run_hashes(words[a:b], b - a) if b > a else np.empty(0, U64))
    return found


def group_keys(grams: np.ndarray, band: int, m: int, d: int) -> tuple[np.ndarray, int]:
    """(the keys of a set's sketch in a band but for empty groups, how many
    more may be left out)."""
    h = common.mixed(grams + U64(0x9E3779B97F4A7C15 * (band + 1) % (1 << 64)))
    group = (h >> U64(32)) % U64(m)
    flips, times = np.unique(group * U64(GROUP_BITS) + (h & U64(GROUP_BITS - 1)), return_counts=True)
    odd = flips[times & 1 == 1]
    group = (odd // U64(GROUP_BITS)).astype(np.int64)
    sums = np.zeros(m, U64)
    weight = np.bincount(group, minlength=m)
    held = np.flatnonzero(weight)
    if len(odd):
        sums[held] = np.add.reduceat(BITS[(odd % U64(GROUP_BITS)).astype(np.int64)], np.cumsum(weight)[held] - weight[held])
    keys = common.mixed(sums ^ common.mixed(U64(band << 32) + np.arange(m, dtype=U64)))
    spare = m - d - 1 - (m - len(held))
    return (keys[held], spare) if spare >= 0 else (keys, 0)


def filter_sketch(grams: np.ndarray) -> bytes:
    odd = np.bincount((grams % U64(FILTER_BITS)).astype(np.int64), minlength=FILTER_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def shared_keys(docs: DataFrame, n: int, percent: int, block_keys: int = 1 << 20) -> DataFrame:
    """(key, doc, code) for every key that two or more documents have; code is
    the band times 2^16 plus the number of keys the document may leave out.
    Besides a row per document with a null key, and its set's size as code.

    A task packs its keys in blocks. Of a key met more than once in a block,
    one row goes to the key's part and all are known to be shared; so a part
    gets a key at most once per block, however hot it is. Parts are as many as
    shuffle partitions."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed_type = pa.schema([("part", pa.int32()), ("state", pa.int8()), ("keys", pa.binary()),
                             ("docs", pa.binary()), ("codes", pa.binary())])

    def emit(batches_in):
        bands = schemes(percent, 1 << 20)
        tops = np.array([b[1] for b in bands])
        keys, ids, codes, held = [], [], [], 0
        salt = TaskContext.get().partitionId() * 7919

        def flush():
            nonlocal keys, ids, codes, held, salt
            if not keys:
                return
            key, doc, code = np.concatenate(keys), np.concatenate(ids), np.concatenate(codes)
            keys, ids, codes, held = [], [], [], 0
            order = np.lexsort((doc, key))
            key, doc, code = key[order], doc[order], code[order]
            fresh = np.concatenate(([True], key[1:] != key[:-1]))
            number = np.cumsum(fresh) - 1
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(key)) - 1
            several = doc[first] != doc[last]  # keys of two documents of this block
            packs = lambda own: (key[own].tobytes(), doc[own].tobytes(), code[own].tobytes())
            local = np.flatnonzero(several[number])
            for at in range(0, len(local), 1 << 18):
                salt += 1
                yield salt % parts, 2, *packs(local[at:at + (1 << 18)])
            part = (key[first] % U64(parts)).astype(np.int64) * 2 + several
            order = np.argsort(part, kind="stable")
            edge = np.searchsorted(part[order], np.arange(2 * parts + 1))
            for p in np.flatnonzero(np.diff(edge)).tolist():
                yield p // 2, p % 2, *packs(first[order[edge[p]:edge[p + 1]]])

        for batch in batches_in:
            for piece in common.by_bytes(batch, "text"):
                sets = ngram_sets(piece.column("text"), n)
                salt += 1
                yield common.batches([(salt % parts, 3, b"", piece.column("doc").to_numpy().tobytes(),
                                       np.array([len(g) for g in sets], np.int32).tobytes())], packed_type)
                for doc, grams in zip(piece.column("doc").to_pylist(), sets):
                    if not len(grams):
                        continue
                    while bands[-2][1] < len(grams):
                        bands = schemes(percent, 2 * len(grams))
                        tops = np.array([b[1] for b in bands])
                    home = int(np.searchsorted(tops, len(grams)))
                    for j in (home, home + 1):
                        own, spare = group_keys(grams, j, *bands[j][2:])
                        keys.append(own)
                        ids.append(np.full(len(own), doc, np.int64))
                        codes.append(np.full(len(own), (j << 16) + min(spare, 65535), np.int32))
                        held += len(own)
                    if held >= block_keys:
                        yield common.batches(list(flush()), packed_type)
        yield common.batches(list(flush()), packed_type)

    def shared(table: pa.Table) -> pa.Table:
        def of(own: pa.Table, name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(own[name].to_pylist()), kind)

        # state 0: a block's only document with the key; 1: one of several, all known; 2: those; 3: sizes
        known, sizes = (table.filter(pc.equal(table["state"], s)) for s in (2, 3))
        alone = [table.filter(pc.equal(table["state"], s)) for s in (0, 1)]
        key, doc, code = (np.concatenate([of(t, c, k) for t in alone]) for c, k in
                          (("keys", np.int64), ("docs", np.int64), ("codes", np.int32)))
        listed = np.arange(len(key)) >= len(of(alone[0], "keys", np.int64))
        order = np.argsort(key, kind="stable")
        same = np.concatenate(([False], key[order][1:] == key[order][:-1], [False]))
        met = order[(same[1:] | same[:-1]) & ~listed[order]]
        own = pa.table({"key": np.concatenate((of(known, "keys", np.int64), key[met])),
                        "doc": np.concatenate((of(known, "docs", np.int64), doc[met])),
                        "code": np.concatenate((of(known, "codes", np.int32), code[met]))})
        docs_of = of(sizes, "docs", np.int64)
        return pa.concat_tables([own, pa.table({"key": pa.nulls(len(docs_of), pa.int64()), "doc": docs_of,
                                                "code": of(sizes, "codes", np.int32)})])

    rows = common.map_arrow(docs, emit, "part int, state byte, keys binary, docs binary, codes binary")
    return rows.groupBy("part").applyInArrow(shared, "key long, doc long, code int")


def telling_keys(shared: DataFrame, top: int = 4) -> DataFrame:
    """(key, doc, weight, top): the shared keys but for those that each
    document may leave out, the most frequent ones. weight: how often the
    document's keys of the band are shared; top: whether the key is among its
    few most frequent ones that are left."""
    sizes = shared.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    own = Window.partitionBy("doc", "code")
    spare = F.col("code").bitwiseAND(65535)
    return (shared.join(sizes, "key").where("members > 1")
            .withColumn("place", F.row_number().over(own.orderBy(F.desc("members"), "key")))
            .withColumn("weight", F.sum("members").over(own))
            .where(F.col("place") > spare)
            .select("key", "doc", "weight", (F.col("place") <= spare + top).alias("top")))


def _whole_sets(docs: DataFrame, n: int) -> DataFrame:
    """(doc, text, n_grams, sketch, mark) of the given documents; equal marks
    (128 bits) mean equal sets."""
    def run(batches_in):
        for batch in batches_in:
            for part in common.by_bytes(batch, "text"):
                sets = ngram_sets(part.column("text"), n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("text"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([filter_sketch(s) for s in sets], pa.binary()),
                     pa.array([np.array([s.sum(dtype=U64), common.mixed(s ^ U64(n)).sum(dtype=U64)]).tobytes() for s in sets],
                              pa.binary())],
                    names=["doc", "text", "n_grams", "sketch", "mark"])

    return common.map_arrow(docs, run, "doc long, text string, n_grams long, sketch binary, mark binary")


@lru_cache(maxsize=64)
def _grams(text: str, n: int) -> frozenset:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def linked(a: str, b: str, n: int, percent: int) -> bool:
    """The definition, on the texts' own n-grams (bytes.lower and bytes.split
    know ASCII only)."""
    x, y = _grams(a, n), _grams(b, n)
    both = len(x & y)
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are links. Sizes and sketches first, then texts."""
    side = lambda x, *cols: sets.select(F.col("doc").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in cols])
    sized = pairs.join(side("a", "n_grams", "sketch"), "a").join(side("b", "n_grams", "sketch"), "b")
    sized = sized.where(100 * F.least("n_grams_a", "n_grams_b") >= percent * F.greatest("n_grams_a", "n_grams_b"))

    def near(batches_in):
        for batch in batches_in:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(f"sketch_{s}").to_pylist()), U64).reshape(batch.num_rows, -1) for s in "ab")
            ok = _near(x ^ y, batch.column("n_grams_a").to_numpy() + batch.column("n_grams_b").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))

    close = common.map_arrow(sized, near, "a long, b long").distinct()
    whole = close.join(side("a", "text"), "a").join(side("b", "text"), "b").select("a", "b", "text_a", "text_b")

    def check(batches_in):
        for batch in batches_in:
            for part in common.by_bytes(batch, "text_a"):
                ok = [linked(p, q, n, percent) for p, q in zip(part.column("text_a").to_pylist(), part.column("text_b").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return common.map_arrow(whole, check, "a long, b long").distinct()


def _near(xor: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether sketches that differ by ``xor`` (rows) allow a link of sets with
    ``total`` n-grams together."""
    return (100 + percent) * np.bitwise_count(xor).sum(axis=-1, dtype=np.int64) <= (100 - percent) * total


def pairs_across(apart: DataFrame, sets: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """The pairs (a, b), a < b, that share a key, have different labels and
    pass sizes and sketches. ``apart`` has key, doc and label.

    Members of a key are dealt to blocks of about ``block``; a group of rows
    holds two blocks and yields only the pairs that pass, so neither a task nor
    a join sees all members or all pairs of a large key."""
    blocks = apart.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    rows = (apart.join(sets.select("doc", "n_grams", "sketch"), "doc").join(blocks, "key")
            .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "doc", "label", "n_grams", "sketch"))
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def passing(table: pa.Table):
        doc, label, size, side = (table[c].to_numpy() for c in ("doc", "label", "n_grams", "block"))
        bits = np.frombuffer(b"".join(table["sketch"].to_pylist()), U64).reshape(len(doc), -1)
        twin = table["i"][0] == table["j"][0]
        for r in range(len(doc)) if twin else np.flatnonzero(side == table["i"][0].as_py()).tolist():
            other = np.arange(r + 1, len(doc)) if twin else np.flatnonzero(side == table["j"][0].as_py())
            other = other[(label[other] != label[r]) & (100 * np.minimum(size[other], size[r]) >= percent * np.maximum(size[other], size[r]))]
            for o in other[_near(bits[other] ^ bits[r], size[other] + size[r], percent)].tolist():
                yield min(doc[r], doc[o]), max(doc[r], doc[o])

    def run(batches_in):
        held = None
        for batch in batches_in:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
            edges = _edges(held)
            found = {p for a, b in zip(edges[:-2], edges[1:-1]) for p in passing(held.slice(a, b - a))}
            held = held.slice(edges[-2])
            yield common.batches(sorted(found), out)
        if held is not None and held.num_rows:
            yield common.batches(sorted(set(passing(held))), out)

    return common.map_arrow(rows, run, "a long, b long").distinct()


def _edges(table: pa.Table) -> list[int]:
    """Where the runs of equal (key, i, j) begin, and the end."""
    change = np.zeros(table.num_rows - 1, bool)
    for c in ("key", "i", "j"):
        x = table[c].to_numpy()
        change |= x[1:] != x[:-1]
    return [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]


def near_components(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((doc, label) of all documents that have a link, label being the
    smallest id reachable by links; (doc, n_shingles) of each row with an id).

    Documents without words, and rows with a null id, are linked with nothing.
    Rows with one id are one document, linked by any of its texts. Of equal
    sets only the smallest id is compared with others. Further columns are not
    read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc"), common.text_of(text_col).alias("text")).where("doc IS NOT NULL")
    every = common.written(shared_keys(source, n, percent), "shared-keys")
    common.release(spark)
    keys = common.written(telling_keys(every.where("key IS NOT NULL")), "telling-keys")
    sizes = every.where("key IS NULL").select("doc", F.col("code").cast("long").alias("n_shingles"))
    common.release(spark)
    sets = common.written(_whole_sets(source.join(keys.select("doc").distinct(), "doc", "left_semi"), n), "near-sets")
    common.release(spark)

    firsts = (sets.groupBy("mark").agg(F.min("doc").alias("a"), F.max("doc").alias("last")).where("a < last").drop("last"))
    copies = common.written(sets.select("doc", "mark").join(firsts, "mark").where("doc > a")
                            .select("a", F.col("doc").alias("b")).distinct(), "copies")
    keys = common.written(keys.join(copies.select(F.col("b").alias("doc")), "doc", "left_anti"), "telling-keys")

    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    hubs = keys.where("top").groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("doc")).alias("minus"))).alias("best")).select("key", (-F.col("best.minus")).alias("hub"))
    tried = common.written(keys.where("top").join(hubs, "key").where("doc <> hub")
                           .select(*ordered("doc", "hub")).distinct(), "tried")
    links = copies.union(common.written(verified(tried, sets, n, percent), "links"))
    while True:
        labels = components(links)
        mine = keys.select("key", "doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left").select(
            "key", "doc", F.coalesce("label", "doc").alias("label"))
        split = (mine.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                 .where("low <> high").select("key"))
        apart = common.written(mine.join(split, "key"), "apart")
        common.release(spark)
        pairs = common.written(pairs_across(apart, sets, percent).join(tried, ["a", "b"], "left_anti"), "tried")
        found = common.written(verified(pairs, sets, n, percent), "links")
        common.dropped(apart)
        common.release(spark)
        if not found.take(1):
            return labels.select(F.col("node").alias("doc"), "label"), sizes
        tried, links = tried.union(pairs), links.union(found)


def joined(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc, n_shingles, component_id (the
    smallest id reachable by links, itself included; null for a null id)."""
    labels, sizes = near_components(docs, n, percent, id_col, text_col)
    nameless = docs.where(F.col(id_col).isNull()).select(common.text_of(text_col).alias("text"))

    def run(batches_in):
        for batch in batches_in:
            for part in common.by_bytes(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(s) for s in ngram_sets(part.column("text"), n)], pa.int64())], names=["n_shingles"])

    nameless = common.map_arrow(nameless, run, "n_shingles long").select(F.lit(None).cast("long").alias("doc"), "n_shingles")
    return sizes.union(nameless).join(labels, "doc", "left").select(
        "doc", "n_shingles", F.coalesce("label", "doc").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are in a group with a smaller id;
    of rows with one id all stay. Columns as before."""
    labels, _ = near_components(docs, n, percent, id_col, text_col)
    labels = labels.where("doc <> label").select(F.col("doc"))
    return docs.join(labels, docs[id_col] == labels["doc"], "left_anti")
