"""Token-id shard files with a minimal perfect hash index.

A shard file is a run of records, each

    document key   8 bytes, signed little-endian
    flags          1 byte: 1 = the key is null
    ids            4 bytes, unsigned little-endian: number of ids
    payload        the ids, 2 or 4 bytes each, unsigned little-endian
    line feed      1 byte

in ascending order of keys over all shards. Shards are written and read by
Spark's own writers and readers, so any store that Spark reaches will do.
The index maps a key to (shard, offset of its payload, ids): keys are dealt by
hash to small parts; each part has a minimal perfect hash (hash and displace:
a seed per bucket of about four keys, searched so that all keys of the part
fill the slots 0..n-1) and a stored 32-bit fingerprint per slot. Keyed reads
open the payloads at the offsets that the index gives.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citypulse.llm import common
from citypulse.llm.tokens import default_vocabulary, encoder

HEAD = "<qBI"
HEAD_BYTES = struct.calcsize(HEAD)
U64 = np.uint64

# ---------------------------------------------------------------- files


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2, id_bytes: int = 2, shard_bytes: int = 16 << 20,
                 vocabulary: str | None = None, added: bool = False) -> None:
    """Encode every text, append ``end_id`` and write shards in key order.

    Texts are encoded where they are read; the records, half as large, are
    then dealt to shards of about ``shard_bytes`` of text by ranges of keys (one
    shuffle). The range bounds come from a sketch of the keys, each counted by the length of
    its texts; its error makes shards larger or smaller and nothing else. A null or empty
    text is its end id alone. Null keys come first, in shards of their own. Rows with equal
    keys follow one another (in a shard, ordered by a hash of the text); a key that
    fills several shards is dealt over them by text and by part of the input.
    ``id_bytes`` is 2 for vocabularies under 65,536 ids, else 4. ``added``: strings of the
    vocabulary's added tokens in a text are those tokens (see ``Encoder``). An empty table gives empty files.
    Further columns are not read.
    """
    vocab = vocabulary or default_vocabulary()
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    source = docs.select(F.col(id_col).cast("long").alias("key"), common.text_of(text_col).alias("text"))
    sized = docs.select(F.col(id_col).cast("long").alias("key"), F.coalesce(
        F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("bytes"))  # as they are: sizes only balance shards
    size = F.col("bytes")
    total, of_null, many = sized.agg(F.sum(size), F.sum(F.when(F.col("key").isNull(), size)), F.count("*")).first()
    total, of_null = total or 0, of_null or 0
    nulls = -(-of_null // shard_bytes)
    shards = max(1, -(-(total - of_null) // shard_bytes))
    cuts = [i / shards for i in range(1, shards)]
    each = max(1, total // max(1, many))  # a text counts once more for every so many bytes
    weighed = sized.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(size / each))))
    last = (weighed.agg(F.percentile_approx("key", cuts, min(1_000_000, max(10_000, 100 * shards)))).first()[0]
            if cuts else None)
    bounds = docs.sparkSession.sparkContext.broadcast(np.array(last or [], np.int64))  # 8 bytes a shard

    def shards_of(keys: pa.Array, tie: np.ndarray, part: np.ndarray) -> np.ndarray:
        null = keys.is_null().to_numpy(zero_copy_only=False)
        key = keys.fill_null(0).to_numpy(zero_copy_only=False)
        low, high = (np.searchsorted(bounds.value, key, side) for side in ("left", "right"))
        low, high = np.where(null, 0, low + nulls), np.where(null, max(0, nulls - 1), high + nulls)
        dealt = common.mixed(tie.view(U64) ^ common.mixed(part.astype(U64)))
        return low + (dealt % (high - low + 1).astype(U64)).astype(np.int64)

    def records(batches_in):
        enc = encoder(vocab, 300_000, added)  # a worker serves the sort of the records too, which takes memory
        for batch in batches_in:
            for part in common.by_bytes(batch, "text", 6 << 20):
                keys, out = part.column("key").to_pylist(), []
                for key, ids in zip(keys, enc.encode_each(part.column("text"))):
                    ids = np.append(ids, np.uint32(end_id))
                    out.append(struct.pack(HEAD, key or 0, key is None, len(ids)) + ids.astype(kind).tobytes())
                shard = shards_of(part.column("key"), *(part.column(c).to_numpy() for c in ("tie", "part")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), part.column("key"), part.column("tie"), pa.array(out, pa.binary())],
                    names=["shard", "key", "tie", "record"])

    # parts of the input, not its rows, spread equal rows: a task that runs again deals the same
    (common.map_arrow(source.withColumns({"tie": F.xxhash64("text"), "part": F.spark_partition_id()}), records,
                      "shard int, key long, tie long, record binary")
     .repartitionById(shards + nulls, F.col("shard"))
     .sortWithinPartitions(F.col("key").asc_nulls_first(), "tie")
     .select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\n").text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, content) of the shard files."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("shard"), "content"))


def read_shards(spark: SparkSession, path: str, id_bytes: int = 2, ids: bool = True) -> DataFrame:
    """One row per record of the shards: key, shard (file number), offset (of
    the payload, in bytes), run_offset (that of the first record with the
    same key in the shard), local_start (ids before it in the shard), n_tokens and, where
    ``ids`` is set, token_ids (unsigned 32-bit little-endian). Without them only
    the heads of the records are looked at."""
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    names = ["key", "shard", "offset", "run_offset", "local_start", "n_tokens"]
    out = pa.schema([(n, pa.int64()) for n in names] + ([("token_ids", pa.binary())] if ids else []))

    def parse(batches_in):
        for batch in batches_in:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = content.as_buffer()
                view = memoryview(data) if data is not None else memoryview(b"")
                at, before, last, run, rows, held = 0, 0, (), 0, [], 0
                while at < len(view):
                    key, null, n = struct.unpack_from(HEAD, view, at)
                    at += HEAD_BYTES
                    if (key, null) != last:
                        last, run = (key, null), at
                    row = (None if null else key, shard, at, run, before, n)
                    rows.append((*row, np.frombuffer(view, kind, n, at).astype("<u4").tobytes()) if ids else row)
                    held += 4 * n if ids else 50
                    at += n * id_bytes + 1
                    before += n
                    if held > 4 << 20:
                        yield common.batches(rows, out)
                        rows, held = [], 0
                if rows:
                    yield common.batches(rows, out)

    ddl = ", ".join(f"{n} long" for n in names) + (", token_ids binary" if ids else "")
    return common.map_arrow(_files(spark, path), parse, ddl)


def with_global_start(found: DataFrame, records: DataFrame) -> DataFrame:
    """Adds ``start`` to found records: ids of all records before, over all shards. The
    totals of ``records`` have one row per shard file."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = (records.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
              .withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).drop("ids"))
    return found.join(totals, "shard").withColumn("start", F.col("base") + F.col("local_start")).drop("base")


# ---------------------------------------------------------------- index

#: of each key: its first shard, the offset of its first payload there, the ids before it in that
#: shard, and the last shard that has it
ENTRY = ["shard", "offset", "local_start", "last_shard"]
INDEX = "part long, n long, seeds binary, fingerprints binary, " + ", ".join(f"{e} binary" for e in ENTRY)


def _key_hash(name: str):
    return F.xxhash64(F.col(name), F.col(name).isNull())


def _fingerprint(name: str):
    return F.shiftrightunsigned(F.xxhash64(F.lit("fingerprint"), F.col(name), F.col(name).isNull()), 32)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return (common.mixed(h.view(U64) ^ U64(0x5851F42D4C957F2D)) % U64(max(1, n // 4))).astype(np.int64)


def _slot(h: np.ndarray, seed, n: int) -> np.ndarray:
    seed = np.asarray(seed).astype(U64)
    return (common.mixed(h.view(U64) + seed * U64(0x9E3779B97F4A7C15)) % U64(n)).astype(np.int64)


def perfect_seeds(h: np.ndarray) -> np.ndarray:
    """A seed per bucket such that every key (64-bit hash, all distinct) gets
    a slot of its own in 0..n-1. Buckets of one key store their slot itself,
    as -1 - slot, once the larger ones are placed."""
    n = len(h)
    bucket = _bucket(h, n)
    order = np.argsort(bucket, kind="stable")
    first = np.searchsorted(bucket[order], np.arange(max(1, n // 4) + 1))
    size = np.diff(first)
    taken = np.zeros(n, bool)
    seeds = np.zeros(len(size), np.int32)
    for b in np.argsort(-size, kind="stable"):
        if size[b] < 2:
            break
        keys, at = h[order[first[b]:first[b + 1]]], 0
        while True:
            trial = np.arange(at, at + 64)
            slots = _slot(keys[None, :], trial[:, None], n)
            ok = ~taken[slots].any(axis=1)
            for t in np.flatnonzero(ok):
                if len(set(slots[t].tolist())) == len(keys):
                    seeds[b] = trial[t]
                    taken[slots[t]] = True
                    break
            else:
                at += 64
                continue
            break
    single = np.flatnonzero(size == 1)
    seeds[single] = -1 - np.flatnonzero(~taken)[:len(single)]
    return seeds


def slots_of(h: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    seed = seeds[_bucket(h, n)]
    return np.where(seed < 0, -1 - seed, _slot(h, np.maximum(seed, 0), n))


def build_index(records: DataFrame, part_keys: int = 50_000) -> DataFrame:
    """The index over all keys of the shards: a row per part with its seeds
    and, by slot, fingerprint and entry of the key. Part sizes follow ``part_keys``, not
    the number of keys."""
    first = F.min(F.struct("shard", "offset", "local_start"))  # one row per key and shard comes here
    keys = (records.where("offset = run_offset").groupBy("key").agg(first.alias("at"), F.max("shard").alias("last_shard"))
            .select(_key_hash("key").alias("h"), _fingerprint("key").alias("f"), "at.*", "last_shard"))
    keys = common.written(keys, "token-keys")
    parts = max(1, -(-keys.count() // part_keys))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        h = table["h"].to_numpy()
        seeds = perfect_seeds(h)
        slot = slots_of(h, seeds, len(h))

        def put(name: str) -> list[bytes]:
            by_slot = np.empty(len(h), np.int64)
            by_slot[slot] = table[name].to_numpy()
            return [by_slot.tobytes()]

        return pa.table({"part": [key[0].as_py()], "n": [len(h)], "seeds": [seeds.tobytes()], "fingerprints": put("f"),
                         **{e: put(e) for e in ENTRY}})

    common.workers_see_package(records.sparkSession)
    return keys.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(parts))).groupBy("part").applyInArrow(build, INDEX)


def lookup(index: DataFrame, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """key, shard, offset, local_start, last_shard of each distinct key that the index
    holds; a key whose slot has another fingerprint is not in it."""
    common.workers_see_package(keys.sparkSession)
    parts = index.count()
    asked = keys.select(F.col(key_col).cast("long").alias("key")).distinct().select(
        "key", _key_hash("key").alias("h"), _fingerprint("key").alias("f"))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(max(1, parts))))

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("key", *ENTRY)})
        row = {k: right[k][0].as_py() for k in right.column_names}
        got = lambda name: np.frombuffer(row[name], np.int64)
        slot = slots_of(left["h"].to_numpy(), np.frombuffer(row["seeds"], np.int32), row["n"])
        hit = got("fingerprints")[slot] == left["f"].to_numpy()
        return pa.table({"key": left["key"].filter(pa.array(hit)), **{e: got(e)[slot[hit]] for e in ENTRY}})

    return (asked.groupBy("part").cogroup(index.groupBy("part"))
            .applyInArrow(find, "key long, " + ", ".join(f"{e} long" for e in ENTRY)))


def keyed_records(spark: SparkSession, path: str, index: DataFrame, keys: DataFrame, key_col: str = "key",
                  id_bytes: int = 2) -> DataFrame:
    """key, shard, local_start, n_tokens, token_ids of every record of the given keys, read at
    the offsets that the index gives: places are grouped by shard and meet the
    shard's bytes in one task. From the place of a key its records are read on while
    they carry it, in further shards from their start. A place that holds no
    record of its key (an index of other files) is an error."""
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    found = lookup(index, keys, key_col).withColumn("first_shard", F.col("shard")).withColumn(
        "shard", F.explode(F.sequence("shard", "last_shard")))
    here = F.col("shard") == F.col("first_shard")
    places = found.select("key", "shard", here.alias("first"), F.when(here, F.col("offset")).otherwise(HEAD_BYTES).alias("offset"),
                          F.when(here, F.col("local_start")).otherwise(0).alias("local_start"))
    out = pa.schema([("key", pa.int64()), ("shard", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()),
                     ("token_ids", pa.binary())])

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        view = memoryview(right["content"][0].as_buffer()) if right.num_rows else memoryview(b"")
        rows = []
        for key, shard, first, at, start in zip(*(left[c].to_pylist() for c in ("key", "shard", "first", "offset", "local_start"))):
            mark, begun = (key or 0, key is None), False
            while at <= len(view):
                *other, n = struct.unpack_from(HEAD, view, at - HEAD_BYTES)
                if tuple(other) != mark:
                    break
                rows.append((key, shard, start, n, np.frombuffer(view, kind, n, at).astype("<u4").tobytes()))
                begun, start, at = True, start + n, at + n * id_bytes + 1 + HEAD_BYTES
            if first and not begun:
                raise ValueError(f"no record of key {key} at byte {at} of shard {shard}")
        return pa.Table.from_batches([common.batches(rows, out)])

    common.workers_see_package(spark)
    return (places.groupBy("shard").cogroup(_files(spark, path).groupBy("shard"))
            .applyInArrow(read, "key long, shard long, local_start long, n_tokens long, token_ids binary"))
