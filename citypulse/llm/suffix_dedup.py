"""Removal of long strings that documents with smaller ids have too, by
threshold-bounded interval expansion on a Burrows-Wheeler transform.

A string of ``size`` bytes belongs to the least hash of its 24-byte pieces; a
text falls into segments of successive strings with one such value. Equal
strings have equal values, wherever they are, so segments can be compared part
by part, by value:

1. blocks of documents send the values they have; parts answer which occur in
   several documents;
2. blocks send each distinct segment with such a value once, with the smallest
   document that has it;
3. parts order the suffixes of the segments that share a value but differ,
   take the Burrows-Wheeler transform, and find all common-prefix lengths below
   ``size`` in increasing order: intervals of suffixes with a common prefix are
   extended backward, breadth first; level l sets the boundaries where
   neighbours share l bytes, and intervals that set none are not
   extended further. The search stops at ``size``: runs without a boundary
   are the suffixes that share ``size`` bytes. Their least document goes back;
4. blocks mark and remove what a smaller document has.

A value, however common, reaches its part once per block, and a segment once per
distinct content and block. The numbers of blocks and parts follow the bytes of the texts. A
value with more than ``most_segments`` segments (a passage's edge, next to which every document
has other text) does not go to one part whole: its strings are dealt one by one, by
the hash of all their bytes, so that equal strings still meet, and no part holds the rest.

Texts are shuffled by block three times; the shuffles of a step go when its table is
written, and its tables when nothing reads them any more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm import common

U64 = np.uint64
PIECE = 24
NOBODY = np.iinfo(np.int64).max
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 1 << 64)
_TABLE = common.mixed(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


class _Sums:
    """Polynomial hashes of any substring of some bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.concatenate(([U64(1)], np.cumprod(np.full(n, _BASE, U64), dtype=U64)))
        self.back = np.concatenate(([U64(1)], np.cumprod(np.full(n, _BACK, U64), dtype=U64)))
        self.total = np.concatenate(([U64(0)], np.cumsum(_TABLE[data] * power[:n], dtype=U64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return common.mixed((self.total[end] - self.total[start]) * self.back[start])


def least_of_each(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` successive entries, from the running minima
    of blocks of that width in both directions."""
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    block = np.full(rows * width, np.iinfo(x.dtype).max, x.dtype)
    block[:len(x)] = x
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, size: int):
    """(value, start, number of strings, hash, text) of the segments of texts, and
    the hashes of their substrings."""
    none = np.empty(0, np.int64)
    if len(data) < size:
        return none.astype(U64), none, none, none.astype(U64), none, None
    sums = _Sums(data)
    at = np.arange(len(data) - PIECE + 1)
    value = least_of_each(sums.of(at, at + PIECE), size - PIECE + 1)
    lens = np.diff(offsets)
    text = np.repeat(np.arange(len(lens)), lens)[:len(value)]
    ok = text == np.repeat(np.arange(len(lens)), lens)[size - 1:]  # the string ends in its text
    fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1])) & ok
    stop = np.concatenate((~ok[1:] | fresh[1:], [True])) & ok
    start, last = np.flatnonzero(fresh), np.flatnonzero(stop)
    many = last - start + 1
    return value[start], start, many, sums.of(start, last + size) + many.astype(U64), text[start], sums


def _spread(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (``many`` of them) of each entry."""
    return np.arange(int(many.sum())) + np.repeat(start - (np.cumsum(many) - many), many)


def suffix_order(text: np.ndarray, size: int) -> np.ndarray:
    """Positions ordered by at least their next ``size`` symbols (0..256),
    by doubling the compared length."""
    n = len(text)
    key = np.zeros(n, U64)
    for k in range(7):
        key[:n - k] |= text[k:].astype(U64) << U64(9 * (6 - k))
    reach = 7
    while True:
        order = np.argsort(key)
        if reach >= size:
            return order
        ranked = key[order]
        rank = np.empty(n, U64)
        rank[order] = np.cumsum(np.concatenate(([1], ranked[1:] != ranked[:-1]))).astype(U64)
        key = rank << U64(32)
        key[:n - reach] |= rank[reach:]
        reach *= 2


def boundaries(text: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    """Whether each suffix, in order, begins a run of suffixes that share
    ``size`` symbols. Text: 0 separates, and stands first."""
    n = len(text)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int32)
    lf[by_symbol] = np.arange(n, dtype=np.int32)
    same = bwt[by_symbol][1:] == bwt[by_symbol][:-1]
    later, earlier = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    later[by_symbol[:-1][same]] = by_symbol[1:][same]
    earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
    found = np.zeros(n + 1, bool)
    found[0] = True
    left, right = np.array([0], np.int32), np.array([n], np.int32)
    for _ in range(size):
        width = right - left
        total = int(width.sum())
        if not total:
            break
        place = np.repeat((left - (np.cumsum(width) - width)).astype(np.int32), width)
        place += np.arange(total, dtype=np.int32)
        real = bwt[place] != 0
        ends = lf[place[(later[place] >= np.repeat(right, width)) & real]] + 1
        starts = lf[place[(earlier[place] < np.repeat(left, width)) & real]]
        ends.sort()
        starts.sort()  # both list the same disjoint intervals
        new = ~found[ends]
        found[ends] = True
        left, right = starts[new], ends[new]
    return found[:n]


def least_documents(lengths: np.ndarray, data: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """For each string of ``size`` bytes of some segments (all of them, one
    after another), the least ``doc`` of a segment that has the string."""
    end = np.cumsum(lengths)
    shift = np.arange(len(lengths)) + 1
    text = np.zeros(len(data) + len(lengths) + 1, np.int16)
    where = np.arange(len(data)) + np.repeat(shift, lengths)
    text[where] = data.astype(np.int16) + 1
    first = end - lengths + shift
    many = lengths - size + 1
    strings = np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)
    order = suffix_order(text, size)
    run = np.cumsum(boundaries(text, order, size)) - 1
    of_place = np.empty(len(text), np.int32)
    of_place[order] = run
    of_string = of_place[strings]
    least = np.full(int(run[-1]) + 1, NOBODY)
    np.minimum.at(least, of_string, np.repeat(doc, many))
    return least[of_string]


def _gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return data[np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)]


def _block(table: pa.Table, size: int):
    """(row slice, its bytes, offsets, segments, document of each segment) by
    slices of about 1 MB."""
    for batch in table.combine_chunks().to_batches():
        for part in common.by_bytes(batch, "text", 1 << 20):
            data, offsets = common.text_bytes(part.column("text"))
            found = segments(data, offsets, size)
            doc = part.column("doc").fill_null(NOBODY).to_numpy()
            yield part, data, offsets, found, doc[found[4]]


def _firsts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order of the values, where each distinct one begins in it)."""
    order = np.argsort(x)
    x = x[order]
    return order, np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else order


def _one_each(name: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an entry of each distinct name, the least doc of that name)."""
    order, first = _firsts(name)
    return order[first], np.minimum.reduceat(doc[order], first) if len(doc) else doc


def _squeezed(data: np.ndarray) -> np.ndarray:
    """Compressed bytes, led by their length (segments overlap a lot)."""
    return np.concatenate((np.array([len(data)], np.int64).view(np.uint8), np.frombuffer(pa.compress(data, "zstd", asbytes=True), np.uint8)))


def _restored(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(pa.decompress(r[8:], int.from_bytes(r[:8], "little"), "zstd", asbytes=True) for r in rows), np.uint8)


def _dealt(part: np.ndarray, parts: int):
    order = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(parts + 1))
    return [(p, order[edge[p]:edge[p + 1]]) for p in np.flatnonzero(np.diff(edge)).tolist()]


def _all(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _binary(rows: list, names: list[str]) -> pa.Table:
    """A table of rows of two numbers and then arrays, packed."""
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.table({n: pa.array([x if i < 2 else x.tobytes() for x in c], pa.int64() if i < 2 else pa.binary())
                     for i, (n, c) in enumerate(zip(names, columns))})


def _without(data: np.ndarray, edges: list[int]) -> str:
    """The text without the spans; a character that a span cuts goes whole."""
    keep, inner = np.ones(len(data), bool), (data & 0xC0) == 0x80  # bytes inside a character
    for a, b in zip(edges[::2], edges[1::2]):
        while a and inner[a]:
            a -= 1
        while b < len(data) and inner[b]:
            b += 1
        keep[a:b] = False
    return data[keep].tobytes().decode()


def deduplicated(docs: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = 8 << 20, part_bytes: int = 4 << 20, most_segments: int = 50_000) -> DataFrame:
    """The columns of ``docs`` and one, ``dedup``: struct of n_bytes,
    n_removed, n_spans (maximal removed runs), spans (byte start and end of
    each), kept (the remaining bytes) and text (where something goes, the
    remaining text: a character that is cut goes whole).

    A byte goes if a string of ``size`` bytes that covers it also starts in a
    document with a smaller id. Matches lie within documents; overlaps count. A
    null text has no bytes. A null id counts as larger than all others, and equal ids
    as neither larger nor smaller. Shorter texts stay whole. Strings and
    segments are told apart by their bytes within a part; which segments are
    equal, and strings of a value with over ``most_segments`` segments, by 64-bit hashes. An empty table gives no rows. The new column gets a
    free name if the input has a ``dedup``.
    """
    spark = docs.sparkSession
    common.workers_see_package(spark)
    total = docs.agg(F.sum(F.octet_length(common.text_of(text_col)))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    parts = max(4, -(-total // part_bytes))
    block = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(blocks)).alias("block")
    source = docs.select(block, F.col(id_col).cast("long").alias("doc"), common.text_of(text_col).alias("text"))

    def values(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = [(s[0], d, s[3]) for _, _, _, s, d in _block(table, size)]
        value, doc, name = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((name, value))
        value, doc, name = value[order], doc[order], name[order]
        first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else order
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first) if len(doc) else np.empty(0, bool)
        fresh = np.concatenate(([1], (name[1:] != name[:-1]) | (value[1:] != value[:-1])))[:len(value)]
        # 0: one document has the value; else the number of its distinct segments, up to what two bytes hold
        weight = np.minimum(np.add.reduceat(fresh.astype(np.int64), first), 65535) if len(value) else order
        weight = np.where(several, weight, 0).astype(np.uint16)
        value = value[first]
        return _binary([(p, key[0].as_py(), value[own], weight[own]) for p, own in
                        _dealt((value % U64(parts)).astype(np.int64), parts)], ["part", "block", "values", "weights"])

    def shared(table: pa.Table) -> pa.Table:
        value, weight = _all(table, "values", U64), _all(table, "weights", np.uint16).astype(np.int64)
        order, first = _firsts(value)
        many = np.diff(np.append(first, len(value)))
        hit, heavy = np.empty(len(value), bool), np.empty(len(value), bool)
        total = np.add.reduceat(np.maximum(weight, 1)[order], first) if len(value) else first
        hit[order] = np.repeat((np.maximum.reduceat(weight[order], first) > 0) | (many > 1), many) if len(value) else hit
        heavy[order] = np.repeat(total > most_segments, many)
        at, rows = 0, []
        for p, b, raw in zip(table["part"].to_pylist(), table["block"].to_pylist(), table["values"].to_pylist()):
            own = np.arange(at, at + len(raw) // 8)
            at += len(own)
            own = own[hit[own]]
            rows.append((p, b, value[own], heavy[own]))
        return _binary([r for r in rows if len(r[2])], ["part", "block", "values", "heavy"])

    asked = source.groupBy("block").applyInArrow(values, "part long, block long, values binary, weights binary")
    common_values = common.written(asked.groupBy("part").applyInArrow(
        shared, "part long, block long, values binary, heavy binary"), "dedup-values")

    columns = ["part", "block", "values", "hashes", "docs", "lengths", "data", "cut"]

    def distinct(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _binary([], columns)
        known, heavy = _all(right, "values", U64), _all(right, "heavy", bool)
        order = np.argsort(known)
        known, heavy = known[order], heavy[order]
        found, cut = [], [np.empty(0, U64)]
        for _, data, _, (value, start, many, name, _, sums), doc in _block(left, size):
            at = np.minimum(np.searchsorted(known, value), len(known) - 1)
            hit = np.flatnonzero(known[at] == value)
            own, doc = _one_each(name[hit], doc[hit])
            own = hit[own]
            split = heavy[at[own]]
            length = many[own] + size - 1
            found.append((value[own][~split], name[own][~split], doc[~split], length[~split],
                          _gathered(data, start[own][~split], length[~split])))
            if split.any():  # each string for itself, known by its hash
                cut.append(name[own][split])
                places = _spread(start[own][split], many[own][split])
                names = sums.of(places, places + size) + U64(1)
                found.append((names, names, np.repeat(doc[split], many[own][split]), np.zeros(len(names), np.int64), np.empty(0, np.uint8)))
        value, name, doc, length, data = (np.concatenate(x) for x in zip(*found))
        start = np.cumsum(length) - length
        own, doc = _one_each(name, doc)
        value, name, length, start = value[own], name[own], length[own], start[own]
        b = left["block"][0].as_py()
        none = np.empty(0, U64)
        rows = [(p, b, value[x], name[x], doc[x], length[x], _squeezed(_gathered(data, start[x], length[x])), none) for p, x in
                _dealt((value % U64(parts)).astype(np.int64), parts)]
        if len(cut) > 1:  # the block is told again which segments are split
            rows.append((b % parts, b, none, none, none.astype(np.int64), none.astype(np.int64), _squeezed(np.empty(0, np.uint8)),
                         np.unique(np.concatenate(cut))))
        return _binary(rows, columns)

    sent = source.groupBy("block").cogroup(common_values.groupBy("block")).applyInArrow(
        distinct, "part long, block long, values binary, hashes binary, docs binary, lengths binary, data binary, cut binary")

    def least(table: pa.Table) -> pa.Table:
        value, name, doc, length = (_all(table, c, t) for c, t in (
            ("values", U64), ("hashes", U64), ("docs", np.int64), ("lengths", np.int64)))
        data = _restored(table["data"].to_pylist())
        rows, at = [], 0
        for b, raw in zip(table["block"].to_pylist(), table["cut"].to_pylist()):
            if raw:
                rows.append((b, 1, np.frombuffer(raw, U64), np.empty(0, np.int64), np.empty(0, np.int64)))
        if not len(value):
            return _binary(rows, ["block", "cut", "hashes", "counts", "lowest"])
        start = np.cumsum(length) - length
        order = np.lexsort((doc, name, value))
        fresh = np.concatenate(([True], name[order][1:] != name[order][:-1]))
        one = order[fresh]  # distinct segments, each with its least document
        number = np.empty(len(name), np.int64)
        number[order] = np.cumsum(fresh) - 1
        alone = np.bincount(np.cumsum(np.concatenate(([True], value[one][1:] != value[one][:-1]))) - 1)
        varied = np.repeat(alone, alone) > 1  # a segment that alone has its value has nothing to be compared with
        varied &= length[one] > 0
        many = np.maximum(length[one] - size, 0) + 1
        begin = np.cumsum(many) - many
        lowest = np.repeat(doc[one], many)
        if varied.any():
            chosen = one[varied]
            inside = np.repeat(varied, many)
            lowest[inside] = least_documents(length[chosen], _gathered(data, start[chosen], length[chosen]), doc[chosen], size)
        flat = np.minimum.reduceat(lowest, begin) == np.maximum.reduceat(lowest, begin)
        for b, raw in zip(table["block"].to_pylist(), table["hashes"].to_pylist()):
            if not raw:
                continue
            own = number[at:at + len(raw) // 8]
            at += len(raw) // 8
            size_of = np.where(flat[own], 1, many[own])
            rows.append((b, 0, name[at - len(own):at], size_of, _gathered(lowest, begin[own], size_of)))
        return _binary(rows, ["block", "cut", "hashes", "counts", "lowest"])

    answers = sent.groupBy("part").applyInArrow(least, "block long, cut long, hashes binary, counts binary, lowest binary")
    answers = common.written(answers, "dedup-answers")
    common.dropped(common_values)

    names, own_name = docs.columns, common.own_column(docs, "dedup")
    block_name, text_name, doc_name = (common.own_column(docs, x) for x in ("block_", "text_", "doc_"))
    whole = docs.select("*", block.alias(block_name), F.col(id_col).cast("long").alias(doc_name), common.text_of(text_col).alias(text_name))
    kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                      ("spans", pa.list_(pa.int64())), ("kept", pa.binary()), ("text", pa.string())])

    def removed(left: pa.Table, right: pa.Table) -> pa.Table:
        cut = np.sort(_all(right.filter(pc.equal(right["cut"], 1)), "hashes", U64))
        right = right.filter(pc.equal(right["cut"], 0))
        hashes, counts, lowest = (_all(right, c, t) for c, t in (("hashes", U64), ("counts", np.int64), ("lowest", np.int64)))
        order = np.argsort(hashes)
        hashes, begin, counts = hashes[order], (np.cumsum(counts) - counts)[order], counts[order]
        rows = []
        view = left.select([doc_name, text_name]).rename_columns(["doc", "text"])
        for part, data, offsets, (value, start, many, name, text, sums), doc in _block(view, size):
            gone = np.zeros(len(data) + 1, np.int64)
            if len(cut) and len(name):  # split segments: their strings in their place
                split = np.flatnonzero(cut[np.minimum(np.searchsorted(cut, name), len(cut) - 1)] == name)
                places = _spread(start[split], many[split])
                start, doc = np.append(start, places), np.append(doc, np.repeat(doc[split], many[split]))
                name = np.append(name, sums.of(places, places + size) + U64(1))
                many = np.append(many, np.ones(len(places), np.int64))
            if len(hashes) and len(name):
                at = np.minimum(np.searchsorted(hashes, name), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == name)
                at = at[hit]
                place = _spread(np.zeros(len(hit), np.int64), many[hit])
                low = lowest[np.repeat(begin[at], many[hit]) + np.where(np.repeat(counts[at], many[hit]) == 1, 0, place)]
                bad = (np.repeat(start[hit], many[hit]) + place)[np.repeat(doc[hit], many[hit]) > low]
                np.add.at(gone, bad, 1)
                np.add.at(gone, bad + size, -1)
            out = np.cumsum(gone[:-1]) > 0
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                edge = np.flatnonzero(np.diff(np.concatenate(([0], out[a:b].view(np.int8), [0]))))
                rows.append({"n_bytes": b - a, "n_removed": int(out[a:b].sum()), "n_spans": len(edge) // 2, "spans": edge.tolist(),
                             "kept": data[a:b][~out[a:b]].tobytes(), "text": _without(data[a:b], edge.tolist()) if len(edge) else None})
        return left.select(names).append_column(own_name, pa.array(rows, kind))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return whole.groupBy(block_name).cogroup(answers.groupBy("block")).applyInArrow(
        removed, f"{schema}, `{own_name}` struct<n_bytes:long,n_removed:long,n_spans:long,spans:array<long>,kept:binary,text:string>")


def without_repeats(docs: DataFrame, size: int = 50, text_col: str = "text", **more) -> DataFrame:
    """``docs`` with repeated strings cut out of the texts (a cut character is
    dropped whole); documents of which nothing but blanks is left go, if
    something was cut. Columns as before."""
    found = deduplicated(docs, size, text_col=text_col, **more)
    mark = F.col(found.columns[-1])
    text = F.coalesce(mark["text"], F.col(text_col))
    keep = (mark["n_removed"] == 0) | F.regexp_like(mark["text"], F.lit(r"\S"))
    return found.where(keep).select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
