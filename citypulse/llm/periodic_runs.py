"""Periodic runs of words, found on a Re-Pair grammar of each text.

The word ids of a text are compressed by Re-Pair: a pair of neighbouring symbols
that occurs at least twice becomes a new symbol. All pairs that are more frequent
than the pairs they overlap with are replaced in one round, in all texts of a
slice at once; each replacement is noted with its place, so every rule knows all
positions it derives. What is left of a text is put under a balanced tree whose
nodes derive one position each.

A run lies inside the lowest node that holds it and crosses the boundary between
that node's two parts. So for every node, once, each period up to half its width
is tried at the boundary: a run of period q that crosses it matches, q words apart,
either at the last word left of the boundary or at the word q before the first one
right of it; matches are widened to their ends by hashes of prefixes. Runs of a rule
are translated to all positions it derives, and intervals of one period that
overlap by a period are merged: pieces cut at the edges of a rule fall into
the whole run that a higher node has. Of equal intervals the smallest period stays.

No text meets another one: one pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm import common

U64 = np.uint64
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 69069069)


def _ids(word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ids of (text, word) pairs, and how often each occurs."""
    _, ids, count = np.unique(word ^ common.mixed(doc.astype(U64) + U64(1)), return_inverse=True, return_counts=True)
    return ids.astype(np.int64), count


def repair(ids: np.ndarray, count: np.ndarray, doc: np.ndarray):
    """(rule, position) of every replacement, the boundary within each rule, and
    the word positions where the symbols left at the end start.

    ``ids``: dense ids that no two texts share. Rules are numbered from 0; the
    boundary is the number of words of a rule's left part."""
    n = len(ids)
    width = [np.ones(len(count), np.int64)]
    sym, pos = ids, np.arange(n)
    link = np.zeros(n, bool)
    often = count[ids] > 1
    link[:-1] = often[:-1] & often[1:] & (doc[:-1] == doc[1:])
    rules, places, cuts, done = [], [], [], []
    made = len(count)
    while True:
        at = np.flatnonzero(link)
        pair, which, times = np.unique((sym[at].astype(U64) << U64(32)) | sym[at + 1].astype(U64),
                                       return_inverse=True, return_counts=True)
        # a pair that occurs once stays so: its parts are never joined again
        live = times[which] > 1
        link[at[~live]] = False
        at, which = at[live], which[live]
        near = np.zeros(len(sym) + 1, bool)
        near[:-1] = link
        near[1:] |= link
        near = near[:-1]
        done.append(pos[~near])
        move = np.cumsum(near) - 1
        sym, pos, link, at = sym[near], pos[near], link[near], move[at]
        if not len(at):
            break
        rank = np.empty(len(pair), np.int64)
        rank[np.argsort(times, kind="stable")] = np.arange(1, len(pair) + 1)
        strength = np.zeros(len(sym) + 2, np.int64)  # of the pair that starts at each symbol, one place later
        strength[at + 1] = rank[which]
        own, before, after = strength[1:-1], strength[:-2], strength[2:]
        fresh = own != before
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(sym)), 0))
        even = (np.arange(len(sym)) - start) % 2 == 0  # every second of overlapping equal pairs
        win = (own > 0) & even & (own >= before) & (own >= after)
        win &= ~((own == before) & fresh)
        first = np.flatnonzero(win)
        _, rep, rule = np.unique(strength[first + 1], return_index=True, return_inverse=True)
        sizes = np.concatenate(width)
        left = sizes[sym[first[rep]]]
        rules.append(rule + made - len(count))
        places.append(pos[first])
        cuts.append(left)
        width = [sizes, left + sizes[sym[first[rep] + 1]]]
        sym[first] = rule + made
        made += len(rep)
        link[first] = link[first + 1]
        keep = np.ones(len(sym), bool)
        keep[first + 1] = False
        sym, pos, link = sym[keep], pos[keep], link[keep]
    none = np.empty(0, np.int64)
    sizes = np.concatenate(width)[len(count):]
    return (np.concatenate(rules or [none]), np.concatenate(places or [none]), np.concatenate(cuts or [none]), sizes,
            np.sort(np.concatenate(done)))


def _tree(tops: np.ndarray, doc: np.ndarray, edges: np.ndarray):
    """(start, boundary, end) of the nodes of balanced trees over the symbols
    that start at ``tops``, one tree a text (texts end at ``edges``)."""
    own = doc[tops]
    first = np.searchsorted(own, own)
    last = np.searchsorted(own, own, side="right")
    rel, here = np.arange(len(tops)) - first, np.arange(len(tops))
    starts = np.append(tops, 0)
    out, half = [], 1
    while len(rel) and half <= rel.max():
        mid = here[rel % (2 * half) == half]
        stop = mid + half
        end = np.where(stop < last[mid], starts[np.minimum(stop, len(tops))], edges[own[mid] + 1])
        out.append((tops[mid - half], tops[mid], end))
        half *= 2
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


class _Prefixes:
    """Whether stretches of words are equal, by hashes modulo two primes."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        value = common.mixed(ids.astype(U64) + U64(7))
        self.total, self.power = [], []
        for prime, base, shift in zip(_PRIMES, _BASES, (U64(1), U64(32))):
            power = np.ones(n + 1, np.int64)
            done = 1
            while done < n + 1:  # powers by doubling
                more = min(done, n + 1 - done)
                power[done:done + more] = power[:more] * (power[done - 1] * base % prime) % prime
                done += more
            term = ((value >> shift) % U64(prime)).astype(np.int64) * power[:n] % prime
            self.total.append(np.concatenate(([0], np.cumsum(term))))
            self.power.append(power)

    def same(self, a: np.ndarray, q: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the words from a and from a + q on agree over ``length``."""
        ok = np.ones(len(a), bool)
        for prime, total, power in zip(_PRIMES, self.total, self.power):
            one = (total[a + length] - total[a]) % prime * power[q] % prime
            ok &= one == (total[a + q + length] - total[a + q]) % prime
        return ok

    def longest(self, a: np.ndarray, q: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The longest agreement (at most ``most``) right of a, or left of it."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            ok = self.same(a[open_] - mid if back else a[open_], q[open_], mid)
            low[open_[ok]] = mid[ok]
            high[open_[~ok]] = mid[~ok] - 1


def _spread(many: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, 1..many of it) of every unit of some counts, by pieces of at most
    about ``limit`` units; one owner may be split over several pieces."""
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    for lo in range(0, total, limit):
        hi = min(total, lo + limit)
        a, b = np.searchsorted(ends, [lo, hi - 1], side="right")
        own = np.arange(a, b + 1)
        part = np.minimum(ends[own], hi) - np.maximum(ends[own] - many[own], lo)
        owner = np.repeat(own, part)
        yield owner, np.arange(lo, hi) - (ends[owner] - many[owner]) + 1


def crossing(ids: np.ndarray, lone: np.ndarray, lo: np.ndarray, cut: np.ndarray, hi: np.ndarray, least: int,
             prefixes: _Prefixes, limit: int = 1 << 21):
    """(node, start, end, period) of the runs of each node that cross its
    boundary, with the smallest period of each interval.

    ``lone``: words that occur once in their text, which match no other."""
    found = []
    half = (hi - lo) // 2
    need = max(1, -(-least // 2))
    for right in (False, True):
        # the words compared first: right, cut - 1 and cut - 1 + q; else cut - q and cut
        many = np.minimum(half, hi - cut) if right else np.minimum(half, cut - lo)
        many = np.where(lone[cut - 1] if right else lone[cut], 0, many)
        for node, q in _spread(many, limit):
            a = cut[node] - 1 if right else cut[node] - q
            hit = np.flatnonzero(ids[a] == ids[a + q])
            node, q, a = node[hit], q[hit], a[hit]
            if need > 1:  # a run matches at two neighbouring words at least
                up = (a + q + 1 < hi[node]) & (ids[np.minimum(a + 1, len(ids) - 1)] == ids[np.minimum(a + q + 1, len(ids) - 1)])
                down = (a > lo[node]) & (ids[np.maximum(a - 1, 0)] == ids[np.maximum(a + q - 1, 0)])
                hit = np.flatnonzero(up | down)
                node, q, a = node[hit], q[hit], a[hit]
            end = a + prefixes.longest(a, q, hi[node] - a - q, False) + q
            start = a - prefixes.longest(a, q, a - lo[node], True)
            ok = end - start >= np.maximum(least, 2 * q)
            found.append((node[ok], start[ok], end[ok], q[ok]))
    if not found:
        return [np.empty(0, np.int64)] * 4
    node, start, end, q = (np.concatenate(x) for x in zip(*found))
    return _smallest(start, end, q, node)


def _smallest(start: np.ndarray, end: np.ndarray, q: np.ndarray, node: np.ndarray | None = None):
    """Of equal intervals (of one node) that with the smallest period."""
    node = np.zeros(len(q), np.int64) if node is None else node
    order = np.lexsort((q, end, start, node))
    node, start, end, q = node[order], start[order], end[order], q[order]
    one = np.ones(len(q), bool)
    one[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[one], start[one], end[one], q[one]


def _merged(start: np.ndarray, end: np.ndarray, q: np.ndarray, words: int):
    """Maximal intervals: those of one period that overlap by a period are one."""
    if not len(q):
        return start, end, q
    order = np.lexsort((start, q))
    start, end, q = start[order], end[order], q[order]
    far = q * (words + 1)
    reach = np.maximum.accumulate(end + far)
    fresh = np.ones(len(q), bool)
    fresh[1:] = start[1:] + q[1:] + far[1:] > reach[:-1]
    head = np.flatnonzero(fresh)
    return start[head], np.maximum.reduceat(end, head), q[head]


def runs(word: np.ndarray, edges: np.ndarray, least: int = 12):
    """(text, start, length, period) of all runs, by text, start and period.

    ``word``: hashes of the words of several texts, one after another; ``edges``:
    the first word of each text, and the number of words. Starts count from the
    text's first word. A run: a stretch with smallest period q, of at least
    ``least`` and 2 q words, that no neighbouring word extends keeping period q."""
    none = [np.empty(0, np.int64)] * 4
    n = len(word)
    if n < 2:
        return none
    doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    ids, count = _ids(word, doc)
    rule, place, cut, size, tops = repair(ids, count, doc)
    lo, mid, hi = _tree(tops, doc, edges)
    # one position stands for all of a rule
    order = np.argsort(rule, kind="stable")
    rule, place = rule[order], place[order]
    first = np.searchsorted(rule, np.arange(len(size) + 1))
    shown = place[first[:-1]]
    lo, mid, hi = np.concatenate((lo, shown)), np.concatenate((mid, shown + cut)), np.concatenate((hi, shown + size))
    named = np.concatenate((np.full(len(lo) - len(size), -1), np.arange(len(size))))
    wide = hi - lo >= max(2, least)
    lo, mid, hi, named = lo[wide], mid[wide], hi[wide], named[wide]
    node, start, end, q = crossing(ids, count[ids] == 1, lo, mid, hi, least, _Prefixes(ids))
    of = named[node]
    inner = of >= 0
    times = first[of[inner] + 1] - first[of[inner]]
    owner = np.repeat(np.flatnonzero(inner), times)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    shift = place[first[of[owner]] + nth] - lo[node[owner]]
    start = np.concatenate((start[~inner], start[owner] + shift))
    end = np.concatenate((end[~inner], end[owner] + shift))
    q = np.concatenate((q[~inner], q[owner]))
    _, start, end, q = _smallest(*_merged(start, end, q, n))
    order = np.lexsort((q, start))
    start, end, q = start[order], end[order], q[order]
    text = doc[start]
    return text, start - edges[text], end - start, q


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_KIND = pa.struct([("n_words", pa.int64()), ("runs", _RUN), ("collapsed", pa.string())])
DDL = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"


def _found(data: np.ndarray, offsets: np.ndarray, least: int) -> pa.Array:
    """The result column for some texts."""
    begin, stop, edges = common.words_of(data, offsets, common.NOT_BLANK)
    text, start, length, q = runs(common.word_hashes(data, begin, stop), edges, least)
    # dropped: what a run holds after its first q words
    change = np.zeros(len(begin) + 1, np.int64)
    np.add.at(change, edges[text] + start + q, 1)
    np.add.at(change, edges[text] + start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    out = data.copy()
    show = np.zeros(len(data) + 1, np.int64)
    np.add.at(show, begin[kept], 1)
    np.add.at(show, stop[kept], -1)
    show = np.cumsum(show[:-1]) > 0
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(edges))[kept]
    later = np.zeros(len(of), bool)
    later[1:] = of[1:] == of[:-1]
    blank = begin[kept][later] - 1  # a word that is not its text's first has a blank before it
    out[blank] = 0x20
    show[blank] = True
    ends = np.concatenate(([0], np.cumsum(show)))[offsets]
    many = np.searchsorted(text, np.arange(len(offsets)))
    listed = pa.ListArray.from_arrays(pa.array(many, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (start, length, q)], ["start", "length", "period"]))
    body = pa.py_buffer(np.ascontiguousarray(out[show]))
    collapsed = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends.astype(np.int32)), body)
    return pa.StructArray.from_arrays([pa.array(np.diff(edges), pa.int64()), listed, collapsed], fields=list(_KIND))


def with_runs(docs: DataFrame, least: int = 12, text_col: str = "text", slice_bytes: int = 2 << 20) -> DataFrame:
    """The columns of ``docs`` and one, ``periodic``: struct of n_words, runs
    (structs of start, as a word number from 0, length and period, in words, by
    start and period) and collapsed (the words that no run holds after its
    first period, joined by one space).

    Words are separated by ASCII white space. A null, empty or blank text has no
    words, no runs and an empty collapsed text. Runs that overlap or nest are all
    given; equal intervals count once, with the smallest period. Repeated rows
    and ids are rows of their own; an empty table gives no rows. The new column
    gets a free name if the input has a ``periodic``. Bytes that are not valid
    UTF-8 are replaced by U+FFFD first. A text of any length is worked on whole,
    in memory of about 100 bytes a byte of text; shorter ones in
    slices of ``slice_bytes``. Words are told apart by 64-bit hashes."""
    names, mark, body = docs.columns, common.own_column(docs, "periodic"), common.own_column(docs, "text_")
    whole = docs.select("*", common.text_of(text_col).alias(body))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{mark}` {DDL}"])

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            for part in common.by_bytes(batch, body, slice_bytes):
                column = _found(*common.text_bytes(part.column(body)), least)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), column], [*names, mark])

    return common.map_arrow(whole, run, schema)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a periodic end in a tenth of the texts, chosen by the checksum
    h of the id, h % 10 = 0: with g = h div 10 and n words, each word i from a = g % n
    on becomes word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). Other texts, those
    without words and those with a null id stay; null texts stay null."""
    h, word, many = (common.own_column(docs, x) for x in ("h_", "words_", "n_"))
    sum_of = F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))
    split = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    chosen = F.coalesce(F.col(h) % 10 == 0, F.lit(False))
    out = (docs.withColumn(h, sum_of).withColumn(word, F.when(chosen, split)).withColumn(many, F.size(F.coalesce(word, F.array()))))
    g = F.floor(F.col(h) / 10)
    a = F.pmod(g, F.col(many))
    p = F.lit(1) + F.floor((F.col(many) - a) / (3 + g % 8))
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    changed = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.col(many) - 1), lambda i: F.get(F.col(word), place(i))))
    return out.select(*[F.when(F.col(many) > 0, changed).otherwise(F.col(c)).alias(c) if c == text_col else F.col(f"`{c}`")
                        for c in docs.columns])
