"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the test items. Training texts are
streamed through it, word by word; at each word it knows the longest run,
ending there, that occurs in some item. Where that run has ``window`` words or
more, its last ``window`` words are hit (so the hit words are the union of all
item windows that occur); an item of fewer words is a window as a whole.
"""

from __future__ import annotations

import itertools
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm import common

# Words: runs of ASCII digits, ASCII letters (lower-cased) and everything beyond ASCII.
_TO_WORD = bytearray(b" " * 128 + bytes(range(128, 256)))
_TO_WORD[0x30:0x3A] = range(0x30, 0x3A)
_TO_WORD[0x61:0x7B] = range(0x61, 0x7B)
_TO_WORD[0x41:0x5B] = range(0x61, 0x7B)
TO_WORD = bytes(_TO_WORD)
_WORD = re.compile(rb"[^ ]+")


def split_words(text: str | None) -> list[bytes]:
    """The words of a text; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_WORD).split()


class Automaton:
    """A suffix automaton over the word runs of a block of items.

    Nearly all states have one way on, so a state is a row of flat arrays (its
    first word and where that leads, link, length, state of its window, first item).
    Further ways are in dictionaries while it grows and in sorted arrays afterwards."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.word, self.to = array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}  # state -> its ways but the first
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.names: list[str] = []
        coded = []
        for name, ws in items:
            if ws:
                self.names.append(name)
                coded.append(array("i", [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]))
        for ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        states = range(len(self.link))
        #: state -> state that holds the last ``window`` words of its runs
        self.full = array("i", [self._holding(v, window) if self.length[v] >= window else -1 for v in states])
        self.found = array("i", [-1]) * len(states)  # that state -> its first item
        self.others: dict[int, set[int]] = {}  # that state -> its further items
        shorter: dict[int, list[tuple[int, int]]] = {}
        for item, ws in enumerate(coded):
            state = 0
            for i, w in enumerate(ws):
                state = self._next(state, w)
                if i + 1 >= window:
                    at = self.full[state]
                    if self.found[at] < 0:
                        self.found[at] = item
                    elif self.found[at] != item:
                        self.others.setdefault(at, set()).add(item)
            if len(ws) < window:
                shorter.setdefault(self._holding(state, len(ws)), []).append((len(ws), item))
        #: state -> short items that its runs end with, as (words, item)
        self.short: dict[int, list[tuple[int, int]]] = {}
        if shorter:
            for v in states:
                u, ends = v, []
                while u > 0:
                    ends += shorter.get(u, [])
                    u = self.link[u]
                if ends:
                    self.short[v] = ends
        self.least = min([window, *map(len, coded)])
        #: the ways of the root, by word; those of other states but the first: words of state v
        #: from begin[v] to begin[v + 1], ascending
        self.root = array("i", [self._next(0, w) for w in range(len(self.vocabulary))])
        self.begin, self.ways, self.targets = array("i", [0, 0]), array("i"), array("i")
        for v in states[1:]:
            ways = sorted(self.more.pop(v, {}).items())
            self.ways.extend(w for w, _ in ways)
            self.targets.extend(t for _, t in ways)
            self.begin.append(len(self.ways))
        self.more = {}

    def _next(self, v: int, w: int) -> int:
        """Where ``w`` leads from v; -1 if nowhere."""
        if self.word[v] == w:
            return self.to[v]
        return self.more[v].get(w, -1) if v in self.more else -1

    def _lead(self, v: int, w: int, target: int) -> None:
        if self.word[v] in (-1, w):
            self.word[v], self.to[v] = w, target
        else:
            self.more.setdefault(v, {})[w] = target

    def _state(self, link: int, length: int) -> int:
        for column, value in ((self.word, -1), (self.to, 0), (self.link, link), (self.length, length)):
            column.append(value)
        return len(self.link) - 1

    def _extend(self, last: int, w: int) -> int:
        """Append a word to the run at ``last``."""
        link, length = self.link, self.length
        q = self._next(last, w)
        if q >= 0:
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = self._state(0, length[last] + 1)
        p = last
        while p != -1 and self._next(p, w) < 0:
            self._lead(p, w, new)
            p = link[p]
        if p != -1:
            q = self._next(p, w)
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.link[q], self.length[p] + 1)
        self.word[copy], self.to[copy] = self.word[q], self.to[q]
        if q in self.more:
            self.more[copy] = dict(self.more[q])
        self.link[q] = copy
        while p != -1 and self._next(p, w) == q:
            self._lead(p, w, copy)
            p = self.link[p]
        return copy

    def _holding(self, v: int, size: int) -> int:
        """The state on the suffix path of v that holds the run of ``size`` words."""
        while self.length[self.link[v]] >= size:
            v = self.link[v]
        return v

    def match(self, text_words: list[bytes]) -> tuple[np.ndarray | None, set[str], int]:
        """(which words are hit or None, items met, longest run)."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in text_words), np.int64, len(text_words))
        known = np.concatenate(([False], ids >= 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        word, to, root, begin, ways, targets = self.word, self.to, self.root, self.begin, self.ways, self.targets
        link, length, least = self.link, self.length, self.window
        hit, items, longest = None, set(), 0
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a < self.least:
                continue
            v = size = 0
            for i, w in enumerate(ids[a:b].tolist(), int(a)):
                while v:
                    if word[v] == w:
                        v = to[v]
                        break
                    k = bisect_left(ways, w, begin[v], begin[v + 1])
                    if k < begin[v + 1] and ways[k] == w:
                        v = targets[k]
                        break
                    v = link[v]
                    size = length[v]
                else:
                    v = root[w]  # every known word leads somewhere from the root
                size += 1
                if size > longest:
                    longest = size
                ends = [(n, item) for n, item in self.short.get(v, ()) if n <= size] if self.short else []
                if size >= least:
                    at = self.full[v]
                    items.add(self.found[at])
                    items |= self.others.get(at, set())
                    ends.append((least, None))
                if ends:
                    if hit is None:
                        hit = np.zeros(len(text_words), bool)
                    hit[i + 1 - max(n for n, _ in ends):i + 1] = True
                    items |= {item for _, item in ends if item is not None}
        return hit, {self.names[item] for item in items}, longest

    def clean(self, text: str) -> str:
        """The text without hit spans, again until nothing is hit."""
        while True:
            hit, _, _ = self.match(split_words(text))
            if hit is None:
                return text
            text = without(text, hit)


def without(text: str, hit: np.ndarray) -> str:
    """The text without hit spans (each from its first word's first to its last
    word's last character)."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw.translate(TO_WORD))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    at, kept = 0, []
    for a, b in zip(edges[::2], edges[1::2]):
        kept.append(raw[at:places[a][0]])
        at = places[b - 1][1]
    kept.append(raw[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """Items in blocks of at most ``block_bytes`` of text (one item at
    least), streamed through the driver block by block."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.make_valid_utf8(F.col(text_col).cast("string")).alias("t"))
    block, held = [], 0
    for row in rows.toLocalIterator():
        size = len(row["t"] or "")
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append(("null" if row["i"] is None else row["i"], split_words(row["t"])))
        held += size
    if block:
        yield block


KIND = ("struct<n_words:long,n_hit:long,items:array<string>,longest:long,hit:binary,clean_text:string,"
        "left:binary>")
FIELDS = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                    ("longest", pa.int64()), ("hit", pa.binary()), ("clean_text", pa.string()), ("left", pa.binary())])


def _either(packed: bytes | None, hit: np.ndarray | None) -> np.ndarray | None:
    if not packed:
        return hit
    past = np.frombuffer(packed, bool)
    return past if hit is None else hit | past


def _packed(hit: np.ndarray | None) -> bytes | None:
    return None if hit is None else hit.tobytes()


def _each(df: DataFrame, names: list[str], text: str, out: str, row) -> DataFrame:
    """``df`` with the struct ``out`` that ``row`` makes of a text and the struct so far."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in names) + f", `{out}` {KIND}"

    def run(batches_in):
        for batch in batches_in:
            for part in common.by_bytes(batch, text):
                before = part.column(out).to_pylist() if out in part.schema.names else [None] * part.num_rows
                rows = [row(t, old) for t, old in zip(part.column(text).to_pylist(), before)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(rows, FIELDS)], names=[*names, out])

    return common.map_arrow(df, run, schema)


def _judged(automaton, cleaned: bool):
    """The struct of a text after one more automaton; ``cleaned``: it is the only one."""
    def row(t, old):
        ws = split_words(t)
        hit, items, longest = automaton.value.match(ws)
        if old:
            items, longest, hit = items | set(old["items"]), max(longest, old["longest"]), _either(old["hit"], hit)
        clean = automaton.value.clean(t) if cleaned and hit is not None else t if cleaned else None
        return {"n_words": len(ws), "n_hit": 0 if hit is None else int(hit.sum()), "items": sorted(items),
                "longest": longest, "hit": _packed(hit), "clean_text": clean, "left": None}

    return row


def matched(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", cleaned: bool = False,
            block_bytes: int = 8 << 20) -> DataFrame:
    """The columns of ``docs`` and one, ``match``: struct of n_words, n_hit,
    items (ids as text, sorted), longest (words of the longest run found), hit (a byte a word) and,
    if asked, clean_text: without the hit spans, and again where words that
    met by the cut are hit, until nothing is.

    Items are broadcast as an automaton of at most ``block_bytes`` of text (an
    item at least; 8 MB take about 70 MB in a process, 200 MB on the driver while it is built). A larger benchmark is met block by block, each
    a pass over a written table, so that a process holds one automaton; every round of
    cutting cuts what any block hits, so results do not depend on the blocks, and
    takes only the documents that the round before has cut. Null and empty texts have no words; a null item id
    is called "null"; repeated items and documents count for themselves; an
    empty benchmark hits nothing. Bytes of a text that are not valid UTF-8 become
    U+FFFD first, in the text column too. The new column gets a free name if the
    input has a ``match``.
    """
    out, names, sc = common.own_column(docs, "match"), docs.columns, docs.sparkSession.sparkContext
    text = docs.schema[text_col]
    df = docs.withColumn(text_col, F.make_valid_utf8(F.col(text_col).cast("string")).cast(text.dataType))
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return _each(df, names, text.name, out, _judged(sc.broadcast(Automaton(first, window)), cleaned))

    def through(df: DataFrame, blocks, row_of) -> DataFrame:
        for block in blocks:
            automaton = sc.broadcast(Automaton(block, window))
            after = common.written(_each(df, names, text.name, out, row_of(automaton)), "matched")
            automaton.destroy()  # nothing reads it any more: the table is written
            common.dropped(df)
            df = after
        return df

    def still_hit(automaton):
        return lambda t, old: {**old, "left": _packed(_either(old["left"], automaton.value.match(split_words(old["clean_text"]))[0]))}

    def cut(t, old):
        mask = _either(old["left"] or old["hit"], None)
        return {**old, "clean_text": without(old["clean_text"] if old["left"] else t, mask), "left": None}

    found = through(df, itertools.chain([first, second], blocks), lambda automaton: _judged(automaton, False))
    if not cleaned:
        return found
    mark = F.col(out)
    done = found.where(mark["hit"].isNull()).withColumn(out, mark.withField("clean_text", F.col(text_col).cast("string")))
    todo = found.where(mark["hit"].isNotNull())
    while todo.take(1):
        todo = common.written(_each(todo, names, text.name, out, cut), "matched")
        todo = through(todo, item_blocks(benchmark, item_col, item_text_col, block_bytes), still_hit)
        done, todo = done.unionAll(todo.where(mark["left"].isNull())), todo.where(mark["left"].isNotNull())
    return done


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, most_coverage: float = 0.5,
                   text_col: str = "text", **more) -> DataFrame:
    """``docs`` without benchmark passages: hit spans are cut out of the
    texts, and documents of whose words more than ``most_coverage`` are hit go.
    Columns as before; see ``matched`` for odd input."""
    found = matched(docs, benchmark, window, text_col, cleaned=True, **more)
    name = found.columns[-1]
    mark = F.col(name)
    keep = mark["n_hit"] <= most_coverage * mark["n_words"]
    return found.where(keep).withColumn(text_col, mark["clean_text"].cast(docs.schema[text_col].dataType)).drop(name)
