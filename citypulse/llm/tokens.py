"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import gc
import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa

from citypulse.llm import common

# Kinds of bytes. Where two of the first three meet, a token surely ends.
LETTER, DIGIT, MARK, APOSTROPHE, OTHER, UNSURE, SPACE, LINE_FEED = range(8)
_KIND = np.full(256, UNSURE, np.uint8)
_KIND[0x21:0x7F] = MARK
_KIND[0x30:0x3A] = DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = LETTER
_KIND[0x27], _KIND[0x20], _KIND[0x0A] = APOSTROPHE, SPACE, LINE_FEED
#: leads of two-byte characters; À to ÿ but for × and ÷ are letters, from Ā on none is blank
_LATIN, _TWO_BYTES, _NO_LETTERS = 0xC3, (0xC4, 0xDF), (0x97, 0xB7)
#: longer pieces (in characters) are not worth remembering
LONG = 32
_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where pieces begin, and the end of the texts.

    A piece begins with each text; where letters, digits and ASCII marks meet;
    and before a lone space and before and after a lone line feed between
    characters that are surely not blank. Apostrophes are left where they are."""
    size = len(raw)
    kind = _KIND[raw]
    latin = np.flatnonzero(raw == _LATIN)
    latin = latin[~np.isin(raw[latin + 1], _NO_LETTERS)]
    kind[latin] = kind[latin + 1] = LETTER
    other = np.flatnonzero((raw >= _TWO_BYTES[0]) & (raw <= _TWO_BYTES[1]))
    kind[other] = kind[other + 1] = OTHER
    begin = np.zeros(size + 1, bool)
    begin[1:-1] = (kind[1:] != kind[:-1]) & (np.maximum(kind[1:], kind[:-1]) <= MARK)
    blank = np.flatnonzero(kind >= SPACE)
    blank = blank[(blank > 0) & (blank < size - 1)]
    blank = blank[(kind[blank - 1] <= OTHER) & (kind[blank + 1] <= OTHER)]
    begin[blank] = True
    begin[blank[kind[blank] == LINE_FEED] + 1] = True
    begin[offsets] = True
    return np.flatnonzero(begin)


class Encoder:
    """Encodes texts with the tokenizers library, remembering pieces.

    Texts are cut where the vocabulary's pre-tokeniser surely ends a token
    (see ``cuts``), so each piece can be encoded by itself, with equal ids. The
    ids of up to ``most`` pieces are remembered; each batch looks up its
    distinct pieces only.

    ``added``: the strings of the vocabulary's added tokens stand for those tokens,
    as they do in the library unless told otherwise; otherwise they are
    ordinary text. Each is then a piece of its own, and texts are cut on both
    sides of it first. If the vocabulary has added tokens that depend on what
    is around them, texts with any of them stay whole.
    """

    def __init__(self, path: str, most: int = 900_000, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        tokens = [t for t in tokens if t.content and (added or not t.special)]
        self.added = sorted({t.content.encode() for t in tokens}, key=len, reverse=True)
        self.any_added = re.compile(b"|".join(map(re.escape, self.added)))
        self.alone = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in tokens)
        self.memory: dict[str, bytes] = {}  # ids as little-endian 32-bit integers
        self.most = most

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of some distinct pieces."""
        ids = list(map(self.memory.get, pieces))
        new = [at for at, i in enumerate(ids) if i is None]
        if new:
            found = self.tokenizer.encode_batch_fast([pieces[at] for at in new], add_special_tokens=False)
            for at, e in zip(new, found):
                ids[at] = array("I", e.ids).tobytes()
            self.memory.update((pieces[at], ids[at]) for at in new if len(pieces[at]) <= LONG)
            if len(self.memory) > self.most:  # the first ones met are the frequent ones
                self.memory = dict(islice(self.memory.items(), self.most // 2))
        return ids

    def _around_added(self, raw: np.ndarray, offsets: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """``edges``, with added tokens cut out whole."""
        data = raw.tobytes()
        if not any(a in data for a in self.added):
            return edges
        spans = []
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            found = [m.span() for m in self.any_added.finditer(data, start, end)]
            spans += found if self.alone or not found else [(start, end)]
        first, last = np.array(spans, np.int64).reshape(-1, 2).T
        at = np.searchsorted(first, edges) - 1  # the last span that begins before the edge
        inside = (at >= 0) & (edges < last[np.maximum(at, 0)]) if len(first) else np.zeros(len(edges), bool)
        return np.unique(np.concatenate((edges[~inside], first, last)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, number of ids of each text) of texts
        without nulls."""
        raw, offsets = common.text_bytes(texts)
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        edges = self._around_added(raw, offsets, cuts(raw, offsets))
        cut = pa.StringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw))
        collecting = gc.isenabled()
        gc.disable()  # the many short-lived strings hold no cycles
        try:
            distinct = cut.dictionary_encode()
            ids = self._ids(distinct.dictionary.to_pylist())
        finally:
            if collecting:
                gc.enable()
        places = distinct.indices.to_numpy()
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = np.cumsum(size) - size
        lengths = size[places]
        ends = np.cumsum(lengths)
        spread = np.repeat((begin[places] - (ends - lengths)).astype(np.int32), lengths)
        spread += np.arange(len(spread), dtype=np.int32)
        before = np.concatenate(([0], ends))[np.searchsorted(edges, offsets)]
        return flat[spread], np.diff(before)

    def encode_each(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        ids, counts = self.encode(texts)
        return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []


def encoder(path: str, most: int = 900_000, added: bool = False) -> Encoder:
    """This process's encoder for a vocabulary file."""
    key = path, added
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, most, added)
    _ENCODERS[key].most = most
    return _ENCODERS[key]
