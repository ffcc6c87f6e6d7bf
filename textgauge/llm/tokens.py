"""Token ids of whole texts with a given public tokenizer, equal to encoding each text at once.

ASCII white space never meets another character in that tokenizer (it is dropped between pieces, composes with
nothing and occurs in no special token), so a text's ids are the ids of its chunks between white space, in
order.  Texts of plain letters are cut into the tokenizer's pieces together, array-wise: equal pieces are found by their
bytes, each is looked up once, and the ids are gathered.  Other texts go chunk by chunk.  Each worker keeps the ids of
pieces and chunks it met, up to a fixed number; what is kept is only a cache, one that isn't there is encoded.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable
from itertools import chain, repeat
from operator import attrgetter

import numpy as np

from textgauge.llm.tables import keeps, working

CACHED = 200_000
ID = attrgetter("id")
PACK = [struct.Struct(f"<{n}I").pack for n in range(24)]
#: Letters whose lower case is one letter and that no normal form changes; other chunks go the long way.
PLAIN = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-ÿ]*")
#: The tokenizer file's pattern of pieces, for lower-case text of the plain letters.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\x09-\x0d\x20]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the others follow from 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Kept(dict):
    """Computes what is missing and keeps it.  A full generation is set aside; what is used again moves on."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.aside = most, {}

    def __missing__(self, key):
        ids = self.aside.get(key)
        if ids is None:
            ids = self.compute(key)
            if len(key) > 64:
                return ids
        if len(self) >= self.most:
            self.aside = dict(self)
            self.clear()
        self[key] = ids
        return ids


class _Pieces(_Kept):
    """Ids of a lower-case piece as little-endian unsigned 32-bit integers."""

    def __init__(self, model):
        super().__init__(CACHED)
        self.tokenize, self.letters = model.tokenize, _byte_letters()

    def compute(self, piece: str) -> bytes:
        if not (piece.isascii() and piece.isprintable()):
            piece = "".join(map(self.letters.__getitem__, piece.encode()))
        found = self.tokenize(piece)
        n = len(found)
        return PACK[n](*map(ID, found)) if n < 24 else struct.pack(f"<{n}I", *map(ID, found))


class _Chunks(_Kept):
    """Ids of a chunk of UTF-8 without ASCII white space."""

    def __init__(self, path: str):
        super().__init__(CACHED)
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces, self.table = _Pieces(self.tokenizer.model), _PieceTable(self.tokenizer.model)

    def compute(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if chunk.isalpha():  # ASCII letters only: one piece
            return self.pieces[text.lower()]
        if b"<|" not in chunk and (chunk.isascii() or PLAIN.fullmatch(text)):
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(text.lower())))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


class _PieceTable:
    """Ids of many pieces at once.  A piece's place says where its ids stand in one array; what is new is encoded together.

    A full table is set aside, and pieces that are met again move to the next one.
    """

    def __init__(self, model, most: int = 3 * CACHED // 4):
        self.tokenize, self.letters, self.most = model.tokenize, _byte_letters(), most
        self.aside = ({}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4"))
        self._begin()

    def _begin(self) -> None:
        self.place, self.start, self.size = {}, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def _encoded(self, names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of pieces in order."""
        shown = [n.decode() for n in names]
        shown = [t if t.isascii() and t.isprintable() else "".join(map(self.letters.__getitem__, n)) for t, n in zip(shown, names, strict=True)]
        found = list(map(self.tokenize, shown))
        size = np.fromiter(map(len, found), np.int64, len(found))
        return size, np.fromiter(map(ID, chain.from_iterable(found)), "<u4", int(size.sum()))

    def _add(self, names: list[bytes], size: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.start)
        self.place.update(zip(names, range(first, first + len(names)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, ids])

    def find(self, names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of different pieces begin, how many they are, and the array that holds them."""
        at = np.array(list(map(self.place.get, names, repeat(-1))), np.int64)
        lost = np.flatnonzero(at < 0).tolist()
        if lost and len(self.place) and len(self.place) + len(lost) > self.most:
            self.aside = (self.place, self.start, self.size, self.flat)
            self._begin()
            return self.find(names)
        if lost:
            missing = [names[i] for i in lost]
            place, start, size, flat = self.aside
            known = np.array(list(map(place.get, missing, repeat(-1))), np.int64)
            again, new = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
            if len(again):
                own = size[known[again]]
                self._add([missing[i] for i in again.tolist()], own, flat[spread(start[known[again]], own)])
            if len(new):
                fresh = [missing[i] for i in new.tolist()]
                self._add(fresh, *self._encoded(fresh))
            at[lost] = list(map(self.place.__getitem__, missing))
        return self.start[at], self.size[at], self.flat


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...``, ``size`` of them, for every row."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


_loaded: dict[str, _Chunks] = {}
keeps("tokens", _loaded.clear)


#: Kinds of bytes in plain lower-case text (white space, letters, digits, others) and contractions.
KINDS = np.full(256, 3, np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = 0
KINDS[97:123] = KINDS[128:] = 1
KINDS[48:58] = 2
ONE_AFTER, TWO_AFTER = b"stmd", (b"re", b"ve", b"ll")
TOGETHER = 1 << 20


def _cut(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of lower-case plain text begin and end; the text ends with white space."""
    kind = KINDS[data]
    begins = np.ones(len(data), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    mark = np.flatnonzero((data == 39) & begins)
    mark = mark[mark + 2 < len(data)]
    after, second = data[mark + 1], data[mark + 2]
    width = np.isin(after, np.frombuffer(ONE_AFTER, np.uint8)).astype(np.int64)
    for a, b in TWO_AFTER:
        width[(after == a) & (second == b)] = 2
    mark, width = mark[width > 0], width[width > 0]
    begins[mark + 1] = False
    rest = mark + 1 + width
    begins[rest[kind[rest] == 1]] = True
    edges = np.flatnonzero(begins)
    pieces = kind[edges] != 0
    ends = np.append(edges[1:], len(data))
    return edges[pieces], ends[pieces]


def _numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """One place of every different piece, and which of them each piece is; nothing if a hash were to mislead.

    Pieces of up to 16 bytes without zero bytes are told apart by all of their bytes; each longer one counts as different.
    """
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    # Eight bytes from every place on, as one number.
    words = np.ndarray((len(data) + 9,), "<u8", padded, 0, (1,))
    low, high = words[starts], words[starts + 8]
    size = (ends - starts).astype(np.uint64)
    bits = np.uint64(8) * np.minimum(size, np.uint64(8))
    low = np.where(size >= 8, low, low & ((np.uint64(1) << bits) - np.uint64(1)))
    more = np.uint64(8) * (np.clip(size, 8, 16) - np.uint64(8))
    high = np.where(size >= 16, high, high & ((np.uint64(1) << more) - np.uint64(1)))
    long = np.flatnonzero(size > 16)
    high[long] = np.arange(len(long), dtype=np.uint64) | np.uint64(255 << 56)
    low[long] = np.uint64(255)
    mixed = (low ^ high * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC4CEB9FE1A85EC53)
    mixed ^= mixed >> np.uint64(29)
    _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
    if (low[first][which] != low).any() or (high[first][which] != high).any():
        return None
    return first, which


def _plain_ids(texts: list[bytes], table: _PieceTable) -> list[bytes] | None:
    """Ids of plain texts together; nothing if their pieces can't be told apart array-wise."""
    whole = b"\n".join(texts) + b"\n"
    if b"\0" in whole:
        return None
    data = np.frombuffer(whole.lower(), np.uint8)  # of bytes, hence only ASCII letters
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] <= 0x9E) & (data[1:] >= 0x80)) + 1
    if len(upper):
        data = data.copy()
        data[upper] += 0x20
    starts, ends = _cut(data)
    if not len(starts):
        return [b""] * len(texts)
    found = _numbered(data, starts, ends)
    if found is None:
        return None
    first, which = found
    shown = data.tobytes()
    start, size, flat = table.find([shown[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
    own = size[which]
    upto = np.concatenate([[0], np.cumsum(own)])
    out = flat[spread(start[which], own)]
    # A text's pieces begin before its end.
    edges = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    cut = upto[edges].tolist()
    return [out[a:b].tobytes() for a, b in zip(cut, cut[1:])]


def _parts(text: bytes) -> list[bytes]:
    """A long text in parts that begin behind white space."""
    out, at = [], 0
    while len(text) - at > TOGETHER:
        cut = max(text.rfind(c, at, at + TOGETHER) for c in (b" ", b"\n"))
        if cut <= at:
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def _is_plain(text: bytes) -> bool:
    return b"<|" not in text and (text.isascii() or PLAIN.fullmatch(text.decode()) is not None)


def encode(texts: Iterable[bytes | None], path: str, end: int | None = None) -> Iterable[bytes]:
    """Ids of every UTF-8 text (none: empty), with ``end`` appended, as little-endian unsigned 32-bit integers.

    Texts are taken together up to ``TOGETHER`` bytes; the order stays.
    """
    if path not in _loaded:
        working("tokens")
        _loaded[path] = _Chunks(path)
    chunks = _loaded[path]
    tail = b"" if end is None else np.uint32(end).astype("<u4").tobytes()

    def one_by_one(text: bytes) -> bytes:
        return b"".join(map(chunks.__getitem__, text.split()))

    def together(group: list[bytes]) -> Iterable[bytes]:
        plain = [t for t in group if _is_plain(t)]
        done = iter(_plain_ids(plain, chunks.table) or map(one_by_one, plain)) if plain else iter(())
        for text in group:
            yield next(done) if _is_plain(text) else one_by_one(text)

    group, held = [], 0
    for text in texts:
        text = text or b""
        if group and held + len(text) > TOGETHER:
            for ids in together(group):
                yield ids + tail
            group, held = [], 0
        if len(text) > TOGETHER:
            yield b"".join(ids for part in _parts(text) for ids in together([part])) + tail
        else:
            group.append(text)
            held += len(text) + 1
    for ids in together(group):
        yield ids + tail
