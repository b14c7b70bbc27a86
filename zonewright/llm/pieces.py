"""Cuts of a text that no byte-level pre-tokenizer rule reaches across.

A single space or line feed between two characters that are not white space always starts a new
pre-token, and such a line feed is one of its own. So does a mark of ``_MARKS`` after an ASCII
letter, as letters and other characters never share a pre-token (no special token of the
vocabularies in use holds such a mark). So the pieces between the cuts can be tokenized alone,
equal pieces once, and a text of any length in parts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from zonewright.llm.textkernel import mix, text_buffer

#: ASCII characters that some pre-tokenizer counts as white space.
_SPACES = np.zeros(256, bool)
_SPACES[[*range(9, 14), *range(28, 33)]] = True
# White space beyond ASCII, as UTF-8.
_WIDE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_WIDE_LEADS = sorted({w[:2] for w in _WIDE})

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in ".,;:!?%*#$&()\"/"]] = True

#: Bytes that are cut at a time, and the longest piece that is looked up by its hash.
WINDOW, LONGEST = 2 << 20, 256
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
#: What is left of eight bytes when only the first k count.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start in the texts between ``offsets``."""
    space = _SPACES[data]
    pair = data[:-1].astype(np.uint16) << 8 | data[1:]
    for lead in _WIDE_LEADS:
        for at in np.flatnonzero(pair == (lead[0] << 8 | lead[1])).tolist():
            for wide in _WIDE:
                if wide[:2] == lead and data[at : at + len(wide)].tobytes() == wide:
                    space[at : at + len(wide)] = True
    cut = (data == 32) | (data == 10)
    cut[1:] &= ~space[:-1]
    cut[:-1] &= ~space[1:]
    full = offsets[:-1] < offsets[1:]
    cut[offsets[:-1][full]] = False
    cut[offsets[1:][full] - 1] = False
    starts = cut.copy()
    starts[1:] |= cut[:-1] & (data[:-1] == 10)
    starts[1:] |= _MARKS[data[1:]] & _LETTERS[data[:-1]]
    starts[offsets[:-1][full]] = True
    return np.flatnonzero(starts)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of an array on, as one number."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts[k]`` numbers from ``starts[k]`` on, for every k."""
    after = np.cumsum(counts)
    return np.arange(after[-1] if len(after) else 0) + np.repeat(starts - after + counts, counts)


def _room(array: np.ndarray, need: int, fill: int = 0) -> np.ndarray:
    """The array, or a copy of it half as long again that has room for ``need``."""
    if need <= len(array):
        return array
    wider = np.full(max(need, len(array) * 3 // 2), fill, array.dtype)
    wider[: len(array)] = array
    return wider


def piece_hashes(eights: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each piece's bytes."""
    value = eights[begin] & _FIRST[np.minimum(size, 8)]
    hashes = mix(value ^ size.astype(np.uint64) * _LENGTH)
    at, rest = 8, np.flatnonzero(size > 8)
    while len(rest):
        value = eights[begin[rest] + at] & _FIRST[np.minimum(size[rest] - at, 8)]
        hashes[rest] = mix(hashes[rest] * _LENGTH + value)
        at += 8
        rest = rest[size[rest] > at]
    return hashes


class PieceMemory:
    """Bytes and token ids of pieces met before, found for many pieces at once.

    A table of places, probed one after the other, leads from a hash to the piece with it. All
    stands in a few arrays, so a piece takes its own bytes and ids and some 60 bytes more.
    """

    def __init__(self):
        self.pieces = self.bytes = self.tokens = 0
        self.table = np.full(1 << 12, -1, np.int32)
        self.hashes = np.zeros(1 << 10, np.uint64)
        self.begin, self.first = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)
        self.size, self.count = np.zeros(1 << 10, np.int32), np.zeros(1 << 10, np.int32)
        self.again = np.zeros(1 << 10, bool)
        self.data, self.ids = np.zeros(1 << 14, np.uint8), np.zeros(1 << 12, "<u4")

    def held(self) -> int:
        """Bytes in use."""
        return 37 * self.pieces + self.bytes + 4 * self.tokens + self.table.nbytes

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the piece with each hash, or -1."""
        last = np.uint64(len(self.table) - 1)
        slot = (hashes & last).astype(np.int64)
        found = self.table[slot]
        other = np.flatnonzero((found >= 0) & (self.hashes[found] != hashes))
        while len(other):
            slot[other] = (slot[other] + 1) & int(last)
            found[other] = self.table[slot[other]]
            other = other[(found[other] >= 0) & (self.hashes[found[other]] != hashes[other])]
        return found

    def _enter(self, start: int) -> None:
        """Puts the pieces from number ``start`` on in the table, which stays half empty."""
        if 2 * self.pieces > len(self.table):
            self.table = np.full(1 << (4 * self.pieces - 1).bit_length(), -1, np.int32)
            start = 0
        number = np.arange(start, self.pieces, dtype=np.int32)
        last = np.uint64(len(self.table) - 1)
        slot = (self.hashes[start : self.pieces] & last).astype(np.int64)
        while len(number):
            free = self.table[slot] < 0
            self.table[slot[free]] = number[free]
            # several may have taken one free place: the last of them has it
            lost = self.table[slot] != number
            number, slot = number[lost], (slot[lost] + 1) & int(last)

    def add(self, hashes: np.ndarray, pieces: list[bytes], tokens: list[bytes]) -> None:
        """Pieces whose hashes differ from each other and from all that are held."""
        n, m = self.pieces, self.pieces + len(pieces)
        raw, flat = np.frombuffer(b"".join(pieces), np.uint8), np.frombuffer(b"".join(tokens), "<u4")
        size, count = np.array(list(map(len, pieces))), np.array(list(map(len, tokens))) // 4
        for name in ("hashes", "begin", "first", "size", "count", "again"):
            setattr(self, name, _room(getattr(self, name), m))
        # eight bytes can be read from every place of a piece of any length
        self.data = _room(self.data, self.bytes + len(raw) + LONGEST + 8)
        self.ids = _room(self.ids, self.tokens + len(flat))
        self.hashes[n:m], self.size[n:m], self.count[n:m], self.again[n:m] = hashes, size, count, False
        self.begin[n:m] = self.bytes + np.cumsum(size) - size
        self.first[n:m] = self.tokens + np.cumsum(count) - count
        self.data[self.bytes : self.bytes + len(raw)] = raw
        self.ids[self.tokens : self.tokens + len(flat)] = flat
        self.pieces, self.bytes, self.tokens = m, self.bytes + len(raw), self.tokens + len(flat)
        self._enter(n)

    def unlike(
        self, eights: np.ndarray, begin: np.ndarray, size: np.ndarray, found: np.ndarray
    ) -> np.ndarray:
        """Which pieces differ from the one found, byte by byte."""
        own, first = _eights(self.data), self.begin[found]
        unlike = size != self.size[found]
        unlike |= ((eights[begin] ^ own[first]) & _FIRST[np.minimum(size, 8)]) != 0
        at, rest = 8, np.flatnonzero((size > 8) & ~unlike)
        while len(rest):
            left = _FIRST[np.minimum(size[rest] - at, 8)]
            wrong = ((eights[begin[rest] + at] ^ own[first[rest] + at]) & left) != 0
            unlike[rest[wrong]] = True
            at += 8
            rest = rest[(size[rest] > at) & ~wrong]
        return unlike

    def trimmed(self, limit: int) -> PieceMemory:
        """What was met again; nothing if that takes more than half of ``limit``."""
        kept, out = np.flatnonzero(self.again[: self.pieces]), PieceMemory()
        size, count = self.size[kept], self.count[kept]
        if 53 * len(kept) + int(size.sum()) + 4 * int(count.sum()) > limit // 2:
            return out
        data = self.data[_runs(self.begin[kept], size)].tobytes()
        ids = self.ids[_runs(self.first[kept], count)].tobytes()
        ends, stops = np.cumsum(size).tolist(), (4 * np.cumsum(count)).tolist()
        out.add(
            self.hashes[kept],
            [data[x:y] for x, y in zip([0, *ends], ends)],
            [ids[x:y] for x, y in zip([0, *stops], stops)],
        )
        return out


class PieceEncoder:
    """Token ids of whole texts, piece by piece.

    ``compute`` tokenizes many pieces at once and gives little-endian 32-bit numbers; ``stream``
    does one long piece. Results are kept by piece up to about ``limit`` bytes; beyond, those that
    were met once only are forgotten.
    """

    def __init__(
        self,
        compute: Callable[[list[str]], list[bytes]],
        stream: Callable[[str], bytes] | None = None,
        limit: int = 64 << 20,
    ):
        self.compute, self.limit = compute, limit
        self.stream = stream or (lambda piece: compute([piece])[0])
        self.memory = PieceMemory()

    def _numbers(
        self, data: np.ndarray, begin: np.ndarray, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece in the memory, and which differ from the piece there."""
        memory, eights = self.memory, _eights(data)
        hashes = piece_hashes(eights, begin, size)
        found = memory.find(hashes)
        new = np.flatnonzero(found < 0)
        memory.again[found[found >= 0]] = True
        if len(new):
            _, lead = np.unique(hashes[new], return_index=True)
            lead = new[np.sort(lead)]
            raw = data.tobytes()
            spans = zip(begin[lead].tolist(), (begin[lead] + size[lead]).tolist())
            pieces = [raw[x:y] for x, y in spans]
            memory.add(hashes[lead], pieces, self.compute([p.decode() for p in pieces]))
            found[new] = memory.find(hashes[new])
        return found, memory.unlike(eights, begin, size, found)

    def _window(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a window and where each text's ids start."""
        begin = piece_starts(data, offsets)
        if not len(begin):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        size = np.diff(np.append(begin, len(data)))
        alone = size > LONGEST
        short = np.flatnonzero(~alone)
        first, counts = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        if len(short):
            padded = np.concatenate([data, np.zeros(8, np.uint8)])
            found, unlike = self._numbers(padded, begin[short], size[short])
            first[short], counts[short] = self.memory.first[found], self.memory.count[found]
            alone[short[unlike]] = True
        single = {}
        for k in np.flatnonzero(alone).tolist():
            piece = data[begin[k] : begin[k] + size[k]].tobytes().decode()
            single[k] = np.frombuffer(self.stream(piece), "<u4")
            first[k], counts[k] = 0, len(single[k])
        after = np.concatenate([[0], np.cumsum(counts)])
        ids = self.memory.ids.take(_runs(first, counts), mode="clip")
        for k, tokens in single.items():
            ids[after[k] : after[k + 1]] = tokens
        if self.memory.held() > self.limit:
            self.memory = self.memory.trimmed(self.limit)
        return ids, after[np.searchsorted(begin, offsets)]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, and the offsets of each text's ids."""
        data, offsets = text_buffer(column)
        ids, ends = [], np.zeros(len(offsets), np.int64)
        total, text, at = 0, 0, 0
        while text < len(offsets) - 1:
            if offsets[text + 1] - at > WINDOW:
                # a long text goes in parts that end where a piece starts
                span = WINDOW
                while True:
                    stop = min(at + span, int(offsets[text + 1]))
                    part = data[at:stop]
                    last = int(piece_starts(part, np.array([0, len(part)]))[-1])
                    if stop == offsets[text + 1] or last:
                        break
                    span *= 2
                if stop < offsets[text + 1]:
                    part = part[:last]
                found, _ = self._window(part, np.array([0, len(part)]))
                ids.append(found)
                total += len(found)
                at += len(part)
                if at < offsets[text + 1]:
                    continue
                text += 1
                ends[text] = total
                continue
            until = max(text + 1, int(np.searchsorted(offsets, at + WINDOW, "right")) - 1)
            found, starts = self._window(
                data[at : offsets[until]], np.append(at, offsets[text + 1 : until + 1]) - at
            )
            ids.append(found)
            ends[text + 1 : until + 1] = total + starts[1:]
            total += len(found)
            text, at = until, int(offsets[until])
        return np.concatenate(ids) if ids else np.zeros(0, "<u4"), ends
