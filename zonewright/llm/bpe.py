"""Byte-level BPE as a streaming transducer, and decoding as a byte-to-text state machine.

A merge decides a token boundary only together with what stands to its right, and a rule can
be blocked only by a rule of better rank, so the reach of that influence is bounded by the
merge list itself. :meth:`MergeTable.lookahead` computes the bound in one pass over the
list. The transducer holds a window a little longer than the bound, emits the tokens that end
before it, and drops their bytes.

Defined results: a null or empty text has no ids; no ids decode to the empty text; bytes that
are no valid UTF-8 decode to U+FFFD; null ids are skipped; an id outside the vocabulary is an
error; repeated rows are encoded each; an empty table gives an empty table; all other columns
pass through, and a column with the name of the result is replaced.
"""

from __future__ import annotations

import codecs
import json
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zonewright.llm.common import slices
from zonewright.llm.pieces import PieceEncoder

# Fixed value: the pre-tokenizer pattern of the vocabulary's family.
PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
#: Of a pair that no rule merges; multiplier of the pair table's hash.
NO_RULE = 1 << 62
PAIR_STEP = 0x9E3779B97F4A7C15
RUNS = [regex.compile(p) for p in (r"\p{L}*", r"\p{N}*", r"[^\s\p{L}\p{N}]*", r"\s*")]


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """Vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab, symbols = content["model"]["vocab"], byte_symbols()
        self.special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(symbols[c] for c in token)
            for token, i in vocab.items()
            if token not in self.special
        } | {i: token.encode() for token, i in self.special.items()}
        self.byte_id = [0] * 256
        for symbol, byte in symbols.items():
            self.byte_id[byte] = vocab[symbol]
        self.rules: list[tuple[int, int, int]] = []
        for rule in content["model"]["merges"]:
            left, right = rule.split(" ") if isinstance(rule, str) else rule
            self.rules.append((vocab[left], vocab[right], vocab[left + right]))
        # rank and result of a pair in one number, so that the smallest is the next rule
        self.rank = {
            a << 32 | b: n << 32 | c for n, (a, b, c) in reversed(list(enumerate(self.rules)))
        }
        self._table = self._pair_table()
        self.special_pattern = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        self.reach = self.lookahead()
        self.longest = max(map(len, self.bytes_of.values()))

    def lookahead(self) -> int:
        """Bytes right of a boundary that suffice to know that it is final.

        ``reach[t]`` is what must be known right of token ``t`` while it is formed: some part
        ``x`` on its right edge could be taken by a rule ``(x, c)`` of better rank than the rule
        that uses ``x`` inside ``t``, which needs ``c`` and the reach of ``xc``. Rules are visited
        in rank order, so ``best[x]`` holds exactly the rules of better rank at each step.
        """
        best: dict[int, int] = {}
        reach: dict[int, int] = {}
        for left, right, made in self.rules:
            need = max(best.get(right, 0), reach.get(right, 0))
            reach[made] = max(need, reach.get(made, 0))
            best[left] = max(best.get(left, 0), len(self.bytes_of[right]) + need)
        return max(best.values(), default=0)

    def merge(self, data: bytes) -> list[int]:
        """Tokens of one pre-token, or of a window of one."""
        ids = [self.byte_id[b] for b in data]
        rank, none = self.rank, 1 << 62
        found = [rank.get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while found:
            low = min(found)
            if low == none:
                break
            i = found.index(low)
            ids[i : i + 2] = [low & 0xFFFFFFFF]
            del found[i]
            if i:
                found[i - 1] = rank.get(ids[i - 1] << 32 | ids[i], none)
            if i < len(found):
                found[i] = rank.get(ids[i] << 32 | ids[i + 1], none)
        return ids


    def _pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and their rules in an open hash table, for lookups of many at once."""
        pairs, rules = np.full(1 << 19, -1), np.full(1 << 19, NO_RULE)
        for pair, rule in self.rank.items():
            at = (pair * PAIR_STEP & (1 << 64) - 1) >> 45
            while pairs[at] >= 0:
                at = (at + 1) % len(pairs)
            pairs[at], rules[at] = pair, rule
        return pairs, rules

    def rules_of(self, pair: np.ndarray) -> np.ndarray:
        """Rank and result of each pair in one number, NO_RULE where there is none."""
        pairs, rules = self._table
        at = (pair.astype(np.uint64) * np.uint64(PAIR_STEP) >> np.uint64(45)).astype(np.int64)
        out = rules[at]
        other = np.flatnonzero((pairs[at] != pair) & (pairs[at] >= 0))
        out[pairs[at] != pair] = NO_RULE
        while len(other):
            at[other] = (at[other] + 1) % len(pairs)
            found = pairs[at[other]]
            hit = found == pair[other]
            out[other[hit]] = rules[at[other[hit]]]
            other = other[~hit & (found >= 0)]
        return out

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of many short pre-tokens, as little-endian 32-bit numbers.

        Each round applies the leftmost rule of best rank in every word; words without a rule
        are done.
        """
        if not words:
            return []
        lengths = np.array([len(w) for w in words])
        ids = np.array(self.byte_id)[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_owner = [], []
        while len(ids):
            rule = np.full(len(ids), NO_RULE)
            rule[:-1] = self.rules_of(ids[:-1] << 32 | ids[1:])
            rule[:-1][owner[:-1] != owner[1:]] = NO_RULE
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            # rank in front of the place; a rule's result is looked up again at its place
            order = np.where(rule == NO_RULE, NO_RULE, (rule >> 32 << 32) + np.arange(len(ids)))
            best = np.minimum.reduceat(order, starts)
            going = best != NO_RULE
            live = np.repeat(going, np.diff(np.append(starts, len(ids))))
            done_ids.append(ids[~live])
            done_owner.append(owner[~live])
            at = best[going] & 0xFFFFFFFF
            ids[at] = rule[at] & 0xFFFFFFFF
            live[at + 1] = False
            ids, owner = ids[live], owner[live]
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        raw = np.concatenate(done_ids)[order].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(words))) * 4
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Transducer:
    """Tokens of one pre-token that arrives in parts; holds at most a window of bytes."""

    def __init__(self, table: MergeTable):
        self.table, self.held = table, bytearray()
        self.window = 2 * (table.reach + table.longest)

    def feed(self, data: bytes) -> list[int]:
        """Tokens that no later byte can change."""
        out: list[int] = []
        for start in range(0, len(data), self.window):
            self.held += data[start : start + self.window]
            while len(self.held) > self.window:
                end, stable = 0, self.window - self.table.reach
                for token in self.table.merge(bytes(self.held[: self.window])):
                    if end + len(self.table.bytes_of[token]) > stable:
                        break
                    end += len(self.table.bytes_of[token])
                    out.append(token)
                del self.held[:end]
        return out

    def finish(self) -> list[int]:
        out = self.table.merge(bytes(self.held)) if self.held else []
        self.held.clear()
        return out


class StreamEncoder:
    """Tokens of a text that arrives in parts of any size, in constant memory.

    Short pre-tokens wait for the characters that decide their end. A run that outgrows the
    buffer goes to the transducer as it comes; of a run of white space the last character is
    held back, since it belongs to what follows.
    """

    BUFFER = 256

    def __init__(self, table: MergeTable):
        self.table, self.text = table, ""
        self.transducer, self.run = Transducer(table), None
        self.margin = max([3, *map(len, table.special)])

    def feed(self, text: str) -> Iterator[int]:
        for start in range(0, len(text), 4 * self.BUFFER):
            self.text += text[start : start + 4 * self.BUFFER]
            if len(self.text) > 2 * self.BUFFER:
                yield from self._drain(last=False)

    def finish(self) -> Iterator[int]:
        yield from self._drain(last=True)

    def _special_at(self) -> tuple[int, int]:
        """Span of the next special token in the buffer, or its end twice."""
        found = self.table.special_pattern and self.table.special_pattern.search(self.text)
        return found.span() if found else (len(self.text), len(self.text))

    def _drain(self, last: bool) -> Iterator[int]:
        while self.text:
            begin, after = self._special_at()
            whole = last or after > begin  # what stands before a special token is complete
            if begin == 0 and after:
                yield from self.transducer.finish()
                self.run = None
                yield self.table.special[self.text[:after]]
                self.text = self.text[after:]
                continue
            limit = begin if whole else max(0, len(self.text) - self.margin)
            if self.run is not None:
                end = RUNS[self.run].match(self.text, 0, limit).end()
                going = end == limit and not whole
                if self.run == 3 and not (end == limit and whole):
                    end = max(0, end - 1)
                yield from self.transducer.feed(self.text[:end].encode())
                self.text = self.text[end:]
                if going:
                    return
                yield from self.transducer.finish()
                self.run = None
                continue
            found = PATTERN.match(self.text, 0, begin)
            end = found.end()
            if end <= limit - self.margin or whole:
                yield from self.transducer.feed(found[0].encode())
                yield from self.transducer.finish()
                self.text = self.text[end:]
                continue
            if end < self.BUFFER:
                return
            last_char = found[0][-1]
            self.run = next(k for k, run in enumerate(RUNS) if run.fullmatch(last_char))
            end = max(0, min(end, limit) - 1)
            yield from self.transducer.feed(self.text[:end].encode())
            self.text = self.text[end:]


class StreamDecoder:
    """Text of ids that arrive in parts; an unfinished character waits for its other bytes."""

    def __init__(self, table: MergeTable):
        self.bytes_of = table.bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


#: Pre-tokens up to so many bytes end inside the transducer's window; they are flushed together.
SHORT = 64


def piece_encoder(path: str) -> PieceEncoder:
    """The transducer's tokens by piece; what it remembers ends with the task that made it."""
    table = merge_table(path)
    transducer = Transducer(table)
    special = {text: struct.pack("<I", i) for text, i in table.special.items()}

    def split(piece: str) -> list[str]:
        """Pre-tokens and special tokens of a piece."""
        if not [text for text in special if text in piece]:
            return PATTERN.findall(piece)
        out = []
        for part in table.special_pattern.split(piece):
            out += [part] if part in special else PATTERN.findall(part)
        return out

    def tokens(found: list[str]) -> list[bytes]:
        lists = [split(piece) for piece in found]
        known = dict(special)
        distinct = {token for tokens in lists for token in tokens}.difference(known)
        raw = {token: token.encode() for token in distinct}
        short = [token for token in distinct if len(raw[token]) <= SHORT]
        known.update(zip(short, table.merge_many([raw[token] for token in short])))
        for token in distinct.difference(known):
            ids = transducer.feed(raw[token])
            ids += transducer.finish()
            known[token] = struct.pack(f"<{len(ids)}I", *ids)
        return [b"".join([known[token] for token in tokens]) for tokens in lists]

    def stream(piece: str) -> bytes:
        """A piece of any length, in parts."""
        encoder, out = StreamEncoder(table), array("I")
        for start in range(0, len(piece), 4096):
            out.extend(encoder.feed(piece[start : start + 4096]))
        out.extend(encoder.finish())
        return out.tobytes()

    return PieceEncoder(tokens, stream)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    keep = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in keep), values],
        names=[*(batch.schema.names[i] for i in keep), name],
    )


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name != name]
    return T.StructType([*kept, T.StructField(name, kind)])


def encode_texts(
    df: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """``df`` with the token ids of each whole text; ``vocabulary`` is a path on every node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, text_col):
                ids, offsets = encoder.encode_column(part.column(text_col))
                listed = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(ids.view("<i4"))
                )
                yield _with_column(part, ids_col, listed)

    return df.mapInArrow(run, _schema(df, ids_col, T.ArrayType(T.IntegerType())))


def _texts(table: MergeTable, ids: pa.ListArray, block: int) -> Iterator[str]:
    """Text of each list of ids, ``block`` ids at a time."""
    for row in ids:
        decoder, out = StreamDecoder(table), []
        known = row.values.drop_null() if row.is_valid else pa.array([], pa.int32())
        for start in range(0, len(known), block):
            out.append(decoder.feed(known.slice(start, block).to_numpy().tolist()))
        out.append(decoder.finish())
        yield "".join(out)


def decode_ids(
    df: DataFrame,
    vocabulary: str,
    ids_col: str = "ids",
    text_col: str = "decoded",
    block: int = 8192,
) -> DataFrame:
    """``df`` with the text of each row's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = pa.array(_texts(table, part.column(ids_col), block), pa.string())
                yield _with_column(part, text_col, texts)

    return df.mapInArrow(run, _schema(df, text_col, T.StringType()))


def round_trip(
    df: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str = "decoded",
    block: int = 8192,
) -> DataFrame:
    """``df`` with the ids of each whole text and the text that these ids give again.

    Both machines run in one task, so ids are never handed to a second Python worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = piece_encoder(vocabulary), merge_table(vocabulary)
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                ids, offsets = encoder.encode_column(part.column(text_col))
                listed = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(ids.view("<i4"))
                )
                texts = pa.array(_texts(table, listed, block), pa.string())
                yield _with_column(_with_column(part, ids_col, listed), decoded_col, texts)

    coded = _schema(df, ids_col, T.ArrayType(T.IntegerType()))
    kept = [f for f in coded.fields if f.name != decoded_col]
    return df.mapInArrow(run, T.StructType([*kept, T.StructField(decoded_col, T.StringType())]))
