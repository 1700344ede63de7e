"""Best-two-fit packing of tokenised documents into sequences.

Documents are tokenised on the executors, ended by an end id, and only longer ones are cut into pieces of the
sequence length. The pieces are dealt into groups of bounded size that are packed independently:
a sequence is filled greedily with the largest piece that fits; then its smallest piece is replaced by two
unpacked pieces if these fit the gap that its removal leaves more tightly. A group wastes at most its last
sequence, and tokens never travel: only lengths do.

Tokenising keeps a bounded cache from white-space separated chunks to token bytes; texts with characters
outside the range in which this is proven equal to the tokenizer's own pipeline go through the tokenizer itself.

Defined results: null text counts as empty and is the end id alone; repeated rows are packed each; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, stored

CAPACITY = 4096
END_ID = 1
#: Pieces packed together; a group is one task's work.
GROUP_PIECES = 16_384
#: Chunks that a worker's cache holds before it starts anew.
CACHE_CHUNKS = 400_000
#: Texts a worker tokenises before it hands on rows.
ROWS = 256


# --- tokens -----------------------------------------------------------------------------------------------------


#: Up to here every letter is its own NFC form, has a one-letter lower case and keeps its class under lower-casing.
LAST_PLAIN = 0x17F
_ODD = {0x85, 0xA0, 0x130, 0x149, *range(0x1C, 0x20)}


def _class(kind: str, negate: bool = False) -> str:
    return "".join(re.escape(chr(c)) for c in range(LAST_PLAIN + 1) if c not in _ODD and (unicodedata.category(chr(c))[0] == kind) != negate)


_LETTERS, _NUMBERS = _class("L"), _class("N")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
_PLAIN = re.compile("[" + "".join(re.escape(chr(c)) for c in range(LAST_PLAIN + 1) if c not in _ODD) + "]*")


@lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """The visible letter that byte-level tokenizers write for each byte."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TokenBytes:
    """Text to little-endian unsigned 32-bit token ids, by a lower-casing word BPE tokenizer file."""

    def __init__(self, path: str, cache: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.size = cache
        self.cache: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        ids = []
        for piece in _PIECES.findall(chunk):
            ids += [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, piece.encode())))]
        out = np.array(ids, "<u4").tobytes()
        if len(self.cache) >= self.size:
            self.cache.clear()
        self.cache[chunk] = out
        return out

    def slow(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self.slow(text)
        chunks, get = text.lower().split(), self.cache.get
        found = list(map(get, chunks))
        if None in found:
            found = [x if x is not None else get(c) or self._chunk(c) for x, c in zip(found, chunks)]
        return b"".join(found)


@lru_cache(4)
def token_bytes(path: str) -> TokenBytes:
    """One a worker process and tokenizer file."""
    return TokenBytes(path)


def pieces_of(tokens: bytes, capacity: int = CAPACITY, end_id: int = END_ID) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32 of the ids) of a document: its ids and the end id, cut only if longer than capacity."""
    ids = tokens + int(end_id).to_bytes(4, "little")
    n = len(ids) // 4
    return [(k, at, min(capacity, n - at), zlib.crc32(ids[4 * at : 4 * (at + capacity)])) for k, at in enumerate(range(0, n, capacity))]


def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each row of docs."""
    id_type = docs.schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                whose, rows = [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    got = pieces_of(encode(text or ""), capacity, end_id)
                    whose += [k] * len(got)
                    rows += got
                piece, start, length, crc = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(whose, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


# --- bins -------------------------------------------------------------------------------------------------------


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every length (1 to capacity)."""
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(lengths, kind="stable")
    start = np.searchsorted(lengths[order], np.arange(capacity + 2))
    left = np.diff(start)  # unpacked pieces of each length
    mask = 0
    for x in np.nonzero(left)[0]:
        mask |= 1 << int(x)
    left, used = left.tolist(), start[:-1].copy()
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rest, number = len(lengths), 0

    def largest(most: int) -> int:
        return (mask & ((2 << most) - 1)).bit_length() - 1

    def drop(x: int) -> None:
        nonlocal mask
        left[x] -= 1
        if not left[x]:
            mask &= ~(1 << x)

    def put_back(x: int) -> None:
        nonlocal mask
        left[x] += 1
        mask |= 1 << x

    while rest:
        held, gap = [], capacity
        while gap and (x := largest(gap)) > 0:
            held.append(x)
            drop(x)
            gap -= x
        if gap and len(held) > 1:
            low = held[-1]  # greedily filled, so the last is the smallest
            room, pair = gap + low, _two_of(mask, left, gap + low)
            if pair and low < sum(pair) <= room:
                held.pop()
                put_back(low)
                for x in pair:
                    drop(x)
                held += pair
        at = 0
        for x in held:
            who = order[used[x]]
            used[x] += 1
            bins[who], offsets[who] = number, at
            at += x
        rest -= len(held)
        number += 1
    return bins, offsets


def _two_of(mask: int, left: list[int], room: int) -> list[int] | None:
    """The two unpacked lengths with the largest sum of at most room."""
    best, total = None, 0
    big = (mask & ((1 << room) - 1)).bit_length() - 1  # leaves at least 1 for the other
    while big > 0 and 2 * big > total:
        small = (mask & ((2 << min(big, room - big)) - 1)).bit_length() - 1
        if small == big and left[big] < 2:
            small = (mask & ((1 << big) - 1)).bit_length() - 1
        if small > 0 and big + small > total:
            best, total = [big, small], big + small
            if total == room:
                return best
        big = (mask & ((1 << big) - 1)).bit_length() - 1
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """pieces (any columns, with length) with sequence_id and offset; pieces must be read from a table."""
    groups = max(1, -(-pieces.count() // group_pieces))
    key = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).alias("pack_group")
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_two_fit(frame["length"].to_numpy(), capacity)
        # a group has fewer sequences than pieces
        return frame.assign(sequence_id=frame["pack_group"].to_numpy() * 2**32 + bins, offset=offsets).drop(columns="pack_group")

    return pieces.select("*", key).groupBy("pack_group").applyInPandas(fill, schema)


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(tokenised_pieces(docs, tokenizer or tokenizer_path(), capacity, end_id), "pieces")
    return pack(pieces, capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
ORACLE: dict[str, str] = {}
