"""Byte-level BPE by a rank queue: one bucket of positions per merge rank under a hierarchy of bitmaps."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from ledgerloom.llm.common import Recent, paused_collection, worker_memory

#: Unicode white space, written out so that it does not depend on the pattern library.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Words with the white space before them, and white space at the end.
CHUNK = re.compile(rf"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")


#: Single bits of a bitmap; 256 words of 256 bits hold 65,536 ranks, more ranks make the upper bitmap wider.
BIT = [1 << i for i in range(4096)]


def blank_chunks(text: str) -> list[str]:
    """The text cut before white space that follows another character; a byte-level pre-token never spans such a place."""
    return CHUNK.findall(text)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


def portable(pattern: str) -> str:
    """The pattern with its white space classes written out."""
    return (
        pattern.replace(r"[^\s", f"[^{BLANK}").replace(r"\S", f"[^{BLANK}]").replace(r"\s", f"[{BLANK}]")
    )


class ByteBpe:
    """Encodes as the merge ranks say: always the least rank, leftmost first."""

    def __init__(self, path: str, pattern: str, memory: int = 500_000) -> None:
        import regex

        self.ranks = load_ranks(path)
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.match = regex.compile(portable(pattern))
        self.lower = [0] * (max(self.ranks.values()) // 256 + 1)
        self.chunks, self.tokens = Recent(memory), Recent(memory)
        # Patterns of this kind begin a new match wherever white space follows something else.
        self.by_space = " ?" in pattern and r"\s+(?!\S)" in pattern

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token.

        The parts form a doubly linked list. ``buckets[r]`` is a heap of the positions whose pair has rank r. Bit r of
        the lower bitmaps says that bucket r has entries, bit w of the upper one that lower bitmap w is not empty: the
        least rank is found by the lowest set bit of each. Entries whose part has gone or whose pair has changed are
        stale and skipped. All bitmaps are empty again at the end.
        """
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        after, before, pair = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n
        lower, upper, bit = self.lower, 0, BIT
        buckets: dict[int, list[int]] = {}
        for i in range(n - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                pair[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    lower[rank >> 8] |= bit[rank & 255]
                    upper |= bit[rank >> 8]
        while upper:
            word = (upper & -upper).bit_length() - 1
            bits = lower[word]
            rank = word << 8 | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                bits &= bits - 1
                lower[word] = bits
                if not bits:
                    upper &= upper - 1
            if pair[i] != rank:
                continue
            j = after[i]
            end = after[i] = after[j]
            pair[j] = pair[i] = -1
            left = before[i]
            if end < n:
                before[end] = i
                new = get(piece[i : after[end]])
                if new is not None:
                    pair[i] = new
                    if new in buckets:
                        heappush(buckets[new], i)
                    else:
                        buckets[new] = [i]
                        lower[new >> 8] |= bit[new & 255]
                        upper |= bit[new >> 8]
            if left >= 0:
                new = get(piece[left:end])
                if new is None:
                    pair[left] = -1
                elif pair[left] != new:
                    pair[left] = new
                    if new in buckets:
                        heappush(buckets[new], left)
                    else:
                        buckets[new] = [left]
                        lower[new >> 8] |= bit[new & 255]
                        upper |= bit[new >> 8]
        ranks, out, i = self.ranks, [], 0
        while i < n:
            j = after[i]
            out.append(ranks[piece[i:j]])
            i = j
        return tuple(out)

    def pre_token(self, piece: str) -> tuple[int, ...]:
        try:
            return self.tokens[piece]
        except KeyError:
            ids = self.merge(piece.encode())
            if len(piece) <= 64:
                self.tokens.add(piece, ids)
            return ids

    def chunk(self, chunk: str) -> tuple[tuple[int, ...], str]:
        ids = tuple(chain.from_iterable(map(self.pre_token, self.match.findall(chunk))))
        return ids, ",".join(map(str, ids))

    def encode_chunks(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """Ids of a text and their decimals, chunk by chunk; special strings have no meaning here."""
        memory = self.chunks
        parts = blank_chunks(text) if self.by_space else [text] if text else []
        try:
            return [memory[part] for part in parts]
        except KeyError:
            out = []
        for part in parts:
            try:
                found = memory[part]
            except KeyError:
                found = self.chunk(part)
                if len(part) <= 64:
                    memory.add(part, found)
            out.append(found)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for ids, _ in self.encode_chunks(text) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encode_texts(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = True,
    memory: int = 500_000,
) -> DataFrame:
    """``(id, n_tokens long, ids_sha256 string, decoded_sha256 string[, ids array<int>])`` for every row.

    ``path`` is a rank file that all executors can read. Each match of ``pattern`` is encoded by itself, without
    special tokens; the ids are then decoded again. A null text counts as empty: no ids, the digests of nothing.
    Repeated rows give repeated results, an empty table an empty result; other columns are not read. A pre-token may
    be of any length: the queue handles n bytes in about n log n steps. ``memory`` entries each of chunks and pre-tokens
    are remembered twice over by a worker, about 1 KB per entry in all; less memory costs time only.
    """
    schema = docs.select(id_column).schema.add("n_tokens", "long", False).add("ids_sha256", "string", False)
    schema = schema.add("decoded_sha256", "string", False)
    if keep_ids:
        schema = schema.add("ids", ArrayType(IntegerType(), False), False)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_memory().get((path, pattern, memory))
        if coder is None:
            coder = worker_memory()[path, pattern, memory] = ByteBpe(path, pattern, memory)
        for batch in batches:
            counts, digests, back, kept = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                with paused_collection():
                    chunks = coder.encode_chunks(text)
                ids = [i for own, _ in chunks for i in own]
                counts.append(len(ids))
                digests.append(hashlib.sha256(",".join([decimals for _, decimals in chunks]).encode()).hexdigest())
                back.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if keep_ids:
                    kept.append(pa.array(ids, pa.int32()))
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())]
            if keep_ids:
                offsets = [0]
                for n in counts:
                    offsets.append(offsets[-1] + n)
                values = pa.concat_arrays(kept) if kept else pa.array([], pa.int32())
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(id_column, text_column).mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``(id, decoded binary)``: the bytes that the ids stand for. Null ids give no bytes; an unknown id is an error."""
    schema = encoded.select(id_column).schema.add("decoded", "binary", False)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {i: b for b, i in load_ranks(path).items()}
        for batch in batches:
            out = [b"".join(bytes_of[i] for i in ids.as_py() or ()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=schema.names)

    return encoded.select(id_column, ids_column).mapInArrow(decode, schema)
