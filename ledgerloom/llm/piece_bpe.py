"""SentencePiece BPE by vectorised merge rounds: flat arrays of symbols, the least pair rank of every word, all words at once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from ledgerloom.llm.common import Recent, paused_collection, text_batches, worker_memory

#: What stands for a space in pieces.
MARK = "▁"
#: Characters of texts that are looked up and merged together.
BATCH_CHARS = 1 << 21
#: Rank of a pair that makes no piece.
NEVER = np.iinfo(np.int32).max
#: Longest chunk that is remembered.
SHORT = 64


def load_pieces(path: str) -> tuple[list[str], list[float], dict[str, int]]:
    """Pieces and scores of a model file by id, and the ids of its special entries: ``unknown``, ``begin``, ``end`` and
    ``byte`` (that of byte 0). Models that this encoder does not cover are an error."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    rules, trainer, kinds = proto.normalizer_spec, proto.trainer_spec, [p.type for p in proto.pieces]
    kind = sentencepiece_model_pb2.ModelProto.SentencePiece
    first_byte = model.piece_to_id("<0x00>")
    covered = (
        trainer.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        and trainer.byte_fallback
        and not trainer.treat_whitespace_as_suffix
        and not rules.precompiled_charsmap
        and rules.add_dummy_prefix
        and rules.escape_whitespaces
        and not rules.remove_extra_whitespaces
        and not proto.denormalizer_spec.precompiled_charsmap
        and set(kinds) <= {kind.NORMAL, kind.UNKNOWN, kind.CONTROL, kind.BYTE}
        and [i for i, k in enumerate(kinds) if k == kind.BYTE] == list(range(first_byte, first_byte + 256))
    )
    if not covered:
        raise ValueError(f"{path}: not a byte-fallback BPE model with identity normalisation")
    special = {"unknown": model.unk_id(), "begin": model.bos_id(), "end": model.eos_id(), "byte": first_byte}
    names = [p.piece if k == kind.NORMAL else "" for p, k in zip(proto.pieces, kinds, strict=True)]
    return names, [p.score for p in proto.pieces], special


class PieceBpe:
    """Merges the pair of the best score, leftmost first, as the model file says; characters without a piece become bytes."""

    def __init__(self, path: str, memory: int = 200_000) -> None:
        self.pieces, scores, self.special = load_pieces(path)
        size = len(self.pieces)
        ids = {piece: i for i, piece in enumerate(self.pieces) if piece}
        order = {score: i for i, score in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        rank = {i: order[scores[i]] for i in ids.values()}
        # Symbols: ids of pieces, then characters that occur in pieces only, then one for all other characters.
        inner = sorted({c for piece in ids for c in piece} - ids.keys())
        symbol = ids | {c: size + i for i, c in enumerate(inner)}
        self.strange = size + len(inner)
        self.symbol_of = np.full(0x110000, self.strange, np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        pairs = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = i
        self.width = self.strange + 1
        keys = np.array([a * self.width + b for a, b in pairs] or [-1], np.int64)
        made = np.array(list(pairs.values()) or [0], np.int32)
        by_key = np.argsort(keys)
        self.keys, self.made = keys[by_key], made[by_key]
        # One entry more: index -1, the pair that makes nothing, has rank NEVER.
        self.rank = np.append(np.array([rank.get(i, NEVER) for i in self.made.tolist()], np.int32), NEVER).astype(np.int32)
        # A piece is early if one of which it is a part does not rank behind it.
        self.early = np.zeros(self.width, bool)
        for (left, right), i in pairs.items():
            for part in (left, right):
                if part in rank and rank[i] <= rank[part]:
                    self.early[part] = True
        joined = {(ord(p[i]) << 21) | ord(p[i + 1]) for p in ids for i in range(len(p) - 1)}
        self.joined = np.array(sorted(joined) or [-1], np.int64)
        self.chunk = re.compile(self._chunk_pattern(ids, rank))
        self.memory = Recent(memory)
        self.byte_ids = frozenset(range(self.special["byte"], self.special["byte"] + 256))
        self.decimal = [str(i) for i in range(size)]
        self.visible = [piece.replace(MARK, " ") for piece in self.pieces]

    @staticmethod
    def _chunk_pattern(ids: dict[str, int], rank: dict[int, int]) -> str:
        """Cuts a text at places that no piece spans: before a space that follows something else, and around line ends.

        If runs of spaces rank behind everything else and, merged from the left, fall into the longest run that is a
        piece again and again, such a run can be cut off a longer one, except from its end.
        """
        if any(MARK in piece.lstrip(MARK) for piece in ids):
            return r"(?s:.+)"
        lines = "" if any("\n" in piece for piece in ids) else r"\n"
        most = max(len(piece) - len(piece.lstrip(MARK)) for piece in ids)
        runs = {len(piece) for piece in ids if not piece.strip(MARK)}

        def merged(n: int) -> list[int]:
            parts, at = [1] * n, 0
            while at + 1 < len(parts):
                if parts[at] + parts[at + 1] in runs:
                    parts[at : at + 2] = [parts[at] + parts[at + 1]]
                    at = 0
                else:
                    at += 1
            return parts

        alone = (
            most in runs
            and most > 1
            and {rank[ids[MARK * n]] for n in runs if n > 1} == {max(rank.values())}
            and all(merged(n) == [most, *merged(n - most)] for n in range(2 * most, 5 * most))
        )
        space = rf"[ {MARK}]"
        long = rf"{space}{{{most}}}(?={space}{{{2 * most}}})|" if alone else ""
        ends = rf"|{lines}+" if lines else ""
        return rf"{long}{space}*[^ {MARK}{lines}]+|{space}+{ends}"

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Places of pairs in the table, -1 for those that make no piece."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def _merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is left of the symbols, and the number of the first character of each. ``word`` numbers the words.

        Every round finds the least rank in each word and merges all its pairs of that rank, leftmost first, an
        overlapping one not; that is what merging one pair after the other gives unless a new pair ranks no later than
        the one that made it. Words where that can happen merge their leftmost pair only. Words without a pair leave.
        """
        place = np.arange(len(symbols))
        left_symbols, left_places = [], []
        same = word[1:] == word[:-1]
        pair = np.append(np.where(same, self._find(symbols[:-1].astype(np.int64) * self.width + symbols[1:]), -1), -1)
        rank = self.rank[pair]
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            if (least == NEVER).any():
                open_ = np.repeat(least != NEVER, lengths)
                left_symbols.append(symbols[~open_])
                left_places.append(place[~open_])
                symbols, word, place, pair, rank = symbols[open_], word[open_], place[open_], pair[open_], rank[open_]
                lengths, least = lengths[least != NEVER], least[least != NEVER]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(least, lengths))
            number = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.append(True, np.diff(at) > 1), number, 0))
            at = at[(number - run) % 2 == 0]
            made = self.made[pair[at]]
            early = self.early[made]
            if early.any():
                owner = word[at]
                first = np.append(True, owner[1:] != owner[:-1])
                at = at[first | ~np.isin(owner, owner[early])]
                made = self.made[pair[at]]
            symbols[at] = made
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, place, pair, rank = symbols[keep], word[keep], place[keep], pair[keep], rank[keep]
            now = at - np.arange(len(at))
            changed = np.concatenate([now, now[now > 0] - 1])
            inside = changed + 1 < len(symbols)
            pair[changed[~inside]], rank[changed[~inside]] = -1, NEVER
            changed = changed[inside]
            found = self._find(symbols[changed].astype(np.int64) * self.width + symbols[changed + 1])
            found[word[changed] != word[changed + 1]] = -1
            pair[changed], rank[changed] = found, self.rank[found]
        symbols, places = np.concatenate(left_symbols), np.concatenate(left_places)
        order = np.argsort(places)
        return symbols[order], places[order]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of every word by itself; spaces may be spaces or marks."""
        text = "".join(words).replace(" ", MARK)
        if not text:
            return [[] for _ in words]
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        cut = np.zeros(len(codes) + 1, bool)
        cut[ends] = cut[0] = True
        # No piece holds two characters that never stand side by side in one, so nothing is merged across them.
        beside = (codes[:-1] << 21) | codes[1:]
        at = np.minimum(np.searchsorted(self.joined, beside), len(self.joined) - 1)
        cut[1:-1] |= self.joined[at] != beside
        symbols, places = self._merge(self.symbol_of[codes], np.cumsum(cut[:-1]))
        bounds = [0, *np.searchsorted(places, ends).tolist()]
        ids = symbols.tolist()
        if symbols.max() >= len(self.pieces):
            out, first = [], self.special["byte"]
            for begin, end in zip(bounds, bounds[1:], strict=False):
                found = []
                for symbol, place in zip(ids[begin:end], places[begin:end].tolist(), strict=True):
                    found += [symbol] if symbol < len(self.pieces) else [first + b for b in chr(codes[place]).encode()]
                out.append(found)
            return out
        return [ids[begin:end] for begin, end in zip(bounds, bounds[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters. Without the space put before a text."""
        return self._visible(ids).removeprefix(" ")

    def _visible(self, ids: list[int]) -> str:
        first, out = self.special["byte"], []
        if self.byte_ids.isdisjoint(ids):
            return "".join([self.visible[i] for i in ids])
        held = bytearray()
        for i in ids:
            if first <= i < first + 256:
                held.append(i - first)
                continue
            out.append(held.decode("utf-8", "replace"))
            held.clear()
            out.append(self.visible[i])
        return "".join(out) + held.decode("utf-8", "replace")

    def encode_batch(self, texts: list[str]) -> list[list[tuple[int, str, str]]]:
        """For every text its chunks as (number of ids, ids in decimal, decoded); chunks not yet known are merged together."""
        chunks = [self.chunk.findall(" " + text) if text else [] for text in texts]
        found, new = self.memory.known(set(chain.from_iterable(chunks)))
        new = list(new)
        for word, ids in zip(new, self.encode_words(new), strict=True):
            decoded = self._visible(ids)
            found[word] = len(ids), " ".join([self.decimal[i] for i in ids]), word if decoded == word else decoded
        self.memory.learn({word: found[word] for word in new if len(word) <= SHORT})
        return [[found[c] for c in own] for own in chunks]


def _coder(path: str, memory: int) -> PieceBpe:
    coder = worker_memory().get((path, memory))
    if coder is None:
        coder = worker_memory()[path, memory] = PieceBpe(path, memory)
    return coder


def encode_pieces(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", end: bool = True, keep_ids: bool = True,
    memory: int = 200_000,
) -> DataFrame:
    """``(id, n_tokens long, ids_sha256 string, decoded_sha256 string[, ids array<int>])`` for every row.

    ``path`` is a ``.model`` file of a byte-fallback BPE model that all executors can read; the ids are those of the
    library without sampling, with the end id if ``end``, and are decoded again. ``ids_sha256`` is the digest of the
    decimal ids joined by spaces. A null text counts as empty: the end id alone, and nothing decoded. Special strings in
    a text are ordinary text. Repeated rows give repeated results, an empty table an empty result; other columns are
    not read. A text may be of any length, but must fit into a worker; it is cut where no piece spans, and texts of
    about BATCH_CHARS characters are merged together. ``memory`` chunks are remembered, twice over; less costs time only.
    """
    schema = docs.select(id_column).schema.add("n_tokens", "long", False).add("ids_sha256", "string", False)
    schema = schema.add("decoded_sha256", "string", False)
    if keep_ids:
        schema = schema.add("ids", ArrayType(IntegerType(), False), False)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, memory)
        last = [str(coder.special["end"])] if end else []
        for batch in batches:
            counts, digests, back, kept = [], [], [], []
            for texts in text_batches(batch.column(1), BATCH_CHARS):
                with paused_collection():
                    encoded = coder.encode_batch(texts)
                for parts in encoded:
                    decimals = " ".join([d for _, d, _ in parts] + last)
                    decoded = "".join([d for _, _, d in parts]).removeprefix(" ")
                    counts.append(sum([n for n, _, _ in parts]) + len(last))
                    digests.append(hashlib.sha256(decimals.encode()).hexdigest())
                    back.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if keep_ids:
                        kept.append(np.array(decimals.split(), np.int32))
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())]
            if keep_ids:
                offsets = np.cumsum([0, *counts]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.array([], np.int32), *kept]))))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(id_column, text_column).mapInArrow(encode, schema)


def decode_pieces(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``(id, decoded string)``: the text that the ids stand for, without begin and end. Null ids give an empty text; an
    id that the model does not have is an error."""
    schema = encoded.select(id_column).schema.add("decoded", "string", False)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, 1)
        for batch in batches:
            out = [coder.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=schema.names)

    return encoded.select(id_column, ids_column).mapInArrow(decode, schema)
