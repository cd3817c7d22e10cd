"""Token counts: batch encoding inside Arrow functions that return lengths only."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.byte_bpe import blank_chunks
from ledgerloom.llm.common import Recent, text_batches, worker_memory

#: Bytes of a batch given to the tokenizer.
BATCH_BYTES = 1 << 20
#: Pieces remembered by a worker, and characters of texts that are looked up together.
MEMORY, TEXT_BYTES = 600_000, 1 << 21


def _lengths(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to token counts, and whether texts may be cut before white space."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]), False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec.get("pre_tokenizer") or {}
    cuttable = (
        before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and spec.get("normalizer") is None
        and not any(len(blank_chunks(x["content"])) > 1 or x["lstrip"] or x["rstrip"] for x in spec.get("added_tokens", ()))
    )
    return (lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]), cuttable


def by_bytes(texts: list[str], limit: int) -> Iterator[list[str]]:
    """Batches of about the same number of bytes, longest text first, so that none waits for one long text."""
    held, size = [], 0
    for text in sorted(texts, key=len, reverse=True):
        held.append(text)
        size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def token_counts(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_bytes long, n_tokens long)`` for every row.

    ``tokenizer`` is the path of a ``.json`` or ``.model`` file that all executors can read. A null or empty text has
    0 bytes and 0 tokens. Texts for a byte-level tokenizer are cut before white space, where it begins a new pre-token
    anyway, so the counts of the pieces add up exactly; pieces that a batch holds often are encoded once. Other kinds
    of tokenizer get the text whole. Encoder batches hold about the same number of bytes. Repeated rows give repeated
    results, an empty table an empty result; other columns are not read.
    """
    schema = docs.select(id_column).schema.add("n_bytes", "long", False).add("n_tokens", "long", False)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = worker_memory().get(("lengths", tokenizer))
        if loaded is None:
            loaded = worker_memory()["lengths", tokenizer] = (*_lengths(tokenizer), Recent(MEMORY))
        lengths, cuttable, memory = loaded
        for batch in batches:
            sizes, counts = [], []
            for texts in text_batches(batch.column(1), TEXT_BYTES):
                sizes += [len(x.encode()) for x in texts]
                if not cuttable:
                    known = dict.fromkeys(texts)
                    known.pop("", None)
                    for some in by_bytes(list(known), BATCH_BYTES):
                        known |= zip(some, lengths(some), strict=True)
                    counts += [known.get(x, 0) for x in texts]
                    continue
                pieces = [blank_chunks(x) for x in texts]
                found, new = memory.known(set(chain.from_iterable(pieces)))
                for some in by_bytes(list(new), BATCH_BYTES):
                    found |= zip(some, lengths(some), strict=True)
                memory.learn({piece: found[piece] for piece in new if len(piece) <= 64})
                counts += [sum(map(found.__getitem__, x)) for x in pieces]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=schema.names
            )

    return docs.select(id_column, text_column).mapInArrow(count, schema)
