"""Removal of long byte strings that occur earlier in the corpus.

Induced sorting names a sample of the suffixes, decides it recursively and induces the rest. The same is done here with
Spark's external sort and shuffle, so that nothing has to fit into a task: the sampled places are those that every
window of 100 bytes chooses by itself (the least hash of its 32-byte strings), a tuple per place stands for all windows
that chose it, and equal tuples get one name, the first occurrence. All other occurrences are decided by their name
alone. First occurrences whose common prefix (the part that all their windows share) occurs in tuples of other names
too are split into shorter ranges of windows and named again, down to single windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, staged
from ledgerloom.llm.rolling import JOIN, Powers, mixed, prefix_hashes

#: Bytes of a string that may not repeat, and of the strings whose least hash is a window's place.
LENGTH, SEED = 100, 32
#: Windows of a long text that are handled at a time.
BLOCK = 1 << 19
#: Widths of the ranges of window offsets at the levels below the first.
WIDTHS = (17, 4, 1)


def places(data: np.ndarray, length: int, powers: Powers) -> Iterator[tuple[np.ndarray, ...]]:
    """For ranges of consecutive windows with one place: hash of the seed there, hash of all their bytes, place, first
    and last start of a window."""
    width = length - SEED + 1
    for begin in range(0, len(data) - length + 1, BLOCK):
        part = data[begin : begin + BLOCK + length - 1]
        n = len(part)
        up, down = powers(n + 1)
        sums = prefix_hashes(part, up)
        seeds = mixed((sums[SEED:] - sums[:-SEED]) * down[: n - SEED + 1])
        index = np.uint64((1 << 20) - 1)
        least = (seeds & ~index) | np.arange(len(seeds), dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[: size - width], least[width - size :])
        at = (least & index).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        place = at[first]
        whole = (sums[last + length] - sums[first]) * down[first]
        whole += (place - first).astype(np.uint64) * JOIN[0] + (last - first).astype(np.uint64) * JOIN[1]
        yield seeds[place], mixed(whole), place + begin, first + begin, last + begin


def _first_level(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            ids, found = [], []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
                if len(data) >= length and doc.is_valid:
                    for some in places(data, length, powers):
                        found.append(some)
                        ids.append(np.full(len(some[0]), doc.as_py(), np.int64))
            if found:
                seed, whole, place, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
                packed = place << 16 | (place - last) << 8 | (place - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(np.concatenate(ids)), pa.array(packed)],
                    names=["core", "whole", "doc_id", "at"],
                )

    return rows


def _contexts(length: int):
    """The bytes around first occurrences, from the texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_buffer()
                at = batch.column(2)[i].values.to_numpy()
                place, high, low = at >> 16, at & 255, at >> 8 & 255
                begin, end = place - high, place - low + length
                data = np.frombuffer(text, np.uint8)
                raw = data.tobytes()
                around = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
                doc = pa.array(np.full(len(at), batch.column(0)[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([doc, pa.array(at), pa.array(around, pa.binary())], names=["doc_id", "at", "around"])

    return rows


def _split(length: int, width: int):
    """Cuts ranges of window offsets at multiples of ``width``; each part with the hashes of what its windows share
    (if the range is whole) and of all its bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, at, around in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                place, low, high = at >> 16, at >> 8 & 255, at & 255
                data = np.frombuffer(around, np.uint8)
                up, down = powers(len(data) + 1)
                sums = prefix_hashes(data, up)
                for cell in range(low // width, high // width + 1):
                    a, b = max(low, cell * width), min(high, cell * width + width - 1)
                    # Offsets of windows against the place; byte j of ``around`` lies at place - high + j.
                    core_begin, core_end = high - cell * width, high - (cell * width + width - 1) + length
                    begin, end = high - b, high - a + length
                    core = (int(sums[core_end]) - int(sums[core_begin])) * int(down[core_begin])
                    whole = (int(sums[end]) - int(sums[begin])) * int(down[begin]) + a * int(JOIN[2]) + b * int(JOIN[3])
                    out[0].append((core + cell * int(JOIN[4])) & (2**64 - 1))
                    out[1].append(whole & (2**64 - 1))
                    out[2].append(doc)
                    out[3].append(place << 16 | a << 8 | b)
                    out[4].append(around[begin:end])
            if out[0]:
                hashes = [pa.array(mixed(np.array(x, np.uint64)).view(np.int64)) for x in out[:2]]
                yield pa.RecordBatch.from_arrays(
                    [*hashes, pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary())],
                    names=["core", "whole", "doc_id", "at", "around"],
                )

    return rows


def _named(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` whose core occurs in another row too, with ``repeated`` (not the first of its name) and ``open`` (the
    first of its name, while other names share its core)."""
    names = rows.groupBy("core", "whole").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
    names = staged(names, f"{name}-names")
    several = names.groupBy("core").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("core", F.lit(True).alias("shared"))
    keep = names.filter("n > 1").select("core", "whole", "first").join(several, "core", "left")
    alone = names.filter("n = 1").select("core", "whole", "first").join(several, "core")
    known = staged(keep.unionByName(alone).withColumnsRenamed({"core": "_core", "whole": "_whole"}), f"{name}-known")
    joined = rows.join(known, (F.col("core") == F.col("_core")) & (F.col("whole") == F.col("_whole")))
    own = F.struct("doc_id", "at")
    flagged = joined.withColumn("repeated", own != F.col("first")).withColumn("open", ~F.col("repeated") & F.col("shared").isNotNull())
    out = staged(flagged.filter("repeated or open").select(*rows.columns, "repeated", "open"), name)
    discard(names, known, rows)
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, begin, end)``: byte ranges, possibly overlapping, that together cover every string of ``length``
    bytes that also starts earlier (in a document with a smaller id, or earlier in the same one). ``length`` lies
    between 40 and 250."""
    texts = docs.select("doc_id", "text").filter((F.octet_length("text") >= length) & F.col("doc_id").isNotNull())
    ids = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # The rows are made twice from the texts, which costs less than keeping them.
    rows = ids.mapInArrow(_first_level(length), "core long, whole long, doc_id long, at long")
    cores = staged(rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core"), "cores")
    shared = staged(rows.join(cores, "core", "left_semi"), "shared")
    discard(cores)
    level = _named(shared, "level0")
    spans = [level.filter("repeated").select("doc_id", "at")]
    wanted = level.filter("open").groupBy("doc_id").agg(F.collect_list("at").alias("places"))
    wanted = wanted.withColumnRenamed("doc_id", "_id")
    found = ids.join(wanted, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "places")
    todo = staged(found.mapInArrow(_contexts(length), "doc_id long, at long, around binary").distinct(), "around")
    schema = "core long, whole long, doc_id long, at long, around binary"
    for depth, width in enumerate(WIDTHS, 1):
        if todo.isEmpty():
            break
        parts = staged(todo.select("doc_id", "at", "around").mapInArrow(_split(length, width), schema), f"split{depth}")
        level = _named(parts, f"level{depth}")
        spans.append(level.filter("repeated").select("doc_id", "at"))
        todo = level.filter("open")
    out = spans[0]
    for more in spans[1:]:
        out = out.union(more)
    place = F.shiftright("at", 16)
    high, low = F.col("at").bitwiseAND(F.lit(255)), F.shiftright("at", 8).bitwiseAND(F.lit(255))
    return out.select("doc_id", (place - high).alias("begin"), (place - low + length).alias("end"))


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans`` (long), ``kept`` (binary), ``kept_sha256`` and ``kept_text`` added:
    the texts without the bytes of the spans; as text without the parts of characters that a cut leaves over. Columns
    of the same names are replaced."""
    made = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary", "kept_sha256": "string", "kept_text": "string"}
    columns = [c for c in docs.columns if c not in made]
    lists = spans.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.struct("begin", "end")).alias("_spans"))
    joined = docs.select(*columns).join(lists, F.col("doc_id").cast("long") == F.col("_id"), "left").drop("_id")
    schema = docs.select(*columns).schema
    for name, kind in made.items():
        schema = schema.add(name, kind)
    text_at = columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in made]
            ranges = batch.column(len(columns))
            for i in range(batch.num_rows):
                text = batch.column(text_at)[i].as_py()
                data = b"" if text is None else text.encode()
                kept, runs, removed, stop = [], 0, 0, -1
                at = 0
                if ranges[i].is_valid:
                    flat = ranges[i].values.flatten()
                    pairs = np.column_stack([x.to_numpy() for x in flat])
                    for b, e in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
                        e = min(e, len(data))
                        if b >= len(data):
                            break
                        if b > stop:
                            runs += 1
                            kept.append(data[at:b])
                        removed += max(0, e - max(b, stop))
                        stop = max(stop, e)
                        at = stop
                kept.append(data[at:])
                rest = b"".join(kept)
                for column, value in zip(out, (len(data), removed, runs, rest, hashlib.sha256(rest).hexdigest(), rest.decode(errors="ignore")), strict=True):
                    column.append(value)
            arrays = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *arrays], names=[*columns, *made])

    return joined.mapInArrow(cut, schema)


def suffix_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans`` (long), ``kept`` (binary), ``kept_sha256`` and
    ``kept_text`` added.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller id or
    earlier in the same document. Strings are judged on the input, matches never cross documents. ``n_spans`` counts
    the maximal removed runs.

    Texts are UTF-8 bytes; a null text counts as empty, texts shorter than ``length`` stay whole. ``doc_id`` names a
    text: rows that repeat an id with its text are one document and get the same result; rows without an id are left
    whole and compared with nothing. An empty table gives an empty result. A text may be of any length.
    """
    return remove_spans(docs, repeated_spans(docs, length))
