"""Repeated byte strings by suffix sorting, distributed by minimizers.

Every string of ``LENGTH`` bytes has one minimizer: of the ``GRAM``-byte grams inside it, the one with
the least hash (the first of equal ones). Equal strings have equal minimizers at equal places, so
only strings around equal minimizers need to be compared, wherever they are.

1. A text is cut into stretches: runs of neighbouring strings with the same minimizer. A stretch is
   sent as two hashes (its minimizer's and its whole content's) and its place; equal stretches count
   as one from here. Stretches with a minimizer that the corpus holds once are done with.
2. A stretch that occurs twice repeats in all its strings. Different stretches with one minimizer
   may share some: their bytes are fetched once for each different stretch and sorted.
3. Tasks leave out strings that cannot repeat, as no other stretch holds the bytes inside them around the
   minimizer, sort the others as suffixes in two stages (``suffix_sort``) and compare neighbours: strings
   whose prefix is shared over the whole length repeat.
4. Repeated strings return to their texts as ranges, and the ranges' union is removed.

A minimizer with more than ``CROWD`` different stretches (the edge of a very common passage) is not
sorted in one task. Its stretches are cut into blocks of ``WIDTHS`` strings by where the minimizer lies
in them, and a block goes with those that hold the same bytes around it; equal blocks count as one.
What is still crowded is cut finer, to single strings at last, whose equality needs no sorting.
Equality of 64 bits of minimizer and 64 of content is taken as equality.

Cases: null and empty texts have no bytes; texts shorter than ``LENGTH`` are left alone. Repeated rows
repeat each other's strings, with equal or null ids too. Long texts are worked in blocks. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.packing import slices
from pitchgrain.llm.shared import discard, materialise, text_or_empty
from pitchgrain.llm.shingles import mixed
from pitchgrain.llm.suffix_sort import common_prefixes, suffix_array

LENGTH = 200
GRAM = 32
CROWD = 1000
WIDTHS = (42, 10, 2, 1, 0)
#: Strings of a block by which a task leaves out what cannot repeat before it sorts.
NARROW = 10
#: Strings that are worked at a time, and bytes that are sorted at a time.
BLOCK = 1 << 21
SORTED = 1 << 21

_PLACE = np.uint64((1 << 28) - 1)
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def gram_hashes(data: bytes, count: int) -> np.ndarray:
    """64-bit hashes of the ``GRAM`` bytes from each of the first ``count`` positions."""
    eight = np.empty(count + GRAM - 8, np.uint64)
    for r in range(8):
        part = eight[r::8]
        part[:] = np.frombuffer(data, "<u8", len(part), r)
    with np.errstate(over="ignore"):
        total = np.zeros(count, np.uint64)
        for k, factor in enumerate(_FACTORS):
            total = mixed(total + eight[8 * k : 8 * k + count]) * factor
    return total


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(data: memoryview, ends: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """Of the texts that lie one behind the other in ``data`` and end at ``ends``: for each stretch its
    minimizer's hash, its content's hash, where its first string begins in ``data``, and its strings."""
    total = int(ends[-1]) if len(ends) else 0
    begin = 0
    while begin + length <= total:
        last = min(begin + BLOCK, total - length + 1)
        part = data[begin : last + length - 1]
        grams = last - begin + length - GRAM
        hashes = gram_hashes(part, grams)
        ranked = (hashes & ~_PLACE) | np.arange(grams, dtype=np.uint64)
        chosen = (least_of(ranked, length - GRAM + 1) & _PLACE).astype(np.int64)
        start = np.arange(begin, last)
        inside = ends[np.searchsorted(ends, start, side="right")] - start >= length
        kept = np.flatnonzero(inside)
        if len(kept):
            picked = chosen[kept]
            new = np.append(True, (picked[1:] != picked[:-1]) | (np.diff(kept) != 1))
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(kept)))
            at = kept[first]
            content = np.array([xxhash.xxh3_64_intdigest(part[p : p + n + length - 1]) for p, n in zip(at.tolist(), size.tolist(), strict=True)], np.uint64)
            yield hashes[picked[first]].view(np.int64), content.view(np.int64), at + begin, size
        begin = last


def bytes_of(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The texts' bytes one behind the other, and where each ends."""
    whole = texts.cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, 8 * whole.offset)
    data = whole.buffers()[2]
    return memoryview(data)[offsets[0] : offsets[-1]] if data else memoryview(b""), offsets[1:] - offsets[0]


def cut(texts: DataFrame, length: int) -> DataFrame:
    """doc_id, text_key, gram, content, size, starts (from 0): the stretches of each text, equal ones of a text in one row."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                data, ends = bytes_of(batch.column("text")[lo:hi])
                for gram, content, at, size in stretches(data, ends, length):
                    owner = np.searchsorted(ends, at, side="right")
                    start = at - np.append(0, ends)[owner]
                    order = np.lexsort((start, size, content, gram, owner))
                    columns = [x[order] for x in (owner, gram, content, size)]
                    new = np.append(True, np.any([x[1:] != x[:-1] for x in columns], axis=0))
                    first = np.flatnonzero(new)
                    rows = pa.array(columns[0][first] + lo)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(rows),
                            batch.column("text_key").take(rows),
                            *(pa.array(x[first]) for x in columns[1:3]),
                            pa.array(columns[3][first].astype(np.int32)),
                            pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), pa.array(start[order].astype(np.int32))),
                        ],
                        names=["doc_id", "text_key", "gram", "content", "size", "starts"],
                    )

    return texts.mapInArrow(found, "doc_id long, text_key long, gram long, content long, size int, starts array<int>")


def fetched(wanted: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """gram, content, bytes of the stretches in ``wanted``, cut from their texts."""
    lists = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("gram", "content", "size", "start")).alias("places"))
    lists = lists.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"})
    met = texts.join(lists, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")))
    placed = met.select(F.col("text").cast("binary").alias("text"), F.explode("places").alias("p"))
    return placed.select("p.gram", "p.content", F.expr("substring(text, p.start + 1, p.size + %d)" % (length - 1)).alias("bytes"))


def alike(keys: list[tuple[int, int, int]], parts: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """A part's number, and first and last string (from 0), of each run of strings that may occur in another part of its group.

    Strings are told apart by blocks as in ``split_parts``: equal ones are in blocks of one number and with one core,
    so a block whose core no other part of the group (gram, core) holds has none that repeats.
    """
    width = min(NARROW, length - GRAM + 1)
    grams, cores = (np.array([k[i] for k in keys], np.int64) for i in (0, 1))
    sizes = np.array([len(p) for p in parts])
    begin, strings = np.cumsum(sizes) - sizes, sizes - length + 1
    hashes = gram_hashes(b"".join(parts), int(sizes.sum()) - GRAM + 1)
    # The minimizer is the first gram with its hash of those inside all strings of the part.
    met = np.flatnonzero(hashes.view(np.int64) == np.repeat(grams, sizes)[: len(hashes)])
    of = np.searchsorted(begin, met, side="right") - 1
    place = met - begin[of]
    inside = (place >= strings[of] - 1) & (place <= length - GRAM)
    anchor = place[inside][np.unique(of[inside], return_index=True)[1]]

    low, high = (anchor - strings + 1) // width, anchor // width
    blocks = high - low + 1
    part = np.repeat(np.arange(len(parts)), blocks)
    block = np.arange(len(part)) - np.repeat(np.cumsum(blocks) - high - 1, blocks)
    at, last = begin[part] + anchor[part] - block * width, length + 1 - width - GRAM
    with np.errstate(over="ignore"):
        core = mixed(grams.view(np.uint64) * _FACTORS[0] + cores.view(np.uint64))[part] + block.view(np.uint64)
        for shift in (*range(0, last, GRAM), last):
            core = mixed(core * _FACTORS[1] + hashes[at + shift])
    _, kind, times = np.unique(core, return_inverse=True, return_counts=True)
    live = np.flatnonzero(times[kind] > 1)
    if len(live):
        part, block = part[live], block[live]
        first = np.flatnonzero(np.append(True, (np.diff(part) != 0) | (np.diff(block) != 1)))
        final = np.append(first[1:], len(live)) - 1
        part, least, most = part[first], block[first], block[final]
        lo, hi = np.maximum(anchor[part] - most * width - width + 1, 0), np.minimum(anchor[part] - least * width, strings[part] - 1)
        yield from zip(part.tolist(), lo.tolist(), hi.tolist(), strict=True)


def repeated_in(keys: list[tuple[int, int, int]], parts: list[bytes], length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """A part's key, and first and last string (from 0), of each run of strings that occur in another part."""
    runs = list(alike(keys, parts, length))
    if not runs:
        return
    base = [lo for _, lo, _ in runs]
    keys, parts = [keys[k] for k, _, _ in runs], [parts[k][lo : hi + length] for k, lo, hi in runs]
    text = np.frombuffer(b"\xff".join(parts), np.uint8)  # no UTF-8 text holds that byte
    order = suffix_array(text, length)
    shared = common_prefixes(text, order, length) >= length
    hit = np.append(shared, False) | np.append(False, shared)
    bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
    strings = np.array([len(p) - length + 1 for p in parts])
    at = np.sort(order[hit])
    part = np.searchsorted(bounds, at, side="right") - 1
    inner = at - bounds[part]
    at, part, inner = (x[inner < strings[part]] for x in (at, part, inner))
    if len(at):
        first = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(part) != 0)))
        last = np.append(first[1:], len(at)) - 1
        for f, z in zip(first.tolist(), last.tolist(), strict=True):
            yield (*keys[part[f]], base[part[f]] + int(inner[f]), base[part[f]] + int(inner[z]))


def sorted_groups(parts: DataFrame, length: int) -> DataFrame:
    """gram, core, sub, lo, hi: runs of strings of a part that occur in other parts of its group (gram, core)."""
    kinds = [("gram", pa.int64()), ("core", pa.int64()), ("sub", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, size = [], [], 0

        def flush() -> pa.RecordBatch:
            rows = list(repeated_in(keys, held, length)) if held else []
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])

        for batch in batches:
            for gram, core, sub, part in zip(*(batch.column(c).to_pylist() for c in ("gram", "core", "sub", "bytes")), strict=True):
                if size > SORTED and (gram, core) != keys[-1][:2]:
                    yield flush()
                    keys, held, size = [], [], 0
                keys.append((gram, core, sub))
                held.append(part)
                size += len(part)
        yield flush()

    ready = parts.select("gram", "core", "sub", "bytes").repartition("gram", "core").sortWithinPartitions("gram", "core")
    return ready.mapInArrow(found, "gram long, core long, sub long, lo int, hi int")


def split_parts(parts: DataFrame, width: int, length: int) -> DataFrame:
    """Each part cut into blocks of ``width`` strings by where the minimizer lies in them.

    Equal strings are in blocks of one number, and all strings of a block hold the same bytes around
    the minimizer, its core. So blocks with different cores share nothing and go to different groups.
    """
    names = ["gram", "content", "base", "strings", "core", "sub", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for gram, content, base, data in zip(*(batch.column(c).to_pylist() for c in ("gram", "content", "base", "bytes")), strict=True):
                strings = len(data) - length + 1
                hashes = gram_hashes(data, len(data) - GRAM + 1)[strings - 1 : length - GRAM + 1].view(np.int64)
                anchor = strings - 1 + int(np.flatnonzero(hashes == gram)[0])
                for block in range((anchor - strings + 1) // width, anchor // width + 1):
                    low, high = max(anchor - block * width - width + 1, 0), min(anchor - block * width, strings - 1)
                    centre = data[anchor - block * width : anchor - block * width - width + 1 + length]
                    piece = data[low : high + length]
                    rows.append((gram, content, base + low, high - low + 1, xxhash.xxh3_64_intdigest(centre, block) - 2**63, xxhash.xxh3_64_intdigest(piece) - 2**63, piece))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return parts.select("gram", "content", "base", "bytes").mapInArrow(cut_up, "gram long, content long, base int, strings int, core long, sub long, bytes binary")


def shared_runs(parts: DataFrame, length: int) -> DataFrame:
    """gram, content, lo, hi: runs of strings of each stretch that occur in others, of ``parts`` (gram,
    content, base, strings, core, sub, bytes), which are stretches or blocks of them."""
    found = []
    for width in WIDTHS:
        group, same = ["gram", "core"], ["gram", "core", "sub"]
        counts = materialise(parts.groupBy(same).agg(F.count(F.lit(1)).alias("n")), "counts")
        equal = parts.join(counts.where("n > 1"), same)
        found.append(equal.select("gram", "content", F.col("base").alias("lo"), (F.col("base") + F.col("strings") - 1).alias("hi")))
        sizes = counts.groupBy(group).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        sizes = materialise(sizes, "sizes")
        some = parts.join(sizes.where(F.col("kinds") <= CROWD), group).dropDuplicates(same)
        runs = sorted_groups(some, length).join(parts.select("content", "base", *same), same)
        found.append(runs.select("gram", "content", F.col("base") + F.col("lo"), F.col("base") + F.col("hi")))
        crowds = sizes.where(F.col("kinds") > CROWD).select(group)
        if width == 0 or crowds.isEmpty():
            break
        parts = materialise(split_parts(parts.join(crowds, group).dropDuplicates(same), width, length), "blocks")
    return reduce(DataFrame.union, found)


def repeated_ranges(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text_key, ranges (first byte, byte behind the last; sorted, not merged) of texts that repeat."""
    all_ = materialise(cut(texts, length), "stretches")
    often = all_.groupBy("gram").agg(F.sum(F.size("starts")).alias("n")).where("n > 1").select("gram")
    held = materialise(all_.join(materialise(often, "grams"), "gram"), "held")
    discard(all_)

    kinds = held.groupBy("gram", "content").agg(
        F.sum(F.size("starts")).alias("n"),
        F.min(F.struct("doc_id", "text_key", "size", F.col("starts")[0].alias("start"))).alias("at"),
    )
    kinds = materialise(kinds, "kinds")
    # A minimizer matters here if it has different stretches and one of them occurs once.
    mixed_ = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    mixed_ = materialise(mixed_.select("gram", "kinds"), "mixed")
    wanted = kinds.join(mixed_, "gram").select("gram", "content", "at.*")
    pieces = fetched(wanted, texts, length)
    parts = pieces.select("gram", "content", F.lit(0).alias("base"), (F.octet_length("bytes") - length + 1).alias("strings"), F.lit(0).cast("long").alias("core"), F.col("content").alias("sub"), "bytes")
    some = shared_runs(materialise(parts.dropDuplicates(["gram", "content"]), "parts"), length)
    whole = kinds.where("n > 1").select("gram", "content", F.lit(0).alias("lo"), (F.col("at.size") - 1).alias("hi"))
    once = kinds.where("n = 1").select("gram", "content")
    runs = whole.union(some.join(once, ["gram", "content"], "left_semi"))
    marks = materialise(runs.groupBy("gram", "content").agg(F.collect_list(F.struct("lo", "hi")).alias("runs")), "marks")

    hits = held.join(marks, ["gram", "content"]).select("doc_id", "text_key", F.explode("starts").alias("start"), "runs")
    spans = hits.select("doc_id", "text_key", F.explode(F.expr(f"transform(runs, r -> struct(start + r.lo as b, start + r.hi + {length} as e))")).alias("span"))
    return spans.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("span")).alias("ranges"))


def strip_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans, kept (binary): one row for each row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    texts = texts.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    ranges = repeated_ranges(texts.where(F.octet_length("text") >= length), length)
    # Held with the ranges, a text needs no second look-up; ids repeat at times, so the text's hash decides.
    ranges = ranges.toDF("of_id", "of_key", "ranges")
    met = texts.join(ranges, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")

    def stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans, removed, sizes = [], [], [], []
            for text, ranges_ in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                data, union = text.encode(), []
                for r in ranges_ or []:
                    if union and r["b"] <= union[-1][1]:
                        union[-1][1] = max(union[-1][1], r["e"])
                    else:
                        union.append([r["b"], r["e"]])
                edges = [0, *(x for u in union for x in u), len(data)]
                kept.append(b"".join(data[b:e] for b, e in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"b": b, "e": e} for b, e in union])
                removed.append(sum(e - b for b, e in union))
                sizes.append(len(data))
            span = pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(map(len, spans), pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<b: int, e: int>>, kept binary"
    return met.select("doc_id", "text", "ranges").mapInArrow(stripped, schema)
