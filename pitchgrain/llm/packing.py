"""Packing by powers of two.

A document's tokens, its end token included, are cut into full sequences and the binary digits of
what is left: 4096, 4096, 1024, 8, 1. Each piece is a sequence of its own, so none crosses documents
and none needs padding, and pieces of equal length form a bucket from which batches of one shape
can be drawn. No row moves: a task numbers its own pieces.

``sequence_id`` holds the bucket (bits 56 up), the task (32 to 55) and a number within both, so a
bucket is one range of ids. A task that runs again after a loss reads the same rows in the same
order and gives the same ids.

Tokens come from the tokenizer's vocabulary alone. Words are cut at ASCII blanks, which no token of
this vocabulary spans, and each task encodes a word once while it is remembered. Ids are kept as
bytes in one Arrow array, since several tasks share an executor's memory.

Cases: a null or empty text is its end token alone. Repeated rows are packed each for itself, rows
with a null ``doc_id`` too. A text of any length is cut whole. Other columns are not read. An empty
table gives no pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.shared import text_or_empty

MOST = 4096
END_ID = 2
#: Pieces, and bytes of theirs, that a task remembers before it starts afresh, and characters that it encodes at a time.
REMEMBERED = 1_000_000
REMEMBERED_BYTES = 32_000_000
SLICE_CHARS = 4_000_000
#: Pieces of letters that are encoded as one text, and texts that are handed to the tokenizer at a time.
JOINED, BATCH = 256, 16
ID = "<u4"

#: Words of letters whose lower case is one letter and which composition leaves alone, then plain signs:
#: the vocabulary's rule cuts between the two, so each can be encoded, and remembered, for itself.
PLAIN = "^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,!?|;:%$#&*]*)$"

SCHEMA = (
    "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class Encoder:
    """Token ids of pieces of text, remembered for the task's next texts."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        #: Which ids end a word, where the vocabulary marks that.
        self.ends = None
        if suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None):
            names = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(names.values()) + 1, bool)
            self.ends[[i for name, i in names.items() if name.endswith(suffix)]] = True
        self.forget(pa.string())

    def forget(self, kind: pa.DataType) -> None:
        self.known, self.ids = pa.array([""], kind), pa.array([b""], pa.large_binary())

    def found(self, texts: list[str]) -> Iterator[np.ndarray]:
        for k in range(0, len(texts), BATCH):
            for x in self.tokenizer.encode_batch_fast(texts[k : k + BATCH], add_special_tokens=False):
                yield np.array(x.ids, ID)

    def remember(self, pieces: pa.Array, ids: list[np.ndarray], sizes: np.ndarray) -> None:
        """``ids`` in any parts; ``sizes`` of each piece."""
        offsets = np.concatenate(([0], np.cumsum(sizes))) * np.dtype(ID).itemsize
        data = np.concatenate([*ids, np.empty(0, ID)])
        fresh = pa.Array.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
        self.known, self.ids = pa.concat_arrays([self.known, pieces]), pa.concat_arrays([self.ids, fresh])

    def learn(self, pieces: pa.Array) -> None:
        """Remember the ids of pieces that are not known.

        Each letter is part of a word, so a piece of letters has one word's end at least. If pieces, joined by
        blanks, have as many ends as there are pieces, then each has one, and the ends tell them apart.
        """
        alone = np.ones(len(pieces), bool)
        if self.ends is not None:
            at = np.flatnonzero(pc.utf8_is_alpha(pieces).to_numpy(zero_copy_only=False))
            bounds = np.append(np.arange(0, len(at), JOINED), len(at))
            groups = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pieces.take(pa.array(at)))
            joined = pc.binary_join(groups, pa.scalar(" ", pieces.type)).to_pylist()
            told, ids, sizes = [], [], []
            for group, found in zip(np.split(at, bounds[1:-1]), self.found(joined), strict=False):
                stops = np.flatnonzero(self.ends[found]) + 1
                if len(stops) == len(group) and len(stops) and stops[-1] == len(found):
                    told.append(group)
                    ids.append(found)
                    sizes.append(np.diff(stops, prepend=0))
            if told:
                alone[np.concatenate(told)] = False
                self.remember(pieces.take(pa.array(np.concatenate(told))), ids, np.concatenate(sizes))
        others = pieces.filter(pa.array(alone))
        ids = list(self.found(others.to_pylist()))
        self.remember(others, ids, np.array([len(x) for x in ids], np.int64))

    def encode(self, pieces: pa.Array) -> pa.Array:
        """The ids of each piece as bytes; no piece comes twice."""
        if len(self.known) > REMEMBERED or self.known.nbytes > REMEMBERED_BYTES or self.known.type != pieces.type:
            self.forget(pieces.type)
        at = pc.index_in(pieces, self.known)
        if at.null_count:
            before, fresh = len(self.known), pieces.filter(at.is_null())
            self.learn(fresh)
            at = pc.replace_with_mask(at, at.is_null(), pc.add(pc.index_in(fresh, self.known[before:]), pa.scalar(before, pa.int32())))
        return self.ids.take(at)


def token_ids(texts: pa.Array, encoder: Encoder, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids in one array, each text's end id last, and where each text begins."""
    split = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    del split
    plain = pc.extract_regex(coded.dictionary, PLAIN)
    head = pc.coalesce(pc.utf8_lower(pc.struct_field(plain, "head")), coded.dictionary)
    tail = pc.coalesce(pc.struct_field(plain, "tail"), "")
    pieces = pa.concat_arrays([head, tail]).dictionary_encode()
    both = encoder.encode(pieces.dictionary).take(pieces.indices)
    words = pc.binary_join_element_wise(both[: len(head)], both[len(head) :], pa.scalar(b"", pa.large_binary()))
    words = pa.concat_arrays([words, pa.array([np.array([end_id], ID).tobytes()], pa.large_binary())])

    # Words' places, and behind each text's last word that of the end.
    stop = np.cumsum(counts + 1)
    place = np.full(stop[-1] if len(stop) else 0, len(words) - 1, np.int32)
    inner = np.ones(len(place), bool)
    inner[stop - 1] = False
    place[inner] = coded.indices.to_numpy(zero_copy_only=False)
    taken = words.take(pa.array(place))
    _, offsets, data = taken.buffers()
    at = np.concatenate(([0], np.frombuffer(offsets, np.int64)[stop])) // np.dtype(ID).itemsize
    return np.frombuffer(data or b"", ID, at[-1]), at


def cut(tokens: int, most: int = MOST) -> list[int]:
    """Lengths of the pieces: full ones, then the powers of two of the rest, falling."""
    rest = tokens % most
    return [most] * (tokens // most) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def slices(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about so many characters; a longer text is a range of its own."""
    sizes, begin, held = pc.utf8_length(texts).to_pylist(), 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > chars:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def pack(docs: DataFrame, vocabulary: str, most: int = MOST, end_id: int = END_ID) -> DataFrame:
    """One row for each piece, with its token ids; see the module for the columns."""
    if most & (most - 1):
        raise ValueError("the longest sequence must be a power of two")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, used = Encoder(vocabulary), TaskContext.get().partitionId(), {}
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for lo, hi in slices(texts):
                ids, at = token_ids(texts[lo:hi], encoder, end_id)
                row, start, length, sequence = [], [], [], []
                for k, tokens in enumerate(np.diff(at).tolist()):
                    begin = 0
                    for n in cut(tokens, most):
                        row.append(k)
                        start.append(begin)
                        length.append(n)
                        used[n] = used.get(n, -1) + 1
                        sequence.append((n.bit_length() - 1) << 56 | task << 32 | used[n])
                        begin += n
                row_, start_, length_ = (np.array(x, np.int64) for x in (row, start, length))
                raw = memoryview(ids).cast("B")
                places = (at[row_] + start_).tolist()
                crc = [zlib.crc32(raw[4 * p : 4 * (p + n)]) for p, n in zip(places, length, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids[lo:hi].take(pa.array(row_)),
                        pa.array(start_),
                        pa.array(length_),
                        pa.ListArray.from_arrays(pa.array(np.append(places, len(ids)).astype(np.int32)), pa.array(ids.view(np.int32))),
                        pa.array(crc, pa.int64()),
                        pa.array(np.diff(at)[row_]),
                        pa.array(sequence, pa.int64()),
                        pa.array(np.zeros(len(row), np.int64)),
                    ],
                    names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(pieces, SCHEMA)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder for each length, so that a reader draws batches of one shape."""
    pieces.write.partitionBy("length").parquet(path)
