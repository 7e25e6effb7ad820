"""Text to vector as an Arrow-batched pandas UDF. The encoder is a parameter."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchgrain.schemas import EMBEDDING_WIDTH

# Fixed value: put in front of a search text, never in front of a document.
QUERY_PREFIX = "Represent this sentence for searching relevant passages: "

BATCH = 64
CACHED_WORDS = 200_000

Encoder = Callable[[list[str]], np.ndarray]
_WORD = re.compile(r"[^ \t\r\n\f\v]+")


def token_hash_encoder(width: int = EMBEDDING_WIDTH) -> Encoder:
    """Deterministic default: each word adds +1 or -1 to one of ``width`` dimensions.

    Dimension and sign come from the MD5 of the lower-cased word; the whole text is read.
    """
    slots: dict[str, int] = {}  # word -> dimension, plus width if it counts down

    def slot(word: str) -> int:
        code = int.from_bytes(hashlib.md5(word.encode("utf-8")).digest()[:4], "big")
        found = code % (2 * width)  # code // width is odd in the upper half
        if len(slots) < CACHED_WORDS:
            slots[word] = found
        return found

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), width), dtype=np.float64)
        for row, text in enumerate(texts):
            hits = []
            for word in _WORD.findall((text or "").lower()):
                found = slots.get(word)
                hits.append(slot(word) if found is None else found)
            counts = np.bincount(np.array(hits, dtype=np.int64), minlength=2 * width)
            out[row] = counts[:width] - counts[width:]
        return out

    return encode


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Each row scaled to length 1; an all-zero row stays zero."""
    vectors = np.asarray(vectors, dtype=np.float64)
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def encode_column(
    text: Column, make_encoder: Callable[[], Encoder] = token_hash_encoder, batch: int = BATCH
) -> Column:
    """Unit vectors for a text column.

    ``make_encoder`` runs once per Python worker and task, so a model is loaded once and then
    used for all Arrow batches; ``batch`` texts go to it at a time.
    """

    @F.pandas_udf("array<float>")
    def run(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make_encoder()
        for chunk in chunks:
            texts = chunk.tolist()
            parts = [
                unit_rows(encode(texts[i : i + batch])).astype(np.float32)
                for i in range(0, len(texts), batch)
            ]
            rows = [vector for part in parts for vector in part]
            yield pd.Series(rows, index=chunk.index)

    return run(text)


def encode_query(
    text: Column,
    make_encoder: Callable[[], Encoder] = token_hash_encoder,
    prefix: str = QUERY_PREFIX,
) -> Column:
    return encode_column(F.concat(F.lit(prefix), text), make_encoder)


def l2_normalise(vector: Column) -> Column:
    """Unit vector by column expressions, for vectors that are already in a table."""
    squares = F.aggregate(
        vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.transform(
        vector, lambda x: F.when(squares > 0, x / F.sqrt(squares)).otherwise(0.0).cast("float")
    )
