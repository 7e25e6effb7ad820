"""Quality scores by positive-unlabelled learning.

Trusted positives and all texts, taken as unlabelled, train a logistic model: the non-negative
unbiased risk  prior * E_pos[loss(+)] + max(0, E_all[loss(-)] - prior * E_pos[loss(-)])  is minimised by
Newton steps. Each step is one Spark aggregation over the features of all texts, whose sums alone come
to the driver: a few thousand numbers, however many texts there are. While the second term is negative
(the model explains unlabelled texts better than the prior allows), the step goes against it, as the
correction demands. The class prior is the share of positives among the labels that may be seen.

Features describe form only: shares of kinds of characters, word lengths, repetition, lines. They are
computed once from whole texts; training and scoring read them, not the texts.

Cases: a null or empty text has features of zero and gets a score. Labels with a null quality or of
unknown documents count for nothing; of contradicting ones the worse counts. Rows that repeat a
``doc_id`` are scored each for itself; a null ``doc_id`` is never labelled and not held out. Without
positives all scores are the prior (a half if there are no labels). Columns beside doc_id and text are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.packing import slices
from pitchgrain.llm.shared import discard, materialise, text_or_empty

STEPS = 10
RIDGE = 0.03
CLIP = 3.0

KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,;:", "!?", "'\"", "()[]{}<>", "|/\\_=+-~", "#$%&*@^`")
OTHER, BEYOND = len(KINDS), len(KINDS) + 1  # control characters, bytes of characters beyond ASCII
NAMES = 24
WORDS_AT = 21  # the logarithm of the number of words
FEW = 2


def kind_of_byte() -> np.ndarray:
    out = np.full(256, OTHER)
    out[128:] = BEYOND
    for k, letters in enumerate(KINDS):
        out[list(letters.encode())] = k
    return out


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` numbers for each text; zeros where there is nothing to measure."""
    n, kinds = len(texts), BEYOND + 1
    whole = texts.cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64, n + 1, 8 * whole.offset)
    size = np.diff(offsets)
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if size.sum() else np.empty(0, np.uint8)
    owner = np.repeat(np.arange(n), size)
    counts = np.bincount(owner * kinds + kind_of_byte()[data], minlength=n * kinds).reshape(n, kinds)
    share = counts / np.maximum(size, 1)[:, None]

    split = pc.ascii_split_whitespace(texts)
    per = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = split.flatten()
    code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    letters = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.float64)
    of = np.repeat(np.arange(n), per)
    words = np.maximum(per, 1)
    mean_length = np.bincount(of, letters, n) / words
    spread = np.sqrt(np.maximum(np.bincount(of, letters**2, n) / words - mean_length**2, 0))
    pairs, again = np.unique(of << 32 | code, return_counts=True)
    which = pairs >> 32
    distinct = np.bincount(which, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, which, again)
    together = of[1:] == of[:-1]
    same = np.bincount(of[1:][together & (code[1:] == code[:-1])], minlength=n)
    two = np.unique(((code[:-1] * 1_000_003 + code[1:]) & 0xFFFFFFFF | of[1:] << 32)[together]) >> 32
    bigrams = np.bincount(two, minlength=n)
    columns = [
        *share.T,
        mean_length,
        spread,
        np.bincount(of, letters <= 3, n) / words,
        np.bincount(of, letters >= 12, n) / words,
        distinct / words,
        most / words,
        same / words,
        bigrams / words,
        np.log1p(per),
        np.log1p(size / (counts[:, 4] + 1)),
        np.sqrt(counts[:, 4] / words),
    ]
    return np.nan_to_num(np.column_stack(columns[:NAMES])).astype(np.float32)


def described(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, x: the features of each text; with ``row`` also that column, a key of any type, as ``row``."""
    kept = ["doc_id", "row"] if row else ["doc_id"]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                x = features(batch.column("text")[lo:hi])
                edges = np.arange(0, x.size + 1, NAMES, dtype=np.int32)
                own = [batch.column(c)[lo:hi] for c in kept]
                yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(pa.array(edges), pa.array(x.ravel()))], names=[*kept, "x"])

    key = [F.col(row).alias("row")] if row else []
    texts = docs.select(F.col("doc_id").cast("long"), *key, text_or_empty().alias("text"))
    return texts.mapInArrow(measured, f"{ddl(texts, kept)}, x array<float>")


def ddl(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)


def expanded(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """What the model is linear in: one, standardised and clipped features, and their squares; shares of
    few words say little and are drawn to the mean."""
    words = np.expm1(x[:, WORDS_AT])[:, None]
    z = np.clip((x - centre) / scale, -CLIP, CLIP) * (words / (words + FEW))
    return np.column_stack((np.ones(len(z)), z, z * z - 1))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, NAMES).astype(np.float64)


def sums(table: DataFrame, columns: list[str], length: int, measure) -> np.ndarray:
    """The sum over all rows of what ``measure`` makes of a batch, an array of ``length`` numbers; only that comes to the driver."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += measure(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(total)], names=["k", "v"])

    parts = table.select(*columns).mapInArrow(partial, "k long, v double")
    out = np.zeros(length)
    for k, v in parts.groupBy("k").agg(F.sum("v")).collect():
        out[k] = v
    return out


class Model:
    def __init__(self, weights: np.ndarray, centre: np.ndarray, scale: np.ndarray, prior: float):
        self.weights, self.centre, self.scale, self.prior = weights, centre, scale, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(expanded(x, self.centre, self.scale) @ self.weights, -30, 30)))


def fit(table: DataFrame, prior: float, steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """``table`` has x and positive (a trusted positive); every row counts as unlabelled."""

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("x"))
        return np.concatenate(([len(x)], x.sum(axis=0), (x * x).sum(axis=0)))

    total = sums(table, ["x"], 1 + 2 * NAMES, moments)
    n = max(total[0], 1)
    centre = total[1 : 1 + NAMES] / n
    scale = np.sqrt(np.maximum(total[1 + NAMES :] / n - centre**2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    width = 1 + 2 * NAMES

    def once(batch: pa.RecordBatch) -> np.ndarray:
        phi = expanded(matrix(batch.column("x")), centre, scale)[batch.column("positive").to_numpy(zero_copy_only=False)]
        return np.concatenate(([len(phi)], phi.sum(axis=0)))

    positives = sums(table, ["x", "positive"], 1 + width, once)
    weights = np.zeros(width)
    weights[0] = np.log(prior / (1 - prior))
    if not positives[0]:
        return Model(weights, centre, scale, prior)
    mean_positive = positives[1:] / positives[0]

    for _ in range(steps):

        def terms(batch: pa.RecordBatch, w: np.ndarray = weights) -> np.ndarray:
            phi = expanded(matrix(batch.column("x")), centre, scale)
            good = batch.column("positive").to_numpy(zero_copy_only=False)
            z = np.clip(phi @ w, -30, 30)
            p, loss = 1 / (1 + np.exp(-z)), np.logaddexp(0, z)  # loss(-) and its slope
            curve = (phi * (p * (1 - p))[:, None]).T @ phi
            return np.concatenate(([loss.sum(), loss[good].sum()], phi.T @ p, phi[good].T @ p[good], curve.ravel()))

        got = sums(table, ["x", "positive"], 2 + 2 * width + width * width, terms)
        loss_all, loss_positive = got[0] / n, got[1] / positives[0]
        slope_all, slope_positive = got[2 : 2 + width] / n, got[2 + width : 2 + 2 * width] / positives[0]
        curve = got[2 + 2 * width :].reshape(width, width) / n
        negative_part = loss_all - prior * loss_positive
        # The loss of a positive is the loss of a negative less z, so its slope lacks one mean.
        if negative_part >= 0:
            slope = slope_all - prior * mean_positive + ridge * weights
            change = -np.linalg.solve(curve + ridge * np.eye(width), slope)
        else:
            change = np.linalg.solve(curve + np.eye(width), slope_all - prior * slope_positive)
        change *= min(1.0, 5.0 / max(np.abs(change).max(), 1e-12))
        weights = weights + change
        if np.abs(change).max() < 1e-4:
            break
    return Model(weights, centre, scale, prior)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, steps: int = STEPS, row: str | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``. Labels of held-out ids are not looked at.

    ``row`` names a key column of ``docs``, which the result then has as ``row``; ids may repeat, keys may not.
    """
    kept = ["doc_id", "row"] if row else ["doc_id"]
    seen = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").cast("long"), "quality").where(~held_out())
    seen = seen.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good, all_ = seen.agg(F.count_if(F.col("quality") == 1), F.count(F.lit(1))).first()
    prior = min(max(good / all_, 0.01), 0.99) if all_ else 0.5
    trusted = seen.where("quality = 1").select(F.col("doc_id").alias("of_id"), F.lit(True).alias("positive"))
    measured = materialise(described(docs, row), "features")
    known = measured.join(trusted, F.col("doc_id") == F.col("of_id"), "left")
    table = materialise(known.select(*kept, "x", F.coalesce("positive", F.lit(False)).alias("positive")), "training")
    discard(measured)
    model = fit(table, prior, steps)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.score(matrix(batch.column("x"))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), scores], names=[*kept, "score"])

    out = table.select(*kept, "x").mapInArrow(scored, f"{ddl(table, kept)}, score double")
    return out.select(*kept, held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
