"""Benchmark decontamination by word windows.

The benchmark's windows of ``WINDOW`` consecutive words (an item of fewer words is one window) form
a hash set that is broadcast. A text's own windows are hashed where the text lies and looked up
first in a bit set of fixed size; what passes is written out as a word sequence and joined with the
windows by equality, which verifies the hit. Each text is read once and no text moves. A window set
of more than ``BROADCAST_CHARS`` characters is joined without broadcast, the rest being the same.

A word is a run of letters and digits after A-Z became lower case. Only as many window lengths as
``WINDOW`` can occur, each of which costs a pass over the words.

Cases: null and empty texts have no words and are never contaminated; items without words match
nothing. Repeated rows are judged each for itself, with null or equal ids too. Equal items each
count. Columns beside those named are kept untouched, whatever their names. An empty benchmark hits
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.shared import fresh_name, materialise, text_or_empty

WINDOW = 13
BROADCAST_CHARS = 64_000_000
#: A document is contaminated if hits cover one of so many of its words.
SHARE = 20
#: Bits of the first filter, fixed whatever the benchmark's size.
BITS = 1 << 18
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same with capitals, and with what stands before a word, for cutting the text itself.
SEGMENT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    # lower() is A-Z only where all characters are ASCII, and much faster there.
    ascii_only = F.octet_length(text) == F.char_length(text)
    small = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))
    return F.regexp_extract_all(small, F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """len, hash, window, item_id: the distinct windows of each item."""
    items = benchmark.select("item_id", words(text_or_empty()).alias("w")).where(F.size("w") > 0)
    spans = items.select("item_id", "w", F.least(F.size("w"), F.lit(size)).alias("len"))
    placed = spans.select("item_id", "w", "len", F.explode(F.expr("sequence(1, size(w) - len + 1)")).alias("at"))
    cut = placed.select("item_id", "len", F.expr("slice(w, at, len)").alias("w"))
    return cut.select("len", F.xxhash64("w").alias("hash"), F.array_join("w", " ").alias("window"), "item_id").distinct()


def bit_set(window_table: DataFrame) -> list[int]:
    """``BITS`` bits in 64s, of which each window sets two."""
    hashed = window_table.select(F.explode(F.array(*places(F.col("hash")))).alias("bit"))
    parts = hashed.groupBy(F.expr("bit div 64").alias("part")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    out = [0] * (BITS // 64)
    for part, bits in parts.collect():
        out[part] = bits
    return out


def places(value: Column) -> tuple[Column, Column]:
    return value.bitwiseAND(F.lit(BITS - 1)), F.shiftrightunsigned(value, 24).bitwiseAND(F.lit(BITS - 1))


def passing(size: int, bits: Column) -> Column:
    """Positions in ``w`` (from 1) whose window of ``size`` words passes the bit set."""
    hashes = F.expr(f"transform(if(n >= {size}, sequence(1, n - {size} + 1), array()), i -> xxhash64(slice(w, i, {size})))")
    return F.array_compact(F.transform(hashes, lambda h, j: F.when(is_set(h, bits), j + 1)))


def is_set(value: Column, bits: Column) -> Column:
    tests = []
    for place in places(value):
        part = F.element_at(bits, F.shiftright(place, 6).cast("int") + 1)
        tests.append(part.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))) != 0)
    return tests[0] & tests[1]


def scan(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), size: int = WINDOW) -> DataFrame:
    """For each row of ``docs``: ``keep``, n_words, n_hit, n_items, items (sorted ids as text), spans
    (``at`` from 1, ``len``) and contaminated."""
    table = materialise(windows(benchmark, size), "windows")
    width = table.agg(F.sum(F.length("window"))).first()[0] or 0
    lengths = sorted(r[0] for r in table.select("len").distinct().collect())
    known = table.select("window", "item_id")
    known = F.broadcast(known) if width <= BROADCAST_CHARS else known

    # What comes with the documents lies in one struct, so that no name can clash.
    read = docs.select(F.struct(*keep).alias("doc"), words(text_or_empty()).alias("w")).withColumn("n", F.size("w"))
    bits = F.from_json(F.lit(str(bit_set(table))), "array<bigint>")
    marked = read.select("doc", "n", "w", *(passing(n, bits).alias(f"p{n}") for n in lengths))
    found = [F.expr(f"transform(p{n}, i -> named_struct('at', i, 'len', {n}, 'window', array_join(slice(w, i, {n}), ' ')))") for n in lengths]
    none = F.expr("cast(array() as array<struct<at: int, len: int, window: string>>)")
    passed = marked.select(F.monotonically_increasing_id().alias("row"), "doc", F.col("n").cast("long").alias("n_words"), F.concat(none, *found).alias("found"))
    passed = materialise(passed, "passed")

    hits = passed.select("row", F.explode("found").alias("f")).select("row", "f.at", "f.len", "f.window").join(known, "window")
    spans = hits.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("at", "len"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    joined = passed.select("row", "doc", "n_words").join(spans, "row", "left")
    covered = F.expr(
        "aggregate(spans, named_struct('upto', 0, 'n', 0), (a, s) -> named_struct("
        "'upto', greatest(a.upto, s.at + s.len - 1), 'n', a.n + greatest(0, s.at + s.len - 1 - greatest(a.upto, s.at - 1)))).n"
    )
    out = joined.select(
        "doc.*",
        "n_words",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<at: int, len: int>>)")).alias("spans"),
    )
    return out.withColumns(
        {"n_items": F.size("items").cast("long"), "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))}
    )


def by_text(docs: DataFrame, benchmark: DataFrame, size: int) -> DataFrame:
    """One row for each different text with hits: key (digest of the text), spans, contaminated."""
    texts = docs.select(F.sha2("text", 256).alias("key"), "text")
    found = scan(texts, benchmark, ("key",), size).where("n_hit > 0")
    return materialise(found.groupBy("key").agg(F.first("spans").alias("spans"), F.first("contaminated").alias("contaminated")), "hit-texts")


def remove_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated ones."""
    gone = by_text(docs, benchmark, size).where("contaminated").select("key")
    return docs.join(gone, F.sha2(docs["text"], 256) == gone["key"], "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the words that hits cover, each with what stands between it and the word before."""
    key, spans = fresh_name(docs, "key"), fresh_name(docs, "spans")
    found = by_text(docs, benchmark, size).select(F.col("key").alias(key), F.col("spans").alias(spans))
    joined = docs.join(found, F.sha2(docs["text"], 256) == F.col(key), "left")
    segments = F.regexp_extract_all("text", F.lit(SEGMENT), F.lit(0))
    rest = F.regexp_extract("text", f"(?s)^(?:{SEGMENT})*(.*)$", 1)
    kept = F.filter(segments, lambda _, i: ~F.exists(spans, lambda s: (s["at"] <= i + 1) & (i + 1 < s["at"] + s["len"])))
    cleaned = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), rest))
    return joined.withColumn("text", cleaned).select(docs.columns)


#: In DuckDB's SQL: windows of both sides joined as text.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
l AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM l, unnest(range(1, len(w) - n + 2)) AS u(i)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM d, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS u(i)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN win USING (n, s)),
cov AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + n)) AS u(k) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hit GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
