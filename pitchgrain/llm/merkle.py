"""A Merkle manifest of a table of documents: a digest and a proof for each row, one root for all.

Leaves are digests of whole rows. In each language leaves stand in the order of their ids, every two
neighbours become their digest until one is left, and the languages' results become the root alike.

A leaf's place is found by rank, not by sorting leaves. Ids of a language are kept as bitmaps: one
64-bit word for each run of 64 ids that has any, made by a map-side OR, so absent runs cost nothing.
Above the words lie directories of counts, one level for each ``STEPS``, with the number of rows
before each entry; a directory's entries under one parent are few, whatever the table's size. The
place of a row is what lies before its word and the bits below its own.

Leaves then fill arrays of 2 ** ``LEVELS`` slots, keyed by tree and place, and each array loses all
its levels at once. What is left of the arrays fills the next ones, so a table of n rows takes
log2(n) / ``LEVELS`` rounds, and no step holds more than one array in memory. Proofs are put together on
the way back down, by equality of tree and place. No digest comes to the driver, only the largest tree's height.

Cases: a null value is written ``-``, empty texts as ``0:``. A null id stands before all others, a null
language is a tree of its own before all others. Rows with equal language and id are ordered by their
leaf; equal leaves are alike, each with a place and proof of its own, and such rows may be any share of
the table. Columns that are not hashed are not read; those that are lacking count as null. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.shared import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a tree that one slot array takes.
LEVELS = 10
#: Bits of an id that lie below each level of the directory; the lowest is the word.
STEPS = (6, 20, 34, 49)
#: Rows that are equal in all that is hashed are told apart by so many parts.
SALTS = 256
#: Rows may be changed in a test if this divides a checksum of their id.
SPOILED = 7

Path = "array<struct<hash: string, left: boolean>>"


def leaf(columns: dict[str, Column]) -> Column:
    """The digest of a row, with its values as ``FIELDS`` orders them."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def values(docs: DataFrame) -> dict[str, Column]:
    have = {c.lower(): c for c in docs.columns}
    return {name: F.col(f"`{have[name]}`") if name in have else F.lit(None).cast("string") for name in FIELDS}


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings, level by level."""
    beside = lambda x, on_left: F.when(x["left"] if on_left else ~x["left"], F.coalesce(x["hash"], F.lit(""))).otherwise("")
    return F.aggregate(path, start, lambda node, x: F.sha2(F.concat(beside(x, True), node, beside(x, False)), 256))


def height(n: Column) -> Column:
    """Levels above ``n`` nodes until one is left."""
    return F.when(n > 1, F.length(F.bin((n - 1).cast("long")))).otherwise(0).cast("int")


def summed_before(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``before``: of ``counts`` (``keys``, n) the sum of n over all rows with the same first key
    that come before in the order of the keys, by a directory for each of them."""
    levels = [counts.select(*keys, "n")]
    for k in range(len(keys) - 1, 1, -1):
        levels.insert(0, levels[0].groupBy(*keys[:k]).agg(F.sum("n").alias("n")))
    before = None
    for depth, level in enumerate(levels, 2):
        above = keys[: depth - 1]
        partition = ", ".join(above)
        own = level.select(*keys[:depth], F.expr(f"sum(n) over (partition by {partition} order by {keys[depth - 1]}) - n").alias("own"))
        if before is None:
            before = own.withColumnRenamed("own", "before")
        else:
            before = own.join(before, above).select(*keys[:depth], (F.col("before") + F.col("own")).alias("before"))
    return before


def among_equal_ids(rows: DataFrame) -> DataFrame:
    """row, after: how many rows of the same tree and id stand before each of ``rows``."""
    keys = ["same", "start", "leaf", "salt"]
    named = rows.select(
        "row", "leaf", F.struct("tree", "id").alias("same"), F.substring("leaf", 1, 4).alias("start"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt")
    )
    before = summed_before(materialise(named.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "counts"), keys)
    placed = named.select(*keys, "row", F.expr("row_number() over (partition by same, start, leaf, salt order by row) - 1").alias("own"))
    return placed.join(before, keys).select("row", (F.col("before") + F.col("own")).alias("after"))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (tree, id, leaf, row, and more) with index, the place in the tree from 0, and n, the tree's rows."""
    places = [f"at{bits}" for bits in reversed(STEPS)]
    keys = ["tree", *places]
    at = {f"at{bits}": F.shiftright("id", bits) for bits in STEPS}
    shifted = lambda value: F.call_function("shiftleft", F.lit(value).cast("long"), F.col("id").bitwiseAND(F.lit(63)).cast("int"))
    rows = rows.withColumns(at)
    words = rows.groupBy(*keys).agg(F.bit_or(shifted(1)).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = materialise(words, "words")
    totals = materialise(words.groupBy("tree").agg(F.sum("n").alias("total")), "totals")
    words = words.join(summed_before(words, keys), keys).join(totals, "tree")

    # Words with more rows than bits hold repeated ids; the rows of those are counted one by one.
    full = words.where(F.col("n") > F.bit_count("bits")).select(*keys)
    again = materialise(rows.join(materialise(full, "full"), keys, "left_semi"), "again")
    if again.isEmpty():
        words = words.withColumn("more", F.expr("cast(array() as array<struct<id: bigint, n: bigint>>)"))
        after = None
    else:
        counts = again.groupBy(*keys, "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        more = counts.groupBy(*keys).agg(F.collect_list(F.struct("id", (F.col("n") - 1).alias("n"))).alias("more"))
        words = words.join(materialise(more, "more"), keys, "left")
        after = materialise(among_equal_ids(again.select("tree", "id", "leaf", "row")), "after")

    words = materialise(words.select("tree", places[-1], "bits", "before", "more", F.col("total").alias("n")), "directory")
    met = rows.join(words, ["tree", places[-1]])
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(shifted(-1))))
    extra = F.aggregate(
        F.coalesce("more", F.expr("cast(array() as array<struct<id: bigint, n: bigint>>)")),
        F.lit(0).cast("long"),
        lambda total, x: total + F.when(x["id"] < F.col("id"), x["n"]).otherwise(F.lit(0).cast("long")),
    )
    met = met.withColumn("index", F.col("before") + below + extra)
    if after is not None:
        met = met.join(after, "row", "left").withColumn("index", F.col("index") + F.coalesce("after", F.lit(0)))
    return met.drop(*places, "bits", "before", "more", "after")


def reduced(levels: Column) -> Column:
    """One more level on top of ``levels``: of every two consecutive nodes the digest, of a last one alone too."""
    last = F.element_at(levels, -1)
    pair = lambda j: F.sha2(F.concat(F.get(last, 2 * j), F.coalesce(F.get(last, 2 * j + 1), F.lit(""))), 256)
    return F.concat(levels, F.array(F.transform(F.sequence(F.lit(0), F.shiftright(F.size(last) - 1, 1)), pair)))


def climb(nodes: DataFrame, rounds: int) -> DataFrame:
    """tree, hash, own, path and top of all ``nodes`` (tree, index, height, hash, own): the siblings up to the
    tree's top, null where there is none, and the top itself."""
    slots = F.sort_array(F.collect_list(F.struct(F.expr(f"cast(index & {(1 << LEVELS) - 1} as int)").alias("slot"), "hash", "own")))
    arrays = nodes.groupBy("tree", F.shiftright("index", LEVELS).alias("array"), "height").agg(slots.alias("slots"))
    steps = F.expr(f"if(height > 0, sequence(1, least(height, {LEVELS})), array())")
    ground = F.array(F.transform("slots", lambda x: x["hash"]))
    arrays = arrays.withColumn("levels", F.aggregate(steps, ground, lambda levels, _: reduced(levels)))
    arrays = materialise(arrays, "slots")
    top = F.expr("element_at(levels, -1)[0]")
    beside = F.expr(
        f"""transform(slots, x -> named_struct('hash', x.hash, 'own', x.own, 'path', cast(
          if(size(levels) > 1, transform(sequence(0, size(levels) - 2), k ->
            named_struct('hash', get(levels[k], cast(shiftright(x.slot, k) ^ 1 as int)), 'left', (shiftright(x.slot, k) & 1) = 1)), array()) as {Path})))"""
    )
    placed = arrays.select("tree", "array", top.alias("top"), F.explode(beside).alias("x"))
    if rounds <= 1:
        return placed.select("tree", "x.hash", "x.own", "x.path", "top")
    left = F.greatest(F.col("height") - LEVELS, F.lit(0)).alias("height")
    above = climb(arrays.select("tree", F.col("array").alias("index"), left, top.alias("hash"), F.col("array").alias("own")), rounds - 1)
    above = materialise(above.select("tree", F.col("own").alias("array"), F.col("path").alias("upper"), F.col("top").alias("summit")), "upper")
    joined = placed.drop("top").join(above, ["tree", "array"])
    return joined.select("tree", "x.hash", "x.own", F.concat("x.path", "upper").alias("path"), F.col("summit").alias("top"))


def rounds_for(nodes: DataFrame) -> int:
    """Slot arrays that lie above each other over the highest tree."""
    most = nodes.agg(F.max("height")).first()[0] or 0
    return max(1, -(-most // LEVELS))


def manifest(docs: DataFrame, also: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, lang, leaf, proof (siblings from leaf to root; null where a node has none, left if it stands
    before), levels (of the proof, within the language), subroot and root of each row of ``docs``, and the
    columns of ``also``, expressions over ``docs``."""
    row = values(docs)
    lang = row["lang"].cast("string")
    # "-" sorts before "=", so null comes first.
    tree = F.coalesce(F.concat(F.lit("="), lang), F.lit("-"))
    doc_id = row["doc_id"].cast("long")
    extra = [column.alias(name) for name, column in (also or {}).items()]
    rows = docs.select(
        tree.alias("tree"),
        F.coalesce(doc_id, F.expr("cast(-9223372036854775808 as bigint)")).alias("id"),
        leaf(row).alias("leaf"),
        F.struct(doc_id.alias("doc_id"), lang.alias("lang"), *extra).alias("own"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = ranked(materialise(rows, "leaves"))
    nodes = materialise(placed.select("tree", "index", height(F.col("n")).alias("height"), F.col("leaf").alias("hash"), "own"), "nodes")
    in_tree = climb(nodes, rounds_for(nodes))

    # A row for each language: its result, and the language's place among all.
    tops = materialise(in_tree.groupBy("tree").agg(F.first("top").alias("hash")), "subroots")
    count = tops.count()
    numbered = tops.select(
        F.lit("").alias("tree"),
        F.expr("row_number() over (order by tree) - 1").cast("long").alias("index"),
        height(F.lit(count)).alias("height"),
        "hash",
        F.col("tree").alias("own"),
    )
    summit = climb(numbered, rounds_for(numbered)).select(F.col("own").alias("tree"), F.col("path").alias("last"), F.col("top").alias("root"))
    out = in_tree.join(materialise(summit, "summit"), "tree")
    return out.select("own.*", F.col("hash").alias("leaf"), F.concat("path", "last").alias("proof"), F.size("path").alias("levels"), F.col("top").alias("subroot"), "root")


def spoiled(docs: DataFrame) -> Column:
    """The leaf after 1 was added to n_chars in the rows that ``SPOILED`` picks; the right one elsewhere."""
    row = values(docs)
    picked = F.coalesce(F.crc32(row["doc_id"].cast("long").cast("string")) % SPOILED == 0, F.lit(False))
    n_chars = row["n_chars"].cast("long")
    return leaf(row | {"n_chars": F.when(picked, n_chars + 1).otherwise(n_chars)})


def checked(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified: each row's proof, tried on rows of which some were changed."""
    found = manifest(docs, {"claimed": spoiled(docs)})
    siblings = F.array_join(F.transform("proof", lambda x: x["hash"]), "")
    out = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), fold(F.col("claimed"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: The CRC-32 of a text in DuckDB's SQL, bit by bit.
_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)))"""


def _hashed(n_chars: str) -> str:
    parts = [f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


#: In DuckDB's SQL: trees level by level, then each row's way up.
ORACLE = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_hashed("n_chars::VARCHAR")} AS leaf,
    CASE WHEN {_CRC.format("doc_id::VARCHAR")} % {SPOILED} = 0 THEN {_hashed("(n_chars + 1)::VARCHAR")} ELSE {_hashed("n_chars::VARCHAR")} END AS claimed FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i FROM l),
n(k, tree, i, h) AS (
  SELECT 0, tree, i, leaf FROM p
  UNION ALL
  SELECT k + 1, tree, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM n) WHERE c > 1 GROUP BY k, tree, i // 2),
s AS (SELECT tree, max(k) AS top, arg_max(h, k) AS subroot FROM n GROUP BY 1),
q AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS t FROM s),
m(k, i, h) AS (
  SELECT 0, t, subroot FROM q
  UNION ALL
  SELECT k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS c FROM m) WHERE c > 1 GROUP BY k, i // 2),
r AS (SELECT max(k) AS last, arg_max(h, k) AS root FROM m),
w AS (
  SELECT doc_id, u.k, (p.i // (1::BIGINT << u.k)) AS spot, n.h FROM p JOIN q USING (tree), unnest(range(0, top)) AS u(k)
    LEFT JOIN n ON n.tree = p.tree AND n.k = u.k AND n.i = xor(p.i // (1::BIGINT << u.k), 1)
  UNION ALL
  SELECT doc_id, top + u.k, t // (1::BIGINT << u.k), m.h FROM p JOIN q USING (tree), r, unnest(range(0, last)) AS u(k)
    LEFT JOIN m ON m.k = u.k AND m.i = xor(t // (1::BIGINT << u.k), 1)),
f AS (SELECT doc_id, list({{'spot': spot, 'h': h}} ORDER BY k) AS way, coalesce(string_agg(h, '' ORDER BY k), '') AS proof FROM w GROUP BY 1),
g(doc_id, way, h) AS (
  SELECT doc_id, coalesce(way, []), claimed FROM p LEFT JOIN f USING (doc_id)
  UNION ALL
  SELECT doc_id, way[2:], sha256(CASE WHEN way[1].spot % 2 = 1 THEN way[1].h || h ELSE h || coalesce(way[1].h, '') END) FROM g WHERE len(way) > 0),
e AS (SELECT doc_id, h AS folded_root FROM g WHERE len(way) = 0)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN q USING (tree) JOIN e USING (doc_id) LEFT JOIN f USING (doc_id), r
"""
