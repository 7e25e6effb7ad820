"""Boilerplate lines, found by how many of a site's pages show them.

A site's pages are first reduced to different texts, by digest, so that copies do not vouch for each
other. Lines are counted once a text, by digest; a line in more than ``RATIO`` of the site's texts and
in ``LEAST`` at least is boilerplate. A site has at most (mean lines of a page) / ``RATIO`` such lines,
whatever its size, so the list of a site fits beside each of its pages. The lists are written first:
Spark then knows their size, sends small ones to all tasks, and joins large ones by site with hot sites
split. Pages are filtered in place and never taken apart and rebuilt.

With ``copies_once`` near copies do not vouch for each other either: texts that are alike make one group
(see ``groups``), and lines and totals count groups.

Cases: lines are compared without blanks at their ends; empty lines are never dropped. A null text
stays null, an empty one empty; both count as the empty text. A null site is a site of its own. Repeated
rows count as one page.
All columns of the input stay, whatever their names; only ``text`` changes. A page may lose all its
lines and then has an empty text. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.shared import fresh_name, materialise

RATIO = 0.05
LEAST = 3
BLANKS = " \t\r"
#: Of ``groups``: words of a shingle, hashes of a sketch, minima of a band, bands, and rounds in which labels spread.
WORDS = 5
SKETCH = 48
ROWS = 5
BANDS = 8
ROUNDS = 2


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def digest(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(BLANKS))))


def spoken(text: Column) -> Column:
    """Digests of the different lines that are not empty."""
    return F.array_distinct(F.transform(F.filter(lines(text), lambda line: F.btrim(line, F.lit(BLANKS)) != ""), digest))


def hashes(text: Column) -> Column:
    """Hashes of the text's shingles; null if it has no word."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(w) - (WORDS - 1), F.lit(1)))
        return F.transform(at, lambda i: F.xxhash64(*(F.get(w, i + (k - 1)) for k in range(WORDS))))

    # A variable of ``transform``, so that the words are found once and not for each shingle.
    return F.when(F.size(words) > 0, F.transform(F.array(words), hashed)[0])


def keys(sample: Column) -> Column:
    """Band keys, each of ``ROWS`` minima of the sample under different orders."""
    order = lambda seed: F.array_min(F.transform(sample, lambda h: F.xxhash64(h, F.lit(seed))))
    return F.array(*(F.xxhash64(F.lit(b), *(order(b * ROWS + r) for r in range(ROWS))) for b in range(BANDS)))


def groups(pages: DataFrame) -> DataFrame:
    """site, label, shown: the different texts of each site (site, text), with their lines' digests.

    Texts that share a band key get the same label; two of 85 % common shingles share none in about 1 of
    100 cases, two of a third in 97 of 100. A label is the least digest that reached the text in
    ``ROUNDS`` rounds, so a large group of near copies has a few labels, not one for each copy.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    page = pages.select("site", F.md5("text").alias("page"), spoken(F.col("text")).alias("shown"), hashes(text).alias("sample"))
    page = page.withColumn("sample", F.slice(F.array_sort(F.array_distinct("sample")), 1, SKETCH))
    page = page.withColumn("page", F.coalesce("page", F.lit("")))
    once = page.groupBy("site", "page").agg(F.first("shown").alias("shown"), F.first("sample").alias("sample"))
    once = materialise(once.withColumn("site_key", F.xxhash64(F.col("site").isNull(), "site")), "texts")
    sampled = once.where("sample is not null").withColumn("keys", keys(F.col("sample")))
    near = sampled.select(F.explode("keys").alias("key"), "site_key", "page")
    near = materialise(near.select(F.xxhash64("site_key", "key").alias("key"), "site_key", "page"), "page-bands")
    label = near.select("key", "site_key", "page", F.col("page").alias("label"))
    for turn in range(ROUNDS):
        least = materialise(label.groupBy("key").agg(F.min("label").alias("least")).withColumnRenamed("key", "of"), "least")
        reached = label.join(least, F.col("key") == F.col("of")).groupBy("site_key", "page").agg(F.min("least").alias("label"))
        labels = materialise(reached, "page-labels")
        if turn < ROUNDS - 1:
            label = near.join(labels, ["site_key", "page"])
    found = once.join(labels, ["site_key", "page"], "left")
    return found.select("site", F.coalesce("label", "page").alias("label"), "shown")


def boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, least: int = LEAST, copies_once: bool = False
) -> DataFrame:
    """site, marks: the digests of each site's boilerplate lines."""
    pages = docs.select(F.col(site).alias("site"), F.col(text).alias("text"))
    if copies_once:
        pages = materialise(groups(pages), "groups")
        shown = pages.select("site", "label", F.explode("shown").alias("line")).distinct()
        pages = pages.select("site", "label").distinct()
    else:
        page = F.md5(F.coalesce(F.col("text"), F.lit("")))
        texts = pages.select("site", page.alias("page"), spoken(F.col("text")).alias("shown"))
        pages = materialise(texts.groupBy("site", "page").agg(F.first("shown", ignorenulls=True).alias("shown")), "texts")
        shown = pages.select("site", F.explode("shown").alias("line"))
    counts = shown.groupBy("site", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    totals = materialise(pages.groupBy("site").agg(F.count(F.lit(1)).alias("total")), "site-totals")
    often = counts.join(totals.withColumnRenamed("site", "of"), F.col("site").eqNullSafe(F.col("of")))
    return often.where(F.col("n") > ratio * F.col("total")).groupBy("site").agg(F.collect_list("line").alias("marks"))


def drop_boilerplate(
    docs: DataFrame,
    site: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least: int = LEAST,
    counts: bool = False,
    copies_once: bool = False,
) -> DataFrame:
    """``docs`` without boilerplate lines; with ``counts`` also n_lines and n_dropped."""
    marks, of = fresh_name(docs, "marks"), fresh_name(docs, "of")
    lists = materialise(boilerplate(docs, site, text, ratio, least, copies_once), "boilerplate").toDF(of, marks)
    joined = docs.join(lists, docs[site].eqNullSafe(lists[of]), "left")
    kept = F.filter(lines(F.col(text)), lambda line: ~F.array_contains(F.col(marks), digest(line)))
    out = joined.withColumn(marks, F.when(F.col(marks).isNotNull(), kept))
    cleaned = F.when(F.col(marks).isNull(), F.col(text)).otherwise(F.array_join(marks, "\n"))
    if not counts:
        return out.withColumn(text, cleaned).select(docs.columns)
    total = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines(F.col(text)))).cast("long")
    left = F.when(F.col(marks).isNull(), total).otherwise(F.size(marks).cast("long"))
    return out.select(*(F.col(c) for c in docs.columns if c != text), total.alias("n_lines"), (total - left).alias("n_dropped"), cleaned.alias(text))


#: In DuckDB's SQL.
ORACLE = f"""
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
texts AS (SELECT DISTINCT source, coalesce(text, '') AS text FROM documents),
shown AS (SELECT DISTINCT source, text, trim(u.l, ' ' || chr(9) || chr(13)) AS line FROM texts, unnest(string_split(text, chr(10))) AS u(l)),
totals AS (SELECT source, count(*) AS total FROM texts GROUP BY 1),
marks AS (
  SELECT s.source, list(s.line) AS marks FROM
  (SELECT source, line, count(*) AS n FROM shown WHERE line <> '' GROUP BY 1, 2) s JOIN totals t USING (source)
  WHERE s.n >= {LEAST} AND s.n > {RATIO}::DOUBLE * t.total GROUP BY 1),
cut AS (
  SELECT doc_id, text, ls, list_filter(ls, lambda x: NOT list_contains(coalesce(m.marks, []), trim(x, ' ' || chr(9) || chr(13)))) AS kept
  FROM pages LEFT JOIN marks m USING (source))
SELECT doc_id, len(ls) AS n_lines, len(ls) - len(kept) AS n_dropped, array_to_string(kept, chr(10)) AS text FROM cut
"""
