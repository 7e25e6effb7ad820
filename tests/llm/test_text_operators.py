"""Each operator against a plain version, on rows with nulls, repeats, ties, long texts and clashing columns."""

import base64
import collections
import hashlib
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from conftest import SF
from pitchgrain.llm import components, decontamination, exact_dedup, html_text, line_dedup, near_dedup, packing, paragraph_dedup, quality, shingles, substring_dedup, suffix_sort, warc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(12).collect()] + [(90, "few words only"), (91, None), (92, "..."), (93, "few words only")]


@pytest.fixture(scope="module")
def rows(items):
    return brute.messy_rows([t for _, t in items])


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def pairs(rows):
    return [r[:2] for r in rows]


def test_exact(docs, none, rows):
    assert ordered(exact_dedup.exact_duplicates(docs).collect()) == ordered(brute.exact_groups(pairs(rows)))
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_exact_tells_clashing_identifiers_apart(spark):
    cut = [("a", [1, 2], [b"x", b"y"]), ("b", [1, 2], [b"x", b"z"]), ("c", [1, 3], [b"x", b"w"])]
    table = spark.createDataFrame([(i, s, a, b) for i, (s, a, b) in enumerate(cut)], "row long, text_sha256 string, ids array<long>, digests array<binary>")
    got = exact_dedup.verified(table.withColumn("doc_id", F.col("row"))).collect()
    assert {r["text_sha256"]: len(r["exact"]) for r in got} == {"a": 2, "b": 2, "c": 0}


def test_chunks_join_to_the_text(spark):
    text = "Some words here. " * 500 + "x" * 9000
    parts = spark.createDataFrame([(text,)], "t string").select(exact_dedup.chunks(F.col("t"))).first()[0]
    assert "".join(parts) == text and max(map(len, parts)) <= exact_dedup.MAX_CHUNK + 1 and len(set(parts)) < len(parts)


def test_lines(docs, none, rows):
    got = line_dedup.drop_boilerplate(docs, ratio=0.08, least=2)
    assert got.columns == docs.columns
    want = brute.without_boilerplate([(r[2], r[1]) for r in rows], 0.08, 2)
    assert ordered(got.select("doc_id", "text", "source").collect()) == ordered((r[0], t, r[2]) for r, t in zip(rows, want, strict=True))
    assert any(t != r[1] for r, t in zip(rows, want, strict=True))
    assert line_dedup.drop_boilerplate(none).count() == 0


def test_contamination(docs, none, rows, items, benchmark):
    got = decontamination.scan(docs, benchmark).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    want = [(r[0], *brute.contamination(r[1], items)) for r in rows]
    assert ordered((*r[:3], list(r[3]), r[4]) for r in got) == ordered(want)
    assert {w[4] for w in want} == {True, False}
    kept = decontamination.remove_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert ordered(r[:2] for r in kept.collect()) == ordered(r[:2] for r, w in zip(rows, want, strict=True) if not w[4])
    assert decontamination.scan(none, benchmark).count() == 0
    assert decontamination.scan(docs, benchmark.where("item_id = 92")).where("n_hit > 0").count() == 0


def test_contaminated_spans_go(spark, benchmark, items):
    text = f"Before it: {items[0][1].upper() if items[0][1].isascii() else items[0][1]} (and after) it!"
    df = spark.createDataFrame([(1, text), (2, None), (3, "clean, text.")], "doc_id long, text string")
    got = dict(tuple(r) for r in decontamination.remove_spans(df, benchmark.where("item_id = 0")).collect())
    assert got[2] is None and got[3] == "clean, text." and got[1].startswith("Before it") and got[1].endswith("after) it!")
    assert brute.contamination(got[1], items[:1])[1] == 0


def test_packing(docs, none, rows):
    got = packing.pack(docs, VOCABULARY).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = ordered((r[0], [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in rows)
    whole = {}
    for p in got:
        assert p["length"] == len(p["ids"]) <= 4096 and p["length"] & (p["length"] - 1) == 0 and p["offset"] == 0
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
    assert len({p["sequence_id"] for p in got}) == len(got)
    assert sum(p["length"] for p in got) == sum(len(ids) for _, ids in want)
    for doc_id in {p["doc_id"] for p in got if p["doc_id"] is not None}:
        parts = sorted((p for p in got if p["doc_id"] == doc_id), key=lambda p: p["start"])
        if sum(r[0] == doc_id for r in rows) == 1:
            whole[doc_id] = [i for p in parts for i in p["ids"]]
            assert [p["start"] for p in parts] == np.cumsum([0, *(p["length"] for p in parts[:-1])]).tolist()
            assert {p["doc_tokens"] for p in parts} == {len(whole[doc_id])}
    assert all(whole[d] == ids for d, ids in want if d in whole) and len(whole) > 30
    assert packing.pack(none, VOCABULARY).count() == 0


def test_cut():
    assert packing.cut(4096 * 2 + 13) == [4096, 4096, 8, 4, 1] and packing.cut(1) == [1]


def test_near(docs, none, rows):
    got = near_dedup.near_duplicates(docs).collect()
    sets = [brute.shingle_set(t) for _, t in pairs(rows)]
    first = brute.components(sets, 85)
    least = {f: min((rows[i][0] for i, g in enumerate(first) if g == f and rows[i][0] is not None), default=None) for f in set(first)}
    want = [(r[0], len(s), r[0] if not s else least[f], r[0] == (r[0] if not s else least[f])) for r, s, f in zip(rows, sets, first, strict=True)]
    assert ordered(got) == ordered(want)
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 2").count() == 0 and kept.where("doc_id = 5").count() == 1


def test_one_large_group_of_near_copies(spark):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join([*words[:k], f"new{k}", *words[k + 1 :]]) for k in range(0, 300, 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {tuple(r) for r in near_dedup.near_duplicates(df).select("component_id").distinct().collect()} == {(0,)}


def test_a_bucket_falls_into_its_components(spark):
    """Nodes of one bucket whose links do not all touch the hub."""
    members = spark.createDataFrame([(1, i, 10) for i in range(8)], "key long, node long, size long")
    true = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (0, 7)], "a long, b long")
    asked = []

    def verify(given):
        asked.extend(tuple(r) for r in given.collect())
        return given.join(true, ["a", "b"])

    labels = {r["node"]: r["label"] for r in components.linked(members, verify, 80).collect()}
    groups = {}
    for node in range(8):
        groups.setdefault(labels.get(node, node), set()).add(node)
    assert sorted(map(sorted, groups.values())) == [[0, 7], [1, 2, 3], [4], [5, 6]]
    assert len(asked) == len(set(asked))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1060)] + [(7, 7)]
    got = {}
    for r in components.components(spark.createDataFrame(links, "a long, b long")).collect():
        got.setdefault(r["label"], set()).add(r["node"])
    assert sorted(map(min, got.values())) == [0, 1000] and sorted(map(len, got.values())) == [60, 61]
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    steps = [30, 60, 90, 120, 150]
    least = near_dedup.thresholds(steps, 85, 1e-7)
    rng = np.random.default_rng(3)
    equal = rng.random((20000, 150)) < 0.85
    assert all((equal[:, :n].sum(axis=1) >= m).all() for n, m in zip(steps, least, strict=True))
    assert least[-1] > 0.5 * 150


def test_bands():
    b = shingles.bands_for(0.8, 3, 1e-3)
    assert (1 - 0.8**3) ** b <= 1e-3 < (1 - 0.8**3) ** (b - 1)


def test_paragraphs(docs, none, rows):
    got = paragraph_dedup.drop_repeats(docs)
    assert got.columns == docs.columns
    own = list(dict.fromkeys(pairs(rows)))
    want = dict(zip(own, brute.without_repeated_paragraphs(own, 80), strict=True))
    assert ordered(r[:2] for r in got.collect()) == ordered((r[0], want[r[:2]]) for r in rows)
    assert any(want[k] != k[1] for k in own)
    assert paragraph_dedup.drop_repeats(none).count() == 0


@pytest.mark.parametrize("crowd", [1000, 2])
def test_substrings(docs, none, rows, crowd, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CROWD", crowd)
    got = substring_dedup.strip_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    want = [(r[0], *w) for r, w in zip(rows, brute.without_repeated_strings([r[1] for r in rows], 200), strict=True)]
    assert ordered((*r[:4], bytes(r[4])) for r in got) == ordered(want)
    assert substring_dedup.strip_repeats(none).count() == 0


def test_only_strings_that_may_repeat_are_sorted(monkeypatch):
    rng = np.random.default_rng(2)
    some = lambda n: rng.integers(97, 123, n, np.uint8).tobytes()
    marks = [some(32) for _ in range(4)]
    left, right = some(168), some(168)

    def part(mark, a, b):  # shares at least ``a`` bytes before the mark and ``b`` behind it, and all its strings hold the mark
        behind = int(rng.integers(b, 169))
        before = int(rng.integers(max(a, 168 - behind), 169))
        return some(before - a) + left[168 - a :] + mark + right[:b] + some(behind - b)

    shares = {0: [(60, 40), (10, 100), (100, 10), (0, 0)], 1: [(84, 84), (100, 90), (120, 30)], 2: [(168, 0), (168, 168), (0, 168), (167, 0)], 3: [(84, 83), (84, 83), (83, 84)]}
    made = [(g, part(marks[g], a, b)) for g, pairs_ in shares.items() for a, b in pairs_ for _ in range(3)]
    grams = [int(substring_dedup.gram_hashes(m, 1).view(np.int64)[0]) for m in marks]
    keys = [(grams[g], 0, k) for k, (g, _) in enumerate(made)]
    parts = [p for _, p in made]
    held = collections.defaultdict(set)
    for k, p in enumerate(parts):
        for i in range(len(p) - 199):
            held[p[i : i + 200]].add(k)
    want = {(*keys[k], i) for k, p in enumerate(parts) for i in range(len(p) - 199) if len(held[p[i : i + 200]]) > 1}
    sorted_ = []
    monkeypatch.setattr(substring_dedup, "suffix_array", lambda text, depth: sorted_.append(text.tobytes()) or suffix_sort.suffix_array(text, depth))
    got = [(*key, i) for *key, lo, hi in substring_dedup.repeated_in(keys, parts, 200) for i in range(lo, hi + 1)]
    assert want and sorted(got) == sorted(want)
    assert not any(marks[0] in text for text in sorted_)
    strings = sum(len(piece) - 199 for text in sorted_ for piece in text.split(b"\xff"))
    assert len(want) <= strings <= len(want) + 2 * substring_dedup.NARROW * len(parts) < sum(len(p) - 199 for p in parts)

    sorted_.clear()
    assert not list(substring_dedup.repeated_in(keys[:12], parts[:12], 200)) and not sorted_


def test_stretches_of_blocks(monkeypatch):
    data = bytes(np.random.default_rng(1).integers(97, 101, 5000, np.uint8)) + b"ab" * 600
    ends = np.array([100, 3000, 3199, len(data)])
    whole = list(substring_dedup.stretches(memoryview(data), ends))
    monkeypatch.setattr(substring_dedup, "BLOCK", 333)
    parts = list(substring_dedup.stretches(memoryview(data), ends))
    covered = [{int(p) + k for _, _, at, size in found for p, n in zip(at, size, strict=True) for k in range(n)} for found in (whole, parts)]
    want = {i for b, e in zip([0, *ends], ends, strict=False) for i in range(b, e - 199)}
    assert covered == [want, want]


def test_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(100):
        text = rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 50)).astype(np.uint8)
        raw = text.tobytes()
        order = suffix_sort.suffix_array(text, 64)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = suffix_sort.common_prefixes(text, order, 16).tolist()
        for k, (a, b) in enumerate(zip(order[:-1].tolist(), order[1:].tolist(), strict=True)):
            pair = zip(raw[a:], raw[b:], strict=False)
            assert shared[k] == min(16, next((i for i, (x, y) in enumerate(pair) if x != y), min(len(raw) - a, len(raw) - b)))


def test_quality(spark, docs, none):
    real, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.quality_scores(real, labels).collect()}
    assert len(got) == real.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    truth = [(r["quality"], got[r["doc_id"]]["score"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    good, bad = ([s for q, s in truth if q == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.9
    few = spark.createDataFrame([(0, 1), (0, 0), (2, None), (None, 1), (777, 1), (3, 1)], "doc_id long, quality int")
    assert quality.quality_scores(docs, few).count() == docs.count()
    assert quality.quality_scores(docs, few.limit(0)).agg(F.max(F.abs(F.col("score") - 0.5))).first()[0] < 1e-9
    assert quality.quality_scores(none, few).count() == 0


def test_held_out_labels_are_not_used(spark):
    real, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [ordered(quality.quality_scores(real, x).select("doc_id", F.round("score", 6)).collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


RECORD = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def test_warc(spark, tmp_path):
    rows = [(5, "http://a", "<p>x</p>"), (3, "http://b", "<p>x</p>"), (9, None, None), (2, "http://\nc", ""), (7, "u", RECORD * 3 + "t")]
    rows += [(8, "u", "WARC/1.1\r\n" * 4), (8, "u", "WARC/1.1\r\n" * 4), (None, "z", "<p>x</p>"), (11, "é", "ñ" * 5000 + RECORD), (12, "l", "y" * 300000)]
    rows += [(100 + i, "h", f"p{i // 2}" + RECORD[:i]) for i in range(40)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("at", F.lit(1)).repartition(2), f"{tmp_path}/w", per_file=15)
    got = warc.read(spark, f"{tmp_path}/w", payloads=True).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        told = ("response", None) if i is None or first[h or ""] == i else ("revisit", first[h or ""])
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *told))
    assert ordered((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == ordered(want)
    assert {bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"} == {h or "" for _, _, h in rows}


def test_warc_broken_and_empty(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(empty, f"{tmp_path}/e")
    assert warc.read(spark, f"{tmp_path}/e").count() == 0
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.warc").write_bytes(RECORD.encode() + b"junk" + RECORD.encode())
    with pytest.raises(ValueError, match="no chain"):
        warc.read(spark, f"{tmp_path}/b")


PAGE = """<!DOCTYPE html><html><head><title>No</title></head><body class="c"><header>Site</header><nav><a href="/">Menu</a></nav>
<div class="cookie-notice">We use</div><div id="w"><div class="post-{0} entry"><h1>T &amp; &eacute;</h1><p>A  b<br>c <b>d</b><p>Long text {0} here &#8212; really.
<ul><li>One<li>Two</ul><script>if(a<b){{"</p>"}}</script><!-- <p>no</p> --><form><input><p>Mail</form><p hidden>h</p></div>
<div class="sidebar"><p>Other stories of great length, more than the text itself has, in many words.</p></div>
<div class="comments"><p>Reader says</p></div></div><footer>End</footer>"""
TEXT = "T & é\nA b c d\nLong text {0} here — really.\nOne\nTwo"


def test_html(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i)) for i in range(5)]
    odd = "<div class='post-9 entry'><p>Short</p></div><div class=big><p>A much longer passage that alone would win here.</p></div>"
    rows += [(5, "http://a.example/odd", f"<body class=c><div>{odd}</div>"), (6, None, None), (7, "::", ""), (8, "http://b.example/", "plain < text"), (0, "http://a.example/0", PAGE.format(0))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("path", F.lit(1))
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    assert all(got[i]["text"] == TEXT.format(i) and got[i]["n_chars"] == len(TEXT.format(i)) for i in range(5))
    assert got[5]["text"] == "Short"  # the host's path, though another holds more here
    assert [got[i]["text"] for i in (6, 7, 8)] == ["", "", "plain < text"]
    assert html_text.extract(pages).count() == len(rows) and html_text.extract(pages.limit(0)).count() == 0


def test_html_never_closed():
    page = '<p a="' + "<b " * 3000 + "<div><p>" * 50 + "<!-- x"
    assert isinstance(html_text.blocks(page), list)


def test_token_ids_of_odd_texts():
    texts = ["", " \t", "don't we'll x'Re", "İstanbul É! ÿÿ. µm", "étude á.b", "a b c\x85d\x1ce", "<|endoftext|> x", "ΑΣ ΣΑΣ.", "abc)—(d 12.5 a_b", "中文。한국어"]
    ids, at = packing.token_ids(pa.array(texts), packing.Encoder(VOCABULARY))
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def words_of_letters(count: int) -> list[str]:
    rng = np.random.default_rng(5)
    return list(dict.fromkeys("".join(rng.choice(list("abcdefgλя"), 9)) for _ in range(count)))


class Counted:
    """The tokenizer, with the number of texts it was handed."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_are_encoded_together_and_once():
    # U+0130 becomes a letter and a mark, so it spoils its group, and that is encoded word by word.
    words = [*words_of_letters(5000), "İx", "it's", "a-b"]
    encoder, plain = packing.Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    want = [*plain.encode(" ".join(words), add_special_tokens=False).ids, 2]
    for _ in range(2):
        ids, at = packing.token_ids(pa.array([" ".join(words)]), encoder)
        assert ids.tolist() == want and at.tolist() == [0, len(want)]
    assert counted.texts < len(words) / 4


def test_remembered_words_take_little_memory():
    words = words_of_letters(20000)
    encoder = packing.Encoder(VOCABULARY)
    packing.token_ids(pa.array(["warm up"]), encoder)
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
    packing.token_ids(pa.array([" ".join(words)]), encoder)
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 100 * len(words)


def test_crowded_paragraphs_meet_by_rare_shingles(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(80):
        words = [f"w{k}" for k in range(60)]
        for _ in range(rng.integers(0, 5)):
            words[rng.integers(60)] = f"x{rng.integers(1000)}"
        rows.append((i, f"a first line of many words {i % 7}\n" + " ".join(words)))
    want = dict(zip((r[0] for r in rows), brute.without_repeated_paragraphs(rows, 80), strict=True))
    got = paragraph_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert dict(tuple(r) for r in got.collect()) == want


def test_paragraphs_exactly_at_the_threshold_meet(spark):
    # 16 of 20 shingles are common; seven bands of two minima overlook these pairs.
    rows = []
    for i in (875, 2001, 3467, 3539, 4087):
        words = [f"a{i}b{k}" for k in range(24)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:20]))]
    got = paragraph_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert dict(tuple(r) for r in got.collect()) == {i: "" if i % 2 else t for i, t in rows}


@pytest.mark.parametrize("percent", [1, 55, 80, 100])
def test_leading_shingles_of_alike_sets_meet(percent):
    rng = np.random.default_rng(percent)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30), dtype=np.uint64)) for _ in range(60)] + [np.empty(0, np.uint64)]
    ends, keys = shingles.leading(sets, percent)
    assert len(ends) == len(sets) + 1 and ends[-1] == len(keys) and shingles.leading([], percent)[0].tolist() == [0]
    first = [set(keys[b:e].tolist()) for b, e in zip(ends, ends[1:])]
    for a, x in zip(sets, first):
        for b, y in zip(sets, first):
            common = len(np.intersect1d(a, b))
            assert x & y or not common or 100 * common < percent * (len(a) + len(b) - common)


def test_crowded_documents_meet_by_rare_shingles(spark):
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(60):
        words = [f"w{k}" for k in range(200)]
        for _ in range(rng.integers(0, 9)):
            words[rng.integers(200)] = f"x{rng.integers(1000)}"
        texts.append(" ".join(words))
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    first = brute.components([brute.shingle_set(t) for t in texts], 85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(enumerate(first))
