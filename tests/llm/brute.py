"""Plain versions of the text operators, and awkward rows to try them on."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql.types import LongType, StringType, StructField, StructType

BLANKS = "[\\x20\\x09-\\x0D]+"
# Names that operators might use inside.
CLASHING = ("key", "marks", "of", "row", "n", "w", "doc", "text_key", "KEPT_ID", "place", "lost", "spans", "of_key", "gone_id", "count")
SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("source", StringType())]
    + [StructField(c, StringType()) for c in CLASHING]
)


def messy_rows(items: list[str]) -> list[tuple]:
    rng = random.Random(7)
    words = [f"{a}{b}" for a in ("re", "Tho", "ing", "éa", "ST", "un") for b in ("da", "mi", "st", "x", "ou", "né", "t")]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    page = lambda n: "\n".join(line(rng.randint(3, 30)) for _ in range(n))
    base = page(12)
    near = base.split(" ")
    near[20] = "changed"
    far = base.split("\n")
    shared = line(60)
    texts = [
        base, base, " ".join(near), base.replace(" ", "\t"), "\n".join(far[:6] + [line(40)] * 3 + far[6:]),
        None, None, "", " \n\t", "word", "one two three four", "one two three four", "ONE two three four five",
        f"{page(2)}\n{items[0]}\n{page(1)}", f"{page(60)}\n{items[1]}", items[2], " ".join(items[3].split()[:13]),
        f"{page(3)}\n{shared}\n{page(3)}", f"{page(2)}\n{shared}", f"{shared}\n{page(4)}", "x " * 1200, "ab" * 700, "ñ" * 3000,
        "The and attion.\n" + page(4), "The and attion.\n" + page(3), "The and attion. \n" + page(5), "The and attion.",
        page(2500), page(2500).upper(), "a<|endoftext|>b don't", *(page(6) for _ in range(8)),
    ]
    rows = [(i, t, f"s{i % 2}" if i % 7 else None, *(["clash"] * len(CLASHING))) for i, t in enumerate(texts)]
    rows += [rows[0], rows[13], rows[13], (None, base, None, *([None] * len(CLASHING))), (None, page(5), "s0", *([None] * len(CLASHING)))]
    return rows


def low(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words_of(text: str | None) -> list[str]:
    return [w for w in re.split(BLANKS, low(text or "")) if w]


def shingle_set(text: str | None) -> frozenset:
    w = words_of(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def components(sets: list[frozenset], percent: int) -> list[int]:
    """For each set the index of the first in its component; empty sets stand alone."""
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(sets))]


def exact_groups(rows: list[tuple]) -> list[tuple]:
    norm = [re.sub(BLANKS, " ", t or "") for _, t in rows]
    ids = defaultdict(list)
    for (d, _), t in zip(rows, norm, strict=True):
        ids[t].append(d)
    keep = {t: min((d for d in group if d is not None), default=None) for t, group in ids.items()}
    return [(d, keep[t], len(ids[t]), d == keep[t], hashlib.sha256(t.encode()).hexdigest()) for (d, _), t in zip(rows, norm, strict=True)]


def without_boilerplate(rows: list[tuple], ratio: float, least: int) -> list[str | None]:
    """rows of (site, text)."""
    texts = {(site, text or "") for site, text in rows}
    total, shown = Counter(s for s, _ in texts), Counter()
    for site, text in texts:
        shown.update((site, x) for x in {x.strip(" \t\r") for x in text.split("\n")} if x)
    bad = {k for k, n in shown.items() if n >= least and n > ratio * total[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r")) not in bad) for s, t in rows]


def contamination(text: str | None, items: list[tuple]) -> tuple[int, int, list[str], bool]:
    find = lambda t: re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low(t or ""))
    w, hit, found = find(text), set(), set()
    for item_id, item in items:
        v = find(item)
        n = min(13, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1) if v else ():
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item_id))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def without_repeated_strings(texts: list[str | None], length: int) -> list[tuple[int, int, int, bytes]]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        spans = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        out.append((len(b), sum(mark), spans, bytes(x for x, m in zip(b, mark, strict=True) if not m)))
    return out


def paragraphs_of(text: str | None, least: int) -> list[tuple[int, list[str]]]:
    """First word's place, and words, of each sentence and each run of one word that is long enough."""
    words = words_of(text)
    same = [0] * len(words)
    i = 0
    while i < len(words):
        j = i
        while j < len(words) and words[j] == words[i]:
            j += 1
        for k in range(i, j):
            same[k] = i + 1 if j - i >= least else 0
        i = j
    out, begin = [], 0
    for k in range(1, len(words) + 1):
        if k == len(words) or same[k] != same[k - 1] or (not same[k - 1] and words[k - 1][-1] in ".!?"):
            if k - begin >= least:
                out.append((begin, words[begin:k]))
            begin = k
    return out


def without_repeated_paragraphs(rows: list[tuple], percent: int, least: int = 15) -> list[str | None]:
    """rows of (doc_id, text), different in id or text."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    places = [(i, at, words) for i in order for at, words in paragraphs_of(rows[i][1], least)]
    first = components([shingle_set(" ".join(words)) for _, _, words in places], percent)
    gone = defaultdict(set)
    for j, f in enumerate(first):
        if f != j:
            i, at, words = places[j]
            gone[i].update(range(at, at + len(words)))
    out = []
    for i, (_, text) in enumerate(rows):
        tokens = re.findall(BLANKS[:-1] + "*[^\\x20\\x09-\\x0D]+", text or "")
        tail = re.search(BLANKS[:-1] + "*\\Z", text or "")[0]
        out.append(text if i not in gone else "".join(t for k, t in enumerate(tokens) if k not in gone[i]) + tail)
    return out
