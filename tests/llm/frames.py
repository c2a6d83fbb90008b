"""Small tables for the corpus operators, and plain versions of what they compute."""

from __future__ import annotations

import re

#: Extra columns that clash with names that operators use inside.
CLASH = "id long, key string, size string, fp string, row long, words string, block long, position string, slot string, found string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
_EXTRA = (7, "k", "s", "f", 1, "w", 2, "p", "t", "y")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def docs_of(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with clashing extra columns."""
    full = [(*r, *(None, None)[: 4 - len(r)]) if len(r) < 4 else r for r in rows]
    return spark.createDataFrame([(*r[:4], len(r[1] or ""), *_EXTRA) for r in full], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def long_text(words=60_000):
    return " ".join(f"w{i % 977}x{i % 31}" for i in range(words))


def edge_rows():
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    return [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a"),
        (2, "The  quick brown\tfox jumps over the lazy dog", "en", "a"),
        (2, "The  quick brown\tfox jumps over the lazy dog", "en", "a"),
        (3, None, "en", "b"),
        (4, "", None, "b"),
        (5, " \n\t ", "en", None),
        (None, "The quick brown fox jumps over the lazy dog", None, None),
        (None, None, None, None),
        (6, long_text(), "en", "c"),
        (7, long_text(), "en", "c"),
        (8, "Österreich ÀÉ 你好 🙂 x", "de", "c"),
        (9, "one", "en", "a"),
    ]


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def plain_simhash(text, size=3):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(_LOWER))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, most=3):
    """{key: smallest key reachable} over {key: fingerprint}."""
    sets, keys = Sets(), sorted(prints)
    for i, a in enumerate(keys):
        sets.find(a)
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                sets.join(a, b)
    return {k: sets.find(k) for k in keys}


def bench_words(text):
    raw = (text or "").encode().translate(_LOWER)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw.decode())


def plain_contamination(docs, items, window=10):
    """[(doc, n_words, n_hit, item ids)] for rows (id, text)."""
    windows = {}
    for item, text in items:
        w = bench_words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        w = bench_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                items_here = windows.get(tuple(w[i : i + size]))
                if items_here:
                    hit.update(range(i, i + size))
                    found |= items_here
        out.append((doc, len(w), len(hit), sorted(map(str, found))))
    return out
