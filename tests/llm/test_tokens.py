"""Token counts and alignment against the libraries themselves and a plain version."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from marketloom.llm import token_alignment, token_counts
from marketloom.llm.common import table
from marketloom.llm.queries import QUERIES
from marketloom.llm.token_alignment import aligned, common_ends
from tests.llm.frames import docs_of, edge_rows, empty_docs

SF = "/root/testdata/sf0.001"
WORDS, BYTES, PIECES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>", "<|end", "ΣΑΣ σας", "é ́x", "İstanbul ı", "x\x1cy\x85z\xa0w",
    "a  b   c \n\n d\t\te \r\n", "   ", "你好，世界 🙂🙂", "it's IT'S we'll 'tis", "1234 5.67e-8", "</w> ▁ x▁y", "<0x41> <s>", "ﬁ ǅ ß", "a" * 3000, " wide　",
]


def texts_of(n, seed):
    rng = random.Random(seed)
    pool = [chr(c) for c in range(1, 0x3000)] + [*ODD, " ", "  ", "\n", "é", "a", "the", "'s", " <|"] * 150
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def edges():
    return edge_rows() + [(100 + i, t) for i, t in enumerate([*ODD, *ODD])]


LIBRARY = Tokenizer.from_file(WORDS)


def library_count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_counts_of_the_whole_table(spark):
    want = {r.doc_id: (len((r.text or "").encode()), library_count(r.text)) for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op11_pair_merging"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want and len(rows) == len(want)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_counts_of_odd_texts():
    with open(WORDS, encoding="utf-8") as f:
        counter = token_counts.TokenCounter(f.read())
    texts = [*ODD, *texts_of(3000, 1)]
    assert [counter.count(t) for t in texts] == [library_count(t) for t in texts]


def test_a_full_table_of_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 3)
    with open(WORDS, encoding="utf-8") as f:
        counter = token_counts.TokenCounter(f.read())
    text = " ".join(f"word{i % 7} other{i % 5}" for i in range(200))
    assert counter.count(text) == library_count(text) and len(counter.words) <= 3


def test_count_edges(spark):
    rows = edges()
    got = token_counts.token_counts(docs_of(spark, rows), WORDS).collect()
    assert Counter((r.id, r.n_tokens) for r in got) == Counter((r[0], library_count(r[1])) for r in rows)
    assert token_counts.token_counts(empty_docs(spark), WORDS).collect() == []


@pytest.mark.parametrize("change", [{"dropout": 0.1}, {"unk_token": "<unk>"}, {"type": "WordPiece"}])
def test_files_that_count_otherwise_are_refused(change):
    with open(WORDS, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"] |= change
    with pytest.raises(ValueError):
        token_counts.check_file(spec)


def test_common_ends():
    rng = random.Random(3)
    for size in (0, 1, 5, 60, 500):
        for share in (0.02, 0.3, 0.95):
            a = sorted(rng.sample(range(1000), size))
            b = [x for x in range(1000) if rng.random() < share]
            here, there = common_ends(np.array(a, int), np.array(b, int))
            assert [a[i] for i in here] == [b[j] for j in there] == sorted(set(a) & set(b))
    a, b = np.arange(0, 100_000, 97), np.arange(0, 100_000)
    here, there = common_ends(a, b)
    assert (here == np.arange(len(a))).all() and (there == a).all()


class Plain:
    """Both encodings by the libraries, groups by sets of offsets, counts in one dictionary."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in plain)}
        self.byte = {c: b for b, c in chars.items()}

    def groups(self, text):
        if not text:
            return []
        raw = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        bytes_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            return []
        ends = []
        for parts in (bytes_a, bytes_b):
            at, own = 0, []
            for p in parts:
                at += len(p)
                own.append(at)
            ends.append(own)
        out, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            i2, j2 = ends[0].index(end) + 1, ends[1].index(end) + 1
            out.append((a[i:i2], b[j:j2]))
            i, j = i2, j2
        return out


def plain_alignment(rows):
    plain = Plain()
    groups = [(r[0], plain.groups(r[1])) for r in rows]
    counts = Counter((a[-1], b[-1]) for _, g in groups for a, b in g)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = Counter()
    for doc, g in groups:
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        digest = hashlib.sha256(text.encode()).hexdigest() if g else ""
        sizes = sum(len(a) for a, _ in g), sum(len(b) for _, b in g)
        best = sum(counts[x] == most[x[1]] for x in links)
        out[doc, *sizes, len(g), len(g), best, sum(counts[x] for x in links), digest] += 1
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_the_whole_table(spark):
    want = plain_alignment([(r.doc_id, r.text) for r in table(spark, SF, "documents").where("length(text) < 8000 or text is null").collect()])
    docs = table(spark, SF, "documents").where("length(text) < 8000 or text is null")
    got = aligned(docs, BYTES, PIECES).select("id", *COLUMNS).collect()
    assert Counter(map(tuple, got)) == want
    assert QUERIES["op13_galloping_alignment"](spark, SF).count() == table(spark, SF, "documents").count()


@pytest.mark.parametrize("frequent", [0, 5, 1 << 19])
def test_alignment_edges_with_few_and_many_frequent_pairs(spark, frequent):
    rows = edges()[:8] + edges()[10:] + [(500 + i, t) for i, t in enumerate(texts_of(60, 2))]
    got = aligned(docs_of(spark, rows), BYTES, PIECES, frequent).select("id", *COLUMNS).collect()
    assert Counter(map(tuple, got)) == plain_alignment(rows)


def test_alignment_of_an_empty_table(spark):
    assert aligned(empty_docs(spark), BYTES, PIECES).collect() == []


def test_batches_are_cut_by_tokens(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "TOKENS", 1)
    rows = [(i, f"one text {i % 3}") for i in range(20)]
    got = aligned(docs_of(spark, rows), BYTES, PIECES).select("id", *COLUMNS).collect()
    assert Counter(map(tuple, got)) == plain_alignment(rows)
