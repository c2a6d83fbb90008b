"""Token counts by byte-pair merging with a heap and a linked list.

Texts are cut as the tokenizer's file says, by the library's own normaliser and pre-tokenizer; the merging is done here. The symbols
of a word lie in a linked list, every adjacent pair that may merge lies in a heap by (rank, place), and the lowest pair is popped
until none is left; popped pairs whose symbols have merged meanwhile are skipped. A word has as many tokens as it has symbols minus
merges, so no identifiers are emitted.

The file must drop white space between words, so that no word, and no step of the normaliser, reaches over a space (the parts of
the file that would tell are checked). So characters whose composed form, lower case and class are the same in every version of
Unicode (``common.SAFE``) are cut by the file's pattern at once, and only chunks with others go through the library's own steps. Counts of
words met before are looked up, at most ``CACHE`` words of up to ``CACHED`` characters; a full table starts anew. No result depends
on either.

Special strings inside a text count as one token each, as the library has it by default. Symbols that the vocabulary lacks count
nothing, as in the library.

Defined results: a missing or empty text has no tokens and no bytes; repeated rows each get a row; missing identifiers stay
missing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import unsafe

CACHE, CACHED = 1 << 18, 48
LIMIT = 2048
_SHIFT = 32
_PLACES = (1 << _SHIFT) - 1


def _split(spec: dict) -> dict:
    """The first step of the pre-tokenizer, which cuts a text into words; only byte-level coding without a pattern may follow."""
    cut = spec.get("pre_tokenizer") or {}
    first, *rest = cut.get("pretokenizers", [cut])
    if any(r["type"] != "ByteLevel" or r.get("use_regex") or r.get("add_prefix_space") for r in rest) or not rest:
        raise ValueError("token counts need words in byte-level form")
    return first if first.get("type") == "Split" else {"pattern": {}}


def _steps(spec: dict) -> list[dict]:
    normal = spec.get("normalizer")
    return normal.get("normalizers", [normal]) if normal else []


def check_file(spec: dict) -> None:
    """Raises if the counting rules of this module do not hold for a tokenizer file."""
    model = spec["model"]
    plain = not (model.get("dropout") or model.get("unk_token") or model.get("byte_fallback") or model.get("ignore_merges"))
    if model.get("type") != "BPE" or not plain or model.get("continuing_subword_prefix"):
        raise ValueError("token counts need a plain byte-pair model")
    cut = _split(spec)
    words = cut["pattern"].get("Regex") if cut.get("behavior") == "Removed" and cut.get("invert") else None
    if not words or regex.search(words, " \t\n\r"):
        raise ValueError("token counts need a file whose words hold no white space")
    for step in _steps(spec):
        spaces = step["type"] == "Replace" and step["pattern"].get("Regex") == r"\s+" and step["content"] == " "
        if step["type"] not in ("NFC", "Lowercase") and not spaces:
            raise ValueError("the file normalises text in a way that may reach over spaces")
    for t in spec.get("added_tokens", []):
        if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]):
            raise ValueError(f"added token {t['content']!r} is not a plain string")


class TokenCounter:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        data = json.loads(spec)
        check_file(data)
        whole = Tokenizer.from_str(spec)
        self.normalizer, self.cutter = whole.normalizer, whole.pre_tokenizer
        model = data["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        # Byte-level form: the printable bytes stand for themselves, the others for the characters from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        self.byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        form = {b: c for c, b in self.byte.items()}
        self.inner = [vocab.get(form[b]) for b in range(256)]
        self.last = [vocab.get(form[b] + suffix) for b in range(256)]
        self.base = max(vocab.values()) + 1
        self.ranks, self.merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] * self.base + vocab[b]] = rank
            self.merged.append(vocab[a + b])
        self.specials = sorted((t["content"] for t in data.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        self.cut = regex.compile(_split(data)["pattern"]["Regex"]).findall
        self.lower = any(n["type"] == "Lowercase" for n in _steps(data))
        self.words: dict[str, int] = {}

    def merge(self, symbols: list[int]) -> int:
        """The number of merges in a word. ``symbols`` is used up."""
        get, merged, base, n = self.ranks.get, self.merged, self.base, len(symbols)
        # The rank of each symbol and the one after it, while that pair stands; a popped pair that does not is out of date.
        pair = [get(a * base + b, -1) for a, b in zip(symbols, symbols[1:])]
        heap = [rank << _SHIFT | i for i, rank in enumerate(pair) if rank >= 0]
        if not heap:
            return 0
        heapify(heap)
        pair.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            top = heappop(heap)
            i, rank = top & _PLACES, top >> _SHIFT
            if pair[i] != rank:
                continue
            merges += 1
            left = symbols[i] = merged[rank]
            j = after[i]
            pair[j] = -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                rank = pair[i] = get(left * base + symbols[j], -1)
                if rank >= 0:
                    heappush(heap, rank << _SHIFT | i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                rank = pair[h] = get(symbols[h] * base + left, -1)
                if rank >= 0:
                    heappush(heap, rank << _SHIFT | h)
        return merges

    def word(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            *inner, last = word.encode("utf-8")
            symbols = [self.inner[b] for b in inner]
            symbols.append(self.last[last])
            if None in symbols:
                symbols = [s for s in symbols if s is not None]
            n = len(symbols)
            if n > 1:
                n -= self.merge(symbols)
            if len(word) <= CACHED:
                if len(self.words) >= CACHE:
                    self.words.clear()
                self.words[word] = n
        return n

    def safe(self, text: str) -> int:
        """Tokens of a text of safe characters."""
        known, word = self.words.get, self.word
        return sum([known(w) or word(w) for w in self.cut(text.lower() if self.lower else text)])

    def other(self, text: str) -> int:
        """Tokens of any text without special strings, cut by the library."""
        normal = self.normalizer.normalize_str(text) if self.normalizer else text
        words = self.cutter.pre_tokenize_str(normal)
        return sum(self.word(bytes([self.byte[c] for c in w]).decode("utf-8")) for w, _ in words if w)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not unsafe(text) and not any(s in text for s in self.specials):
            return self.safe(text)
        total, safe = 0, []
        for chunk in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
            special = any(s in chunk for s in self.specials)
            if not special and not unsafe(chunk):
                safe.append(chunk)
                continue
            at = 0
            for m in self.special.finditer(chunk) if special else ():
                total += 1 + self.other(chunk[at : m.start()])
                at = m.end()
            total += self.other(chunk[at:])
        return total + self.safe(" ".join(safe))


@lru_cache(maxsize=2)
def _counter(spec: str) -> TokenCounter:
    """One counter for each worker process and file."""
    return TokenCounter(spec)


def count_all(spec: str, texts: Iterable[str | None]) -> list[int]:
    counter = _counter(spec)
    return [counter.count(t) for t in texts]


def token_count(df: DataFrame, path: str, text_col: str = "text") -> Column:
    """Long column: the tokens of ``text_col`` of ``df``. The file at ``path`` is read by the driver and sent to the tasks."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    check_file(json.loads(spec))
    shared = df.sparkSession.sparkContext.broadcast(spec)  # a vocabulary: its size does not depend on the table

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(count_all(shared.value, (t.as_py() for t in batch)), pa.int64())

    return of(F.col(text_col))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sizes = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    counted = rows.select("id", sizes.alias("n_bytes"), token_count(rows, path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
