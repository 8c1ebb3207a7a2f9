"""Byte-level BPE: a contiguous rank array per word, and decoding back to the text.

A word (a match of the pre-tokenizer's pattern) is a run of bytes. Its part boundaries and the
ranks of adjacent pairs stand in two parallel lists. While some pair has a rank, the lists are
scanned for the smallest (the leftmost of equals), the boundary between the two parts is deleted
and the ranks on both sides of it are looked up anew. Scanning beats a queue while a word is short; a word of over
LONG_WORD bytes keeps the same merges in a heap, so that its cost stays n log n.

Defined results: null and empty text give no ids and decode to the empty text; the special token's
string in a text is that token, as the tokenizers library reads it; repeated rows and doc_ids are
encoded one by one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import arrow_map, table, texts

#: The byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for the standard library's faster engine.
PLAIN = r" ?[^\W\d_]+| ?\d+|'s|'t|'re|'ve|'m|'ll|'d| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
LONG_WORD = 256
#: Words whose ids a worker keeps; the table is emptied when full.
KEPT_WORDS = 800_000
NO_RANK = 1 << 60
#: Found in texts with characters outside Latin letters and common punctuation, or with \x1c-\x1f or a number that isn't a digit: there the standard library's classes may differ from the pattern's.
UNLIKE = r"[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027]"


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def unsupported(spec: dict) -> None:
    """Raises where a file asks for something else than byte-level words and plain merges."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = {
        "normalizer": spec.get("normalizer") not in (None, {}),
        "pre_tokenizer": pre.get("type") != "ByteLevel" or pre.get("add_prefix_space", True) or not pre.get("use_regex", True),
        "model": model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix")),
        "added_tokens": any(t.get(k) for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word")) or any(t.get("normalized") and spec.get("normalizer") for t in spec["added_tokens"]),
    }
    if any(wrong.values()):
        raise ValueError(f"not a plain byte-level vocabulary: {', '.join(k for k, bad in wrong.items() if bad)}")


class BytePairCodec:
    """Encodes and decodes with a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        unsupported(spec)
        letters = byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        self.vocab = {spell(t): i for t, i in spec["model"]["vocab"].items()}
        #: Pair of ids -> rank and joined id, both as one integer: it compares as the rank does.
        self.pairs: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = spell(left), spell(right)
            self.pairs[self.vocab[a] << 20 | self.vocab[b]] = rank << 20 | self.vocab[a + b]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: t for t, i in self.vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.base = [self.vocab[bytes([b])] for b in range(256)]
        self.any_words, self.plain_words, self.unlike = regex.compile(PATTERN).findall, re.compile(PLAIN).findall, re.compile(UNLIKE).search
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, str] = {}
        self.decimal = [str(i) for i in range(max(self.bytes_of) + 1)]

    def merge(self, word: bytes) -> list[int]:
        if len(word) > LONG_WORD:
            return self.merge_long(word)
        parts = [self.base[b] for b in word]
        get = self.pairs.get
        ranks = [get(a << 20 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NO_RANK:
            at = ranks.index(best)
            parts[at] = joined = best & 0xFFFFF
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] << 20 | joined, NO_RANK)
            if at < len(ranks):
                ranks[at] = get(joined << 20 | parts[at + 1], NO_RANK)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        parts: list[int] = [self.base[b] for b in word]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(p, i, parts[i], parts[i + 1]) for i in range(n - 1) if (p := self.pairs.get(parts[i] << 20 | parts[i + 1]))]
        heapq.heapify(heap)
        while heap:
            best, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = best & 0xFFFFF, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := self.pairs.get(parts[a] << 20 | parts[b])):
                    heapq.heappush(heap, (p, a, parts[a], parts[b]))
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> str:
        """The ids of a word, in decimal and joined by commas."""
        ids = ",".join([self.decimal[i] for i in self.merge(word.encode())])
        if len(word) <= 64:
            if len(self.known) >= KEPT_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def encode_joined(self, text: str) -> str:
        """The text's ids in decimal, joined by commas."""
        out: list[str] = []
        known, start = self.known, 0
        words = self.any_words if self.unlike(text) else self.plain_words
        for m in self.cut.finditer(text) if self.cut and any(s in text for s in self.special) else ():
            out += [known.get(w) or self.word(w) for w in words(text[start : m.start()])]
            out.append(str(self.special[m[0]]))
            start = m.end()
        out += [known.get(w) or self.word(w) for w in words(text[start:] if start else text)]
        return ",".join(out)

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_joined(text).split(",")] if text else []

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")


_CODECS: dict[str, BytePairCodec] = {}


def codec(path: str) -> BytePairCodec:
    """One codec for each worker process and vocabulary file."""
    if path not in _CODECS:
        _CODECS[path] = BytePairCodec(path)
    return _CODECS[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, ids (if with_ids), n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    at = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(at)
        spelled = {d: c.bytes_of[i] for i, d in enumerate(c.decimal) if i in c.bytes_of}
        get = spelled.__getitem__
        for batch in batches:
            n, digest, back, lists = [], [], [], []
            for text in batch.column("text").to_pylist():
                joined = c.encode_joined(text)
                ids = joined.split(",") if joined else []
                n.append(len(ids))
                digest.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded = b"".join(map(get, ids)).decode("utf-8", "replace")
                back.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    lists.append([int(i) for i in ids])
            cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return arrow_map(texts(docs), run, schema)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


QUERIES = {"op7_bpe": op7_bpe}
SQL: dict[str, str] = {}
