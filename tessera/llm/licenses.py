"""Licence scans: an Aho-Corasick automaton finds phrases and identifier tags, a shunting-yard parser evaluates expressions.

A text is lower-cased (A-Z) and cut into words; the words, joined by single blanks, go through one
automaton that holds every phrase between blanks, so that a hit is a place where the phrase's words
stand consecutively. Phrases of BASE are counted and placed; phrases of NOTICES only add labels. After
an "SPDX-License-Identifier:" tag, which the same automaton finds, the rest of the line is an expression:
`or` binds weaker than `and`, `and` weaker than `with`, a trailing + belongs to its identifier. Its
operands become labels, and its value is the permissive share that a user can choose: `or` takes the
larger, `and` the smaller.

Defined results: null and empty texts have no words, null places, empty label strings and score 0; a
broken expression gives its identifiers as labels and no value; repeated rows are scanned one by one;
other columns are ignored. Texts are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import arrow_map, table, texts

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notice phrases of this method, in words as the scan cuts them.
NOTICES = {
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge": "mit",
    "mit license": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "unlicense": "unlicense",
    "no part of this publication may be reproduced": "reserved",
}
TAG = "spdx license identifier"
#: How freely a text under the label may be used, 0 to 1; unknown labels take UNKNOWN.
FREEDOM = {"cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "mit": 0.9, "bsd": 0.9, "apache": 0.9, "apache-2.0": 0.9, "cc-by": 0.8, "mpl": 0.6, "cc-by-sa": 0.5, "lgpl": 0.5, "gpl": 0.3, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "reserved": 0.0}
UNKNOWN = 0.5
STRENGTH = {"or": 1, "and": 2, "with": 3}

#: Bytes to lower case; what the words' pattern leaves out becomes a blank.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256))
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
#: A word that the scan keeps and no phrase holds.
GAP = " \uffff "
TAG_LINE = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.I)


def freedom(label: str) -> float:
    name = label.rstrip("+").removesuffix("-only").removesuffix("-or-later")
    for n in (name, name.partition("-")[0], "-".join(name.split("-")[:2])):
        if n in FREEDOM:
            return FREEDOM[n]
    return UNKNOWN


def leading(expression: str) -> tuple[list[str], int]:
    """The tokens up to the first that can't follow, and where the last of them ends."""
    found: list[str] = []
    depth, end = 0, 0
    operand = True  # what is due next
    for m in TOKEN.finditer(expression):
        word = m[0].lower()
        if operand and word == "(":
            depth += 1
        elif operand and word not in STRENGTH and word != ")":
            operand = False
        elif not operand and word in STRENGTH:
            operand = True
        elif not operand and word == ")" and depth:
            depth -= 1
        else:
            break
        found.append(word)
        end = m.end()
    return found, end


def to_postfix(expression: str) -> list[str] | None:
    """Shunting yard; the expression ends at the first token that can't follow. None if no valid one stands there."""
    out: list[str] = []
    stack: list[str] = []
    tokens, _ = leading(expression)
    for word in tokens:
        if word == "(":
            stack.append(word)
        elif word == ")":
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif word in STRENGTH:
            while stack and stack[-1] != "(" and STRENGTH[stack[-1]] >= STRENGTH[word]:
                out.append(stack.pop())
            stack.append(word)
        else:
            out.append(word)
    if not tokens or tokens[-1] in STRENGTH or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(postfix: list[str]) -> float:
    """`with` keeps the licence's value: an exception only adds rights."""
    values: list[float] = []
    for token in postfix:
        if token in STRENGTH:
            right, left = values.pop(), values.pop()
            values.append(max(left, right) if token == "or" else min(left, right) if token == "and" else left)
        else:
            values.append(freedom(token))
    return values[-1]


def identifiers(expression: str) -> list[str]:
    """The licences of a broken expression: its operands up to the first token that can't follow, without exceptions."""
    tokens, _ = leading(expression)
    return [t for k, t in enumerate(tokens) if t not in STRENGTH and t not in "()" and (not k or tokens[k - 1] != "with")]


def automaton(base: dict[str, str], notices: dict[str, str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {**base, **notices, TAG: ""}:
        found.add_word(f" {phrase} ", (phrase, base.get(phrase), notices.get(phrase)))
    found.make_automaton()
    return found


def flatten(text: str) -> tuple[str, int]:
    """The words of a text between single blanks, and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(FOLD).split()
    return " " + b" ".join(words).decode("utf-8", "surrogatepass") + " ", len(words)


def phrase_labels(text: str, finder: ahocorasick.Automaton) -> set[str]:
    """The labels of a text's phrases."""
    return {label for _, (_, *both) in finder.iter(flatten(text)[0]) for label in both if label is not None}


def scan(text: str, finder: ahocorasick.Automaton) -> tuple[int, int, int | None, int | None, str, str, float]:
    flat, n_words = flatten(text)
    n_base, first, last, tagged = 0, None, None, False
    base_labels, labels = set(), set()
    at, blanks = 0, 0
    for end, (phrase, base, notice) in finder.iter(flat):
        if base is not None:
            start = end - len(phrase) - 1
            # matches come by their end: a longer one may start before the last that was counted
            blanks, at = (blanks + flat.count(" ", at, start), start) if start >= at else (flat.count(" ", 0, start), start)
            n_base += 1
            first = blanks if first is None else min(first, blanks)
            last = blanks if last is None else max(last, blanks)
            base_labels.add(base)
        if notice is not None:
            labels.add(notice)
        tagged |= phrase == TAG
    labels |= base_labels
    values, chosen = [], set()
    # what stands outside the expressions, with a word in their place that is in no phrase
    outside, at = [], 0
    if tagged:
        for m in TAG_LINE.finditer(text):
            postfix = to_postfix(m[1])
            if postfix is None:
                broken = identifiers(m[1])
                labels.update(broken)
                values.extend(map(freedom, broken))
                continue
            exceptions = {k - 1 for k, t in enumerate(postfix) if t == "with"}
            chosen.update(t for k, t in enumerate(postfix) if t not in STRENGTH and k not in exceptions)
            values.append(evaluate(postfix))
            outside += [text[at : m.start(1)], GAP]
            at = m.start(1) + leading(m[1])[1]
    # a phrase inside an expression is the expression's: its reader may choose another operand
    values.extend(map(freedom, phrase_labels("".join([*outside, text[at:]]), finder) if outside else labels))
    labels |= chosen
    score = min(values, default=None)
    return n_words, n_base, first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), 0.0 if score is None else 1.0 - score


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """A row per document. score: how restrictive the strictest notice is, 0 (none, or free) to 1 (reserved)."""
    phrases = base or BASE, notices or NOTICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton(*phrases)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            rows = [scan(t, finder) for t in batch.column("text").to_pylist()]
            cols = [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=names)

    return arrow_map(texts(docs), run, SCHEMA)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


QUERIES = {"op4_licenses": op4_licenses}
SQL: dict[str, str] = {}
