from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from tessera.llm import pii

FRAGMENTS = ["a@b.co", "x.y+z@d-e.f.gh", "1.2.3.4", "192.168.0.256", "10.0.0.1.5", "4111 1111 1111 1111", "4111-1111-1111-1111", "4242424242424242", "+1 (555) 123-4567", "+49 30 1234567", "_", "@", ".", " ", "-", "1", "22", "é", "😀", "\x01", "+", "(", "\n", "a", "7 ", "0"]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and not all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and not (13 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark):
    r = random.Random(3)
    rows = [(k, "".join(r.choice(FRAGMENTS) for _ in range(r.randint(0, 14)))) for k in range(1500)]
    rows += [(9001, None), (9002, "1 " * 40_000), (9004, "a@" * 20_000 + "b.c" * 3000), (9005, "+1" + "1 " * 20_000), (9006, "mail a@b.co, " * 2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: [(s.kind, s.start, s.end) for s in x.spans if s.kind in pii.BASE] for x in pii.find_pii(df).collect()}
    assert all(got[k] == brute(t) for k, t in rows)


def test_long_runs_end(spark):
    rows = [(1, "a" * 100_000), (2, "1" * 100_000), (3, "1." * 50_000)]
    got = {x.doc_id: x.spans for x in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [] and got[2] == [] and len(got[3]) == 12_500


def test_context_and_checksums(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00 end"), (2, "IBAN DE89 3704 0044 0532 0130 01"), (3, "my SSN is 123-45-6789"), (4, "part 123-45-6789")]
    got = {x.doc_id: [s.kind for s in x.spans] for x in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["iban"], 2: [], 3: ["ssn"], 4: []}


def test_redaction(spark):
    rows = [(1, "é a@b.co, 1.2.3.4!", 9), (2, None, 0), (3, "", 0), (4, "to x@1.2.3.4.com now", 1), (5, "a@b.co", 1)]
    out = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()}
    assert out[1] == ("é [EMAIL], [IP]!", 16) and out[2] == (None, None) and out[3] == ("", 0) and out[5] == ("[EMAIL]", 7)
    assert out[4] == ("to [EMAIL] now", 14)  # the address inside overlaps


def test_many_matches_in_one_text(spark):
    """Linear in the matches: a text of 100,000 addresses beside one of accounts, within seconds."""
    n = 100_000
    text = "é a@b.co," * n
    df = spark.createDataFrame([(1, text), (2, "x " * 10 + "DE89 3704 0044 0532 0130 00; " * 5000)], "doc_id long, text string")
    began = time.monotonic()
    got = {r.doc_id: r for r in pii.find_pii(df).select("doc_id", F.size("spans").alias("n"), F.element_at("spans", -1).alias("last")).collect()}
    assert got[1].n == n and (got[1].last.start, got[1].last.end) == (9 * n - 7, 9 * n - 1)
    assert got[2].n == 5000
    out = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert out[1] == "é [EMAIL]," * n and out[2] == "x " * 10 + "[IBAN]; " * 5000
    assert time.monotonic() - began < 60


def test_context_reaches_over_earlier_matches(spark):
    rows = [(1, "SSN: 123-45-6789, 123-45-6780 and 123-45-6781"), (2, "SSN " + "x" * 60 + " 123-45-6789"), (3, 'token = "' + "0a" * 20 + '"'), (4, "commit " + "0a" * 20), (5, "secret 1.2.3.4 " + "0a" * 20)]
    got = {x.doc_id: [(s.kind, s.start) for s in x.spans] for x in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [("ssn", 5), ("ssn", 18), ("ssn", 34)], 2: [], 3: [("secret", 9)], 4: [], 5: [("ip", 7), ("secret", 15)]}


def test_marks_come_back(spark):
    text = "\x01\x02\x03b 1 2-3 \x03e 4111 1111-1111 1111 \x01 9-9 9\x02"
    row = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.redact(row).head().text == text.replace("4111 1111-1111 1111", "[CARD]")


def test_empty_repeated_and_clashing(spark):
    df = spark.createDataFrame([(1, "a@b.co", "x", 3), (1, "a@b.co", "y", 4), (None, "1.2.3.4", None, None)], "doc_id long, text string, spans string, `a.b` int")
    assert pii.find_pii(df.limit(0)).count() == 0 and pii.redact(df.limit(0)).count() == 0
    assert sorted(len(r.spans) for r in pii.find_pii(df).collect()) == [1, 1, 1]
    out = pii.redact(df)
    assert out.columns == df.columns and sorted((r.text, r.spans or "") for r in out.collect()) == [("[EMAIL]", "x"), ("[EMAIL]", "y"), ("[IP]", "")]
