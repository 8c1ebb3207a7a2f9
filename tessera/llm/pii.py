"""Personal data: expressions propose spans, checksums confirm them, nearby context words adjust the score. DataFrame functions only.

Each kind has an expression whose matches are leftmost and non-overlapping, a validator, a prior score and context
words. Matches come from regexp_extract_all, the gaps between them from split with the same expression;
running sums of their lengths give the spans in code points. The kinds of BASE stand as they
are proposed and validated; the others need a score of at least THRESHOLD, where a context word among
the CONTEXT characters before the span lifts the prior.

A text of n characters and m matches costs n + m log m steps: the expressions enter a run of
characters only at its start or where the last match ended (\\G), running sums double their stride, contexts are put
together from the pieces before a match, and card numbers are read from a copy of the text in which a single
blank or hyphen between digits became one marker character, so that no expression recurses.

Defined results: null and empty texts have no spans; rows that repeat a doc_id are searched one by one;
other columns are ignored (and kept by redact). Texts are searched whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import let, table

CONTEXT = 48
THRESHOLD = 0.5
LIFT = 0.4
#: Matches of five characters and more that fill the context for certain.
BEFORE = CONTEXT // 5 + 1
#: Single characters that stand for a blank and a hyphen between digits in the copy that cards are read from, and the sign of an escape there.
BLANK, HYPHEN, ESCAPE = "\x01", "\x02", "\x03"
BETWEEN_BLANK, BETWEEN_HYPHEN = "(?<=[0-9])[ ](?=[0-9])", "(?<=[0-9])[-](?=[0-9])"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def step(acc: Column, k: Column) -> Column:
        d = F.substring(digits, n - k, F.lit(1)).cast("int") * F.when(k % 2 == 1, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0


def mod97(iban: Column) -> Column:
    """ISO 13616: the first four characters to the end, letters as 10 to 35, the number modulo 97 is 1."""
    compact = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        return F.when(letter, (acc * 100 + F.ascii(c) - 55) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # an expression that a text with a match fulfils, cheap to test
    valid: object
    prior: float
    words: str  # context words, as alternatives
    marked: bool = False  # read from the copy with marks


def _card(m: Column) -> Column:
    digits = digits_of(m)
    return F.length(digits).between(13, 19) & luhn(digits)


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda m: F.lit(True), 0.8, "e-?mail|contact|write to"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), 0.6, r"\bip\b|address|host|server"),
    Kind("card", f"[0-9][0-9{BLANK}{HYPHEN}]++", "[0-9][ -]?[0-9]", _card, 0.7, "card|visa|credit|payment", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", lambda m: F.length(digits_of(m)).between(9, 15), 0.6, "phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", lambda m: F.length(F.regexp_replace(m, " ", "")).between(15, 34) & mod97(m), 0.6, "iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", lambda m: F.lit(True), 0.2, r"\bssn\b|social security|taxpayer"),
    Kind("secret", r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])", "[0-9A-Fa-f]{32}", lambda m: m.rlike("[0-9]") & m.rlike("[A-Fa-f]"), 0.3, "token|secret|api.?key|password|credential|bearer"),
)
#: Kinds whose spans may hold those of others come first.
REDACTION = ("secret", "email", "iban", "phone", "card", "ssn", "ip")
BASE = ("email", "ip", "card", "phone")


def running_sums(values: Column) -> Column:
    """Inclusive prefix sums of an array of ints by doubling strides: as many passes over the array as its length has binary digits."""

    def add(acc: Column, j: Column) -> Column:
        stride = F.call_function("shiftleft", F.lit(1), j - 1)
        return F.transform(acc, lambda v, i: F.when(i >= stride, v + acc[i - stride]).otherwise(v))

    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size(values)))), values, add)


def _with_matches(source: Column, kind: Kind, none: Column, body: Callable[[Column, Column], Column]) -> Column:
    """body(matches, gaps) of the text that the kind reads, or none if it has no valid match; there is a gap more than matches."""
    judged = lambda s, m: F.when(F.exists(m, kind.valid), let(F.split(s, kind.pattern, -1), lambda g: body(m, g))).otherwise(none)
    return let(source, lambda s: let(F.regexp_extract_all(s, F.lit(kind.pattern), F.lit(0)), lambda m: judged(s, m)))


def _judged(matches: Column, gaps: Column, kind: Kind) -> Column:
    """A struct for each match: at (its number), match, score, and hit, whether it is a span. The context is put together from the ends of the gaps and matches before."""
    last = lambda c: F.right(c, F.lit(CONTEXT))

    def of(pieces: Column) -> Column:
        def score(k: Column) -> Column:
            near = last(F.array_join(F.slice(pieces, F.greatest(2 * k - 2 * BEFORE, F.lit(0)) + 1, F.least(2 * k, F.lit(2 * BEFORE)) + 1), ""))
            return F.least(F.lit(1.0), F.lit(kind.prior) + F.when(F.lower(near).rlike(kind.words), LIFT).otherwise(0.0))

        scored = F.transform(matches, lambda m, k: F.struct(k.alias("at"), m.alias("match"), F.when(kind.valid(m), score(k)).alias("score")))
        least = 0.0 if kind.name in BASE else THRESHOLD
        return F.transform(scored, lambda x: F.struct(x["at"].alias("at"), x["match"].alias("match"), x["score"].alias("score"), F.coalesce(x["score"] >= least, F.lit(False)).alias("hit")))

    return let(F.flatten(F.transform(gaps, lambda g, k: F.array(last(g), F.coalesce(last(F.get(matches, k)), F.lit(""))))), of)


def _spans(text: Column, kind: Kind) -> Column:
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    source = F.regexp_replace(F.translate(text, BLANK + HYPHEN, "??"), BETWEEN_BLANK, BLANK) if kind.marked else text
    source = F.regexp_replace(source, BETWEEN_HYPHEN, HYPHEN) if kind.marked else source

    def placed(matches: Column, gaps: Column) -> Column:
        """The k-th match ends after the first k + 1 gaps and matches."""
        steps = F.transform(matches, lambda m, k: F.char_length(m) + F.char_length(gaps[k]))

        def span(x: Column, ends: Column) -> Column:
            end = ends[x["at"]]
            return F.struct(F.lit(kind.name).alias("kind"), (end - F.char_length(x["match"])).alias("start"), end.alias("end"), x["score"].alias("score"))

        hits = F.filter(_judged(matches, gaps, kind), lambda x: x["hit"])
        return let(hits, lambda h: let(running_sums(steps), lambda ends: F.transform(h, lambda x: span(x, ends))))

    return F.when(text.rlike(kind.needs), _with_matches(source, kind, none, placed)).otherwise(none)


def spans_of(text: Column) -> Column:
    """All spans of a text: kind, start, end, score; by kind as listed, then by start."""
    return F.concat(*[_spans(text, kind) for kind in KINDS])


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, score) of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), let(text, spans_of).alias("spans"))


def _replaced(c: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _without(text: Column, kind: Kind) -> Column:
    """The text with every span of one kind replaced by its name. In a marked copy, marks that were there before are escaped, and come back."""
    escaped = _replaced(text, (ESCAPE, ESCAPE + "e"), (BLANK, ESCAPE + "b"), (HYPHEN, ESCAPE + "h")) if kind.marked else text
    source = F.regexp_replace(F.regexp_replace(escaped, BETWEEN_BLANK, BLANK), BETWEEN_HYPHEN, HYPHEN) if kind.marked else text

    def joined(matches: Column, gaps: Column) -> Column:
        kept = F.transform(_judged(matches, gaps, kind), lambda x: F.when(x["hit"], f"[{kind.name.upper()}]").otherwise(x["match"]))
        whole = let(kept, lambda k: F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(k, i), F.lit("")))), ""))
        return _replaced(whole, (BLANK, " "), (HYPHEN, "-"), (ESCAPE + "b", BLANK), (ESCAPE + "h", HYPHEN), (ESCAPE + "e", ESCAPE)) if kind.marked else whole

    return F.when(text.rlike(kind.needs), _with_matches(source, kind, text, joined)).otherwise(text)


def redacted(text: Column) -> Column:
    """The text with spans replaced by their kind in brackets, kind by kind in the order of REDACTION, each in what the kinds before left."""
    by_name = {kind.name: kind for kind in KINDS}

    def after(t: Column, names: tuple[str, ...]) -> Column:
        return let(_without(t, by_name[names[0]]), lambda x: after(x, names[1:])) if names else t

    return after(text, REDACTION)


def redact(docs: DataFrame) -> DataFrame:
    """docs with texts redacted and n_chars counted anew; a null text stays null."""
    whole = F.when(F.col("text").isNotNull(), let(F.col("text").cast("string"), redacted))
    out = docs.withColumn("text", whole)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *map(count, BASE), F.size("spans").cast("long").alias("n_spans"), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


QUERIES = {"op6_pii": op6_pii}
SQL: dict[str, str] = {}
