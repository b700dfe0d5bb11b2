"""Personal data: patterns propose spans, checksums confirm them, context weighs them.

Every step is a column expression on one row, so a document is read once and nothing is
shuffled. Spans come from cutting the text at the matches: the lengths of the pieces and
of the matches, summed up, are the places.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before and behind a span that are searched for words that speak for its kind.
CONTEXT = 40
_CHUNK = 256


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _digit_count(match: Column, least: int, most: int) -> Column:
    return F.length(_digits(match)).between(least, most)


def _mod_97(match: Column) -> Column:
    """ISO 7064 over the account number, without gaps, with its first four characters moved to the end."""
    match = F.regexp_replace(match, "\x20", "")
    turned = F.concat(F.substring(match, 5, 64), F.substring(match, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)
    return match.rlike("^[A-Z0-9]{15,34}$") & (rest == 1)


def _social_number(match: Column) -> Column:
    """Three, two and four digits, without the groups that are never issued."""
    return match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$") & ~match.rlike("^(000|666|9)|-00-|-0000$")


_IP_PART = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds a span, ``valid`` confirms it, ``context`` words raise its score.

    A span needs ``least`` in all; a base kind is kept whatever its score is.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    context: str
    score: float
    base: bool = True
    least: float = 0.5


# The patterns find what the plain ones find. Possessive repeats and the guards in front
# only keep the matcher from trying a long run again from each of its characters.
# The order of the base kinds is the order of their spans.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        "mail|contact|write|reach|kontakt|correo|courriel",
        0.9,
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{_IP_PART}(\.{_IP_PART}){{3}}$"),
        r"\bip\b|host|server|address|login|ping",
        0.7,
    ),
    Kind(
        "card",
        r"[0-9]++(?:[\x20-]?+[0-9]++)*+",
        lambda m: _digit_count(m, 13, 19) & F.call_function("luhn_check", _digits(m)),
        "card|visa|master|amex|credit|debit|karte|tarjeta|carte|pay",
        0.8,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: _digit_count(m, 9, 15),
        "phone|call|tel|mobile|fax|whatsapp|sms",
        0.7,
    ),
    Kind(
        "iban",
        # Written as one or in groups of four.
        r"[A-Z]{2}[0-9]{2}(?:[0-9A-Za-z]++|(?:\x20[0-9A-Z]{4}){2,7}(?:\x20[0-9A-Z]{1,3})?)",
        _mod_97,
        "iban|bank|account|konto|cuenta|compte",
        0.9,
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9])[0-9]++(?:-[0-9]++)++",
        _social_number,
        "ssn|social|security|insured",
        0.4,
        base=False,
    ),
)
_BONUS = 0.1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and however deep it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column) -> Column:
    """0 and the sums up to each element."""
    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(values, start, lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))


def _totals_before(lengths: Column) -> Column:
    """For each element the sum of those before it, by chunks so that long arrays stay nearly linear."""

    def chunked(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / _CHUNK).cast("int")
        each = F.transform(
            F.sequence(F.lit(0), last), lambda c: _running(F.slice(values, c * _CHUNK + 1, F.lit(_CHUNK)))
        )
        return _let(each, shifted)

    def shifted(inner: Column) -> Column:
        return _let(
            _running(F.transform(inner, lambda chunk: F.element_at(chunk, -1))),
            lambda outer: F.flatten(
                F.transform(
                    inner,
                    lambda chunk, c: _let(
                        F.get(outer, c),
                        lambda base: F.transform(F.slice(chunk, 1, F.size(chunk) - 1), lambda x: x + base),
                    ),
                )
            ),
        )

    return _let(lengths, chunked)


_SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _found(text: Column, matches: Column, kind: Kind) -> Column:
    """The confirmed spans of a kind, of which the text has at least one match."""

    none = F.lit("")

    def spans(gaps: Column) -> Column:
        def near(i: Column) -> Column:
            """What stands on either side, also beyond the next match of the kind."""

            def last(x: Column) -> Column:
                return F.coalesce(F.right(x, F.lit(CONTEXT)), none)

            def first(x: Column) -> Column:
                return F.coalesce(F.left(x, F.lit(CONTEXT)), none)

            before = F.concat(last(F.get(gaps, i - 1)), last(F.get(matches, i - 1)), last(F.get(gaps, i)))
            behind = F.concat(first(F.get(gaps, i + 1)), first(F.get(matches, i + 1)), first(F.get(gaps, i + 2)))
            return F.lower(F.concat(last(before), F.lit(" | "), first(behind)))

        def span(place: Column) -> Column:
            start = place["before"] + F.length(F.get(gaps, place["i"]))
            score = F.lit(kind.score) + F.when(near(place["i"]).rlike(kind.context), F.lit(_BONUS)).otherwise(F.lit(0.0))
            return F.struct(
                F.lit(kind.name).alias("kind"), start.alias("start"),
                (start + F.length(place["match"])).alias("end"), score.alias("score"),
            )

        size = F.transform(matches, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("long"))
        number = F.sequence(F.lit(0), F.size(matches) - 1)
        placed = F.arrays_zip(_totals_before(size).alias("before"), matches.alias("match"), number.alias("i"))
        confirmed = F.transform(F.filter(placed, lambda p: kind.valid(p["match"])), span)
        return confirmed if kind.base else F.filter(confirmed, lambda s: s["score"] >= kind.least)

    # The pieces between the matches; the last one is behind them all.
    return _let(F.split(text, kind.pattern, -1), spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ``spans`` (kind, start, end, score).

    Starts and ends count code points, ends are exclusive; spans are ordered by kind as
    in ``KINDS``, then by start. Null and empty texts have none. Repeated rows each give
    a row; other columns are ignored.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    none, text = F.array().cast(_SPAN), F.col("_text")

    def of(kind: Kind) -> Column:
        matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        return _let(matches, lambda m: F.when(F.size(m) > 0, _found(text, m, kind)).otherwise(none))

    spans = [of(kind) for kind in KINDS]
    return rows.select(F.col(id_col), F.concat(*spans).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans as text."""
    base = [kind.name for kind in KINDS if kind.base]
    found = find_pii(docs, id_col, text_col)

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    is_base = lambda s: reduce(lambda a, b: a | b, [s["kind"] == name for name in base])
    return found.select(
        F.col(id_col), *(count(name) for name in base),
        F.sha2(span_list(F.filter("spans", is_base)), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
