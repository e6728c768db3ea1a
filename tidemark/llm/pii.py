"""Personal data, by DataFrame expressions alone.

Regular expressions propose spans. ``split`` by a pattern and the pattern's matches alternate, so the
running sum of their lengths gives each match's place; a text is only taken apart by a pattern
if it matches at all. Validators confirm spans: number ranges, Luhn's sum for cards, the remainder
by 97 for account numbers, digit counts for telephone numbers. Words near a span move its score. Spans of
the base kinds stand whatever their score; the further kinds must reach a threshold.

The patterns are written so that no text makes them slow: classes are possessive where giving back
could not help, and a run is entered only at its start or where the last match ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import documents, query

THRESHOLD = 0.5
# Code points before and after a span in which context words count.
NEAR = 40


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: what proposes it, a cheap test for texts that cannot hold it, what
    confirms it, the score it starts from, and the words that raise the score."""

    name: str
    pattern: str
    gate: str
    valid: Callable[[str], str]
    score: float
    context: str
    base: bool = False


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _remainder_97(m: str) -> str:
    """Letters count from 10, the first four characters go to the end; the number's remainder by 97."""
    plain = f"replace({m}, ' ', '')"
    step = "case when c = '' then a when c between '0' and '9' then (a * 10 + int(c)) % 97 else (a * 100 + ascii(c) - 55) % 97 end"
    return f"aggregate(split(substr({plain}, 5) || substr({plain}, 1, 4), ''), 0, (a, c) -> {step})"


# The base kinds' shapes and limits, in their order. This module's own kinds follow.
KINDS = (
    Kind(
        "email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
        lambda m: "true", 0.9, "mail|contact|write to|kontakt|correo|courriel", True,
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".",
        lambda m: f"{m} rlike '^{_PART}([.]{_PART}){{3}}$'", 0.7, "ip|host|server|address|adresse|login", True,
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?[0-9])++", "",
        lambda m: f"length({_digits(m)}) between 12 and 19 and luhn_check({_digits(m)})", 0.7, "card|visa|master|credit|karte|tarjeta|carte", True,
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+",
        lambda m: f"length({_digits(m)}) between 9 and 15", 0.7, "phone|call|tel|fax|mobil|telefon", True,
    ),
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "",
        lambda m: f"length(replace({m}, ' ', '')) between 15 and 34 and {_remainder_97(m)} = 1", 0.9, "iban|account|konto|cuenta|compte|bank",
    ),
    Kind(
        "ssn", r"(?<![0-9-])(?!000|666|9[0-9][0-9])[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "-",
        lambda m: "true", 0.3, "ssn|social|security|tax",
    ),
    Kind(
        "secret", r"(?<![A-Za-z0-9])(?i:token|secret|password|passwd|api[_-]?key)[ ]{0,3}[=:][ ]{0,3}[\"']?[A-Za-z0-9_/+-]{16,}+", "",
        lambda m: "true", 0.8, "key|auth|secret|token",
    ),
    Kind(
        "birth", r"(?<![0-9])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9])", "-",
        lambda m: "true", 0.2, "born|birth|geboren|nacid|naissance|né le",
    ),
)

_SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,score:double>>"


def _quoted(text: str) -> str:
    """A text as a raw SQL literal."""
    return "r'" + text.replace("'", r"\x27") + "'"


def _matches(text: str, rank: int, kind: Kind) -> str:
    """SQL for all confirmed spans of one kind."""
    pattern = _quoted(kind.pattern)
    # What lies before a match, and the match; the rest after the last match has none.
    steps = f"zip_with(split({text}, {pattern}, -1), regexp_extract_all({text}, {pattern}, 0), (gap, m) -> struct(coalesce(length(gap), 0) as gap, m))"
    near = f"lower(substr({text}, greatest(1, a.at + s.gap + 1 - {NEAR}), length(s.m) + 2 * {NEAR}))"
    score = f"least(1.0D, {kind.score}D + if({near} rlike {_quoted(kind.context)}, 0.3D, 0.0D))"
    stands = f"s.m is not null and {kind.valid('s.m')}" + ("" if kind.base else f" and {score} >= {THRESHOLD}D")
    span = f"named_struct('start', a.at + s.gap, 'rank', {rank}, 'stop', a.at + s.gap + length(s.m), 'kind', '{kind.name}', 'score', {score})"
    found = (
        f"aggregate({steps}, named_struct('at', 0, 'found', cast(array() as {_SPAN})), "
        f"(a, s) -> named_struct('at', a.at + s.gap + coalesce(length(s.m), 0), 'found', if({stands}, array_append(a.found, {span}), a.found))).found"
    )
    gate = f"contains({text}, '{kind.gate}') and " if kind.gate else ""
    return f"if({gate}{text} rlike {pattern}, {found}, cast(array() as {_SPAN}))"


def spans_column(text: str, kinds: Sequence[Kind] = KINDS) -> Column:
    """All spans of a text column by start, then kind, as ``(start, rank, stop, kind, score)``; offsets
    are code points and ``stop`` is the first one after the span. A missing text has none."""
    found = ", ".join(_matches(text, rank, kind) for rank, kind in enumerate(kinds))
    return F.expr(f"array_sort(coalesce(concat({found}), cast(array() as {_SPAN})))")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redacted(text: str, spans: str) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the kind of the first in brackets."""
    return F.expr(
        f"if(size({spans}) = 0, {text}, aggregate({spans}, named_struct('at', 0, 'out', ''), "
        "(a, s) -> if(s.start >= a.at, "
        f"named_struct('at', s.stop, 'out', a.out || substr({text}, a.at + 1, s.start - a.at) || '[' || upper(s.kind) || ']'), "
        "named_struct('at', greatest(a.at, s.stop), 'out', a.out)), "
        f"a -> a.out || substr({text}, a.at + 1)))"
    )


def find_personal_data(docs: DataFrame, text_column: str = "text", name: str = "pii") -> DataFrame:
    """All columns of the documents and an array ``pii`` of spans, see :func:`spans_column`.

    A missing or empty text has no spans; rows without an id and repeated rows are searched like others;
    an empty table gives an empty result. A column of the array's name is replaced.
    """
    return docs.withColumn(name, spans_column(f"`{text_column}`"))


@query()
def op7_personal_data(spark, sf_dir):
    """Spans of personal data in every document."""
    found = find_personal_data(documents(spark, sf_dir)).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["rank"] < sum(kind.base for kind in KINDS))
    counts = (F.expr(f"cast(size(filter(pii, s -> s.kind = '{kind.name}')) as bigint) as n_{kind.name}") for kind in KINDS if kind.base)
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"))
