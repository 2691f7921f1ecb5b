"""Personal data: patterns propose spans, checksums and ranges confirm them, context words add to a score.

Only DataFrame functions run here.  A text is looked at by a kind's pattern only if it holds a character
that every match needs.  Repeated parts of the patterns are possessive and matches start only where a
run starts, which changes no match and keeps long runs from being tried at each of their characters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = "A-Za-z0-9._%+-"
CONTEXT_CHARS = 40
#: Added to the score if a context word of the kind stands within ``CONTEXT_CHARS`` before a match.
CONTEXT_BONUS = 0.4
#: Kinds that the base list lacks are kept from this score on.
KEEP_SCORE = 0.6


@dataclass(frozen=True)
class Kind:
    name: str
    needs: str  # a pattern of single characters that every match holds
    pattern: str
    score: float
    context: str
    base: bool = True


#: In the order in which spans with one start are listed.
KINDS = (
    Kind("email", "@", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write"),
    Kind("ip", "[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", 0.6, r"\bip\b|address|host|server"),
    Kind("card", "[0-9]", r"[0-9](?:[\x20-]?+[0-9])++", 0.8, "card|visa|credit|payment"),
    Kind("phone", r"\+", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, r"phone|call|\btel|mobile|fax"),
    Kind("iban", "[A-Z]", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", 0.9, "iban|account|bank", False),
    Kind("ssn", "-", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, r"\bssn\b|social security", False),
    Kind("key", "AKIA", r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])", 0.9, "key|secret", False),
    Kind("secret", "[0-9]", r"(?<![A-Za-z0-9])[0-9a-f]{16,64}(?![A-Za-z0-9])", 0.3, "password|passwd|token|secret|api.?key", False),
)
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod_97(match: Column) -> Column:
    """Whether an IBAN's check digits are right: letters count 10 to 35, the first four signs go last."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    signs = F.split(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)), "")
    step = lambda rest, c: F.when(
        c.rlike("[0-9]"), rest * 10 + F.ascii(c) - 48
    ).otherwise(rest * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.filter(signs, lambda c: c != ""), F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return _mod_97(match)
    return F.lit(True)


def _check(kind: Kind):
    return lambda m: _valid(kind.name, m["match"])


def _scored(no: int, kind: Kind) -> Column:
    """The confirmed matches of a kind as spans; those of other than base kinds need their score."""

    def span(m: Column) -> Column:
        before = F.substring(
            F.col("body"), F.greatest(m["start"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT_CHARS))
        )
        bonus = F.when(before.rlike(f"(?i)(?:{kind.context})"), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            m["start"].cast("bigint").alias("start"), F.lit(no).alias("kind_no"), m["end"].cast("bigint").alias("end"),
            F.lit(kind.name).alias("kind"), F.least(F.lit(1.0), F.lit(kind.score) + bonus).alias("score"),
        )

    spans = F.transform("placed", span)
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= KEEP_SCORE)


def _count(name: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("bigint").alias(f"n_{name}")


SPAN = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,score:double>>"


def _placed(matches: Column, between: Column) -> Column:
    """Start, end and text of each match: ``between`` is what stands before, between and after them."""
    step = lambda done, i: F.struct(
        (done["at"] + F.char_length(F.get(between, i)) + F.char_length(F.get(matches, i))).alias("at"),
        F.array_append(done["found"], F.struct(
            (done["at"] + F.char_length(F.get(between, i))).alias("start"),
            (done["at"] + F.char_length(F.get(between, i)) + F.char_length(F.get(matches, i))).alias("end"),
            F.get(matches, i).alias("match"),
        )).alias("found"),
    )
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.aggregate(
        F.sequence(F.lit(0), F.size(matches) - 1), F.struct(F.lit(0).alias("at"), none.alias("found")), step,
        lambda done: done["found"],
    )


def find(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: kind, start, end (code points, the end exclusive) and score, sorted by
    start and then by kind.

    Matches of a kind are leftmost and do not overlap; one that its check refuses is dropped and the
    search goes on behind it.  Kinds of the base list stay whatever their score; others need
    ``KEEP_SCORE``.  A null or empty text has no spans; every row gives one row.  Beside ``spans``, all
    columns of ``docs`` come back as they are, whatever their names.
    """
    frame = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.coalesce(docs[text], F.lit("")).alias("body"))
    empty = F.array().cast(SPAN)
    for no, kind in enumerate(KINDS):
        found = F.regexp_extract_all("body", F.lit(kind.pattern), F.lit(0))
        frame = frame.withColumn("matches", F.when(F.col("body").rlike(kind.needs), found))
        frame = frame.withColumn("between", F.when(F.size("matches") > 0, F.split("body", kind.pattern, -1)))
        placed = _placed(F.col("matches"), F.col("between"))
        frame = frame.withColumn("placed", F.when(F.size("matches") > 0, F.filter(placed, _check(kind))))
        frame = frame.withColumn(
            f"spans_{kind.name}", F.when(F.size("placed") > 0, _scored(no, kind)).otherwise(empty)
        ).drop("matches", "between", "placed")
    every = F.array_sort(F.concat(*[F.col(f"spans_{k.name}") for k in KINDS]))
    return frame.select("doc", every.alias(spans)).select("doc.*", spans)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    step = lambda done, s: F.struct(
        F.greatest(done["at"], s["end"]).alias("at"),
        F.when(s["start"] >= done["at"], F.concat(done["parts"], F.array(
            F.substring(text, done["at"].cast("int") + 1, (s["start"] - done["at"]).cast("int")),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
        ))).otherwise(done["parts"]).alias("parts"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    rest = lambda done: F.concat(
        F.array_join(done["parts"], ""), F.substring(text, done["at"].cast("int") + 1, F.char_length(text))
    )
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def summary(found: DataFrame) -> DataFrame:
    """Number of spans of each base kind, a digest of the base spans, and all spans."""
    base = F.filter("spans", lambda s: s["kind_no"].isin([n for n, k in enumerate(KINDS) if k.base]))
    counts = [_count(k.name) for k in KINDS if k.base]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
