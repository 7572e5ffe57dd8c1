"""Operator 5: personal data by patterns, checksums and nearby words.

Patterns propose spans, validators confirm them (Luhn for cards, mod 97 for bank accounts, part and
digit counts for addresses and phones), and words nearby move the score. Column functions only.

The base patterns keep their leftmost, non-overlapping matches. They are written here so that a
match can only start where the plain pattern's leftmost match would, and possessively where nothing
follows that could need the characters back: the same matches in linear time and without deep
recursion on very long texts.

Defined results: null and empty texts have no spans; each row is judged alone, so ties and repeats
don't matter; positions are code points, end exclusive; other columns are kept untouched by
:func:`redact` and ignored by :func:`spans`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import let

_R = "A-Za-z0-9._%+-"
SPAN = "struct<kind:string,start:int,end:int,score:double,base:boolean>"
CONTEXT_CHARS, MIN_SCORE = 48, 0.5


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def valid_ip(s: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(s, r"\."), lambda p: (F.length(part(p)) <= 3)
                    & F.coalesce(part(p).try_cast("int") <= 255, F.lit(False)))


def valid_card(s: Column) -> Column:
    n = F.length(_digits(s))
    return (n >= 13) & (n <= 19) & F.call_function("luhn_check", _digits(s))


def valid_phone(s: Column) -> Column:
    n = F.length(_digits(s))
    return (n >= 9) & (n <= 15)


def valid_iban(s: Column) -> Column:
    """Mod 97 over the rearranged account number, letters counting 10 to 35."""
    plain = F.replace(s, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    step = lambda acc, c: F.when(
        c.rlike("[0-9]"), (acc * 10 + c.try_cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.length(plain).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


def valid_any(s: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Detector:
    """``needs``: a cheap pattern without which there can be no match. ``score`` before words
    nearby; ``base`` detectors score enough alone."""

    kind: str
    pattern: str
    needs: str
    valid: object
    score: float
    near: str
    base: bool = True


# Base patterns first, in the order in which spans are listed; then the method's additions: bank
# accounts, cards and phones that touch other digits (the base drops the whole run), and
# nine-digit identity numbers, which count only beside a word that names them.
DETECTORS = (
    Detector("email", rf"(?:(?<![{_R}])|\G)[{_R}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", valid_any,
             0.9, "mail|contact|write"),
    Detector("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", valid_ip, 0.6, "ip|address|host|server"),
    Detector("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])", "[0-9]", valid_card,
             0.8, "card|visa|pay|credit"),
    Detector("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", valid_phone, 0.7, "phone|call|tel|mobile"),
    Detector("card", r"(?<![0-9])[0-9]{13,19}+(?![0-9])", "[0-9]", valid_card, 0.7, "card|visa|pay|credit", False),
    Detector("phone", r"\+[0-9]{1,3} ?\([0-9]{2,4}\) ?[0-9]{3}[ -][0-9]{4}(?![0-9])", r"\+[0-9]", valid_phone,
             0.7, "phone|call|tel|mobile", False),
    Detector("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}",
             valid_iban, 0.8, "iban|account|bank", False),
    Detector("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-[0-9]{2}-", valid_any,
             0.3, "ssn|social security|national id", False),
)
KINDS = ("email", "ip", "card", "phone", "iban", "national_id")


def detect(text: Column, detector: Detector, min_score: float = MIN_SCORE) -> Column:
    """array<span> of one detector, in text order.

    ``regexp_extract_all`` has the matches and ``split`` what lies between them, so the running sum
    of their lengths gives each match its place."""
    none = F.array().cast(f"array<{SPAN}>")
    pattern = F.lit(detector.pattern)

    def place(found):
        matches, between = found["m"], found["g"]

        def step(acc, i):
            hit = F.get(matches, i)
            start = (acc["at"] + F.length(F.get(between, i))).cast("int")
            end = (start + F.length(hit)).cast("int")
            before = F.lower(F.substring(text, F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1,
                                         F.least(start, F.lit(CONTEXT_CHARS))))
            after = F.lower(F.substring(text, end + 1, CONTEXT_CHARS))
            near = F.concat_ws(" ", before, after).rlike(rf"\b(?:{detector.near})")
            score = F.least(F.lit(1.0), F.lit(detector.score) + F.when(near, 0.3).otherwise(0.0))
            span = F.struct(F.lit(detector.kind).alias("kind"), start.alias("start"), end.alias("end"),
                            score.alias("score"), F.lit(detector.base).alias("base"))
            return F.struct(end.alias("at"),
                            F.when(F.coalesce(detector.valid(hit), F.lit(False)), F.concat(acc["out"], F.array(span)))
                            .otherwise(acc["out"]).alias("out"))

        zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
        placed = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), zero, step, lambda acc: acc["out"])
        return F.when(F.size(matches) == 0, none).otherwise(
            F.filter(placed, lambda s: s["score"] >= min_score))

    found = let(F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
                         F.split(text, detector.pattern, -1).alias("g")), place)
    return F.when(text.rlike(detector.needs), found).otherwise(none)


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def spans(text: Column, min_score: float = MIN_SCORE) -> Column:
    """array<struct<kind,start,end,score,base>> by kind, then start. Additions that overlap a base
    span of their own kind are left out."""
    text = F.coalesce(text, F.lit(""))
    base = F.concat(*[detect(text, d, min_score) for d in DETECTORS if d.base])
    more = F.concat(*[detect(text, d, min_score) for d in DETECTORS if not d.base])

    def join(found):
        extra = F.filter(found["more"], lambda x: ~F.exists(
            found["base"], lambda b: (b["kind"] == x["kind"]) & (b["start"] < x["end"]) & (x["start"] < b["end"])))
        keyed = F.transform(F.concat(found["base"], extra),
                            lambda s: F.struct(_rank(s["kind"]).alias("r"), s["start"].alias("s"), s.alias("span")))
        return F.transform(F.array_sort(keyed), lambda k: k["span"])

    return let(F.struct(base.alias("base"), more.alias("more")), join)


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets (overlapping
    spans by that of the first), and ``n_chars``, where there is one, brought up to date. Other
    columns stay; a null text stays null."""
    def rewrite(text, found):
        by_start = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"),
                                                                      s["kind"].alias("k"))))

        def step(acc, s):
            mark = F.concat(F.lit("<"), F.upper(s["k"]), F.lit(">"))
            gap = F.substring(text, acc["at"] + 1, F.greatest(s["s"] - acc["at"], F.lit(0)))
            out = F.when(s["s"] >= acc["at"], F.concat(acc["out"], F.array(gap, mark))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], s["e"]).alias("at"), out.alias("out"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        rest = lambda acc: F.concat(F.array_join(acc["out"], ""),
                                    F.substring(text, acc["at"] + 1, F.length(text)))
        return F.aggregate(by_start, zero, step, rest)

    text = F.col("text")
    new = let(spans(text, min_score), lambda found: F.when(F.size(found) == 0, text).otherwise(rewrite(text, found)))
    out = docs.withColumn("text", F.when(text.isNull(), text).otherwise(new))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
