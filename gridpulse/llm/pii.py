"""Personal data in whole texts: candidate spans, judged by boosted trees; column expressions only.

Base patterns with their checks find what is certain. More generous patterns, on the text
with the certain spans blanked, propose what may be personal data in another form. Trees
learn from all texts what format and surroundings certain spans have and what proposed ones
have; a calibrated threshold for each kind says which proposed spans are added.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.boosting import Cell, Model, learned, threshold
from gridpulse.llm.common import col, fresh

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive where nothing can be given back, and an address or a number is not
#: tried from its middle (an address is, right behind another), so each text is gone through once.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_AT = r"(?: ?[(\[{<] ?(?:at|AT|@) ?[)\]}>] ?|@| at (?=[A-Za-z0-9-]{1,63} dot ))"
_DOT = r"(?:\.| ?[(\[{<] ?(?:dot|DOT|\.) ?[)\]}>] ?| dot )"
#: Generous patterns: addresses that are spelled out, bracketed dots, cards and numbers of other lengths and groupings.
PROPOSED = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,4}+(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\.)[0-9]{1,4}+){3}(?!\.?[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[ .-]?+[0-9]{4}){2}[ .-]?+[0-9]{1,7}|[0-9]{4}[ .-]?+[0-9]{6}[ .-]?+[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
}
#: What a text must hold for a pattern to be tried.
_NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
_MAY_BE_SPELLED = r"@|[(\[{<] ?(?:at|AT) ?[)\]}>]| dot "
#: Words that announce a kind, in four languages.
CUES = {
    "email": "mail|contact|kontakt|correo|courriel",
    "ip": r"\bip\b|host|address|adresse|server|direcci",
    "card": "card|visa|master|amex|credit|karte|tarjeta|carte",
    "phone": "tel|phone|call|fax|mobil|handy|móvil|tél|anruf|llam|appel",
}
BEFORE, AFTER = 32, 8
#: Share of texts, by hash, that calibrate; share of certain spans from which proposed ones are added, and on how many.
CALIBRATES, SURE, LEAST = 5, 0.9, 20
_BLANK = "\0"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """Sums up to every place of an array, sixteen by sixteen, so that its length matters once."""

    def with_stride(stride: int) -> Callable[[Column], Column]:
        def summed(x: Column) -> Column:
            def at(v: Column, i: Column) -> Column:
                back = F.sequence(F.lit(0), F.least(F.lit(15), F.floor(i / stride).cast("int")))
                return F.aggregate(back, F.lit(0).cast("long"), lambda total, j: total + F.get(x, (i - j * stride).cast("int")))

            return F.when(F.size(x) > stride, F.transform(x, at)).otherwise(x)

        return summed

    out = lengths
    for k in range(8):
        out = _let(out, with_stride(16**k))
    return out


def _cut(text: Column, pattern: str, needs: str) -> tuple[Column, Column]:
    """What lies between the matches of a pattern (one more than matches), and the matches."""
    found = F.rlike(text, F.lit(needs)) if needs != "@" else F.contains(text, F.lit("@"))
    between = F.when(found, F.split(text, pattern, -1)).otherwise(F.array(text))
    return between, F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _spans(between: Column, values: Column) -> Column:
    """(start, stop, value, before, after) of every match, in code points."""
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(values)), values, lambda g, v: (F.length(g) + F.length(v)).cast("long"))
    return _let(_running(steps), lambda ends: F.transform(values, lambda v, i: F.struct(
        (F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("stop"), v.alias("value"),
        F.substring(F.get(between, i), -BEFORE, BEFORE).alias("before"),
        F.substring(F.get(between, i + 1), 1, AFTER).alias("after"),
    )))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of up to 19 digits is right."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        doubled = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.length(digits).between(1, 19) & (F.when(F.length(digits).between(1, 19), total % 10) == 0)


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_CERTAIN: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.rlike(v, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    "card": lambda v: _let(_digits(v), lambda d: F.length(d).between(16, 19) & F.coalesce(_luhn(d), F.lit(False))),
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
}


def _code(*cases: Column) -> Column:
    """The place of the first case that holds, or the number of cases."""
    out = F.when(cases[0], 0)
    for i, case in enumerate(cases[1:], 1):
        out = out.when(case, i)
    return out.otherwise(len(cases))


def features(kind: str, span: Column) -> list[Column]:
    """What the trees see of a span: small numbers, so that all patterns together are a bounded table.

    Whether a form is the base form (an @, a leading plus, plain dots, 16 digits or more) is not among them.
    """
    value, before, after = span["value"], span["before"], span["after"]
    digits, has = _digits(value), lambda pattern: F.rlike(value, F.lit(pattern))
    shared = [
        F.rlike(F.lower(before), F.lit(CUES[kind])).cast("int"),
        _code(F.rlike(before, F.lit(r"(?:^|\s)$")), F.rlike(before, F.lit(r"[(\[<{\"'=:;,/]$"))),
        _code(F.rlike(after, F.lit(r"^(?:$|\s)")), F.rlike(after, F.lit(r"^[.,;:!?)\]>}\"']"))),
    ]
    many = F.length(digits)
    amount = _code(many < 8, many < 10, many == 10, many < 13, many < 16, many == 16)
    runs = F.least(F.lit(6), F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))))
    own = {
        "email": [
            F.least(F.lit(4), F.size(F.regexp_extract_all(value, F.lit(_DOT), F.lit(0)))),
            _code(has(r"(?:com|org|net|edu|gov|info|io|de|fr|es|eu|uk)$"), has(r"[^A-Za-z][a-z]{2,6}$"), has(r"[A-Za-z]$")),
            has(rf"^{_LOCAL}*[0-9]").cast("int"), has(rf"^{_LOCAL}*[._]").cast("int"),
        ],
        "ip": [
            F.rlike(F.regexp_replace(value, r"[^0-9]+", "."), F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$")).cast("int"),
            has(r"(?:^|[^0-9])0[0-9]").cast("int"), has(r"^(?:10|127|192|172|0)[^0-9]").cast("int"),
        ],
        "card": [
            (runs > 1).cast("int"), F.coalesce(_luhn(digits), F.lit(False)).cast("int"),
            F.rlike(digits, F.lit("^(?:4|5[1-5]|2[2-7]|3[47]|6)")).cast("int"),
        ],
        "phone": [
            amount, runs, _code(has(r"\("), has("-"), has(r"\."), has(" ")), _code(F.startswith(digits, F.lit("0")), F.startswith(digits, F.lit("1"))),
        ],
    }
    return shared + own[kind]


def _prepared(docs: DataFrame, text_col: str, names: dict[str, str]) -> DataFrame:
    """`docs` with (between, values) of the base patterns and of the proposing ones, under `names`."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn(names["text"], text)
    blanked = names["text"]
    for kind in KINDS:
        between, values = _cut(F.col(names["text"]), BASE[kind], _NEEDS[kind])
        rows = rows.withColumn(names[f"{kind}-between"], between).withColumn(names[f"{kind}-values"], values)
    for kind in KINDS:
        # Blank the certain spans one kind after the other; what is blank already is no match.
        between, values = _cut(F.col(blanked), BASE[kind], _NEEDS[kind])
        rows = rows.withColumn(names["cut"], F.struct(between.alias("g"), values.alias("v")))
        test = _CERTAIN[kind]
        parts = F.zip_with(F.col(names["cut"])["g"], F.col(names["cut"])["v"], lambda g, v: F.concat(
            g, F.when(v.isNull(), "").when(test(v), F.repeat(F.lit(_BLANK), F.length(v))).otherwise(v)
        ))
        rows = rows.withColumn(names["blanked"], F.array_join(parts, ""))
        blanked = names["blanked"]
    for kind in KINDS:
        needs = _MAY_BE_SPELLED if kind == "email" else _NEEDS[kind]
        between, values = _cut(F.col(blanked), PROPOSED[kind], needs)
        rows = rows.withColumn(names[f"{kind}-gaps"], between).withColumn(names[f"{kind}-proposed"], values)
    return rows


def _names(docs: DataFrame) -> dict[str, str]:
    wanted = ["text", "cut", "blanked", *(f"{k}-{part}" for k in KINDS for part in ("between", "values", "gaps", "proposed"))]
    return dict(zip(wanted, fresh(docs, *(w.replace("-", "_") for w in wanted))))


def _certain(kind: str, names: dict[str, str]) -> Column:
    found = _spans(F.col(names[f"{kind}-between"]), F.col(names[f"{kind}-values"]))
    return F.filter(found, lambda span: _CERTAIN[kind](span["value"]))


def _proposed(kind: str, names: dict[str, str]) -> Column:
    return _spans(F.col(names[f"{kind}-gaps"]), F.col(names[f"{kind}-proposed"]))


def judges(docs: DataFrame, text_col: str = "text") -> dict[str, tuple[Model, float]]:
    """Trees and threshold of every kind, from the spans of all texts; a kind without enough of them gets no trees.

    The driver takes the counts of feature patterns, of which there are some ten thousands
    at most whatever the number of rows.
    """
    names = _names(docs)
    rows = _prepared(docs, text_col, names)
    held = F.pmod(F.xxhash64(F.col(names["text"])), F.lit(CALIBRATES)) == 0

    def seen(kind: str, spans: Column, certain: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(
            F.lit(kind).alias("kind"), F.lit(certain).alias("certain"), F.array(*features(kind, s)).alias("features")
        ))

    spans = F.concat(*[seen(k, _certain(k, names), True) for k in KINDS], *[seen(k, _proposed(k, names), False) for k in KINDS])
    counts = rows.select(held.alias("held"), F.inline(spans)).groupBy("kind", "held", "features").agg(
        F.count_if("certain").alias("positive"), F.count_if(~F.col("certain")).alias("negative")
    ).collect()
    out = {}
    for kind in KINDS:
        cells = [(r.held, Cell(tuple(r.features), r.positive, r.negative)) for r in counts if r.kind == kind]
        model = learned([c for held_out, c in cells if not held_out])
        limit = threshold(model, [c for held_out, c in cells if held_out], SURE, LEAST)
        if limit < math.inf:
            out[kind] = (model, limit)
    return out


def found(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str], dict[str, str]]:
    """`docs` with two arrays of (start, stop, value) per kind: the base spans, and all of them; and the names of these.

    Starts and stops are in code points, stops exclusive; spans of a kind are in order of
    start and those of different kinds may overlap. Every row is judged on its own whole
    text, so repeated rows have equal spans; an empty or null text has none; no rows give
    none. Added columns take names that `docs` does not have.
    """
    chosen = judges(docs, text_col)
    names = _names(docs)
    rows = _prepared(docs, text_col, names)
    made = fresh(docs, *(f"{k}_{part}" for part in ("base", "spans") for k in KINDS))
    base, every = dict(zip(KINDS, made)), dict(zip(KINDS, made[len(KINDS) :]))

    def plain(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value")))

    for kind in KINDS:
        rows = rows.withColumn(base[kind], plain(_certain(kind, names)))
    for kind in KINDS:
        added = F.col(base[kind])
        if kind in chosen:
            model, limit = chosen[kind]
            more = F.filter(_proposed(kind, names), lambda s: _let(
                F.array(*features(kind, s)),
                lambda f: model.column([F.get(f, F.lit(i)) for i in range(len(features(kind, s)))]) >= limit,
            ))
            added = F.sort_array(F.concat(added, plain(more)))
        rows = rows.withColumn(every[kind], added)
    return rows.select(*[col(c) for c in docs.columns], *made), base, every


def listed(spans: dict[str, str]) -> Column:
    """kind:start:stop of all spans, by kind and start, with commas between them."""

    def named(kind: str) -> Callable[[Column], Column]:
        return lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string"))

    return F.array_join(F.concat(*[F.transform(F.col(name), named(kind)) for kind, name in spans.items()]), ",")
