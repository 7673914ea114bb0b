"""Operator 5: personal data by weak supervision, with DataFrame functions only.

Base spans follow four fixed patterns and checks; they always stay. Candidates are the base spans
and what wider patterns match beside them. Regex, gazetteer and context labelers vote on each
candidate (1, -1, or 0 to abstain). The votes of all documents are counted by pattern of votes;
expectation-maximisation estimates from these counts how reliable each labeler is, and with that
how likely each pattern is personal data. On these likelihoods a logistic span classifier is
trained, whose features are the votes and the span's form; a candidate of ``SURE`` or more, in the
form its kind must have and not overlapping a base span, is added.

Only counts of vote and feature patterns reach the driver, whose number does not grow with the
data. Null texts count as empty. Offsets are code points, the end exclusive. A text's matches are
followed one after another, so a text of any length is one row and no row depends on another.

The patterns are written so that no match needs backtracking over a long run: a run is entered at
its start or where the last match ended, which finds the same leftmost matches.

Repeated rows are judged each; an empty table gives an empty result. ``mask`` keeps the table's columns,
but for those named ``__candidates`` and ``__spans``, which it uses.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table, to_driver, written

KINDS = ("email", "ip", "card", "phone")
SURE = 0.9
#: Code points before a span that context labelers see.
CONTEXT = 32
#: Patterns of votes and features: kinds x 3^5 votes x digits x lengths.
PATTERNS = 4 * 3**5 * 21 * 11

BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A whole run of digits and single separators, if its length can be a card's.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a kind may look like beside its base pattern.
WIDER = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)) ?"
    r"[A-Za-z0-9-]{1,63}+(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}+){1,4}+",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})"
    r"(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}"
    r"[ .-][0-9]{4}(?![0-9])",
}
# Top-level domains, calling codes, issuers' first digits.
DOMAINS = (
    "com org net edu gov mil int info biz io dev app co ai me eu de fr es uk us ca it nl be ch at "
    "pl se no dk fi pt ie cz gr hu ro ru ua jp cn in br mx ar au nz za kr"
).split()
CALLING = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 "
    "64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 218 234 254 351 352 353 354 358 359 370 "
    "371 372 380 381 385 386 420 421 852 880 886 961 962 965 966 971 972 974"
).split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6011|64|65|62)"
CUES = {
    "email": r"e-?mail|contact|write to|courriel|correo|adresse",
    "ip": r"\bip\b|host|server|address|login|client|adresse",
    "card": r"card|visa|credit|karte|carte|tarjeta|payment|iban",
    "phone": r"phone|\btel|call|fax|mobile|handy|tél|teléfono|whatsapp",
}
COUNTER_CUES = r"version|release|section|isbn|issn|order|invoice|serial|build|chapter|\bv\."


# ---------------------------------------------------------------- spans


def _spans(text: Column, pattern: str) -> Column:
    """``start, end, value`` of all matches, from what lies between them."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(state: Column, k: Column) -> Column:
        value = F.get(matches, k)
        start = state["at"] + F.length(F.get(between, k))
        end = start + F.length(value)
        span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    walked = F.aggregate(
        F.sequence(F.lit(0), F.size(matches) - 1),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        step,
        lambda state: state["out"],
    )
    return F.when(F.size(matches) > 0, walked).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """For a text of digits, 19 at most."""
    back = F.reverse(digits)

    def weighed(k: Column) -> Column:
        digit = F.substring(back, k, F.lit(1)).cast("int")
        twice = 2 * digit
        return F.when(k % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(places, F.lit(0), lambda s, k: s + weighed(k))
    return (F.length(digits) > 0) & (total % 10 == 0)


def _passes(kind: str, value: Column) -> Column:
    """The base check of a kind."""
    digits = _digits(value)
    n = F.length(digits)
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _votes(kind: str, text: Column, span: Column) -> list[Column]:
    """Regex, gazetteer, context for, context against, and what touches the span."""
    value, digits = span["value"], _digits(span["value"])
    yes, no, abstain = F.lit(1), F.lit(-1), F.lit(0)
    if kind == "email":
        form = value.rlike(r"^[A-Za-z0-9][^@]*[@\[(].*[A-Za-z]{2,}$")
        listed = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1)).isin(DOMAINS)
    elif kind == "ip":
        form = _passes(kind, value)
        # Version numbers are small; 0 and 255 in front are no hosts.
        listed = ~value.rlike(r"^(?:0+|255)\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$")
    elif kind == "card":
        form = _passes(kind, value)
        listed = digits.rlike(ISSUERS)
    else:
        form = F.length(digits).between(9, 15)
        listed = value.rlike(rf"^\+(?:{'|'.join(CALLING)})") | value.rlike(r"^\([0-9]{3}\)")
    begin = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, begin + 1, span["start"] - begin))
    around = F.concat(
        F.substring(text, F.greatest(span["start"], F.lit(1)), F.least(span["start"], F.lit(1))),
        F.substring(text, span["end"] + 1, F.lit(1)),
    )
    return [
        F.when(form, yes).otherwise(no),
        F.when(listed, yes).otherwise(no),
        F.when(before.rlike(CUES[kind]), yes).otherwise(abstain),
        F.when(before.rlike(COUNTER_CUES), no).otherwise(abstain),
        F.when(around.rlike(r"[\p{L}\p{N}_]"), no).otherwise(yes),
    ]


VOTES = ("form", "listed", "cue", "counter", "edge")


def _described(k: int, text: Column, span: Column, base: Column) -> Column:
    kind = KINDS[k]
    size = F.least(F.floor((span["end"] - span["start"]) / 4), F.lit(10)).cast("int")
    return F.struct(
        F.lit(k).alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        base.alias("base"),
        *(v.alias(n) for n, v in zip(VOTES, _votes(kind, text, span), strict=True)),
        F.least(F.length(_digits(span["value"])), F.lit(20)).alias("digits"),
        size.alias("size"),
    )


def with_candidates(df: DataFrame, text: str = "text", into: str = "candidates") -> DataFrame:
    """Adds an array of described spans, base spans and others; all columns stay."""
    whole = F.coalesce(F.col(text), F.lit(""))
    own = [f"__{into}_{kind}" for kind in KINDS]
    wide = [f"__{into}_wide_{kind}" for kind in KINDS]
    # A look for what each pattern needs spares most texts the patterns.
    needs = {
        "email": whole.contains("@"),
        "ip": whole.rlike(r"[0-9]\.[0-9]"),
        "card": whole.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
        "phone": whole.contains("+"),
    }
    wider_needs = {
        "email": whole.contains("at]") | whole.contains("at)"),
        "card": needs["card"],
        "phone": whole.rlike(r"[0-9][ .-][0-9]{4}"),
    }
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    found = df.select(
        "*",
        *(
            F.when(needs[k], _spans(whole, BASE[k])).otherwise(none).alias(c)
            for k, c in zip(KINDS, own, strict=True)
        ),
        *(
            F.when(wider_needs[k], _spans(whole, WIDER[k])).otherwise(none).alias(c)
            for k, c in zip(KINDS, wide, strict=True)
            if k in WIDER
        ),
    )
    valid = [F.filter(F.col(c), _check(kind)) for kind, c in zip(KINDS, own, strict=True)]
    found = found.select(
        *(c for c in found.columns if c not in own),
        *(v.alias(c) for v, c in zip(valid, own, strict=True)),
    )
    parts = [F.transform(F.col(c), _describe(k, whole, True)) for k, c in enumerate(own)]
    for k, c in enumerate(wide):
        if KINDS[k] in WIDER:
            free = F.filter(F.col(c), _apart(own))
            parts.append(F.transform(free, _describe(k, whole, False)))
    return found.withColumn(into, F.concat(*parts)).drop(*own, *wide)


def _check(kind: str):
    return lambda span: _passes(kind, span["value"])


def _describe(k: int, text: Column, base: bool):
    return lambda span: _described(k, text, span, F.lit(base))


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _apart(columns: list[str]):
    def test(span: Column) -> Column:
        clear = F.lit(True)
        for c in columns:
            clear = clear & ~F.exists(F.col(c), lambda other: _overlap(span, other))
        return clear

    return test


# ---------------------------------------------------------------- reliabilities and classifier


@dataclass
class Model:
    """Weights of the span classifier, by feature and value; and the labelers' reliabilities."""

    bias: float = 0.0
    weights: dict[tuple[str, int], float] = field(default_factory=dict)
    reliability: dict[tuple[str, str], float] = field(default_factory=dict)


def _posteriors(rows: list[tuple[tuple[int, ...], int]], rounds: int = 60):
    """Likelihood of each vote pattern, and each labeler's share of right votes."""
    likely = [1 / (1 + math.exp(-sum(votes))) for votes, _ in rows]
    table_: list = []
    for _ in range(rounds):
        total = [1.0, 1.0]
        table_ = [{(v, y): 1.0 for v in (-1, 0, 1) for y in (0, 1)} for _ in VOTES]
        for (votes, n), p in zip(rows, likely, strict=True):
            total[1] += n * p
            total[0] += n * (1 - p)
            for own, v in zip(table_, votes, strict=True):
                own[v, 1] += n * p
                own[v, 0] += n * (1 - p)
        sums = [{y: sum(own[v, y] for v in (-1, 0, 1)) for y in (0, 1)} for own in table_]
        likely = []
        for votes, _ in rows:
            odds = math.log(total[1] / total[0])
            for own, size, v in zip(table_, sums, votes, strict=True):
                odds += math.log(own[v, 1] / size[1]) - math.log(own[v, 0] / size[0])
            likely.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    right = []
    for own in table_:
        cast = sum(own[v, y] for v in (-1, 1) for y in (0, 1))
        right.append((own[1, 1] + own[-1, 0]) / cast)
    return likely, right


def train(counts: list) -> Model:
    """From rows of votes and features with their number ``n``."""
    model = Model()
    examples = []
    for k, kind in enumerate(KINDS):
        votes: dict[tuple[int, ...], int] = defaultdict(int)
        own = [row for row in counts if row["kind"] == k]
        for row in own:
            votes[tuple(row[v] for v in VOTES)] += row["n"]
        if not votes:
            continue
        likely, right = _posteriors(list(votes.items()))
        by_votes = dict(zip(votes, likely, strict=True))
        model.reliability.update({(kind, v): r for v, r in zip(VOTES, right, strict=True)})
        for row in own:
            active = [(f"{kind} {f}", row[f]) for f in (*VOTES, "digits", "size")]
            examples.append((active, row["n"], by_votes[tuple(row[v] for v in VOTES)]))
    total = sum(n for _, n, _ in examples) or 1
    # Logistic regression on the likelihoods, each step scaled by the gradients so far.
    weights: dict[tuple[str, int], float] = defaultdict(float)
    seen: dict[tuple[str, int], float] = defaultdict(lambda: 1e-8)
    for _ in range(200):
        gradient: dict[tuple[str, int], float] = defaultdict(float)
        for active, n, p in examples:
            score = sum(weights[f] for f in active)
            error = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, score)))) - p)
            for f in active:
                gradient[f] += error
        for f, g in gradient.items():
            g += 1e-6 * weights[f]
            seen[f] += g * g
            weights[f] -= 0.5 * g / math.sqrt(seen[f])
    model.weights = dict(weights)
    return model


def fit(candidates: DataFrame, column: str = "candidates") -> Model:
    """Counts the patterns of all rows' candidates and trains on them."""
    names = ["kind", *VOTES, "digits", "size"]
    each = candidates.select(F.explode(column).alias("c")).select(*(f"c.{n}" for n in names))
    counted = each.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    rows = to_driver(counted, PATTERNS)
    return train(sorted(rows, key=lambda r: tuple(r[n] for n in names)))


def _probability(model: Model, span: Column) -> Column:
    score = F.lit(model.bias)
    for k, kind in enumerate(KINDS):
        for f in (*VOTES, "digits", "size"):
            values = {v: w for (name, v), w in model.weights.items() if name == f"{kind} {f}"}
            if not values:
                continue
            weight = F.lit(0.0)
            for v, w in sorted(values.items()):
                weight = F.when(span[f] == v, F.lit(w)).otherwise(weight)
            score = score + F.when(span["kind"] == k, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-score))


def decide(model: Model, column: str = "candidates", sure: float = SURE) -> Column:
    """Base spans and what the classifier adds, by kind and start: ``kind, start, end, base``."""
    found = F.filter(
        F.col(column),
        lambda s: s["base"] | ((s["form"] == 1) & (_probability(model, s) >= sure)),
    )
    short = F.transform(
        found,
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["base"].alias("base"),
        ),
    )
    # Of added spans that overlap, the one that starts first stays; the kind decides ties.
    def first(s: Column) -> Column:
        return ~F.exists(
            short,
            lambda o: ~o["base"]
            & _overlap(s, o)
            & ((o["start"] < s["start"]) | ((o["start"] == s["start"]) & (o["kind"] < s["kind"]))),
        )

    return F.array_sort(F.filter(short, lambda s: s["base"] | first(s)))


def written_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    one = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    )
    return F.array_join(one, ",")


def mask(df: DataFrame, model: Model, text: str = "text", sure: float = SURE) -> DataFrame:
    """Replaces each span by its kind in brackets; overlapping spans by that of the first."""
    candidates, spans = "__candidates", "__spans"
    columns = df.columns
    marked = with_candidates(df, text, candidates).withColumn(
        spans, decide(model, candidates, sure)
    )
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    by_place = F.array_sort(
        F.transform(
            F.col(spans),
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
            ),
        )
    )

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(F.col(text), state["at"] + 1, s["start"] - state["at"])
        grown = F.concat(state["out"], gap, F.get(names, s["kind"]))
        inside = s["start"] < state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(grown).alias("out"),
        )

    masked = F.aggregate(
        by_place,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda s: F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, F.length(text))),
    )
    new = F.when(F.size(spans) > 0, masked).otherwise(F.col(text))
    return marked.select(*(new.alias(c) if c == text else F.col(c) for c in columns))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Without the texts; kept, as training and deciding both need them.
    found = written(with_candidates(docs.select("doc_id", "text")).select("doc_id", "candidates"))
    spans = found.select("doc_id", decide(fit(found)).alias("spans"))
    base = F.filter("spans", lambda s: s["base"])
    return spans.select(
        "doc_id",
        *(_number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sha2(written_spans(base), 256).alias("base_sha256"),
        written_spans(F.col("spans")).alias("spans"),
    )


def _number(k: int) -> Column:
    """Base spans of a kind."""
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
