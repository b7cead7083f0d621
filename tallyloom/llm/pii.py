"""Personal data in texts: candidates, boosted trees, calibrated redactions. Column functions only.

Generators propose spans: the four base patterns before any check, and wider ones for spaced,
bracketed or otherwise unusual forms. They may overlap. The base matches that pass their check are
always redacted; every other proposal is judged by boosted trees over features of its format and
of the text around it.

The trees are fitted without hand-made labels: a proposal that passes the base check of its kind is a
positive, one that fails a negative, and the features leave the checks out. So a proposal is
redacted if numbers of its form, in such surroundings, are nearly always valid: a card number with one
wrong digit is, a run of digits within a hexadecimal token is not. The form is that of the usual writing:
a spelt-out address is read as a plain one. Proposals that overlap a base span are redacted with
it and are no negatives, and a span that two generators of a kind propose counts once.

All features are bits. What the trees need from the corpus is one count per kind and bit pattern, so
every proposal of every text is in the fit and at most ``4 * 2 ** FEATURES`` counts reach the
driver. There the trees grow on one half of the texts (by hash), and isotonic regression on the other
half turns scores into probabilities; the redacted patterns go back as a literal of the same bound.

Matches are found as Java expressions with possessive quantifiers and guards at the start of a run,
which match the same spans as the plain ones without backtracking. Positions count code points.

Defined cases: a null text is an empty one without spans; repeated rows are judged alike; an empty
table gives an empty result; only the columns asked for are read, and own columns carry a prefix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import as_table

OWN = "_pii_"

# Kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

# Wider generators: a spelt-out or spaced address, a number in groups of any separators.
WIDE_EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(](?:at|AT)[\])] ?| @ ?|@)"
              r"[A-Za-z0-9-]++(?:(?: ?[\[(](?:dot|DOT)[\])] ?|\.)[A-Za-z0-9-]++)*+")
WIDE_PHONE = r"(?<![0-9A-Za-z+.,-])\(?[0-9]{2,4}\)?(?:[ ./-][(]?[0-9]{2,5}[)]?){1,4}+(?![0-9A-Za-z])"
WIDE_CARD = r"(?<![0-9A-Za-z])[0-9]{3,6}+(?:[ ./_-]{1,3}+[0-9]{3,6}+){2,4}+(?![0-9A-Za-z])"

CUES = {
    "email": "(?i)(mail|contact|write|reach|address)",
    "ip": r"(?i)(\bip\b|host|server|addr|node|login)",
    "card": "(?i)(card|visa|master|amex|credit|debit|pay|account)",
    "phone": r"(?i)(call|tel|phone|fax|mobile|cell|whatsapp|sms)",
}
CONTEXT = 32  # code points before a span that cues are looked for in


def _spans(text: Column, pattern: str) -> Column:
    """All matches with start, end, what they match and what stands around, by code points.

    Texts without a match are scanned once. The others are split as well: the lengths of the parts
    between matches give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    following = F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1)))
    none = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")

    def add(state: Column, piece: Column) -> Column:
        start = state["at"] + F.char_length(piece["part"])
        end = start + F.char_length(piece["match"])
        span = F.struct(start.alias("start"), end.alias("end"), piece["match"].alias("match"),
                        F.right(piece["part"], F.lit(CONTEXT)).alias("before"),
                        F.left(piece["next"], F.lit(1)).alias("after"))
        return F.when(piece["match"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")))

    pieces = F.arrays_zip(parts.alias("part"), found.alias("match"), following.alias("next"))
    walked = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("spans")), add)
    return F.when(F.size(found) > 0, walked["spans"]).otherwise(none)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: from the right, every second digit counts double."""
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """The base check of a match of the base pattern of its kind."""
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = _digits(match)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _plain(kind: str, match: Column) -> Column:
    """A match in the usual writing of its kind: at and dot as signs, groups apart by one separator."""
    if kind == "email":
        at = F.regexp_replace(match, r" ?[\[(](?:at|AT)[\])] ?| @ ?", "@")
        return F.regexp_replace(at, r" ?[\[(](?:dot|DOT)[\])] ?", ".")
    if kind == "card":
        return F.regexp_replace(match, "[ ./_-]{2,3}|[./_]", " ")
    return match


def _bits(kind: str, s: Column) -> list[Column]:
    """Features of a span: its form, then what stands around it. None repeats a base check."""
    match, before, after = _plain(kind, s["match"]), s["before"], s["after"]
    digits = _digits(match)
    if kind == "phone":  # valid by the number of digits, so groups take its place
        first = [match.rlike("(?<![0-9])[0-9]{3,4}[ .-]?[0-9]{4}$"),
                 match.rlike(r"^[0-9]{1,4}([./-])[0-9]{1,2}\1[0-9]{1,4}$"),
                 match.contains("/")]
    else:
        first = [F.length(digits) >= 12, F.length(digits).between(9, 15), F.length(digits) < 9]
    return [
        *first,
        match.rlike(r"[()\[\]]"),
        match.rlike("[0-9][ -][0-9]"),
        match.rlike("^[0-9]{4}(?:[ -]?[0-9]{4}){2,3}$"),
        match.rlike(r"\.[A-Za-z]{2,}$"),
        match.rlike(r"[.][0-9]+[.]"),
        before.rlike(r"(?:^|\s)$"),
        before.rlike("[A-Za-z0-9=\"'_/:#]$"),
        after.rlike("^[A-Za-z0-9_=/\"']"),
        before.rlike(CUES[kind]),
    ]


FEATURES = 12


def _judged(kind: str, rank: int, spans: Column, valid: Column | None) -> Column:
    """Proposals as structs (start, rank of the kind, end, base, bits)."""
    def proposal(s: Column) -> Column:
        code = sum((F.when(bit, 1 << i).otherwise(0) for i, bit in enumerate(_bits(kind, s))), F.lit(0))
        base = F.lit(False) if valid is None else _valid(kind, s["match"])
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("kind"), s["end"].alias("end"),
                        base.alias("base"), code.alias("bits"))
    return F.transform(spans, proposal)


_PROPOSALS = "array<struct<start:int,kind:int,end:int,base:boolean,bits:int>>"


def _unlike(spans: Column, usual: Column) -> Column:
    """The spans that are none of the usual ones."""
    return F.filter(spans, lambda s: ~F.exists(usual, lambda u: (u["start"] == s["start"]) & (u["end"] == s["end"])))


def propose(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the text, the base spans and the other proposals of every row.

    Left out are proposals that overlap a base span of their text, and those of a wider generator that
    the base pattern of the kind has found already.
    """
    text = F.coalesce(F.col(OWN + "text"), F.lit(""))
    rows = docs.select(*keep, docs["text"].alias(OWN + "text"))
    generators = [("email", EMAIL, True), ("ip", IP, True), ("card", CARD, True), ("phone", PHONE, True),
                  ("email", WIDE_EMAIL, False), ("phone", WIDE_PHONE, False), ("card", WIDE_CARD, False)]
    found = rows.select("*", *[_spans(text, pattern).alias(f"{OWN}spans{i}")
                               for i, (_, pattern, _) in enumerate(generators)])
    judged = []
    for i, (kind, _, base) in enumerate(generators):
        spans, usual = F.col(f"{OWN}spans{i}"), F.col(f"{OWN}spans{KINDS.index(kind)}")
        if not base:
            spans = _unlike(spans, usual)
        judged.append(_judged(kind, KINDS.index(kind), spans, F.lit(True) if base else None))
    everything = F.col(OWN + "all")
    apart = found.select(*keep, OWN + "text", F.concat(*judged).cast(_PROPOSALS).alias(OWN + "all")).withColumn(
        OWN + "base", F.array_sort(F.filter(everything, lambda p: p["base"])))
    others = F.filter(everything, lambda p: ~p["base"] & ~F.exists(
        F.col(OWN + "base"), lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"])))
    return apart.select(*keep, OWN + "text", OWN + "base", others.alias(OWN + "others"))


@dataclass(frozen=True)
class Tree:
    """Two levels of questions about one bit each; a value per leaf."""

    first: int
    second: tuple[int, int]
    values: tuple[float, float, float, float]

    def value(self, bits: int) -> float:
        side = bits >> self.first & 1
        return self.values[2 * side + (bits >> self.second[side] & 1)]


def _leaf(rows, prior: float) -> float:
    """Newton step of the log loss, shrunk; rows hold (bits, weight, positives, probability)."""
    gradient = sum(good - n * p for _, n, good, p in rows)
    curvature = sum(n * p * (1 - p) for _, n, good, p in rows)
    return gradient / (curvature + prior)


def _gain(rows, prior: float) -> float:
    gradient = sum(good - n * p for _, n, good, p in rows)
    return gradient * gradient / (sum(n * p * (1 - p) for _, n, good, p in rows) + prior)


def _best_bit(rows, prior: float) -> int:
    def worth(i: int) -> float:
        return sum(_gain([r for r in rows if (r[0] >> i & 1) == side], prior) for side in (0, 1))
    return max(range(FEATURES), key=worth)


def boost(counts: list[tuple[int, int, int]], rounds: int = 30, rate: float = 0.3, prior: float = 1.0):
    """(start value, trees) from (bits, proposals, positives)."""
    total, good = sum(n for _, n, _ in counts), sum(g for _, _, g in counts)
    start = math.log((good + 0.5) / (total - good + 0.5))
    scores, trees = [start] * len(counts), []
    for _ in range(rounds if total else 0):
        rows = [(b, n, g, 1 / (1 + math.exp(-s))) for (b, n, g), s in zip(counts, scores)]
        first = _best_bit(rows, prior)
        halves = [[r for r in rows if (r[0] >> first & 1) == side] for side in (0, 1)]
        second = tuple(_best_bit(half, prior) for half in halves)
        values = tuple(rate * _leaf([r for r in halves[a] if (r[0] >> second[a] & 1) == b], prior)
                       for a in (0, 1) for b in (0, 1))
        trees.append(Tree(first, second, values))
        scores = [max(min(s + trees[-1].value(b), 30.0), -30.0) for (b, _, _), s in zip(counts, scores)]
    return start, trees


def isotonic(points: list[tuple[float, int, int]]) -> list[tuple[float, float]]:
    """(least score, probability) of pooled blocks, rising, from (score, proposals, positives)."""
    blocks: list[list[float]] = []
    for score, n, good in sorted(points):
        blocks.append([score, n, good])
        while len(blocks) > 1 and (blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]):
            _, n2, good2 = blocks.pop()
            blocks[-1][1] += n2
            blocks[-1][2] += good2
    # One imagined negative: a block of few proposals is not certain.
    return [(score, good / (n + 1)) for score, n, good in blocks]


def redacted_patterns(counts: list[tuple[int, int, int, int, int]], least: float) -> list[int]:
    """Codes (kind and bits) whose calibrated probability reaches ``least``.

    ``counts`` holds (kind, fold, bits, proposals, positives).
    """
    accepted = []
    for kind in range(len(KINDS)):
        own = [c for c in counts if c[0] == kind]
        start, trees = boost([c[2:] for c in own if c[1] == 0])

        def score(bits: int) -> float:
            return start + sum(t.value(bits) for t in trees)

        blocks = isotonic([(score(b), n, g) for _, fold, b, n, g in own if fold == 1])
        cut = min((s for s, p in blocks if p >= least), default=math.inf)
        accepted += sorted({(kind << FEATURES) + c[2] for c in own if score(c[2]) >= cut})
    return accepted


def _code(p: Column) -> Column:
    return F.shiftleft(p["kind"], FEATURES) + p["bits"]


def select_spans(proposed: DataFrame, least: float) -> DataFrame:
    """Adds all spans to redact, sorted by start and kind.

    ``proposed`` must be a table, as it is read once for the counts and once for the result.
    """
    base, others = F.col(OWN + "base"), F.col(OWN + "others")
    fold = F.pmod(F.xxhash64(OWN + "text"), F.lit(2)).cast("int")
    counted = (proposed.where((F.size(base) > 0) | (F.size(others) > 0))
               .select(fold.alias("fold"), F.explode(F.concat(base, others)).alias("p"))
               .groupBy("p.kind", "fold", "p.bits")
               .agg(F.count("*").alias("n"), F.sum(F.col("p.base").cast("int")).alias("good")))
    codes = redacted_patterns([tuple(r) for r in counted.collect()], least)
    accepted = F.array(*[F.lit(c) for c in codes]).cast("array<int>")
    # An added span overlaps no base span, and no added one before it.
    fresh = F.array_sort(F.filter(others, lambda p: F.array_contains(accepted, _code(p))))
    nothing = F.array().cast(_PROPOSALS)

    def apart(state: Column, p: Column) -> Column:
        return F.when(p["start"] < state["at"], state).otherwise(
            F.struct(p["end"].alias("at"), F.concat(state["kept"], F.array(p)).alias("kept")))

    added = F.aggregate(fresh, F.struct(F.lit(0).alias("at"), nothing.alias("kept")), apart)["kept"]
    return proposed.withColumn(OWN + "spans", F.when(F.size(others) == 0, base).otherwise(
        F.array_sort(F.concat(base, added))))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(
        ":", kinds[p["kind"]], p["start"].cast("string"), p["end"].cast("string"))), ",")


def find(docs: DataFrame, keep: list[str], least: float = 0.9) -> DataFrame:
    """``keep``, the text and the spans of every row (OWN base, OWN spans)."""
    return select_spans(as_table(propose(docs, keep), "pii-proposals"), least)


def counts_of(found: DataFrame, keep: list[str]) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    def number(kind: int) -> Column:
        return F.size(F.filter(OWN + "base", lambda p: p["kind"] == kind)).cast("long")
    return found.select(
        *keep, *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(spans_text(F.col(OWN + "base")), 256).alias("base_sha256"),
        spans_text(F.col(OWN + "spans")).alias("spans"),
        (F.size(OWN + "spans") - F.size(OWN + "base")).alias("n_added"))


def redact(docs: DataFrame, least: float = 0.9) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; a null text stays null.

    Where spans overlap, the later one only lengthens what is taken out.
    """
    others = [c for c in docs.columns if c != "text"]
    found = find(docs, others, least)
    text = F.col(OWN + "text")
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def cut(state: Column, p: Column) -> Column:
        plain = F.substring(text, state["at"] + 1, p["start"] - state["at"])
        apart = F.concat(state["out"], F.array(plain, marks[p["kind"]]))
        return F.struct(F.greatest(state["at"], p["end"]).alias("at"),
                        F.when(p["start"] >= state["at"], apart).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    walked = F.aggregate(OWN + "spans", start, cut,
                         lambda s: F.concat(F.array_join(s["out"], ""),
                                            F.substring(text, s["at"] + 1, F.char_length(text))))
    return found.select(*others, F.when(F.size(OWN + "spans") > 0, walked).otherwise(text).alias("text")).select(
        *docs.columns)
