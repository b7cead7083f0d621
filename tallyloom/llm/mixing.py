"""Mixing sources to target weights by iterative proportional fitting. Column functions only.

Documents fall into cells of source, language and topic. The tokens of each cell are summed over all
documents; raking then scales the cells, one dimension after the other, until the tokens expected
from each source, language and topic meet their target shares of the budget. A value that holds fewer
tokens than its share gives all it has, and the others of its dimension divide what it lacks by their
shares, before the first round. No cell gives more than it holds either: where it would, its documents
are all taken. What the marginals together still leave open after the last round is taken from all
cells by the room they have, so the expected tokens are the budget; ``reached`` tells what each
value gets. A document is sampled with the probability of its cell, by a hash of its id.

Target shares name the values of each dimension; without named sources, the MOST_SOURCES largest by tokens
get equal shares. All other values, nulls too, form one rest value, which keeps its natural share; the
named ones divide what is left. So there are at most ``(sources + 1) * (languages + 1) * (topics + 1)``
cells, a bound that is known from the parameters; that many sums reach the driver and that many
probabilities go back by a broadcast join. Sources are counted in Spark, however many there are.

Defined cases: a null text has no tokens and the topic of an empty one; a null id is replaced by the
digest of the text; repeated rows are sampled alike; a value named but absent gets nothing, and its
share goes to the others of its dimension; an empty table gives an empty result. Own columns
carry a prefix, so further columns of the input cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD
from tallyloom.session import as_table

OWN = "_mix_"
REST = "*"
DIMENSIONS = ("source", "lang", "topic")

# Topics by what a text holds; the first that applies. The last two divide by length in words.
TOPIC_MARKS = (("contact", r"@[A-Za-z0-9-]+\."), ("licence", "[Ll]icen[cs]e"), ("table", r" \| "))
LONG_WORDS = 500
MOST_SOURCES = 20  # that get a share of their own where the targets name none


@dataclass(frozen=True)
class Targets:
    shares: dict[str, dict[str, float] | None]  # only "source" may be None: equal shares of the largest
    rate: float = 0.5  # tokens to sample, as a share of all tokens
    rounds: int = 30
    seed: str = "mix-1"


DEFAULT = Targets({
    "source": None,
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    "topic": {"contact": 0.05, "licence": 0.05, "table": 0.02, "long": 0.58, "short": 0.3},
})


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    found = F.when(F.lit(False), F.lit(""))
    for topic, mark in TOPIC_MARKS:
        found = found.when(text.rlike(mark), F.lit(topic))
    return found.when(tokens >= LONG_WORDS, F.lit("long")).otherwise(F.lit("short"))


def _named(column: Column, shares: dict[str, float]) -> Column:
    return F.when(column.isin(*shares), column).otherwise(F.lit(REST))


def goals(cells: dict[tuple[str, ...], int], targets: Targets) -> list[dict[str, tuple[float, float]]]:
    """Per dimension and value: the tokens its share asks for, and those it can be asked for.

    Values are filled up to a common level of tokens per share; those that hold less give all they have.
    """
    total = sum(cells.values())
    budget, found = targets.rate * total, []
    for i, name in enumerate(DIMENSIONS):
        there = defaultdict(int)
        for key, n in cells.items():
            there[key[i]] += n
        rest = there.get(REST, 0) / total if total else 0.0
        named = {v: s for v, s in targets.shares[name].items() if s > 0 and there.get(v)}
        fund, whole = (1 - rest) * budget, sum(named.values())
        level, taken, shared = 0.0, 0, 0.0
        for v in sorted(named, key=lambda v: (there[v] / named[v], v)):
            level = max(level, (fund - taken) / (whole - shared))
            taken, shared = taken + there[v], shared + named[v]
        found.append({REST: (rest * budget, rest * budget), **{
            v: (s / whole * fund, min(float(there[v]), s * level)) for v, s in named.items()}})
    return found


def rake(cells: dict[tuple[str, ...], int], targets: Targets) -> dict[tuple[str, ...], float]:
    """The sampling probability of each cell, from its tokens."""
    asked = [{v: goal for v, (_, goal) in dimension.items()} for dimension in goals(cells, targets)]
    weights = {key: targets.rate * n for key, n in cells.items()}
    for _ in range(targets.rounds):
        for i, goal in enumerate(asked):
            sums = defaultdict(float)
            for key in sorted(weights):
                sums[key[i]] += weights[key]
            weights = {key: min(w * goal.get(key[i], 0.0) / sums[key[i]], float(cells[key])) if sums[key[i]] else 0.0
                       for key, w in weights.items()}
    room = {key: cells[key] - w if w > 0 else 0.0 for key, w in weights.items()}
    missing, free = targets.rate * sum(cells.values()) - sum(weights.values()), sum(room.values())
    more = min(max(missing, 0.0) / free, 1.0) if free else 0.0
    # Rounded, so that a cell taken whole is taken whatever the last bits say.
    return {key: round((weights[key] + more * room[key]) / n, 12) if n else targets.rate for key, n in cells.items()}


def with_cells(docs: DataFrame, targets: Targets) -> DataFrame:
    """``docs`` with its own columns for tokens, source, language and topic."""
    counted = docs.withColumn(OWN + "tokens", tokens_of(docs["text"]))
    tokens = F.col(OWN + "tokens")
    return (counted.withColumn(OWN + "topic", _named(topic_of(docs["text"], tokens), targets.shares["topic"]))
            .withColumn(OWN + "source", docs["source"])
            .withColumn(OWN + "lang", _named(docs["lang"], targets.shares["lang"])))


def sums_of(celled: DataFrame, targets: Targets) -> tuple[dict[tuple[str, ...], int], Targets]:
    """The tokens of all cells, and the targets with their sources named."""
    source, keys = OWN + "source", [OWN + d for d in DIMENSIONS]
    sums = celled.groupBy(*keys).agg(F.sum(OWN + "tokens").alias("n"))
    if targets.shares["source"] is None:
        sums = as_table(sums, "mixing-cells")
        largest = (sums.where(F.col(source) != REST).groupBy(source).agg(F.sum("n").alias("n")).where("n > 0")
                   .orderBy(F.desc("n"), source).limit(MOST_SOURCES).collect())
        targets = replace(targets, shares={**targets.shares, "source": {r[source]: 1.0 for r in largest}})
    folded = sums.withColumn(source, _named(F.col(source), targets.shares["source"])).groupBy(*keys).agg(F.sum("n").alias("n"))
    return {tuple(r)[:3]: r["n"] for r in folded.collect()}, targets


def reached(docs: DataFrame, targets: Targets = DEFAULT) -> DataFrame:
    """dimension, value, tokens, target and expected (both in tokens) of every value of the targets."""
    cells, targets = sums_of(with_cells(docs, targets), targets)
    probabilities, rows = rake(cells, targets), []
    for i, (name, wanted) in enumerate(zip(DIMENSIONS, goals(cells, targets))):
        for value in sorted({*wanted, *targets.shares[name]}):
            own = [key for key in cells if key[i] == value]
            rows.append((name, value, sum(cells[k] for k in own), wanted.get(value, (0.0, 0.0))[0],
                         float(sum(cells[k] * probabilities[k] for k in own))))
    return docs.sparkSession.createDataFrame(rows, "dimension string, value string, tokens long, target double, expected double")


def mix(docs: DataFrame, targets: Targets = DEFAULT) -> DataFrame:
    """``docs`` with OWN tokens, source, lang, topic, prob and sampled."""
    celled = with_cells(docs, targets)
    cells, targets = sums_of(celled, targets)
    celled = celled.withColumn(OWN + "source", _named(F.col(OWN + "source"), targets.shares["source"]))
    probabilities = rake(cells, targets)
    known = docs.sparkSession.createDataFrame(
        [(*key, p) for key, p in probabilities.items()],
        ", ".join(f"_cell_{d} string" for d in DIMENSIONS) + f", {OWN}prob double")
    on = [F.col(OWN + d) == F.col("_cell_" + d) for d in DIMENSIONS]
    draw = F.conv(F.substring(F.md5(F.concat(
        F.lit(targets.seed + ":"), F.coalesce(docs["doc_id"].cast("string"), F.md5(F.coalesce(docs["text"], F.lit("")))))),
        1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return (celled.withColumn(OWN + "draw", draw)
            .join(F.broadcast(known), on, "left").drop(*["_cell_" + d for d in DIMENSIONS])
            .withColumn(OWN + "sampled", F.col(OWN + "draw") < F.col(OWN + "prob")))


def sample(docs: DataFrame, targets: Targets = DEFAULT) -> DataFrame:
    """The sampled rows of ``docs``, with its columns."""
    return mix(docs, targets).where(OWN + "sampled").select(*docs.columns)


def oracle(targets: Targets = DEFAULT) -> str:
    """The same in SQL, the rounds of raking written out."""
    def cases(column: str, d: str) -> str:
        return f"CASE WHEN {column} IN (SELECT v FROM share_{d}) THEN {column} ELSE '{REST}' END"

    marks = " ".join(f"WHEN regexp_matches(text, '{mark}') THEN '{topic}'" for topic, mark in TOPIC_MARKS)
    with_ = [f"""counted AS (SELECT doc_id, text, source AS src, lang AS lng,
        len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS tokens FROM documents)""",
             f"""topical AS (SELECT *, CASE {marks} WHEN tokens >= {LONG_WORDS} THEN 'long' ELSE 'short' END AS tpc
        FROM counted)""",
             ]
    for d in DIMENSIONS:
        if targets.shares[d] is None:
            with_.append(f"""share_{d} AS MATERIALIZED (SELECT src AS v, 1::DOUBLE AS s FROM topical WHERE src <> '{REST}'
        GROUP BY src HAVING sum(tokens) > 0 ORDER BY sum(tokens) DESC, src LIMIT {MOST_SOURCES})""")
        else:
            listed = ", ".join(f"('{v}', {s}::DOUBLE)" for v, s in targets.shares[d].items())
            with_.append(f"share_{d} AS MATERIALIZED (SELECT v, s FROM (VALUES {listed}) AS t(v, s))")
    with_ += [f"""celled AS (SELECT doc_id, text, tokens, {cases('src', 'source')} AS source,
        {cases('lng', 'lang')} AS lang, {cases('tpc', 'topic')} AS topic FROM topical)""",
              "cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS n FROM celled GROUP BY ALL)"]
    for d in DIMENSIONS:
        with_.append(f"""goal_{d} AS MATERIALIZED (WITH there AS (SELECT {d} AS v, sum(n) AS n FROM cells GROUP BY 1),
        rest AS (SELECT coalesce(sum(n) FILTER (v = '{REST}'), 0) / sum(n) AS r, sum(n) * {targets.rate} AS budget FROM there),
        named AS (SELECT v, s, n FROM share_{d} JOIN there USING (v) WHERE n > 0 AND s > 0),
        levels AS (SELECT v, s, n, ((1 - r) * budget - coalesce(sum(n) OVER before, 0))
            / ((SELECT sum(s) FROM named) - coalesce(sum(s) OVER before, 0)) AS level FROM named, rest
            WINDOW before AS (ORDER BY n / s, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT v, least(n, s * max(level) OVER ()) AS goal FROM levels
        UNION ALL SELECT '{REST}', r * budget FROM rest)""")
    with_.append(f"w0 AS MATERIALIZED (SELECT source, lang, topic, n, {targets.rate} * n AS w FROM cells)")
    step = 0
    for _ in range(targets.rounds):
        for d in DIMENSIONS:
            with_.append(f"""w{step + 1} AS MATERIALIZED (SELECT source, lang, topic, n,
        CASE WHEN s = 0 THEN 0 ELSE least(w * coalesce(goal, 0) / s, n) END AS w
        FROM (SELECT *, sum(w) OVER (PARTITION BY {d}) AS s FROM w{step}) LEFT JOIN goal_{d} ON v = {d})""")
            step += 1
    with_.append(f"""roomy AS (SELECT *, CASE WHEN w > 0 THEN n - w ELSE 0 END AS room FROM w{step})""")
    with_.append(f"""closed AS MATERIALIZED (SELECT source, lang, topic, n, w + room * coalesce(least(1,
        greatest({targets.rate} * sum(n) OVER () - sum(w) OVER (), 0) / nullif(sum(room) OVER (), 0)), 0) AS w FROM roomy)""")
    return "WITH " + ",\n".join(with_) + f"""
    SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS prob, draw < p AS sampled FROM (
        SELECT c.doc_id, c.source, c.lang, c.topic, c.tokens,
            CASE WHEN n = 0 THEN {targets.rate} ELSE round(w / n, 12) END AS p,
            ('0x' || substr(md5('{targets.seed}:' || coalesce(c.doc_id::VARCHAR, md5(coalesce(c.text, '')))), 1, 13))::BIGINT
                / {float(1 << 52)}::DOUBLE AS draw
        FROM celled c JOIN closed k ON c.source = k.source AND c.lang = k.lang AND c.topic = k.topic)"""
