import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from llm.textkit import DOCS, PROSE, SF_DIR

from tallyloom.llm import mixing, pii, url_filter
from tallyloom.llm.queries import ORACLES, QUERIES, URL_RULES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
            "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if valid(k, m[0])]
    text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
    counts = tuple(sum(f[1] == i for f in found) for i in range(4))
    return (*counts, hashlib.sha256(text.encode()).hexdigest()), text


ODD = [
    "a@b.c.d@e.f x@y _@z.w", "a@b.c_d@e.f", "\U0001f600\U0001f600 me@host.example.com, 1.2.3.4.5 and 01.002.3.255",
    "256.1.1.1 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (974) 555-3436 +4 +123456789012345678",
    "1 2 3 4 5 6 7 8 9 0 1 2 3", "\u65e5\u672c 4111111111111111\u65e5 +49 30 1234567.", "x" * 20_000 + "@", "1" * 20_000,
    "1 " * 5000, "a@" + "b." * 5000 + "c", "\u00e9" * 50 + "p.q+r%s@t-u.v", None, "", "...@...", "9.9.9", "+1+1+1 22 333 444",
]


def test_base_spans(docs_of):
    draw = random.Random(3)
    texts = ODD + ["".join(draw.choice("a1.@+ -(4)9\u00e9") for _ in range(draw.randint(0, 60))) for _ in range(400)]
    rows = pii.counts_of(pii.find(docs_of(list(enumerate(texts))), ["doc_id", "text"]), ["doc_id", "text"]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts, spans = base(r["text"])
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == counts, r["text"]
        assert set(filter(None, spans.split(","))) <= set(filter(None, r["spans"].split(",")))


def test_addresses_with_zero_parts(docs_of):
    texts = ["10.0.0.1", "0.0.0.0", "192.168.000.1", "127.0.0.1 and 8.8.8.8", "at 192.168.0.17.", "00.000.0000.0255",
             "0.0.0.256", "10.0.0.1000", "10.0.0300.1", "0." * 400 + "0", "1." + "0" * 4000 + ".0.1", "0" * 4000 + ".0.0.999"]
    docs = docs_of(list(enumerate(texts)))
    rows = pii.counts_of(pii.find(docs, ["doc_id"]), ["doc_id"]).collect()
    for r in rows:
        counts, _ = base(texts[r["doc_id"]])
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == counts, texts[r["doc_id"]][:40]
    assert [r["n_ip"] for r in sorted(rows, key=lambda r: r["doc_id"])][:9] == [1, 1, 1, 2, 1, 1, 0, 0, 0]
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert redacted[0] == "[IP]" and redacted[3] == "[IP] and [IP]" and redacted[4] == "at [IP]."


def test_query_on_the_table(spark):
    texts = dict(duckdb.execute(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall())
    for r in QUERIES["op7_pii"](spark, SF_DIR).collect():
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == base(texts[r["doc_id"]])[0]


def test_numbers_like_valid_ones_are_added(docs_of):
    draw = random.Random(9)

    def number():
        return "4" + "".join(draw.choice("0123456789") for _ in range(15))

    good = [n for n in (number() for _ in range(6000)) if luhn(n)][:500]
    wrong = [n for n in (number() for _ in range(60)) if not luhn(n)][:8]
    texts = [f"pay by card {n} now" for n in good + wrong] + [f"token={hashlib.md5(str(i).encode()).hexdigest()}" for i in range(500)]
    rows = pii.counts_of(pii.find(docs_of(list(enumerate(texts))), ["doc_id"]), ["doc_id"]).collect()
    added = {r["doc_id"] for r in rows if r["n_added"]}
    assert added == set(range(500, 508))


def test_unusual_forms_are_added_among_valid_ones(docs_of):
    draw = random.Random(5)

    def digits(n):
        return "".join(draw.choice("0123456789") for _ in range(n))

    def card():
        return " ".join(["4" + digits(3), digits(4), digits(4), digits(4)])

    cards = [card() for _ in range(6000)]
    good = [f"pay by card {c} now" for c in cards if luhn(c.replace(" ", ""))][:400]
    good += [f"please write to amy{i}@mail.example.org today" for i in range(400)]
    good += [f"please call +1 ({digits(3)}) {digits(3)}-{digits(4)} today" for _ in range(400)]
    wanted = {f"pay by card {c} now": f"card:12:{12 + len(c)}" for c in [c for c in cards if not luhn(c.replace(" ", ""))][:6]}
    wanted["pay by card 4111.1111.1111.1112 now"] = "card:12:31"
    wanted["please write to amy [at] example [dot] org today"] = "email:16:42"
    wanted["please write to bob(at)example(dot)org today"] = "email:16:38"
    wanted |= {f"please call ({a}) 555-3436 today": "phone:12:26" for a in range(201, 207)}
    not_wanted = ["please meet @ noon today", "please call 2024-05-12 today", "please call 12/05/2024 today"]
    texts = good + list(wanted) + not_wanted
    rows = pii.counts_of(pii.find(docs_of(list(enumerate(texts))), ["doc_id"]), ["doc_id"]).collect()
    assert len(good) == 1200
    assert {texts[r["doc_id"]]: r["spans"] for r in rows if r["n_added"]} == wanted


def test_redaction(clashing, awkward):
    docs = clashing([*awkward, (30, "write a@b.example.com or call +1 (974) 555-3436!"), (31, "\U0001f600 1.2.3.4")])
    found = pii.redact(docs)
    assert found.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts[30] == "write [EMAIL] or call [PHONE]!" and texts[31] == "\U0001f600 [IP]"
    assert texts[1] is None and texts[5] == PROSE * 3
    assert pii.redact(docs.limit(0)).count() == 0


def test_pii_and_mixing_use_no_python(spark):
    for name in ("op7_pii", "op10_mixing"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", ["op2_sharding", "op8_warc", "op10_mixing"])
def test_query_agrees_with_sql(spark, name):
    from oracle_check import canonical
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    wanted = connection.execute(ORACLES[name])
    assert canonical(found.columns, found.collect()) == canonical(
        [d[0] for d in wanted.description], wanted.fetchall())


def test_rake_meets_targets():
    targets = mixing.Targets({"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.7, "de": 0.3}, "topic": {"x": 1.0}}, 0.2, 60)
    cells = {("a", "en", "x"): 5000, ("a", "de", "x"): 700, ("b", "en", "x"): 900, ("b", "de", "x"): 800, ("*", "*", "*"): 600}
    found = mixing.rake(cells, targets)
    taken = {k: found[k] * n for k, n in cells.items()}
    budget, rest = 0.2 * 8000, 0.2 * 600
    assert sum(taken.values()) == pytest.approx(budget)
    assert sum(v for k, v in taken.items() if k[0] == "a") == pytest.approx((budget - rest) / 2)
    assert sum(v for k, v in taken.items() if k[1] == "de") == pytest.approx((budget - rest) * 0.3)
    assert all(0 <= p <= 1 for p in found.values())
    assert mixing.rake({}, targets) == {}


def test_rake_takes_no_more_than_there_is():
    targets = mixing.Targets({"source": {"a": 0.9, "b": 0.1}, "lang": {}, "topic": {}}, 0.5)
    found = mixing.rake({("a", "*", "*"): 100, ("b", "*", "*"): 900}, targets)
    assert found["a", "*", "*"] == 1.0 and found["b", "*", "*"] <= 1.0


def test_rake_spends_the_budget_when_a_value_is_too_rare():
    targets = mixing.Targets({"source": {"a": 0.4, "b": 0.4, "c": 0.2}, "lang": {"en": 1.0}, "topic": {"x": 0.5, "y": 0.5}}, 0.5)
    cells = {("a", "en", "x"): 30, ("b", "en", "x"): 900, ("c", "en", "x"): 900, ("b", "en", "y"): 70, ("c", "en", "y"): 100}
    found = mixing.rake(cells, targets)
    assert sum(found[k] * n for k, n in cells.items()) == pytest.approx(1000)
    assert found["a", "en", "x"] == pytest.approx(1, abs=0.01) and all(0 <= p <= 1 for p in found.values())
    source, _, topic = mixing.goals(cells, targets)
    assert source["a"] == (400.0, 30.0) and source["b"][1] == pytest.approx(970 * 2 / 3)
    assert topic["y"][1] == 170.0 and topic["x"][1] == pytest.approx(830)


def test_largest_sources_get_equal_shares_and_the_budget_is_spent(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mixing.reached(docs).collect()
    for name in mixing.DIMENSIONS:
        own = [r for r in rows if r["dimension"] == name]
        assert sum(r["expected"] for r in own) == pytest.approx(mixing.DEFAULT.rate * sum(r["tokens"] for r in own), rel=1e-6)
        assert all(r["expected"] <= r["tokens"] + 1e-6 for r in own)
    assert len({r["target"] for r in rows if r["dimension"] == "source" and r["value"] != "*"}) == 1


def test_mixing_defined_cases(spark, clashing, awkward):
    docs = clashing(awkward)
    assert mixing.sample(docs).columns == docs.columns
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(awkward)
    assert all(r[mixing.OWN + "sampled"] is not None for r in rows)
    assert len({r[mixing.OWN + "sampled"] for r in rows if r["doc_id"] == 5}) == 1
    odd = spark.createDataFrame([(1, "a b", None, None, 3), (2, None, "xx", "elsewhere", 0)], DOCS)
    assert {r[mixing.OWN + "source"] for r in mixing.mix(odd).collect()} == {"*"}  # the one source has no tokens
    more = odd.union(spark.createDataFrame([(3, "c d e", "en", "elsewhere", 5)], DOCS))
    assert {r[mixing.OWN + "source"] for r in mixing.mix(more).collect()} == {"*", "elsewhere"}
    named = mixing.Targets({**mixing.DEFAULT.shares, "source": {"src0": 1.0}})
    assert {r[mixing.OWN + "source"] for r in mixing.mix(more, named).collect()} == {"*"}
    assert mixing.sample(docs.limit(0)).count() == 0


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match("[^?#]*", rest[len(host):])[0]


URLS = ["http://A.Net/x", "http://a.net", "http://net/", "http://b.example.net/en/1", "http://example.net/de/1", "http://xexample.net/en/",
        "https://example.com/de/", "https://m.example.com/de/9.html?a=b#c", "https://x.org/fr/", "ftp://x.org/frx", "no scheme", "", None,
        "http://", "http://?q", "http://h#f/p", "x://y://z/p", "http://\u00c9.NET/\u00c9?x", "http://example.com/en/?p=/de/"]


def test_urls_and_fixed_rules(spark):
    pages = spark.createDataFrame([(i, u, 7) for i, u in enumerate(URLS + URLS)], "page_id long, url string, rule int")
    nothing = spark.createDataFrame([], "url string, bad boolean")
    rows = url_filter.judge(pages, nothing, URL_RULES).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path = host_and_path(r["url"])
        fits = [f for f in URL_RULES if (host == f.host or host.endswith("." + f.host)) and path.startswith(f.path)]
        best = max(fits, key=lambda f: len(f.text), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best.text)
        assert r["verdict"] == (best.verdict if best else "allow")
    assert url_filter.judge(pages.limit(0), nothing, URL_RULES).count() == 0


def test_mined_rules_against_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for i in range(600):
        spam, lang = draw.random() < 0.2, draw.choice(["en", "de"])
        host = ("casino" if spam else draw.choice(["news", "blog"])) + ".example.org"
        rows.append((f"http://{host}/{lang}/{i}", spam and lang == "en" or draw.random() < 0.05))
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    mining = url_filter.Mining(support=0.02, confidence=0.8, pages=10)
    mined, twins = url_filter.mine(labelled, mining)
    rules = {frozenset(r["tokens"]): r["confidence"] for r in mined.collect()}
    follows = {r["token"] for r in twins.collect()}
    tokens = [(frozenset(r["t"]), r["bad"]) for r in labelled.select(
        url_filter.tokens_of(F.col("url")).alias("t"), "bad").collect()]
    every = {t for own, _ in tokens for t in own}
    import itertools
    wanted = {}
    for size in range(1, 5):
        for some in map(frozenset, itertools.combinations(sorted(every), size)):
            held = [bad for own, bad in tokens if some <= own]
            if held and sum(held) >= 0.02 * 600 and sum(held) >= 0.8 * len(held):
                wanted[some] = sum(held) / len(held)
    held_by = {t: frozenset(i for i, (own, _) in enumerate(tokens) if t in own) for t in every}
    assert follows == {t for t in every if any(held_by[t] == held_by[o] and o < t for o in every)}
    assert rules == pytest.approx({some: c for some, c in wanted.items() if not some & follows}) and wanted
    verdicts = url_filter.judge(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string"),
                                labelled, [], mining).collect()
    for r, (own, _) in zip(sorted(verdicts, key=lambda r: r["page_id"]), tokens):
        assert r["verdict"] == ("block" if any(rule <= own for rule in wanted) else "allow")


def test_enough_bad_pages_are_proof_at_every_size(spark):
    def pages(others):
        rows = [(f"http://casino.example/{i}", True) for i in range(25)] + [(f"http://few.example/{i}", True) for i in range(19)]
        return spark.createDataFrame(rows + [(f"http://news{i % 7}.example.org/{i}", i % 50 == 0) for i in range(others)],
                                     "url string, bad boolean")
    for others in (500, 8000):
        rules = {tuple(r["tokens"]): r["confidence"] for r in url_filter.mine(pages(others))[0].collect()}
        assert rules == {("domain:casino.example",): 1.0}


def test_url_query_against_brute_force(spark, tmp_path):
    import itertools
    draw = random.Random(6)
    urls = [f"http://{draw.choice(['casino', 'news', 'blog'])}.example.org/{draw.choice(['a', 'b'])}/{i}" for i in range(400)]
    pages = [(i, u, "") for i, u in enumerate(urls)] + [(900, "http://casino.example.org/a/", ""), (901, None, "")]
    labels = [(i, int("casino" not in u and draw.random() < 0.9), int("/b/" in u and "blog" in u)) for i, u in enumerate(urls) if i % 4]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    tokens = {r["url"]: frozenset(r["t"]) for r in spark.createDataFrame([(u,) for _, u, _ in pages], "url string").select(
        "url", url_filter.tokens_of(F.col("url")).alias("t")).collect()}
    known = [(tokens[urls[i]], quality == 0 or toxic == 1) for i, quality, toxic in labels]
    wanted = {}
    every = sorted({t for own, _ in known for t in own})
    for some in (frozenset(c) for n in range(1, len(every) + 1) for c in itertools.combinations(every, n)):
        held = [bad for own, bad in known if some <= own]
        if sum(held) >= 20 and sum(held) >= 0.6 * len(held):
            wanted[some] = sum(held) / len(held)
    assert wanted
    rows = QUERIES["op5_url_filter"](spark, str(tmp_path)).collect()
    assert len(rows) == len(pages)
    by_id = {i: u for i, u, _ in pages}
    for r in rows:
        fits = sorted((-p, " ".join(sorted(some))) for some, p in wanted.items() if some <= tokens[by_id[r["page_id"]]])
        assert r["rule"] is None and r["verdict"] == ("block" if fits else "allow")
        assert (r["mined"], r["confidence"]) == ((fits[0][1], pytest.approx(-fits[0][0])) if fits else (None, None))
    assert {r["verdict"] for r in rows} == {"allow", "block"}


def test_many_shared_segments_are_one_item(spark):
    """Forty segments that always occur together: one item, found at once; a URL with any of them is met by it."""
    shared = [f"s{i:02d}" for i in range(40)]
    rows = [(f"http://x.example/{'/'.join(shared)}/{i}", True) for i in range(25)]
    rows += [(f"http://x.example/good/{i}", False) for i in range(200)]
    mined, twins = url_filter.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    assert sorted((r["tokens"], r["confidence"]) for r in mined.collect()) == [
        (["domain:x.example", "path:s00"], 1.0), (["path:s00"], 1.0)]
    assert twins.count() == 39
    pages = [(1, "http://other.example/s07/new"), (2, "http://x.example/good/7"), (3, f"http://x.example/{'/'.join(shared)}/99"), (4, None)]
    judged = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"),
                              spark.createDataFrame(rows, "url string, bad boolean"), []).collect()
    assert {r["page_id"]: (r["verdict"], r["mined"]) for r in judged} == {
        1: ("block", "path:s07"), 2: ("allow", None), 3: ("block", "domain:x.example path:s00"), 4: ("allow", None)}
