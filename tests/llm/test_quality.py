import collections
import random

from pyspark.sql import functions as F
from llm.textkit import PROSE, SF_DIR, WORD

from tallyloom.llm import classifier, quality_rules
from tallyloom.llm.queries import QUERIES


def base(text):
    words = WORD.findall(text or "")
    dup, seen = 0, set()
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


SHOWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def judged(docs):
    rows = quality_rules.judge(docs, ["doc_id", "text"]).collect()
    return [(r["doc_id"], r["text"], *(r[quality_rules.OWN + c] for c in (*SHOWN, "kept"))) for r in rows]


def test_counts_of_awkward_texts(docs_of, awkward):
    rows = judged(docs_of(awkward))
    assert len(rows) == len(awkward)
    for _, text, *found, kept in rows:
        assert tuple(found) == base(text)
        assert not (found[-1] and kept)


def test_counts_of_random_texts(docs_of):
    draw = random.Random(5)
    texts = ["".join(draw.choice(["a ", "b ", "c", "\n", "# ", "\u00df", "\t", "d e f g h i j k "])
                     for _ in range(draw.randint(0, 120))) for _ in range(150)]
    for _, text, *found, _ in judged(docs_of(list(enumerate(texts)))):
        assert tuple(found) == base(text)


def test_query_on_the_table(spark):
    from duckdb import connect
    texts = dict(connect().execute(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall())
    rows = QUERIES["op4_quality_rules"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in SHOWN) == base(texts[r["doc_id"]])


def test_junk_goes_and_prose_stays(docs_of):
    draw = random.Random(1)
    clean = [" ".join(draw.choice(WORD.findall(PROSE)) for _ in range(120)) + "." for _ in range(300)]
    junk = [" ".join(w + "$$$" for w in t.split()) for t in clean[:30]]
    docs = docs_of(list(enumerate(clean + junk)))
    kept = {r["doc_id"] for r in quality_rules.filter_documents(docs).collect()}
    assert kept == set(range(300))


def test_filter_keeps_columns_and_repeats(clashing, docs_of):
    docs = clashing([(1, PROSE * 3), (1, PROSE * 3), (None, None), (2, "x")])
    long = docs_of([(1, " ".join(f"w{i} river" for i in range(60)) + ".")]).union(
        docs_of([(1, " ".join(f"w{i} river" for i in range(60)) + ".")]))
    assert quality_rules.filter_documents(docs).columns == docs.columns
    assert quality_rules.filter_documents(docs.limit(0)).count() == 0
    assert quality_rules.filter_documents(long).count() == 2


def test_fit_trusts_the_rule_that_agrees():
    # Three rules; the third votes at random, the first two go together.
    patterns = {"+++": 450, "++-": 440, "--+": 50, "---": 60}
    model = quality_rules.fit(patterns, 3)
    assert model.posterior("++-") > 0.5 > model.posterior("--+")
    assert quality_rules.fit({}, 3).prior == quality_rules.START_PRIOR


def test_classifier_on_held_out_rows(spark):
    scored = QUERIES["op9_quality_classifier"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert scored.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = scored.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows)
    assert rows and right >= 0.9 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_classifier_defined_cases(spark, docs_of, awkward):
    docs = docs_of(awkward)
    one = spark.createDataFrame([(5, 1), (5, None), (None, 0)], "doc_id long, label int")
    assert {r["score"] for r in classifier.score(docs, one).collect()} == {1.0}
    none = one.limit(0)
    assert {r["score"] for r in classifier.score(docs, none).collect()} == {0.5}
    both = spark.createDataFrame([(5, 1), (6, 1), (7, 0), (2, 0)], "doc_id long, label int")
    rows = classifier.score(docs, both).collect()
    assert len(rows) == len(awkward) and all(0 <= r["score"] <= 1 for r in rows)
    repeated = {r["score"] for r in rows if r["doc_id"] in (5, 6)}
    assert len(repeated) == 1
    assert classifier.score(docs.where(F.lit(False)), both).count() == 0
