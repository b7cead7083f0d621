import itertools
import random

import numpy as np
import pytest
from llm.textkit import PROSE, SF_DIR, WORD

from tallyloom.llm import components, embedding_dedup, minhash
from tallyloom.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(pairs, k):
    """By position: set size and component, as the smallest id that is not null."""
    sets = [shingles(t, k) for _, t in pairs]
    links = [(i, j) for i, j in itertools.combinations(range(len(pairs)), 2)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = roots(range(len(pairs)), links)
    out = []
    for i, (doc_id, _) in enumerate(pairs):
        ids = [pairs[j][0] for j in root if root[j] == root[i] and pairs[j][0] is not None]
        component = min(ids, default=None)
        out.append((doc_id, len(sets[i]), component, doc_id is not None and doc_id == component))
    return sorted(out, key=repr)


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)],
    [(1, 5), (2, 5), (2, 6), (3, 6), (10, 11), (None, 3)],
])
def test_components(spark, edges):
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    proper = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    nodes = {x for e in proper for x in e}
    assert {r["node"]: r["root"] for r in found.collect()} == roots(nodes, proper)
    assert found.count() == len(nodes)


def variants(seed, words, count, share):
    draw = random.Random(seed)
    original = [f"w{draw.randint(0, 400)}" for _ in range(words)]
    out = [" ".join(original)]
    for _ in range(count - 1):
        out.append(" ".join(f"n{draw.randint(0, 9999)}" if draw.random() < share else w for w in original))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_groups_against_brute_force(docs_of, awkward, words):
    texts = variants(1, 120, 25, 0.03) + variants(2, 60, 25, 0.06) + variants(3, 200, 10, 0.02)
    pairs = awkward + [(100 + i, t) for i, t in enumerate(texts)] + [(90, texts[3]), (91, PROSE + " tail")]
    found = minhash.group(docs_of(pairs), words=words).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(pairs, words)


def test_links_away_from_the_centre(docs_of):
    """Copies too far from the original and from most others, but pairwise alike."""
    texts = variants(7, 150, 60, 0.07)
    texts += [t + " extra word" for t in texts[20:30]]
    pairs = list(enumerate(texts))
    found = minhash.group(docs_of(pairs), words=2).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(pairs, 2)


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op6_minhash"](spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute([tuple(r) for r in docs], 2)


def test_one_of_each_group_stays(clashing, docs_of, awkward):
    pairs = awkward + [(20, PROSE * 3 + "!"), (None, "only null ids here"), (None, "only null ids here")]
    docs = clashing(pairs)
    kept = minhash.drop_near_duplicates(docs, words=2)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect())
    without_words = [1, 2, 3]
    assert ids == sorted([-1, 4, 5, 7, 8, 9, 10, *without_words])
    assert minhash.drop_near_duplicates(docs.limit(0)).count() == 0


def brute_vectors(rows):
    good = [i for i, (_, v, label) in enumerate(rows) if v and label is not None
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for i, j in itertools.combinations(good, 2):
        a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
        if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93:
            links.append((i, j))
    root = roots(range(len(rows)), links)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in root if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((vec_id, sum(i in e for e in links), component, vec_id is not None and vec_id == component))
    return sorted(out, key=repr)


def test_vectors_against_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = draw.normal(size=16)
        for _ in range(25):
            rows.append([len(rows), (centre + draw.normal(size=16) * 0.22).astype(np.float32).tolist(), int(c % 3)])
    rows += [[900 + i, draw.normal(size=16).astype(np.float32).tolist(), i % 2] for i in range(60)]
    rows += [[2000, rows[0][1], 0], [2001, rows[0][1], 0], [2001, rows[0][1], 0], [2002, rows[0][1], 1],
             [2003, rows[0][1], None], [2004, None, 0], [2005, [0.0] * 16, 0], [2006, [float("nan")] + [1.0] * 15, 0],
             [2007, [None] + [1.0] * 15, 0], [2008, [], 0], [None, rows[0][1], 0], [2009, [1.0, 2.0], 0],
             [2010, [2.0, 4.0], 0], [2011, [float("inf")] * 16, 0], [2012, [x * 1e30 for x in rows[0][1]], 0]]
    table = spark.createDataFrame([tuple(r) for r in rows], "vec_id long, embedding array<float>, label int")
    for cell, chunk in ((20, 16), (10_000, 10_000)):
        monkeypatch.setattr(embedding_dedup, "CELL", cell)
        monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
        found = [tuple(r) for r in embedding_dedup.link(table).collect()]
        assert sorted(found, key=repr) == brute_vectors(rows)
    assert embedding_dedup.link(table.limit(0)).count() == 0
