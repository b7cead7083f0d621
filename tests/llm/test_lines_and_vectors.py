"""Shared lines, vector codes and whitening against plain Python."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from llm.textkit import PROSE, SF_DIR
from oracle_check import canonical
from tallyloom.llm import line_dedup, vector_codes, whitening
from tallyloom.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


# --- shared lines --------------------------------------------------------------------------

def plain_lines(pairs, documents, shortest=1):
    """(id, n_lines, n_dropped, kept text) of every row, in input order."""
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip("\x20\t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, text in pairs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    common = {k for k, ids in holders.items() if len(ids) >= documents and len(k) >= max(shortest, 1)}
    out = []
    for i, text in pairs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in common]
        out.append((i, len(lines), len(lines) - len(kept), text if len(kept) == len(lines) else "\n".join(kept)))
    return out


def dropped(docs, **options):
    done = line_dedup.drop_common_lines(docs, **options)
    return [tuple(r) for r in done.select("doc_id", *[line_dedup.OWN + c for c in ("n_lines", "n_dropped", "kept")]).collect()]


def test_lines_agree_with_plain_python(docs_of):
    draw = random.Random(4)
    stock = ["Share this page", "  share THIS page\t", "Ärger Über alles", "ärger über alles", "", " ", "a\x0bb", "\x0b\x0c x",
             "All rights reserved.", "x ", " wide", "日本語の行", "İstanbul", "İstanbul"]
    pairs = [(i // 2 if i % 9 == 0 else i, "\n".join(draw.choices(stock, k=draw.randrange(1, 9)))) for i in range(120)]
    pairs += [(7000, None), (7001, ""), (7002, "\n\n"), (7003, "only here"), (None, "Share this page"), (None, None), pairs[0], pairs[0]]
    assert sorted(dropped(docs_of(pairs), documents=30), key=repr) == sorted(plain_lines(pairs, 30), key=repr)
    assert sorted(dropped(docs_of(pairs), documents=3, shortest=6), key=repr) == sorted(plain_lines(pairs, 3, 6), key=repr)


def test_awkward_lines(docs_of, awkward, clashing):
    long_text = "\n".join(f"line {i}" if i % 3 else "Menu" for i in range(60_000))
    pairs = [*awkward, (20, long_text), (21, "menu"), (22, "x" * 300_000 + "\nMENU ")]
    want = sorted(plain_lines(pairs, 3), key=repr)
    assert sorted(dropped(docs_of(pairs), documents=3), key=repr) == want
    clash = clashing(pairs).withColumn("text_", F.lit(1)).withColumnRenamed("node", "line").withColumnRenamed("root", "position")
    done = line_dedup.drop_common_lines(clash, documents=3)
    assert done.columns[:len(clash.columns)] == clash.columns
    assert sorted(((r["doc_id"], r[line_dedup.OWN + "kept"]) for r in done.collect()), key=repr) == sorted(((w[0], w[3]) for w in want), key=repr)
    assert dropped(docs_of([]), documents=3) == []


def test_repeated_ids_are_one_document(docs_of):
    assert [r[2] for r in dropped(docs_of([(1, "a"), (1, "a"), (2, "a")]), documents=3)] == [0, 0, 0]
    assert sorted(dropped(docs_of([(1, "a"), (1, "b\na"), (2, "A "), (3, "a")]), documents=3)) == [
        (1, 1, 1, ""), (1, 2, 1, "b"), (2, 1, 1, ""), (3, 1, 1, "")]


def test_query_of_lines_agrees_with_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    found = con.execute(ORACLES["op13_line_dedup"])
    got = QUERIES["op13_line_dedup"](spark, SF_DIR)
    assert canonical(got.columns, got.collect()) == canonical([d[0] for d in found.description], found.fetchall())


def test_shared_line_of_many_documents_is_split_over_tasks(docs_of):
    """The join that finds a hot line's positions comes from two exchanges, which Spark can split."""
    docs = docs_of([(i, f"{PROSE}{i}\nCookie notice\n{i}") for i in range(500)])
    plan = line_dedup.drop_common_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Nested" not in plan and "Cartesian" not in plan


# --- vector codes --------------------------------------------------------------------------

def plain_codes(rows, scale=1024, parts=4, entries=256, rounds=4):
    """{row number: (code, error)}, label sums and the digest, in Python's own integers."""
    kept = [(i, r) for i, r in enumerate(rows) if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    x = {i: [math.floor(float(np.float32(c)) * scale) for c in r[1]] for i, r in kept}
    size = len(next(iter(x.values())))
    step = -(-size // parts)
    cut = {i: [(v + [0] * (step * parts - size))[p * step:(p + 1) * step] for p in range(parts)] for i, v in x.items()}
    order = sorted(kept, key=lambda k: (k[1][0] is None, k[1][0] or 0, x[k[0]]))
    books = [[cut[i][p] for i, _ in order[:entries]] for p in range(parts)]

    def near(point, book):
        gaps = [sum((a - b) ** 2 for a, b in zip(point, e)) for e in book]
        return min(range(len(book)), key=gaps.__getitem__), min(gaps)
    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for i in x:
                groups[near(cut[i][p], books[p])[0]].append(cut[i][p])
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    coded = {i: [near(cut[i][p], books[p]) for p in range(parts)] for i in x}
    codes = {i: ("".join(f"{e:02x}" for e, _ in c), sum(g for _, g in c)) for i, c in coded.items()}
    labels = collections.Counter()
    for i, (_, error) in codes.items():
        labels[rows[i][2]] += error
    flat = ",".join(str(v) for p in range(parts) for e in books[p] for v in e[:max(0, min(step, size - p * step))])
    return codes, labels, hashlib.sha256(flat.encode()).hexdigest()


def as_plain(rows, **options):
    codes, labels, digest = plain_codes(rows, **options)
    return sorted(((rows[i][0], *c, labels[rows[i][2]], digest) for i, c in codes.items()), key=repr)


def coded(spark, rows, **options):
    done = vector_codes.compress(spark.createDataFrame(rows, VECTORS), **options)
    return sorted((tuple(r) for r in done.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def some_vectors(count, size, seed, spread=1.0):
    draw = random.Random(seed)
    return [(i, [draw.uniform(-spread, spread) for _ in range(size)], draw.choice([0, 1, 2, None])) for i in range(count)]


@pytest.mark.parametrize(("size", "spread"), [(8, 1), (12, 30_000.0), (7, 2), (3, 1)])
def test_codes_agree_with_plain_integers(spark, size, spread):
    rows = some_vectors(90, size, size, spread)
    rows += [rows[3], rows[3], (None, rows[5][1], 1), (200, [0.25] * size, 2), (201, [-0.0] * size, None), (4, [0.5] * size, 1)]
    assert coded(spark, rows, entries=9, rounds=3) == as_plain(rows, entries=9, rounds=3)


def test_rows_that_cannot_be_coded_are_dropped(spark):
    rows = some_vectors(30, 8, 3)
    odd = [(100, None, 1), (101, [None] + [0.0] * 7, 1), (102, [math.nan] * 8, 1), (103, [math.inf] + [0.0] * 7, 1),
           (104, [], 1), (105, [1.0, 2.0], 1), (106, [3e38] * 8, 1)]
    assert coded(spark, rows + odd, entries=4) == as_plain(rows, entries=4)
    assert coded(spark, odd[:5]) == [] and coded(spark, []) == []
    one = [(1, [0.5, 0.25, -0.5, 0.0], None)]
    assert coded(spark, one) == as_plain(one)
    clash = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("mine") for c in ("x", "code", "error", "size", "part")})
    assert len(vector_codes.compress(clash, entries=4).collect()) == 30


def test_query_of_codes_agrees_with_plain_integers(spark):
    stored = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()[:]
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in stored]
    x = np.array([[math.floor(float(c) * 1024) for c in r[1]] for r in rows], np.int64)  # no limbs, no matrix product
    step = x.shape[1] // 4
    order = np.argsort([r[0] for r in rows])
    books = [x[order[:256], p * step:(p + 1) * step].copy() for p in range(4)]
    for turn in range(5):
        gaps = [((x[:, None, p * step:(p + 1) * step] - books[p][None]) ** 2).sum(axis=2) for p in range(4)]
        best = [g.argmin(axis=1) for g in gaps]
        if turn == 4:
            break
        for p in range(4):
            for e in set(best[p].tolist()):
                members = x[best[p] == e, p * step:(p + 1) * step]
                books[p][e] = members.sum(axis=0) // len(members)
    errors = sum(g.min(axis=1) for g in gaps)
    labels = collections.Counter()
    for r, error in zip(rows, errors.tolist()):
        labels[r[2]] += error
    digest = hashlib.sha256(",".join(map(str, np.concatenate(books).reshape(-1).tolist())).encode()).hexdigest()
    want = sorted((r[0], "".join(f"{b[i]:02x}" for b in best), int(errors[i]), labels[r[2]], digest) for i, r in enumerate(rows))
    got = QUERIES["op12_vector_codes"](spark, SF_DIR)
    assert sorted(tuple(r) for r in got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()) == want


def test_limbs_multiply_exactly():
    draw = random.Random(5)
    for bits, size in ((10, 3), (26, 4), (29, 16), (30, 1)):
        a = [[draw.randrange(-(1 << bits), 1 << bits) for _ in range(size)] for _ in range(6)]
        b = [[draw.choice([(1 << bits) - 1, -(1 << bits), 0, draw.randrange(1 << bits)]) for _ in range(size)] for _ in range(5)]
        want = [[sum(p * q for p, q in zip(r, s)) for s in b] for r in a]
        assert vector_codes.dot_products(np.array(a), np.array(b)).tolist() == want


def test_codes_stand_for_their_entries(spark):
    rows = vector_codes.vectors_of(spark.createDataFrame(some_vectors(40, 7, 9), VECTORS))
    codec = vector_codes.fit(rows, entries=40)
    back = vector_codes.decode(vector_codes.encode(rows, codec, ["vec_id"]), codec, ["vec_id"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.select("vec_id", "x").collect()))


# --- whitening -----------------------------------------------------------------------------

def plain_whitening(rows, scale=256, components=4):
    """n, {row: deviation}, {row: whitened up to sign}, explained."""
    x = {i: [math.floor(float(np.float32(c)) * scale) for c in r[1]] for i, r in enumerate(rows)}
    distinct = sorted(set(map(tuple, x.values())))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    centred = np.array(distinct, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    picked = [k for k in np.argsort(-values)[:components] if values[k] > 1e-11 * values.sum()]
    white = {i: [(np.array(v) - np.array(sums) / n) @ vectors[:, k] / math.sqrt(values[k]) for k in picked] for i, v in x.items()}
    return n, deviation, white, [values[k] / values.sum() for k in picked]


def check_whitening(spark, rows, found, components=4):
    n, deviation, white, explained = plain_whitening(rows, components=components)
    assert collections.Counter((r["vec_id"], r["component"]) for r in found) == collections.Counter(
        (r[0], k + 1) for r in rows for k in range(len(explained)))
    assert {r["n"] for r in found} == {n}
    assert all(r["identity_error"] < 1e-4 for r in found)
    by_id = collections.defaultdict(set)
    for i, r in enumerate(rows):
        by_id[r[0]].add(deviation[i])
    assert all(r["deviation"] in by_id[r["vec_id"]] for r in found)
    for k, share in enumerate(explained):
        mine = [r for r in found if r["component"] == k + 1]
        assert all(math.isclose(r["explained"], share, rel_tol=1e-9) for r in mine)
        want = sorted(w[k] for w in white.values())
        got = sorted(r["whitened"] for r in mine)
        assert np.allclose(got, want, atol=1e-7) or np.allclose(sorted(-g for g in got), want, atol=1e-7)


def stretched(count, size, seed):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, 3.0 / (j + 1)) for j in range(size)], 0) for i in range(count)]


@pytest.mark.parametrize("size", [2, 6, 40])
def test_whitening_agrees_with_numpy(spark, size):
    rows = stretched(150, size, size)
    rows += [(500, rows[3][1], 1), (3, rows[3][1], 1), (501, rows[9][1], None), (None, rows[7][1], 0)]
    done = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    check_whitening(spark, rows, done)


def test_many_blocks_agree_with_numpy(spark, monkeypatch):
    """Blocks of a few rows, dealt to many tasks, in both directions of the matrix."""
    monkeypatch.setattr(whitening, "ENTRIES", 60)
    monkeypatch.setattr(whitening, "TOGETHER", 2)
    rows = stretched(130, 12, 8)
    check_whitening(spark, rows, whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5)).collect())


def test_rows_without_whitened_form(spark):
    rows = stretched(40, 5, 2)
    odd = [(100, None, 1), (101, [None] + [0.0] * 4, 1), (102, [math.nan] * 5, 1), (103, [-math.inf] + [0.0] * 4, 1),
           (104, [], 1), (105, [1.0, 2.0], 1), (106, [3e38] * 5, 1)]
    clash = spark.createDataFrame(rows + odd, VECTORS).withColumns({c: F.lit("mine") for c in ("x", "index", "w", "n", "size")})
    check_whitening(spark, rows, whitening.whiten(clash).collect())
    for few in ([], odd[:5], rows[:1], [(i, [0.5, 0.5], 0) for i in range(5)]):
        assert whitening.whiten(spark.createDataFrame(few, VECTORS)).collect() == []
    flat = [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(8)]  # one direction only
    check_whitening(spark, flat, whitening.whiten(spark.createDataFrame(flat, VECTORS)).collect())


def test_large_deviations_are_exact_or_null(spark):
    big = spark.createDataFrame([([2_000_000_000, -3],), ([5, 7],)], "x array<long>")
    n, sums = 40_000, (11, -12)
    want = [sum((n * a - s) ** 2 for a, s in zip(r["x"], sums)) for r in big.collect()]
    got = [r[0] for r in big.select(whitening.deviation(F.col("x"), n, sums, 2_000_000_000)).collect()]
    assert got == [w if w < 1 << 63 else None for w in want] and None in got


def test_query_of_whitening_agrees_with_numpy(spark):
    stored = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in stored]
    check_whitening(spark, rows, QUERIES["op11_whitening"](spark, SF_DIR).collect())
