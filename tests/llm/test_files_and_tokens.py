import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as library
import zstandard
from pyspark.sql import functions as F

from llm.textkit import PROSE, SF_DIR

from tallyloom.llm import sentencepiece, sharding, warc
from tallyloom.llm.queries import QUERIES, TOKENIZER
from tallyloom.session import scratch_path


def field(number, kind, data):
    head = bytes([(number << 3 | kind) & 127 | (128 if number > 15 else 0)]) + (bytes([number >> 4]) if number > 15 else b"")
    return head + (bytes([data]) if kind == 0 else data if kind == 5 else _length(len(data)) + data)


def _length(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def unigram_model():
    """A small unigram model with bytes, in the file format."""
    draw = random.Random(2)
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    sign = sentencepiece.SPACE_SIGN
    words = [sign, *"abcdethrinu", "th", "the", "in", "er", "re", sign + "the", sign + "a", "he", "hea", "eat", sign + "t", "heather"]
    pieces += [(w, -draw.uniform(1, 12), 1) for w in words]
    body = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, t))
                    for p, s, t in pieces)
    return body + field(2, 2, field(3, 0, 1) + field(35, 0, 1)) + field(3, 2, field(1, 2, b"identity") + field(3, 0, 1)
                                                                      + field(4, 0, 0) + field(5, 0, 1))


def texts():
    draw = random.Random(8)
    odd = ["", " ", "  two  spaces ", "日本語 テキスト \U0001f600", "a▁b", "\n\n x\t y", "a" * 300, "<s> </s> <0x41>", PROSE * 5]
    return odd + ["".join(draw.choice(" ab\nZé the heather in.12") for _ in range(draw.randint(0, 60))) for _ in range(400)]


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_ids_are_those_of_the_library(kind):
    data = unigram_model() if kind == "unigram" else open(TOKENIZER, "rb").read()
    mine = sentencepiece.Codec(sentencepiece.Model.parse(data))
    theirs = library.SentencePieceProcessor(model_proto=data)
    ids, at = mine.encode(pa.array(texts(), pa.large_string()))
    back, ends = mine.decode(ids.astype("int64"), at)
    for i, text in enumerate(texts()):
        wanted = theirs.encode(text)
        assert ids[at[i]:at[i + 1]].tolist() == wanted, text
        assert back[ends[i]:ends[i + 1]].tobytes().decode() == theirs.decode(wanted)


def test_models_that_change_texts_are_refused():
    with pytest.raises(ValueError):
        sentencepiece.Model.parse(field(3, 2, field(4, 0, 1)))


def test_encoding_of_rows(docs_of, awkward):
    model = sentencepiece.Model.read(TOKENIZER)
    docs = docs_of([*awkward, (11, "a▁b")])
    coded = sentencepiece.encode(docs, model, ["doc_id", "text"])
    rows = coded.collect()
    assert len(rows) == len(awkward) + 1
    for r in rows:
        assert (r["ids"] is None) == (r["text"] is None)
        assert r["round_trip"] is (None if r["text"] is None else "▁" not in r["text"])
    back = sentencepiece.decode(coded.select("doc_id", "ids", F.col("text").alias("before")), model, ["doc_id", "before"])
    for r in back.collect():
        assert r["text"] == (None if r["before"] is None else r["before"].replace("▁", " "))
    assert sentencepiece.encode(docs.limit(0), model, ["doc_id"]).count() == 0


def test_token_query_on_the_table(spark):
    found = QUERIES["op1_sentencepiece"](spark, SF_DIR)
    theirs = library.SentencePieceProcessor(model_file=TOKENIZER)
    texts_of = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(texts_of) and all(r["round_trip"] for r in rows)
    assert all(list(r["ids"]) == theirs.encode(texts_of[r["doc_id"]]) for r in rows)


def long_units():
    draw = random.Random(1)
    base64 = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    chinese = [chr(c) for c in range(0x4E00, 0x5200)]
    return {"one letter": "x" * 20_000, "period": "xyz" * 7000, "genes": "".join(draw.choices("ACGT", k=20_000)),
            "base64": "".join(draw.choices(base64, k=20_000)), "chinese": "".join(draw.choices(chinese, k=20_000)),
            "words": "".join(draw.choices("the of and ing tion over river mill people town".split(), k=4000)),
            "no pieces": "😀é" * 6000, "runs": "a" * 7 + "1" * 9000 + "b" * 9001,
            "just cut": "n" * (sentencepiece.LONG + 1), "not cut": "nm" * (sentencepiece.LONG // 2)}


@pytest.mark.parametrize("name", list(long_units()))
def test_long_units_are_those_of_the_library(name):
    codec = sentencepiece.Codec(sentencepiece.Model.read(TOKENIZER))
    theirs = library.SentencePieceProcessor(model_file=TOKENIZER)
    text = long_units()[name]
    ids, at = codec.encode(pa.array([text, "a b", text[::-1]], pa.large_string()))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [theirs.encode(t) for t in (text, "a b", text[::-1])]
    back, ends = codec.decode(ids, at)
    assert back[:ends[1]].tobytes().decode() == text


def test_blocks_of_a_unigram_model_and_of_few_characters(monkeypatch):
    """Small blocks, so that starts that never agree occur too; both kinds of model."""
    monkeypatch.setattr(sentencepiece, "LONG", 40)
    monkeypatch.setattr(sentencepiece, "BLOCK", 16)
    monkeypatch.setattr(sentencepiece, "WARM", 4)
    monkeypatch.setattr(sentencepiece, "SIDE_BY_SIDE", 3)
    draw = random.Random(2)
    for kind in (1, 2):
        model = sentencepiece.Model.parse(unigram_model()) if kind == 1 else sentencepiece.Model.read(TOKENIZER)
        codec = sentencepiece.Codec(model)
        for text in ["".join(draw.choices("abc", k=400)), "a" * 333, "ab" * 200, "".join(draw.choices("ab\u00e9", k=300))]:
            chars = sentencepiece._code_points(text)
            rows, whole = codec._segment(chars[None], np.array([len(chars)]))
            assert codec._segment_long(chars).tolist() == whole.tolist()


def test_a_megabyte_without_spaces_takes_seconds():
    import time
    codec = sentencepiece.Codec(sentencepiece.Model.read(TOKENIZER))
    draw = random.Random(3)
    text = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=1_000_000))
    began = time.process_time()
    ids, at = codec.encode(pa.array([text], pa.large_string()))
    assert time.process_time() - began < 60 and len(ids) > 100_000


def shards_of(frame):
    own = sharding.OWN
    return [(r["doc_id"], r["text"], r[own + "bytes"], r[own + "id"], r[own + "total"]) for r in frame.collect()]


@pytest.mark.parametrize("limit", [300, 2000, 10_000_000])
def test_shards_fit_and_cover(docs_of, awkward, limit):
    pairs = awkward + [(i, f"text {i} " * (i % 9)) for i in range(100, 500)]
    rows = shards_of(sharding.assign(docs_of(pairs), "doc_id", F.octet_length("text"), limit))
    assert sorted(((r[0], r[1]) for r in rows), key=repr) == sorted(pairs, key=repr)
    held = {}
    for doc_id, text, size, shard, total in rows:
        assert size == len((text or "").encode())
        held.setdefault(shard, []).append((size, total))
    for members in held.values():
        total = sum(s for s, _ in members)
        assert all(t == total for _, t in members)
        assert total <= limit or len([s for s, _ in members if s]) == 1


def test_only_buckets_too_large_are_split(docs_of):
    pairs = [(i, "x" * 100) for i in range(400)]
    rows = shards_of(sharding.assign(docs_of(pairs), "doc_id", F.octet_length("text"), 1500))
    totals = {r[3]: r[4] for r in rows}
    for shard in totals:  # a shard and the rest of its parent together were too large
        assert sum(t for s, t in totals.items() if s.startswith(shard[:-1])) > 1500
    assert not any(a != b and b.startswith(a) for a in totals for b in totals)


def test_a_hot_key_and_equal_rows_are_split(docs_of):
    pairs = [(7, f"{i:04d}" * 25) for i in range(200)] + [(7, "same" * 25)] * 90
    rows = shards_of(sharding.assign(docs_of(pairs), "doc_id", F.octet_length("text"), 1000))
    assert sorted((r[0], r[1]) for r in rows) == sorted(pairs)
    held = {}
    for _, _, size, shard, total in rows:
        held[shard] = held.get(shard, 0) + size
    assert max(held.values()) <= 1000


def test_shards_are_written_and_read_back(spark, clashing, awkward):
    docs = clashing([*awkward, *[(i, "abc" * 30) for i in range(100, 160)]])
    for limit in (500, 10_000_000):
        path = scratch_path(spark, "shards-test")
        assigned = sharding.assign(docs, "doc_id", F.octet_length("text"), limit)
        sharding.write(assigned, path)
        back = sharding.read(spark, path, docs.schema)
        assert sorted(shards_of(back), key=repr) == sorted(shards_of(assigned), key=repr)
        assert set(docs.columns) <= set(back.columns)
    assert sharding.assign(docs.limit(0), "doc_id", F.octet_length("text"), 10).count() == 0


def test_a_column_called_shard_is_kept(spark, docs_of):
    docs = docs_of([(i, "abc" * 30) for i in range(40)]).withColumn("shard", F.concat(F.lit("mine "), "doc_id"))
    path = scratch_path(spark, "shards-test")
    sharding.write(sharding.assign(docs, "doc_id", F.octet_length("text"), 500), path)
    back = sharding.read(spark, path, docs.schema)
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == {i: f"mine {i}" for i in range(40)}
    assert len({r[sharding.OWN + "id"] for r in back.collect()}) > 1


def test_cases_the_sql_leaves_out(docs_of):
    """Rows above the limit and repeated rows, by the shortest prefix that fits."""
    import hashlib
    pairs = [(i, "y" * (30 + i)) for i in range(60)] + [(3, "y" * 33)] * 2 + [(200, "z" * 5000)]
    rows = shards_of(sharding.assign(docs_of(pairs), "doc_id", F.octet_length("text"), 1000))
    assert sorted((r[0], r[1]) for r in rows) == sorted(pairs)
    bits = {i: f"{int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16):060b}" for i, _ in pairs}
    for doc_id, text, _, shard, total in rows:
        if doc_id == 200:
            assert total == 5000 and sum(r[3] == shard for r in rows) == 1
            continue
        for depth in range(61):
            held = sum(len(t) for i, t in pairs if bits[i].startswith(bits[doc_id][:depth]))
            if held <= 1000:
                break
        assert (shard, total) == (bits[doc_id][:depth], held)


PAGES = [(1, "http://a/x", "same"), (2, "http://a/y", "same"), (2, "http://a/y", "same"), (3, "http://a/z z\r\n", "other " * 4000),
         (4, None, None), (5, "http://e", ""), (None, "http://n", "same"), (None, "http://m", "lonely"), (6, "u", "é\U0001f600\r\n\r\nWARC/1.1\r\n")]


def test_archives(spark):
    pages = spark.createDataFrame(PAGES + [(100 + i, f"http://h/{i}", f"<p>page {i}</p>" * 20) for i in range(300)],
                                  "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    index = warc.write(pages.coalesce(2), folder, warc.Settings(archive_bytes=4000, sample_bytes=2000))
    rows = warc.read(warc.archives(index), payloads=True).collect()
    assert len(rows) == len(PAGES) + 300
    by_id = {}
    for r in rows:
        by_id.setdefault(r["page_id"], []).append(r)
    same = [by_id[1][0], *by_id[2], next(r for r in by_id[None] if r["url"] == "http://n")]
    assert [r["record_type"] for r in same] == ["revisit", "response", "response", "revisit"]
    assert [r["refers_to"] for r in same] == [2, None, None, 2] and {r["payload_bytes"] for r in same} == {4}
    assert (by_id[4][0]["record_type"], by_id[4][0]["refers_to"], by_id[5][0]["record_type"]) == ("revisit", 5, "response")
    assert bytes(by_id[6][0]["payload"]).decode() == PAGES[-1][2] and by_id[3][0]["url"] == "http://a/z%20z%0D%0A"
    entries = index.collect()
    assert len(entries) == len(rows) and len({e["file"] for e in entries}) > 2
    with_dictionary = 0
    for entry in entries[:40]:  # every record can be read alone, with the archive's own dictionary
        with open(entry["file"].removeprefix("file://"), "rb") as file:
            magic, size = struct.unpack("<II", file.read(8))
            words = None
            if magic == warc.DICTIONARY_FRAME:
                words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(file.read(size), 1 << 24))
            with_dictionary += words is not None
            file.seek(entry["offset"])
            record = zstandard.ZstdDecompressor(dict_data=words).decompress(file.read(entry["length"]))
            assert record.startswith(b"WARC/1.1\r\n") and entry["record_id"].encode() in record
    assert with_dictionary >= 30  # only an archive of a few short records has none
    assert warc.write(pages.limit(0), folder).count() == 0


def test_small_payloads_stay_whole(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    index = warc.write(pages, scratch_path(spark, "warc-test"), warc.Settings(least_payload=5))
    assert {r["record_type"] for r in warc.read(warc.archives(index)).collect()} == {"response"}
