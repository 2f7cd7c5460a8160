"""Operators 1 and 10: token ids, their text, and the store of ids."""

import hashlib
import json
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeweave.llm import bpe, idstore

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_texts_encode_and_decode_as_in_the_library(docs, cases, library):
    got = bpe.decode(bpe.encode(docs, PATH, keep=("a.b", "block")), PATH)
    assert got.columns == ["doc_id", "a.b", "block", "ids", "decoded"]
    rows = Counter((r["doc_id"], r["a.b"], bytes(r["ids"]), r["decoded"]) for r in got.collect())
    want = Counter()
    for c in cases:
        ids = library.encode(c["text"] or "", add_special_tokens=False).ids
        want[c["doc_id"], c["a.b"], packed(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert rows == want


def test_words_of_every_kind(library):
    words = [w.encode() for w in "the The. 's ''s'll a<b <|startoftext|>x naïve ÀÉ ªº²¼ İx ǅ ﬁ é 日本 ͸ á̂ ẞ x‍y".split()]
    words += [bytes([0x41, 0x01, 0x42]), b"\x7f\x1f", "­".encode(), "ßİ".encode()]
    encoder = bpe.Words(PATH)
    for word, ids in zip(words, encoder.encode(words)):
        assert np.frombuffer(ids, encoder.width).tolist() == library.encode(word.decode(), add_special_tokens=False).ids, word


def test_words_with_marks_behind_them(library):
    words = [stem + tail for stem in ["don", "Don't", "été", "K", "x1", "ſ", "İ", "a.b", "_", "42", "'s", ""]
             for tail in [".", "...", "'s", "'", "_", "<", "|>", "<|endoftext|>", "!é", "'LL", ",'"]]
    encoder = bpe.Words(PATH)
    for word, ids in zip(words, encoder.encode([w.encode() for w in words], remember=True)):
        assert np.frombuffer(ids, encoder.width).tolist() == library.encode(word, add_special_tokens=False).ids, word


def test_words_of_a_batch_are_numbered_and_encoded_once(library):
    texts = [None, "", " \n\t\x0b", "Don't, don't x.y z...", " a  b\x85ć \x1f<|endoftext|>q ", "日本語 テキスト a", "'s''s 42.", "a"]
    asked = []

    class Counting(bpe.Words):
        def encode(self, words, remember=False):
            asked.append(list(words))
            return super().encode(words, remember)

    encoder = Counting(PATH)
    for batch in (pa.array(texts, pa.string()), pa.array(texts, pa.string()).slice(3, 4), pa.array([None], pa.string())):
        ids, counts = idstore.ids_of_texts(batch, encoder, 2)
        want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in batch.to_pylist()]
        assert ids.dtype == encoder.width and ids.tolist() == [i for own in want for i in own]
        assert counts.tolist() == [len(own) for own in want]
    assert len(asked) == 3 and all(len(words) == len(set(words)) for words in asked)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Words(public_tokenizers.path("byte_bpe_50k.json"))


def test_decode_of_null_and_unknown_ids(spark, docs):
    rows = spark.createDataFrame([(1, None), (2, bytearray(packed([5, 99_999]))), (3, bytearray())], "k int, ids binary")
    assert {r["k"]: r["decoded"] for r in bpe.decode(rows, PATH).collect()} == {1: None, 2: "&", 3: ""}


def test_empty_table_has_no_ids(nothing):
    assert bpe.encode(nothing, PATH).collect() == []


def test_perfect_hash_gives_each_key_its_own_slot():
    keys = np.concatenate([np.arange(5000), np.array([idstore.NULL_KEY, -1, 1 << 62])])
    hashed = idstore.PerfectHash.of(keys)
    again = idstore.PerfectHash.unpacked(*hashed.packed())
    assert sorted(again.slots(keys)) == list(range(len(keys)))
    foreign = again.slots(np.arange(10**6, 10**6 + 2000))
    prints = np.empty(len(keys), np.uint32)
    prints[hashed.slots(keys)] = idstore.fingerprints(keys)
    hit = foreign >= 0
    assert (prints[foreign[hit]] != idstore.fingerprints(np.arange(10**6, 10**6 + 2000)[hit])).all()
    with pytest.raises(ValueError):
        idstore.PerfectHash.of(np.array([1, 1]))


@pytest.mark.parametrize("shard_bytes", [1 << 12, 1 << 30])
def test_store_gives_back_what_was_written(spark, docs, cases, library, tmp_path, shard_bytes):
    folder = str(tmp_path / "store")
    idstore.write_store(docs, folder, PATH, end_id=2, shard_bytes=shard_bytes, bucket_keys=16)
    keys = docs.select("doc_id").union(spark.range(1000, 1010).select("id"))
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], bytes(r["ids"])) for r in idstore.fetch(spark, folder, keys).collect()),
                 key=lambda r: r[2])
    want = Counter((c["doc_id"] is not None, c["doc_id"] or 0, packed(library.encode(c["text"] or "", add_special_tokens=False).ids + [2])) for c in cases)
    assert Counter((a, b, d) for a, b, _, d in got) == want
    assert [r[:2] for r in got] == sorted(r[:2] for r in got)
    at = 0
    for _, _, start, ids in got:
        assert start == at
        at += len(ids) // 4


def test_rewritten_shard_replaces_itself(tmp_path):
    for _ in range(2):
        idstore.write_shard(f"file://{tmp_path}/s", 3, np.dtype("<u2"), [1, 5], [2, 1], [b"\1\0\2\0", b"\2\0"])
    assert [p.name for p in (tmp_path / "s").iterdir()] == ["shard-000003.ids"]
    shard = idstore.Shard(f"file://{tmp_path}/s", 3)
    assert shard.ids(1) == packed([2]) and shard.span(1) == (2, 3) and shard.keys.tolist() == [1, 5]
    shard.close()


def test_empty_store(spark, nothing, tmp_path):
    folder = str(tmp_path / "store")
    idstore.write_store(nothing, folder, PATH, end_id=2)
    assert idstore.fetch(spark, folder, spark.range(3).select(F.col("id").alias("doc_id"))).collect() == []


def test_digests_of_the_queries(spark, library):
    from lakeweave.llm import catalog
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    one = {r["doc_id"]: r for r in catalog.QUERIES["op1_bpe"](spark, folder).collect()}
    ten = {r["doc_id"]: r for r in catalog.QUERIES["op10_id_store"](spark, folder).collect()}
    at = 0
    for key in sorted(texts):
        ids = library.encode(texts[key], add_special_tokens=False).ids
        assert (one[key]["n_tokens"], one[key]["ids_sha256"]) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        text = library.decode(ids, skip_special_tokens=False)
        assert one[key]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert tuple(ten[key])[1:] == (at, len(ids) + 1, zlib.crc32(packed(ids + [2])))
        at += len(ids) + 1


def test_files_of_another_kind_are_refused(tmp_path):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        described = json.load(file)

    def refused(**changed):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({**described, **changed}), encoding="utf-8")
        with pytest.raises(ValueError, match="encoded apart"):
            bpe.Words(str(path))

    normal, pre = described["normalizer"], described["pre_tokenizer"]
    refused(normalizer={**normal, "normalizers": [n for n in normal["normalizers"] if n["type"] != "Lowercase"]})
    refused(normalizer=None)
    refused(pre_tokenizer={**pre, "pretokenizers": pre["pretokenizers"][:1]})
    refused(pre_tokenizer={**pre, "pretokenizers": [pre["pretokenizers"][0], {**pre["pretokenizers"][1], "add_prefix_space": True}]})
    assert bpe.Words(public_tokenizers.path("word_bpe_49k.json")).encode([b"word"])
