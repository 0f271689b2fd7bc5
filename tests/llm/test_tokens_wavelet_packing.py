import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowforge.llm import packing, wavelet
from flowforge.llm.common import string_bytes
from flowforge.llm.tokens import MemoEncoder

ODD = ["", " ", "a", "it's a test's  end", " lead", "trail ", "x\n\ny", "tab\tx y", "ÀÉ İstanbul ß",
       "a1b2 33 <|endoftext|> x", "don't 'quoted' (x) [y], z...", "a  b", "漢字 　 かな", "a\n b",
       "\n", "a\r\nb", "word- -word", "“quote” —dash", "one\ntwo three.\nEnd", "é x ́y", "Kelvin K"]


def plain(name, texts, end):
    tok = Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    return [e.ids + [end] for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_memo_encoder_agrees_with_the_library(name, spaces):
    enc = MemoEncoder(P.path(name), spaces)
    for _ in range(2):  # cold, then from the memo
        ids, n = enc.encode(*string_bytes(pa.array(ODD)), 7)
        at = np.cumsum(n) - n
        assert [ids[a:a + k].tolist() for a, k in zip(at, n)] == plain(name, ODD, 7)
    enc.limit = 3  # forgets between slices
    ids, n = enc.encode(*string_bytes(pa.array(ODD)), 7)
    assert ids.tolist() == sum(plain(name, ODD, 7), [])


SPECIAL = ["<|endoftext|>", "one <|endoftext|> two", "a<|endoftext|>b<|startoftext|>", "plain text", "", "x <|ENDOFTEXT|> y",
           "<|endoftext|", "|> <|", "  two\n\n<|startoftext|> \n", "été<|endoftext|>漢字", "<|endof", "text|>"]


def unmodified(name, texts, end):
    tok = Tokenizer.from_file(P.path(name))
    return [tok.encode(t, add_special_tokens=False).ids + [end] for t in texts]


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_special_strings_get_the_librarys_ids(name, spaces):
    from flowforge.llm.tokens import encoder
    texts = SPECIAL + ODD + SPECIAL
    expect = unmodified(name, texts, 7)
    assert 50256 in expect[1] or 49407 in expect[1]
    for _ in range(2):
        ids, n = encoder(P.path(name), spaces).encode(*string_bytes(pa.array(texts)), 7)
        at = np.cumsum(n) - n
        assert [ids[a:a + k].tolist() for a, k in zip(at, n)] == expect


def test_special_strings_in_the_queries(spark, tmp_path):
    from flowforge.llm.queries import QUERIES
    spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id bigint, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    rows, start = QUERIES["op8_wavelet_ids"](spark, str(tmp_path)).orderBy("doc_id").collect(), 0
    for r, ids in zip(rows, unmodified("byte_bpe_50k.json", SPECIAL, 2), strict=True):
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    total = {r["doc_id"]: r["doc_tokens"] for r in QUERIES["op9_retrieval_packing"](spark, str(tmp_path)).collect()}
    assert total == {i: len(ids) for i, ids in enumerate(unmodified("word_bpe_49k.json", SPECIAL, 1))}


def test_wavelet_matrix_access_count_locate():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 513, 3000):
        ids = rng.integers(0, 50, n).astype(np.uint16) * 997
        data = wavelet.shard_bytes([1, None], np.array([n, 0]), ids)
        names, counts, m = wavelet.open_shard(data)
        assert names == [1, None] and counts.tolist() == [n, 0]
        assert (m.decode() == ids).all()
        for i in range(0, n, max(1, n // 20)):
            assert m.access(i) == ids[i]
        for v in np.unique(ids)[:4].tolist() + [65535]:
            assert m.count(v) == (ids == v).sum()
            assert m.count(v, n // 3, n // 2) == (ids[n // 3:n // 2] == v).sum()
            assert m.locate(v) == np.flatnonzero(ids == v).tolist()


def test_wavelet_round_trip(spark, docs, clashing, empty, tmp_path):
    expect = sorted(((d, t or "") for d, t in docs.select("doc_id", "text").collect()),
                    key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    ids = plain("byte_bpe_50k.json", [t for _, t in expect], 2)
    for name, df in (("a", docs), ("b", clashing)):
        wavelet.write_shards(df, str(tmp_path / name), P.path("byte_bpe_50k.json"), 2, shard_ids=500)
        rows = wavelet.read_documents(spark.read.parquet(str(tmp_path / name))).orderBy("start").collect()
        assert [r["doc_id"] for r in rows] == [d for d, _ in expect]
        got = [np.frombuffer(r["ids"], "<u4").tolist() for r in rows]
        assert sorted(map(tuple, got)) == sorted(map(tuple, ids))
        assert [r["start"] for r in rows] == (np.cumsum([len(g) for g in got]) - [len(g) for g in got]).tolist()
    wavelet.write_shards(empty, str(tmp_path / "e"), P.path("byte_bpe_50k.json"), 2)
    assert wavelet.read_documents(spark.read.parquet(str(tmp_path / "e"))).count() == 0


def check_packing(rows, expect, width):
    sequences = {}
    for sequence, offset, length in ((r["sequence_id"], r["offset"], r["length"]) for r in rows):
        sequences.setdefault(sequence, []).append((offset, length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == width or at & (at - 1) == 0 and at < width
    pieces = sorted(len(r["ids"]) // 4 for r in rows)
    assert sum(pieces) == sum(map(len, expect))
    # every id once: pieces in order of place rebuild the documents
    whole, at = [], {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert len(r["ids"]) == 4 * r["length"]
        key = (r["doc_id"], r["doc_tokens"], r["start"])
        at.setdefault(key, []).append(np.frombuffer(r["ids"], "<u4").tolist())
    done = sum(len(p) for ps in at.values() for p in ps)
    assert done == sum(map(len, expect))
    return at


def test_packing_round_trip(docs, clashing, empty):
    texts = [t or "" for t, in docs.select("text").collect()]
    expect = plain("word_bpe_49k.json", texts, 1)
    for df in (docs, clashing):
        at = check_packing(packing.pack(df, P.path("word_bpe_49k.json"), 1, width=64, shard_ids=3000).collect(), expect, 64)
        one = sorted(((k[2], p) for k, ps in at.items() if k[0] == 4 for p in ps))
        assert sum((p for _, p in one), []) == expect[3]
    assert packing.pack(empty, P.path("word_bpe_49k.json"), 1).count() == 0


def test_packing_statistics_and_neighbours(docs):
    tokens = packing.tokenized(docs, P.path("word_bpe_49k.json"), 1)
    df, n, mean = packing.term_statistics(tokens)
    ids = plain("word_bpe_49k.json", [t or "" for t, in docs.select("text").collect()], 1)
    assert n == len(ids) and df[1] == n and mean == pytest.approx(np.mean([len(i) for i in ids]))
    for term in (5, 320, 1125):
        assert df[term] == sum(term in i for i in ids)
    # a document is placed beside its best match, not beside the next one
    a, b, c = np.array([10, 11, 12, 13, 1]), np.array([20, 21, 22, 23, 1]), np.array([10, 11, 12, 14, 1])
    p = packing.Packer(64, np.ones(1 << 16, np.float32), 5.0)
    p.shard([("a", a), ("b", b), ("c", c)])
    assert [x[0] for x in p.open] == ["a", "c", "b"]


def test_packing_finds_neighbours_in_other_partitions(spark):
    rng = np.random.default_rng(2)
    words = ["river", "engine", "violin", "planet", "cheese", "castle", "doctor", "window", "garden", "soldier"]
    common = ["the", "of", "and", "in", "was", "that", "with", "this", "from", "they"]
    rows = [(10 * part + k, " ".join([w] * 12 + [f"{x}" for x in rng.permutation(common)]))
            for part in range(8) for k, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartitionByRange(8, "doc_id")
    assert df.rdd.getNumPartitions() == 8
    got = packing.pack(df, P.path("word_bpe_49k.json"), 1, width=64, shard_ids=400).collect()
    order = [r["doc_id"] % 10 for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])) if r["start"] == 0]
    assert sorted(order) == sorted(d % 10 for d, _ in rows)
    # documents of one word stand together although each partition holds one
    assert sum(a == b for a, b in zip(order, order[1:])) >= 0.75 * len(order)


def test_packing_ranges_are_cut_alike_at_every_size(spark):
    rows = spark.range(24_000).select(F.col("id").alias("doc_id"), F.expr(
        "unhex(repeat('0102', cast(if(id = 7, 70000, 10 + id % 50) as int)))").alias("ids"))
    told = {n: {r[0] for r in packing.telling(rows.where(F.col("doc_id") < n), 1 << 21).select("doc_id").collect()}
            for n in (15_000, 24_000)}
    assert told[15_000] == {d for d in told[24_000] if d < 15_000}
    assert 7 in told[15_000] and 10 < len(told[15_000]) < 150


def test_packing_scores_with_all_terms_of_the_seed():
    seed = np.arange(100, 140).repeat(3)
    light = np.array([200])  # the only term that the other document shares, and the seed's lightest
    index = packing.Index([np.concatenate([seed, light]), np.array([200, 300, 301]), np.array([400])],
                          np.where(np.arange(1 << 16) == 200, 0.1, 5).astype(np.float32), 50.0)
    score = index.scores(0)
    assert score[1] > 0 and score[2] == 0


def test_wavelet_query_digest(spark):
    from flowforge.llm.queries import QUERIES
    got = QUERIES["op8_wavelet_ids"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    ids, start = plain("byte_bpe_50k.json", [d["text"] for d in docs], 2), 0
    for r, d, i in zip(got, docs, ids, strict=True):
        assert tuple(r) == (d["doc_id"], start, len(i), zlib.crc32(np.array(i, "<u4").tobytes()))
        start += len(i)


def test_packing_query_digest(spark):
    from flowforge.llm.queries import QUERIES
    got = QUERIES["op9_retrieval_packing"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    for d, ids in zip(docs, plain("word_bpe_49k.json", [d["text"] for d in docs], 1), strict=True):
        at = 0
        for r in sorted((r for r in got if r["doc_id"] == d["doc_id"]), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    length = {}
    for r in got:
        length[r["sequence_id"]] = length.get(r["sequence_id"], 0) + r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in length.values())
