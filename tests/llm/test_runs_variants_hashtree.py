import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowforge.llm import hashtree, queries, runs, variants

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


# --- periodic runs ---------------------------------------------------------

def brute_runs(words, least=24, times=3):
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                # a stretch is listed under its smallest period
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted((a, size, q) for (a, size), q in out.items())


def brute_collapsed(words, found):
    gone = {i for a, size, q in found for i in range(a + q, a + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4), st.sampled_from([(24, 3), (4, 3), (1, 4)]))
def test_runs_agree_with_brute_force(texts, sizes):
    least, times = sizes
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    ids = np.array([x for t in texts for x in t], np.int64)
    of, start, size, period = runs.find_runs(ids, first, least, times)
    got = sorted(zip(of.tolist(), (start - first[of]).tolist(), size.tolist(), period.tolist()))
    assert got == sorted((k, *r) for k, t in enumerate(texts) for r in brute_runs(t, least, times))


def test_nested_and_long_runs():
    rng = random.Random(7)
    unit = [rng.randrange(5) for _ in range(37)]
    words = [9] + unit * 9 + [0, 1] * 40 + [rng.randrange(3) for _ in range(400)] + [4] * 100 + (unit + [2] * 30) * 4
    first = np.array([0, len(words)])
    of, start, size, period = runs.find_runs(np.array(words), first, 24, 3)
    assert sorted(zip(start.tolist(), size.tolist(), period.tolist())) == brute_runs(words)
    with pytest.raises(ValueError):
        runs.find_runs(np.array(words), first, 24, 2)


def test_collapse_keeps_rows_and_columns(spark, docs, clashing, empty):
    lines = "one two three four\n" * 8 + "end"
    more = docs.union(spark.createDataFrame([(11, lines, "en", "a", 1), (11, lines, "en", "a", 1),
                                             (12, "na " * 5000, None, None, None)], docs.schema))
    for r in runs.collapse_runs(more).collect():
        words = WORD.findall(r["text"] or "")
        found = brute_runs(words) if len(words) < 6000 else []
        assert [tuple(x) for x in r["runs"]] == found and r["n_runs"] == len(found) and r["n_words"] == len(words)
        assert r["collapsed_text"] == brute_collapsed(words, found)
    out = runs.collapse_runs(clashing)
    assert out.count() == clashing.count()
    assert set(out.columns) == {*clashing.columns, "n_runs", "runs", "collapsed_text"}
    assert runs.collapse_runs(empty).collect() == []


def test_periodic_run_query(spark, docs, tmp_path):
    """The query with its planted repeats against plain Python."""
    rows = [(i, " ".join(f"w{(i * k) % 11}" for k in range(n)), "en", "a", 0) for i, n in enumerate([0, 1, 30, 80, 200] * 9)]
    docs.union(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for d, text in spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", "text").collect():
        w = WORD.findall(text or "")
        h = zlib.crc32(str(d).encode())
        g, n = h // 10, len(w)
        if d is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        found = brute_runs(w) if n < 6000 else []
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        digest = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        want.append((d, len(found), *best, 1000 * best[1] // best[2] if found else None, digest,
                     hashlib.sha256(brute_collapsed(w, found).encode()).hexdigest()))
    got = queries.op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r["n_runs"] > 0 for r in got) > 3


# --- spelling variants -----------------------------------------------------

def brute_variants(rows, delete_every=None):
    n = Counter()
    for d, text in rows:
        for w in LETTERS.findall(text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{d}:{w}".encode())
            if delete_every and d is not None and h % delete_every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [] for w in n}
    for a, b in itertools.combinations(sorted(n), 2):
        if variants.one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def some_texts(seed, count, letters, stems):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(stems)]
    out = []
    for d in range(count):
        words = []
        for _ in range(60):
            w = rng.choice(base[:1 + int(len(base) * rng.random() ** 3)])
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice(letters), w[k] + rng.choice(letters)]) + w[k + 1:]
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((d, rng.choice([" ", ", ", "9", "\n"]).join(words)))
    return out


@pytest.mark.parametrize("node,asks,letters", [(4096, 1 << 16, "abcdefghéñ×"), (8, 16, "abcqü"),
                                               (2, 3, "aq")])
def test_variants_agree_with_brute_force(spark, monkeypatch, node, asks, letters):
    """Small nodes force deep routing, blocks of full paths and copies."""
    monkeypatch.setattr(variants, "NODE", node)
    monkeypatch.setattr(variants, "ASKS", asks)
    chain = "ringing " * 5 + "ringings " * 40 + "ringingst " * 300
    rows = some_texts(node, 120, letters, 25) + [(None, chain), (None, "unrelated " * 6), (500, None), (501, ""),
                                                (502, ("x" * 100 + " ") * 30 + ("x" * 101 + " ") * 5)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = variants.spelling_variants(table, delete_every=7).collect()
    want = brute_variants(rows, 7)
    assert sorted(map(tuple, got)) == want
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)


def test_variants_edges(spark, docs, clashing, empty):
    assert variants.spelling_variants(empty).collect() == []
    assert variants.spelling_variants(docs.where("text is null")).collect() == []
    again = clashing.union(clashing).union(clashing)
    assert sorted(map(tuple, variants.spelling_variants(again).collect())) == \
        brute_variants(again.select("doc_id", "text").collect())


def test_checksums_are_joined_rightly():
    words = [b"", b"a", "été".encode(), b"long" * 20]
    prefix = [b"1:", b"-77:", b"123456789:"]
    row, word = (np.array(x) for x in zip(*itertools.product(range(3), range(4))))
    got = variants._checksums(np.array([zlib.crc32(p) for p in prefix], np.uint32), row, words, word)
    assert got.tolist() == [zlib.crc32(prefix[i] + words[j]) for i, j in zip(row, word)]


def test_one_edit():
    assert variants.one_edit("abc", "abd") and variants.one_edit("abc", "ab") and variants.one_edit("abc", "xabc")
    assert not variants.one_edit("abc", "abc") and not variants.one_edit("abc", "acb") and not variants.one_edit("a", "abc")


# --- hash tree -------------------------------------------------------------

def test_shards_are_whole_and_even(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 5).cast("int")).alias("text"))
    out = hashtree.number_shards(rows, hashtree.even_tree(40), hashtree.even_tree(41)).toPandas()
    assert len(out) == 20_000 and set(out["shard"]) == set(range(40)) and set(out["law"]) == {"key"}
    sizes = out.groupby("shard")["slot"].agg(["size", "min", "max", "nunique"])
    assert (sizes["min"] == 0).all() and (sizes["max"] == sizes["size"] - 1).all() and (sizes["nunique"] == sizes["size"]).all()
    assert 380 < sizes["size"].min() and sizes["size"].max() < 620
    moved = out[out["shard"] != out["grown_shard"]]
    assert set(moved["grown_shard"]) == {40} and 350 < len(moved) < 640


def test_movement_stays_in_changed_subtrees(spark):
    keys = spark.range(30_000).select(F.col("id").alias("doc_id"))
    tree = hashtree.even_tree(40)
    heavier = [s._replace(weight=2.0) if s.shard == 7 else s for s in tree]  # rack 1 of region 0
    both = hashtree.place(hashtree.place(keys, tree), heavier, name="then").where("shard <> then").collect()
    assert both
    for r in both:
        a, b = tree[r["shard"]], tree[r["then"]]
        assert (b.region == 0 and a.region == 1) or (b.rack == 1 and a.region == 0 and a.rack != 1) or b.shard == 7
    gone = [s._replace(weight=0.0) if s.shard == 7 else s for s in tree]
    lost = hashtree.place(hashtree.place(keys, tree), gone, name="then").where("then = 7").count()
    assert lost == 0
    heavy = [s._replace(weight=3.0) if s.shard < 20 else s for s in tree]
    share = hashtree.place(keys, heavy).where("shard < 20").count() / 30_000
    assert abs(share - 0.75) < 0.01


def test_shard_rows_hot_and_odd(spark, monkeypatch, docs, clashing, empty):
    monkeypatch.setattr(hashtree, "RANKED", 50)
    monkeypatch.setattr(hashtree, "CHUNK", 7)
    same = spark.range(500).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = docs.select("doc_id", "text").union(same)
    tree, grown = hashtree.even_tree(40), hashtree.even_tree(41)
    out = hashtree.number_shards(rows, tree, grown)
    got = out.toPandas()
    assert len(got) == rows.count()
    by = got.groupby("shard")["slot"]
    assert (by.nunique() == by.size()).all() and (by.max() == by.size() - 1).all() and (by.min() == 0).all()
    texts = [(d, t or "") for d, t in rows.collect()]
    want = Counter((d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in texts)
    have = out.groupBy("doc_id", "size", "text_crc32").count().collect()
    assert {tuple(r)[:3]: r["count"] for r in have} == want
    again = hashtree.number_shards(rows.repartition(13), tree, grown)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))
    assert sorted(hashtree.number_shards(clashing, tree).columns) == sorted(out.columns)
    assert hashtree.number_shards(empty, tree).collect() == []


def test_written_shards(spark, docs, tmp_path):
    tree = hashtree.even_tree(40)
    hashtree.write_shards(docs, f"{tmp_path}/shards", tree, files=3)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(str, back.select(*docs.columns, "shard").collect())) == \
        sorted(map(str, hashtree.place(docs, tree).select(*docs.columns, "shard").collect()))


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_spelling_variants", "op13_hash_tree"])
def test_queries_agree_with_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.execute(queries.ORACLE_SQL[name])
    names = sorted(got.columns)
    assert sorted(c[0] for c in want.description) == names
    order = [[c[0] for c in want.description].index(n) for n in names]
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == \
        sorted(str(tuple(row[i] for i in order)) for row in want.fetchall())
