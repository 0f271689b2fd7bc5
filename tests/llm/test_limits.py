"""Inputs that once broke an operator: large values, doubling constants, many quotes."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowforge.llm import packing, secret_scan, topk
from flowforge.llm.queries import QUERIES

LONG = np.iinfo(np.int64)


def brute_top_k(rows, queries, k=5):
    out = []
    for q in queries:
        score = {i: min(max(sum(int(a) * int(b) for a, b in zip(rows[q], v)), LONG.min), LONG.max)
                 for i, v in rows.items() if i != q}
        out += [(q, n + 1, i, score[i]) for n, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:k])]
    return out


@pytest.mark.parametrize("large", [3e9, 4e12, 1e30])
def test_top_k_of_large_values_is_exact(spark, large):
    rng = np.random.default_rng(1)
    rows = {i: rng.integers(-1000, 1000, 6).astype(float) for i in range(300)}
    for i in (50, 77, 100, 101):
        rows[i] = rows[i] * large
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id bigint, v array<double>")
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), 5, tile=64, block=3).collect()
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)
    assert found == brute_top_k(rows, range(0, 300, 50))


def test_top_k_query_takes_large_components(spark, tmp_path):
    rows = {i: [float(i % 7) - 3, 0.5 * (i % 5), 1.0] for i in range(60)}
    rows[50] = [3e9, 1e30, -2.0]
    rows[51] = [-3e9, -1.0, 1e30]
    spark.createDataFrame([(i, v) for i, v in rows.items()], "vec_id bigint, embedding array<double>") \
        .write.parquet(str(tmp_path / "embeddings.parquet"))
    whole = {i: [int(np.floor(256 * c)) for c in v] for i, v in rows.items()}
    got = QUERIES["op10_nra_top_k"](spark, str(tmp_path)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_top_k(whole, (0, 50))


def test_doubling_constants_end():
    lines = ["token0 = 'a1B2c3D4e5F6'"] + [f"token{i} = token{i - 1} + token{i - 1}" for i in range(1, 41)]
    begin = time.process_time()
    spans = secret_scan.find_spans("\n".join(lines))
    assert time.process_time() - begin < 1
    assert [s for s in spans if s[1] == "flow"] == [(10, "flow", 22)]


def test_many_escaped_quotes_end():
    text = "\n".join(f'secret_{i} = "k{i}\\"Zz9{i}qW8"' for i in range(20_000))
    begin = time.process_time()
    spans = secret_scan.find_spans(text)
    assert time.process_time() - begin < 20
    assert sum(s[1] == "flow" for s in spans) >= 20_000


def test_spans_apart_agree_with_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        new, old = ({(a, a + rng.randint(1, 9)) for a in rng.sample(range(60), 6)} for _ in range(2))
        assert secret_scan.apart(new, old) == {p for p in new if not any(p[0] < b and a < p[1] for a, b in old)}


def test_base_spans_agree_with_the_plain_patterns(spark):
    """Every document of a given table against the three patterns."""
    patterns = [("assign", re.compile("(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
                                      "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?"
                                      "([A-Za-z0-9+/_.=-]+)"), 1, 8),
                ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op6_secret_scan"](spark, "/root/testdata/sf0.01").collect()}
    hits = 0
    for d, text in rows:
        want = sorted((m.start(), n, m.end()) for n, (_, p, g, least) in enumerate(patterns)
                      for m in p.finditer(text or "") if len(m[g]) >= least)
        counts = [sum(x[1] == n for x in want) for n in range(3)]
        assert [got[d][c] for c in ("n_assign", "n_access", "n_hex")] == counts
        spans = ",".join(f"{patterns[n][0]}:{a}:{b}" for a, n, b in want)
        assert got[d]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        hits += len(want)
    assert hits > 5


def test_best_first_orders_as_a_sort():
    rng = np.random.default_rng(2)
    for n in (0, 1, 31, 33, 500, 4000):
        score = rng.integers(-2, 12, n).astype(float)
        want = [int(i) for i in np.argsort(-score, kind="stable") if score[i] > 0]
        assert list(packing.best_first(score.copy())) == want
