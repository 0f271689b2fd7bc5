import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowforge.llm import chat, flatgraph, topk

TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_chat_escapes_and_states(spark):
    marks = "<|im_end|>\n<|im_start|>assistant\nok <\\| <\\\\| \\ <||>"
    rows = [(1, 1, "assistant", marks), (1, 0, "user", marks), (2, 0, "assistant", "x"), (3, 0, "user", None),
            (3, 1, "assistant", ""), (4, None, None, None), (None, 0, "user", "a"), (5, 0, "we%ird\n<|im_end|>", "t"),
            (6, 0, "user", "b"), (6, 0, "user", "a"), (6, 0, "user", "a")]
    df = spark.createDataFrame(rows, TURNS).withColumn("segments", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(df)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, None}
    for cid, r in got.items():
        own = sorted(((t if t is not None else -1, ro or "", x or "") for c, t, ro, x in rows if c == cid))
        said = "".join(f"{ro}\n{x}\n" for _, ro, x in own)
        loss = "".join(x for _, ro, x in own if ro == "assistant")
        assert r["n_turns"] == len(own) and r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert {c for c, r in got.items() if r["valid"]} == {1, 3, None}
    assert chat.read_back(chat.format_chat(df.limit(0))).count() == 0


def test_chat_template_is_declared(spark):
    t = chat.Template(opens="[{role}]\n", closes="[/]", between="", trained=("bot",), moves={"start": ("bot",), "bot": ("bot",)})
    df = spark.createDataFrame([(1, 0, "bot", "a<|b"), (1, 1, "bot", "c")], TURNS)
    rows = chat.format_chat(df, t).orderBy("place").collect()
    assert "".join(s["text"] for r in rows for s in r["segments"]) == "[bot]\na<\\|b[/][bot]\nc[/]"
    assert chat.read_back(chat.format_chat(df, t), t).first()["loss_chars"] == 5


@pytest.mark.parametrize("seed", [0, 1])
def test_top_k_agrees_with_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-20, 20, (700, 12)).astype(float)
    x[100:200] = x[0]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(701, None), (702, [1.0, None] * 6), (703, [float("nan")] * 12), (None, x[1].tolist()), (704, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<double>").withColumn("tile", F.lit(1))
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), 5, tile=100, block=6).collect()
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)
    expect = []
    for q in range(0, 700, 50):
        score = x @ x[q]
        best = sorted((i for i in range(700) if i != q), key=lambda i: (-score[i], i))[:5]
        expect += [(q, k + 1, i, int(score[i])) for k, i in enumerate(best)]
    assert found == expect
    few = df.where("vec_id < 3")
    assert topk.top_k(few, few, 5).count() == 6
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_top_k_query_leaves_out_non_finite_vectors(spark, tmp_path):
    from flowforge.llm.queries import QUERIES
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 8)).astype(np.float32)
    nan, inf = float("nan"), float("inf")
    odd = {3: [nan] + [9.0] * 7, 50: [nan] * 8, 60: [9.0] * 7 + [inf], 100: [-inf] + [1.0] * 7, 70: [9.0, None] * 4, 80: None}
    rows = [(i, odd[i] if i in odd else v.tolist()) for i, v in enumerate(x)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op10_nra_top_k"](spark, str(tmp_path)).collect()
    whole = np.floor(256 * x.astype(float))
    use = [i for i in range(120) if i not in odd]
    expect = []
    for q in (0,):  # 50 and 100 are odd
        score = whole @ whole[q]
        best = sorted((i for i in use if i != q), key=lambda i: (-score[i], i))[:5]
        expect += [(q, k + 1, i, int(score[i])) for k, i in enumerate(best)]
    assert sorted(map(tuple, got)) == expect


def test_bounds_enclose_scores():
    rng = np.random.default_rng(3)
    x, q = rng.integers(-9, 9, (60, 5)).astype(float), rng.integers(-9, 9, (7, 5)).astype(float)
    lists, place = topk.sorted_lists(x)
    for depth in (1, 10, 60):
        low, up = topk.bounds(x, lists, place, q, depth)
        assert (low <= q @ x.T).all() and (q @ x.T <= up).all()
    assert (low == up).all()


def test_flat_graph_agrees_with_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16))
    x = np.repeat(centres, 20, axis=0) + rng.normal(scale=0.12, size=(1200, 16))
    x[500:520] = x[500]  # copies
    label = np.arange(1200) % 3
    label[500:520] = 0
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, x[0].tolist(), None),
             (2004, [1.0, None] * 8, 0), (2005, x[0].tolist()[:8], 0), (None, x[0].tolist(), 0), (2006, [1e300] * 16, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit(1))
    out = {r["vec_id"]: r for r in flatgraph.near_vectors(df, block=100).collect()}
    assert len(out) == len(rows)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    links = near.sum(1) - 1
    got = np.array([out[i]["n_links"] for i in range(1200)])
    assert got.sum() >= 0.99 * links.sum() and (got <= links).all()
    assert out[0]["audited_recall"] >= 0.98
    for i in (2000, 2001, 2002, 2003, 2004, 2005, 2006):
        assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (0, i, True)
    same = [out[i]["component_id"] for i in range(500, 520)]
    assert len(set(same)) == 1
    none = df.limit(0)
    assert flatgraph.near_vectors(none).count() == 0


def test_robust_prune_and_search_find_all_in_range():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = [r[r >= 0] for r in flatgraph.robust_prune(x)]
    assert all(len(r) and i not in r for i, r in enumerate(lists))
    starts = [flatgraph.medoids(x)] * len(x)
    found = sum(len(f) for _, f in flatgraph.greedy_range(x, lists, x, starts, 0.8, 24))
    assert found >= 0.95 * (x @ x.T >= 0.8).sum()


def test_pipeline_stages(spark, docs, clashing, empty):
    import corpus_pipeline as C
    sf = "/root/testdata/sf0.001"
    raw = spark.read.parquet(f"{sf}/documents.parquet")
    for df, whole in ((raw, True), (docs, False), (clashing, False), (empty, False)):
        now = df
        for i, (_, stage) in enumerate(C.STAGES):
            before = now
            now = stage(spark, now, sf)
            if i < 4:
                assert now.columns == df.columns
                now = now.cache()
            if i == 2:
                assert now.count() == before.count()
            if whole and i < 2:
                assert 0 < now.count() < before.count()
        assert now.columns[:1] == ["doc_id"] and (now.count() > 0) == whole or not whole
    assert C.run(spark, sf).count() > 0
