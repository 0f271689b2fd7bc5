import hashlib
import re

import pytest
from pyspark.sql import functions as F

from flowforge.llm import lshforest, mixing, quality, secret_scan, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_mix_follows_targets(spark, docs, clashing, empty):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    assert sorted(r["size"] for r in rows) == sorted(len(WORD.findall(t or "")) for t, in docs.select("text").collect())
    assert all(0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"] for r in rows)
    total = {}
    for r in rows:
        total[r["source"]] = (r["source_size"], r["target"])
    assert sum(t for _, t in total.values()) == pytest.approx(1.5 * sum(s for s, _ in total.values()))
    assert all(t <= 2 * s for s, t in total.values())
    again = mixing.mix_sources(clashing.select(*docs.columns).repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    emitted = mixing.emit_copies(clashing, mixing.mix_sources(clashing))
    assert emitted.columns == clashing.columns and emitted.count() == sum(r["copies"] for r in rows)
    assert mixing.mix_sources(empty).count() == 0


def test_mix_sources_stay_near_their_target(spark):
    # the large ones are a third of the rows; weights 3, 1, 2 by name, null last
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr(
        "repeat('w ', 1 + int(pow(hash(id) & 7, 3)))").alias("text"), F.expr(
        "case when id % 3 = 0 then 'big' when id % 7 = 0 then null else concat('s', id % 4) end").alias("source"))
    out = mixing.mix_sources(rows, weights=(3, 1, 2))
    sums = out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.sum("size").alias("s"),
                                     F.max("size").alias("m")).collect()
    names = sorted((r["source"] for r in sums if r["source"]), key=lambda x: x.encode()) + [None]
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    free = {r["source"]: r["g"] / weight[r["source"]] for r in sums if r["g"] < 2 * r["s"] - 1e-6}
    assert max(free.values()) == pytest.approx(min(free.values()))
    assert all(abs(r["t"] - r["g"]) <= 4 * r["m"] for r in sums)
    ones = rows.where("doc_id = 0").select("doc_id", "text", F.lit(None).cast("string").alias("source"))
    assert mixing.mix_sources(ones).first()["target"] == pytest.approx(1.5 * ones.count() * out.where("doc_id=0").first()["size"])


def brute_repeats(rows, width):
    first = {}
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - width + 1):
            if d is not None:
                k = tuple(w[i:i + width])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i:i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("width,cells", [(50, 1 << 20), (3, 1 << 6), (1, 1 << 16)])
def test_substring_agrees_with_brute_force(docs, width, cells):
    """A tiny sketch lets every window through: results stay whole."""
    got = substring.remove_repeats(docs, width, cells).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(docs.select("doc_id", "text").collect(), width)


def test_substring_edges(clashing, empty):
    out = substring.remove_repeats(clashing)
    assert out.count() == clashing.count() and out.columns[:5] == clashing.columns[:5]
    assert substring.remove_repeats(empty).count() == 0


def test_sketch_never_undercounts(docs):
    import numpy as np
    text = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    bits = substring.count_min(text, 2, 1 << 12)
    counts = {}
    from flowforge.llm.common import string_bytes
    import pyarrow as pa
    col = pa.array([r[0] for r in text.collect()])
    for _, (h,), _, _ in substring.text_windows(*string_bytes(col), 2, 1):
        for x in h.tolist():
            counts[x] = counts.get(x, 0) + 1
    for h, n in counts.items():
        if n > 1:
            for r in range(substring.ROWS):
                cell = int(substring.sketch_cell(np.array([h], np.uint64), r, 1 << 12)[0])
                assert bits[r][cell >> 3] >> (cell & 7) & 1
    cells = np.unique(np.random.default_rng(1).integers(0, 10 ** 6, 3000))
    assert (substring._cells(substring._gaps(cells)) == cells).all()


def brute_near(rows, words, percent):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for d, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append((d, frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1)) if len(w) >= words
                     else frozenset([tuple(w)]) if w else frozenset()))
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in sets), key=str)


def test_near_duplicates_agree_with_brute_force(spark, clashing, empty):
    base = " ".join(f"t{i}" for i in range(120)).split()
    rows = [(100 + k, " ".join(base[:k % 7] + [f"n{k}"] + base[k % 7 + 1:])) for k in range(60)]  # a dense region
    rows += [(200, "THE Cat sat on the mat today again"), (201, "the cat SAT on the mat today again"),
             (202, "lone"), (203, "Lone"), (204, None), (205, ""), (None, "lone"), (206, "two words"), (207, "two words")]
    rows += [(300 + k, " ".join(f"x{k}y{j // 2}" for j in range(30))) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for words in (2, 5):
        got = lshforest.near_duplicates(df, words=words, reach=4)
        assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == \
            brute_near(rows, words, 80)
        assert got.where("kept <> (doc_id = component_id)").count() == 0
    assert lshforest.near_duplicates(clashing).count() == clashing.count()
    assert lshforest.near_duplicates(empty).count() == 0


def test_blocks_of_a_dense_region_meet(spark, monkeypatch):
    """A chain of 40 texts, each near the next only, in blocks of 6."""
    monkeypatch.setattr(lshforest, "BLOCK", 6)
    rows = [(k, " ".join(f"c{j}" for j in range(4 * k, 4 * k + 60))) for k in range(40)]
    rows += [(100 + k, " ".join([f"c{j}" for j in range(60)] + [f"z{k}{j}" for j in range(k % 40)])) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = lshforest.near_duplicates(df, words=2, reach=1)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == \
        brute_near(rows, 2, 80)


def test_components_of_chains_and_hubs(spark):
    from flowforge.llm.graph import components
    rows = [(i, i + 1) for i in range(500)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 4999), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(501)}, **{1000 + i: 1000 for i in range(400)}, 5000: 4999, 4999: 4999}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_secret_patterns_and_flows(docs, clashing, empty):
    find = secret_scan.find_spans
    assert find("") == []
    assert find("token=secret:abcdefghij") == []  # the short match uses up its text
    assert find("x API_KEY : 'abcdefgh' y")[0] == (2, "assign", 21)
    assert find("Key toſen=abcdefghij") == []  # only ASCII letters in either case
    hexes = [s for s in find("q " + "a" * 31 + " " + "0f" * 16) if s[1] == "hex"]
    assert hexes == [(34, "hex", 66)]
    assert [s for s in find("AKIAAKIA12345678 AKIA1") if s[1] == "access"] == [(0, "access", 16)]
    text = 'seed = "Zk81" + "xYq93Lm0"\ndb.passphrase = seed'
    assert [(k, text[a:b]) for a, k, b in find(text)] == [("flow", "Zk81"), ("flow", "xYq93Lm0")]
    assert find('passphrase = "changeme"') == [] and find('colour = "Zk81xYq93Lm0"') == []
    assert secret_scan.redact("ab token=12345678 cd", find("ab token=12345678 cd"), "#") == "ab # cd"
    out = secret_scan.scan_secrets(clashing)
    assert out.count() == clashing.count()
    clean = {r["doc_id"]: r for r in out.collect()}
    assert clean[10]["redacted_text"].count("<SECRET>") == 2 and "hunter2" not in clean[10]["redacted_text"]
    assert secret_scan.scan_secrets(empty).count() == 0


KEY = "Zk81xYq93Lm0"
FORMS = ["api_secret: str = \"K\"", "const password: string = \"K\"", "let passphrase: Option<&'static str> = \"K\";",
         "def f(x: int = 3, db_password: Optional[str] = 'K'):", "var password string = \"K\"", "val apiSecret: String? = \"K\"",
         "char password[] = \"K\";", "char passphrase[32] = \"K\";", "cfg[\"password\"] = \"K\"", "passphrase\t=\t\"K\"",
         "passphrase\t:\tK", "passphrase:\n  K", "passphrase: |\n  K\nnext: 1", "passphrase: >-\n    K\n", "a:\n  passphrase:\n    \"K\"",
         "passphrase = (\n    \"K\"\n)", "passphrase = \\\n    \"K\"", "passphrase =\n    \"K\"", "passphrase = \"\"\"K\"\"\"",
         "passphrase = '' \"K\"", "passphrase = r'K'", "s = \"a\\\"b\"; passphrase = \"K\"", "f(\"a\\\"\", passphrase=\"K\")",
         "{\"passphrase\": \"K\"}", "{\"passphrase\":\n \"K\"}", "passphrase=K", "passphrase := `K`", "it's passphrase = 'K'",
         "{\"path\": \"C:\\\", \"passphrase\": \"K\"}", "url = \"db://h;passphrase=K;x\"", "passphrase = ''+\n  \"K\"", "const char *passphrase = \"K\";"]


@pytest.mark.parametrize("form", FORMS)
def test_secret_literals_of_each_form(form):
    text = "first = 1\n" + form.replace("K", KEY) + "\nlast: 2\n"
    at = text.index(KEY)
    spans = [(a, b) for a, k, b in secret_scan.find_spans(text) if k == "flow"]
    assert (at, at + len(KEY)) in spans
    assert all(text[a:b] == KEY for a, b in spans)


def test_secret_literals_in_parts_and_escapes():
    spans = lambda t: [t[a:b] for a, k, b in sorted(secret_scan.find_spans(t)) if k == "flow"]
    assert spans('passphrase = ("Zk81xY"\n  "q93Lm0")') == ["Zk81xY", "q93Lm0"]
    assert spans('passphrase = "Zk81xY" +\n  "q93Lm0"') == ["Zk81xY", "q93Lm0"]
    assert spans('passphrase = "Zk81\\"xYq93Lm0"') == ['Zk81\\"xYq93Lm0']
    assert spans('passphrase: |\n  Zk81xYq9\n  3Lm0aB7c\nother: 1') == ["Zk81xYq9", "3Lm0aB7c"]
    assert spans('PASSPHRASE=\nCOLOUR=Zk81xYq93Lm0') == []
    assert spans('passphrase:\n  colour: Zk81xYq93Lm0') == []
    assert spans('apiSecret: SecretString = load()\nx = 1') == []


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.score_quality(docs, labels, carry=["doc_id"]).join(labels, "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.97
    # calibrated: the mean score is near the share of good documents
    row = out.agg(F.avg("score"), F.avg("quality")).first()
    assert abs(row[0] - row[1]) < 0.03


def test_quality_edges(spark, docs, clashing, empty):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (5, 0, None), (6, None, 1), (None, 1, 1), (8, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for df in (docs, clashing):
        rows = quality.score_quality(df, labels).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    none = quality.score_quality(docs, labels.limit(0))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert quality.score_quality(empty, labels).count() == 0
