"""Registered queries of the operators, each over its whole table, and SQL
where SQL can express them. The digests named by the result contracts are
derived here from what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowforge.llm import (
    chat, flatgraph, hashtree, lshforest, mixing, packing, quality, runs, secret_scan, substring, topk, variants, wavelet)
from flowforge.llm.common import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op2_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], turns.schema)
    return chat.read_back(chat.format_chat(turns.union(extra)))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id"])


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "flow")
    counts = [F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
              for k in ("assign", "access", "hex")]
    return scanned.select("doc_id", *counts,
                          F.sha2(secret_scan.joined_spans(base).cast("binary"), 256).alias("base_sha256"),
                          secret_scan.joined_spans(F.col("secrets")).alias("spans"))


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lshforest.near_duplicates(table(spark, sf_dir, "documents"), words=2).drop("th")


def op8_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "wavelet")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, tokenizer("byte_bpe_50k.json"), 2)
    rows = wavelet.read_documents(spark.read.parquet(path))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_nra_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    # floor() turns NaN and infinity into whole numbers, so they become null first; it
    # also ends at the range of a long, but doubles from 2^53 on are whole already
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.expr(
        "transform(transform(embedding, x -> 256 * cast(x as double)), y -> if(isnan(y) or abs(y) = double('infinity'), "
        "null, if(abs(y) < 9007199254740992d, floor(y) + 0d, y)))").alias("v"))
    found = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.with_planted_runs(table(spark, sf_dir, "documents"))
    found = runs.collapse_runs(docs, 24, 3, carry=["doc_id"]).withColumn("best", runs.longest_exponent(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"), 6, 5, 5, delete_every=199)


def op13_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashtree.number_shards(table(spark, sf_dir, "documents"), hashtree.even_tree(40), hashtree.even_tree(41))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_remove_repeats": op2_remove_repeats,
    "op3_flat_graph": op3_flat_graph,
    "op4_chat_format": op4_chat_format,
    "op5_quality": op5_quality,
    "op6_secret_scan": op6_secret_scan,
    "op7_lsh_forest": op7_lsh_forest,
    "op8_wavelet_ids": op8_wavelet_ids,
    "op9_retrieval_packing": op9_retrieval_packing,
    "op10_nra_top_k": op10_nra_top_k,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hash_tree": op13_hash_tree,
}

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"



def _crc32_sql(text: str) -> str:
    """SQL for the unsigned crc32 of a string's UTF-8 bytes: two steps of four
    bits for each byte."""
    table16 = []
    for i in range(16):
        for _ in range(4):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table16.append(i)

    def four_bits(a: str) -> str:
        return f"xor({a} >> 4, ({table16}::UBIGINT[])[({a} & 15)::INT + 1])"

    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS UBIGINT))"
    return (f"CAST(xor(list_reduce([4294967295::UBIGINT] || {octets}, lambda c, b: {four_bits(four_bits('xor(c, b)'))}), "
            "4294967295::UBIGINT) AS BIGINT)")


def _runs_sql(longest: int = 1 << 17) -> str:
    """SQL of op11: one pair of tables per length of factors (names, and the
    stretches whose successors have one distance)."""
    ctes, found, length = [], [], 1
    while length <= longest:
        names = f"""f{length}(rid, i, name, gap, again) AS MATERIALIZED (
  SELECT rid, i, name, lead(i) OVER w - i, count(*) OVER (PARTITION BY name) > 1 FROM ({{}}) WINDOW w AS (PARTITION BY name ORDER BY i))"""
        if length == 1:
            ctes.append(names.format("SELECT rid, i, dense_rank() OVER (ORDER BY rid, w) AS name FROM t"))
        else:
            half = f"f{length // 2}"
            ctes.append(names.format(
                f"SELECT a.rid, a.i, dense_rank() OVER (ORDER BY a.name, b.name) AS name FROM {half} a JOIN {half} b "
                f"ON a.rid = b.rid AND b.i = a.i + {length // 2} WHERE a.again AND b.again"))
        found.append(f"""SELECT rid, min(i) AS start, count(*) - 1 + {length} + gap AS length, gap AS period
  FROM (SELECT rid, i, gap, i - row_number() OVER (PARTITION BY rid, gap ORDER BY i) AS g FROM f{length}
    WHERE gap > {length // 2} AND gap <= {length}) GROUP BY rid, gap, g""")
        length *= 2
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_crc32_sql("CAST(doc_id AS VARCHAR)")} AS h,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
a AS (SELECT rid, doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
    h // 10 % 8 AS g FROM d),
t AS (SELECT rid, i, CASE WHEN i >= a THEN w[a + (i - a) % (1 + (n - a) // (3 + g)) + 1] ELSE w[i + 1] END AS w
  FROM (SELECT *, unnest(range(n)) AS i FROM a)),
{", ".join(ctes)},
r AS (SELECT * FROM ({" UNION ALL ".join(found)}) WHERE length >= greatest(24, 3 * period)),
b AS (SELECT rid, count(*) AS n_runs, max(CAST(length AS DOUBLE) / period) AS best,
    string_agg(start || ',' || length || ',' || period || E'
', '' ORDER BY start, period) AS runs FROM r GROUP BY rid),
m AS (SELECT r.rid, arg_min(r, (start, period)) AS m FROM r JOIN b USING (rid)
  WHERE CAST(length AS DOUBLE) / period = best GROUP BY r.rid),
x AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT t.rid, string_agg(t.w, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN x ON t.rid = x.rid AND t.i = x.i GROUP BY t.rid)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, m.m.start AS start, CAST(m.m.length AS BIGINT) AS length,
  CAST(m.m.period AS BIGINT) AS period, CAST(1000 * m.m.length // m.m.period AS BIGINT) AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (rid) LEFT JOIN m USING (rid) LEFT JOIN k USING (rid)"""


def _tree_sql(shards: int, name: str) -> str:
    """SQL that draws regions, racks and shards for the even tree of op13."""
    u = "(CAST('0x' || substr(md5('tree:' || {} || ':' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296"
    tree = ", ".join(f"({s // 20}, {s // 5}, {s})" for s in range(shards))
    return f"""{name}_tree(region, rack, shard) AS (VALUES {tree}),
{name}_0 AS (SELECT id, arg_max(region, (draw, -region)) AS region FROM (SELECT id, region, ln({u.format("region")}) / n AS draw
  FROM keys, (SELECT region, count(*) AS n FROM {name}_tree GROUP BY region)) GROUP BY id),
{name}_1 AS (SELECT id, region, arg_max(rack, (draw, -rack)) AS rack FROM (SELECT id, region, rack,
    ln({u.format("region || ':' || rack")}) / n AS draw
  FROM {name}_0 JOIN (SELECT region, rack, count(*) AS n FROM {name}_tree GROUP BY region, rack) USING (region)) GROUP BY id, region),
{name} AS (SELECT id, arg_max(shard, (draw, -shard)) AS {name} FROM (SELECT id, shard,
    ln({u.format("region || ':' || rack || ':' || shard")}) AS draw
  FROM {name}_1 JOIN {name}_tree USING (region, rack)) GROUP BY id)"""


ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": f"""
WITH d AS (SELECT doc_id, source, CAST({WORDS} AS BIGINT) AS size FROM documents),
k AS (SELECT *, CASE WHEN size < 16 THEN size
        ELSE length(bin(size)) * 8 + ((size >> (length(bin(size)) - 4)) & 7) END AS c,
      md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS i FROM s),
w AS (SELECT *, CAST([3, 1, 2][CAST(i % 3 + 1 AS INTEGER)] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM n),
f AS (SELECT *, cap / w AS full_at FROM w),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY full_at, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY full_at, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
o AS (SELECT full_at, i, level FROM l WHERE level <= full_at ORDER BY full_at, i LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN NOT EXISTS (SELECT 1 FROM o) THEN cap
        WHEN l.full_at < (SELECT full_at FROM o)
          OR (l.full_at = (SELECT full_at FROM o) AND l.i < (SELECT i FROM o)) THEN cap
        ELSE (SELECT level FROM o) * w END AS target FROM l),
r AS (SELECT k.*, source_size, target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e,
        CAST(CAST('0x' || substr(md5('mix:offset:' || coalesce('=' || k.source, 'null')), 1, 8) AS BIGINT) AS DOUBLE)
          / 4294967296 AS u,
        row_number() OVER (PARTITION BY k.source ORDER BY c, h, doc_id, size) AS g
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, CAST(least(floor(u + e * g) - floor(u + e * (g - 1)), 2) AS BIGINT) AS copies FROM r)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM p""",
    "op2_remove_repeats": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
      FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
m AS (SELECT g, min(doc_id) AS least FROM n GROUP BY g),
c AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS p FROM n JOIN m USING (g) WHERE doc_id > least),
p AS (SELECT rid, list(p) AS gone FROM c GROUP BY rid),
x AS (SELECT d.rid, d.doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [0] ELSE range(1, len(w) + 1) END) AS p FROM d),
k AS (SELECT x.rid, x.doc_id, len(any_value(w)) AS n_words, count(c.p) AS n_removed,
        coalesce(string_agg(CASE WHEN c.p IS NULL AND x.p > 0 THEN w[x.p] END, ' ' ORDER BY x.p), '') AS kept
      FROM x LEFT JOIN c ON x.rid = c.rid AND x.p = c.p GROUP BY x.rid, x.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, n_removed, sha256(kept) AS kept_sha256 FROM k""",
    "op4_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || E'\n' || text || E'\n', '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + 13 + 11
    + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
    ELSE before = 'user' AND role = 'assistant' END) AS valid
FROM p GROUP BY conv_id""",
    "op10_nra_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_periodic_runs": _runs_sql(),
    "op12_spelling_variants": f"""
WITH RECURSIVE o AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS w FROM documents),
p AS (SELECT doc_id, w, count(*) AS c, {_crc32_sql("CAST(doc_id AS VARCHAR) || ':' || w")} AS h FROM o GROUP BY doc_id, w),
q AS (SELECT CASE WHEN h % 199 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, c FROM p),
v AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM q WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
x AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (SELECT a.word, b.word AS other, b.n AS m FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT x.word, v.word, v.n FROM x JOIN v ON x.rest = v.word
  UNION SELECT v.word, x.word, x.n FROM x JOIN v ON x.rest = v.word),
s AS (SELECT word, count(*) AS near, max(m) AS best FROM e GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(near, 0) AS n_near, CASE WHEN best >= 5 * v.n THEN best END AS form_n,
    CASE WHEN best >= 5 * v.n THEN (SELECT min(encode(other)) FROM e WHERE e.word = v.word AND m = best) END AS form
  FROM v LEFT JOIN s USING (word)),
g AS (SELECT word, n, n_near, form_n, decode(form) AS form FROM f),
r(word, root, form) AS (SELECT word, word, form FROM g UNION ALL
  SELECT r.word, r.form, g.form FROM r JOIN g ON g.word = r.form)
SELECT g.word, g.form, r.root, g.n, g.n_near, g.form_n FROM g JOIN r ON g.word = r.word AND r.form IS NULL""",
    "op13_hash_tree": f"""
WITH d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id,
    CAST(octet_length(encode(coalesce(text, ''))) + 16 AS BIGINT) AS size,
    {_crc32_sql("coalesce(text, '')")} AS text_crc32 FROM documents),
keys AS (SELECT DISTINCT id FROM d),
{_tree_sql(40, "shard")},
{_tree_sql(41, "grown_shard")},
n AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1) // {hashtree.CHUNK} AS chunk FROM d),
o AS (SELECT doc_id, size, text_crc32, shard, grown_shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws(':', 'tree:slot', id, size, text_crc32, chunk)),
      doc_id, size, text_crc32, chunk) - 1 AS slot
  FROM n JOIN shard USING (id) JOIN grown_shard USING (id))
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, slot,
  CAST(grown_shard AS INTEGER) AS grown_shard FROM o""",
}
