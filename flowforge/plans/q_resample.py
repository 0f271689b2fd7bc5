"""Registered oversampling queries (2.5): every synthetic row against SQL,
which finds neighbours by brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowforge.operators import resample as RS
from flowforge.plans import stages as S
from flowforge.plans.catalog import register


def _smote(spark, sf):
    d, cols = S.split_dataset(spark, sf)
    return RS.smote_oversample(d.where(F.col("split") == "train"), cols, "Label_Multi", "flow_id", k=5, seed=42)


def _sql_smote() -> str:
    """The same rows by brute force: all pairs inside each minority class."""
    f = S.FINAL_FEATURES
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in f)
    return S.sql_split(
        "tr AS (SELECT flow_id, Label_Multi, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in f) +
        " FROM spl WHERE split = 'train')",
        """cls AS (SELECT Label_Multi, n, m - n AS s, coalesce(sum(m - n) OVER (ORDER BY Label_Multi
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM (SELECT Label_Multi, n, max(n) OVER () AS m
  FROM (SELECT Label_Multi, count(*) AS n FROM tr GROUP BY 1) x) y)""",
        "mino AS (SELECT tr.* FROM tr JOIN cls USING (Label_Multi) WHERE s > 0 AND n >= 2)",
        f"""nb AS (SELECT flow_id, nb_key, rk FROM (SELECT a.flow_id, b.flow_id AS nb_key, row_number() OVER (
  PARTITION BY a.flow_id ORDER BY {d2}, b.flow_id) AS rk FROM mino a JOIN mino b
  ON a.Label_Multi = b.Label_Multi AND a.flow_id <> b.flow_id) z WHERE rk <= 5)""",
        "kk AS (SELECT flow_id, max(rk) AS k FROM nb GROUP BY 1)",
        """base AS (SELECT mino.*, n, s, off, row_number() OVER (PARTITION BY Label_Multi
  ORDER BY md5(CAST(flow_id AS VARCHAR) || '|42'), flow_id) AS r FROM mino JOIN cls USING (Label_Multi))""",
        """gen AS (SELECT base.*, r - 1 + t.i * n AS j FROM base, LATERAL (SELECT unnest(range(CAST(s // n +
  CASE WHEN r - 1 < s % n THEN 1 ELSE 0 END AS BIGINT))) AS i) t)""",
        """hsh AS (SELECT gen.*, CAST('0x' || substr(md5(Label_Multi || '|' || j || '|42'), 1, 13) AS BIGINT) AS h,
  CAST(CAST('0x' || substr(md5(Label_Multi || '|' || j || '|43'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM gen)""") + \
        "SELECT flow_id, Label_Multi, " + ", ".join(f) + ", FALSE AS is_synthetic FROM tr UNION ALL " \
        "SELECT CAST(-(h.off + h.j + 1) AS BIGINT), h.Label_Multi, " + ", ".join(f"h.{c} + h.u * (o.{c} - h.{c})" for c in f) + \
        " , TRUE FROM hsh h JOIN kk USING (flow_id) JOIN nb ON nb.flow_id = h.flow_id AND nb.rk = h.h % kk.k + 1" \
        " JOIN tr o ON o.flow_id = nb.nb_key"


@register("smote_oversample", _sql_smote())
def q_smote_oversample(spark, sf):
    """k = 5 exact within-class neighbours, keyed synthesis, seed 42."""
    return _smote(spark, sf)


@register("resampled_class_counts", S.sql_split() + """SELECT Label_Multi,
  CAST(CASE WHEN count(*) >= 2 THEN max(count(*)) OVER () ELSE count(*) END AS BIGINT) AS count
FROM spl WHERE split = 'train' GROUP BY Label_Multi""")
def q_resampled_class_counts(spark, sf):
    return RS.resampled_class_counts(_smote(spark, sf))
