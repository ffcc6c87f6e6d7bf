"""Queries of the closed-form classifier and of the fit along penalties."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgauge.catalog.registry import SPACE, query, rounded, roles, sql_light, table
from textgauge.catalog.serving import _PARTS
from textgauge.operators import bayes
from textgauge.operators.sampling import split_rows
from textgauge.operators.scoring import positive_probability
from textgauge.session import scratch_path

_TOKENS = f"regexp_extract_all(lower({sql_light('text')}), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_{SPACE}]')"

# The same formulas: counts of the training split, logarithms of smoothed shares, sums per text.
_BAYES = f"""with parts as (select * from {_PARTS}),
  tokens as (select conv_id, turn, split, generated, unnest({_TOKENS}) as token from parts),
  counts as (select token, count(*) filter (generated = 0) as n0, count(*) filter (generated = 1) as n1 from tokens where split = 'train' group by token),
  totals as (select sum(n0) as t0, sum(n1) as t1, count(*) as v from counts),
  priors as (select count(*) filter (generated = 0) / count(*)::double as p0, count(*) filter (generated = 1) / count(*)::double as p1 from parts where split = 'train'),
  sums as (select conv_id, turn, sum(ln((n0 + 1) / (t0 + v)::double)) as s0, sum(ln((n1 + 1) / (t1 + v)::double)) as s1
    from tokens join counts using (token), totals group by conv_id, turn),
  joint as (select p.conv_id, p.turn, p.split, p.generated, ln(p0) + coalesce(s0, 0) as j0, ln(p1) + coalesce(s1, 0) as j1
    from parts p left join sums s on p.conv_id = s.conv_id and p.turn = s.turn, priors),
  scored as (select *, case when j1 > j0 then 1 else 0 end as prediction, exp(j1 - greatest(j0, j1)) / (exp(j0 - greatest(j0, j1)) + exp(j1 - greatest(j0, j1))) as p,
    exp(j0 - greatest(j0, j1)) / (exp(j0 - greatest(j0, j1)) + exp(j1 - greatest(j0, j1))) as q from joint)"""


def _scored(spark, sf):
    rows = split_rows(roles(spark, sf), "generated", ["conv_id", "turn"])
    model = bayes.fit_bayes(rows.where("split = 'train'"), "text", "generated", scratch_path(spark, "bayes"))
    return model, bayes.score_bayes(rows, model, "text", ["conv_id", "turn"], ["split", "generated"])


@query("bayes_scores", f"{_BAYES} select conv_id, turn, split, generated, prediction, round(p, 6) as prob_ai from scored")
def _(spark, sf):
    rows = _scored(spark, sf)[1]
    return rows.select("conv_id", "turn", "split", F.col("generated").cast("int"), "prediction", F.round(F.col("probabilities")[1], 6).alias("prob_ai"))


_CHANCE = "greatest(case when generated = 1 then p else q end, 1e-300)"


@query(
    "bayes_validation",
    f"""{_BAYES}, held as (select * from scored where split = 'validation'),
      cells as (select c, count(*) filter (generated = c) as support, count(*) filter (prediction = c) as predicted,
        count(*) filter (generated = c and prediction = c) as hits from held, (select unnest([0, 1]) as c) group by c),
      each as (select *, case when predicted > 0 then hits / predicted::double else 0 end as pr, case when support > 0 then hits / support::double else 0 end as re,
        case when support + predicted > 0 then 2 * hits / (support + predicted)::double else 0 end as f from cells)
      select sum(support)::bigint as n, round(sum(hits) / sum(support)::double, 6) as accuracy, round(sum(pr * support) / sum(support), 6) as precision,
        round(sum(re * support) / sum(support), 6) as recall, round(sum(f * support) / sum(support), 6) as f1,
        (select round(avg(-ln({_CHANCE})), 6) from held) as loss from each""",
)
def _(spark, sf):
    scored = _scored(spark, sf)[1].where("split = 'validation'")
    return rounded(bayes.validation_metrics(scored, "generated"))


@query(
    "bayes_weights",
    f"{_BAYES} select token, n0, n1, round(ln((n1 + 1) / (t1 + v)::double) - ln((n0 + 1) / (t0 + v)::double), 6) as log_odds from counts, totals",
)
def _(spark, sf):
    model = _scored(spark, sf)[0]
    counts = model.counts.select("token", F.col("n")[0].alias("n0"), F.col("n")[1].alias("n1"))
    odds = model.weights().select("token", F.round(F.col("w")[1] - F.col("w")[0], 6).alias("log_odds"))
    return counts.join(odds, "token")


@query(
    "positive_probability",
    """select vec_id, dim::bigint as dim, round(greatest(0.0e0, least(1.0e0, embedding[2]::double)), 6) as p from (select *, len(embedding) as dim from embeddings)""",
)
def _(spark, sf):
    from pyspark.ml.functions import array_to_vector

    rows = table(spark, sf, "embeddings")
    share = F.transform("embedding", lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x.cast("double"))))
    vectors = rows.select("vec_id", F.size("embedding").cast("bigint").alias("dim"), array_to_vector(share).alias("v"))
    return vectors.select("vec_id", "dim", F.round(positive_probability("v"), 6).alias("p"))
