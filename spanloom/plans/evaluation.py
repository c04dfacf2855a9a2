"""Queries that evaluate decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import evaluate as ev
from spanloom.operators import vector as vec
from spanloom.operators.learn import Logistic

from .registry import register
from .vector import _LOO, vectors

EDGES = [-1.0, 0.1, 0.2, 0.3, 0.4, 1.0]


def hit():
    return F.col("pred") == F.col("label")


def loo(spark, sf):
    return vec.leave_one_out(vectors(spark, sf), "vec_id", "label", "embedding")


_S = _LOO + ", z as (select vec_id, sim s, (pred = label)::int y, margin from loo)"


@register("q_auc", _S + """, ra as (select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2 k from z)
select round((sum(k) filter (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 6) auc, sum(y)::bigint n_pos, sum(1 - y)::bigint n_neg from ra""")
def auc(spark, sf):
    return ev.auc(loo(spark, sf), "sim", hit()).select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")


@register("q_eer", _S + """, ct as (select s, sum(y) p, sum(1 - y) q from z group by s),
k as (select s, 1 - sum(p) over w / sum(p) over () frr, sum(q) over w / sum(q) over () far from ct window w as (order by s desc rows unbounded preceding))
select round((frr + far) / 2, 6) eer, s threshold from k order by round(abs(frr - far), 9), s desc limit 1""")
def eer(spark, sf):
    return ev.eer(loo(spark, sf), "sim", hit()).select(F.round("eer", 6).alias("eer"), "threshold")


@register("q_threshold", _S + """, ct as (select s, sum(y) p, sum(1 - y) q from z group by s),
k as (select s, sum(p) over w / (sum(p) over w + sum(q) over w) g from ct window w as (order by s desc rows unbounded preceding))
select coalesce(min(s) filter (g >= 0.08), 1.0) threshold from k""")
def threshold(spark, sf):
    return ev.precision_threshold(loo(spark, sf), "sim", hit(), 0.08)


@register("q_reliability", _S + """, b as (select *, case when s < 0.1 then 0 when s < 0.2 then 1 when s < 0.3 then 2 when s < 0.4 then 3 else 4 end bin from z)
select bin, count(*) n, round(avg(s), 6) mean_p, round(avg(y), 6) mean_y from b group by bin""")
def reliability(spark, sf):
    return ev.reliability(loo(spark, sf), "sim", hit(), EDGES).select("bin", "n", F.round("mean_p", 6).alias("mean_p"), F.round("mean_y", 6).alias("mean_y"))


@register("q_bottom10", _S + """, ra as (select *, row_number() over (order by s, vec_id) k, count(*) over () c, sum(1 - y) over () w from z)
select share::double share, floor(c * share)::bigint n, sum(1 - y)::bigint wrong, round(sum(1 - y) / greatest(any_value(w), 1), 6) captured
from ra cross join (values (0.1::double), (0.2::double)) t(share) where k <= floor(c * share) group by share, c""")
def bottom10(spark, sf):
    found = ev.bottom_share(loo(spark, sf), "sim", "vec_id", hit(), [0.1, 0.2])
    return found.select("share", "n", "wrong", F.round("captured", 6).alias("captured"))


@register("q_logit_score", _S + """
select vec_id, round(1 / (1 + exp(-(-0.5 + (s - 0.25) / 0.1 * 0.8 + (coalesce(margin, 0.05) - 0.05) / 0.04 * 0.3))), 5) p from z""")
def logit_score(spark, sf):
    model = Logistic(["sim", "margin"], [0.25, 0.05], [0.1, 0.04], [0.8, 0.3], -0.5)
    return loo(spark, sf).select("vec_id", F.round(model.score(), 5).alias("p"))


@register("q_threshold_sweep", _S + """
select thr::double thr, count(*) n, sum(y)::bigint hits, round(avg(y), 6) prec from z cross join (values (0.1::double), (0.2::double), (0.3::double), (0.4::double)) t(thr) where s >= thr group by thr""")
def threshold_sweep(spark, sf):
    swept = loo(spark, sf).withColumn("thr", F.explode(F.array(*map(F.lit, (0.1, 0.2, 0.3, 0.4))))).filter("sim >= thr")
    return swept.groupBy("thr").agg(F.count("*").alias("n"), F.sum(hit().cast("long")).alias("hits"), F.round(F.avg(hit().cast("double")), 6).alias("prec"))
