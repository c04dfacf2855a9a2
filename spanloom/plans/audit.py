"""Queries of calibration, rolling profiles and rankings of decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import calibrate as cal
from spanloom.operators import evaluate as ev
from spanloom.operators import report as rp
from spanloom.operators import vector as vec
from spanloom.operators.learn import fit_logistic, left_out_scores
from spanloom.operators.relational import first_per_group

from .registry import register
from .relational import table
from .sequence import _E, HOUR, ORDER, events
from .vector import _LOO, vectors


def _loo(spark, sf):
    scored = vec.leave_one_out(vectors(spark, sf), "vec_id", "label", "embedding")
    return scored.withColumns({"y": (F.col("pred") == F.col("label")).cast("int"), "season": F.col("vec_id") % 3})


def _newton(rows: str, steps: int, ridge: float = 1, n: str = "n", z: str = "z") -> str:
    """Newton steps of a ridge logistic model on two standardised features per group f of ``rows`` (f, x1, x2, y), as recursive SQL."""
    return f"""
{z} as (select f, (x1 - avg(x1) over w) / s1 x1, (x2 - avg(x2) over w) / s2 x2, y from (select *, stddev_pop(x1) over (partition by f) s1, stddev_pop(x2) over (partition by f) s2 from {rows}) window w as (partition by f)),
{n} as (select distinct f, 0 it, 0.0::double b0, 0.0::double b1, 0.0::double b2 from {z} union all
  select f, it + 1, b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / d, b1 + (h00 * (g1 * h22 - g2 * h12) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / d,
    b2 + (h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / d
  from (select *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) d from (
    select f, it, b0, b1, b2, sum(y - p) g0, sum((y - p) * x1) - {ridge} * b1 g1, sum((y - p) * x2) - {ridge} * b2 g2, sum(v) h00, sum(v * x1) h01, sum(v * x2) h02, sum(v * x1 * x1) + {ridge} h11, sum(v * x1 * x2) h12, sum(v * x2 * x2) + {ridge} h22
    from (select s.f, it, b0, b1, b2, x1, x2, y, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) p, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) * (1 - 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2)))) v from {n} s join {z} t on t.f = s.f where it < {steps})
    group by f, it, b0, b1, b2)))"""


_S = _LOO.replace("with ", "with recursive ", 1) + ", r0 as (select vec_id, vec_id % 3 as season, sim x1, margin x2, (pred = label)::int y from loo)"


@register("q_logit_fit", _S + ", one as (select 0 f, x1, x2, y from r0)," + _newton("one", 12) + """
select 'sim' feature, round(b1, 5) coef from n where it = 12 union all select 'margin', round(b2, 5) from n where it = 12 union all select 'bias', round(b0, 5) from n where it = 12""")
def logit_fit(spark, sf):
    model = fit_logistic(_loo(spark, sf), ["sim", "margin"], "y")
    return spark.createDataFrame([(n, round(float(c), 5)) for n, c in [*zip(model.features, model.coef, strict=True), ("bias", model.bias)]], "feature string, coef double")


@register("q_left_out_model", _S + ", others as (select g.season f, x1, x2, y from r0 join (select distinct season from r0) g on g.season <> r0.season)," + _newton("others", 12) + """,
m as (select f, avg(x1) m1, stddev_pop(x1) s1, avg(x2) m2, stddev_pop(x2) s2 from others group by f)
select vec_id, round(1 / (1 + exp(-(b0 + b1 * (x1 - m1) / s1 + b2 * (x2 - m2) / s2))), 5) p from r0 join n on n.f = season and it = 12 join m on m.f = season""")
def left_out_model(spark, sf):
    return left_out_scores(_loo(spark, sf), "season", ["sim", "margin"], "y").select("vec_id", F.round("p", 5).alias("p"))


@register("q_audit_rank")
def audit_rank(spark, sf):
    """The share of wrong labels among the tenth and fifth that a left-out ranker trusts least; fitted by two nested models, so tested against numpy."""
    rows = _loo(spark, sf).select("vec_id", "season", "sim", "margin", "y", F.lit(1.0).alias("one"))
    named = rows.select("vec_id", "season", F.col("sim").alias("top1"), "margin", F.log1p(F.col("vec_id") % 7).alias("log_dur"), "y")
    ranked = cal.ranked_for_audit(named.filter("vec_id % 4 <> 0"), named.filter("vec_id % 4 = 0"), "season", ["top1", "margin", "log_dur"])
    return ev.bottom_share(ranked, "p", "vec_id", F.col("y") == 1, [0.1, 0.2]).select("share", "n", "wrong")


_NESTED = _S + """, tr as (select g.season f, x1, x2, y from r0 join (select distinct season from r0) g on g.season <> r0.season where vec_id % 4 <> 0),""" + _newton("tr", 12, 1, "na", "za") + """,
ma as (select f, avg(x1) m1, stddev_pop(x1) s1, avg(x2) m2, stddev_pop(x2) s2 from tr group by f),
au as (select vec_id, season, b0 + b1 * (x1 - m1) / s1 + b2 * (x2 - m2) / s2 lp, x2, y from r0 join na on na.f = season and it = 12 join ma on ma.f = season where vec_id % 4 = 0),
tb as (select g.season f, lp x1, x2, y from au join (select distinct season from au) g on g.season <> au.season),""" + _newton("tb", 14, 3, "nb", "zb") + """,
mb as (select f, avg(x1) m1, stddev_pop(x1) s1, avg(x2) m2, stddev_pop(x2) s2 from tb group by f)
select vec_id, round(1 / (1 + exp(-(b0 + b1 * (lp - m1) / s1 + b2 * (x2 - m2) / s2))), 5) p from au join nb on nb.f = season and it = 14 join mb on mb.f = season"""


@register("q_audit_chances", _NESTED)
def audit_chances(spark, sf):
    """The two nested left-out models of an audit, on two features each, which SQL can fit too."""
    rows = _loo(spark, sf).select("vec_id", "season", F.col("sim").alias("top1"), "margin", "y")
    ranked = cal.ranked_for_audit(rows.filter("vec_id % 4 <> 0"), rows.filter("vec_id % 4 = 0"), "season", ["top1", "margin"], beside=("margin",))
    return ranked.select("vec_id", F.round("p", 5).alias("p"))


@register("q_suspects", _LOO + """, sc as (select vec_id, 1 / (1 + exp(-(sim * 8 - 3))) p from loo) select vec_id, round(p, 6) p, (select count(*) from sc) remaining from sc order by p, vec_id limit 40""")
def suspects(spark, sf):
    scored = _loo(spark, sf).select("vec_id", (1 / (1 + F.exp(-(F.col("sim") * 8 - 3)))).alias("p"))
    return cal.suspects(scored, "p", "vec_id", 40).select("vec_id", F.round("p", 6).alias("p"), "remaining")


_RUNS = _E + """,
b as (select *, case when lag(t) over w is null or t - lag(t) over w >= 28800000000 then 1 else 0 end s from e window w as (partition by user_id order by t, event_id)),
r as (select *, sum(s) over (partition by user_id order by t, event_id) run_id from b),
c as (select user_id, run_id, event_type, count(*) n, sum(value) v from r group by 1, 2, 3),
k as (select *, row_number() over (partition by user_id, run_id order by n desc, event_type) q, sum(n) over (partition by user_id, run_id) a from c),
u as (select user_id, run_id, max(event_type) filter (q = 1) pred, max(event_type) filter (q = 2) "second", max(n / a) filter (q = 1) s1, coalesce(max(n / a) filter (q = 2), 0) s2, coalesce(max(n / a) filter (q = 3), 0) s3, least(count(*), 3) nc from k group by 1, 2),
x as (select u.*, st, en, nu from u join (select user_id, run_id, min(t) / 1e6 st, max(t) / 1e6 + 30 en, count(*) nu from r group by 1, 2) using (user_id, run_id)),
caps as (select user_id, run_id, event_type l, t / 1e6 a, t / 1e6 + 30 b, event_id from r where event_id % 3 = 0), cards as (select user_id, event_type l, t / 1e6 + 10 tt from e where event_id % 11 = 0)"""


def _runs(spark, sf):
    from spanloom.operators import sequence as seq

    own = seq.runs(events(spark, sf), ["user_id"], ORDER, "t", "t", 8 * HOUR, F.lit(False)).withColumn("s", F.col("t") / F.lit(1e6))
    counts = own.groupBy("user_id", "run_id", "event_type").agg(F.count("*").alias("n"), F.min("s").alias("a"), F.max("s").alias("b"))
    facts = [F.min("a").alias("start_s"), (F.max("b") + 30).alias("end_s"), F.sum("n").alias("n_utts"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "event_type"))).alias("c")]
    ranked = F.slice(F.transform("c", lambda x: F.struct(x["event_type"].alias("label"), (-x["m"] / F.col("n_utts")).alias("score"))), 1, 3)
    runs = counts.groupBy("user_id", "run_id").agg(*facts).withColumn("candidates", ranked).drop("c").withColumns({"pred": F.col("candidates")[0]["label"], "second": F.get("candidates", F.lit(1))["label"]})
    captions = own.filter("event_id % 3 = 0").select("user_id", "run_id", F.col("event_type").alias("label"), F.col("s").alias("start_s"), (F.col("s") + 30).alias("end_s"))
    cards = own.filter("event_id % 11 = 0").select("user_id", F.col("event_type").alias("label"), (F.col("s") + 10).alias("t_s"))
    return runs, captions, cards


@register("q_run_features", _RUNS + """
select user_id, run_id::bigint run_id, round(s1, 6) top1, round(s2, 6) top2, round(s3, 6) top3, round(s1 - s2, 6) margin, round(s2 - s3, 6) gap23, nc::double n_cands, round(ln(1 + en - st), 6) log_dur, round(ln(1 + nu), 6) log_n_utts,
  (nu >= 4)::int::double confessional, (run_id = 1)::int::double recap, (pred = 'error')::int::double mention_pred, 0.0::double host_pred, round(ln(1 + nu * 2), 6) log_bank_n, round(ln(1 + nu * 5.0), 6) log_bank_s, 0.0::double log_bank_n2, round(ln(greatest(user_id, 1)), 6) log_ep, round(s1 * (s1 - s2), 6) top1_x_margin from x""")
def run_features(spark, sf):
    runs, _, _ = _runs(spark, sf)
    told = runs.withColumns({
        "dur": F.col("end_s") - F.col("start_s"), "domain": F.when(F.col("n_utts") >= 4, "confessional").otherwise("field"), "segment": F.when(F.col("run_id") == 1, "recap").otherwise("body"), "named": F.col("pred") == "error",
        "episode": F.col("user_id"), "bank_n": F.col("n_utts") * 2, "bank_s": F.col("n_utts") * 5.0, "bank_n2": F.lit(None).cast("long"),
    })
    return cal.run_features(told).select("user_id", "run_id", *(F.round(c, 6).alias(c) for c in cal.RUN))


@register("q_around_features", _RUNS + """,
f as (select x.user_id, x.run_id,
  exists (select 1 from caps c where c.user_id = x.user_id and c.run_id <> x.run_id and c.l = x.pred and c.b >= x.st - 60 and c.a <= x.en + 60) cap_pred_near,
  exists (select 1 from caps c where c.user_id = x.user_id and c.run_id <> x.run_id and c.l = x."second" and c.b >= x.st - 60 and c.a <= x.en + 60) cap_second_near,
  coalesce((select max(l) from caps c where c.user_id = x.user_id and c.b = (select max(b) from caps o where o.user_id = x.user_id and o.b <= x.st and o.b >= x.st - 30)) = x.pred, false) cap_prev_pred,
  coalesce((select max(l) from caps c where c.user_id = x.user_id and c.a = (select min(a) from caps o where o.user_id = x.user_id and o.a >= x.en and o.a <= x.en + 30)) = x.pred, false) cap_next_pred,
  exists (select 1 from cards d where d.user_id = x.user_id and d.l = x.pred and d.tt between x.st - 90 and x.en + 90) card_pred_near, exists (select 1 from cards d where d.user_id = x.user_id and d.l = x."second" and d.tt between x.st - 90 and x.en + 90) card_second_near,
  (select count(*) from caps c where c.user_id = x.user_id) >= 20 ep_has_caps, exists (select 1 from cards d where d.user_id = x.user_id) ep_has_cards from x)
select user_id, run_id::bigint run_id, cap_pred_near::int::double cap_pred_near, cap_second_near::int::double cap_second_near, cap_prev_pred::int::double cap_prev_pred, cap_next_pred::int::double cap_next_pred, card_pred_near::int::double card_pred_near,
  card_second_near::int::double card_second_near, ep_has_caps::int::double ep_has_caps, ep_has_cards::int::double ep_has_cards from f""")
def around_features(spark, sf):
    runs, captions, cards = _runs(spark, sf)
    return cal.around_features(runs.select("user_id", "run_id", "start_s", "end_s", "pred", "second"), captions, cards, ["user_id"], "run_id").select("user_id", "run_id", *cal.AROUND)


@register("q_rule_mask", _RUNS + " select user_id, count(*) filter (s1 >= 0.5 and s1 - s2 >= 0.2 and pred <> 'error' and en - st >= 31) taken, count(*) n from x group by 1")
def rule_mask(spark, sf):
    runs, _, _ = _runs(spark, sf)
    told = runs.withColumns({"dur": F.col("end_s") - F.col("start_s"), "domain": F.lit("field"), "segment": F.lit("body"), "named": F.col("pred") == "error", "episode": F.lit(1), "bank_n": F.lit(0), "bank_s": F.lit(0.0), "bank_n2": F.lit(0)})
    return cal.run_features(told).groupBy("user_id").agg(F.count_if(cal.accepted(0.5, 0.2, 31.0)).alias("taken"), F.count("*").alias("n"))


_ROLL = """with x as (select vec_id, label, vec_id // 50 as ep, vec_id % 7 + 1 as w, unnest(embedding)::double x, unnest(range(64)) d from embeddings), eps as (select distinct ep from x)"""


@register("q_rolling", _ROLL + """,
m as (select e.ep, label, d, sum(x * w * pow(0.5, (e.ep - 1 - x.ep) / 3.0)) m from eps e join x on x.ep < e.ep where vec_id % 2 = 0 group by 1, 2, 3),
u as (select ep, label, d, m / sqrt(sum(m * m) over (partition by ep, label)) m from m),
s as (select vec_id, u.label other, round(sum(x.x * u.m), 6) score from x join u using (d) where vec_id % 2 = 1 and u.ep = x.ep group by 1, 2),
r as (select *, row_number() over (partition by vec_id order by score desc, other) k from s) select vec_id, k::int rank_no, other as label, round(score, 4) score from r where k <= 2""")
def rolling(spark, sf):
    items = vectors(spark, sf).withColumns({"ep": F.floor(F.col("vec_id") / 50), "w": F.col("vec_id") % 7 + 1})
    state = vec.rolling_profiles(items.filter("vec_id % 2 = 0"), ["label"], "ep", "embedding", F.col("w"))
    found = vec.rolling_rank(items.filter("vec_id % 2 = 1"), "vec_id", "ep", "embedding", state, "label", "profile", 2)
    return found.withColumn("score", F.round("score", 4))


@register("q_revisit", _ROLL + """,
m as (select e.ep, label, d, sum(x * w) m from eps e join x on x.ep <> e.ep where vec_id % 2 = 0 group by 1, 2, 3), u as (select ep, label, d, m / sqrt(sum(m * m) over (partition by ep, label)) m from m),
s as (select vec_id, any_value(x.ep) ep, any_value(w) w, u.label other, round(sum(x.x * u.m), 6) score from x join u using (d) where vec_id % 2 = 1 and u.ep = x.ep group by vec_id, u.label),
b as (select vec_id, any_value(ep) ep, any_value(w) w, max(score) score from s group by vec_id)
select ep, count(*) n, sum(w)::bigint secs, sum(case when score >= 0.2 then w else 0 end)::bigint auto_secs from b group by ep""")
def revisit(spark, sf):
    """Each episode scored again by the profiles of all other episodes: seconds decided per episode."""
    items = vectors(spark, sf).withColumns({"ep": F.floor(F.col("vec_id") / 50), "w": F.col("vec_id") % 7 + 1})
    others = vec.left_out_profiles(items.filter("vec_id % 2 = 0"), ["label"], "ep", "embedding", F.col("w"))
    # an episode's own profiles stand at the period before it
    placed = others.withColumn("ep", F.col("ep") - 1)
    best = vec.rolling_rank(items.filter("vec_id % 2 = 1"), "vec_id", "ep", "embedding", placed, "label", "profile", 1).join(items.select("vec_id", "ep", "w"), "vec_id")
    return best.groupBy("ep").agg(F.count("*").alias("n"), F.sum("w").alias("secs"), F.sum(F.when(F.col("score") >= 0.2, F.col("w")).otherwise(0)).alias("auto_secs"))


_EX = """with x as (select vec_id, label, unnest(embedding)::double x, unnest(range(64)) d from embeddings),
p as (select vec_id p, label l from (select *, row_number() over (partition by label order by vec_id % 9 desc, vec_id) k from embeddings where vec_id % 2 = 0) where k <= 4),
a as (select x.vec_id, p.l other, p, sum(x.x * y.x) s from x join x y on y.d = x.d join p on p.p = y.vec_id where x.vec_id % 2 = 1 group by 1, 2, 3), e as (select vec_id, other, max(s) s from a group by 1, 2),
m as (select label, d, avg(x) m from x where vec_id % 2 = 0 group by label, d), u as (select label, d, m / (sqrt(sum(m * m) over (partition by label)) + 1e-9) m from m),
c as (select vec_id, u.label other, sum(x.x * u.m) s from x join u using (d) where vec_id % 2 = 1 group by 1, 2)"""


def _exemplars(spark, sf, mode):
    rows = vectors(spark, sf)
    even = rows.filter("vec_id % 2 = 0")
    picked = first_per_group(even, ["label"], [F.desc(F.col("vec_id") % 9), F.col("vec_id")], 4).select("label", F.col("embedding").alias("exemplar"))
    means = vec.profiles(even, ["label"], "embedding").select("label", "profile")
    return vec.rank_exemplars(rows.filter("vec_id % 2 = 1"), "vec_id", "embedding", picked, "label", "exemplar", means, 2, mode)


@register("q_exemplar_rank", _EX + " select vec_id, k::int rank_no, other as label, s score from (select vec_id, other, round(s, 6) s, row_number() over (partition by vec_id order by round(s, 6) desc, other) k from e) where k <= 2")
def exemplar_rank(spark, sf):
    return _exemplars(spark, sf, "exemplar")


@register("q_blend_rank", _EX + " select vec_id, k::int rank_no, other as label, s score from (select vec_id, other, round((e.s + c.s) / 2, 6) s, row_number() over (partition by vec_id order by round((e.s + c.s) / 2, 6) desc, other) k from e join c using (vec_id, other)) where k <= 2")
def blend_rank(spark, sf):
    return _exemplars(spark, sf, "blend")


@register("q_ablation", "with " + ", ".join(
    f"x{n} as (select vec_id, label, unnest(embedding[1:{n}])::double x, unnest(range({n})) d from embeddings), t{n} as (select label, d, sum(x) s, count(*) n from x{n} group by 1, 2), "
    f"c{n} as (select a.vec_id, a.label, t{n}.label other, a.x, t{n}.s - case when t{n}.label = a.label then a.x else 0 end s from x{n} a join t{n} using (d)), "
    f"s{n} as (select vec_id, label, other, round(sum(x * s) / (sqrt(sum(s * s)) + 1e-9), 6) v from c{n} group by 1, 2, 3), l{n} as (select vec_id, label, arg_max(other, (v, -other)) pred from s{n} group by 1, 2)" for n in (64, 32)) + """,
a as (select 'whole' variant, * from l64 union all select 'half', * from l32), g as (select *, unnest(['all', case when vec_id % 3 = 0 then 'thirds' end, case when label < 5 then 'low' end]) subset from a)
select variant, subset, count(*) n, round(avg((pred = label)::int), 6) accuracy from g where subset is not null group by 1, 2""")
def ablation(spark, sf):
    rows = vectors(spark, sf)
    scored = [vec.leave_one_out(rows.withColumn("embedding", F.slice("embedding", 1, n)), "vec_id", "label", "embedding").withColumn("variant", F.lit(name)) for n, name in ((64, "whole"), (32, "half"))]
    found = rp.ablation(scored[0].unionByName(scored[1]), "variant", F.col("pred") == F.col("label"), {"thirds": F.col("vec_id") % 3 == 0, "low": F.col("label") < 5})
    return found.withColumn("accuracy", F.round("accuracy", 6))


@register("q_audit_frame", """
with v as (select o_orderkey k, o_custkey g, case when o_orderkey % 9 = 0 then 'X' else o_orderstatus end prev, o_orderstatus pred, case when o_custkey % 4 = 0 then 'reject' else 'confirm' end verdict from orders)
select c_custkey g, c_nationkey episode, round(c_acctbal, 2) top1, (c_custkey % 4 <> 0)::int::double y from customer where c_nationkey >= 2 and c_custkey in (select g from v where prev = pred)""")
def audit_frame(spark, sf):
    orders = table(spark, sf, "orders")
    said = orders.select(F.col("o_custkey").alias("g"), F.when(F.col("o_orderkey") % 9 == 0, "X").otherwise(F.col("o_orderstatus")).alias("prev_label"), F.col("o_orderstatus").alias("pred"), F.when(F.col("o_custkey") % 4 == 0, "reject").otherwise("confirm").alias("verdict"))
    groups = table(spark, sf, "customer").select(F.col("c_custkey").alias("g"), F.col("c_nationkey").alias("episode"), F.round("c_acctbal", 2).alias("top1"))
    return cal.audit_frame(said, groups, "g").select("g", "episode", "top1", "y")
