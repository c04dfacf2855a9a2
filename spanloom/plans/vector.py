"""Queries over embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import vector as vec

from .registry import register
from .relational import table


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", "embedding")


#: Vectors as long rows, and the unit means of the even ones per label.
_L = """with x as (select vec_id, label, unnest(embedding)::double x, unnest(range(64)) d from embeddings),
m as (select label, d, sum(x * {w}) / sum({w}) m from x where vec_id % 2 = 0 group by label, d),
u as (select label, d, m / (sqrt(sum(m * m) over (partition by label)) + 1e-9) m from m),
s as (select vec_id, u.label other, round(sum(x.x * u.m), 6) score from x join u using (d) where vec_id % 2 = 1 group by vec_id, u.label),
r as (select *, row_number() over (partition by vec_id order by score desc, other) rank_no from s)"""
_PLAIN = _L.replace("{w}", "1.0")


def even_profiles(spark, sf):
    return vec.profiles(vectors(spark, sf).filter("vec_id % 2 = 0"), ["label"], "embedding")


def odd_ranked(spark, sf, top):
    return vec.rank_profiles(vectors(spark, sf).filter("vec_id % 2 = 1"), "vec_id", "embedding", even_profiles(spark, sf), "label", "profile", top)


@register("q_centroids", _L.replace("{w}", "pow(0.5, (vec_id % 8) / 3.0)") + " select label, d::int dim, round(m, 6) v from u")
def centroids(spark, sf):
    weight = F.pow(F.lit(0.5), (F.col("vec_id") % 8) / 3.0)
    found = vec.profiles(vectors(spark, sf).filter("vec_id % 2 = 0"), ["label"], "embedding", weight)
    return found.select("label", F.posexplode("profile").alias("dim", "v")).withColumn("v", F.round("v", 6))


@register("q_rank", _PLAIN + " select vec_id, rank_no::int rank_no, other as label, score from r where rank_no <= 3")
def rank(spark, sf):
    return odd_ranked(spark, sf, 3)


@register("q_decide", _PLAIN + """,
p as (select vec_id, max(other) filter (rank_no = 1) label_pred, max(score) filter (rank_no = 1) a, max(score) filter (rank_no = 2) b from r group by vec_id)
select label_pred, case when a < 0.15 then 'no_candidate' when a >= 0.25 and round(a - b, 6) >= 0.05 then 'auto' else 'low_margin' end decision, count(*) n from p group by 1, 2""")
def decide(spark, sf):
    found = vec.decide(odd_ranked(spark, sf, 2), "vec_id", "label", 0.25, 0.05, 0.15)
    return found.groupBy(F.col("label").alias("label_pred"), "decision").agg(F.count("*").alias("n"))


_LOO = """with x as (select vec_id, label, unnest(embedding)::double x, unnest(range(64)) d from embeddings),
t as (select label, d, sum(x) s, count(*) n from x group by label, d),
c as (select x.vec_id, x.label, t.label other, t.n, x.x, t.s - case when t.label = x.label then x.x else 0 end s from x join t using (d)),
s as (select vec_id, label, other, round(sum(x * s) / (sqrt(sum(s * s)) + 1e-9), 6) score from c where n > 1 or other <> label group by vec_id, label, other),
r as (select *, row_number() over (partition by vec_id order by score desc, other) k from s),
loo as (select vec_id, label, max(other) filter (k = 1) pred, max(score) filter (k = 1) sim, max(score) filter (other = label) sim_true,
  round(max(score) filter (k = 1) - max(score) filter (k = 2), 6) margin from r group by vec_id, label)"""


@register("q_loo", _LOO + " select vec_id, label, pred, sim, sim_true, margin from loo")
def loo(spark, sf):
    return vec.leave_one_out(vectors(spark, sf), "vec_id", "label", "embedding")


@register("q_consistency", _LOO + """,
f as (select vec_id from loo where pred <> label and round(sim - sim_true, 6) > 0.10),
m2 as (select label, d, avg(x) m from x where vec_id not in (select vec_id from f) group by label, d),
u2 as (select label, d, m / (sqrt(sum(m * m) over (partition by label)) + 1e-9) m from m2),
s2 as (select x.vec_id, x.label, u2.label other, round(sum(x.x * u2.m), 6) score from x join u2 using (d) where x.vec_id in (select vec_id from f) group by 1, 2, 3)
select vec_id, true first_pass, coalesce(round(max(score) - max(score) filter (other = label), 6), 9.0) > 0.10 dropped from s2 group by vec_id""")
def consistency(spark, sf):
    return vec.consistency(vectors(spark, sf).withColumn("dur", F.lit(4.0)), "vec_id", "label", "embedding", "dur")


@register("q_knn", """with e as (select vec_id, embedding::double[] v from embeddings),
s as (select a.vec_id, b.vec_id other, round(list_inner_product(a.v, b.v), 6) score from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0),
r as (select *, row_number() over (partition by vec_id order by score desc, other) k from s) select vec_id, other, score from r where k = 1""")
def knn(spark, sf):
    items = vectors(spark, sf).select("vec_id", "embedding")
    return vec.nearest_in_blocks(items, "vec_id", "embedding", items.filter("vec_id % 20 = 0"))


@register("q_confusion", _LOO + " select label, pred, count(*) n from loo group by label, pred")
def confusion(spark, sf):
    from spanloom.operators.evaluate import confusion

    return confusion(vec.leave_one_out(vectors(spark, sf), "vec_id", "label", "embedding"), "label", "pred")


@register("q_fps", """with recursive e as (select vec_id, label, embedding::double[] v from embeddings),
p as (select label, vec_id, 1 pick, [vec_id] got from (select *, row_number() over (partition by label order by vec_id % 7 desc, vec_id) k from e) where k = 1
  union all select label, vec_id, pick, got from (
    select p.label, e.vec_id, p.pick + 1 pick, list_append(p.got, e.vec_id) got,
      row_number() over (partition by p.label order by round((select min(1 - list_inner_product(e.v, o.v)) from e o where o.label = p.label and list_contains(p.got, o.vec_id)), 6) desc, e.vec_id) k
    from p join e on e.label = p.label and not list_contains(p.got, e.vec_id) where p.pick < 5) where k = 1)
select label, vec_id, pick from p""")
def fps(spark, sf):
    items = vectors(spark, sf).withColumn("size", F.col("vec_id") % 7)
    return vec.exemplars(items, "vec_id", "label", "embedding", "size", 5)


@register("q_domain_fallback", """with p as (select label, vec_id % 3 as dom, count(*) n from embeddings where (vec_id % 3 + label) % 4 <> 0 group by 1, 2),
w as (select distinct label, d dom from embeddings cross join (values (0), (1), (2)) t(d)),
r as (select w.label, w.dom, p.dom used, p.n, row_number() over (partition by w.label, w.dom order by case when p.dom = w.dom then 0 else 1 + p.dom end) k from w left join p using (label))
select label, dom::bigint dom, used::bigint used_domain, n from r where k = 1""")
def domain_fallback(spark, sf):
    rows = vectors(spark, sf).withColumn("dom", F.col("vec_id") % 3)
    there = rows.filter("(dom + label) % 4 <> 0").groupBy("label", "dom").agg(F.count("*").alias("n"))
    wanted = rows.select("label").distinct().select("label", F.explode(F.array(*(F.lit(k).cast("long") for k in range(3)))).alias("dom"))
    return vec.with_fallback(wanted, there, "label", "dom", "n", [0, 1, 2])


@register("q_contrast", """with x as (select vec_id, label, unnest(embedding)::double x, unnest(range(64)) d from embeddings),
m as (select label, d, avg(x) m from x where vec_id % 4 < 2 group by label, d), u as (select label, d, m / (sqrt(sum(m * m) over (partition by label)) + 1e-9) m from m),
s as (select vec_id // 2 as pair, vec_id % 2 as side, u.label other, round(sum(x.x * u.m), 6) score from x join u using (d) where vec_id % 4 >= 2 group by 1, 2, 3),
r as (select *, row_number() over (partition by pair, side order by score desc, other) k from s),
t as (select a.pair, a.other la, b.other lb, a.score sa, b.score sb from r a join r b on a.pair = b.pair and a.side = 0 and b.side = 1 and a.k = 1 and b.k = 1 where a.other <> b.other)
select t.pair, la left_label, lb right_label, round(sa - x.score + sb - y.score, 6) contrast from t join r x on x.pair = t.pair and x.side = 0 and x.other = lb join r y on y.pair = t.pair and y.side = 1 and y.other = la""")
def contrast(spark, sf):
    rows = vectors(spark, sf).withColumn("pair", F.floor(F.col("vec_id") / 2))
    profile = vec.profiles(rows.filter("vec_id % 4 < 2"), ["label"], "embedding")
    half = lambda side: rows.filter(f"vec_id % 4 >= 2 and vec_id % 2 = {side}").select("pair", "embedding")
    return vec.contrast(half(0), half(1), "pair", "embedding", profile, "label", "profile")
