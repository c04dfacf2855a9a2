"""Queries of reports, signals, files and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.functions import vectors as vx
from spanloom.operators import report as rp
from spanloom.operators import signal as sg
from spanloom.operators.stages import run_stages
from spanloom.sources import subtitles as st
from spanloom.sources.files import private_folder
from spanloom.streaming import sessions as ss

from .registry import register
from .relational import table

_EP = """with e as (select o_custkey % 12 as season, o_orderkey k, case o_orderkey % 5 when 0 then 'none' when 1 then 'embedded_sdh' when 2 then 'embedded' else 'file_sdh' end source, (o_orderkey % 7 > 1)::int timing_ok, (o_orderkey % 13 = 0)::int is_double,
  case when o_orderkey % 3 = 0 then 6 else 2 end channels, o_totalprice / 10000 - 15 as length_delta from orders)"""


def _episodes(spark, sf):
    k = F.col("o_orderkey")
    source = F.when(k % 5 == 0, "none").when(k % 5 == 1, "embedded_sdh").when(k % 5 == 2, "embedded").otherwise("file_sdh")
    return table(spark, sf, "orders").select(
        (F.col("o_custkey") % 12).alias("season"), k.alias("k"), source.alias("source"), (k % 7 > 1).cast("int").alias("timing_ok"), (k % 13 == 0).cast("int").alias("is_double"),
        F.when(k % 3 == 0, 6).otherwise(2).alias("channels"), (F.col("o_totalprice") / 10000 - 15).alias("length_delta"),
    )


@register("q_inventory", _EP + """
select season, count(*) n_episodes, count(*) filter (source = 'none') n_no_subs, count(*) filter (ends_with(source, 'sdh')) n_sdh, count(*) filter (starts_with(source, 'embedded')) n_embedded, count(*) filter (timing_ok = 0) n_timing_bad,
  count(*) filter (is_double = 1) n_doubles, count(*) filter (channels = 6) n_51, count(*) filter (abs(length_delta) > 10) n_length_mismatch from e group by 1""")
def inventory(spark, sf):
    return rp.inventory(_episodes(spark, sf), "season", 10.0)["per_season"]


@register("q_inventory_frames", _EP + """
select 'missing' frame, count(*) n, sum(k)::bigint keys from e where source = 'none' union all select 'timing_bad', count(*), sum(k)::bigint from e where timing_ok = 0
union all select 'doubles', count(*), sum(k)::bigint from e where is_double = 1 union all select 'length_mismatch', count(*), sum(k)::bigint from e where abs(length_delta) > 10""")
def inventory_frames(spark, sf):
    frames = rp.inventory(_episodes(spark, sf), "season", 10.0)
    rows = [frames[n].agg(F.lit(n).alias("frame"), F.count("*").alias("n"), F.sum("k").alias("keys")) for n in ("missing", "timing_bad", "doubles", "length_mismatch")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


w = "(case when ({0})::double < 0 then '-' else '' end || floor(abs(({0})::double) + 0.5)::bigint)".format  # rounds halves away from zero


@register("q_causes", f"""
with c as (select o_orderkey, case when o_orderkey % 11 = 0 then null else (o_orderkey % 400 - 150)::double end d, (2000 + o_custkey % 9000)::double as dur, (1500 + o_orderkey % 3000)::double as last, case when o_orderkey % 4 = 0 then 42.0::double end listed from orders)
select case when d is null then 'unknown' when listed > 0 and dur > 1.7 * listed * 60 and dur > 4200 then 'probably a double episode (' || {w("dur / 60")} || ' min against ' || {w("listed")} || ')'
  when d > 30 and d < 120 then 'runs ' || {w("d")} || ' s past the end: frame-rate drift' when d > 30 then 'covers ' || {w("d / 60")} || ' min more than the file: other cut or wrong episode'
  when dur > 0 and last < 0.7 * dur then 'truncated at ' || {w("100 * last / dur")} || ' %' else 'ends ' || {w("-d / 60")} || ' min early: different cut' end cause, count(*) n from c group by 1""")
def causes(spark, sf):
    k = F.col("o_orderkey")
    delta = F.when(k % 11 != 0, (k % 400 - 150).cast("double"))
    cause = rp.probable_cause(delta, 2000.0 + F.col("o_custkey") % 9000, 1500.0 + k % 3000, F.when(k % 4 == 0, 42.0), 30.0)
    return table(spark, sf, "orders").groupBy(cause.alias("cause")).agg(F.count("*").alias("n"))


@register("q_resolution_report", """
with t as (select user_id % 9 as season, case event_type when 'click' then 'cast' when 'view' then 'alias' when 'signup' then 'host' when 'error' then 'stop' else 'unresolved' end kind, event_id % 5 + 1 as lines from events)
select season, sum(lines)::bigint lines, sum(case when kind = 'cast' then lines else 0 end)::bigint "cast", sum(case when kind = 'alias' then lines else 0 end)::bigint alias, sum(case when kind = 'host' then lines else 0 end)::bigint host,
  sum(case when kind = 'stop' then lines else 0 end)::bigint stop, sum(case when kind = 'unresolved' then lines else 0 end)::bigint unresolved,
  round(100 * sum(case when kind in ('cast', 'alias', 'host') then lines else 0 end) / nullif(sum(case when kind <> 'stop' then lines else 0 end), 0), 1) pct_resolved from t group by 1""")
def resolution_report(spark, sf):
    kind = F.when(F.col("event_type") == "click", "cast").when(F.col("event_type") == "view", "alias").when(F.col("event_type") == "signup", "host").when(F.col("event_type") == "error", "stop").otherwise("unresolved")
    tokens = table(spark, sf, "events").select((F.col("user_id") % 9).alias("season"), kind.alias("kind"), (F.col("event_id") % 5 + 1).alias("lines"))
    return rp.resolution_report(tokens, "season", "kind", "lines", ["cast", "alias", "host", "stop", "unresolved"])


@register("q_corpus_stats", """
with i as (select case when o_orderkey % 10 = 0 then 'test' when o_orderkey % 10 = 1 then 'dev' else 'train' end split, o_custkey % 30 as ep, o_orderstatus l, o_totalprice / 1000 as s from orders)
select 'all' of, 'items' as name, count(*) n, round(sum(s) / 3600, 2) as hours from i union all select 'all', 'labels', count(distinct l), round(sum(s) / 3600, 2) from i union all select 'split', split, count(*), round(sum(s) / 3600, 2) from i group by split
union all select 'label', l, count(*), round(sum(s) / 3600, 2) from i group by l union all select 'episodes', split, count(distinct ep), round(sum(s) / 3600, 2) from i group by split""")
def corpus_stats(spark, sf):
    k = F.col("o_orderkey")
    items = table(spark, sf, "orders").select(F.when(k % 10 == 0, "test").when(k % 10 == 1, "dev").otherwise("train").alias("split"), (F.col("o_custkey") % 30).alias("ep"), F.col("o_orderstatus").alias("l"), (F.col("o_totalprice") / 1000).alias("s"))
    return rp.corpus_statistics(items, "split", "ep", "l", "s")


@register("q_episode_titles", """
with l as (select case when n_nationkey % 6 <> 5 then n_nationkey % 5 end season, n_name title, n_nationkey * 2 as length from nation) select c_custkey, title, length from customer left join (select season, min((title, length)) t, min((title, length))[1] title, min((title, length))[2] length from l where season is not null group by 1) on season = c_nationkey""")
def episode_titles(spark, sf):
    listed = table(spark, sf, "nation").select(F.when(F.col("n_nationkey") % 6 != 5, F.col("n_nationkey") % 5).alias("season"), F.col("n_name").alias("title"), (F.col("n_nationkey") * 2).alias("length"))
    return rp.episode_titles(table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("season")), listed, ["season"]).select("c_custkey", "title", "length")


@register("q_confident", "select o_orderpriority in ('1-URGENT', '2-HIGH') confident, map_extract(map {'F': 'final', 'O': 'open'}, o_orderstatus)[1] said, count(*) n from orders group by 1, 2")
def confident(spark, sf):
    """Decisions that count as made, and codes put in words by a lookup; a code it lacks gives null."""
    said = F.try_element_at(F.create_map(F.lit("F"), F.lit("final"), F.lit("O"), F.lit("open")), F.col("o_orderstatus"))
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("confident"), said.alias("said")).agg(F.count("*").alias("n"))


@register("q_relabelled", "select map_extract(map {'F': 'final', 'O': 'open', 'P': 'partly'}, o_orderstatus)[1] said, count(*) n from orders group by 1")
def relabelled(spark, sf):
    """Codes put in words by a lookup that must know them all."""
    said = tx.in_words(F.col("o_orderstatus"), {"F": "final", "O": "open", "P": "partly"}, "order status")
    return table(spark, sf, "orders").groupBy(said.alias("said")).agg(F.count("*").alias("n"))


@register("q_stages", """
with s as (select unnest([{'run': 1, 'a': 'ran', 'b': 'ran', 'c': 'after'}, {'run': 2, 'a': 'there', 'b': 'there', 'c': 'ran'}, {'run': 3, 'a': 'before', 'b': 'ran', 'c': 'ran'}]) s),
c as (select o_custkey % 10 as g, sum(round(o_totalprice) * 2)::bigint total from orders where o_orderstatus <> 'P' group by 1)
select s.run::int run, s.a big, s.b doubled, s.c summed, (select count(*) from orders where o_orderstatus <> 'P')::bigint n_doubled, (select sum(total) from c)::bigint total from s""")
def stages(spark, sf):
    """Three stages run up to the second, then all, then from the second by force: what became of each, and the same rows in the end."""
    folder = private_folder(spark, "stages")
    made = [
        ("big", lambda df: df.filter("o_orderstatus <> 'P'")), ("doubled", lambda df: df.select((F.col("o_custkey") % 10).alias("g"), (F.round("o_totalprice") * 2).alias("x"))), ("summed", lambda df: df.groupBy("g").agg(F.sum("x").cast("long").alias("total"))),
    ]
    orders, told = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_totalprice"), []
    for run, asked in enumerate(({"through": "doubled"}, {}, {"first": "doubled", "force": True}), 1):
        rows, done = run_stages(made, orders, folder, **asked)
        told.append((run, done["big"], done["doubled"], done["summed"]))
    doubled = spark.read.parquet(f"{folder}/01-doubled").agg(F.count("*").alias("n_doubled"))
    shape = spark.createDataFrame(told, "run int, big string, doubled string, summed string")
    return shape.crossJoin(F.broadcast(doubled)).crossJoin(F.broadcast(rows.agg(F.sum("total").alias("total"))))  # one row each


@register("q_log_rms", """
with f as (select vec_id, unnest(range(8)) k, embedding::double[] v from embeddings) select vec_id, k::int frame, round(ln(sqrt(list_sum(list_transform(v[k * 8 + 1:k * 8 + 8], lambda x: x * x)) / 8 + 1e-12) + 1e-6), 5) level from f""")
def log_rms(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(sg.log_rms(F.col("embedding"), 8)).alias("frame", "level")).withColumn("level", F.round("level", 5))


@register("q_signal_ratio", "select vec_id, round(sqrt(list_sum(list_transform(embedding[1:16]::double[], lambda x: x * x)) / 16) / (sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x)) / 64) + 1e-9), 5) ratio from embeddings")
def signal_ratio(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.round(sg.rms_ratio(F.slice("embedding", 1, 16), F.col("embedding")), 5).alias("ratio"))


@register("q_cue_frames", """
with c as (select conv_id, turn * 2.0 s, turn * 2.0 + length(text) % 5 / 2 e from conversations), n as (select conv_id, max(turn) * 4 + 6 n from conversations group by 1),
f as (select distinct conv_id, unnest(range(greatest(floor(s / 0.5), 0)::bigint, least(ceil(e / 0.5), n)::bigint)) k from c join n using (conv_id))
select conv_id, n n_frames, count(k) n_on, coalesce(sum(k), 0)::bigint places from n left join f using (conv_id) group by 1, 2""")
def cue_frames(spark, sf):
    rows = table(spark, sf, "conversations")
    cues = rows.select("conv_id", (F.col("turn") * 2.0).alias("s"), (F.col("turn") * 2.0 + F.length("text") % 5 / 2).alias("e"))
    lengths = rows.groupBy("conv_id").agg((F.max("turn") * 4 + 6).alias("n"))
    on = F.filter(F.transform("on", lambda x, k: F.when(x == 1, k)), lambda k: k.isNotNull())
    return sg.cue_frames(cues, lengths, "conv_id", "s", "e", "n", 0.5).select("conv_id", F.size("on").cast("long").alias("n_frames"), F.size(on).cast("long").alias("n_on"), F.aggregate(on, F.lit(0).cast("long"), lambda acc, k: acc + k).alias("places"))


@register("q_packed_vectors", "select vec_id, 256 n_bytes, round(sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))), 5) norm from embeddings")
def packed_vectors(spark, sf):
    packed = table(spark, sf, "embeddings").select("vec_id", sg.packed_vector(F.col("embedding")).alias("data"))
    return packed.select("vec_id", F.length("data").alias("n_bytes"), F.round(vx.norm(sg.unpacked_vector(F.col("data"))), 5).alias("norm"))


@register("q_ragged_frames", """
with w as (select vec_id, unnest([0, 5, 6]) z, unnest([5, 1, 4]) n, unnest([10, 20, 30]) s, embedding::double[] v from embeddings), f as (select vec_id, s, z, v, unnest(range(n)) k from w) select vec_id, s::int window_start, k::int frame_no, round(v[z + k + 1], 6) as "value" from f""")
def ragged_frames(spark, sf):
    tracks = table(spark, sf, "embeddings").select("vec_id", F.lit([10, 20, 30]).alias("starts"), F.lit([5, 1, 4]).alias("lens"), "embedding")
    return sg.ragged_frames(tracks, "vec_id", "starts", "lens", "embedding").withColumn("value", F.round(F.col("value").cast("double"), 6))


@register("q_anchor_fit", """
with b as (select user_id, case when event_id % 2 = 0 then 's' else 'e' end kind, event_id cue, epoch_us(ts) / 1e6 t, value - 10 lag from events where value > 8), c as (select user_id, count(*) n from events group by 1),
f as (select user_id, count(distinct case when kind = 's' then cue end) ns, count(distinct round(t, 2)) nk, median(lag) m from b group by 1)
select user_id, round(coalesce(ns, 0) / n, 6) share, coalesce(nk, 0) n_knots, case when coalesce(ns, 0) / n >= 0.3 and nk >= 5 then round(m, 6) end as "offset", case when coalesce(ns, 0) / n >= 0.3 and nk >= 5 then 'anchors' else 'envelope' end source from c left join f using (user_id)""")
def anchor_fit(spark, sf):
    from .sequence import events

    rows = events(spark, sf)
    bounds = rows.filter("value > 8").select("user_id", F.when(F.col("event_id") % 2 == 0, "s").otherwise("e").alias("kind"), F.col("event_id").alias("cue"), (F.col("t") / F.lit(1e6)).alias("t_s"), (F.col("value") - 10).alias("lag"))
    return sg.anchor_fit(bounds, rows.select("user_id"), "user_id", 0.3, 5).select("user_id", F.round("share", 6).alias("share"), "n_knots", F.round("offset", 6).alias("offset"), "source")


# ---- files: written to the shared folder and read back


@register("q_turn_files", "select 'U' || conv_id uri, turn * 2.5::double start_s, round(1 + length(text) % 40 / 8.0, 3)::double dur_s, role speaker from conversations")
def turn_files(spark, sf):
    turns = table(spark, sf, "conversations").select(F.concat(F.lit("U"), "conv_id").alias("uri"), (F.col("turn") * 2.5).alias("start_s"), F.round(1 + F.length("text") % 40 / 8.0, 3).alias("dur_s"), F.col("role").alias("speaker"))
    path = private_folder(spark, "turns")
    st.write_turns(turns, path)
    return st.read_turns(spark, path)


@register("q_spans_files", "select 'U' || conv_id uri, min(turn) * 2.5::double start_s, max(turn) * 2.5::double + 2 end_s from conversations group by conv_id")
def spans_files(spark, sf):
    spans = table(spark, sf, "conversations").groupBy(F.concat(F.lit("U"), "conv_id").alias("uri")).agg((F.min("turn") * 2.5).alias("start_s"), (F.max("turn") * 2.5 + 2).alias("end_s"))
    path = private_folder(spark, "spans")
    st.write_spans(spans, path)
    return st.read_spans(spark, path)


@register("q_manifest_files", "select case when o_orderkey % 10 = 0 then 'dev' else 'train' end split, count(*) n, sum(o_custkey)::bigint keys from orders group by 1")
def manifest_files(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 10 == 0, "dev").otherwise("train").alias("split"))
    path = private_folder(spark, "manifest")
    st.write_manifest(rows, path)
    return st.read_manifest(spark, path, "o_orderkey long, o_custkey long").groupBy("split").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


@register("q_trial_files", "select (o_custkey % 2)::int target, 'a' || o_orderkey a, 'b' || o_custkey b from orders")
def trial_files(spark, sf):
    rows = table(spark, sf, "orders").select((F.col("o_custkey") % 2).cast("int").alias("target"), F.concat(F.lit("a"), "o_orderkey").alias("a"), F.concat(F.lit("b"), "o_custkey").alias("b"))
    path = private_folder(spark, "trials")
    st.write_trials(rows, path)
    return st.read_trials(spark, path)


@register("q_word_cache", "select conv_id % 3 = 0 as bare, count(*) n, round(sum(turn * 1.5), 3)::double starts from conversations group by 1")
def word_cache(spark, sf):
    word = F.to_json(F.array(F.col("role"), (F.col("turn") * 1.5).cast("string"), F.lit("2.5")))
    listed = F.concat(F.lit("["), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", F.regexp_replace(F.regexp_replace(word, '"([0-9.]+)"', "$1"), "^$", "").alias("w")))), lambda x: x["w"]), ","), F.lit("]"))
    docs = table(spark, sf, "conversations").groupBy("conv_id").agg(listed.alias("l")).select(F.when(F.col("conv_id") % 3 == 0, F.col("l")).otherwise(F.concat(F.lit('{"audio_s":1,"words":'), "l", F.lit("}"))).alias("value"), (F.col("conv_id") % 3 == 0).cast("string").alias("bare"))
    path = private_folder(spark, "words")
    docs.write.partitionBy("bare").text(path)
    found = st.read_word_cache(spark, path)
    return found.groupBy(F.col("file").contains("bare=true").alias("bare")).agg(F.count("*").alias("n"), F.round(F.sum("start_s"), 3).alias("starts"))


@register("q_vector_files", "select label, count(*) n, round(sum(embedding[1]::double), 4) first_sum from embeddings where label <> 3 group by 1 union all select 3, count(*), round(-sum(embedding[1]::double), 4) from embeddings where label = 3")
def vector_files(spark, sf):
    """Vectors written by partition; one partition is written again with other values, and the others stay."""
    from spanloom.operators.merge import write_partitions

    rows = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    path = private_folder(spark, "vectors")
    write_partitions(rows, path, ["label"])
    write_partitions(rows.filter("label = 3").withColumn("embedding", F.transform("embedding", lambda x: -x)), path, ["label"])
    return spark.read.schema(rows.schema).parquet(path).groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum(F.col("embedding")[0].cast("double")), 4).alias("first_sum"))


@register("q_file_facts", r"""
with c as (select conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) x from conversations)
select conv_id, count(*) filter (x <> '') n_cues, min(turn * 2.5::double) filter (x <> '') first_s, max(turn * 2.5::double + 2.25) filter (x <> '') last_s, case when count(*) filter (x <> '') = 0 then 'no cues' end parse_error from c group by 1""")
def file_facts(spark, sf):
    """The facts of timed texts made from conversations."""
    text = F.trim(F.regexp_replace("text", r"\s+", " "))
    block = st.render_cues(F.col("turn") + 1, F.col("turn") * 2.5, F.col("turn") * 2.5 + 2.25, text)
    files = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", block.alias("b")))), lambda x: x["b"]), "\n").alias("srt"))
    return st.file_facts(files, "conv_id", "srt")


@register("q_scrubbed", """select conv_id, '{"turn":' || turn || ',"inner":{"kept":"' || role || '"}}' as body from conversations""")
def scrubbed(spark, sf):
    nested = table(spark, sf, "conversations").select("conv_id", "text", F.struct("turn", "text", F.struct(F.col("role").alias("kept"), F.col("text").alias("sdh_name")).alias("inner")).alias("body"))
    return st.without_fields(nested).select("conv_id", F.to_json("body").alias("body"))


@register("q_report_files", "select n_nationkey, null as missing, n_name from nation")
def report_files(spark, sf):
    path = private_folder(spark, "report")
    st.write_report(table(spark, sf, "nation"), path, ["n_nationkey", "missing", "n_name"])
    return spark.read.schema("n_nationkey int, missing string, n_name string").option("header", True).csv(path)


@register("q_encodings", "select c_custkey, 'éñ ' || c_custkey as line from customer")
def encodings(spark, sf):
    """Text files, some in UTF-8 and some in Latin-1 (as Windows-1252 has it), read by the same reader."""
    rows = table(spark, sf, "customer").select(F.concat(F.lit("éñ "), F.col("c_custkey").cast("string")).alias("value"), F.col("c_custkey") % 2 == 0)
    path = private_folder(spark, "encoded")
    for n, encoding in enumerate(("UTF-8", "iso-8859-1")):
        rows.filter(rows[1] == (n == 0)).select("value").write.mode("append").option("encoding", encoding).option("quote", "").csv(path)
    lines = st.read_texts(spark, path, "*.csv").select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    return lines.select(F.regexp_extract("line", "([0-9]+)$", 1).cast("long").alias("c_custkey"), "line")


@register("q_ids", """
select o_orderkey, 'S' || (o_custkey % 40) || '_E' || lpad((o_orderkey % 17)::varchar, 2, '0') || '_U' || lpad((o_orderkey % 9999)::varchar, 4, '0') id, (o_custkey % 40)::int season, (o_orderkey % 17)::int episode, case when o_orderkey % 3 = 0 then (o_orderkey % 17 + 1)::int end second_episode from orders""")
def ids(spark, sf):
    k, s = F.col("o_orderkey"), (F.col("o_custkey") % 40).cast("string")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    name = F.concat(F.lit("show.s"), F.lpad(s, 2, "0"), F.lit("e"), two(k % 17), F.when(k % 3 == 0, F.concat(F.lit("e"), two(k % 17 + 1))).otherwise(F.lit("")), F.lit(".mkv"))
    return table(spark, sf, "orders").select("o_orderkey", tx.item_id(F.concat(F.lit("S"), s), k % 17, "U", k % 9999).alias("id"), tx.season_episode(name).alias("n")).select("o_orderkey", "id", "n.*")


@register("q_stamps", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') at_utc from events")
def stamps(spark, sf):
    from spanloom.functions.time import micros

    return table(spark, sf, "events").select("event_id", st.stamp(F.timestamp_micros(micros("ts"))).alias("at_utc"))


@register("q_italics", """
with l as (select conv_id, turn, case turn % 5 when 1 then '<i>' || substr(text, 1, 9) when 3 then substr(text, 1, 9) || '</i>' when 4 then '<I>all</I>' else substr(text, 1, 9) end line from conversations),
f as (select *, regexp_matches(line, '(?i)<i\\b[^>]*>') o, regexp_matches(line, '(?i)</i\\s*>') c from l), s as (select *, last_value(case when o and not c then true when c and not o then false end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) was from f)
select conv_id, turn, o or coalesce(was, false) is_italic from s""")
def italics(spark, sf):
    cut, k = F.substring("text", 1, 9), F.col("turn") % 5
    line = F.when(k == 1, F.concat(F.lit("<i>"), cut)).when(k == 3, F.concat(cut, F.lit("</i>"))).when(k == 4, "<I>all</I>").otherwise(cut)
    return tx.italic_lines(table(spark, sf, "conversations").select("conv_id", "turn", line.alias("line")), ["conv_id"], "turn", "line").select("conv_id", "turn", "is_italic")


# ---- streams


@register("q_stream_dedupe", """
with recursive o as (select user_id, epoch_us(ts) / 1e6 t, row_number() over (partition by user_id order by epoch_us(ts), event_id) rn from events),
f as (select user_id, rn, t, t a from o where rn = 1 union all select o.user_id, o.rn, o.t, case when o.t - f.a <= 86400 then f.a else o.t end from f join o on o.user_id = f.user_id and o.rn = f.rn + 1)
select user_id, count(distinct a) n_kept, round(min(a) * 1e6)::bigint first_us from f group by 1""")
def stream_dedupe(spark, sf):
    from spanloom.functions.time import micros

    stream = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf).select("user_id", (micros("ts") / F.lit(1e6)).alias("at"))
    kept = ss.run_available(ss.dedupe_stream(stream, "user_id", "at", 86_400.0), private_folder(spark, "deduped"), private_folder(spark, "state"))
    return kept.groupBy("user_id").agg(F.count("*").alias("n_kept"), F.round(F.min("at") * 1e6).cast("long").alias("first_us"))


@register("q_stream_changes", """
with recursive o as (select user_id, value, row_number() over (partition by user_id order by epoch_us(ts), event_id) rn from events),
f as (select user_id, rn, value last, 1 keep from o where rn = 1 union all select o.user_id, o.rn, case when abs(o.value - f.last) >= 15 then o.value else f.last end, (abs(o.value - f.last) >= 15)::int from f join o on o.user_id = f.user_id and o.rn = f.rn + 1)
select user_id, sum(keep)::bigint n_kept from f group by 1""")
def stream_changes(spark, sf):
    from spanloom.functions.time import micros

    stream = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf).select("user_id", (micros("ts") / F.lit(1e6)).alias("at"), "value")
    kept = ss.run_available(ss.changes_stream(stream, "user_id", "at", "value", 15.0), private_folder(spark, "changed"), private_folder(spark, "state"))
    return kept.groupBy("user_id").agg(F.count("*").alias("n_kept"))
