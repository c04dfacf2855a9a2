"""Queries over names, texts and timed text."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import resolve as rs
from spanloom.sources import subtitles as st

from .registry import register
from .relational import table


@register("q_token_norm", r"""
select p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(upper(p_name || ' (x) ' || p_brand || ' - '), '\([^)]*\)', '', 'g'), '[^A-Z0-9.''\- #]', ' ', 'g'), '\s+', ' ', 'g'), ' .-') token from part""")
def token_norm(spark, sf):
    return table(spark, sf, "part").select("p_partkey", tx.token_norm(F.concat("p_name", F.lit(" (x) "), "p_brand", F.lit(" - "))).alias("token"))


@register("q_slug", "select c_custkey, trim(lower(regexp_replace(c_name || ' & ' || c_mktsegment || '!', '[^A-Za-z0-9]+', '-', 'g')), '-') slug from customer")
def slug(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", tx.slug(F.concat("c_name", F.lit(" & "), "c_mktsegment", F.lit("!"))).alias("slug"))


@register("q_upper_share", r"""
select doc_id, round(case when length(regexp_replace(text, '\P{L}', '', 'g')) = 0 then 0.0 else length(regexp_replace(text, '\P{Lu}', '', 'g')) / length(regexp_replace(text, '\P{L}', '', 'g')) end, 6) share from documents""")
def upper_share(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(tx.upper_share(F.col("text")), 6).alias("share"))


@register("q_mentions", """
with b as (select item_id, regexp_extract_all(lower(text), '([a-z]+)', 1) w from benchmark),
n as (select item_id, w[1] || ' ' || w[2] a, w[3] || ' ' || w[4] b from b where len(w) >= 4)
select doc_id, item_id from documents, n where regexp_matches(' ' || lower(text) || ' ', '[^a-z''](?:' || a || '|' || b || ')[^a-z]')""")
def mentions(spark, sf):
    w = tx.name_words(F.col("text"))
    items = table(spark, sf, "benchmark").filter(F.size(w) >= 4).select("item_id", F.explode(F.array(F.concat_ws(" ", w[0], w[1]), F.concat_ws(" ", w[2], w[3]))).alias("name"))
    return rs.mentions(table(spark, sf, "documents"), "doc_id", "text", items, "item_id", "name").select("doc_id", "item_id")


@register("q_fuzzy", """
with w as (select distinct unnest(string_split(lower(p_name), ' ')) token from part),
c as (select distinct substr(token, 1, length(token) - 1) token from w where length(token) >= 5 union select token from w where length(token) >= 4),
n as (select token as name from w where length(token) >= 4),
p as (select c.token, name, levenshtein(c.token, name) d from c, n where length(c.token) >= 4 and levenshtein(c.token, name) <= 1),
g as (select token, min(d) d, count(*) k, arg_min(name, (d, name)) name from p group by token)
select token, name, d::int distance from g where d = 0 or k = 1""")
def fuzzy(spark, sf):
    words = table(spark, sf, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("token")).distinct()
    cut = words.filter("length(token) >= 5").select(F.expr("substring(token, 1, length(token) - 1)").alias("token")).unionByName(words)
    return rs.fuzzy_unique(cut, words.withColumnRenamed("token", "name"), "token", "name")


@register("q_resolve", """
with w as (select upper(n_name) t from nation union select upper(substr(n_name, 1, 3)) from nation union select upper(r_name) from region union select upper(c_mktsegment) from customer),
a as (select upper(n_name) token, list_sort(list(distinct n_nationkey)) v from nation group by 1), r as (select upper(r_name) token, list_sort(list(distinct 100 + r_regionkey)) v from region group by 1),
p as (select upper(substr(n_name, 1, 3)) token, list_sort(list(distinct n_nationkey)) v from nation group by 1)
select t token, case when len(coalesce(a.v, r.v, p.v)) = 1 then coalesce(a.v, r.v, p.v)[1] end resolved,
  case when coalesce(a.v, r.v, p.v) is null then 'unresolved' when len(coalesce(a.v, r.v, p.v)) > 1 then 'ambiguous' when a.v is not null then 'nation' when r.v is not null then 'region' else 'prefix' end via,
  len(coalesce(a.v, r.v, p.v)) n_values from w left join a on a.token = t left join r on r.token = t left join p on p.token = t""")
def resolve(spark, sf):
    nation, region, customer = (table(spark, sf, n) for n in ("nation", "region", "customer"))
    short = F.upper(F.substring("n_name", 1, 3)).alias("token")
    full, regions = nation.select(F.upper("n_name").alias("token"), F.col("n_nationkey").alias("value")), region.select(F.upper("r_name").alias("token"), (F.col("r_regionkey") + 100).alias("value"))
    tokens = full.select("token").unionByName(nation.select(short)).unionByName(regions.select("token")).unionByName(customer.select(F.upper("c_mktsegment").alias("token"))).distinct()
    found = rs.first_lookup(tokens, "token", [("nation", full), ("region", regions), ("prefix", nation.select(short, F.col("n_nationkey").alias("value")))])
    return found.select("token", "resolved", "via", F.when(F.col("resolved").isNotNull(), F.lit(1)).otherwise(F.size("candidates")).cast("long").alias("n_values"))


@register("q_block_match", """
with d as (select doc_id, regexp_extract_all(lower(text), '([a-z0-9'']+)', 1) w from documents), b as (select item_id, regexp_extract_all(lower(text), '([a-z0-9'']+)', 1) w from benchmark),
ds as (select doc_id, unnest(range(len(w) - 7)) at0, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' '))) s from d where len(w) >= 8),
bs as (select distinct item_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' '))) s from b where len(w) >= 8)
select doc_id, item_id, count(*) n, min(at0)::int first_at from ds join bs using (s) group by 1, 2""")
def block_match(spark, sf):
    words = tx.word_tokens(F.col("text"))
    return rs.shared_blocks(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "item_id", words, words, 8)


@register("q_convention", """
with l as (select doc_id, unnest(string_split(text, chr(10))) line from documents)
select doc_id, count(*) n_lines, count(*) filter (length(line) > 80) n_long, count(*) filter (regexp_matches(line, '[.?!]$')) n_closed, count(*) filter (length(line) > 80) >= 2 has_long,
  round(count(*) filter (regexp_matches(line, '[.?!]$')) / count(*), 6) closed_share from l group by doc_id""")
def convention(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    long, closed = F.count_if(F.length("line") > 80), F.count_if(F.col("line").rlike("[.?!]$"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), long.alias("n_long"), closed.alias("n_closed"), (long >= 2).alias("has_long"), F.round(closed / F.count("*"), 6).alias("closed_share"))


@register("q_srt_parse", r"""
select conv_id, (row_number() over (partition by conv_id order by turn) - 1)::int idx, turn * 2.5::double start_s, turn * 2.5::double + 2.25 end_s, trim(regexp_replace(text, '\s+', ' ', 'g')) raw_text
from conversations where length(trim(regexp_replace(text, '\s+', ' ', 'g'))) > 0""")
def srt_parse(spark, sf):
    text = F.trim(F.regexp_replace("text", r"\s+", " "))
    rows = table(spark, sf, "conversations").filter(F.length(text) > 0)
    block = st.render_cues(F.col("turn") + 1, F.col("turn") * 2.5, F.col("turn") * 2.5 + 2.25, text)
    files = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", block.alias("b")))), lambda x: x["b"]), "\n").alias("srt"))
    return st.parse_cues(files, "conv_id", "srt")


_NAMES = "n as (select distinct lower(n_name) nm from nation), t as (select distinct substr(lower(n_name), 1, length(n_name) - 1) || 'x' tok from nation union select lower(n_name) from nation union select lower(substr(n_name, 2)) from nation)"


@register("q_fuzzy_ratio", f"""
with recursive {_NAMES},
p as (select tok, nm, 0 i, list_transform(range(length(nm) + 1), lambda x: 0) c from t, n
  union all select tok, nm, i + 1, list_prepend(0, list_transform(range(1, length(nm) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(c[k + 1], case when nm[k] = tok[i + 1] then c[k] + 1 else 0 end)))))
  from p where i < length(tok)),
r as (select tok, nm, 200.0 * c[length(nm) + 1] / (length(tok) + length(nm)) s from p where i = length(tok)),
b as (select tok, nm, s, row_number() over (partition by tok order by s desc, nm) k from r where s >= 85),
e as (select tok, min(nm) nm, min(levenshtein(tok, nm)) d, count(*) q from t, n where length(tok) >= 4 and length(nm) >= 4 and levenshtein(tok, nm) <= 1 and tok not in (select tok from b) group by tok)
select tok token, nm as name, round(s, 5) score from b where k = 1 union all select tok, nm, 85.0 from e where q = 1 or d = 0""")
def fuzzy_ratio(spark, sf):
    nation = table(spark, sf, "nation").select(F.lower("n_name").alias("name"))
    less = F.expr("concat(substring(name, 1, length(name) - 1), 'x')")
    tokens = nation.select(F.explode(F.array("name", less, F.expr("substring(name, 2)"))).alias("token")).distinct()
    return rs.fuzzy_best(tokens, nation, "token", "name").select("token", "name", F.round("score", 5).alias("score"))


@register("q_clean_lines", r"""
with l as (select item_id, case item_id % 7 when 0 then '>> ' || upper(substr(text, 1, 6)) || ': <i>' || substr(text, 8, 20) || '</i>' when 1 then '- ' || substr(text, 1, 20) || ' (laughs) go' when 2 then '(' || substr(text, 1, 20) || ')'
  when 3 then '♪ ' || substr(text, 1, 12) || ' ♪' when 4 then 'MAN #2 (V.O.): ' || substr(text, 1, 15) when 5 then '– [' || substr(text, 1, 9) || '] yes' else 'Plain: ' || substr(text, 1, 15) end as line from benchmark),
b as (select item_id, trim(regexp_replace(line, '<[^>]+>|\{\\[^}]*\}', '', 'g'), e' \t\r\n') s from l),
t as (select item_id, regexp_matches(s, '^\s*(?:>>|[-–—])\s*') turn, regexp_replace(s, '^\s*(?:>>|[-–—])\s*', '') s from b),
n as (select *, regexp_extract(s, '^\s*([A-Z][A-Z0-9.''\-#]*(?:\s+[A-Z0-9#][A-Z0-9.''\-#]*){0,2})\s*(?:\([^)]*\))?\s*:\s*(.*)$', 1) nm, regexp_extract(s, '^\s*([A-Z][A-Z0-9.''\-#]*(?:\s+[A-Z0-9#][A-Z0-9.''\-#]*){0,2})\s*(?:\([^)]*\))?\s*:\s*(.*)$', 2) more from t),
r as (select item_id, turn, case when length(nm) >= 2 then trim(nm, ' .') end as name, case when length(nm) >= 2 then more else s end s from n),
q as (select *, s <> '' and (regexp_matches(s, '^\s*(?:\([^)]*\)|\[[^\]]*\]|♪+.*♪*|\*[^*]*\*)\s*$') or (regexp_matches(s, '[♪♫]') and length(regexp_replace(s, '[♪♫\s]', '', 'g')) < 3)) snd from r)
select item_id, case when snd then '' else trim(regexp_replace(regexp_replace(regexp_replace(s, '\([^()]*\)', '', 'g'), '\[[^\[\]]*\]', '', 'g'), '\s+', ' ', 'g')) end as text, name, turn is_turn, snd is_sound from q""")
def clean_lines(spark, sf):
    cut = lambda a, n: F.substring("text", a, n)
    lines = [
        F.concat(F.lit(">> "), F.upper(cut(1, 6)), F.lit(": <i>"), cut(8, 20), F.lit("</i>")), F.concat(F.lit("- "), cut(1, 20), F.lit(" (laughs) go")), F.concat(F.lit("("), cut(1, 20), F.lit(")")),
        F.concat(F.lit("♪ "), cut(1, 12), F.lit(" ♪")), F.concat(F.lit("MAN #2 (V.O.): "), cut(1, 15)), F.concat(F.lit("– ["), cut(1, 9), F.lit("] yes")), F.concat(F.lit("Plain: "), cut(1, 15)),
    ]
    line = F.element_at(F.array(*lines), (F.col("item_id") % 7 + 1).cast("int"))
    return table(spark, sf, "benchmark").select("item_id", tx.clean_line(line).alias("c")).select("item_id", "c.*")


@register("q_place_cards", r"""
with c as (select page_id, upper(regexp_extract(url, '([a-z]{2,12})', 1)) || case when page_id % 3 = 0 then ' TRIBE / ' when page_id % 3 = 1 then ' / ' else ' 9 ' end || case when page_id % 4 = 0 then 'NIGHT ' else 'DAY ' end || (page_id % 40) card from pages)
select page_id, replace(trim(regexp_extract(card, '^([A-Z][A-Z'' .-]{1,30}?)\s*(?:TRIBE)?\s*[/|]?\s*(DAY|NIGHT)\s*(\d{1,2})\b', 1)), ' TRIBE', '') tribe,
  lower(regexp_extract(card, '(DAY|NIGHT) \d+$', 1)) kind, (page_id % 40)::int n from c where regexp_matches(card, '^([A-Z][A-Z'' .-]{1,30}?)\s*(?:TRIBE)?\s*[/|]?\s*(DAY|NIGHT)\s*(\d{1,2})\b')""")
def place_cards(spark, sf):
    k = F.col("page_id")
    name = F.upper(F.regexp_extract("url", "([a-z]{2,12})", 1))
    when = F.concat(F.when(k % 4 == 0, "NIGHT ").otherwise("DAY "), (k % 40).cast("string"))
    lines = F.when(k % 3 == 0, F.array(F.concat(name, F.lit(" TRIBE")), when)).when(k % 3 == 1, F.array(name, F.lit(" "), when)).otherwise(F.array(F.concat(name, F.lit(" 9 "), when)))
    return table(spark, sf, "pages").select("page_id", tx.location_card(lines).alias("c")).filter("c is not null").select("page_id", "c.*")


@register("q_title_tests", """
select page_id, contains(lower(url), 'the') or contains(lower(url), 'example') or contains(lower(url), '.cc.') hit, starts_with(url, 'https') secure, not starts_with(url, 'http://a') as other from pages""")
def title_tests(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.contains_any(F.col("url"), ["the", "example", ".cc."]).alias("hit"), F.col("url").like("https%").alias("secure"), (~F.col("url").like("http://a%")).alias("other"))


@register("q_int_lists", "select o_orderkey, [o_orderkey % 7, o_custkey % 5, 12]::int[]::varchar as items, (o_orderkey % 7 + o_custkey % 5 + 12)::bigint total from orders")
def int_lists(spark, sf):
    text = F.concat((F.col("o_orderkey") % 7).cast("string"), F.lit(", "), (F.col("o_custkey") % 5).cast("string"), F.lit(",,12 "))
    found = table(spark, sf, "orders").select("o_orderkey", tx.int_list(text).alias("x"))
    return found.select("o_orderkey", F.concat(F.lit("["), F.array_join(F.col("x").cast("array<string>"), ", "), F.lit("]")).alias("items"), F.aggregate("x", F.lit(0).cast("long"), lambda acc, v: acc + v).alias("total"))


@register("q_prompts", """
with r as (select n_regionkey, string_agg('| ' || n_nationkey || ' | ' || n_name || ' |', chr(10) order by n_nationkey) t from nation group by 1)
select r_regionkey, 'Candidates of ' || r_name || ':' || chr(10) || '| key | name |' || chr(10) || '|---|---|' || chr(10) || t prompt from region join r on n_regionkey = r_regionkey""")
def prompts(spark, sf):
    packed = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("rows"))
    both = table(spark, sf, "region").join(packed, F.col("n_regionkey") == F.col("r_regionkey"))
    asked = tx.markdown_table(["key", "name"], F.col("rows"), lambda r: [r["n_nationkey"], r["n_name"]])
    return both.select("r_regionkey", F.concat(F.lit("Candidates of "), "r_name", F.lit(":\n"), asked).alias("prompt"))


@register("q_ordered_blocks", """
with recursive w as (select conv_id, turn, unnest(regexp_extract_all(lower(text), '([a-z0-9'']+)', 1)) tok, unnest(range(len(regexp_extract_all(lower(text), '([a-z0-9'']+)', 1)))) k from conversations),
s as (select conv_id, list(tok order by turn, k) x from w group by 1)
select conv_id, 0::bigint a_at, 0::bigint b_at, (len(x) // 2)::bigint n from s where len(x) // 2 >= 3
union all select conv_id, (len(x) // 2)::bigint, (len(x) // 2 + 1)::bigint, (len(x) - len(x) // 2)::bigint from s where len(x) - len(x) // 2 >= 3""")
def ordered_blocks(spark, sf):
    said = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("turn", tx.word_tokens(F.col("text")).alias("w")))), lambda x: x["w"]))
    both = table(spark, sf, "conversations").groupBy("conv_id").agg(said.alias("a")).withColumn("h", F.floor(F.size("a") / 2).cast("int"))
    b = F.concat(F.slice("a", 1, F.col("h")), F.array(F.lit("~")), F.slice("a", F.col("h") + 1, F.size("a")))
    return rs.ordered_blocks(both.withColumn("b", F.when(F.size("a") > 0, b).otherwise(F.array().cast("array<string>"))), "conv_id", "a", "b")
