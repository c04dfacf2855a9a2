"""The queries of this subpackage, by the names the entry module registers, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_OP1 = r"""
with d as (select doc_id, string_split_regex(trim(lower(coalesce(text, '')), e' \t\n\x0b\f\r'), '[\x20\x09-\x0D]+') w from documents),
b as (select item_id, string_split_regex(trim(lower(coalesce(text, '')), e' \t\n\x0b\f\r'), '[\x20\x09-\x0D]+') w from benchmark),
ds as (select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' '))) s from d where w[1] <> ''),
bs as (select distinct item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' '))) s from b where w[1] <> ''),
n as (select item_id, count(*) n_item from bs group by 1),
p as (select doc_id, item_id, count(*) n_shared from ds join bs using (s) where doc_id is not null and item_id is not null group by all)
select doc_id, item_id, n_shared, n_item, n_shared / n_item containment from p join n using (item_id) where n_shared >= n_item * 0.8::double
"""


def op2_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import fingerprint_neighbours

    return fingerprint_neighbours(_table(spark, sf_dir, "documents"))


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality

    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_personal_data_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from secrets import token_hex

    from .pii import replace_personal_data

    # a key of one's own makes surrogates that can be made again; without one they are this run's only
    key = spark.conf.get("spanloom.surrogate.key", None) or token_hex(32)
    return replace_personal_data(_table(spark, sf_dir, "documents"), key)


def op5_warc_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import capture_histories

    return capture_histories(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_OP5 = """
with p as (select page_id, coalesce(html, '') h, sha1(coalesce(html, '')) x from pages),
f as (select h, min(page_id) first_id from p group by 1)
select page_id, octet_length(encode(h))::bigint payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(x, (i // 4 * 5 + 1)::int, 5))::int >> (15 - i % 4 * 5)::int) & 31) + 1, 1)), '') payload_digest,
  case when page_id is distinct from first_id and first_id is not null then 'revisit' else 'response' end record_type,
  case when page_id is distinct from first_id then first_id end refers_to
from p join f using (h)
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(_table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import find_secrets

    return find_secrets(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokencount import token_counts

    return token_counts(_table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(_table(spark, sf_dir, "documents"))


def op10_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_components

    return simhash_components(_table(spark, sf_dir, "documents"))


def op11_minhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .multiindex import minhash_components

    return minhash_components(_table(spark, sf_dir, "documents"))


_OP11 = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 1 then w else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) s from w),
n as (select doc_id, count(s)::bigint n from w left join s using (doc_id) group by 1),
p as (select a.doc_id a, b.doc_id b, count(*) shared from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by all),
e as (select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where 100 * shared >= 80 * (x.n + y.n - shared)),
r(doc_id, root) as (select doc_id, doc_id from n union select e.b, r.root from r join e on r.doc_id = e.a where r.root < e.b)
select doc_id, n n_shingles, min(root) component_id, min(root) = doc_id kept from r join n using (doc_id) group by doc_id, n
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .manifest import manifest_proofs

    return manifest_proofs(_table(spark, sf_dir, "documents"))


def _op12(levels: int = 9) -> str:
    """The SQL of op12, a step a level, for groups of up to 8 ** ``levels`` rows and fewer than 65 groups.

    A CRC-32 takes eight shifts a byte, so a list of the bytes, each followed by eight marks, is folded into it.
    """
    field = "case when {0} is null then '-' else octet_length(encode({0}::varchar))::varchar || ':' || {0}::varchar end".format
    row = "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
    tampered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = "list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end)"
    siblings = "coalesce(string_agg(h, '' order by idx) over (partition by g, idx // 8 order by idx rows between {}), '')".format
    steps = [
        f"d as (select row_number() over () r, doc_id, lang, {row.format(field('text'))} leaf, case when xor({crc}, 4294967295) % 3 = 0 then {row.format(field(tampered))} end other from documents)",
        "l0 as (select r, lang g, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 idx, count(*) over (partition by lang) n, leaf h from d)",
    ]

    def tree(name: str, height: int) -> None:
        for k in range(height):
            steps.append(f"{name}p{k} as (select g, idx, n, h, {siblings('unbounded preceding and 1 preceding')} a, {siblings('1 following and unbounded following')} b from {name}{k})")
            steps.append(f"{name}{k + 1} as (select g, idx // 8 idx, (any_value(n) + 7) // 8 n, case when any_value(n) > 1 then sha256(string_agg(h, '' order by idx)) else any_value(h) end h from {name}{k} group by g, idx // 8)")

    tree("l", levels)
    steps.append(f"t0 as (select 0 g, g lang, row_number() over (order by g nulls first) - 1 idx, count(*) over () n, h, h subroot from l{levels})")
    tree("t", 2)
    steps.append("f0 as (select d.doc_id, d.leaf, d.lang, l0.idx, coalesce(d.other, d.leaf) h, '' proof from d join l0 using (r))")
    for k in range(levels):
        steps.append(f"f{k + 1} as (select f.doc_id, f.leaf, f.lang, f.idx // 8 idx, case when p.n > 1 then sha256(p.a || f.h || p.b) else f.h end h, f.proof || case when p.n > 1 then p.a || p.b else '' end proof from f{k} f join lp{k} p on f.lang is not distinct from p.g and f.idx = p.idx)")
    steps.append(f"g0 as (select f.doc_id, f.leaf, t.subroot, t.idx, f.h, f.proof from f{levels} f join t0 t on f.lang is not distinct from t.lang)")
    for k in range(2):
        steps.append(f"g{k + 1} as (select f.doc_id, f.leaf, f.subroot, f.idx // 8 idx, case when p.n > 1 then sha256(p.a || f.h || p.b) else f.h end h, f.proof || case when p.n > 1 then p.a || p.b else '' end proof from g{k} f join tp{k} p on f.idx = p.idx)")
    return "with " + ",\n".join(steps) + "\nselect doc_id, leaf, subroot, t2.h root, sha256(proof) proof_sha256, g2.h folded_root, g2.h = t2.h verified from g2, t2"


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ranked import search_documents

    # vectored reads copy a row group's texts once more, outside the heap
    docs = spark.read.option("parquet.hadoop.vectored.io.enabled", "false").parquet(f"{sf_dir}/documents.parquet")
    return search_documents(docs, _table(spark, sf_dir, "benchmark"))


_OP13 = r"""
with d as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') t from documents),
q as (select row_number() over () i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') t from benchmark),
s as (select count(*)::bigint n_docs, sum(len(t))::bigint n_terms from d where len(t) > 0),
p as (select r, term, count(*)::bigint tf from (select r, unnest(t) term from d) group by all),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint w from p, s group by term, n_docs),
m as (select r, doc_id, 25 + (75 * len(t)::bigint * n_docs) // n_terms m from d, s where len(t) > 0),
qt as (select i, term, count(*)::bigint times from (select i, unnest(t) term from q) group by all),
x as (select i, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint score from qt join w using (term) join p using (term) join m using (r) group by all),
y as (select i, doc_id, score, row_number() over (partition by i order by score desc, doc_id) rank from x join m using (r) where score > 0)
select item_id, rank::int rank, doc_id, score from y join q using (i) where rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_containment": op1_benchmark_containment,
    "op2_minhash_fingerprints": op2_minhash_fingerprints,
    "op3_quality_gam": op3_quality_gam,
    "op4_personal_data_surrogates": op4_personal_data_surrogates,
    "op5_warc_histories": op5_warc_histories,
    "op6_language_id": op6_language_id,
    "op7_secret_scans": op7_secret_scans,
    "op8_token_counts": op8_token_counts,
    "op9_source_mixing": op9_source_mixing,
    "op10_simhash_pigeonring": op10_simhash_pigeonring,
    "op11_minhash_multi_index": op11_minhash_multi_index,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op1_benchmark_containment": _OP1,
    "op5_warc_histories": _OP5,
    "op11_minhash_multi_index": _OP11,
    "op12_merkle_manifest": _op12(),
    "op13_ranked_search": _OP13,
}
