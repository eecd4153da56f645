"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidara.llm import substring, suffixes
from evidara.llm.decontamination import contamination
from evidara.llm.language import identify
from evidara.llm.lexical import rank_documents
from evidara.llm.minhash import near_duplicates
from evidara.llm.mixing import mixture
from evidara.llm.neighbours import nearest
from evidara.llm.recipes import exact_groups
from evidara.llm.toxicity import toxicity
from evidara.llm.tries import prefix_trie
from evidara.llm.urls import filter_urls
from evidara.llm.warc import archive_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return f

    return add


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


@query("op4_minhash_near_dedup", """
    with recursive w as (
      select doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
    s as (
      select doc_id, case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
        else list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) end as sh from w),
    n as (select doc_id, coalesce(len(sh), 0) as n from s),
    e as (select doc_id, unnest(sh) as g from s),
    p as (
      select a.doc_id as a, b.doc_id as b, count(*) as c from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
    l as (
      select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b where 100 * c >= 80 * (x.n + y.n - c)),
    u as (select a, b from l union all select b, a from l),
    r(doc_id, c) as (select doc_id, doc_id from n union select u.b, r.c from r join u on u.a = r.doc_id)
    select n.doc_id, n.n as n_shingles, min(r.c) as component_id, min(r.c) = n.doc_id as kept
    from n join r using (doc_id) group by n.doc_id, n.n
""")
def op4(spark: SparkSession, path: str) -> DataFrame:
    return near_duplicates(table(spark, path, "documents"), k=4)


@query("op8_substring_dedup", """
    with w as (
      select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
    win as (
      select doc_id, i, array_to_string(ws[i:i + 12], ' ') as g
      from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w where len(ws) >= 13)),
    f as (select g, min(doc_id) as m from win group by g),
    d as (select win.doc_id, i from win join f using (g) where m < win.doc_id),
    c as (select doc_id, list_distinct(flatten(list(range(i, i + 13)))) as p from d group by doc_id)
    select doc_id, len(ws) as n_words, coalesce(len(p), 0) as n_removed,
      sha256(array_to_string(case when p is null then ws else list_filter(ws, lambda x, i: not list_contains(p, i)) end, ' ')) as kept_sha256
    from w left join c using (doc_id)
""")
def op8(spark: SparkSession, path: str) -> DataFrame:
    return substring.removal_digests(table(spark, path, "documents"))


@query("op7_suffix_array_dedup", """
    with b as (
      select row_number() over () as rid, doc_id, encode(coalesce(text, '')) as t, octet_length(encode(coalesce(text, ''))) as n from documents),
    w as (select rid, i, md5(t[i:i + 399]) as h from (select rid, t, unnest(range(1, n - 398)) as i from b where n >= 400)),
    d as (select h from w group by h having count(*) > 1),
    s as (select rid, i, lag(i) over (partition by rid order by i) as prev from w where h in (select h from d)),
    g as (select rid, i, sum(case when prev is null or i > prev + 400 then 1 else 0 end) over (partition by rid order by i) as run from s),
    m as (select rid, run, min(i) as a, max(i) + 400 as z from g group by rid, run),
    e as (select rid, a, z, coalesce(lag(z) over (partition by rid order by a), 1) as from_, row_number() over (partition by rid order by a desc) = 1 as last from m),
    k as (
      select e.rid, count(*) as n_spans, sum(z - a) as n_removed,
        string_agg(case when a > from_ then hex(t[from_:a - 1]) else '' end || case when last and z <= n then hex(t[z:n]) else '' end, '' order by a) as hx
      from e join b using (rid) group by e.rid)
    select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
      sha256(case when hx is null then t else unhex(hx) end) as kept_sha256
    from b left join k using (rid)
""")
def op7(spark: SparkSession, path: str) -> DataFrame:
    return suffixes.removal_digests(table(spark, path, "documents"))


@query("op9_toxicity")
def op9(spark: SparkSession, path: str) -> DataFrame:
    return toxicity(table(spark, path, "documents"), table(spark, path, "labels"))


@query("op2_language_id")
def op2(spark: SparkSession, path: str) -> DataFrame:
    return identify(table(spark, path, "documents"))


@query("op10_decontamination")
def op10(spark: SparkSession, path: str) -> DataFrame:
    return contamination(table(spark, path, "documents"), table(spark, path, "benchmark"))


@query("op1_mixing")
def op1(spark: SparkSession, path: str) -> DataFrame:
    return mixture(table(spark, path, "documents"))


URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query("op3_url_filter", r"""
    with recursive rules(h, p, verdict) as (values
      ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    parts as (
      select row_number() over () as rid, page_id, url, html,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) as rest from pages),
    addr as (select *, case when contains(url, '://') then host || case when rest = '' then '/' else rest end end as address from parts),
    raw as (
      select address as a, host, unnest([
        regexp_extract(regexp_extract(html, '(?i)<link[^>]*rel\s*=\s*["'']?canonical[^>]*>'), '(?i)href\s*=\s*["'']?([^"''\s>]+)', 1),
        regexp_extract(html, '(?i)<meta[^>]*http-equiv\s*=\s*["'']?refresh[^>]*url\s*=\s*["'']?([^"''\s>]+)', 1)]) as link from addr),
    full_ as (
      select a, case when contains(link, '://') then link when link like '//%' then 'http:' || link when link like '/%' then 'http://' || host || link end as u
      from raw where link <> ''),
    edge as (
      select distinct a, lower(regexp_extract(u, '^.*?://([^/?#]*)', 1)) ||
        case when regexp_extract(u, '^.*?://[^/?#]*([^#]*)', 1) = '' then '/' else regexp_extract(u, '^.*?://[^/?#]*([^#]*)', 1) end as b
      from full_ where u is not null and a is not null),
    both_ as (select a, b from edge union select b, a from edge),
    reach(n, m) as (select a, a from both_ union select r.n, b.b from reach r join both_ b on b.a = r.m),
    nodes as (
      select m, regexp_extract('http://' || m, '^.*?://([^/?#]*)', 1) as host, regexp_extract('http://' || m, '^.*?://[^/?#]*([^?#]*)', 1) as path
      from (select distinct m from reach)),
    said as (
      select m, arg_max(verdict, (length(h) + length(p), length(h))) as v
      from nodes join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by m),
    told as (select n, bool_or(v = 'block') and not bool_or(v = 'allow') as bad from reach left join said using (m) group by n),
    own as (
      select rid, arg_max(h || p, (length(h) + length(p), length(h))) as rule, arg_max(verdict, (length(h) + length(p), length(h))) as v
      from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by rid)
    select page_id, host, path, rule, coalesce(v, case when bad then 'block' else 'allow' end) as verdict
    from addr left join own using (rid) left join told on told.n = address
""")
def op3(spark: SparkSession, path: str) -> DataFrame:
    return filter_urls(table(spark, path, "pages"), URL_RULES)


@query("op5_nearest_neighbours", """
    with v as (
      select vec_id, embedding::double[] as e from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    s as (
      select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
      from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
    select query_id, rank, vec_id, score from r where rank <= 20
""")
def op5(spark: SparkSession, path: str) -> DataFrame:
    return nearest(table(spark, path, "embeddings"))


_BASE32 = " || ".join(
    f"translate(lpad(to_base(('0x' || substr(h, {i}, 10))::bigint, 32), 8, '0'), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"
    for i in (1, 11, 21, 31))


@query("op6_warc", f"""
    with p as (select page_id, encode(coalesce(html, '')) as b from pages),
    d as (select page_id, octet_length(b) as n, sha1(b) as h from p),
    m as (select h, n, max(page_id) as head from d group by h, n)
    select page_id, n as payload_bytes, {_BASE32} as payload_digest,
      case when page_id < head then 'revisit' else 'response' end as record_type, case when page_id < head then head end as refers_to
    from d join m using (h, n)
""")
def op6(spark: SparkSession, path: str) -> DataFrame:
    return archive_round_trip(table(spark, path, "pages"))


@query("op13_exact_dedup", """
    with n as (
      select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
    g as (select t, max(doc_id) as keep_id, count(*) as group_size from n group by t)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from n join g using (t)
""")
def op13(spark: SparkSession, path: str) -> DataFrame:
    return exact_groups(table(spark, path, "documents"))


@query("op11_lexical_search", r"""
    with d as (
      select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from documents),
    i as (
      select row_number() over () as q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from benchmark),
    s as (select sum(len(ts))::bigint as l, count(*) filter (len(ts) > 0) as n from d),
    q as (select q, item_id, term, count(*) as c from (select q, item_id, unnest(ts) as term from i) group by all),
    p as (select r, term, count(*) as tf from (select r, unnest(ts) as term from d) where term in (select term from q) group by all),
    f as (select term, floor(1000 * ln((2 * max(n) + 2) / (2 * count(*) + 1)))::bigint as w from p, s group by term),
    m as (select r, doc_id, 75 + (25 * len(ts) * n) // l as m from d, s where len(ts) > 0),
    x as (
      select q, item_id, r, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
      from q join p using (term) join f using (term) join m using (r) group by all),
    k as (select *, row_number() over (partition by q order by score desc, doc_id)::int as rank from x where score > 0)
    select item_id, rank, doc_id, score from k where rank <= 20
""")
def op11(spark: SparkSession, path: str) -> DataFrame:
    return rank_documents(table(spark, path, "documents"), table(spark, path, "benchmark"))


@query("op12_conversation_trie", r"""
    with t as (
      select conv_id, row_number() over (partition by conv_id order by turn nulls first, sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as pos,
        sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as g,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
      from conversations where conv_id is not null),
    ops as (
      select conv_id, conv_id::varchar as s, list_concat([4294967295], flatten(list_transform(range(1, strlen(conv_id::varchar) + 1),
        lambda i: [ascii(substr(conv_id::varchar, i, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))) as l
      from (select distinct conv_id from t)),
    c as (
      select conv_id, conv_id - conv_id % 20 as donor,
        xor(list_reduce(l, lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295) % 4 as h from ops),
    lead_ as (select c.conv_id, t.pos as d, t.g, t.words from c join t on t.conv_id = c.donor and t.pos <= c.h),
    own as (
      select t.conv_id, t.pos - c.h + (select count(*) from lead_ where lead_.conv_id = t.conv_id) as d, t.g, t.words
      from t join c using (conv_id) where t.pos > c.h),
    r as (select * from lead_ union all select * from own),
    p as (
      select conv_id, d, words, sha256(string_agg(g, '' order by d) over (partition by conv_id order by d)) as k from r
      union all select conv_id, 0, 0, 'root' from c),
    n as (select d, k, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words from p group by d, k),
    x as (select n.*, q.k as up from n left join p q on q.conv_id = n.conv_id and q.d = n.d - 1),
    kids as (select d - 1 as d, up as k, count(*) as n_children from x where up is not null group by all),
    y as (select x.*, coalesce(n_children, 0) as n_children from x left join kids using (d, k)),
    sub as (
      select p.d, p.k, sum((y.n_convs - 1) * y.words)::bigint as saved_tokens, count(*) filter (y.n_children = 0) as n_leaves
      from y join p on p.conv_id = y.conv_id and p.d <= y.d group by all),
    last_ as (select conv_id, max(d) as d from p group by conv_id),
    e as (select p.d, p.k, string_agg(conv_id::varchar, ',' order by conv_id) as s from p join last_ using (conv_id, d) group by all)
    select y.conv_id, y.d as depth, u.conv_id as parent_conv_id, y.n_convs, y.n_children, n_leaves, saved_tokens, sha256(coalesce(s, '')) as ends_sha256
    from y join sub using (d, k) left join e using (d, k) left join n u on u.d = y.d - 1 and u.k = y.up
""")
def op12(spark: SparkSession, path: str) -> DataFrame:
    return prefix_trie(table(spark, path, "conversations"))
