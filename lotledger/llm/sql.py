"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# 160 bits in 32 groups of five: 40 bits of the hexadecimal digest at a time.
_B32 = (
    "list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',"
    " 1 + cast((cast('0x' || substr({hex}, 1 + 10 * (i // 8), 10) as bigint)"
    " >> (35 - 5 * (i % 8))) & 31 as bigint), 1)), 'string_agg', '')"
)


def _digest(block: str) -> str:
    return "'sha1:' || " + _B32.format(hex=f"sha1({block})")


def _urn(value: str) -> str:
    h = f"md5({value})"
    cut = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {cut} || '>'"


_NL = "chr(13) || chr(10)"

WARC = rf"""
with r as (
  select page_id, url as target_uri, coalesce(html, '') as payload,
    {_urn("'response|' || coalesce(cast(page_id as varchar), '') || '|' || coalesce(url, '')")} as refers_to,
    'HTTP/1.1 200 OK' || {_NL} || 'Content-Type: text/html; charset=utf-8' || {_NL}
      || 'Content-Length: ' || strlen(coalesce(html, '')) as head
  from pages
), t as (
  select *, {_digest(f"head || {_NL} || {_NL} || payload")} as source_block_digest,
    {_digest("payload")} as source_payload_digest,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(payload,
      '(?is)<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</(script|style|noscript|template)\s*>', ' ', 'g'),
      '\s+', ' ', 'g'),
      '(?i)<(/?(p|div|section|article|header|footer|nav|main|ul|ol|li|table|tr|h[1-6]|title|blockquote|pre)\b[^>]*|br\b[^>]*|hr\b[^>]*)>', chr(10), 'g'),
      '<[/!?a-zA-Z][^>]*>', '', 'g') as bare
  from r
), d as (
  select page_id, 'metadata' as record_type, refers_to, target_uri, 'application/warc-fields' as content_type,
    source_block_digest, source_payload_digest,
    'source-block-digest: ' || source_block_digest || {_NL} || 'source-payload-digest: ' || source_payload_digest || {_NL}
      || 'source-http: ' || replace(head, {_NL}, {_NL} || 'source-http: ') || {_NL} as block
  from t
  union all
  select page_id, 'conversion', refers_to, target_uri, 'text/plain; charset=utf-8',
    source_block_digest, source_payload_digest,
    trim(regexp_replace(regexp_replace(
      replace(replace(replace(replace(replace(replace(replace(bare, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
        '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'),
      '[ \t\r]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))
  from t
), n as (
  select *, '2024-01-01T00:00:00Z' as date, {_urn("record_type || '|' || refers_to")} as record_id,
    cast(strlen(block) as bigint) as content_length, {_digest("block")} as block_digest
  from d
)
select page_id, record_type, record_id, refers_to, target_uri, date, content_type, content_length,
  block_digest, source_block_digest, source_payload_digest, block,
  concat_ws({_NL}, 'WARC/1.1', 'WARC-Type: ' || record_type, 'WARC-Record-ID: ' || record_id,
    'WARC-Refers-To: ' || refers_to, 'WARC-Target-URI: ' || target_uri, 'WARC-Date: ' || date,
    'WARC-Block-Digest: ' || block_digest, 'Content-Type: ' || content_type,
    'Content-Length: ' || content_length) || {_NL} || {_NL} || block || {_NL} || {_NL} as record
from n
"""


def _rounds(n: int) -> str:
    """One table per round of the spread, s0 to sn."""
    steps = []
    for i in range(n):
        steps.append(f"""s{i + 1} as (
  select kind, host, sum(score) as score from (
    select kind, host, score from s0
    union all
    select m.kind, m.target_host, s.score * m.share from moves m join s{i} s on s.kind = m.kind and s.host = m.source_host
  ) group by all
)""")
    return ",\n".join(steps)


LINK_TRUST = rf"""
with rules(v, h, p) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), pg as (
  select page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
), fits as (
  select u.host, u.path, r.h || r.p as rule, r.v,
    row_number() over (partition by u.host, u.path order by length(r.h || r.p) desc, length(r.h) desc, r.v desc) as k
  from (select distinct host, path from pg) u
  join rules r on (u.host = r.h or ends_with(u.host, '.' || r.h)) and starts_with(u.path, r.p)
), ruled as (
  select pg.page_id, pg.host, pg.path, f.rule, f.v
  from pg left join (select * from fits where k = 1) f on f.host = pg.host and f.path = pg.path
), seeds as (
  select host, avg(case when v = 'allow' then 1.0 else 0.0 end) as trust, avg(case when v = 'block' then 1.0 else 0.0 end) as distrust
  from ruled where host <> '' group by host
), s0 as (
  select 'trust' as kind, host, trust as score from seeds union all select 'distrust', host, distrust from seeds
), edges as (
  select source, target, count(*) as links from (
    select host as source, translate(unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?(?:[a-z][a-z0-9+.\-]*:)?//([^/"''\s>?#]+)', 1)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as target
    from pg
  ) where source <> '' and source <> target group by all
), moves as (
  select 'trust' as kind, source as source_host, target as target_host, 0.85 * links / sum(links) over (partition by source) as share from edges
  union all
  select 'distrust', target, source, 0.85 * links / sum(links) over (partition by target) from edges
), {_rounds(16)}, verdicts as (
  select host, case when sum(case when kind = 'distrust' then score else -score end) >= 0.5 then 'block' else 'allow' end as by_host
  from s16 group by host
)
select r.page_id, r.host, r.path, r.rule, coalesce(r.v, h.by_host, 'allow') as verdict
from ruled r left join verdicts h on h.host = r.host
"""


NEAR_VECTORS = """
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(embedding) > 0
    and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
    and list_bool_or(list_transform(embedding, lambda x: coalesce(x <> 0, false)))
), n as (
  select vec_id, e, sqrt(list_inner_product(e, e)) as size from v
), links as (
  select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.9
), reach(vec_id, hit) as (
  select vec_id, vec_id from embeddings
  union
  select r.vec_id, l.b from reach r join links l on l.a = r.hit
)
select r.vec_id, cast((select count(*) from links l where l.a = r.vec_id) as bigint) as n_links,
  min(r.hit) as component_id, min(r.hit) = r.vec_id as kept
from reach r group by r.vec_id
"""

FILTER_AUDIT = r"""
with w as (
  select coalesce(source, '') as part, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), f as (
  select part, doc_id, len(words) < 200 as a, 100 * len(list_distinct(words)) < 50 * len(words) as b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) as c,
    regexp_matches(text, '[#$%&*|]') as d,
    coalesce(min(doc_id) over (partition by text) < doc_id, false) as e
  from w
), m as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    (case when a then 'A' else '' end) || (case when b then 'B' else '' end) || (case when c then 'C' else '' end)
      || (case when d then 'D' else '' end) || (case when e then 'E' else '' end) as fails
  from f left join (
    select doc_id as label_id, max(case when quality = 1 then 1 else 0 end) as good,
      max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels group by doc_id
  ) on doc_id = label_id
), g as (
  select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, fails
), l as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x
), o as (
  select p.x || q.x || r.x || s.x || t.x as filter_order
  from l p, l q, l r, l s, l t
  where p.x not in (q.x, r.x, s.x, t.x) and q.x not in (r.x, s.x, t.x) and r.x not in (s.x, t.x) and s.x <> t.x
), k as (
  select filter_order, step, substr(filter_order, step, 1) as name, substr(filter_order, 1, step - 1) as before
  from o, (select unnest([1, 2, 3, 4, 5]) as step)
), r as (
  select part, filter_order, step, name,
    sum(case when translate(fails, before || name, '') = fails then n else 0 end) as kept,
    sum(case when contains(fails, name) and translate(fails, before, '') = fails then n else 0 end) as removed,
    sum(case when contains(fails, name) and translate(fails, before, '') <> fails then n else 0 end) as redundant,
    sum(case when fails = name then n else 0 end) as unique_fails,
    sum(case when contains(fails, name) and translate(fails, before, '') = fails then good else 0 end) as good_lost,
    sum(case when contains(fails, name) and translate(fails, before, '') = fails then toxic else 0 end) as toxic_lost
  from g, k group by part, filter_order, step, name
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, name) as bigint) as shapley
from r
"""
