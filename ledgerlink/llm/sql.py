"""Checks of the queries that SQL can express, for the checking database."""

SQL = {
    "op5_urls": r"""
with parts as (
  select page_id, url, instr(url, '://') as mark from pages
), cut as (
  select page_id, case when coalesce(mark, 0) = 0 then null else regexp_extract(substr(url, mark + 3), '^[^?#]*', 0) end as rest
  from parts
), split as (
  select page_id,
    coalesce(translate(regexp_extract(rest, '^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(case when instr(rest, '/') = 0 then '' else substr(rest, instr(rest, '/')) end, '') as path
  from cut
), rules (action, rule_host, rule_path) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), best as (
  select s.page_id, s.host, s.path, max_by(struct_pack(name := rule_host || rule_path, action := action), length(rule_host || rule_path)) as hit
  from split s join rules r on (s.host = rule_host or s.host like '%.' || rule_host) and starts_with(s.path, rule_path)
  group by s.page_id, s.host, s.path
)
select s.page_id, s.host, s.path, b.hit.name as rule, coalesce(b.hit.action, 'allow') as verdict
from split s left join best b on s.page_id = b.page_id and s.host = b.host and s.path = b.path""",
    "op11_ranking": r"""
with words as (
  select r, key, kind, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (
    select row_number() over () as r, doc_id as key, 'document' as kind, text from documents
    union all
    select row_number() over () as r, item_id as key, 'item' as kind, text from benchmark
  ) as whole
), counted as (
  select kind, r, key, term, count(*) as times from words group by kind, r, key, term
), held as (
  select * from counted where kind = 'document'
), sizes as (
  select r, sum(times)::bigint as n from held group by r
), corpus as (
  select count(*) as docs, sum(n)::bigint as length from sizes
), weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as weight
  from held, corpus group by term
), scores as (
  select i.r, i.key as item_id, d.r as doc, d.key as doc_id,
    sum(i.times * weight * ((1000000000 * d.times) // (1000 * d.times + 8 * (100 - 75 + (75 * n * docs) // length))))::bigint as score
  from counted i join held d on i.term = d.term and i.kind = 'item' join weights w on w.term = d.term join sizes s on s.r = d.r, corpus
  group by i.r, i.key, d.r, d.key
), ranked as (
  select *, row_number() over (partition by r order by score desc, doc_id) as rank from scores where score > 0
)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 10""",
}
