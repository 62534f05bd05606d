"""DuckDB SQL of the queries that SQL can express."""

#: Words, windows and hits straight from their definition.
DECONTAMINATE = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
w as (select distinct item_id, words[i:i + 9] as w from (select item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) as i from b where len(words) > 0)),
lengths as (select distinct len(w) as n from w),
p as (select doc_id, i, n, words[i:i + n - 1] as w from (select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i from d, lengths where len(words) >= n)),
h as (select doc_id, i, n, item_id from p join w using (w)),
words_hit as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from h) group by doc_id),
items as (select doc_id, count(distinct item_id) as n_items, list_sort(list(distinct cast(item_id as varchar))) as ids from h group by doc_id)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words_hit using (doc_id) left join items using (doc_id)
"""

#: Rules on hosts and paths; aliases by normalised URL (the given pages declare
#: no canonical or refresh links; those are tested against brute force).
URL_FILTER = r"""
with p as (select page_id, url from pages),
u as (select url, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path,
    list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^.*?://[^?#]*\?([^#]*)', 1, 's'), '&'), lambda x: x <> '' and not regexp_matches(x, '^(utm_|ref=)'))) as q
  from (select url from p union select null)),
n as (select url, host, path, host || regexp_replace(path, '/+$', '') || case when len(q) > 0 then '?' || array_to_string(q, '&') else '' end as node from u),
rules (h, r, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
own as (select url, max_by(h || r, length(h || r)) as rule, max_by(v, length(h || r)) as verdict from n, rules
  where (host = h or ends_with(host, '.' || h)) and starts_with(path, r) group by url),
comp as (select node, max(case when verdict = 'allow' then 1 else 0 end) as allowed from n join own using (url) group by node)
select page_id, n.host as host, n.path as path, own.rule as rule, coalesce(own.verdict, case when comp.allowed = 0 then 'block' else 'allow' end) as verdict
from p join n on p.url is not distinct from n.url left join own on own.url = p.url left join comp on comp.node = n.node
"""

#: Bits of the failed filters a document, counted by part, then applied in each order.
FILTER_AUDIT = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
m as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from d),
f as (select doc_id, part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(min(doc_id) over (partition by t) < doc_id, false)] as failed,
    coalesce(doc_id in (select doc_id from labels where quality = 1), false) as good, coalesce(doc_id in (select doc_id from labels where toxic = 1), false) as toxic from m),
g as (select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by part, failed),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (select a.x || b.x || c.x || d.x || e.x as o from l a, l b, l c, l d, l e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select o, cast(i as integer) as step, ascii(o[i]) - 64 as f, list_transform(range(1, i), lambda k: ascii(o[k]) - 64) as before from orders, range(1, 6) r(i)),
s as (select part, o, step, f, failed[f] as own, len(list_filter(before, lambda k: failed[k])) > 0 as gone,
  len(list_filter(failed, lambda x: x)) = 1 as alone, n, good, toxic from steps, g),
c as (select part, o as filter_order, step, f, coalesce(sum(n) filter (not own and not gone), 0) as kept, coalesce(sum(n) filter (own and not gone), 0) as removed,
  coalesce(sum(n) filter (own and gone), 0) as redundant, coalesce(sum(n) filter (own and alone), 0) as unique_fails,
  coalesce(sum(good) filter (own and not gone), 0) as good_lost, coalesce(sum(toxic) filter (own and not gone), 0) as toxic_lost from s group by part, o, step, f)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, f) as bigint) as shapley from c
"""

WARC_SALVAGE = r"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from p)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest, case when first is null or first is not distinct from page_id then 'response' else 'revisit' end as record_type,
  case when first is not null and first is distinct from page_id then first end as refers_to from f
"""

#: Dense: every group with every kept term.
DIVERGENCE = r"""
with d as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t from documents),
w as (select row_number() over () as i, lang, source, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words from d),
o as (select i, lang, source, unnest(words) as term from w),
kept as (select lang, term from o group by lang, term having count(distinct i) >= 30),
groups as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from o join kept using (lang, term) group by lang, source, term),
v as (select g.lang, count(k.term) as terms from (select distinct lang from d) g left join kept k using (lang) group by g.lang),
cells as (select lang, source, term, coalesce(n, 0) as n from groups join kept using (lang) left join c using (lang, source, term)),
p as (select lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang, source) + 5 * terms) as p from cells join v using (lang)),
l as (select lang, term, sum(n) as n from cells group by lang, term),
q as (select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang) + 5 * terms) as q from l join v using (lang)),
pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
  union all select a.lang, a.source, b.source, 0 from groups a join groups b on a.lang = b.lang and a.source <> b.source join v on v.lang = a.lang where terms = 0),
terms as (select lang, source, term as item, p - q as value from p join q using (lang, term) where n > 0 and p > q)
select lang, source, 'pair' as part, item, cast(value as bigint) as value, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from pairs
union all
select lang, source, 'term', item, cast(value as bigint), cast(r as integer) from (select *, row_number() over (partition by lang, source order by value desc, item) as r from terms) where r <= 50
"""

SQL = {"op13_divergence": DIVERGENCE, "op12_warc_salvage": WARC_SALVAGE, "op11_filter_audit": FILTER_AUDIT, "op2_decontaminate": DECONTAMINATE, "op3_url_filter": URL_FILTER}
