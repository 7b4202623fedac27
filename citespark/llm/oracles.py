"""DuckDB SQL for the queries of this subpackage that SQL can express."""

OP8 = """
with p as (
  select page_id, coalesce(html, '') as body, strlen(coalesce(html, ''))::bigint as payload_bytes,
         min(page_id) over (partition by coalesce(html, '')) as least
  from pages
)
select page_id, payload_bytes, sha256(body) as payload_digest,
       case when payload_bytes >= 100 and page_id > least then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id > least then least end as refers_to
from p
"""

OP10 = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix:' || coalesce(doc_id::varchar, '')) as key
  from documents
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rank from d group by source
), c as (
  select *, ([1, 2, 3])[rank % 3 + 1]::bigint as weight, 3 * source_size as cap from s
), o as (
  select *, row_number() over w - 1 as k,
         coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0)::double as cap_before,
         coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0)::double as weight_before
  from c window w as (order by cap::double / weight, rank)
), l as (
  select min(k) as k, arg_min(share, k) as share
  from (select k, cap, weight, ((select sum(source_size) from s) - cap_before) / ((select sum(weight) from c) - weight_before) as share from o)
  where cap >= weight * share
), t as (
  select o.source, o.source_size, case when o.k < l.k then o.cap::double else o.weight * l.share end as target from o, l
), b as (
  select *, floor(target + 0.5)::bigint as budget, case when source_size > 0 then floor(target + 0.5)::bigint // source_size else 0 end as epochs from t
), r as (
  select d.doc_id, d.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size as rest,
         coalesce(sum(d.size) over (partition by d.source order by d.key, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join b on d.source is not distinct from b.source
)
select doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::bigint as taken from r
"""

ORACLE_SQL: dict[str, str] = {"op8_warc": OP8, "op10_mix": OP10}
