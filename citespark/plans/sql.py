"""Pieces of DuckDB SQL that the oracles share: the same rules as functions/ and operators/, said again in SQL."""

from __future__ import annotations

from citespark.functions import analyze, text, urls
from citespark.operators.search import WEIGHTS
from citespark.plans.query import compile_query, phrase_patterns


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def collapse(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{text.WHITESPACE}', ' ', 'g'))"


def fold(x: str) -> str:
    return f"lower(translate({x}, '{text.ACCENTED}', '{text.PLAIN}'))"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{text.TOKEN}')"


def stem(x: str) -> str:
    return f"case when regexp_extract({x}, '{analyze.LIGHT}', 1) <> '' then regexp_extract({x}, '{analyze.LIGHT}', 1) else {x} end"


STOPS = "[" + ", ".join(map(quoted, analyze.STOPWORDS)) + "]"

BLOCKS = f"""
bl as (
  select article_id, lang, source, unnest(range(1, len(l) + 1))::int as block_index, unnest(l) as block_text
  from (select doc_id as article_id, lang, source, list_filter(list_transform(string_split(text, chr(10)), lambda x: {collapse('x')}), lambda x: x <> '') as l from documents)
)"""

POSTINGS = f"""{BLOCKS},
vec as (
  select article_id, 'b' as vec_kind, block_index as vec_id, {WEIGHTS['D']} as weight, block_text from bl
  union all select article_id, 'm', 0, {WEIGHTS['A']}, block_text from bl where block_index = 1
),
tok as (select article_id, vec_kind, vec_id, weight, unnest({tokens('block_text')}) as t from vec),
lx as (
  select article_id, vec_kind, vec_id, weight,
         unnest(case when list_contains({STOPS}, {fold('t')}) then [t] else list_distinct([{fold('t')}, {fold(stem('t'))}, {stem('t')}, t]) end) as lexeme
  from tok
),
post as (select article_id, vec_kind, vec_id, weight, lexeme, count(*) as tf from lx group by all)"""

GATE = """
gate as (select distinct article_id, source, lang from bl where article_id not in (select doc_id from labels where quality = 0))"""


def hits(query: str) -> str:
    rows = compile_query(query).rows()
    values = ", ".join(f"({o}, {s}, {n}, {quoted(x)}, {p}, {i})" for i, (o, s, n, x, p) in enumerate(rows))
    return f"""
q(ord, side, n_lex, lexeme, is_prefix, which) as (values {values}),
hit as (
  select p.*, q.ord, q.side, q.n_lex, q.which from post p join q
    on (q.is_prefix and starts_with(p.lexeme, q.lexeme)) or (not q.is_prefix and p.lexeme = q.lexeme)
),
side_ok as (select article_id, vec_kind, vec_id, ord, side from hit group by all having count(distinct which) = max(n_lex)),
th as (
  select article_id, vec_kind, vec_id, ord, sum(r)::bigint as rank
  from (select distinct article_id, vec_kind, vec_id, ord, lexeme, weight * tf as r from hit join side_ok using (article_id, vec_kind, vec_id, ord, side))
  group by all
),
cand as (select article_id from th group by all having count(distinct ord) = {len({r[0] for r in rows})})"""


def ranked(query: str) -> str:
    plan = compile_query(query)
    accented = ", ".join(str(t.ord) for t in plan.terms if t.accented) or "-1"
    return f"""
bt as (select article_id, ord, coalesce(max(rank) filter (where vec_kind = 'm'), 0) as m, coalesce(max(rank) filter (where vec_kind = 'b'), 0) as b from th group by all),
tr as (select article_id, sum(m + b)::bigint as term_rank, coalesce(sum(m) filter (where ord in ({accented})), 0)::bigint as accent_rank from bt group by all),
bv as (select article_id, vec_kind, vec_id, sum(rank)::bigint as rank from th group by all having count(*) = {len(plan.terms)}),
wh as (select article_id, coalesce(max(rank) filter (where vec_kind = 'm'), 0) as meta_rank, coalesce(max(rank) filter (where vec_kind = 'b'), 0) as body_rank from bv group by all),
ranked as (
  select article_id, term_rank, accent_rank, coalesce(meta_rank, 0)::bigint as meta_rank, coalesce(body_rank, 0)::bigint as body_rank,
         (term_rank + accent_rank + coalesce(meta_rank, 0) + coalesce(body_rank, 0))::bigint as score,
         case when meta_rank > 0 and body_rank > 0 then 'both' when meta_rank > 0 then 'metadata' when body_rank > 0 then 'body' else 'document' end as match_reason
  from tr left join wh using (article_id)
)"""


def search(query: str, limit: int | None = 10, offset: int = 0, where: str = "true", phrase: str | None = None, k: int = 1) -> str:
    held = f"and article_id in (select article_id from bl where {phrase_match('block_text', phrase)})" if phrase else ""
    page = f"limit {limit} offset {offset}" if limit is not None else ""
    return f"""
with {POSTINGS}, {GATE}, {hits(query)}, {ranked(query)},
ids as (select article_id from cand where article_id in (select article_id from gate where {where}) {held}),
page as (select * from ranked where article_id in (select article_id from ids) order by score desc, article_id {page}),
best as (
  select article_id, vec_id, row_number() over (partition by article_id order by rank desc, vec_id) as place from bv where vec_kind = 'b'
),
shown as (select article_id, string_agg(vec_id::varchar, ',' order by place) as passages from best where place <= {k} group by all)
select article_id, source, lang, term_rank, accent_rank, meta_rank, body_rank, score, match_reason, coalesce(passages, '') as passages,
       (select count(*) from ids) as total_matches
from page left join shown using (article_id) join gate using (article_id)
"""


def phrase_match(x: str, needle: str) -> str:
    words = tokens(x)
    forms = {
        "simple": f"array_to_string({words}, ' ')", "folded": f"array_to_string(list_transform({words}, lambda w: {fold('w')}), ' ')",
        "lemma": f"array_to_string(list_transform({words}, lambda w: {fold(stem('w'))}), ' ')", "accented_lemma": f"array_to_string(list_transform({words}, lambda w: {stem('w')}), ' ')",
    }
    tests = [f"regexp_matches({forms[b]}, {quoted(p)})" for b, p in phrase_patterns(needle).items()]
    return "(" + " or ".join(tests or ["false"]) + ")"


def html_text(x: str) -> str:
    out = f"regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '(?s)<!--.*?-->', '', 'g'), '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]*>', '', 'g')"
    for name, char in text.ENTITIES:
        out = f"replace({out}, {quoted(name)}, {quoted(char)})"
    return collapse(out)


def is_boilerplate(x: str) -> str:
    phrases = " or ".join(f"contains({fold(x)}, {quoted(p)})" for p in text.BOILERPLATE_PHRASES)
    label = f"(len(string_split({x}, ' ')) <= 2 and upper({x}) = {x} and lower({x}) <> {x} and length({x}) < 20)"
    return f"({x} <> '' and ({phrases} or (regexp_matches({x}, '{text.REGIONAL}') and length({x}) < 60) or {label}))"


def url_parts(u: str) -> dict[str, str]:
    whole = f"case when regexp_matches(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*://') then trim({u}) else 'https://' || regexp_replace(trim({u}), '^//', '') end"
    get = lambda i: f"regexp_extract({whole}, '^([^:/?#]+)://([^/?#]*)([^?#]*)(?:\\?([^#]*))?', {i})"
    return {"scheme": f"lower({get(1)})", "host": f"lower({get(2)})", "path": get(3), "query": get(4)}


def canonical_url(u: str) -> str:
    """The identity form in steps of its own: parameters as [name, value] lists, percent codes by DuckDB's functions."""
    rest = f"regexp_replace(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*:', '')"
    scheme = f"(case when regexp_matches(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*:') then lower(split_part(trim({u}), ':', 1)) else 'https' end)"
    bare = f"split_part({rest}, '#', 1)"
    before = f"split_part({bare}, '?', 1)"
    host = f"lower(regexp_extract({before}, '^//([^/]*)', 1))"
    host = f"(case {scheme} when 'http' then regexp_replace({host}, ':80$', '') when 'https' then regexp_replace({host}, ':443$', '') else {host} end)"
    path = f"regexp_replace({before}, '^//[^/]*', '')"
    path = f"(case when {path} = '' then '/' when {path} = '/' then '/' else (case when starts_with({path}, '/') then '' else '/' end) || rtrim({path}, '/') end)"
    given = f"list_filter(string_split(case when contains({bare}, '?') then substring({bare}, strpos({bare}, '?') + 1) else '' end, '&'), lambda x: x <> '')"
    plain = lambda x: f"url_decode(replace({x}, '+', ' '))"
    pairs = f"list_transform({given}, lambda x: [{plain('split_part(x, chr(61), 1)')}, case when contains(x, '=') then {plain('substring(x, strpos(x, chr(61)) + 1)')} else '' end])"
    drop = "[" + ", ".join(map(quoted, urls.TRACKING)) + "]"
    kept = f"list_sort(list_filter({pairs}, lambda p: not list_contains({drop}, lower(p[1]))))"
    coded = lambda x: f"replace(url_encode({x}), '%20', '+')"
    query = f"array_to_string(list_transform({kept}, lambda p: {coded('p[1]')} || '=' || {coded('p[2]')}), '&')"
    return f"(case when {u} = '' then {u} else {scheme} || '://' || {host} || {path} || case when {query} <> '' then '?' || {query} else '' end end)"


def outlet(u: str) -> str:
    labels = f"string_split(regexp_replace({url_parts(u)['host']}, ':[0-9]+$', ''), '.')"
    last = lambda k: f"array_to_string({labels}[-{k}:], '.')"
    two = "[" + ", ".join(map(quoted, urls.MULTIPART_SUFFIXES)) + "]"
    return f"case when list_contains({two}, {last(2)}) then {last(3)} else {last(2)} end"


def strip_furniture(x: str, tags) -> str:
    out = f"regexp_replace(coalesce({x}, ''), '(?s)<!--.*?-->', '', 'g')"
    for tag in tags:
        out = f"regexp_replace({out}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', '', 'g')"
    return out
