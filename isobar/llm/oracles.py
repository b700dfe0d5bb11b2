"""DuckDB SQL that must give the same rows as the queries of this folder."""

from __future__ import annotations

from isobar.llm.pii import CONTEXT, KINDS

EXACT_DEDUP = r"""
with rows as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents
)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id is not distinct from min(doc_id) over same as kept, sha256(body) as text_sha256
from rows window same as (partition by body)"""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def contamination(documents: str = "documents") -> str:
    """The report over one row per document of a table."""
    return rf"""
with items as (select item_id, {_WORDS} as words from benchmark),
windows as (
  select item_id, least(len(words), 13) as size, words, unnest(range(1, len(words) - least(len(words), 13) + 2)) as i
  from items where len(words) > 0
),
grams as (select distinct item_id, size, array_to_string(words[i:i + size - 1], ' ') as gram from windows),
docs as (select row_number() over () as rid, doc_id, {_WORDS} as words from {documents}),
starts as (
  select rid, size, words, unnest(range(1, len(words) - size + 2)) as i
  from docs, (select distinct size from grams) where len(words) >= size
),
hits as (
  select rid, i, s.size, item_id
  from (select rid, i, size, array_to_string(words[i:i + size - 1], ' ') as gram from starts) s
       join grams g on g.size = s.size and g.gram = s.gram
),
places as (
  select rid, count(distinct place) as n_hit from (select rid, unnest(range(i, i + size)) as place from hits)
  group by rid
),
found as (
  select rid, count(*) as n_items, sha256(string_agg(item_id::varchar, ',' order by item_id::varchar)) as digest
  from (select distinct rid, item_id from hits where item_id is not null) group by rid
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, coalesce(digest, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from docs left join places using (rid) left join found using (rid)"""


_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[0-9A-Za-z]+|(?:\x20[0-9A-Z]{4}){2,7}(?:\x20[0-9A-Z]{1,3})?)",
    "ssn": r"[0-9]+(?:-[0-9]+)+",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_CLOSE = "replace(m, ' ', '')"
_TURNED = f"string_split({_CLOSE}[5:] || {_CLOSE}[1:4], '')"
_CODES = f"list_transform({_TURNED}, lambda c: case when c < 'A' then ascii(c) - 48 else ascii(c) - 55 end)"
_VALID = {
    "email": "true",
    "ip": "list_max(list_transform(string_split(m, '.'), lambda p: p::hugeint)) <= 255",
    "card": f"""length({_DIGITS}) between 13 and 19 and list_sum(list_transform(range(1, length({_DIGITS}) + 1),
        lambda i: case when i % 2 = 1 then reverse({_DIGITS})[i]::int
             when reverse({_DIGITS})[i]::int > 4 then reverse({_DIGITS})[i]::int * 2 - 9
             else reverse({_DIGITS})[i]::int * 2 end)) % 10 = 0""",
    "phone": f"length({_DIGITS}) between 9 and 15",
    "iban": f"""regexp_full_match({_CLOSE}, '[A-Z0-9]{{15,34}}') and list_reduce(list_prepend(0, {_CODES}),
        lambda rest, x: case when x < 10 then (rest * 10 + x) % 97 else (rest * 100 + x) % 97 end) = 1""",
    "ssn": """regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}')
        and not regexp_matches(m, '^(?:000|666|9)|-00-|-0000$')""",
}


def _spans_of(number: int, name: str) -> str:
    kind = KINDS[number]
    context = "" if kind.base else f" and regexp_matches(near, '{kind.context}')" * (kind.score < kind.least)
    pattern = _PLAIN[name]
    return f"""
  select rid, {number} as k, '{name}' as kind, last - length(m) as first, last from (
    select rid, m,
           lower(right(coalesce(ps[i] || ms[i], '') || gap, {CONTEXT}) || ' | '
                 || left(ps[i + 2] || coalesce(ms[i + 2] || ps[i + 3], ''), {CONTEXT})) as near,
           (sum(length(gap) + length(m)) over (partition by rid order by i))::bigint as last
    from (select rid, ms, ps, unnest(ms) as m, unnest(ps[1:len(ms)]) as gap, unnest(range(len(ms))) as i from (
      select rid, regexp_extract_all(body, '{pattern}') as ms, regexp_split_to_array(body, '{pattern}') as ps
      from rows)))
  where {_VALID[name]}{context}"""


def _pii() -> str:
    joined = "coalesce(string_agg(kind || ':' || first || ':' || last, ',' order by k, first){}, '')"
    counts = ", ".join(f"count(*) filter (kind = '{kind.name}') as n_{kind.name}" for kind in KINDS if kind.base)
    base = ", ".join(f"'{kind.name}'" for kind in KINDS if kind.base)
    each = "\n  union all".join(_spans_of(number, kind.name) for number, kind in enumerate(KINDS))
    return f"""
with rows as materialized (select row_number() over () as rid, doc_id, coalesce(text, '') as body from documents),
spans as ({each}
)
select doc_id, {counts}, sha256({joined.format(f" filter (kind in ({base}))")}) as base_sha256,
       {joined.format("")} as spans
from rows left join spans using (rid) group by rid, doc_id"""


PII = _pii()


_USABLE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
_INTEGERS = "list_transform(embedding, lambda x: floor(256 * x::double))"

HARD_NEGATIVES = f"""
with vectors as materialized (
  select row_number() over () as rid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         {_INTEGERS} as v
  from embeddings where label is not null and {_USABLE}
),
pairs as materialized (
  select a.rid as anchor, a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
         list_dot_product(a.v, b.v)::bigint as score
  from vectors a join vectors b on a.rid <> b.rid where a.vec_id % 100 = 0
),
positives as (
  select anchor, anchor_id, vec_id, score, row_number() over (partition by anchor order by score desc, vec_id) as slot
  from pairs where same qualify slot <= 5
)
select p.anchor_id, p.vec_id as positive_id,
       row_number() over (partition by p.anchor, p.slot order by n.score desc, n.vec_id)::int as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join pairs n on n.anchor = p.anchor and not n.same
where 80 * p.score <= 100 * n.score and n.score <= p.score qualify rank <= 5"""


def clustering(centroids: int = 40, rounds: int = 5, dimension: int = 64) -> str:
    """Every vector against every centroid, each round written out."""
    nearest = """a{r} as materialized (
  select rid, vec_id, v, min((list_dot_product(v, v) - 2 * list_dot_product(v, w) + list_dot_product(w, w))::bigint
         * 1000 + c) as best
  from kept, c{r} group by rid, vec_id, v
)"""
    means = """c{n} as materialized (
  select o.c, coalesce(m.w, o.w) as w from c{r} o left join (
    select c, list(((s - (((s % n) + n) % n)) // n)::double order by i) as w from (
      select c, i, sum(x::bigint) as s, count(*) as n
      from (select best % 1000 as c, unnest(v) as x, unnest(range(len(v))) as i from a{r}) group by c, i
    ) group by c
  ) m using (c)
)"""
    steps = [nearest.format(r=r) if turn == 0 else means.format(r=r, n=r + 1) for r in range(rounds) for turn in (0, 1)]
    return f"""
with kept as materialized (
  select row_number() over () as rid, vec_id, {_INTEGERS} as v from embeddings
  where {_USABLE} and len(embedding) = {dimension}
),
c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id) nulls last, v) - 1 as c, v as w
  from kept qualify c < {centroids}
),
{", ".join(steps)},
{nearest.format(r=rounds)}
select vec_id, (best % 1000)::int as cluster, best // 1000 as distance,
       sum(best // 1000) over (partition by best % 1000)::bigint as cluster_inertia,
       sum(best // 1000) over ()::bigint as inertia,
       sha256(array_to_string(list_transform(w, lambda x: x::bigint::varchar), ',')) as centroid_sha256
from a{rounds} join c{rounds} on c = best % 1000"""
