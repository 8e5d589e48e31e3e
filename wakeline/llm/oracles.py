"""DuckDB SQL for the results of those queries that SQL can express, by plain definitions and not by the methods."""

from __future__ import annotations

from .mixing import BLOCK_TOKENS, LEVELS, ROUNDS

_LINKS_TO_CLASSES = """
reach as (select id as node, id as root from nodes union select links.b, reach.root from reach join links on links.a = reach.node),
classes as (select node as id, min(root) as class_id from reach group by node)"""

OP1 = r"""
with lines as (
  select doc_id, unnest(range(len(l))) as pos, unnest(l) as line from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
normal as (select doc_id, pos, line, trim(regexp_replace(line, '\s+', ' ', 'g')) as norm from lines),
firsts as (select norm, min((doc_id, pos)) as spot, string_split(norm, ' ') as w from normal where norm <> '' group by norm),
long as (select * from firsts where len(w) >= 5),
places as (select norm, spot, w, unnest(range(1, len(w) + 1)) as i from long),
variants as (select norm, spot, i, array_to_string(w[:i - 1], ' ') || '|' || array_to_string(w[i + 1:], ' ') as key, trim(array_to_string(w[:i - 1], ' ') || ' ' || array_to_string(w[i + 1:], ' ')) as rest from places),
near as (
  select norm from (select norm, spot, min(spot) over (partition by i, key) as least from variants) where spot > least
  union select case when v.spot > f.spot then v.norm else f.norm end from variants v join long f on f.norm = v.rest),
judged as (
  select n.doc_id, n.pos, n.line, n.norm <> '' as counts, n.norm <> '' and ((n.doc_id, n.pos) > f.spot or n.norm in (select norm from near)) as gone
  from normal n left join firsts f on f.norm = n.norm)
select doc_id, count(*) filter (counts) as n_lines, count(*) filter (gone) as n_removed,
  coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as text
from judged group by doc_id
"""


def op3(repeats: float) -> str:
    """The bisection as one round after another, and the blocks by running sums."""
    points = 1 << LEVELS
    rounds, low, step = [], "0.0::double", 1.0
    for r in range(ROUNDS):
        step /= points
        rounds.append(
            f"r{r} as (select min(alpha) as first, {step!r}::double as step from (select alpha, max(exp(alpha * ln(p)) / p) / sum(exp(alpha * ln(p))) as m "
            f"from (select tokens::double / (select sum(tokens) from filled)::double as p, unnest(range({points + 1})) as i from filled) s, (select {low} as low) l, lateral (select low + i * {step!r}::double as alpha) a group by alpha) where m <= {repeats + 1e-9!r})"
        )
        low = f"(select first - step from r{r})"
    hashed = "('0x' || substr(md5('mix|' || {}), 1, 15))::bigint"
    return f"""
with docs as (
  select doc_id, source, coalesce('=' || source, '') as key, coalesce(doc_id::varchar, '') as id,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> ''))::bigint as tokens from documents),
sources as (select key, sum(tokens)::bigint as tokens from docs group by key),
filled as (select * from sources where tokens > 0),
{", ".join(rounds)},
alpha as (select case when (select first from r0) = 0 then 0.0 else coalesce((select first from r{ROUNDS - 1}), 1.0) end as a),
weights as (
  select key, tokens, case when tokens > 0 then round(exp(a * ln(tokens)) / (select sum(exp(a * ln(tokens))) from filled), 9) else 0.0 end as weight from sources, alpha),
budgets as (
  select key, weight, case when tokens > 0 then floor(weight * (select sum(tokens) from filled))::bigint // tokens else 1 end as passes,
    case when tokens > 0 then floor(weight * (select sum(tokens) from filled))::bigint % tokens else 0 end as room, ceil(greatest(tokens, 1) / {BLOCK_TOKENS})::bigint as blocks from weights),
placed as (select d.*, b.weight, b.passes, b.room, {hashed.format("d.key || '|' || d.id")} % b.blocks as block from docs d join budgets b on b.key = d.key),
turned as (select *, {hashed.format("key || '|block|' || block")} as turn, {hashed.format("key || '|document|' || id")} as place from placed),
blocks as (select key, block, any_value(turn) as turn, any_value(room) as room, sum(tokens)::bigint as n from turned group by key, block),
summed as (select *, sum(n) over (partition by key order by turn, block) as upto from blocks),
edge as (select key, min((turn, block)) as spot, arg_min(room - (upto - n), (turn, block)) as space from summed where upto > room group by key),
inner_ as (select t.key, t.place, t.id, sum(t.tokens) over (partition by t.key order by t.place, t.id) as upto, e.space from turned t join edge e on e.key = t.key and t.block = e.spot[2]),
last_ as (select key, max((place, id)) as spot from inner_ where upto <= space group by key)
select t.doc_id, t.source, t.tokens, t.block, t.weight, t.passes,
  t.passes + case when t.room > 0 and (e.spot is null or (t.turn, t.block) < e.spot or ((t.turn, t.block) = e.spot and (t.place, t.id) <= l.spot)) then 1 else 0 end as copies
from turned t left join edge e on e.key = t.key left join last_ l on l.key = t.key
"""


OP5 = f"""
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings),
fit as (
  select * from v where label is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and list_inner_product(e, e) > 0),
links as (
  select x.vec_id as a, y.vec_id as b from fit x join fit y on x.label = y.label and x.vec_id <> y.vec_id
  where list_inner_product(x.e, y.e) / (sqrt(list_inner_product(x.e, x.e)) * sqrt(list_inner_product(y.e, y.e))) >= 0.93),
nodes as (select vec_id as id from v),
{_LINKS_TO_CLASSES}
select c.id as vec_id, coalesce(n, 0)::bigint as n_links, class_id as component_id, c.id = class_id as kept
from classes c left join (select a, count(*) as n from links group by a) l on l.a = c.id
"""

OP8 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select a.vec_id as query_id, b.vec_id as vec_id, list_inner_product(a.e, b.e)::bigint as score from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP9 = f"""
with d as (select doc_id, {_WORDS} as w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as x from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
dups as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by x) as least from windows) where doc_id > least),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as i from dups),
words as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from d),
kept as (
  select words.doc_id, count(gone.i) as n_removed, string_agg(word, ' ' order by words.i) filter (gone.i is null) as text
  from words left join gone on gone.doc_id = words.doc_id and gone.i = words.i group by words.doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256 from d left join kept on kept.doc_id = d.doc_id
"""

OP10 = f"""
with recursive d as (select doc_id, {_WORDS} as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
sizes as (select doc_id, count(*) as n, md5(string_agg(s, '|' order by s)) as print from shingles group by doc_id),
common as (select x.doc_id as a, y.doc_id as b, count(*) as k from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id),
links as (select a, b, sa.print as pa, sb.print as pb from common join sizes sa on sa.doc_id = a join sizes sb on sb.doc_id = b where k >= 0.8 * (sa.n + sb.n - k) - 1e-9),
nodes as (select doc_id as id from d),
{_LINKS_TO_CLASSES}
select c.id as doc_id, class_id, coalesce(n, 0)::bigint as n_links, coalesce(m, 0)::bigint as n_texts, c.id = class_id as kept
from classes c left join (select a, count(*) as n, count(distinct pb) filter (pb <> pa) as m from links group by a) l on l.a = c.id
"""
