"""SQL for the queries that SQL can express."""

from __future__ import annotations

# Conversations 2n and 2n + 1 lend each other their last assistant turn; positions are code points of the completion.
PREFERENCE = r"""
with last as (
  select conv_id, max(turn) as last_turn, max_by(coalesce(text, ''), turn) as said
  from conversations where role = 'assistant' and conv_id is not null group by conv_id),
swaps as (
  select l.conv_id, l.last_turn, coalesce(o.said, '') as said from last l left join last o on o.conv_id = xor(l.conv_id, 1)),
sides as (
  select c.conv_id as pair_id, c.turn, coalesce(c.role, 'unknown') as role, coalesce(c.text, '') as one,
    case when c.role = 'assistant' and c.turn = s.last_turn then s.said else coalesce(c.text, '') end as two
  from conversations c join swaps s on s.conv_id = c.conv_id),
numbered as (select *, row_number() over (partition by pair_id order by turn nulls last, role, one) as nth from sides),
shared as (
  select pair_id, coalesce(min(nth) filter (one <> two) - 1, max(nth)) as prompt_turns from numbered group by pair_id),
turns as (
  select n.pair_id, nth, role, prompt_turns, nth > prompt_turns as own,
    '<|' || role || '|>' || chr(10) || one || '<|end|>' || chr(10) as one,
    '<|' || role || '|>' || chr(10) || two || '<|end|>' || chr(10) as two
  from numbered n join shared s on s.pair_id = n.pair_id),
placed as (
  select *, sum(length(one)) over w as one_end, sum(length(two)) over w as two_end
  from turns window w as (partition by pair_id, own order by nth))
select pair_id, pair_id as chosen_id, -1 - pair_id as rejected_id, prompt_turns::int as prompt_turns,
  coalesce(string_agg(one, '' order by nth) filter (not own), '') as prompt,
  coalesce(string_agg(one, '' order by nth) filter (own), '') as chosen,
  coalesce(string_agg((one_end - length(one) + length(role) + 5) || ':' || one_end, ',' order by nth)
    filter (own and role = 'assistant'), '') as chosen_mask,
  coalesce(string_agg(two, '' order by nth) filter (own), '') as rejected,
  coalesce(string_agg((two_end - length(two) + length(role) + 5) || ':' || two_end, ',' order by nth)
    filter (own and role = 'assistant'), '') as rejected_mask
from placed group by pair_id, prompt_turns
"""

# Every pair of texts that share a shingle is counted in full; components by following links.
SIMILAR = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, other) as (
  select doc_id, doc_id from words union select r.doc_id, l.b from reach r join links l on l.a = r.other)
select d.doc_id, coalesce(max(n), 0)::bigint as n_shingles, min(other) as component_id
from words d join reach r on r.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id
group by d.doc_id
"""

# Every vector against every other of its label, in double precision.
VECTORS = """
with recursive sound as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
units as (select vec_id, label, v, sqrt(list_inner_product(v, v)) as norm from sound),
links as (
  select a.vec_id as a, b.vec_id as b from units a join units b on a.label = b.label and a.vec_id <> b.vec_id
  where list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
reach(vec_id, other) as (
  select vec_id, vec_id from embeddings union select r.vec_id, l.b from reach r join links l on l.a = r.other),
named as (select vec_id, min(other) as component_id from reach group by vec_id)
select n.vec_id, (select count(*) from links where a = n.vec_id)::bigint as n_links, component_id, n.vec_id = component_id as kept
from named n
"""

# Texts are compared without ASCII white space; the one with the most code points stays, then the smallest id.
EXACT = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from (select doc_id, sha256(norm) as text_sha256,
        first_value(doc_id) over (partition by norm order by n_chars desc, doc_id) as keep_id,
        count(*) over (partition by norm) as group_size
      from t)
"""


# crc32 byte by byte from its table; near words meet in the word without one letter.
SPELLING = r"""
with recursive crc as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents)
  where length(run) >= 7 group by all),
hashed as (
  select run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
    lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)]::bigint[] end))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) as h
  from runs, crc),
words as (
  select word, sum(n)::bigint as n from (
    select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed)
  where length(word) >= 7 group by word having sum(n) >= 2),
cut as (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, b.word as other from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select word, rest from cut where rest in (select word from words)
  union select rest, word from cut where rest in (select word from words)),
best as (
  select near.word, count(*) as n_near, first(other order by w.n desc, other) as other, max(w.n) as other_n
  from near join words w on w.word = near.other group by near.word),
forms as (
  select word, n, coalesce(n_near, 0) as n_near, case when other_n >= 10 * n then other end as form, case when other_n >= 10 * n then other_n end as form_n
  from words left join best using (word)),
steps(word, root) as (
  select word, word from forms union all select s.word, f.form from steps s join forms f on f.word = s.root where f.form is not null)
select f.word, form, s.root, n, n_near, form_n
from forms f join steps s on s.word = f.word where s.root in (select word from forms where form is null)
"""


def oracles() -> dict[str, str]:
    return {
        "op1_preference_pairs": PREFERENCE,
        "op4_adaptive_prefix_join": SIMILAR,
        "op5_robust_pruned_graph": VECTORS,
        "op6_chunk_recipes": EXACT,
        "op11_kd_letter_counts": SPELLING,
    }
