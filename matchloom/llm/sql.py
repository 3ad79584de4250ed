"""SQL for DuckDB that gives the same rows as the query of that name."""

WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""

ORACLE = {
    "op7_set_relation_join": f"""
with recursive words as (select doc_id, {WORDS} as w from documents),
sets as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) end) as s from words),
kinds as (select list_sort(s) as s, len(s) as n, min(doc_id) as rep from sets group by all),
tokens as (select rep, n, unnest(s) as t from kinds),
shared as (select a.rep as x, b.rep as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as o from tokens a join tokens b on a.t = b.t and a.rep < b.rep
  and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) group by 1, 2),
links as (select x, y from shared where 100 * o >= 85 * (nx + ny - o)),
both_ways as (select x, y from links union select y, x from links),
reach as (select rep as x, rep as y from kinds where n > 0 union select r.x, l.y from reach r join both_ways l on r.y = l.x),
least_of as (select x, min(y) as component_id from reach group by x)
select d.doc_id, cast(len(d.s) as bigint) as n_shingles, coalesce(c.component_id, d.doc_id) as component_id
from sets d left join kinds k on k.s = list_sort(d.s) and k.n > 0 left join least_of c on c.x = k.rep""",
    "content_chunk_dedup": """
with lines as (select doc_id, md5(text) as h, string_split(text, chr(10)) as l from documents),
hashed as (select *, list_transform(l, lambda x: cast('0x' || substr(md5(x), 1, 7) as bigint)) as v from lines),
ends as (select *, list_filter(range(1, len(l)), lambda i: (v[i] + 31 * coalesce(v[i - 1], 0)) % 3 = 0) as e from hashed),
bounds as (select doc_id, h, l, list_concat([0], e, [len(l)]) as b from ends),
parts as (select doc_id, h, unnest(list_transform(range(1, len(b)), lambda k: {'s': b[k], 'n': b[k + 1] - b[k], 'c': l[b[k] + 1 : b[k + 1]]})) as p from bounds),
chunks as (select doc_id, h, p.s as s, p.n as n, array_to_string(p.c, chr(10)) as c from parts where len(list_filter(p.c, lambda x: trim(x) <> '')) >= 2),
marked as (select *, first_value((doc_id, s)) over (partition by c order by doc_id, s) as f from chunks),
gone as (select distinct doc_id, h, s, n from marked where (doc_id, s) > f),
lost as (select doc_id, h, sum(n) as removed_lines, count(*) as removed_chunks, flatten(list(range(s, s + n))) as g from gone group by 1, 2)
select d.doc_id, case when x.g is null then d.text else array_to_string(list_transform(list_filter(range(0, len(l.l)), lambda i: not list_contains(x.g, i)), lambda i: l.l[i + 1]), chr(10)) end as text,
  cast(len(l.l) as bigint) as n_lines, cast(coalesce(removed_lines, 0) as bigint) as removed_lines, cast(coalesce(removed_chunks, 0) as bigint) as removed_chunks
from documents d join (select distinct doc_id, h, l from lines) l on l.doc_id = d.doc_id and l.h = md5(d.text) left join lost x on x.doc_id = d.doc_id and x.h = l.h""",
    "op1_preference_format": """
with t as (select conv_id as pair_id, turn, role, text from conversations),
last_turn as (select pair_id, max(turn) as turn from t group by 1),
last_text as (select t.pair_id, min(t.text) as text from t join last_turn l on t.pair_id = l.pair_id and t.turn = l.turn group by 1),
rejected as (select t.pair_id, t.turn, t.role, case when t.turn = l.turn then o.text else t.text end as text
  from t join last_turn l on t.pair_id = l.pair_id left join last_text o on o.pair_id = xor(t.pair_id, 1) where t.turn < l.turn or o.text is not null),
sides as (select *, 'chosen' as side from t union all select *, 'rejected' from rejected),
per_turn as (select pair_id, turn, count(*) filter (side = 'chosen') as n, list_sort(list((role, text)) filter (side = 'chosen')) as c, list_sort(list((role, text)) filter (side = 'rejected')) as r from sides group by 1, 2),
split as (select pair_id, coalesce(min(turn) filter (c is distinct from r), 4611686018427387904) as split from per_turn group by 1),
parts as (select s.pair_id, case when s.turn < p.split then 'prompt' else s.side end as part, s.turn // 64 as block, s.turn, s.role, s.text, '<|' || s.role || '|>' || chr(10) as head
  from sides s join split p on s.pair_id = p.pair_id where s.side = 'chosen' or s.turn >= p.split),
placed as (select *, head || text || '<|end|>' || chr(10) as whole, row_number() over w as pos, sum(length(head || text || '<|end|>' || chr(10))) over (w rows unbounded preceding) as e
  from parts window w as (partition by pair_id, part, block order by turn, role, text)),
done as (select pair_id, cast(block as bigint) as block, coalesce(string_agg(whole, '' order by pos) filter (part = 'prompt'), '') as prompt,
  coalesce(string_agg(whole, '' order by pos) filter (part = 'chosen'), '') as chosen, coalesce(string_agg(span, ',' order by pos) filter (part = 'chosen'), '') as chosen_mask,
  coalesce(string_agg(whole, '' order by pos) filter (part = 'rejected'), '') as rejected, coalesce(string_agg(span, ',' order by pos) filter (part = 'rejected'), '') as rejected_mask, count(*) as n_turns
  from (select *, case when part <> 'prompt' and role = 'assistant' then cast(e - length(whole) + length(head) as varchar) || ':' || cast(e as varchar) end as span from placed) group by 1, 2)
select d.*, cast((select coalesce(sum(q.n), 0) from per_turn q where q.pair_id = d.pair_id and q.turn < p.split) as bigint) as prompt_turns from done d join split p on p.pair_id = d.pair_id""",
    "op8_content_archive": """
with p as (select page_id, sha256(coalesce(html, '')) as payload_digest, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first_id from p)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and page_id > first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id > first_id then first_id end as refers_to from f""",
    "op11_filter_interactions": """
with w as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
firsts as (select t as ft, min(doc_id) as first_id from w group by 1),
known as (select doc_id as label_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by 1),
flags as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, case when len(w) < 200 then 1 else 0 end as fa, case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end as fb,
  case when 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) then 4 else 0 end as fc, case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end as fd,
  case when doc_id > first_id then 16 else 0 end as fe from w left join firsts on ft = t left join known on label_id = doc_id),
masks as (select part, fa + fb + fc + fd + fe as m, count(*) as n, sum(good) as g, sum(toxic) as x from flags group by 1, 2),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (select a.f || b.f || c.f || d.f || e.f as filter_order from letters a, letters b, letters c, letters d, letters e
  where (select count(distinct y.f) from (values (a.f), (b.f), (c.f), (d.f), (e.f)) as y(f)) = 5),
steps as (select filter_order, step, cast(1 << (ascii(substr(filter_order, step, 1)) - 65) as integer) as bit,
  cast(list_sum(list_concat([0], list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i, 1)) - 65)))) as integer) as before from orders, (select cast(unnest(range(1, 6)) as integer) as step)),
done as (select part, filter_order, step, bit, sum(n) filter (m & (before | bit) = 0) as kept, sum(n) filter (m & before = 0 and m & bit <> 0) as removed,
  sum(n) filter (m & before <> 0 and m & bit <> 0) as redundant, sum(n) filter (m = bit) as unique_fails, sum(g) filter (m & before = 0 and m & bit <> 0) as good_lost,
  sum(x) filter (m & before = 0 and m & bit <> 0) as toxic_lost from masks, steps group by 1, 2, 3, 4)
select part, filter_order, step, cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
  cast(coalesce(unique_fails, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(sum(coalesce(removed, 0)) over (partition by part, bit) as bigint) as shapley from done""",
    "op12_phrase_collocations": r"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p from documents),
words as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
sums as (select lang, sum(len(w)) as n from words group by 1),
grams as (select lang, unnest(flatten([list_transform(range(1, len(w) + 1), lambda i: w[i]), list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
  list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])])) as phrase from words),
f as (select lang, phrase, count(*)::hugeint as f, string_split(phrase, ' ') as w from grams group by 1, 2 having count(*) >= 10),
cuts as (select lang, phrase, f as a, w, unnest(range(1, len(w))) as k from f where len(w) > 1),
scored as (select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r, (1000000 * c.a * c.a) // (x.f * y.f) as score from cuts c
  join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1 : c.k], ' ') join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1 :], ' ')),
lowest as (select *, row_number() over (partition by lang, phrase order by score, k) as o from scored),
longer as (select lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase, f as b from f where len(w) = 3),
covered as (select lang, phrase, max(b) as b from longer group by 1, 2),
kept as (select q.* from lowest q left join covered c on c.lang = q.lang and c.phrase = q.phrase where o = 1 and (c.b is null or 100 * c.b < 50 * q.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select r.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked r join sums s on s.lang = r.lang where rank <= 2000""",
    "op13_quantised_near_dedup": """
with recursive v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings),
sound as (select vec_id, e from v where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (select a.vec_id as x, b.vec_id as y from sound a join sound b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id as x, vec_id as y from v union select r.x, l.y from reach r join links l on r.y = l.x),
least_of as (select x, min(y) as component_id from reach group by x),
counts as (select x, count(*) as n from links group by 1)
select v.vec_id, cast(coalesce(n, 0) as bigint) as n_links, component_id, v.vec_id = component_id as kept from v join least_of on least_of.x = v.vec_id left join counts on counts.x = v.vec_id""",
}
