"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'), lambda x: x <> '')"
PLAIN_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

#: Base counts and verdict of the quality rules, for a table with doc_id and text.
QUALITY = rf"""
with d as (select row_number() over () as k, doc_id, coalesce(text, '') as t, {WORDS} as w from {{documents}}),
g as (select k, unnest(range(1, len(w) - 1)) as p, w from d where len(w) >= 3),
r as (select k, p, count(*) over (partition by k, w[p], w[p + 1], w[p + 2]) as c from g),
rep as (select k, count(distinct q) as n from (select k, unnest([p, p + 1, p + 2]) as q from r where c > 1) group by k),
c as (
  select d.k, doc_id, w, t, len(w)::bigint as n_words, length(regexp_replace(t, '[ \x09-\x0D]+', '', 'g'))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) as lines, coalesce(rep.n, 0)::bigint as n_repeat_words
  from d left join rep using (k)),
b as (select *, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c)
select k, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or word_chars < 3 * n_words or word_chars > 12 * n_words or 100 * n_dup_lines > 40 * len(lines)
    or 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 40 * word_chars or 100 * (length(t) - length(replace(t, '!', ''))) > 30 * n_words
    or 100 * (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) > 40 * word_chars or len(list_distinct(w)) < 15) as kept
from b
"""

DECONTAMINATION = rf"""
with d as (select row_number() over () as k, doc_id, {PLAIN_WORDS} as w from {{documents}}),
i as (select item_id, {PLAIN_WORDS} as w from {{benchmark}}),
iw as (select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as g
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as p from (select *, least(10, len(w)) as n from i where len(w) > 0))),
lens as (select distinct n from iw),
dw as (select k, n, p, array_to_string(w[p:p + n - 1], ' ') as g
  from (select k, w, n, unnest(range(1, len(w) - n + 2)) as p from d, lens where len(w) >= n)),
h as (select k, p, dw.n, item_id from dw join iw on dw.n = iw.n and dw.g = iw.g),
c as (select k, count(distinct q) as n_hit from (select k, unnest(range(p, p + n)) as q from h) group by k),
s as (select k, string_agg(x, ',' order by x) as items, count(*) as n_items from (select distinct k, item_id::varchar as x from h) group by k)
select k, doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (k) left join s using (k)
"""

LOW_WORDS = WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

#: Documents with their number of different {n}-word shingles and the least doc_id that links reach, at {percent} % of the union.
JACCARD = rf"""
with recursive d as (select row_number() over () as k, doc_id, {LOW_WORDS} as w from {{documents}}),
s as (select distinct k, unnest(case when len(w) >= {{n}} then list_transform(range(1, len(w) - {{n}} + 2), lambda p: array_to_string(w[p:p + {{n}} - 1], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from d),
n as (select k, count(*) as n from s group by k),
p as (select a.k as x, b.k as y, count(*) as c from s a join s b on a.g = b.g and a.k < b.k group by 1, 2),
e as (select x, y from p join n a on a.k = x join n b on b.k = y where 100 * c >= {{percent}} * (a.n + b.n - c)),
l as (select x, y from e union all select y, x from e),
r(k, z) as (select k, k from d union select r.k, l.y from r join l on l.x = r.z),
c as (select r.k, min(doc_id) as component_id from r join d on d.k = r.z group by 1)
select k, doc_id, coalesce(n, 0)::bigint as n_shingles, component_id from d left join n using (k) left join c using (k)
"""

#: What is left of documents when all words of repeated 35-word windows are gone.
REPEATS = rf"""
with d as (select row_number() over () as k, doc_id, {WORDS} as w from {{documents}}),
i as (select k, p, array_to_string(w[p:p + 34], ' ') as g from (select k, w, unnest(range(1, len(w) - 33)) as p from d where len(w) >= 35)),
g as (select g from i group by g having count(*) > 1),
x as (select distinct k, unnest(range(p, p + 35)) as q from i where g in (select g from g)),
o as (select k, unnest(w) as word, unnest(range(1, len(w) + 1)) as q from d),
t as (select k, string_agg(word, ' ' order by q) as kept from o left join x using (k, q) where x.k is null group by k),
c as (select k, count(*) as n from x group by k)
select k, doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join c using (k) left join t using (k)
"""

#: Cheapest repair of damaged conversations: a recursion over the rows of each, with the best (cost, edits, text) of four states.
CONVERSATIONS = r"""
with recursive crc as (select list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
o as (select dense_rank() over (order by conv_id nulls first) as g, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from {conversations}),
m as (select o.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda x: ascii(substr(key, x, 1)))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 as kind from o, crc),
e as (select g, turn, case when kind = 4 then 'user' else role end as role, case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text,
  unnest(case when kind = 3 then [0, 1] else [0] end) as copy from m where kind > 0),
s as (select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as ink, substr(role, 1, 1) as x, row_number() over (partition by g order by turn nulls first, role, text, copy) as i,
  row_number() over (partition by g, role, text order by turn nulls first, copy) as nth from e),
f as (select *, case when ink = '' then 1 when nth > 1 then 2 when right(ink, 1) in ('.', '!', '?') then 0 else 3 end as fault from s),
z as (select *, lag(x) over (partition by g order by i) || x as pair from f),
sums as (select g, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate,
  count(*) filter (fault = 3) as truncated, count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal from z group by g),
-- n: nothing yet, s: after system, u: after user, a: after assistant; an unreachable state costs 10^9 or more
r as (
  select g, 0::bigint as i, {'c': 0::bigint, 'e': '', 't': ''} as n, {'c': 1000000000::bigint, 'e': '', 't': ''} as s, {'c': 1000000000::bigint, 'e': '', 't': ''} as u, {'c': 1000000000::bigint, 'e': '', 't': ''} as a from (select distinct g from o)
  union all
  select q.g, q.i, list_min([{'c': n.c + 3, 'e': n.e || 'D', 't': n.t}]),
    list_min([{'c': s.c + 3, 'e': s.e || 'D', 't': s.t}, {'c': n.c + k + if(x = 's', 0, 1000000000), 'e': n.e || 'K', 't': w}]),
    list_min([{'c': u.c + 3, 'e': u.e || 'D', 't': u.t}, {'c': n.c + k + if(x = 'u', 0, 1000000000), 'e': n.e || 'K', 't': w}, {'c': n.c + k + 2, 'e': n.e || 'R', 't': 'user:' || text},
      {'c': s.c + k + if(x = 'u', 0, 1000000000), 'e': s.e || 'K', 't': s.t || chr(10) || w}, {'c': s.c + k + 2, 'e': s.e || 'R', 't': s.t || chr(10) || 'user:' || text},
      {'c': a.c + k + if(x = 'u', 0, 1000000000), 'e': a.e || 'K', 't': a.t || chr(10) || w}, {'c': a.c + k + 2, 'e': a.e || 'R', 't': a.t || chr(10) || 'user:' || text}]),
    list_min([{'c': a.c + 3, 'e': a.e || 'D', 't': a.t}, {'c': u.c + k + if(x = 'a', 0, 1000000000), 'e': u.e || 'K', 't': u.t || chr(10) || w}, {'c': u.c + k + 2, 'e': u.e || 'R', 't': u.t || chr(10) || 'assistant:' || text}])
  from (
    select p.g, f.i, f.x, f.text, f.role || ':' || f.text as w, case fault when 3 then 1 when 0 then 0 else 1000000000 end as k, n, s, u1 as u,
      list_min([a, {'c': u1.c + 2, 'e': u1.e || 'I', 't': u1.t || chr(10) || 'assistant:'}]) as a
    from (select *, list_min([u, {'c': n.c + 2, 'e': n.e || 'I', 't': 'user:'}, {'c': s.c + 2, 'e': s.e || 'I', 't': s.t || chr(10) || 'user:'}, {'c': a.c + 2, 'e': a.e || 'I', 't': a.t || chr(10) || 'user:'}]) as u1 from r) p
    join f on f.g = p.g and f.i = p.i + 1) q),
b as (select r.g, list_min([r.n, r.a, {'c': r.u.c + 2, 'e': r.u.e || 'I', 't': r.u.t || chr(10) || 'assistant:'}, {'c': r.s.c + 4, 'e': r.s.e || 'II', 't': r.s.t || chr(10) || 'user:' || chr(10) || 'assistant:'}]) as b
  from r left join sums using (g) where r.i = coalesce(sums.n, 0))
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, b.b.c as cost, b.b.e as audit, sha256(b.b.t) as repaired_sha256
from (select distinct g, conv_id from o) o left join sums using (g) join b using (g)
"""

#: The best {top} phrases of two and three words of each language, of those found {least} times or more.
COLLOCATIONS = r"""
with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from {documents}),
p as (select lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') as w from d),
u as (select lang, x, count(*) as n from (select lang, unnest(w) as x from p) group by all),
b as (select lang, x, y, count(*) as n from (select lang, unnest(w[:-2]) as x, unnest(w[2:]) as y from p where len(w) > 1) group by all),
t as (select lang, x, y, z, count(*) as n from (select lang, unnest(w[:-3]) as x, unnest(w[2:-2]) as y, unnest(w[3:]) as z from p where len(w) > 2) group by all having count(*) >= {least}),
around as (select lang, x, y, max(n) as n from (select lang, x, y, n from t union all select lang, y, z, n from t) group by all),
two as (select b.lang, b.x || ' ' || b.y as phrase, b.n as a, l.n as l, r.n as r from b join u l on l.lang = b.lang and l.x = b.x join u r on r.lang = b.lang and r.x = b.y
  left join around o on o.lang = b.lang and o.x = b.x and o.y = b.y where b.n >= {least} and (o.n is null or 100 * o.n < 50 * b.n)),
three as (select t.lang, t.x || ' ' || t.y || ' ' || t.z as phrase, t.n as a, l1.n as l1, r1.n as r1, l2.n as l2, r2.n as r2,
    (1000000 * t.n::hugeint * t.n::hugeint) // (l1.n::hugeint * r1.n::hugeint) as s1, (1000000 * t.n::hugeint * t.n::hugeint) // (l2.n::hugeint * r2.n::hugeint) as s2
  from t join u l1 on l1.lang = t.lang and l1.x = t.x join b r1 on r1.lang = t.lang and r1.x = t.y and r1.y = t.z
    join b l2 on l2.lang = t.lang and l2.x = t.x and l2.y = t.y join u r2 on r2.lang = t.lang and r2.x = t.z),
every as (select lang, phrase, a, l, r, (1000000 * a::hugeint * a::hugeint) // (l::hugeint * r::hugeint) as score from two
  union all select lang, phrase, a, if(s1 <= s2, l1, l2), if(s1 <= s2, r1, r2), least(s1, s2) from three),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from every),
n as (select lang, sum(n) as n from u group by lang)
select lang, rank, phrase, a, l, r, n.n::bigint as n, score::bigint as score from ranked join n using (lang) where rank <= {top}
"""

ORACLES = {
    "op3_ngram_jaccard": f"select * exclude (k) from ({JACCARD.format(documents='documents', n=4, percent=85)})",
    "op4_quality_rules": f"select * exclude (k) from ({QUALITY.replace('{documents}', 'documents')})",
    "op5_substring_dedup": f"select * exclude (k) from ({REPEATS.replace('{documents}', 'documents')})",
    "op11_minhash": f"select * exclude (k), doc_id is not distinct from component_id as kept from ({JACCARD.format(documents='documents', n=5, percent=85)})",
    "op12_collocations": COLLOCATIONS.format(documents="documents", least=10, top=2000),
    "op13_conversation_repair": CONVERSATIONS.replace("{conversations}", "conversations"),
    "op8_decontamination": f"select * exclude (k) from ({DECONTAMINATION.replace('{documents}', 'documents').replace('{benchmark}', 'benchmark')})",
}
