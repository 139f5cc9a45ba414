"""Independent DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
with rows as (
  select doc_id, length(coalesce(text, '')) as points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents
), ranked as (
  select *, count(*) over (partition by text_sha256) as group_size,
         first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id nulls last) as keep_id
  from rows
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from ranked
"""

CHAT_FORMAT = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked as (
  select *,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') as marked_role,
    regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') as marked_text
  from said
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>' || marked_role || chr(10) || marked_text || '<|im_end|>' || chr(10))) as bigint)
    as formatted_chars
from marked group by conv_id
"""

COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), split as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), runs as (
  select lang, w, unnest(range(1, 5)) as k from split
), places as (
  select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from runs
), grams as (
  select lang, k as words, array_to_string(w[i : i + k - 1], ' ') as phrase from places
), f as (
  select lang, words, phrase, count(*) as a from grams group by all
), totals as (
  select lang, cast(sum(a) as bigint) as n from f where words = 1 group by lang
), often as (
  select *, string_split(phrase, ' ') as w from f where a >= 30
), places_of_cuts as (
  select *, unnest(range(1, words)) as k from often
), cuts as (
  select c.lang, c.phrase, c.words, c.a, k, p.a as l, q.a as r,
    cast((2000000::hugeint * c.a) // (p.a::hugeint + q.a) as bigint) as score
  from places_of_cuts c
  join f p on p.lang = c.lang and p.phrase = array_to_string(c.w[1 : k], ' ')
  join f q on q.lang = c.lang and q.phrase = array_to_string(c.w[k + 1 : ], ' ')
), weakest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), shorter as (
  select lang, words, a, w, unnest(range(2, words)) as k from often
), inside as (
  select lang, a, w, k, unnest(range(1, words - k + 2)) as i from shorter
), around as (
  select lang, array_to_string(w[i : i + k - 1], ' ') as phrase, max(a) as most from inside group by all
), ranked as (
  select *, count(*) over (partition by text_sha256) as group_size,
         first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id nulls last) as keep_id
  from rows
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from ranked
"""

CHAT_FORMAT = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked as (
  select *,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') as marked_role,
    regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') as marked_text
  from said
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>' || marked_role || chr(10) || marked_text || '<|im_end|>' || chr(10))) as bigint)
    as formatted_chars
from marked group by conv_id
"""

COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), split as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), runs as (
  select lang, w, unnest(range(1, 5)) as k from split
), places as (
  select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from runs
), grams as (
  select lang, k as words, array_to_string(w[i : i + k - 1], ' ') as phrase from places
), f as (
  select lang, words, phrase, count(*) as a from grams group by all
), totals as (
  select lang, cast(sum(a) as bigint) as n from f where words = 1 group by lang
), often as (
  select *, string_split(phrase, ' ') as w from f where a >= 30
), places_of_cuts as (
  select *, unnest(range(1, words)) as k from often
), cuts as (
  select c.lang, c.phrase, c.words, c.a, k, p.a as l, q.a as r,
    cast((2000000::hugeint * c.a) // (p.a::hugeint + q.a) as bigint) as score
  from places_of_cuts c
  join f p on p.lang = c.lang and p.phrase = array_to_string(c.w[1 : k], ' ')
  join f q on q.lang = c.lang and q.phrase = array_to_string(c.w[k + 1 : ], ' ')
), weakest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), around as (
  select lang, array_to_string(w[i : i + k - 1], ' ') as phrase, max(a) as most
  from often, range(2, words) as lengths(k), range(1, words - k + 2) as places(i) group by all
), ranked as (
  select c.*, row_number() over (partition by c.lang order by score desc, c.a desc, encode(c.phrase)) as rank
  from weakest c left join around x on x.lang = c.lang and x.phrase = c.phrase
  where x.most is null or 100::hugeint * x.most < 80::hugeint * c.a
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": EXACT_DEDUP, "op11_chat_format": CHAT_FORMAT, "op12_collocations": COLLOCATIONS}
