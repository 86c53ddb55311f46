"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from textloom.llm.line_rules import PHRASE, SHORT_LINE

_WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op9_hash_mixing"] = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
  from sized group by source),
ranked as (
  select *, row_number() over (order by 2.0::double * source_size / weight, source nulls last) as k from sources),
levels as (
  select k, source_size, weight,
         (1.5::double * sum(source_size) over ()
          - coalesce(sum(2 * source_size) over (order by k rows between unbounded preceding and 1 preceding), 0))
         / (sum(weight) over (order by k rows between current row and unbounded following)) as level
  from ranked),
chosen as (select level from levels where weight * level <= 2 * source_size order by k limit 1),
targets as (
  select source, source_size,
         least((2 * source_size)::double, weight * coalesce((select level from chosen), 0)::double) as target
  from ranked),
budgets as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as times,
         target - times * source_size as budget
  from targets),
placed as (
  select d.doc_id, d.size, b.source_size, b.target, b.times, b.budget,
         sum(d.size) over (partition by d.source order by h range between unbounded preceding and current row) as upto,
         sum(d.size) over (partition by d.source, h) as own
  from sized d join budgets b on d.source is not distinct from b.source)
select doc_id, size, source_size, target,
       (size * (times + case when upto + (upto - own) <= 2 * budget then 1 else 0 end))::bigint as taken
from placed
"""

_LINE_WORDS = rf"len(regexp_extract_all(l, '{_WORD}'))"
_BARS = "len(regexp_extract_all(l, '[|»›•]'))"
_MARKS = "len(regexp_extract_all(l, '[#*$%&<>]+|!!+'))"
_FAILS = rf"""(({_BARS} >= 3 and {_BARS} * 3 >= {_LINE_WORDS})
     or ({_LINE_WORDS} < 3 and not regexp_matches(l, '[.!?:;…"'')»”][\x20\x09-\x0D]*$'))
     or ({_MARKS} >= 3 and {_MARKS} * 3 >= {_LINE_WORDS})
     or ({_LINE_WORDS} <= {SHORT_LINE} and regexp_matches(lower(l), '{PHRASE}')))"""

ORACLES["op10_line_rules"] = rf"""
with texts as (
  select doc_id, row_number() over () as r, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') as w
  from documents),
windows as (
  select r, unnest(range(1, len(w) - 3)) as i, w from texts where len(w) >= 5),
grams as (
  select r, i, count(*) over (partition by r, array_to_string(w[i:i + 4], ' ')) as n from windows),
steps as (
  select r, least(5, coalesce(lead(i) over (partition by r order by i) - i, 5)) as step from grams where n > 1),
repeated as (select r, sum(step)::bigint as n_repeat_words from steps group by r),
measured as (
  select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) as lines,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words,
         coalesce(list_sum(list_transform(lines, lambda l: case when {_FAILS} then 0 else {_LINE_WORDS} end)), 0)
           as n_kept
  from texts left join repeated using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_kept >= 0.5 * n_words as kept
from measured
"""
