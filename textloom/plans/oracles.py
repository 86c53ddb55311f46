"""The queries as SQL for a single-node engine, to compare results."""

from __future__ import annotations

from textloom.operators.permutation import HASH_DIGITS, ROUNDS
from textloom.plans.queries import (
    CORPUS, EPOCH, FEED, LEARNED_MERGES, PROMPT_CHARS, SHARD_ROWS, WORLD_SIZE)

LOW, HIGH, LENGTH, BINS = CORPUS.min_chars, CORPUS.max_chars, CORPUS.max_length, CORPUS.histogram_bins

# Fixed value: the word pattern in classes that all regular-expression engines know.
_WORD_CLASS = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}"
_SPACE_CLASS = r"\p{Z}\x{09}-\x{0D}\x{85}"
WORD_PATTERN = rf"[{_WORD_CLASS}]+|[^{_WORD_CLASS}{_SPACE_CLASS}]+"


def _with(*tables: str) -> str:
    return "with " + ",\n".join(tables)


# Tables ------------------------------------------------------------------------

def _chunked(name: str, source: str, keys: str, column: str = "text") -> str:
    return f"""{name} as (
  select {keys}, part_idx, {column} from (
    select {keys}, unnest(parts) as {column}, unnest(range(len(parts)))::integer as part_idx from (
      select {keys}, case when length({column}) <= {HIGH} then [{column}]
                          else string_split({column}, chr(10)) end as parts
      from {source} where length({column}) >= {LOW}))
  where length({column}) between {LOW} and {HIGH})"""


CHUNKS = _chunked("chunks", "documents", "doc_id")

CORPORA = """corpora as (
  select 'documents' as corpus, doc_id::varchar as row_id, text from documents
  union all select 'conversations', conv_id || '-' || turn, text from conversations
  union all select 'benchmark', item_id::varchar, text from benchmark)"""

HASHED = f"""hashed as (
  select doc_id, part_idx, text, md5('{CORPUS.seed}:' || doc_id || ':' || part_idx) as h,
         md5('{CORPUS.seed}:{EPOCH}:' || doc_id || ':' || part_idx) as eh, count(*) over () as n
  from chunks)"""

SPLIT = f"""labelled as (
  select doc_id, part_idx, text,
         case when row_number() over (order by h, doc_id, part_idx)
                   <= ceil({CORPUS.test_ratio}::double * n) then 'test' else 'train' end as split, h
  from hashed)"""

SHARDS = f"""shards as (
  select *, row_number() over (partition by split order by h, doc_id, part_idx) - 1 as pos, count(*) over (partition by split) as split_rows
  from labelled),
sharded as (
  select *, case when pos < m * (q + 1) then pos // (q + 1) else m + (pos - m * (q + 1)) // q end as shard_id
  from (select *, split_rows // k as q, split_rows % k as m from (
    select *, ceil(split_rows / {SHARD_ROWS})::bigint as k from shards)))"""

ORDERED = """ordered as (
  select *, row_number() over (order by doc_id, part_idx) - 1 as pos from chunks)"""

RANKED = f"""placed as (
  select doc_id, part_idx, row_number() over (order by eh, doc_id, part_idx) - 1 as pos, n from hashed),
ranked as (
  select doc_id, part_idx, pos, slot % {WORLD_SIZE} as rank, slot // {WORLD_SIZE} as rank_pos
  from (select *, unnest(range(pos, (ceil(n / {WORLD_SIZE}) * {WORLD_SIZE})::bigint, n)) as slot from placed))"""


def _words(name: str, source: str, keys: str, column: str = "text") -> str:
    return f"""{name} as (
  select {keys}, unnest(w) as word, unnest(range(len(w)))::integer as word_idx
  from (select {keys}, regexp_extract_all({column}, '{WORD_PATTERN}') as w from {source}))"""


WORDS = _words("words", "chunks", "doc_id, part_idx")
COUNTS = "counted as (select word, count(*) as cnt from words group by word)"


def _alphabet(name: str, source: str) -> str:
    return f"""{name} as (
  select tok, 3 + row_number() over (order by tok) as id
  from (select distinct unnest(string_split(word, '')) as tok from {source}))"""


ALPHABET = _alphabet("alpha", "counted")

SPECIALS = """specials as (
  select * from (values ('[UNK]', 0), ('[PAD]', 1), ('[SOS]', 2), ('[EOS]', 3)) v(tok, id))"""

# A word as a text of its symbols, each between chr(1) and chr(2).
_OPEN, _CLOSE = "chr(1)", "chr(2)"
_SYMBOLS = f"{_OPEN} || array_to_string(string_split(word, ''), {_CLOSE} || {_OPEN}) || {_CLOSE}"


def _symbol_list(column: str = "s") -> str:
    return f"string_split({column}[2:length({column}) - 1], {_CLOSE} || {_OPEN})"


def _pairs(name: str, states: str) -> str:
    return f"""{name} as (
  select l[i] as a, l[i + 1] as b, sum(cnt)::bigint as n
  from (select cnt, {_symbol_list()} as l from {states}), unnest(range(1, len(l))) r(i)
  group by 1, 2)"""


def _merge_step(k: int) -> str:
    nxt = k + 1
    return f"""{_pairs(f"p{k}", f"w{k}")},
b{k} as materialized (
  select a, b, n, x.id as left_id, y.id as right_id
  from p{k} join ids{k} x on x.tok = a join ids{k} y on y.tok = b
  order by n desc, x.id, y.id limit 1),
ids{nxt} as materialized (
  select * from ids{k} union all select a || b, (select max(id) + 1 from ids{k}) from b{k}),
w{nxt} as materialized (
  select word, cnt, replace(s, {_OPEN} || a || {_CLOSE} || {_OPEN} || b || {_CLOSE},
                               {_OPEN} || a || b || {_CLOSE}) as s
  from w{k}, b{k})"""


def _learned(merges: int, extra_words: str | None = None) -> list[str]:
    """Tables up to ``w<merges>`` and ``ids<merges>``; extra words are split but not counted."""
    extra = f" union all {extra_words}" if extra_words else ""
    start = f"""ids0 as materialized (select tok, id from alpha),
w0 as materialized (
  select word, cnt, {_SYMBOLS} as s from (select word, cnt from counted{extra}))"""
    return [CHUNKS, WORDS, COUNTS, ALPHABET, start, *[_merge_step(k) for k in range(merges)]]


def _encoded(merges: int, words: str, keys: str, rows: str) -> str:
    """Ids and tokens of each row of ``rows``, by the final symbols of its words."""
    final = f"w{merges}"
    named = ", ".join(f"r.{k}" for k in keys.split(", "))
    return f"""symbols as (
  select word, unnest(l) as tok, unnest(range(len(l))) as j
  from (select word, {_symbol_list()} as l from {final})),
encoded as (
  select {named}, coalesce(list(coalesce(x.id, 0) order by w.word_idx, s.j)
                           filter (where s.tok is not null), []) as ids,
         coalesce(list(s.tok order by w.word_idx, s.j) filter (where s.tok is not null), []) as toks
  from {rows} r
  left join {words} w on {" and ".join(f"w.{k} = r.{k}" for k in keys.split(", "))}
  left join symbols s on s.word = w.word
  left join ids{merges} x on x.tok = s.tok
  group by {named})"""


def _text(ids: str) -> str:
    return f"array_to_string(list_transform({ids}, lambda q: q::varchar), ' ')"


def _fitted(ids: str, pad: int = 1) -> str:
    return f"({ids} || list_transform(range({LENGTH}), lambda z: {pad}))[1:{LENGTH}]"


LEARNED = _learned(LEARNED_MERGES)
ENCODED = [*LEARNED, _encoded(LEARNED_MERGES, "words", "doc_id, part_idx", "chunks")]
_MARKED = _fitted("[2::bigint] || ids || [3::bigint]")
_CODES = "list_transform(string_split(text, ''), lambda c: unicode(c))"
CODED = f"coded as (select doc_id, part_idx, {_fitted(_CODES)} as ids from chunks)"

# A list of merges with their ids, from the steps.
_MERGE_ROWS = "\nunion all ".join(
    f"select {k}::integer as rank, left_id::integer as left_id, right_id::integer as right_id, "
    f"(select max(id) from ids{k + 1})::integer as new_id from b{k}" for k in range(LEARNED_MERGES))

TRACE = """trace as (
  select day(ts)::integer - 1 as epoch,
         case when event_type in ('error', 'signup') then 'valid' else 'train' end as split,
         (user_id % 4)::integer as rank, event_id as batch_idx, value / 100 as loss, ts
  from events),
losses as (select epoch, split, sum(loss) / count(*) as loss from trace group by all),
durations as (
  select epoch, us // 60000000 as minutes, us // 1000000 % 60 as seconds
  from (select epoch, date_diff('microsecond', min(ts), max(ts)) as us from trace group by epoch))"""


def _histogram(source: str, by: str = "") -> str:
    """Length histogram of ``source(length)``, one for each value of ``by``."""
    key, of_bin = (f"{by}, ", f"b.{by}, ") if by else ("", "")
    same = f" and b.{by} = l.{by}" if by else ""
    lower, upper = "b.e[b.bin_idx + 1]", "b.e[b.bin_idx + 2]"
    return f"""ranges as (
  select {key}min(length) as mn, max(length) as mx, count(*) as total
  from {source} {f"group by {by}" if by else ""}),
edges as (
  select *, list_transform(range({BINS + 1}), lambda k: case when k = {BINS} then mx
    else trunc(k::double * ((mx::double - mn::double) / {BINS}) + mn::double)::bigint end) as e
  from ranges),
bins as (select *, unnest(range({BINS}))::integer as bin_idx from edges),
histogram as (
  select {of_bin}b.bin_idx, {lower} as lo, {upper} as hi,
         count(l.length) as cnt, count(l.length) / b.total * 100 as pct
  from bins b left join {source} l on l.length >= {lower}
    and (l.length < {upper} or (b.bin_idx = {BINS - 1} and l.length <= {upper})){same}
  group by {of_bin}b.bin_idx, b.e, b.total)"""


def _lengths(source: str) -> str:
    return f"lengths as (select length(text)::bigint as length from {source})"


ORACLES: dict[str, str] = {}


def _add(name: str, select: str, *tables: str) -> None:
    ORACLES[name] = (_with(*tables) + "\n" if tables else "") + select


# Sources and sinks
_add("scan_documents", "select doc_id, text, lang, source, n_chars from documents")
_add("scan_splits", "select split, doc_id, part_idx, text from labelled", CHUNKS, HASHED, SPLIT)
_add("scan_shard", "select doc_id, part_idx, text from sharded where split = 'test' and shard_id = 0",
     CHUNKS, HASHED, SPLIT, SHARDS)
_add("write_splits", "select split, doc_id, part_idx, text from labelled", CHUNKS, HASHED, SPLIT)
_add("named_shards", "select split, split || '_shard_' || shard_id || '.parquet' as file, doc_id, part_idx, text from sharded",
     CHUNKS, HASHED, SPLIT, SHARDS)
_add("shard_assign", f"""select doc_id, part_idx, pos,
  (ntile(ceil((select count(*) from chunks) / {SHARD_ROWS})::bigint) over (order by doc_id, part_idx)) - 1 as shard_id
from ordered""", CHUNKS, ORDERED)
_add("shard_sizes", "select split, shard_id, count(*) as n_rows from sharded group by all",
     CHUNKS, HASHED, SPLIT, SHARDS)
_add("text_corpus", "select unnest(string_split(text, chr(10))) as line from chunks", CHUNKS)
_add("text_lines", "select unnest(string_split(text, chr(10))) as line from documents")
_add("tokenizer_roundtrip", _MERGE_ROWS, *LEARNED)
_add("tokenized_write", f"""select split, shard_id, {_text(_MARKED)} as input_ids
from encoded join sharded using (doc_id, part_idx)""", *ENCODED, HASHED, SPLIT, SHARDS)
_add("materialize_reuse", "select doc_id, part_idx, text from chunks", CHUNKS)
_add("trace_write", "select epoch, split, rank, batch_idx, loss from trace", TRACE)

# Projections, filters, reshaping
_LINES = f"""lines as (
  select doc_id, unnest(l) as text, unnest(range(len(l)))::integer as part_idx
  from (select doc_id, string_split(text, chr(10)) as l from documents where length(text) > {HIGH}))"""
_add("text_length", "select doc_id, length(text)::integer as length from documents")
_add("drop_short", f"select doc_id from documents where length(text) >= {LOW}")
_add("keep_fitting", f"select doc_id, text from documents where length(text) between {LOW} and {HIGH}")
_add("newline_parts", "select doc_id, part_idx, text from lines", _LINES)
_add("chunk_over_long", f"select doc_id, part_idx, text from lines where length(text) between {LOW} and {HIGH}",
     _LINES)
_add("split_long_texts", "select doc_id, part_idx, text from chunks", CHUNKS)
_add("chunk_outcomes", f"""select outcome, count(*) as parts from (
  select case when length(part) < {LOW} then 'too_short' when length(part) > {HIGH} then 'too_long'
              else 'kept' end as outcome
  from (select unnest(case when length(text) <= {HIGH} then [text] else string_split(text, chr(10)) end) as part
        from documents)) group by outcome""")
_add("chunk_conversations", "select conv_id, turn, part_idx, text as utterance from said",
     _chunked("said", "conversations", "conv_id, turn"))

# Set operations
_add("flatten_splits", "select doc_id, part_idx, text from chunks", CHUNKS)
_add("combine_corpora", "select corpus, row_id, text from corpora", CORPORA)

# Profiles
_add("corpus_count", "select count(*) as n_rows from chunks", CHUNKS)
_add("length_range", """select min(length(text))::integer as min_length, max(length(text))::integer as max_length,
  count(*) as total from documents""")
_add("length_bin_edges", f"""select unnest(range({BINS + 1}))::integer as edge_idx, unnest(e) as edge from edges""",
     _lengths("documents"), _histogram("lengths"))
_add("length_histogram", "select bin_idx, lo, hi, cnt, pct from histogram",
     CHUNKS, _lengths("chunks"), _histogram("lengths"))
_add("length_report", """select -1 as bin_idx, 'Length distribution (total count: ' || sum(cnt)::bigint || '):' as line
from histogram union all select bin_idx, 'Length: ' || format('{:,}', lo) || ' - ' || format('{:,}', hi)
  || ', Counts: ' || format('{:,}', cnt) || ', Percentage: ' || format('{:.6f}', pct) || '%' as line
from histogram""", _lengths("documents"), _histogram("lengths"))
_add("null_texts", "select count(*) as n_rows, count(*) filter (where text is null) as null_texts from documents")
_add("corpus_summary", "select 'doc_id, text, lang, source, n_chars' as features, count(*) as num_rows from documents")
_add("stage_profile", "select stage, bin_idx, lo, hi, cnt, pct from histogram",
     CORPORA, _chunked("combined", "corpora", "corpus, row_id"), """staged as (
  select corpus || ' raw' as stage, length(text)::bigint as length from corpora
  union all select corpus || ' chunks', length(text) from combined
  union all select 'combined', length(text) from combined)""", _histogram("staged", "stage"))
ORACLES["ledger_profile"] = ORACLES["stage_profile"]

# Ordering, splitting
_add("train_test_split", "select doc_id, part_idx, split from labelled", CHUNKS, HASHED, SPLIT)
_add("split_sizes", "select split, count(*) as n_rows from labelled group by split", CHUNKS, HASHED, SPLIT)
_add("seeded_shuffle", """select doc_id, part_idx, row_number() over (order by h, doc_id, part_idx) - 1 as pos
from hashed""", CHUNKS, HASHED)
_add("batch_assign", f"select doc_id, part_idx, pos, pos // {FEED.batch_size} as batch_id from ordered",
     CHUNKS, ORDERED)
_add("epoch_order", "select doc_id, part_idx, pos from placed", CHUNKS, HASHED, RANKED)
_add("rank_shards", "select doc_id, part_idx, pos, rank::integer as rank, rank_pos from ranked",
     CHUNKS, HASHED, RANKED)
_add("rank_sizes", "select rank::integer as rank, count(*) as n_rows from ranked group by rank",
     CHUNKS, HASHED, RANKED)



def _network() -> str:
    """One pass of the keyed permutation over the numbers that are no positions yet."""
    state = "select pos, k, n, a, b, x // b as l, x % b as r from walk, size where k = 0 or x >= n"
    for k in range(ROUNDS):
        def added(digit: str) -> str:
            return f"('0x' || substr(md5('{CORPUS.seed}:{EPOCH}:{k}:' || {digit}), 1, {HASH_DIGITS}))::bigint"
        turned = f"l, (r + {added('l')}) % b as r" if k % 2 else f"(l + {added('r')}) % a as l, r"
        state = f"select pos, k, n, a, b, {turned} from ({state})"
    return state


_WALK = f"""dims as (select count(*) as n, ceil(sqrt(count(*)))::bigint as a from ordered),
size as (select n, a, (n + a - 1) // a as b from dims),
walk as (select pos, pos as x, 0 as k from ordered
  union all select pos, l * b + r, k + 1 from ({_network()}))"""
ORACLES["epoch_bijection"] = "with recursive " + ",\n".join([CHUNKS, ORDERED, _WALK]) + f"""
select doc_id, part_idx, pos, x as epoch_pos, (x % {WORLD_SIZE})::integer as rank, x // {WORLD_SIZE} // {FEED.batch_size} as batch_id
from walk join ordered using (pos), size where k > 0 and x < n"""

# Vocabulary
_add("pre_tokenize", "select doc_id, part_idx, word_idx, word from words", CHUNKS, WORDS)
_add("word_counts", "select word, cnt from counted", CHUNKS, WORDS, COUNTS)
_VOCAB = "select tok as token, id::integer as id, {} as special from {}"
_add("alphabet", _VOCAB.format("true", "specials") + " union all " + _VOCAB.format("false", "alpha"),
     CHUNKS, WORDS, COUNTS, ALPHABET, SPECIALS)
_add("pair_counts", "select a as left_token, b as right_token, n from p0",
     *_learned(0), _pairs("p0", "w0"))
_add("best_pairs", """select a as left_token, b as right_token, n
from p0 join ids0 x on x.tok = a join ids0 y on y.tok = b order by n desc, x.id, y.id limit 25""",
     *_learned(0), _pairs("p0", "w0"))
_add("first_merge", f"select word, cnt, array_to_string({_symbol_list()}, ' ') as symbols from w1", *_learned(1))
_add("bpe_merges", _MERGE_ROWS, *LEARNED)
_add("bpe_vocab", _VOCAB.format("true", "specials") + " union all "
     + _VOCAB.format("false", f"ids{LEARNED_MERGES}"), *LEARNED, SPECIALS)
_add("vocab_size", f"select count(*) + 4 as vocab_size from ids{LEARNED_MERGES}", *LEARNED)
_add("special_ids", "select tok as token, id::integer as id from specials", SPECIALS)

# Tokenizing and decoding
_add("wrap_markers", "select doc_id, part_idx, '[SOS]' || text || '[EOS]' as text from chunks", CHUNKS)
# Each marker becomes one private-use character, which stands for its id.
_add("special_literals", f"""select doc_id, part_idx, {_text("ids")} as ids from (
  select doc_id, part_idx, list(case when c in (chr(57344), chr(57345), chr(57346), chr(57347))
                                     then unicode(c) - 57344 else coalesce(id, 0) end order by j) as ids
  from (select doc_id, part_idx, unnest(l) as c, unnest(range(len(l))) as j
        from (select doc_id, part_idx, string_split(chr(57346) || replace(text, '. ', '.' || chr(57347) || ' ' || chr(57344))
                                                    || '[' || chr(57345) || ']', '') as l from chunks))
  left join alpha on tok = c
  where not regexp_full_match(c, '[{_SPACE_CLASS}]')
  group by doc_id, part_idx)""", CHUNKS, WORDS, COUNTS, ALPHABET)
_add("encode_corpus", f"select doc_id, part_idx, {_text('ids')} as ids from encoded", *ENCODED)
_add("encode_roundtrip", "select count(*) as n_rows, 0::bigint as mismatches from chunks", CHUNKS)
_add("unknown_chars", """select doc_id, part_idx, count(c)::integer as n_ids,
  count(c) filter (where id is null)::integer as n_unknown
from (select doc_id, part_idx, unnest(string_split(word, '')) as c from words) left join alpha on tok = c
group by doc_id, part_idx""", CHUNKS, WORDS, "english as (select * from documents where lang = 'en')",
     _chunked("english_chunks", "english", "doc_id"), _words("english_words", "english_chunks", "doc_id, part_idx"),
     _alphabet("alpha", "english_words"))
_add("pad_truncate", f"select doc_id, {_text(_fitted(_CODES))} as ids from documents")
_add("tokenize_corpus", f"select doc_id, part_idx, {_text(_MARKED)} as input_ids from encoded", *ENCODED)
_add("tokenize_chars", f"select doc_id, part_idx, {_text(_MARKED)} as input_ids from encoded",
     *_learned(0), _encoded(0, "words", "doc_id, part_idx", "chunks"))
_add("encode_prompts", f"select conv_id, turn, {_text('[2::bigint] || ids')} as ids from encoded",
     "prompts as (select * from conversations)",
     _words("prompt_words", "prompts", "conv_id, turn"),
     *_learned(LEARNED_MERGES, """select distinct word, 0 from prompt_words
                                  where word not in (select word from counted)"""),
     _encoded(LEARNED_MERGES, "prompt_words", "conv_id, turn", "prompts"))
_add("decode_corpus", "select doc_id, part_idx, array_to_string(toks, ' ') as decoded from encoded", *ENCODED)

# Training-data assembly
_add("next_token_pairs", f"""select doc_id, part_idx, {_text(f"ids[1:{LENGTH - 1}]")} as input,
  {_text(f"ids[2:{LENGTH}]")} as target from coded""", CHUNKS, CODED)
_add("token_pairs_flat", f"""select doc_id, part_idx, unnest(range({LENGTH - 1}))::integer as pos,
  unnest(ids[1:{LENGTH - 1}])::integer as input, unnest(ids[2:{LENGTH}])::integer as target from coded""",
     CHUNKS, CODED)
_add("loss_token_counts", f"""select pos // {FEED.batch_size} as batch_id, sum(length(text) - 1)::bigint as loss_tokens
from ordered group by 1""", CHUNKS, ORDERED)
_add("valid_lengths", f"""select doc_id, part_idx, length(text)::integer as valid_length,
  {_text("list_transform(ids, lambda i: (i <> 1)::integer)")} as mask
from coded join chunks using (doc_id, part_idx)""", CHUNKS, CODED)
_add("batch_matrix", f"""select pos // {FEED.batch_size} as batch_id,
  string_agg({_text("ids")}, '|' order by pos) as rows
from ordered join coded using (doc_id, part_idx) group by 1""", CHUNKS, ORDERED, CODED)
_add("rank_batches", f"""select rank::integer as rank, rank_pos // {FEED.batch_size} as batch_id,
  string_agg(doc_id || ':' || part_idx, ' ' order by rank_pos) as rows
from ranked group by 1, 2""", CHUNKS, HASHED, RANKED)
_FED = f"""fed as (
  select split, doc_id, part_idx, {_text(_MARKED)} as ids, md5('{CORPUS.seed}:{EPOCH}:' || doc_id || ':' || part_idx) as eh,
         count(*) over (partition by split) as n
  from encoded join labelled using (doc_id, part_idx))"""
_add("feed_batches", f"""select split, pos // {FEED.batch_size} as batch_id, string_agg(ids, '|' order by pos) as rows
from (select *, row_number() over (partition by split order by doc_id, part_idx) - 1 as pos from fed)
group by 1, 2""", *ENCODED, HASHED, SPLIT, _FED)
ORACLES["stream_batches"] = ORACLES["feed_batches"]
_add("feed_rank_batches", f"""select split, (slot % {WORLD_SIZE})::integer as rank,
  slot // {WORLD_SIZE} // {FEED.batch_size} as batch_id, string_agg(ids, '|' order by slot // {WORLD_SIZE}) as rows
from (select *, unnest(range(pos, (ceil(n / {WORLD_SIZE}) * {WORLD_SIZE})::bigint, n)) as slot
      from (select *, row_number() over (partition by split order by eh, doc_id, part_idx) - 1 as pos from fed))
group by 1, 2, 3""", *ENCODED, HASHED, SPLIT, _FED)
ORACLES["rank_files"] = ORACLES["feed_rank_batches"]
_add("finish_sequences", f"""select doc_id, {_text(f'''ids[1:{PROMPT_CHARS}] || {_fitted(
    f"(case when stop > 0 then generated[1:stop - 1] else generated end)[1:{LENGTH - PROMPT_CHARS - 1}]"
)}[1:{LENGTH} - len(ids[1:{PROMPT_CHARS}])]''')} as ids
from (select *, coalesce(list_position(generated, 3), 0) as stop
      from (select *, ids[{PROMPT_CHARS + 1}:] as generated
            from (select doc_id, list_transform(string_split(text, ''),
                                                lambda c: case when c = '.' then 3 else unicode(c) end) as ids
                  from documents)))""")

# Traces
_add("epoch_loss", "select epoch, split, round(loss, 6) as loss from losses", TRACE)
_add("epoch_perplexity", "select epoch, split, round(loss, 6) as loss, round(exp(loss), 6) as perplexity from losses",
     TRACE)
_add("best_epochs", """select epoch, round(loss, 6) as loss from (
  select *, min(loss) over (order by epoch rows between unbounded preceding and 1 preceding) as before
  from losses where split = 'valid' and not isnan(loss) and loss < 'inf'::double)
where before is null or loss < before""", TRACE)
ORACLES["stream_best_epochs"] = ORACLES["best_epochs"]
_add("epoch_duration", "select epoch, minutes, seconds from durations", TRACE)
_add("loss_history", """select split, (epoch // 1000)::bigint as page,
  string_agg(printf('%.6f', round(loss, 6)), ' ' order by epoch) as losses from losses group by 1, 2""", TRACE)
_add("sample_trace", """select conv_id as prompt_id, prompt, place // 1000 as page,
  string_agg(text, chr(10) || '--' || chr(10) order by place) as generated
from (select s.conv_id, p.text as prompt, s.text,
             row_number() over (partition by s.conv_id, p.text order by s.turn, s.text) - 1 as place
      from conversations s join conversations p on p.conv_id = s.conv_id and p.turn = 0
      where s.role = 'assistant') group by 1, 2, 3""")
_add("epoch_report", f"""select epoch,
  'Epoch: ' || lpad((epoch + 1)::varchar, 2, '0') || '/{FEED.epochs}, ' || minutes || 'm ' || seconds || 's ::'
  || 'Train Loss: ' || printf('%-8.4f', t) || ', Train PPL: ' || printf('%-8.4f', exp(t))
  || ' | Valid Loss: ' || printf('%-8.4f', v) || ', Valid PPL: ' || printf('%-8.4f', exp(v)) as line,
  'epoch-' || lpad(epoch::varchar, 2, '0') || '-valid_loss-' || printf('%07.4f', v) || '.pt' as checkpoint
from (select epoch, max(loss) filter (where split = 'train') as t, max(loss) filter (where split = 'valid') as v
      from losses group by epoch) join durations using (epoch)""", TRACE)

# Streams: the same rows as in batch
_add("stream_chunk", ORACLES["split_long_texts"])
_add("stream_tokenize", ORACLES["tokenize_corpus"])
_add("stream_word_counts", ORACLES["word_counts"])

# User functions
_add("map_batches", ORACLES["text_length"])
_add("flat_map_batches", "select doc_id, text from chunks", CHUNKS)

_add("table_function", "select doc_id, part_idx, text from chunks", CHUNKS)
_add("table_function_groups", f"""select doc_id, lang, pos // {FEED.batch_size} as batch_id, (pos % {FEED.batch_size})::integer as place
from (select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 as pos from documents)""")
