"""DuckDB SQL for the queries that SQL can express."""

import string

from fleetgrid.llm.quality import FLAGGED_WORDS

_SPACES = r"[\x20\x09-\x0D]"
_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"


_LINE_DEDUP = f"""
with lines as (
  select doc_id, unnest(split) as line, generate_subscripts(split, 1) as position
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as split from documents)),
keyed as (select *, {_lower(f"trim(line, {_BLANKS})")} as key from lines),
shared as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5),
marked as (
  select k.*, s.key is not null and k.doc_id <> s.keeper as dropped
  from keyed k left join shared s on k.key = s.key)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by position) filter (not dropped), ''))
    as kept_sha256
from marked group by doc_id"""

_BENCHMARK_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_DECONTAMINATION = f"""
with texts as (
  select doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_BENCHMARK_WORDS}') as words
  from documents),
items as (
  select item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_BENCHMARK_WORDS}') as words
  from benchmark),
windows as (
  select item_id, words[i:i + 12] as w
  from (select *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) as i
        from items where len(words) > 0)),
sizes as (select distinct len(w) as size from windows),
places as (
  select doc_id, i, words[i:i + size - 1] as w
  from (select *, unnest(range(1, len(words) - size + 2)) as i
        from texts, sizes where len(words) >= size)),
hits as (
  select p.doc_id, p.i, len(p.w) as size, b.item_id from places p join windows b on p.w = b.w),
covered as (
  select doc_id, count(distinct position) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as position from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select t.doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from texts t left join covered c on t.doc_id = c.doc_id left join found f on t.doc_id = f.doc_id"""

_FLAGGED = ", ".join(f"'{x}'" for x in FLAGGED_WORDS)
_N_LINES = "len(lines)"
_REJECTED = f"""
  10 * n_symbols > n_words
  or word_chars < 3 * n_words
  or word_chars > 10 * n_words
  or 2 * n_dup_lines > {_N_LINES}
  or 2 * length(regexp_replace(body, '[^A-Z]', '', 'g'))
    > length(regexp_replace(body, '[^A-Za-z]', '', 'g'))
  or 10 * len(list_filter(words, lambda x: regexp_matches(x, '\\p{{L}}'))) < 8 * n_words
  or 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…){_SPACES}*$')))
    > 3 * {_N_LINES}
  or 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^{_SPACES}*[-*•]')))
    > 9 * {_N_LINES}
  or len(list_filter(string_split_regex({_lower("body")}, '[^a-z]+'), lambda x: x in ({_FLAGGED})))
    >= 2"""

_QUALITY = f"""
with texts as (
  select doc_id, coalesce(text, '') as body, {_words("text")} as words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
windows as (
  select doc_id, unnest(range(1, len(words) - 1)) as i, words from texts),
keyed as (select doc_id, i, [words[i], words[i + 1], words[i + 2]] as w from windows),
twice as (
  select doc_id, i from keyed
  qualify count(*) over (partition by doc_id, w) >= 2),
repeated as (
  select doc_id, count(distinct position) as n
  from (select doc_id, unnest([i, i + 1, i + 2]) as position from twice) group by doc_id),
counted as (
  select t.*, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(r.n, 0) as n_repeat_words
  from texts t left join repeated r on t.doc_id = r.doc_id),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or ({_REJECTED})) as kept
from judged"""

_TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

_SEARCH = f"""
with texts as (
  select row_number() over () as doc, doc_id,
    regexp_extract_all({_lower("coalesce(text, '')")}, '{_TERMS}') as terms from documents),
items as (
  select row_number() over () as item, item_id,
    list_distinct(regexp_extract_all({_lower("coalesce(text, '')")}, '{_TERMS}')) as terms
  from benchmark),
asked as (select item, unnest(terms) as term from items),
sizes as (
  select count(*) as docs, cast(sum(len(terms)) as bigint) as length
  from texts where len(terms) > 0),
held as (
  select doc, term, count(*) as tf
  from (select doc, unnest(terms) as term from texts)
  where term in (select term from asked) group by doc, term),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double)
    / cast(2 * count(*) + 1 as double))) as bigint) as w
  from held, sizes group by term),
damped as (
  select doc, doc_id, 50 + (50 * len(terms) * docs) // length as m
  from texts, sizes where len(terms) > 0),
scored as (
  select item, h.doc, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
  from asked a join held h on a.term = h.term join weights x on x.term = h.term
    join damped d on d.doc = h.doc
  group by item, h.doc),
ranked as (
  select item, doc_id, score,
    row_number() over (partition by item order by score desc, doc_id) as rank
  from scored s join texts t on s.doc = t.doc where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score
from ranked r join items i on r.item = i.item where rank <= 50"""

# The crc32 of a text of ASCII characters, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(cast(conv_id as varchar), ''),
    lambda x: [cast(ascii(x) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: case when x >= 0 then xor(c, x)
    when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end), 4294967295)"""

_TRIE = f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first) - 1 as pos
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 20 as base, {_CRC32} % 4 as h, n
  from (select conv_id, count(*) as n from turns group by conv_id)),
rebuilt as (
  select c.conv_id, t.pos as place, role, text
  from convs c join turns t on t.conv_id = c.base and t.pos < c.h
  union all
  select c.conv_id, t.pos + c.h as place, role, text
  from convs c join turns t on t.conv_id = c.conv_id and t.pos >= c.h),
placed as (
  select conv_id, row_number() over (partition by conv_id order by place) as depth,
    sha256(concat(role, chr(1), text)) as turn, {_words("text")} as words
  from rebuilt),
paths as (
  select conv_id, depth, len(words) as words,
    sha256(string_agg(turn, '') over (partition by conv_id order by depth)) as node
  from placed
  union all select conv_id, 0, 0, 'root' from convs),
lengths as (select conv_id, max(depth) as length from paths group by conv_id),
nodes as (
  select node, p.depth, min(p.conv_id) as conv_id, count(*) as n_convs, max(words) as words,
    sha256(coalesce(string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id)
      filter (length = p.depth), '')) as ends_sha256
  from paths p join lengths l on p.conv_id = l.conv_id group by node, p.depth),
parents as (
  select n.node, p.node as parent
  from nodes n join paths p on p.conv_id = n.conv_id and p.depth = n.depth - 1),
children as (select parent, count(*) as n_children from parents group by parent),
weighed as (
  select n.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * words as saved
  from nodes n left join children c on n.node = c.parent),
below as (
  select p.node, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens
  from weighed w join paths p on p.conv_id = w.conv_id and p.depth <= w.depth group by p.node)
select w.conv_id, w.depth, u.conv_id as parent_conv_id, w.n_convs, w.n_children, n_leaves,
  cast(saved_tokens as bigint) as saved_tokens, w.ends_sha256
from weighed w join below b on w.node = b.node left join parents p on w.node = p.node
  left join nodes u on p.parent = u.node"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": _LINE_DEDUP,
    "op4_decontamination": _DECONTAMINATION,
    "op10_quality_rules": _QUALITY,
    "op12_lexical_search": _SEARCH,
    "op13_prefix_trie": _TRIE,
}
