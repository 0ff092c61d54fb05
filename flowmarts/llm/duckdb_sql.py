"""DuckDB SQL that the corpus queries are compared with."""

# One common table expression for words: runs of other characters than space and \x09 to \x0D.
WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""
with t as (select doc_id, sha256({LOWER}) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by text_sha256)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from t join g using (text_sha256)
"""

# The CRC goes byte by byte over the hex digits, with the table of the reflected polynomial 0xEDB88320.
SHARDS = """
with recursive bits as (
  select i, i as v, 0 as k from range(256) r(i)
  union all
  select i, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end, k + 1 from bits where k < 8),
crc as (select list(v order by i) as tab from bits where k = 8),
d as (
  select doc_id, source as stratum, strlen(coalesce(text, '')) + 1 as size,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda x: ('0x' || x)::bigint)), lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1])), 4294967295) as text_crc32
  from documents, crc),
e as (select *, md5('17|' || coalesce(doc_id::varchar, '') || '|' || text_crc32 || '|' || size) as shuffled from d),
r as (
  select *, row_number() over (partition by stratum order by shuffled, doc_id nulls first, text_crc32, size) - 1 as k,
    count(*) over (partition by stratum) as n, count(*) over () as total from e),
p as (select *, row_number() over (order by (2 * k + 1) / (2 * n), stratum nulls first, shuffled, doc_id nulls first, text_crc32, size) - 1 as pos from r)
select doc_id, size, text_crc32, 'rows' as law, (pos * 8 // total)::int as shard,
  pos - ((pos * 8 // total) * total + 7) // 8 as slot, null::int as grown_shard, stratum
from p
"""

MIX = """
with s as (select source, count(*) as n, sqrt(count(*)::double) as weight from documents group by source),
t as (select sum(weight) as total, sum(n) as rows from s),
r as (select source, weight * rows::double / (total * n) as rate from s, t),
d as (
  select documents.*, rate, md5('29|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))) as digest
  from documents join r on documents.source is not distinct from r.source),
u as (select *, (('0x' || substr(digest, 1, 8))::bigint::double * 1048576 + ('0x' || substr(digest, 9, 5))::bigint::double) / 4503599627370496 as u from d),
k as (
  select *, list_reduce(range(1, ceil(rate + 12 * sqrt(rate) + 30)::bigint + 1)::double[],
    lambda a, i: case when a[2] > u then a else [a[1] * rate / i, a[2] + a[1] * rate / i, i] end,
    [exp(-rate), exp(-rate), 0.0]) as state from u),
c as (select * exclude (state), state[3]::int as copies from k)
select doc_id, text, lang, source, n_chars, copies, copy::int as copy, md5('29|' || digest || '|' || copy) as mix_key
from (select *, unnest(range(1, copies + 1)) as copy from c)
"""

# {docs}: the table judged; the result has its columns and the verdict.
QUALITY = """
with d as (
  select row_number() over () as rid, t.*, WORDS_OF as w, string_split(coalesce(text, ''), chr(10)) as ls from {docs} t),
l as (
  select rid, source, coalesce(text, '') as document, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as k from d),
n as (
  select *, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm from l),
h as (select source, count(distinct coalesce(text, '')) as n from d group by source),
f as (
  select c.source, norm from (select source, norm, count(distinct document) as docs from n where norm <> '' group by source, norm) c
  join h on c.source is not distinct from h.source where docs >= 20 and docs * 100 >= n * 10),
m as (select n.*, f.norm is not null as furniture from n left join f on n.source is not distinct from f.source and n.norm = f.norm),
r as (
  select rid, sum(case when furniture then len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) else 0 end)::bigint as lost,
    coalesce(string_agg(line, chr(10) order by k) filter (where not furniture), '') as clean, bool_or(furniture) as changed,
    count(*) filter (where norm <> '') - count(distinct line) filter (where norm <> '') as dup
  from m group by rid),
g as (select rid, unnest(range(1, len(w) - 1)) as p, w from d where len(w) >= 3),
q as (select rid, p, count(*) over (partition by rid, w[p], w[p + 1], w[p + 2]) as times from g),
c as (select rid, count(distinct p + k) as covered from q, range(3) o(k) where times > 1 group by rid),
v as (
  select d.*, len(w)::bigint as n_words, length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    dup::bigint as n_dup_lines, coalesce(covered, 0)::bigint as n_repeat_words, lost as n_removed_words, clean, changed
  from d join r using (rid) left join c using (rid)),
j as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from v),
judged as (select *, not base_failed and 100 * n_removed_words <= 50 * n_words as kept from j)
""".replace("WORDS_OF", WORDS)

LINES = QUALITY.replace("{docs}", "documents") + """
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed_words from judged
"""

SQL = {"op3_line_frequency": LINES, "op7_poisson_mix": MIX, "op8_stratified_shards": SHARDS, "op9_chunk_recipes": EXACT}
