"""The queries' results in SQL that DuckDB runs on the same tables."""

WORDS = r"length(regexp_replace(regexp_replace(coalesce({t}, ''), '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]', '', 'g'))"

OP8 = (
    """
with recursive sized as (
  select doc_id, source, """
    + WORDS.format(t="text")
    + """::bigint as size from documents),
sums as (
  select source, sum(size)::bigint as source_size,
    [1, 2, 3][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::bigint as w
  from sized group by source),
-- the sources that stop are those of the smallest size to weight
ranked as (
  select *, source_size / w as ratio, sum(source_size) over () as total,
    coalesce(sum(3 * source_size) over (order by source_size / w range between unbounded preceding and current row exclude group), 0) as full_before,
    sum(w) over () - coalesce(sum(w) over (order by source_size / w range between unbounded preceding and current row exclude group), 0) as free
  from sums),
level as (
  select max(ratio) as stop from ranked where w * (total - full_before)::double / free::double > 3 * source_size),
shared as (
  select r.*, coalesce(r.ratio <= level.stop, false) as is_full from ranked r, level),
targets as (
  select source, source_size,
    (case when is_full then 3 * source_size else
      w * (total - coalesce(sum(case when is_full then 3 * source_size else 0 end) over (), 0))::double
        / (sum(case when is_full then 0 else w end) over ())::double end)::double as target
  from shared),
rates as (
  select *, case when source_size > 0 then least(round(target / source_size, 9), 3.0) else 0.0 end as rate from targets),
counted as (
  select s.doc_id, s.source, s.size, r.source_size, r.target, r.rate,
    row_number() over (partition by s.source order by s.size desc, s.doc_id) as k
  from sized s join rates r on s.source is not distinct from r.source),
first as (
  select doc_id, source, size, source_size, target,
    (floor(rate) + floor((rate - floor(rate)) * k + 0.4142135623)
      - floor((rate - floor(rate)) * (k - 1) + 0.4142135623))::bigint as copies
  from counted),
short as (
  select source, any_value(target) - sum(copies * size) as short from first group by source),
candidates as (
  select source, short, octave, arg_min(size, doc_id) as size, min(doc_id) as doc_id from (
    select f.*, short.short,
      length(bin(size)) * 2 + case when substring(bin(size), 2, 1) = '1' then 1 else 0 end as octave
    from first f join short on f.source is not distinct from short.source
    where size > 0 and case when short.short > 0 then copies < 3 else copies > 0 end)
  group by source, short, octave),
numbered as (
  select *, row_number() over (partition by source order by size desc, doc_id) as n from candidates),
fold as (
  select source, 0::bigint as n, abs(short) as missing, null::bigint as picked from short
  union all
  select c.source, c.n, case when c.size <= f.missing then f.missing - c.size else f.missing end,
    case when c.size <= f.missing then c.doc_id end
  from fold f join numbered c on c.source is not distinct from f.source and c.n = f.n + 1),
picked as (
  select f.source, f.picked, case when s.short > 0 then 1 else -1 end as more
  from fold f join short s on f.source is not distinct from s.source where f.picked is not null)
select f.doc_id, f.size, f.source_size, f.target, f.copies + coalesce(p.more, 0) as copies,
  (f.copies + coalesce(p.more, 0)) * f.size as taken
from first f left join picked p on p.source is not distinct from f.source and p.picked = f.doc_id
"""
)

_RULES = """
  select * from (values
    ('symbols', 1, [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0]::double[]),
    ('long_words', 1, [5.5, 6.0, 6.5, 7.0, 8.0, 10.0, 12.0]::double[]),
    ('short_words', -1, [4.0, 3.5, 3.0, 2.5, 2.0]::double[]),
    ('dup_lines', 1, [0.1, 0.2, 0.3, 0.5]::double[]),
    ('repeats', 1, [0.05, 0.1, 0.15]::double[])) r(rule, sign, cutoffs)
"""

OP9 = (
    r"""
with texts as (
  select row_number() over () as r, doc_id, lang, coalesce(text, '') as text from documents),
words as (
  select r, unnest(list) as word, generate_subscripts(list, 1) as pos
  from (select r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as list from texts)),
windows as (
  select r, pos, case when lead(word, 4) over w is not null then concat_ws(' ', word, lead(word, 1) over w,
    lead(word, 2) over w, lead(word, 3) over w, lead(word, 4) over w) end as five
  from words window w as (partition by r order by pos)),
twice as (
  select r, pos from (select r, pos, five, count(*) over (partition by r, five) as n from windows where five is not null) where n > 1),
covered as (
  select r, sum(least(5, coalesce(pos - before, 5)))::bigint as n
  from (select r, pos, lag(pos) over (partition by r order by pos) as before from twice) group by r),
lines as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup from (
    select r, unnest(string_split(text, chr(10))) as line from texts)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
counted as (select r, count(*) as n_words, sum(length(word))::bigint as word_chars from words group by r),
figures as (
  select t.doc_id, t.lang as stratum, coalesce(c.n_words, 0)::bigint as n_words, coalesce(c.word_chars, 0)::bigint as word_chars,
    length(regexp_replace(t.text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(l.n_lines, 0)::bigint as n_lines,
    coalesce(l.n_dup, 0)::bigint as n_dup_lines, coalesce(v.n, 0)::bigint as n_repeat_words
  from texts t left join counted c using (r) left join lines l using (r) left join covered v using (r)),
judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    map {'symbols': n_symbols / nullif(n_words, 0), 'long_words': word_chars / nullif(n_words, 0),
      'short_words': word_chars / nullif(n_words, 0), 'dup_lines': n_dup_lines / nullif(n_lines, 0),
      'repeats': n_repeat_words / nullif(n_words, 0)} as ratios
  from figures),
good as (select doc_id, max(quality) = 1 as good from labels where quality is not null group by doc_id),
rules as ("""
    + _RULES
    + """),
tests as (select rule, sign, unnest(cutoffs) as cutoff, generate_subscripts(cutoffs, 1) as leniency from rules),
counts as (
  select j.stratum, t.rule, t.sign, t.cutoff, t.leniency, count(*) filter (g.good) as n,
    count(*) filter (g.good and coalesce((j.ratios[t.rule] - t.cutoff) * t.sign > 0, false)) as k,
    count(*) filter (not g.good and coalesce((j.ratios[t.rule] - t.cutoff) * t.sign > 0, false)) as bad
  from judged j join good g using (doc_id), tests t where not j.base_failed group by all),
tails as (
  select *, case when k >= n * 0.01 then 1.0 else (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln(0.01::double) + (n - i) * ln(0.99::double))) from range(0, k + 1) x(i)) end as tail
  from counts),
chosen as (
  select stratum, rule, sign, arg_max(cutoff, (bad - k) * 1000 + leniency) as cutoff from tails
  where bad > k and tail <= 0.05 / ((select count(*) from (select distinct stratum from counts)) * (select count(*) from tests))
  group by all),
rejected as (
  select j.doc_id, j.stratum, j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed,
    exists (select 1 from chosen c where c.stratum is not distinct from j.stratum
      and (j.ratios[c.rule] - c.cutoff) * c.sign > 0) as hit
  from judged j)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not hit as kept
from rejected
"""
)

OP12 = """
with payloads as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as n from pages),
kept as (
  select *, n >= 1000 and page_id <> max(page_id) over (partition by html) as is_copy,
    max(page_id) over (partition by html) as largest from payloads)
select page_id, n as payload_bytes, sha1(html) as payload_digest,
  case when is_copy then 'revisit' else 'response' end as record_type,
  case when is_copy then largest end as refers_to
from kept
"""

# crc32 of a text of ASCII characters, bit by bit: -1 stands for a step, other numbers are taken in
CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split({x}, ''),"
    " lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),"
    " lambda crc, b: case when b >= 0 then xor(crc, b) else xor(crc >> 1, (crc & 1) * 3988292384) end))"
)

OP13 = (
    """
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as pos,
    coalesce(role, '') as role, coalesce(text, '') as text from conversations),
sizes as (select conv_id, count(*) as n from turns group by conv_id),
plan as (
  select c.conv_id, c.h, c.base, least(c.h, coalesce(s.n, 0)) as lent
  from (select conv_id, conv_id - conv_id % 100 as base, """
    + CRC32.format(x="conv_id::varchar")
    + """ % 6 as h from sizes) c
    left join sizes s on s.conv_id = c.base),
rebuilt as (
  select p.conv_id, t.pos + 1 as depth, t.role, t.text from plan p join turns t on t.conv_id = p.base and t.pos < p.lent
  union all
  select p.conv_id, p.lent + t.pos - p.h + 1, t.role, t.text from plan p join turns t on t.conv_id = p.conv_id and t.pos >= p.h
  union all
  select conv_id, 0, '', '' from plan),
paths as (
  select conv_id, depth, length(text) as chars,
    sha256(string_agg(strlen(role) || ',' || strlen(text) || ',' || role || text, '') over (partition by conv_id order by depth)) as name
  from rebuilt),
members as (
  select *, lag(name) over (partition by conv_id order by depth) as parent, max(depth) over (partition by conv_id) as most from paths),
nodes as (
  select depth, name, any_value(parent) as parent, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = most), '') as ends
  from members group by depth, name),
kids as (select depth - 1 as depth, parent as name, count(*) as n from nodes where depth > 0 group by all),
full_nodes as (
  select n.*, coalesce(k.n, 0) as n_children, (n.n_convs - 1) * n.chars as saved
  from nodes n left join kids k using (depth, name)),
-- every node with each of its ancestors, itself among them
totals as (
  select m.depth, m.name, sum(y.saved) as saved, count(*) filter (y.n_children = 0) as leaves
  from full_nodes y join members m on m.conv_id = y.conv_id and m.depth <= y.depth group by m.depth, m.name)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children::bigint as n_children,
  t.leaves::bigint as n_leaves, t.saved::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from full_nodes n join totals t using (depth, name)
  left join nodes p on p.depth = n.depth - 1 and p.name = n.parent
"""
)
