"""DuckDB text of the operators that SQL can express: another way to the same rows, without the operators' own steps."""

# ---- op3: rules and an exact lookup, no filter

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_FILTER = rf"""
with parts as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end as rest from pages),
split as (
  select page_id, rest, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|\z)'))) as args
  from parts),
named as (
  select page_id, host, path, case when rest is not null then
      regexp_replace(regexp_replace(host, '^.*@|:[0-9]*\z', '', 'g'), '^(www\.|m\.)', '') || regexp_replace(path, '/\z', '')
      || case when len(args) > 0 then '?' || array_to_string(args, '&') else '' end end as canonical,
    case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
         when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
         when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
         when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
         when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
  from split),
known as (select distinct canonical as c from named where regexp_matches(host, 'adult|bets|casino|pills|spam|ads-track') and canonical is not null)
select page_id, host, path, rule,
  case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
       when c is not null then 'block' else 'allow' end as verdict,
  canonical, c is not null as listed
from named left join known on c = canonical
"""

# ---- op6: highest quotients by ranking all of them, and one running sum for each source

MIXING = r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
    cast('0x' || substr(md5('5:' || coalesce(cast(doc_id as varchar), '-')), 1, 15) as bigint) as turn from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source is null, source) - 1 as rank from docs group by source),
weighted as (select *, [3, 1, 2][rank % 3 + 1] as weight, 2 * source_size as cap from sources),
levels as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over filled, 0)) / (sum(weight) over () - coalesce(sum(weight) over filled, 0)) as level,
    cap / weight as full_at from weighted window filled as (order by cap / weight, rank rows between unbounded preceding and 1 preceding)),
opened as (select *, (select arg_min(level, (full_at, rank)) from levels where level < full_at) as open_level from levels),
targets as (
  select source, rank, source_size, cast(case when level >= full_at then cap else weight * open_level end as double) as target from opened),
sized as (select *, greatest(1, least(64, floor((select min(target) from targets where target > 0) / 64)))::bigint as block from targets),
counted as (
  select *, ceil(source_size / block)::bigint as blocks, round(sum(target) over () / block)::bigint as seats from sized),
quotients as (
  select rank, target / (2 * step + 1) as quotient, step, seats
  from (select rank, target, seats, unnest(generate_series(0, cast(2 * target / block + 9 as bigint))) as step from counted where target > 0)),
won as (
  select rank, count(*) as quota from (select rank, seats, row_number() over (order by quotient desc, rank, step) as place from quotients)
  where place <= seats group by rank),
plan as (
  select c.*, least(coalesce(quota, 0), 2 * blocks) as quota, 2147483647 % greatest(blocks, 1) as stride,
    cast('0x' || substr(md5('5:rank ' || cast(rank as varchar)), 1, 15) as bigint) % greatest(blocks, 1) as first
  from counted c left join won using (rank)),
streamed as (
  select d.*, p.* exclude (source), coalesce(sum(size) over (partition by d.source order by turn, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from docs d join plan p on p.source is not distinct from d.source),
cut as (
  select doc_id, least(start + size, (b + 1) * block) - greatest(start, b * block) as words,
    greatest(0, (quota - (stride * b + first) % blocks + blocks - 1) // blocks) as times
  from (select *, unnest(generate_series(start // block, (start + size - 1) // block)) as b from streamed where size > 0)),
taken as (select doc_id, sum(words * times) as taken from cut group by doc_id)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken, source from streamed left join taken using (doc_id)
"""

# ---- op12: every phrase of every piece, counted one by one

COLLOCATIONS = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\n\x0B\f\r]')) as piece from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, 1 as k, unnest(w) as phrase from words
  union all select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words
  union all select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from words),
counted as (select lang, k, phrase, count(*) as c from grams group by all),
candidates as (select *, string_split(phrase, ' ') as w from counted where k > 1 and c >= 10),
cuts as (
  select *, 1 as j, w[1] as first, array_to_string(w[2 : k], ' ') as rest from candidates
  union all select *, 2, array_to_string(w[1 : 2], ' '), w[3] from candidates where k = 3),
scored as (
  select x.*, f.c as l, t.c as r, (1000000::hugeint * x.c * x.c) // (f.c::hugeint * t.c) as score
  from cuts x join counted f on f.lang = x.lang and f.phrase = first join counted t on t.lang = x.lang and t.phrase = rest),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (
  select lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) as part, c as longer from candidates where k = 3),
kept as (
  select * from lowest x where not exists (
    select 1 from inside i where i.lang = x.lang and i.part = x.phrase and x.k = 2 and 100 * i.longer >= 50 * x.c)),
ranked as (select *, row_number() over (partition by lang order by score desc, c desc, phrase) as rank from kept qualify rank <= 2000),
totals as (select lang, sum(c) as n from counted where k = 1 group by lang)
select lang, rank, phrase, c as a, l, r, n::bigint as n, score::bigint as score from ranked join totals using (lang)
"""

# ---- op11: running sums over whole conversations, windows one after the other by recursion

CHAT_WINDOWS = r"""
with recursive given as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, t, case t when 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) r(t)),
written as (
  select *, '<s>' || coalesce(role, '?') || chr(10)
    || regexp_replace(text, '(<|\[)(\\*)(s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])', '\1\2\\\3', 'g') || '</s>' || chr(10) as piece from given),
lined as (
  select *, ceil(strlen(piece) / 4)::bigint as cost, length(piece) as chars,
    coalesce(sum(ceil(strlen(piece) / 4)::bigint) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from written),
turns as (select *, start // 65536 as block, role = 'system' and start = 0 as first from lined),
rooms as (select conv_id, greatest(2048 - 256 - coalesce(sum(cost) filter (first), 0), 512) as room from turns group by conv_id),
windows as (
  select conv_id, block, min(start) as opened from turns group by conv_id, block
  union all
  select w.conv_id, w.block, min(t.start) from windows w join turns t on t.conv_id is not distinct from w.conv_id and t.block = w.block
    join rooms r on r.conv_id is not distinct from w.conv_id
  where t.start > w.opened and t.start + t.cost - w.opened > r.room group by w.conv_id, w.block),
repeated as (
  select w.conv_id, sum(t.chars) as chars from windows w join turns t on t.conv_id is not distinct from w.conv_id
  where t.start < w.opened and (t.first or t.start >= w.opened - 256) group by w.conv_id)
select t.conv_id, count(*) as n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(t.chars) + coalesce(any_value(r.chars), 0))::bigint as formatted_chars
from turns t left join repeated r on r.conv_id is not distinct from t.conv_id group by t.conv_id
"""
