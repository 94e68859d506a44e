"""DuckDB SQL for those operator queries that SQL can express on whole tables."""

#: A word of the contracts, as a DuckDB pattern.
_WORD = r"[^\x20\x09-\x0D]+"

OP1_WARC = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
h as (select page_id, octet_length(payload) as payload_bytes, sha1(payload) as hex from p),
b as (select page_id, payload_bytes, hex,
        [cast(concat('0x', substr(hex, 5 * g + 1, 5)) as integer) for g in range(8)] as groups from h),
d as (select page_id, payload_bytes,
        array_to_string(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> (15 - 5 * k)) & 31) + 1, 1)
                                  for k in range(4)] for v in groups]), '') as payload_digest from b),
r as (select *, max(page_id) over (partition by payload_digest) as target from d)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when page_id = target then 'response' else 'revisit' end as record_type,
  case when page_id = target then null else target end as refers_to
from r
"""

OP3_MIXING = rf"""
with docs as (select doc_id, source, case when source is null then 'n' else 's' || source end as skey,
    cast(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as bigint) as size from documents),
units as (select doc_id, skey, size, count(*) as copies, size * count(*) as words from docs group by 1, 2, 3),
src as (select skey, cast(sum(words) as bigint) as source_size from units group by 1),
weighed as (select *, cast([3, 1, 2][(row_number() over (order by skey = 'n', skey) - 1) % 3 + 1] as double) as weight,
    2.0::double * source_size as cap from src),
-- in order of cap / weight the clamped sources come first; a source is clamped if even the level without it is above its cap
ranked as (select *, 1.5::double * sum(source_size) over () - coalesce(sum(cap) over w, 0) as rest,
    sum(weight) over (order by cap / weight desc, skey desc) as weights from weighed
    window w as (order by cap / weight, skey rows between unbounded preceding and 1 preceding)),
judged as (select *, cap < weight * (rest / weights) as clamped from ranked),
lvl as (select (1.5::double * max(total) - sum(case when clamped then cap else 0 end))
      / sum(case when clamped then 0 else weight end) as level
    from judged, (select cast(sum(source_size) as double) as total from src)),
filled as (select skey, source_size, case when cap < weight * level then cap else weight * level end as target from judged, lvl),
parts as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from filled),
placed as (select u.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size as left_words,
    md5('7:' || coalesce(cast(u.doc_id as varchar), 'null')) as key from units u join parts p using (skey)),
started as (select *, coalesce(sum(words) over (partition by skey order by key, doc_id, size
    rows between unbounded preceding and 1 preceding), 0) as start from placed),
picked as (select *, words > 0 and start + words / 2.0::double <= left_words as taken_once from started),
rests as (select skey, max(left_words) - sum(case when taken_once then words else 0 end) as rest from picked group by 1),
swaps as (select skey, arg_min(struct_pack(key := key, start := start),
      struct_pack(near := abs(words - abs(rest)), key := key, start := start)) as s
    from picked join rests using (skey)
    where words > 0 and taken_once = (rest < 0) and abs(words - abs(rest)) < abs(rest) and left_words > 0 group by 1),
final as (select p.*, whole + cast(taken_once != (s.skey is not null and p.words > 0) as bigint) as reps
    from picked p left join swaps s on p.skey = s.skey and p.key = s.s.key and p.start = s.s.start)
select d.doc_id, d.size, f.source_size, f.target, d.size * f.reps as taken
from docs d join final f on d.skey = f.skey and d.size = f.size and d.doc_id is not distinct from f.doc_id
"""

OP4_QUALITY = rf"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, regexp_extract_all(text, '{_WORD}') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines from t),
m as (select doc_id, words, len(words) as n_words, len(array_to_string(words, '')) as word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, len(lines) as n_lines from w),
win as (select doc_id, unnest(range(1, n_words - 1)) as i, words from m where n_words >= 4),
grams as (select doc_id, i, words[i:i + 2] as gram from win),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as n from grams) where n > 1),
cov as (select doc_id, count(distinct i + k) as n from rep, (select unnest([0, 1, 2]) as k) group by 1),
f as (select m.*, coalesce(cov.n, 0) as n_repeat_words from m left join cov using (doc_id)),
b as (select *, cast(n_words < 50 as int) + 2 * cast(100 * n_repeat_words > 50 * n_words as int)
    + 4 * cast(word_chars < 2 * n_words as int) + 8 * cast(word_chars > 20 * n_words as int)
    + 16 * cast(10 * n_symbols > n_words as int) + 32 * cast(2 * n_dup_lines > n_lines as int) as fail_bits from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) != 0 as base_failed,
  fail_bits = 0 as kept, n_lines, fail_bits from b
"""

QUALITY_ABLATIONS = f"""
with book as ({OP4_QUALITY}),
r(policy, rule, whole, own) as (values ('v0', 'few_words', 3, 1), ('v0', 'repeated_windows', 3, 2), ('v1', 'few_words', 63, 1),
  ('v1', 'repeated_windows', 63, 2), ('v1', 'short_words', 63, 4), ('v1', 'long_words', 63, 8), ('v1', 'many_signs', 63, 16),
  ('v1', 'repeated_lines', 63, 32))
select policy, rule, count(*) filter (where (fail_bits & own) <> 0) as n_failed,
  count(*) filter (where (fail_bits & whole) = own) as n_failed_only_this, count(*) filter (where (fail_bits & whole) = 0) as n_kept,
  count(*) filter (where (fail_bits & whole & ~own) = 0) as n_kept_without
from book, r group by 1, 2
"""

OP6_RECOMPRESSION = rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as words from documents),
win as (select doc_id, i, array_to_string(words[i:i + 34], ' ') as w
    from (select doc_id, words, unnest(range(1, len(words) - 33)) as i from d where len(words) >= 35)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by w) as n from win) where n > 1),
gone as (select distinct doc_id, i + k as at from rep, (select unnest(range(35)) as k)),
one as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as at from d),
kept as (select o.doc_id, count(g.at) as n_removed,
    string_agg(word, ' ' order by o.at) filter (where g.at is null) as text
    from one o left join gone g on o.doc_id = g.doc_id and o.at = g.at group by 1)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept using (doc_id)
"""

OP8_NEARDUP = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as words from documents),
s as (select distinct doc_id, unnest(case when len(words) >= 5
      then [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)]
      when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as shingle from d),
n as (select doc_id, count(*) as n from s group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b using (shingle)
    where a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b
    where 100 * common >= 85 * (x.n + y.n - common)),
edges as (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a),
low as (select a as doc_id, min(b) as m from reach group by 1)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(low.m, d.doc_id)) as component_id,
  least(d.doc_id, coalesce(low.m, d.doc_id)) = d.doc_id as kept
from d left join n using (doc_id) left join low using (doc_id)
"""

OP2_SUFFIX_DEDUP = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
win as (select doc_id, i, substr(h, 2 * i + 1, 400) as w
    from (select doc_id, h, unnest(range(len(h) // 2 - 199)) as i from d where len(h) >= 400)),
rep as (select doc_id, i from win semi join (select w from win group by w having count(*) > 1) using (w)),
runs as (select doc_id, i, i - lag(i) over (partition by doc_id order by i) as step from rep),
groups as (select doc_id, i, sum(case when step <= 200 then 0 else 1 end) over (partition by doc_id order by i) as g from runs),
spans as (select doc_id, g, min(i) as a, max(i) + 200 as b from groups group by 1, 2),
cuts as (select doc_id, count(*) as n_spans, sum(b - a) as n_removed, list(a order by a) as a, list(b order by a) as b
    from spans group by 1),
kept as (select d.doc_id, len(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
    case when n_spans is null then h else array_to_string([substr(h, 2 * x[1] + 1, 2 * (x[2] - x[1])) for x in
      list_zip(list_concat([0], b), list_concat(a, [len(h) // 2]))], '') end as h
    from d left join cuts using (doc_id))
select doc_id, cast(n_bytes as bigint) as n_bytes, cast(n_removed as bigint) as n_removed, n_spans,
  sha256(unhex(h)) as kept_sha256 from kept
"""

OP11_TRIE = rf"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (select conv_id, list(struct_pack(role := role, text := text) order by turn nulls first, role, text) as seq from t group by 1),
-- crc32, bit by bit
h as (select *, cast(xor(list_reduce(list_concat([4294967295], list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 as int) as h
    from own),
full_ as (select h.conv_id, coalesce(b.seq[1:h], []) || h.seq[h + 1:] as seq
    from h left join own b on b.conv_id = h.conv_id - h.conv_id % 20),
cuts as (select conv_id, seq, unnest(range(len(seq) + 1)) as depth from full_),
member as (select conv_id, depth, seq[1:depth] as node, seq[1:depth - 1] as up, len(seq) = depth as ends from cuts),
n as (select node, depth, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '')) as ends_sha256
    from member group by 1, 2),
c as (select up, depth - 1 as depth, count(*) as n_children from n where depth > 0 group by 1, 2),
own_sums as (select n.*, coalesce(c.n_children, 0) as n_children, cast(c.n_children is null as int) as leaf,
    case when n.depth = 0 then 0 else (n.n_convs - 1) * len(regexp_extract_all(n.node[n.depth].text, '{_WORD}')) end as saved
    from n left join c on c.up = n.node and c.depth = n.depth),
spread as (select node, leaf, saved, unnest(range(depth + 1)) as d from own_sums),
sums as (select node[1:d] as node, d as depth, sum(leaf) as n_leaves, sum(saved) as saved_tokens from spread group by 1, 2)
select o.conv_id, cast(o.depth as bigint) as depth, p.conv_id as parent_conv_id, o.n_convs, o.n_children,
  cast(s.n_leaves as bigint) as n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, o.ends_sha256
from own_sums o join sums s on s.node = o.node and s.depth = o.depth
left join n p on o.depth > 0 and p.node = o.up and p.depth = o.depth - 1
"""

OP12_VAFILE = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, x.vec_id, cast(list_inner_product(q.v, x.v) as bigint) as score
    from v q join v x on q.vec_id % 20 = 0 and q.vec_id != x.vec_id and len(q.v) = len(x.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""

OP13_AUDIT = rf"""
with t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '{_WORD}') as words, min(doc_id) over (partition by text) as first from t),
l as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by 1),
f as (select w.doc_id, part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, map(['A', 'B', 'C', 'D', 'E'], [
    len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
    100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text), regexp_matches(text, '[#$%&*|]'),
    coalesce(w.doc_id > first, false)]) as fails from w left join l on w.doc_id = l.doc_id),
m as (select part, good, toxic, fails, count(*) as n from f group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as c),
o as (select a.c || b.c || d.c || e.c || g.c as filter_order from x a, x b, x d, x e, x g
    where len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
s as (select m.*, filter_order, i as step, fails[substr(filter_order, i, 1)] as fails_here,
    len(list_filter(range(1, i), lambda j: fails[substr(filter_order, j, 1)])) = 0 as there,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda z: fails[z])) = 1 as lone
    from m, o, (select unnest([1, 2, 3, 4, 5]) as i)),
g as (select part, filter_order, step, substr(filter_order, step, 1) as filter,
    coalesce(sum(n) filter (where there and not fails_here), 0) as kept, coalesce(sum(n) filter (where there and fails_here), 0) as removed,
    coalesce(sum(n) filter (where fails_here and not there), 0) as redundant,
    coalesce(sum(n) filter (where fails_here and lone), 0) as unique_fails,
    coalesce(sum(n) filter (where there and fails_here and good), 0) as good_lost,
    coalesce(sum(n) filter (where there and fails_here and toxic), 0) as toxic_lost from s group by 1, 2, 3)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, filter) as bigint) as shapley
from g
"""

ORACLES = {"op1_warc": OP1_WARC, "op2_suffix_dedup": OP2_SUFFIX_DEDUP, "op3_mixing": OP3_MIXING, "op4_quality": OP4_QUALITY, "quality_ablations": QUALITY_ABLATIONS,
           "op6_recompression": OP6_RECOMPRESSION, "op8_neardup": OP8_NEARDUP, "op11_trie": OP11_TRIE, "op12_vafile": OP12_VAFILE,
           "op13_audit": OP13_AUDIT}
