"""SQL twins of the training-data queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op1_near_duplicates": r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as words
  from documents),
s as (
  select doc_id, list_distinct(case when len(words) = 0 then [] when len(words) = 1 then words
    else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end) as shingles
  from w),
e as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from s),
links as (
  select x.doc_id as a, y.doc_id as b
  from e x join e y on x.shingle = y.shingle and x.doc_id < y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n
  having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
both_ways as (select a, b from links union all select b, a from links),
reach(a, b) as (
  select doc_id, doc_id from documents
  union
  select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
root as (select a as doc_id, min(b) as component_id from reach group by a)
select s.doc_id, len(shingles)::bigint as n_shingles, component_id, s.doc_id = component_id as kept
from s join root using (doc_id)
""",
    "op6_top_k": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e::double[], c.e::double[])::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 10
""",
    "op9_boilerplate_lines": r"""
with l as (
  select doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as nth
  from documents),
t as (select *, trim(line, ' ' || chr(9) || chr(13)) as bare from l),
b as (select bare from t where bare <> '' group by bare having count(distinct source) >= 5),
m as (select t.*, bare <> '' and bare in (select bare from b) as gone from t)
select doc_id, count(*) filter (where bare <> '') as n_lines, count(*) filter (where gone) as n_removed,
       md5(coalesce(string_agg(line, chr(10) order by nth) filter (where not gone), '')) as kept_md5
from m group by doc_id
""",
    "op10_mixture": rf"""
with d as (
  select doc_id, source, len({WORDS})::bigint as size, length(coalesce(text, '')) as chars from documents),
k as (
  select doc_id, source, size,
         -ln((('0x' || substr(md5('mix:' || doc_id::varchar), 1, 12))::bigint::double + 0.5) / 281474976710656.0)
         / least(greatest(6.0::double * size / greatest(chars, 1), 0.25), 2.0) as key
  from d),
s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as nth from k group by source),
c as (select *, [3, 1, 2][((nth - 1) % 3 + 1)::int] as weight, 2 * source_size as cap from s),
f as (
  select *, (sum(source_size) over () * 1.5::double
             - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level
  from c),
u as (select min_by(level, cap / weight) as level from f where cap > level * weight),
t as (
  select source, source_size,
         case when cap <= f.level * weight then cap::double else u.level * weight end as target
  from f left join u on true),
g as (
  select source, source_size, target, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from t),
r as (
  select k.*, g.source_size, g.target, g.epochs, g.target - g.epochs * g.source_size as rest,
         sum(k.size) over (partition by k.source order by key, doc_id, k.size rows unbounded preceding) as upto
  from k join g on k.source is not distinct from g.source)
select doc_id, size, source_size, target,
       (size * (epochs + case when upto <= rest or upto - rest < rest - (upto - size) then 1 else 0 end))::bigint as taken
from r
""",
    "op11_source_divergence": r"""
with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
t as (select row, lang, source, unnest(terms) as term from d),
kept as (select lang, term, count(*) as n from t group by lang, term having count(distinct row) >= 30),
langs as (select lang, count(kept.term) as v, coalesce(sum(n), 0) as n
          from (select distinct lang from d) left join kept using (lang) group by lang),
c as (select t.lang, t.source, t.term, count(*) as n from t join kept using (lang, term) group by all),
sums as (select d.lang, d.source, coalesce(any_value(s.n), 0) as n
         from (select distinct lang, source from d) d
         left join (select lang, source, sum(n) as n from c group by all) s using (lang, source) group by all),
p as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (s.n + 5 * l.v)::hugeint as p,
    1 + (1000000000::hugeint * (k.n + 5)) // (l.n + 5 * l.v)::hugeint as q
  from sums s join langs l using (lang) join kept k using (lang) left join c using (lang, source, term)),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(any_value(f.value), 0)::bigint as value
  from sums a join sums b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source as a, y.source as b, sum(abs(x.p - y.p)) as value
             from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) f
    on f.lang = a.lang and f.a = a.source and f.b = b.source
  group by all),
terms as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from p where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 50
""",
    "op13_prefix_trie": r"""
with ids as (
  select distinct conv_id, conv_id - conv_id % 5 as base from conversations where conv_id is not null),
cut as (
  select conv_id, base, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
      range(1, len(conv_id::varchar) + 1), lambda i: ord(substr(conv_id::varchar, i::int, 1))::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 9 as h
  from ids),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      sha256(len(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as place
  from conversations where conv_id is not null),
heads as (
  select cut.conv_id, t.place, t.role, t.text from cut join turns t on t.conv_id = cut.base and t.place <= cut.h),
tails as (
  select t.conv_id, t.place - cut.h + coalesce(n.n, 0) as place, t.role, t.text
  from turns t join cut using (conv_id) left join (select conv_id, count(*) as n from heads group by 1) n using (conv_id)
  where t.place > cut.h),
said as (
  select conv_id, place::bigint as depth, strlen(text)::bigint as bytes,
    sha256(len(role)::varchar || ':' || role || text) || ' ' as code
  from (select * from heads union all select * from tails)),
steps as (
  select conv_id, depth, bytes, string_agg(code, '') over (partition by conv_id order by depth) as path from said
  union all select conv_id, 0, 0, '' from ids),
ends as (select conv_id, max(depth) as depth from steps group by 1),
nodes as (
  select path, any_value(s.depth) as depth, any_value(bytes) as bytes, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where e.depth = s.depth), '')) as ends_sha256
  from (select * from steps) s join (select conv_id, depth from ends) e using (conv_id) group by path),
links as (
  select distinct c.path as path, p.path as parent
  from steps c join steps p on c.conv_id = p.conv_id and p.depth = c.depth - 1),
kids as (select parent as path, count(*) as n_children from links group by 1),
below as (
  select distinct a.path as path, d.path as under
  from steps a join steps d on a.conv_id = d.conv_id and d.depth >= a.depth),
sums as (
  select below.path, count(*) filter (where k.path is null) as n_leaves, sum((n.n_convs - 1) * n.bytes) as saved_tokens
  from below join nodes n on n.path = below.under left join kids k on k.path = below.under group by below.path)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children, s.n_leaves,
  s.saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n join sums s using (path) left join kids k using (path)
left join links l using (path) left join nodes p on p.path = l.parent
""",
}
