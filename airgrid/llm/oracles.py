"""SQL equivalents (DuckDB) of those queries that SQL can express."""

OP3 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::double) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""

OP4 = """
with recursive w as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents
), s as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
  from w
), e as (select doc_id, len(s) as n, unnest(s) as t from s),
links as (
  select x.doc_id as a, y.doc_id as b from e x join e y on x.t = y.t and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
), c as (select a, min(b) as b from reach group by a)
select s.doc_id, len(s.s) as n_shingles, least(s.doc_id, coalesce(c.b, s.doc_id)) as component_id
from s left join c on c.a = s.doc_id
"""

OP12 = """
with recursive f as (
  select *, case when source is null then '' else '+' || source end as tree,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
    replace(text, chr(10), '') as bare,
    flatten(list_transform(string_split(doc_id::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])) as turns
  from documents
), g as (
  select doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when text is not null and list_reduce(list_prepend(4294967295::bigint, turns), lambda c, x:
        case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c // 2, 3988292384::bigint) else c // 2 end) % 2 = 1
      then sha256(head || strlen(bare) || ':' || bare) end as changed
  from f
), l as (
  select *, row_number() over (order by tree, doc_id nulls first, leaf) as id,
    row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n
  from g
), t as (
  select tree, 0 as lvl, pos, n, leaf as h from l
  union all
  select tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' order by pos)) from t where n > 1 group by tree, lvl, pos // 3, n
), s as (
  select tree, h as subroot, row_number() over (order by tree) - 1 as pos, count(*) over () as n from t where n = 1
), u as (
  select 0 as lvl, pos, n, subroot as h from s
  union all
  select lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' order by pos)) from u where n > 1 group by lvl, pos // 3, n
), step as (
  select l.id, 0 as part, t.lvl, t.pos, l.pos // (3 ** t.lvl)::bigint as me, t.h from l
  join t on t.tree = l.tree and t.n > 1 and t.pos // 3 = l.pos // (3 ** (t.lvl + 1))::bigint
  union all
  select l.id, 1, u.lvl, u.pos, s.pos // (3 ** u.lvl)::bigint, u.h from l join s on s.tree = l.tree
  join u on u.n > 1 and u.pos // 3 = s.pos // (3 ** (u.lvl + 1))::bigint
), side as (
  select id, part, lvl, coalesce(string_agg(h, '' order by pos) filter (where pos < me), '') as l,
    coalesce(string_agg(h, '' order by pos) filter (where pos > me), '') as r
  from step group by id, part, lvl
), way as (
  select id, sha256(string_agg(l || r, '' order by part, lvl)) as proof, list({'l': l, 'r': r} order by part, lvl) as sides from side group by id
), done as (
  select l.doc_id, l.leaf, s.subroot, (select h from u where n = 1) as root, coalesce(way.proof, sha256('')) as proof_sha256,
    list_reduce(list_prepend({'l': coalesce(l.changed, l.leaf), 'r': ''}, coalesce(way.sides, [])),
      lambda a, b: {'l': sha256(b.l || a.l || b.r), 'r': ''}).l as folded_root
  from l join s on s.tree = l.tree left join way on way.id = l.id
)
select *, folded_root = root as verified from done
"""

ORACLES = {"op3_top_products": OP3, "op4_jaccard_join": OP4, "op12_merkle_manifest": OP12}
