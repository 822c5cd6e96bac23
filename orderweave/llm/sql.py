"""DuckDB counterparts of the queries that SQL can express over whole tables."""

from __future__ import annotations

_OP1 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped as (
  select *,
    replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') as body,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c') as name
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(name) + length(body) + 14)::bigint as formatted_chars
from escaped group by conv_id
"""

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = rf"""
with doc as (
  select doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from documents
), item as (
  select item_id, w, least(len(w), 10) as size from (
    select item_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from benchmark where item_id is not null)
  where len(w) > 0
), pattern as (
  select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as g
  from (select item_id, w, size, unnest(range(1, len(w) - size + 2)) as i from item)
), place as (
  select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
  from doc, (select distinct size from pattern) where len(w) >= size
), hit as (
  select p.doc_id, p.i, p.size, q.item_id
  from place p join pattern q on q.size = p.size and q.g = array_to_string(p.w[p.i:p.i + p.size - 1], ' ')
), words as (
  select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + size)) as j from hit) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as found
  from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(found, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc d left join words using (doc_id) left join items using (doc_id)
"""

_OP5 = rf"""
with recursive doc as (
  select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from documents
), shingle as materialized (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from doc where len(w) >= 5)
  union all
  select doc_id, array_to_string(w, ' ') from doc where len(w) between 1 and 4
), sizes as (
  select doc_id, count(*) as n from shingle group by doc_id
), pair as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingle a join shingle b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
), link as materialized (
  select a, b from pair join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * pair.n >= 85 * (x.n + y.n - pair.n)
), reach(a, b) as (
  select a, b from link
  union
  select r.a, l.b from reach r join link l on l.a = r.b
), least_id as (
  select a as doc_id, min(b) as b from reach group by a
)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) as component_id,
  d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) as kept
from doc d left join sizes using (doc_id) left join least_id using (doc_id)
"""

_OP7 = rf"""
with doc as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents
), place as (
  select doc_id, i, array_to_string(w[i:i + 49], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from doc where len(w) >= 50)
), again as (
  select doc_id, i from place join (select g, min(doc_id) as first from place group by g) using (g) where first < doc_id
), gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as j from again
), word as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as j from doc
), kept as (
  select doc_id, string_agg(word, ' ' order by j) as text from word anti join gone using (doc_id, j) group by doc_id
), removed as (
  select doc_id, count(*) as n from gone group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(r.n, 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from doc d left join removed r using (doc_id) left join kept k using (doc_id)
"""

def _stand_earlier(n: int) -> str:
    """Documents in which some `n` consecutive lines also stand together at an earlier place."""
    run = ", ".join(f"x{k} := {x}" for k, x in enumerate(_leads(n)))
    return f"""
    select doc_id, {n} as n from (
      select doc_id, j, lead(j, {n - 1}) over own as last, struct_pack({run}) as run
      from line window own as (partition by doc_id order by k))
    where last is not null qualify row_number() over (partition by run order by doc_id, j) > 1"""


def _leads(n: int) -> list[str]:
    return ["line", *(f"lead(line, {k}) over own" for k in range(1, n))]


_OP9 = rf"""
with piece as (
  select doc_id, unnest(p) as line, generate_subscripts(p, 1) as k
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as p from documents)
), line as (
  select *, row_number() over (partition by doc_id order by k) as j from piece where regexp_matches(line, '{_WORD}')
), gone as (
  select doc_id, k from line qualify row_number() over (partition by line order by doc_id, j) > 1
), longest as (
  select doc_id, max(n) as longest from ({' union all '.join(_stand_earlier(n) for n in (1, 2, 4, 8))}) group by doc_id
), marked as (
  select l.doc_id, l.k, g.k is not null as gone,
    lag(g.k is not null, 1, false) over (partition by l.doc_id order by l.k) as before
  from line l left join gone g on g.doc_id = l.doc_id and g.k = l.k
), counted as (
  select doc_id, count(*) as n_lines, count_if(gone) as n_removed, count_if(gone and not before) as n_runs from marked group by doc_id
), kept as (
  select doc_id, string_agg(line, chr(10) order by k) as text from piece anti join gone using (doc_id, k) group by doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, coalesce(n_runs, 0) as n_runs,
  coalesce(longest, 0) as longest, sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join counted using (doc_id) left join kept k using (doc_id) left join longest using (doc_id)
"""

_OP10 = """
with doc as (
  select doc_id, encode(coalesce(text, '')) as h, strlen(coalesce(text, '')) as n from documents
), place as (
  select doc_id, i, array_slice(h, i + 1, i + 50) as g
  from (select doc_id, h, unnest(range(0, n - 49)) as i from doc where n >= 50)
), again as (
  select doc_id, i from place join (select g, min(doc_id) as first from place group by g) using (g) where first < doc_id
), gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as j from again
), spans as (
  select doc_id, count(*) as n_removed, count_if(before is null or before < j - 1) as n_spans
  from (select doc_id, j, lag(j) over (partition by doc_id order by j) as before from gone) group by doc_id
), byte as (
  select doc_id, j, hex(array_slice(h, j + 1, j + 1)) as b from (select doc_id, h, unnest(range(0, n)) as j from doc)
), kept as (
  select doc_id, string_agg(b, '' order by j) as h from byte anti join gone using (doc_id, j) group by doc_id
)
select d.doc_id, d.n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(k.h, ''))) as kept_sha256
from doc d left join spans using (doc_id) left join kept k using (doc_id)
"""

_FIELD = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_OP11 = f"""
with recursive leaf as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as p from (
    select doc_id, case when source is null then '' else '=' || source end as tree, n_bits % 2 = 0 as chosen,
      sha256({_FIELDS} || {_FIELD.format("text")}) as leaf,
      sha256({_FIELDS} || {_FIELD.format("replace(text, chr(10), '')")}) as tampered
    from (
      select *, list_reduce(
          list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: list_prepend(ascii(c)::bigint, [-1, -1, -1, -1, -1, -1, -1, -1])))),
          lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, 3988292384 * (c & 1)) end) + 1 as n_bits  -- the check sum, but for its last step
      from documents))
), tree as (
  select tree, 0 as level, list(leaf order by p) as nodes from leaf group by tree
  union all
  select tree, level + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) from tree where len(nodes) > 1
), grown as materialized (
  select * from tree
), subroot as (
  select tree, nodes[1] as node, row_number() over (order by tree) - 1 as p from grown where len(nodes) = 1
), top as (
  select 0 as level, list(node order by p) as nodes from subroot
  union all
  select level + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) from top where len(nodes) > 1
), whole as materialized (
  select * from top
), run as (
  select l.tree, l.p, g.level, (l.p // (3 ** g.level)::bigint) as k, g.nodes from leaf l join grown g on g.tree = l.tree and len(g.nodes) > 1
), step as (
  select tree, p, level, array_to_string(nodes[k - k % 3 + 1:k], '') as before, array_to_string(nodes[k + 2:k - k % 3 + 3], '') as after from run
), run_of_tree as (
  select s.tree, w.level, (s.p // (3 ** w.level)::bigint) as k, w.nodes from subroot s join whole w on len(w.nodes) > 1
), step_of_tree as (
  select tree, level, array_to_string(nodes[k - k % 3 + 1:k], '') as before, array_to_string(nodes[k + 2:k - k % 3 + 3], '') as after from run_of_tree
), steps as materialized (
  select tree, p, list(struct_pack(before, after) order by level) as witness from step group by tree, p
), steps_of_tree as materialized (
  select tree, list(struct_pack(before, after) order by level) as witness from step_of_tree group by tree
), proof as (
  select l.*, coalesce(s.witness, []) || coalesce(t.witness, []) as witness, u.node as subroot, (select nodes[1] from whole where len(nodes) = 1) as root
  from leaf l left join steps s using (tree, p) left join steps_of_tree t using (tree) join subroot u using (tree)
), folded as (
  select tree, p, 0 as k, case when chosen then tampered else leaf end as node, witness from proof
  union all
  select tree, p, k + 1, sha256(witness[k + 1].before || node || witness[k + 1].after), witness from folded where k < len(witness)
)
select doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(q.witness, lambda s: s.before || s.after), '')) as proof_sha256,
  f.node as folded_root, f.node = root as verified
from proof q join folded f on f.tree = q.tree and f.p = q.p and f.k = len(q.witness)
"""

SQL: dict[str, str] = {
    "op1_chat": _OP1,
    "op2_decontaminate": _OP2,
    "op5_minhash": _OP5,
    "op7_substrings": _OP7,
    "op9_lines": _OP9,
    "op10_suffixes": _OP10,
    "op11_merkle": _OP11,
}
