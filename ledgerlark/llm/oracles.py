"""DuckDB SQL for the registered queries that SQL can express."""

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

OP1 = f"""
with docs as (
  select doc_id, {_WORDS}::bigint as size, coalesce('0' || source, '1') as s,
         md5(concat_ws('|', '20240607', doc_id::varchar)) as k
  from documents),
sizes as (select s, sum(size)::bigint as source_size from docs group by s),
weighed as (
  select *, (array[5.0, 2.0, 1.0])[(row_number() over (order by s) - 1)::int % 3 + 1]::double as w,
         (2 * source_size)::double as cap, (sum(source_size) over ())::double * 1.5 as words
  from sizes),
levels as (
  select *, (words - coalesce(sum(cap) over (order by cap / w, s rows between unbounded preceding and 1 preceding), 0.0))
            / sum(w) over (order by cap / w, s rows between current row and unbounded following) as lev
  from weighed),
level as (select arg_min(lev, (cap / w, s)) as lev from levels where lev * w <= cap),
targets as (
  select s, source_size, case when level.lev is null then cap else least(cap, level.lev * w) end as target
  from levels, level),
rates as (
  select *, case when source_size = 0 then 0 else floor(target / source_size)::bigint end as whole from targets),
placed as (
  select d.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size as part,
         sum(size) over (partition by d.s order by k, doc_id, size rows between unbounded preceding and current row) as upto,
         row_number() over (partition by d.s order by k, doc_id, size) as n
  from docs d join rates r on d.s = r.s),
gaps as (
  select s, any_value(part) - coalesce(sum(size) filter (where upto <= part), 0) as gap from placed group by s),
fills as (
  select p.s, arg_min(n, (abs(size - gap), k, n)) as n
  from placed p join gaps g on p.s = g.s
  where upto > part and abs(size - gap) < gap group by p.s)
select doc_id, size, source_size, target,
       size * (whole + case when upto <= part or p.n = f.n then 1 else 0 end) as taken
from placed p left join fills f on p.s = f.s
"""


def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _row(text: str) -> str:
    return "sha256(" + " || ".join(_encoded(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# The checksum of CRC-32, bit by bit: a byte of the text comes in, eight shifts follow.
_CRC = """xor(list_reduce(
  list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''),
    lambda b: list_prepend(ascii(b)::bigint, [-1::bigint for i in range(8)])))),
  lambda c, x: case when x >= 0 then xor(c, x) when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end), 4294967295)"""

OP11 = f"""
with recursive
docs as (
  select doc_id, coalesce('1' || source, '0') as s, {_row('text')} as leaf,
         case when {_CRC} % 2 = 0 then {_row("replace(text, chr(10), '')")} else {_row('text')} end as shown
  from documents),
placed as (select *, row_number() over (partition by s order by doc_id nulls first) - 1 as i from docs),
nodes as (
  select 0 as lev, s, i, leaf as h, count(*) over (partition by s) as n from placed
  union all
  select lev + 1, s, i // 3, sha256(string_agg(h, '' order by i)), (max(n) + 2) // 3 from nodes where n > 1
  group by lev, s, i // 3),
roots as (select s, h as subroot, lev as deep, row_number() over (order by s) - 1 as i from nodes where n = 1),
tops as (
  select 0 as lev, i, subroot as h, count(*) over () as n from roots
  union all
  select lev + 1, i // 3, sha256(string_agg(h, '' order by i)), (max(n) + 2) // 3 from tops where n > 1
  group by lev, i // 3),
forest as (
  select s, lev, i, h from nodes where n > 1
  union all
  select r.s, r.deep + t.lev, t.i, t.h from tops t, roots r where t.n > 1),
steps as (
  select p.s, p.i as own, 0 as lev, case when r.deep = 0 then r.i else p.i end as i from placed p join roots r on p.s = r.s
  union all
  select x.s, x.own, x.lev + 1, case when x.lev + 1 = r.deep then r.i else x.i // 3 end
  from steps x join roots r on x.s = r.s
  where x.lev + 1 < r.deep + (select max(lev) from tops)),
sides as (
  select p.s, p.own, p.lev,
         coalesce(string_agg(f.h, '' order by f.i) filter (where f.i < p.i), '') as l,
         coalesce(string_agg(f.h, '' order by f.i) filter (where f.i > p.i), '') as r
  from steps p join forest f on f.s = p.s and f.lev = p.lev and f.i // 3 = p.i // 3
  group by p.s, p.own, p.lev, p.i),
proofs as (select s, own, sha256(string_agg(l || r, '' order by lev)) as proof, count(*) as deep from sides group by s, own),
folds as (
  select s, i as own, 0 as lev, shown as h from placed
  union all
  select f.s, f.own, f.lev + 1, sha256(x.l || f.h || x.r) from folds f join sides x on x.s = f.s and x.own = f.own and x.lev = f.lev),
ends as (select s, own, arg_max(h, lev) as h from folds group by s, own)
select p.doc_id, p.leaf, r.subroot, t.h as root, coalesce(f.proof, sha256('')) as proof_sha256, e.h as folded_root, e.h = t.h as verified
from placed p join roots r on p.s = r.s join tops t on t.n = 1 join ends e on e.s = p.s and e.own = p.i
left join proofs f on f.s = p.s and f.own = p.i
"""

ORACLES = {"op1_mix_sources": OP1, "op11_merkle_manifest": OP11}
