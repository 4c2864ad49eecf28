"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

# Positions in a stream, the common level of targets, the points of the slots and the blocks of 128
# words are the operator's definitions.
_MIX = f"""
with sizes as (
  select doc_id, source, cast({_WORDS} as bigint) as size,
    coalesce(md5(cast(doc_id as varchar)), md5(text), '') as k
  from documents),
numbered as (
  select source, source_size, 2.0 * source_size as cap,
    case (row_number() over (order by source nulls last) - 1) % 3
      when 0 then 3.0 when 1 then 1.0 else 2.0 end::double as weight
  from (select source, cast(sum(size) as bigint) as source_size from sizes group by source) s),
levels as (
  select *, (cast(sum(source_size) over () as double) * 1.5 - coalesce(sum(cap) over (
      order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0.0))
    / sum(weight) over (order by cap / weight, source nulls last
      rows between current row and unbounded following) as level
  from numbered),
targets as (
  select source, source_size, least(cap, coalesce(weight * max(case when level <= cap / weight
    then level end) over (), cap)) as target
  from levels),
parts as (
  select source, cast(floor(target) as bigint) as wanted from targets where floor(target) > 0),
ends as (
  select source, cast(floor(cast(sum(wanted) over (order by source nulls last
      rows between unbounded preceding and current row) as double)
    / cast(sum(wanted) over () as double) * 2147483648) as bigint) as hi
  from parts),
bounds as (
  select source, coalesce(lag(hi) over (order by source nulls last), 0) as lo, hi from ends),
points as (
  select slot, slot % 2147483648 * 1327217885 % 2147483648 as spot
  from (select unnest(range((select cast((sum(wanted) + 127) // 128 as bigint) from parts))) as slot) r),
slots as (
  select slot, source, row_number() over (partition by source order by slot) - 1 as block
  from points join bounds on spot >= lo and spot < hi),
placed as (
  select s.*, source_size, target, row_number() over () as id,
    cast(sum(size) over (partition by s.source order by k, doc_id nulls last, size
      rows between unbounded preceding and current row) as bigint) - size as first
  from sizes s join targets t on s.source is not distinct from t.source),
passes as (
  select id, source, size, first + pass * source_size as start, first + pass * source_size + size as stop
  from placed cross join (values (0), (1)) p(pass) where size > 0),
blocks as (
  select *, unnest(range(start // 128, (stop - 1) // 128 + 1)) as block from passes),
pieces as (
  select id, slot, least(stop, (b.block + 1) * 128) - greatest(start, b.block * 128) as words
  from blocks b join slots s on b.source is not distinct from s.source and b.block = s.block),
taken as (
  select id, sum(words) as taken, min(slot) as first_slot, count(*) as n_pieces from pieces group by id)
select doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken, first_slot,
  cast(coalesce(n_pieces, 0) as bigint) as n_pieces
from placed left join taken using (id)
"""

_AFTER = "substr(url, strpos(url, '://') + 3)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST = f"""case when contains(url, '://')
  then translate(regexp_extract({_AFTER}, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') else '' end"""
_PATH = f"case when contains(url, '://') then regexp_extract({_AFTER}, '^[^/?#]*([^?#]*)', 1) else '' end"
_QUERY = f"regexp_extract({_AFTER}, '^[^?#]*\\?([^#]*)', 1)"
_KEPT = (
    f"list_filter(string_split({_QUERY}, '&'), lambda x: x <> '' and not "
    "regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))"
)

# The given pages hold no canonical links and no redirects (a page that did would make a row
# here fail), so aliases are the spellings of one URL.
_URLS = f"""
with pages2 as (
  select page_id, url, {_HOST} as host, {_PATH} as path,
    case when contains(url, '://') then {_KEPT} end as kept,
    case when regexp_matches(coalesce(html, ''), '(?i)<(link|meta)\\b[^>]*(canonical|http-equiv)')
      then error('links are not expressed here') end as links
  from pages),
keyed as (
  select *, case when contains(url, '://') then
      regexp_replace(regexp_replace(host, '^(www|m)\\.', ''), ':(80|443)$', '')
      || regexp_replace(path, '(/index\\.html|\\.html|/)$', '')
      || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end
    else url end as node
  from pages2),
rules(action, site, prefix) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting as (
  select distinct k.url, r.site || r.prefix as rule, r.action
  from keyed k join rules r on (k.host = r.site or ends_with(k.host, '.' || r.site))
    and starts_with(k.path, r.prefix)),
decided as (
  select url, rule, action from (select *, row_number() over (partition by url
    order by length(rule) desc, action, rule desc) as rn from fitting) f where rn = 1),
classes as (
  select node, min(action) as spread from keyed join decided using (url) group by node)
select page_id, host, path, rule, coalesce(action, spread, 'allow') as verdict
from keyed k left join decided d on k.url = d.url left join classes c on k.node = c.node
"""

# The crc32 is the usual one, byte by byte over a table that its polynomial gives.
_SPELLING = f"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as entries),
found as (
  select coalesce(cast(doc_id as varchar), '') as doc,
    translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') as run
  from documents),
counted as (select doc, run, count(*) as c from found where length(run) >= 5 group by doc, run),
hashed as (
  select run, c, xor(4294967295, list_reduce(
    [4294967295] || flatten(list_transform(string_split(doc || ':' || run, ''), lambda x:
      case when unicode(x) < 128 then [unicode(x)::bigint] else [195::bigint, unicode(x) - 64] end)),
    lambda s, b: xor(s >> 8, entries[xor(s & 255, b) + 1]))) as h
  from counted, crc_table),
damaged as (
  select c, case when h % 97 <> 0 then run
    else left(run, h % length(run)) || substr(run, h % length(run) + 2) end as word
  from hashed),
words as materialized (
  select word, cast(sum(c) as bigint) as n from damaged
  where length(word) >= 5 group by word having sum(c) >= 3),
rests as materialized (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as materialized (
  select distinct a.word, b.word as other, b.n from rests a join rests b
    on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select a.word, b.word, b.n from rests a join words b on a.rest = b.word
  union select b.word, a.word, a.n from rests a join words b on a.rest = b.word),
best as (
  select word, other, n, count(*) over (partition by word) as n_near,
    row_number() over (partition by word order by n desc, other) as rn
  from near),
formed as materialized (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
    case when b.n >= 2 * w.n then other end as form, case when b.n >= 2 * w.n then b.n end as form_n
  from words w left join best b on w.word = b.word and rn = 1),
chain(word, node, form) as (
  select word, word, form from formed
  union all
  select c.word, f.word, f.form from chain c join formed f on c.form = f.word)
select f.word, f.form, c.node as root, f.n, f.n_near, f.form_n
from formed f join chain c on f.word = c.word and c.form is null
"""

_CODE_ROUNDS = 6


def _codes() -> str:
    """Rounds as one pair of common table expressions each; whole numbers throughout."""

    def assigned(k: int) -> str:
        return f"""near{k} as materialized (
  select vec_id, p, min({{'d': d, 'e': e}}) as best from (
    select x.vec_id, x.p, c.e, cast(sum((x.v - c.v) * (x.v - c.v)) as bigint) as d
    from cells x join book{k} c on x.p = c.p and x.j = c.j group by all) group by all)"""

    def moved(k: int) -> str:
        return f"""book{k + 1} as materialized (
  select c.p, c.e, c.j, coalesce(cast(floor_div as bigint), c.v) as v
  from book{k} c left join (
    select p, e, j, (s - ((s % n) + n) % n) // n as floor_div from (
      select x.p, a.best.e as e, x.j, sum(x.v) as s, count(*) as n
      from cells x join near{k} a on x.vec_id = a.vec_id and x.p = a.p group by all)) m
  on c.p = m.p and c.e = m.e and c.j = m.j)"""

    rounds = ",\n".join(f"{assigned(k)},\n{moved(k)}" for k in range(_CODE_ROUNDS))
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * x::double) as bigint)) as w
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cells as materialized (
  select vec_id, (i - 1) // (len(w) // 8) as p, (i - 1) % (len(w) // 8) as j, w[i] as v
  from (select vec_id, w, unnest(range(1, len(w) + 1)) as i from kept)),
book0 as materialized (
  select p, e, j, v from cells join (
    select vec_id, row_number() over (order by vec_id) - 1 as e from kept order by vec_id limit 16) using (vec_id)),
{rounds},
{assigned(_CODE_ROUNDS)},
coded as (
  select vec_id, string_agg(lower(printf('%02x', best.e)), '' order by p) as code,
    cast(sum(best.d) as bigint) as error
  from near{_CODE_ROUNDS} group by vec_id),
digest as (
  select sha256(string_agg(cast(v as varchar), ',' order by p, e, j)) as codebooks_sha256 from book{_CODE_ROUNDS})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join kept using (vec_id), digest
"""


_VECTOR_LINKS = """
with recursive vectors as materialized (
  select vec_id, case when embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
    then list_transform(embedding, lambda x: x::double) end as v
  from embeddings),
links as materialized (
  select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.vec_id <> b.vec_id
    and a.v is not null and b.v is not null and list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) as (
  select vec_id, vec_id from vectors
  union
  select r.a, l.b from reach r join links l on r.b = l.a),
ends as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from vectors v join ends e on v.vec_id = e.a left join counts c on v.vec_id = c.a
"""

ORACLES: dict[str, str] = {
    "op8_source_mix": _MIX,
    "op10_url_verdicts": _URLS,
    "op11_spelling_variants": _SPELLING,
    "op12_vector_codes": _codes(),
    "op13_embedding_near_dedup": _VECTOR_LINKS,
}
