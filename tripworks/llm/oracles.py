"""SQL counterparts of the corpus queries, where SQL can state them."""

from __future__ import annotations

from tripworks.llm import audit, chat, decontaminate, manifest, mixture, repeats
from tripworks.llm.frames import ASCII_UPPER

_WORDS = "regexp_extract_all(translate(coalesce({text}, ''), '%s', '%s'), '%s')" % (
    ASCII_UPPER,
    ASCII_UPPER.lower(),
    decontaminate.WORD,
)


def contamination(size: int = decontaminate.WINDOW) -> str:
    words, item_words = _WORDS.format(text="text"), _WORDS.format(text="text")
    return f"""
with item_words as (select item_id, {item_words} as w from benchmark where item_id is not null),
wins as (
  select distinct cast(item_id as varchar) as item, least(len(w), {size}) as k,
    array_to_string(w[s + 1 : s + least(len(w), {size})], ' ') as win
  from item_words, unnest(range(0, greatest(len(w) - {size}, 0) + 1)) as t(s) where len(w) > 0),
doc_words as (select row_number() over () as r, doc_id, {words} as w from documents),
places as (select r, p, k, array_to_string(w[p + 1 : p + k], ' ') as win
  from doc_words, (select distinct k from wins), unnest(range(0, len(w) - k + 1)) as t(p)),
occur as (select r, p, places.k, item from places join wins using (k, win)),
hit as (select r, count(distinct p + j) as n_hit from occur, unnest(range(0, k)) as t(j) group by r),
seen as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from occur group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words left join hit using (r) left join seen using (r)
"""


def mixing() -> str:
    weights = ", ".join(str(w) for w in mixture.WEIGHTS)
    return f"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
    md5('{mixture.SEED}:' || cast(doc_id as varchar)) as tie from documents),
sums as (
  select source, cast(sum(size) as bigint) as source_size,
    ([{weights}])[(row_number() over (order by source nulls last) - 1) % {len(mixture.WEIGHTS)} + 1] as w
  from sized group by source),
ordered as (
  select *, row_number() over (order by source_size / w, source) as nth, sum(w) over rest as w_rest, coalesce(sum(source_size) over before, 0) as full_size,
    sum(source_size) over () as total
  from sums
  window rest as (order by source_size / w, source rows between current row and unbounded following),
    before as (order by source_size / w, source rows between unbounded preceding and 1 preceding)),
filling as (select *, ({mixture.BUDGET} * total - {mixture.MOST} * full_size) / w_rest as share from ordered),
level as (select arg_min(share, nth) filter (where w * share <= {mixture.MOST} * source_size) as share from filling),
targets as (
  select source, source_size, cast(case when w * level.share > {mixture.MOST} * source_size
    then {mixture.MOST} * source_size else w * level.share end as double) as target,
    cast('0x' || md5(case when source is null then '{mixture.SEED}' else '{mixture.SEED}:' || source end)[1:12] as bigint)
      / 281474976710656.0::double as start
  from sums, level),
placed as (
  select s.*, source_size, target, start, case when source_size > 0 then target / source_size else 0.0 end as rate,
    row_number() over (partition by s.source order by size, tie nulls first) as place
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  cast((floor(rate * place + start) - floor(rate * (place - 1) + start)) * size as bigint) as taken
from placed
"""


def rotation() -> str:
    def safe(text: str) -> str:
        return f"replace(replace({text}, '<|', '< |'), '|>', '| >')"

    system = ", ".join(f"'{r}'" for r in chat.CONTEXT_ROLES)
    return f"""
with turns as (
  select conv_id, coalesce(role, '{chat.UNNAMED}') as role, coalesce(text, '') as text, turn from conversations),
placed as (
  select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as place from turns),
speakers as (select distinct conv_id, role as speaker from turns where role not in ({system})),
said as (
  select p.conv_id, (place - 1) // {chat.PART_TURNS} as part, place, speaker, role = speaker as own,
    case when role = speaker then '<|assistant|>' when role in ({system}) then '<|' || {safe("role")} || '|>'
      else '<|user:' || {safe("role")} || '|>' end || chr(10) as head, {safe("text")} || '<|end|>' as body
  from placed p join speakers s on p.conv_id is not distinct from s.conv_id),
spans as (
  select *, sum(length(head) + length(body) + 1) over (partition by conv_id, speaker order by place) as until,
    length(head) + length(body) + 1 as size from said)
select conv_id, cast(part as bigint) as part, speaker, string_agg(head || body || chr(10), '' order by place) as text,
  cast(min(until - size) as bigint) as offset,
  coalesce(string_agg(cast(until - 1 - length(body) as varchar) || ':' || cast(until - 1 as varchar), ',' order by place) filter (where own), '') as mask,
  count(*) as n_turns, cast(sum(size) as bigint) as n_chars, cast(coalesce(sum(length(body)) filter (where own), 0) as bigint) as n_trained
from spans group by conv_id, part, speaker
"""


def filter_audit() -> str:
    return f"""
with documents_read as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
labelled as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
  from labels where doc_id is not null group by doc_id),
judged as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    [len(w) < {audit.FEWEST_WORDS}, 100 * len(list_distinct(w)) < {audit.DISTINCT_PER_100} * len(w),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {audit.CAPITALS_PER_100} * length(t),
     regexp_matches(t, '{audit.SIGNS}'),
     coalesce(min(d.doc_id) over (partition by t) < d.doc_id, false)] as f
  from documents_read d left join labelled l on d.doc_id = l.doc_id),
letters as (select unnest(range(1, 6)) as f),
orders as (
  select [a.f, b.f, c.f, d.f, e.f] as o from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
cells as (
  select part, f, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
  from judged group by part, f),
steps as (
  select part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') as filter_order, step, o[step] as this,
    n, good, toxic, f[o[step]] as fails,
    list_bool_or(list_transform(o[1 : step - 1], lambda x: f[x])) as before,
    len(list_filter(f, lambda x: x)) as n_fails
  from cells, orders, unnest(range(1, 6)) as t(step)),
counted as (
  select part, filter_order, cast(step as integer) as step, this,
    cast(coalesce(sum(n) filter (where not fails and not coalesce(before, false)), 0) as bigint) as kept,
    cast(coalesce(sum(n) filter (where fails and not coalesce(before, false)), 0) as bigint) as removed,
    cast(coalesce(sum(n) filter (where fails and coalesce(before, false)), 0) as bigint) as redundant,
    cast(coalesce(sum(n) filter (where fails and n_fails = 1), 0) as bigint) as unique_fails,
    cast(coalesce(sum(good) filter (where fails and not coalesce(before, false)), 0) as bigint) as good_lost,
    cast(coalesce(sum(toxic) filter (where fails and not coalesce(before, false)), 0) as bigint) as toxic_lost
  from steps group by part, filter_order, step, this)
select * exclude (this), cast(sum(removed) over (partition by part, this) as bigint) as shapley from counted
"""


def merkle(levels: int = 6, dataset_levels: int = 3) -> str:
    """Stated for up to 16 ** levels rows of a source and 16 ** dataset_levels sources."""

    def leaf(text: str) -> str:
        fields = [text if c == "text" else f"cast({c} as varchar)" for c in manifest.COLUMNS]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    step = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    byte = f"list_reduce(list_prepend(xor(c0, b), range(8)), lambda c, i: {step})"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c0, b: {byte}))"

    def climb(name: str, base: str, key: str, depth: int) -> str:
        out = [f"{name}0 as materialized ({base})"]
        for n in range(depth):
            out.append(f"""
{name}s{n} as materialized (
  select *, idx // {manifest.ARITY} as run, count(*) over (partition by {key}) as nodes,
    string_agg(digest, '') over (partition by {key}, idx // {manifest.ARITY} order by idx rows between unbounded preceding and 1 preceding) as l,
    string_agg(digest, '') over (partition by {key}, idx // {manifest.ARITY} order by idx rows between 1 following and unbounded following) as r
  from {name}{n}),
{name}{n + 1} as materialized (
  select {key}, run as idx, case when any_value(nodes) = 1 then any_value(digest) else sha256(string_agg(digest, '' order by idx)) end as digest
  from {name}s{n} group by {key}, run)""")
        return ",".join(out)

    def folded(at: str, alias: str) -> str:
        return f"case when {alias}.nodes = 1 then {at} else sha256(coalesce({alias}.l, '') || {at} || coalesce({alias}.r, '')) end"

    sides = [f"g{n}" for n in range(levels)] + [f"d{n}" for n in range(dataset_levels)]
    joins = "\n".join(
        f"join {a[0]}s{a[1:]} {a} on {a}.{'k' if a[0] == 'g' else 'one'} = {'x.k' if a[0] == 'g' else '1'} and {a}.idx = "
        + (f"x.idx // {manifest.ARITY ** int(a[1:])}" if a[0] == "g" else f"y.idx // {manifest.ARITY ** int(a[1:])}")
        for a in sides
    )
    met = " || ".join(f"coalesce({a}.l, '') || coalesce({a}.r, '')" for a in sides)
    folds = ""
    for n, a in enumerate(sides):
        folds += f", {folded('at_' + str(n), a)} as at_{n + 1}"
    return f"""
with read as materialized (
  select doc_id, coalesce('=' || source, '') as k, {leaf("text")} as digest, {leaf(f"translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')")} as lowered,
    list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)) as bytes
  from documents),
leaves as materialized (
  select *, row_number() over (partition by k order by doc_id nulls first, digest) - 1 as idx,
    case when coalesce({crc} % {manifest.TAMPERED} = 0, false) then lowered else digest end as at_0
  from read),
{climb("g", "select k, idx, digest from leaves", "k", levels)},
{climb("d", f"select 1 as one, row_number() over (order by k) - 1 as idx, digest, k from g{levels}", "one", dataset_levels)},
found as (
  select x.doc_id, x.digest as leaf, y.digest as subroot, (select digest from d{dataset_levels}) as root,
    sha256({met}) as proof_sha256, x.at_0{folds}
  from leaves x join d0 y on x.k = y.k
{joins})
select doc_id, leaf, subroot, root, proof_sha256, at_{len(sides)} as folded_root, at_{len(sides)} = root as verified from found
"""


def repeated_bytes(length: int = repeats.LENGTH) -> str:
    return f"""
with texts as materialized (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
places as (select r, doc_id, s, substr(h, 2 * s + 1, 2 * {length}) as k
  from texts, unnest(range(0, len(h) // 2 - {length} + 1)) as t(s) where doc_id is not null),
firsts as (select k, min(doc_id) as first from places group by k having min(doc_id) < max(doc_id)),
hits as (select r, s from places join firsts using (k) where first < doc_id),
marked as (select *, case when s <= lag(s) over (partition by r order by s) + {length} then 0 else 1 end as new from hits),
numbered as (select *, sum(new) over (partition by r order by s) as run from marked),
runs as (select r, run, min(s) as begins, max(s) + {length} as ends from numbered group by r, run),
gaps as (select *, coalesce(lag(ends) over (partition by r order by run), 0) as since from runs),
cut as (
  select r, sum(ends - begins) as n_removed, count(*) as n_spans, max(ends) as last,
    string_agg(substr(h, 2 * since + 1, 2 * (begins - since)), '' order by run) as kept
  from gaps join texts using (r) group by r)
select doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from texts left join cut using (r)
"""


def all_sql() -> dict[str, str]:
    return {
        "op2_benchmark_decontamination": contamination(),
        "op9_source_mixing": mixing(),
        "op10_chat_formatting": rotation(),
        "op11_filter_audit": filter_audit(),
        "op12_merkle_manifest": merkle(),
        "op13_suffix_array_dedup": repeated_bytes(),
    }
