"""Reference SQL (DuckDB) of the text queries that SQL can express, from their contracts."""

from __future__ import annotations

from tarmac.llm.secrets import BASE_RULES, RULES

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URLS = rf"""
with parts as (
    select page_id,
        coalesce({_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")}, '') host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') path
    from pages),
outcomes as (
    select doc_id, max((quality = 0)::int) bad from labels
    where doc_id is not null and quality is not null group by doc_id),
hosts as (
    select host, count(bad)::double n, coalesce(sum(bad), 0)::double k,
        regexp_extract(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '([^.]*\.)?[^.]*$', 0) as domain,
        regexp_extract(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[^.]*$', 0) as suffix
    from parts left join outcomes on page_id = doc_id group by host),
overall as (select (sum(k) + 0.5) / (sum(n) + 1) m from hosts),
suffixes as (select suffix, sum(n) n, sum(k) k, any_value(m) prior from hosts, overall group by suffix),
s0 as (select sum((k - n * prior) ** 2 - n * prior * (1 - prior)) / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0) r from suffixes),
s1 as (select 1 / least(greatest(coalesce(r, 0.8), 0.001), 0.8) - 1 s from s0),
s2 as (select suffix, (k + s * prior) / (n + s) prior, n + s ns, s from suffixes, s1),
s3 as (select suffix, prior, prior * (1 - prior) / (ns + 1) var from s2),
domains as (
    select domain, suffix, sum(n) n, sum(k) k, any_value(prior) prior, any_value(var) var from hosts join s3 using (suffix) group by domain, suffix),
d0 as (select sum((k - n * prior) ** 2 - n * prior * (1 - prior)) / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0) r from domains),
d1 as (select 1 / least(greatest(coalesce(r, 0.8), 0.001), 0.8) - 1 s from d0),
d2 as (select domain, (k + s * prior) / (n + s) prior, n + s ns, s, var from domains, d1),
d3 as (select domain, prior, prior * (1 - prior) / (ns + 1) + (s / ns) ** 2 * var as var from d2),
primed as (select hosts.*, prior, var from hosts join d3 using (domain)),
h0 as (select sum((k - n * prior) ** 2 - n * prior * (1 - prior)) / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0) r from primed),
h1 as (select 1 / least(greatest(coalesce(r, 0.8), 0.001), 0.8) - 1 s from h0),
judged as (
    select host, n::bigint labelled, (k + s * prior) / (n + s) mean, n + s ns, s, var from primed, h1),
rules(rule, rule_host, rule_path, verdict) as (values
    ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
    ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
    ('com/de/', 'com', '/de/', 'block')),
fits as (
    select host, path, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
    from (select distinct host, path from parts) u
    join rules on (u.host = rule_host or ends_with(u.host, '.' || rule_host)) and starts_with(u.path, rule_path)
    group by host, path)
select page_id, p.host, p.path, f.rule,
    coalesce(f.verdict, case when greatest(mean - 1.645 * sqrt(mean * (1 - mean) / (ns + 1) + (s / ns) ** 2 * var), 0) >= 0.3
        then 'block' else 'allow' end) verdict,
    labelled, round(mean, 6) bad_rate
from parts p join judged j on p.host = j.host left join fits f on f.host = p.host and f.path = p.path
"""

_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = rf"""
with items as (select item_id, {_WORDS} w from benchmark),
windows as (
    select item_id, least(len(w), 13) size, w[i:i + least(len(w), 13) - 1] as words
    from (select *, unnest(range(1, len(w) - least(len(w), 13) + 2)) i from items where len(w) > 0)),
docs as (select row_number() over () as row, doc_id, {_WORDS} w from documents),
sizes as (select distinct size from windows),
places as (
    select row, i, size, w[i:i + size - 1] as words
    from (select row, w, size, unnest(range(1, len(w) - size + 2)) i from docs, sizes where len(w) >= size)),
hits as (
    select row, i, p.size, item_id from places p
    join (select words, list(distinct item_id) ids from windows group by words) using (words), unnest(ids) as t(item_id)),
covered as (
    select row, count(distinct pos) n_hit from (select row, unnest(range(i, i + size)) as pos from hits) group by row),
named as (
    select row, count(distinct item_id) n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) ids
    from hits group by row)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
    sha256(coalesce(ids, '')) items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from docs left join covered using (row) left join named using (row)
"""

_TURN = "replace(replace(replace(replace(replace({0}, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]')"

CHAT = f"""
with turns as (
    select conv_id, turn, role, text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
named as (
    select conv_id, turn, role as r, text as t, coalesce(role, '') role, coalesce(text, '') text from turns)
select conv_id, count(*) n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, r nulls first, t nulls first)) turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, r nulls first, t nulls first)
        filter (role = 'assistant'), '')) loss_sha256,
    sum(22 + length({_TURN.format("role")}) + length({_TURN.format("text")}))::bigint formatted_chars
from named group by conv_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans_of(place: int, rule) -> str:
    """Matches with their places: lengths of what is between them and of them, added up."""
    return f"""
    select row, {place} place, {_quoted(rule.name)} kind, (sum(gap + size) over w - size)::bigint as pos, size, kept
    from (select row, i, length(gaps[i]) gap, length(whole[i]) size, length(kept[i]) kept
        from (select row, string_split_regex(text, {_quoted(rule.pattern)}) gaps,
                regexp_extract_all(text, {_quoted(rule.pattern)}, 0) whole,
                regexp_extract_all(text, {_quoted(rule.pattern)}, {rule.group}) kept
            from docs where regexp_matches(text, {_quoted(rule.pattern)})),
        unnest(range(1, len(whole) + 1)) as t(i))
    window w as (partition by row order by i)"""


def _secret_sql() -> str:
    parts = []
    for place, rule in enumerate(RULES, 1):
        parts.append(f"select row, place, kind, pos, pos + size stop from ({_spans_of(place, rule)}) where kept >= {rule.least}")
    base = ", ".join(_quoted(r.name) for r in BASE_RULES)
    joined = "string_agg(kind || ':' || pos || ':' || stop, ',' order by pos, place)"
    counts = ", ".join(f"count(*) filter (kind = {_quoted(r.name)}) n_{r.name}" for r in BASE_RULES)
    total = ", ".join(f"coalesce(n_{r.name}, 0)::bigint n_{r.name}" for r in BASE_RULES)
    return f"""
with docs as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
spans as ({" union all ".join(parts)}),
found as (
    select row, {counts}, {joined} filter (kind in ({base})) as base, {joined} as spans from spans group by row)
select doc_id, {total}, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from docs left join found using (row)
"""


SECRETS = _secret_sql()


def _centroid_rounds(rounds: int) -> str:
    """Common tables c0 to c<rounds> of (k, p, y), and d0 to d<rounds> of (vec_id, k, d)."""
    out = []
    for r in range(rounds + 1):
        if r:
            out.append(f"""
m{r} as (
    select k, p, sum(x)::bigint s, count(*)::bigint n from d{r - 1} join x using (vec_id) group by k, p),
c{r} as (
    select k, p, case when n is null then y else (s - ((s % n) + n) % n) // n end y from c{r - 1} left join m{r} using (k, p))""")
        out.append(f"""
d{r} as (
    select vec_id, arg_min(k, (d, k)) k, min(d) d from (
        select vec_id, k, sum((x - y) * (x - y))::bigint d from x join c{r} using (p) group by vec_id, k)
    group by vec_id)""")
    return ",".join(out)


CENTROIDS = f"""
with kept as (
    select vec_id, embedding v from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64),
x as (
    select vec_id, p, floor(256 * v[p]::double)::bigint x from (select vec_id, v, unnest(range(1, 65)) p from kept)),
starts as (
    select vec_id, row_number() over (order by sha256('2:' || vec_id)) - 1 k from kept
    order by k limit 40),
c0 as (select k, p, x y from starts join x using (vec_id)),{_centroid_rounds(5)},
sums as (select k, sum(d)::bigint inertia from d5 group by k),
digests as (select k, sha256(string_agg(y::bigint::varchar, ',' order by p)) sha from c5 group by k)
select vec_id, k::int as cluster, d as distance, sums.inertia as cluster_inertia,
    (select sum(d)::bigint from d5) as inertia, sha as centroid_sha256
from d5 join sums using (k) join digests using (k)
"""


def _code_rounds(rounds: int) -> str:
    """Common tables e0 to e<rounds> of (part, k, p, y), and g0 to g<rounds> of (vec_id, part, k, d)."""
    out = []
    for r in range(rounds + 1):
        if r:
            out.append(f"""
m{r} as (
    select part, k, p, sum(x)::bigint s, count(*)::bigint n from g{r - 1} join x using (vec_id, part) group by part, k, p),
e{r} as (
    select part, k, p, case when n is null then y else (s - ((s % n) + n) % n) // n end y
    from e{r - 1} left join m{r} using (part, k, p))""")
        out.append(f"""
g{r} as (
    select vec_id, part, arg_min(k, (d, k)) k, min(d) d from (
        select x.vec_id, x.part, k, sum((x - y) * (x - y))::bigint d from x join e{r} using (part, p) group by all)
    group by vec_id, part)""")
    return ",".join(out)


VECTOR_CODES = f"""
with kept as (
    select vec_id, label, embedding v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = len(embedding)),
x as (
    select vec_id, (p - 1) // 16 part, (p - 1) % 16 p, floor(1024 * v[p]::double)::bigint x
    from (select vec_id, v, unnest(range(1, 65)) p from kept)),
starts as (select vec_id, row_number() over (order by vec_id) - 1 k from kept order by k limit 256),
e0 as (select part, k, p, x y from starts join x using (vec_id)),{_code_rounds(4)},
coded as (
    select vec_id, string_agg(lpad(lower(to_hex(k)), 2, '0'), '' order by part) code, sum(d)::bigint error from g4 group by vec_id),
labelled as (select coded.*, label from coded join kept using (vec_id)),
sums as (select label, sum(error)::bigint label_error from labelled group by label)
select vec_id, code, error, label_error,
    (select sha256(string_agg(y::bigint::varchar, ',' order by part, k, p)) from e4) as codebooks_sha256
from labelled join sums on labelled.label is not distinct from sums.label
"""

SHARDS = """
with recursive bits(i, v, k) as (
    select range::bigint, range::bigint, 0 from range(256)
    union all
    select i, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from bits where k < 8),
crc as (select list(v order by i) t from bits where k = 8),
docs as (
    select doc_id, coalesce(strlen(text), 0) + 1 size, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::bigint a,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint) bytes
    from documents),
placed as (
    select doc_id, size, a, bytes,
        row_number() over w n, sum(size) over w s, sum(size) over (order by a) group_end,
        sum(size) over (order by a) - sum(size) over (partition by a) group_begin
    from docs window w as (order by a, doc_id nulls first rows unbounded preceding)),
targets as (
    select k, (select sum(size) from docs) // 1 * k // 8 want, (select sum(size) from docs) * 0.01 / 8 near from range(1, 8) t(k)),
-- The border of texts nearest to each even share if it is near enough, else the border of documents.
borders as (
    select k, want, near, min((abs(g - want), g)) text_border from targets, (select distinct group_end g from placed union select 0) group by all),
rows_below as (
    select k, min((abs(s - want), s)) row_border from targets, (select s from placed union select 0) group by k),
ends as (
    select k, case when struct_extract_at(text_border, 1) <= near then struct_extract_at(text_border, 2)
        else struct_extract_at(row_border, 2) end s
    from borders join rows_below using (k)),
sharded as (select placed.*, (select count(*) from ends where ends.s < placed.s) shard from placed)
select doc_id, size::bigint as size,
    xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32,
    'bytes' as law, shard::int as shard, row_number() over (partition by shard order by n) - 1 as slot, null::int as grown_shard
from sharded, crc
"""
