"""DuckDB SQL with the same columns and rows as the query of the same name."""

from __future__ import annotations

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_OP1 = f"""
with doc as (
    select doc_id, coalesce({_PLAIN.format("text")}, []) as w from documents),
item as (
    select item_id, {_PLAIN.format("text")} as w from benchmark),
win as (
    select distinct item_id, least(10, len(w)) as n,
        array_to_string(w[p : p + least(10, len(w)) - 1], ' ') as g
    from (select *, unnest(range(1, len(w) - least(10, len(w)) + 2)) as p from item
          where len(w) > 0)),
run as (
    select doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') as g
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p
          from doc, (select distinct n from win) where len(w) >= n)),
hit as (select doc_id, p, run.n, item_id from run join win using (g)),
covered as (
    select doc_id, count(*) as n_hit from (
        select distinct doc_id, unnest(range(p, p + n)) as q
        from (select distinct doc_id, p, n from hit)) group by doc_id),
named as (
    select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
    from (select distinct doc_id, cast(item_id as varchar) as i from hit) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
    coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from doc left join covered using (doc_id) left join named using (doc_id)
"""

_OP4 = f"""
with doc as (
    select doc_id, coalesce({_SPACED.format("text")}, []) as w from documents),
run as (
    select doc_id, p, array_to_string(w[p : p + 12], ' ') as g
    from (select doc_id, w, unnest(range(1, len(w) - 11)) as p from doc where len(w) >= 13)),
first as (select g, min(doc_id) as d from run group by g),
gone as (
    select distinct doc_id, unnest(range(p, p + 13)) as q
    from run join first using (g) where doc_id > d),
cut as (select doc_id, list(q) as qs from gone group by doc_id),
word as (
    select doc_id, q, w[q] as x
    from (select doc_id, w, unnest(range(1, len(w) + 1)) as q from doc)),
kept as (
    select doc_id, string_agg(x, ' ' order by q) as t
    from word anti join gone using (doc_id, q) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words,
    cast(coalesce(len(qs), 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from doc left join cut using (doc_id) left join kept using (doc_id)
"""

_G = "(1.01 / 0.99)"
_FENCES = ", ".join(
    f"max(case when share = '{s}' then q1 - 3 * (q1 - q0) end) as low_{s}, "
    f"max(case when share = '{s}' then q1 + 3 * (q2 - q1) end) as high_{s}"
    for s in ("symbols", "lines", "repeats", "length")
)
_DRAWN = ", ".join(f"(x.total * x.q{i} + 20 * y.q{i}) / (x.total + 20) as q{i}" for i in range(3))
_OP5 = f"""
with doc as (
    select row_number() over () as r, *, coalesce({_SPACED.format("text")}, []) as w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
    from documents),
run as (
    select r, p, count(*) over (partition by r, array_to_string(w[p : p + 7], ' ')) as c
    from (select r, w, unnest(range(1, len(w) - 6)) as p from doc where len(w) >= 8)),
again as (
    select r, count(*) as n from (
        select distinct r, unnest(range(p, p + 8)) as q from run where c > 1) group by r),
base as (
    select r, doc_id, lang, source, len(w) as n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as n_symbols,
        len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(again.n, 0) as n_repeat_words, len(lines) as n_lines
    from doc left join again using (r)),
x as (
    select r, lang, source, unnest([
        {{'share': 'symbols', 'x': n_symbols / n_words}},
        {{'share': 'lines', 'x': n_dup_lines / n_lines}},
        {{'share': 'repeats', 'x': n_repeat_words / n_words}},
        {{'share': 'length', 'x': word_chars / n_words}}], recursive := true)
    from base where n_words > 0),
bins as (
    select *, case when x > 0 then floor(ln(x) / ln({_G})) else -2147483648 end as b from x),
counts as (
    select 2 as level, lang, source, share, b, count(*) as n from bins group by all
    union all select 1, lang, null, share, b, count(*) from bins group by all
    union all select 0, null, null, share, b, count(*) from bins group by all),
cum as materialized (
    select *, sum(n) over (partition by level, lang, source, share order by b) as upto,
        sum(n) over (partition by level, lang, source, share) as total,
        case when b = -2147483648 then 0 else pow({_G}, b) * (1 + {_G}) / 2 end as v
    from counts),
quart as materialized (
    select level, lang, source, share, max(total) as total,
        min(case when upto >= total * 0.1 then v end) as q0,
        min(case when upto >= total * 0.5 then v end) as q1,
        min(case when upto >= total * 0.9 then v end) as q2
    from cum group by all),
langs as materialized (
    select x.lang, share, {_DRAWN} from quart x join quart y using (share)
    where x.level = 1 and y.level = 0),
groups as (
    select x.lang, x.source, share, {_DRAWN} from quart x join langs y using (share)
    where x.level = 2 and x.lang is not distinct from y.lang),
rule as (select lang, source, {_FENCES} from groups group by all)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
    cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
    cast(n_repeat_words as bigint) as n_repeat_words,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    n_words >= 20 and 100 * n_repeat_words <= 30 * n_words and coalesce(
        not (n_symbols / n_words > high_symbols and n_symbols > 1)
        and not (n_dup_lines / n_lines > high_lines and n_dup_lines > 1)
        and not (n_repeat_words / n_words > high_repeats and n_repeat_words > 16)
        and word_chars / n_words between low_length and high_length, false) as kept
from base left join rule
    on base.lang is not distinct from rule.lang and base.source is not distinct from rule.source
"""

_OP9 = """
with page as (select page_id, coalesce(html, '') as html from pages),
of as (
    select *, octet_length(encode(html)) as n, max(page_id) over (partition by html) as last
    from page)
select page_id, cast(n as bigint) as payload_bytes, sha1(html) as payload_digest,
    case when n >= 1000 and page_id < last then 'revisit' else 'response' end as record_type,
    case when n >= 1000 and page_id < last then last end as refers_to
from of
"""

_OP11 = """
with wide as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
met as (
    select a.vec_id as a, b.vec_id as b, a.label = b.label as same,
        cast(list_dot_product(a.v, b.v) as bigint) as s
    from wide a join wide b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where a.vec_id % 100 = 0),
near as (
    select a, b as p, s as ps from met where same
    qualify row_number() over (partition by a order by s desc, b) <= 5)
select a as anchor_id, p as positive_id,
    cast(row_number() over (partition by a, p order by s desc, b) as integer) as rank,
    b as negative_id, ps as positive_score, s as negative_score
from near join met using (a)
where not same and 30 * ps <= 100 * s and 100 * s <= 90 * ps
qualify row_number() over (partition by a, p order by s desc, b) <= 10
"""

_OP12 = """
with doc as (
    select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as u,
        sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h
    from documents),
num as (
    select *, len(u) as n,
        list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(h, i, 8) as bigint)) as x
    from doc),
cut as (
    select *, least(x[1] % (n + 1), x[2] % (n + 1)) as a, greatest(x[1] % (n + 1), x[2] % (n + 1)) as b,
        case when t = '' or regexp_matches(t, '<[PSM]>') or x[3] % 100 >= 100 then 'plain'
            when x[4] % 100 < 50 then 'spm' else 'psm' end as form
    from num),
part as (
    select *, array_to_string(u[1 : a], '') as p, array_to_string(u[a + 1 : b], '') as m,
        array_to_string(u[b + 1 :], '') as s
    from cut)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
    case when form <> 'plain' then length(m) end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(t) as restored_sha256
from part
"""

_ASSIGN = """((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = (
    (0, "assign", _ASSIGN, 2),
    (1, "access", "AKIA[A-Z0-9]{16,}", 0),
    (2, "hex", "[0-9a-f]{24,}", 0),
    (3, "live", "[A-Za-z0-9+/_=-]{20,}", 0),
)
_MATCHES = " union all ".join(
    f"select r, {rank} as rank, '{kind}' as kind, unnest(regexp_extract_all(t, '{p}')) as m, "
    f"unnest(regexp_extract_all(t, '{p}', {group})) as v, unnest(string_split_regex(t, '{p}')[:-2]) as gap, "
    f"unnest(range(len(regexp_extract_all(t, '{p}')))) as k from doc where regexp_matches(t, '{p}')"
    for rank, kind, p, group in _KINDS
)
_OP13 = f"""
with doc as (
    select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
found as ({_MATCHES}),
owners as (
    select v, count(distinct coalesce(source, chr(0))) as n from found join doc using (r) group by v),
placed as (
    select *, z - length(m) as a, len(list_distinct(string_split(v, ''))) >= 10
        and regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Za-z]') as looks
    from (select *, sum(length(gap) + length(m)) over (partition by r, kind order by k) as z from found)),
base as (select * from placed where kind <> 'live' and (kind <> 'assign' or length(v) >= 6)),
own as (
    select * from placed x where kind = 'live' and looks and not exists (
        select 1 from base b where b.r = x.r and b.a < x.z and x.a < b.z)),
spans as (
    select r, kind, rank, a, kind || ':' || cast(a as bigint) || ':' || cast(z as bigint) as s, looks, n
    from (select * from base union all select * from own) join owners using (v)
    where kind <> 'live' or n <= 2),
told as (
    select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
        count(*) filter (kind = 'hex') as n_hex,
        string_agg(s, ',' order by a, rank) filter (kind <> 'live') as base,
        string_agg(s, ',' order by a, rank) as spans,
        count(*) filter (kind <> 'live' and n > 2) as n_examples,
        count(*) filter (kind <> 'live' and n <= 2 and looks) as n_live
    from spans group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
    coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
    coalesce(spans, '') as spans, coalesce(n_examples, 0) as n_examples, coalesce(n_live, 0) as n_live
from doc left join told using (r)
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": _OP1,
    "op4_substring_dedup": _OP4,
    "op5_quality_rules": _OP5,
    "op9_warc": _OP9,
    "op11_hard_negatives": _OP11,
    "op12_fill_in_middle": _OP12,
    "op13_secret_scan": _OP13,
}
