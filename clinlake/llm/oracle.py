"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from clinlake.llm import sharding, url_filter

_CHAT = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, t, case t when 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok' from range(2) r(t)
), said as (
    select *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') as escaped,
        replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') as role_escaped
    from rows
), whole as (
    select conv_id, count(*) as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role_escaped, escaped) as turns,
        coalesce(string_agg(text, '' order by turn nulls first, escaped) filter (where role = 'assistant'), '') as loss,
        sum(length('<|im_start|>') + length(role_escaped) + 1 + length(escaped) + length('<|im_end|>') + 1) as formatted_chars
    from said group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
    cast(formatted_chars as bigint) as formatted_chars, cast(0 as bigint) as n_attachments
from whole
"""


def _urls() -> str:
    parsed = r"""
    select page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
    from pages"""
    fits = sorted(url_filter.RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    test = "when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{x}'"
    rule = " ".join(test.format(h=h, p=p, x=h + p) for _, h, p in fits)
    verdict = " ".join(test.format(h=h, p=p, x=what) for what, h, p in fits)
    words = "|".join(url_filter.LISTED_WORDS)
    return rf"""
with parsed as ({parsed}),
judged as (
    select *, case {rule} end as rule, case {verdict} end as of_rule,
        regexp_matches(host, '(^|\.)([^.]*-)?({words})(-[^.]*)?(\.|$)') as listed
    from parsed
)
select page_id, host, path, rule, coalesce(of_rule, case when listed then 'block' else 'allow' end) as verdict, listed from judged
"""


def _shards() -> str:
    bits = sharding.HASH_BITS
    return f"""
with hashed as (
    select row_number() over () as r, doc_id, coalesce(strlen(text), 0) as n_bytes,
        ('0x' || substr(md5(coalesce(cast(doc_id as varchar), chr(2)) || chr(31) || coalesce(text, chr(2))), 1, {bits // 4}))::bigint as hash
    from documents
), prefixes as (
    select r, d, hash >> ({bits} - d)::int as prefix, n_bytes from hashed, range(31) t(d)
), fit as (
    select d, prefix from prefixes group by d, prefix having sum(n_bytes) <= {sharding.QUERY_BYTE_LIMIT}
), leaf as (
    select r, min(d) as depth from prefixes join fit using (d, prefix) group by r
), placed as (
    select doc_id, n_bytes, hash, case when depth = 0 then '' else substr(lpad(bin(hash), {bits}, '0'), 1, depth::int) end as shard, depth::int as depth
    from hashed join leaf using (r)
)
select *, count(*) over (partition by shard) as shard_documents, cast(sum(n_bytes) over (partition by shard) as bigint) as shard_bytes from placed
"""


_PHRASES = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), said as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), places as (
    select lang, w, unnest(range(1, len(w) + 1)) as i from said where len(w) > 0
), counts as (
    select lang, size, phrase, count(*) as f from (
        select lang, size, array_to_string(w[i : i + size - 1], ' ') as phrase
        from places, range(1, 4) t(size) where i + size - 1 <= len(w))
    group by all
), totals as (
    select lang, sum(f)::bigint as n from counts where size = 1 group by lang
), candidates as (
    select lang, size, phrase, f as a, string_split(phrase, ' ') as w from counts where size > 1 and f >= 10
), inside as (
    select lang, phrase, max(a) as longer from (
        select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from candidates where size = 3)
    group by all
), cuts as (
    select c.lang, c.phrase, c.a, k, x.f as l, y.f as r,
        (1000000::hugeint * c.a * c.a // (x.f::hugeint * y.f::hugeint))::bigint as score
    from (select *, unnest(range(1, size)) as k from candidates) c
    join counts x on x.lang = c.lang and x.size = k and x.phrase = array_to_string(w[1:k], ' ')
    join counts y on y.lang = c.lang and y.size = c.size - k and y.phrase = array_to_string(w[k + 1 : c.size], ' ')
), scored as (
    select lang, phrase, a, arg_min(struct_pack(l := l, r := r, score := score), score * 4 + k) as s from cuts
    where not exists (select 1 from inside i where i.lang = cuts.lang and i.phrase = cuts.phrase and 100 * i.longer >= 50 * cuts.a)
    group by all
), ranked as (
    select lang, row_number() over (partition by lang order by s.score desc, a desc, phrase) as rank, phrase, a, s.l as l, s.r as r, s.score as score
    from scored
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_phrase_collocations": _PHRASES, "op5_typed_parts": _CHAT, "op9_extendible_hashing": _shards(), "op10_filter_cascade": _urls()}
