"""SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WARC = """
with hashed as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes,
        sha1(coalesce(html, '')) as hex
    from pages
),
newest as (
    select hex, max(page_id) as target from hashed group by hex
),
coded as (
    select hex, target,
        array_to_string(list_transform(
            range(32),
            lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((
                ('0x' || substr(hex, 5 * (k // 4) + 1, 5))::bigint >> (15 - 5 * (k % 4))::bigint
            ) & 31) + 1, 1)
        ), ''
        ) as payload_digest
    from newest
)
select page_id, payload_bytes, payload_digest,
    case when page_id = target then 'response' else 'revisit' end as record_type,
    case when page_id = target then null else target end as refers_to
from hashed join coded using (hex)
"""

DECONTAMINATION = f"""
with item_words as (
    select item_id, regexp_extract_all({_LOWER.format("text")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from benchmark
),
passages as (
    select distinct item_id, w[i : i + least(len(w), 13) - 1] as passage
    from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i
          from item_words where len(w) > 0)
),
doc_words as (
    select doc_id, coalesce(regexp_extract_all({_LOWER.format("text")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w
    from documents
),
lengths as (select distinct len(passage) as n from passages),
places as (
    select doc_id, i, n, w[i : i + n - 1] as passage
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
          from doc_words, lengths where len(w) >= n)
),
found as (
    select doc_id, i, n, item_id from places join passages using (passage)
),
hits as (
    select doc_id, count(distinct k) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as k
          from (select distinct doc_id, i, n from found))
    group by doc_id
),
names as (
    select doc_id, count(distinct item_id) as n_items,
        string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
    from found group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from doc_words left join hits using (doc_id) left join names using (doc_id)
"""

CHAT = """
with turns as (
    select conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') as role,
        replace(coalesce(text, ''), '<|', '< |') as text,
        cast(coalesce(floor(turn / 256), 0) as bigint) as part
    from conversations
),
speakers as (
    select distinct conv_id, role as speaker from turns where role <> 'system'
),
views as (
    select t.conv_id, speaker, part, turn, role, text,
        '<|im_start|>' || case when role = 'system' then role when role = speaker then 'assistant'
            else 'user name=' || role end || chr(10) as head
    from turns t join speakers s on t.conv_id is not distinct from s.conv_id
),
placed as (
    select *, head || text || '<|im_end|>' || chr(10) as body,
        sum(length(head) + length(text) + 11) over (
            partition by conv_id, speaker, part order by turn nulls first, role, text
            rows unbounded preceding) as after
    from views
)
select conv_id, speaker, part, cast(count(*) as integer) as n_turns,
    string_agg(body, '' order by turn nulls first, role, text) as rendered,
    coalesce(string_agg(
        cast(after - length(text) - 11 as bigint) || '-' || cast(after as bigint), ','
        order by turn nulls first, role, text) filter (role = speaker), '') as mask
from placed
group by conv_id, speaker, part
"""

RULES = r"""
with texts as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
),
words as (
    select r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from texts
),
windows as (
    select r, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) as gram
    from (select r, w, unnest(range(1, len(w) - 1)) as i from words where len(w) >= 3)
),
again as (
    select r, unnest(starts) as i
    from (select r, list(i) as starts from windows group by r, gram having count(*) > 1)
),
repeat_words as (
    select r, count(distinct k) as n
    from (select r, unnest([i, i + 1, i + 2]) as k from again) group by r
),
lines as (
    select r, unnest(string_split(text, chr(10))) as line from texts
),
dup_lines as (
    select r, count(*) - count(distinct line) as n from lines
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by r
),
pieces as (
    select r, first, substr(text, first, 1039) as piece
    from (select r, text, unnest(range(1, length(text) - 38, 1000)) as first from texts)
),
strings as (
    select r, first + k - 1 as i, substr(piece, k, 40) as s
    from (select r, first, piece, unnest(range(1, length(piece) - 38)) as k from pieces)
),
repeats as (
    select r, unnest(starts) as i
    from (select r, list(i) as starts from strings group by r, s having count(*) > 1)
),
covered as (
    select r, sum(least(coalesce(after, i + 40), i + 40) - i) as n
    from (select r, i, lead(i) over (partition by r order by i) as after from repeats)
    group by r
),
long_repeats as (
    select distinct r from (
        select r, substr(text, i, 401) as s
        from (select r, text, unnest(range(1, length(text) - 399)) as i
              from texts where r in (select r from covered where n > 400))
    ) group by r, s having count(*) > 1
),
counted as (
    select doc_id, r, cast(len(w) as bigint) as n_words,
        cast(length(array_to_string(w, '')) as bigint) as word_chars,
        cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(coalesce(dup_lines.n, 0) as bigint) as n_dup_lines,
        cast(coalesce(repeat_words.n, 0) as bigint) as n_repeat_words,
        100 * coalesce(covered.n, 0) <= 30 * length(text)
            and r not in (select r from long_repeats) as good
    from texts join words using (r) left join dup_lines using (r)
    left join repeat_words using (r) left join covered using (r)
),
failed as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and good as kept
from failed
"""

RESAMPLING = rf"""
with crc_table as (
    select list_transform(range(256), lambda b:
        list_reduce(list_prepend(b, range(8)), lambda c, k:
            case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crcs
),
texts as (
    select row_number() over () as r, doc_id, regexp_extract_all(
        {_LOWER.format("text")},
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
),
own as (
    select r, word, count(*) as n from (select r, unnest(w) as word from texts) group by r, word
),
wanted as (
    select word, count(*) as n from (select unnest(regexp_extract_all(
        {_LOWER.format("text")},
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark) group by word
),
words as (select word from own union select word from wanted),
hashed as (
    select word, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(0, strlen(word)), lambda i:
            ('0x' || substr(hex(encode(word)), cast(2 * i + 1 as bigint), 2))::bigint)),
        lambda c, byte: xor(c >> 8, crcs[cast((xor(c, byte) & 255) + 1 as bigint)])
        ), 4294967295) % 10000 as bucket
    from words, crc_table
),
source as (select bucket, sum(n) as s from own join hashed using (word) group by bucket),
target as (select bucket, sum(n) as t from wanted join hashed using (word) group by bucket),
gains as (
    select bucket, cast(floor(1000 * ln(
        cast(coalesce(t, 0) + 1 as double) * cast((select coalesce(sum(s), 0) from source) + 10000 as double)
        / (cast(s + 1 as double) * cast((select coalesce(sum(t), 0) from target) + 10000 as double))
    )) as bigint) as gain
    from source left join target using (bucket)
),
weights as (
    select r, sum(n * gain) as weight
    from own join hashed using (word) join gains using (bucket) group by r
),
scored as (
    select doc_id, r, cast(coalesce(len(w), 0) as bigint) as n_features,
        cast(coalesce(weight, 0) as bigint) as weight,
        cast(coalesce(weight, 0) as bigint) + cast(floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double)
            / 4294967296::double))) as bigint) as score
    from texts left join weights using (r)
),
ranked as (
    select r, row_number() over (order by score desc, doc_id) as rank from scored
    where n_features >= 20
)
select doc_id, n_features, weight, score,
    case when rank <= (select count(*) from ranked) * 10 // 100 then rank end as rank
from scored left join ranked using (r)
"""

ORACLES = {
    "op4_warc": WARC,
    "op7_chat": CHAT,
    "op10_decontamination": DECONTAMINATION,
    "op12_quality_rules": RULES,
    "op13_resampling": RESAMPLING,
}
