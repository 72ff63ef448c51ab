"""DuckDB counterparts of the queries that SQL can express."""

ORACLES: dict[str, str] = {}

_SPLIT = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES["op9_bloom_dedup"] = f"""
with t as (
  select doc_id, sha256(translate(coalesce(text, ''), {_UPPER})) as text_sha256 from documents
), g as (
  select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by 1
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from t join g using (text_sha256)
"""

ORACLES["op7_ngram_join"] = f"""
with recursive t as (
  select doc_id, string_split_regex(trim(regexp_replace(translate(coalesce(text, ''), {_UPPER}),
    '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '), ' ') as w from documents
), s as (
  select doc_id, list_distinct(case when len(w) >= 5
    then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    when w = [''] then [] else [array_to_string(w, ' ')] end) as sh from t
), e as (select doc_id, unnest(sh) as h from s
), f as (select h from e group by h having count(*) > 1
), i as (
  select a.doc_id as a, b.doc_id as b, count(*) as common from e a join f using (h) join e b using (h)
  where a.doc_id <> b.doc_id group by 1, 2
), l as (
  select a, b from i join s x on x.doc_id = a join s y on y.doc_id = b
  where 100 * common >= 80 * (len(x.sh) + len(y.sh) - common)
), r as (
  select doc_id as start, doc_id as node from s union select r.start, l.b from r join l on l.a = r.node
)
select s.doc_id, len(s.sh)::bigint as n_shingles, min(r.node) as component_id
from s join r on r.start = s.doc_id group by s.doc_id, s.sh
"""

ORACLES["op5_line_rules"] = r"""
with d as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents
), w as (
  select *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from d
), tri as (
  select r, i, w[i:i+2] as g from (select r, w, unnest(range(1, len(w) - 1)) as i from w)
), rep as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from tri) where n > 1
), cov as (
  select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from rep) group by r
), raw as (
  select r, source, t, unnest(string_split(t, chr(10))) as line from d
), ln as (
  select r, source, t, line, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm from raw
), lines as (select * from ln where norm <> ''
), dup as (select r, count(*) - count(distinct line) as n from lines group by r
), freq as (
  select source, norm from lines group by 1, 2 having count(distinct t) > 10
), lost as (
  select r, sum(len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) as n
  from lines join freq on lines.source is not distinct from freq.source and lines.norm = freq.norm group by r
), f as (
  select doc_id, len(w)::bigint as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
    coalesce(dup.n, 0)::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words,
    coalesce(lost.n, 0)::bigint as removed_words
  from w left join dup using (r) left join cov using (r) left join lost using (r)
), b as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f
)
select *, not base_failed and removed_words * 100 <= n_words * 50 as kept from b
"""

ORACLES["op2_chat"] = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), p as (
  select *, contains(text, '</turn>') or contains(text, '### ') as esc,
    case when regexp_full_match(role, '[a-z]+') then role else to_json(role)::varchar end as named from c
), f as (
  select *, length(named) + 4 + if(esc, 1, 0) + 2 + 8 + length(if(esc, replace(replace(replace(
    text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## '), text)) as chars from p
), g as (
  select conv_id, count(*) as n_turns, sum(chars)::bigint as formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as whole,
    coalesce(string_agg(if(role = 'assistant', text, ''), '' order by turn, role, text), '') as loss
  from f group by conv_id
)
select conv_id, n_turns, sha256(whole) as turns_sha256, length(loss)::bigint as loss_chars,
  sha256(loss) as loss_sha256, formatted_chars from g
"""

ORACLES["op6_warc"] = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages
), d as (
  select page_id, payload_bytes, min(page_id) over (partition by h) as first_id,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(h, ((i // 4) * 5 + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)), '')
      as payload_digest from p
)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  if(page_id = first_id, 'response', 'revisit') as record_type,
  if(page_id = first_id, null, first_id) as refers_to from d
"""


def _license_sql() -> str:
    from idweave.llm.license_rules import RULES, SENTENCES

    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    # line ends and cuts are doubled, so that each of two neighbours has one of its own
    longest_first = "|".join(s.replace(" ", r"(?: |\n\n)") for s in sorted(SENTENCES, key=len, reverse=True))
    steps = ["rest0 as (select r, doc_id, ids as rest, n, []::varchar[] as found from seq)"]
    for k, (name, ids) in enumerate(RULES, start=1):
        want = "".join(f"<{i}>" for i in ids)
        steps.append(
            f"rest{k} as (select r, doc_id, n, replace(rest, '{want}', '<>') as rest, "
            f"if(contains(rest, '{want}') and not list_contains(found, '{name}'), "
            f"list_append(found, '{name}'), found) as found from rest{k - 1})"
        )
    return rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), known(norm, id) as (values {known}
), marks as (
  select r, regexp_replace(translate(translate(t, {_UPPER}), '|', ' '), '(^|\n)[^a-z0-9\n]+', '\1', 'g') as t from d
), cut as (
  select r, regexp_replace(regexp_replace(t, '\n\n+', '|', 'g'), '[.!?;:]([\x20\x09-\x0D]|$)', '|\1', 'g') as t from marks
), flat as (
  select r, trim(regexp_replace(regexp_replace(t, '[^a-z0-9\n|]+', ' ', 'g'), ' ?([\n|]) ?', '\1\1', 'g'), ' ') as t from cut
), runs as (
  select r, regexp_extract_all('|' || t || '|', '[\n|](?:{longest_first})[\n|]') as s from flat
), sent as (
  select r, i, replace(trim(s[i], chr(10) || '|'), chr(10) || chr(10), ' ') as norm
  from (select r, s, unnest(range(1, len(s) + 1)) as i from runs)
), hit as (
  select r, string_agg('<' || id || '>', '' order by i) as ids, count(*) as n from sent join known using (norm) group by r
), seq as (
  select r, doc_id, coalesce(ids, '') as ids, coalesce(n, 0)::bigint as n from d left join hit using (r)
), {", ".join(steps)}
select seq.doc_id, seq.ids as sentence_ids, array_to_string(found, ',') as licenses, seq.n as n_sentences,
  len(regexp_extract_all(rest, '<[^>]+>'))::bigint as n_unmatched
from rest{len(RULES)} as last join seq using (r)
"""


ORACLES["op1_license_rules"] = _license_sql()

ORACLES["op11_collocations"] = rf"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), {_UPPER}), '[.,;:!?\n\x0B\x0C\r]')) as piece from documents
), w as (
  select lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') as w from p
), one as (select lang, w1, count(*) as f from (select lang, unnest(w) as w1 from w) group by all
), n as (select lang, sum(f)::bigint as n from one group by 1
), two as (
  select lang, x[1] as w1, x[2] as w2, count(*) as f
  from (select lang, unnest(list_zip(w[:-2], w[2:])) as x from w where len(w) > 1) group by all having f >= 10
), three as (
  select lang, x[1] as w1, x[2] as w2, x[3] as w3, count(*) as f
  from (select lang, unnest(list_zip(w[:-3], w[2:-2], w[3:])) as x from w where len(w) > 2) group by all having f >= 10
), cuts as (
  select t.lang, t.w1, t.w2, null as w3, t.f as a, 1 as k, l.f as l, r.f as r
  from two t join one l using (lang, w1) join one r on r.lang = t.lang and r.w1 = t.w2
  union all
  select t.lang, t.w1, t.w2, t.w3, t.f, 1, l.f, r.f
  from three t join one l using (lang, w1) join two r on r.lang = t.lang and r.w1 = t.w2 and r.w2 = t.w3
  union all
  select t.lang, t.w1, t.w2, t.w3, t.f, 2, l.f, r.f
  from three t join two l using (lang, w1, w2) join one r on r.lang = t.lang and r.w1 = t.w3
), scored as (
  select *, (1000000::hugeint * a * a // (l::hugeint * r))::bigint as score from cuts
  qualify row_number() over (partition by lang, w1, w2, w3 order by score, k) = 1
), longer as (
  select lang, w1, w2, max(f) as around
  from (select lang, w1, w2, f from three union all select lang, w2, w3, f from three) group by all
), kept as (
  select s.lang, concat_ws(' ', s.w1, s.w2, s.w3) as phrase, a, l, r, score
  from scored s left join longer g on s.w3 is null and g.lang = s.lang and g.w1 = s.w1 and g.w2 = s.w2
  where around is null or 100 * around < 50 * a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join n using (lang) qualify rank <= 2000
"""

ORACLES["op13_hard_negatives"] = """
with v as (
  select distinct on (vec_id) vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  order by vec_id, label, embedding
), s as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    list_dot_product(a.v, b.v)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0
), p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select anchor_id, positive_id, (row_number() over w)::int as rank, other_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= 10
"""
