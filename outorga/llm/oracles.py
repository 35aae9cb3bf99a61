"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from outorga.llm.licences import BASE, MORE

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(string_split_regex(" + _LOWER.format("coalesce(text, '')") + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_ONE = f"""
with d as (select row_number() over () r, doc_id, {_WORDS} w from documents),
b as (select item_id::varchar item, {_WORDS} w from benchmark where item_id is not null),
g as (select distinct item, len(c) k, array_to_string(c, ' ') t from (
  select item, unnest([w[i:i + 12] for i in range(1, greatest(len(w) - 12, 1) + 1)]) c from b where len(w) > 0)),
k as (select distinct k from g),
s as (select r, w, k, unnest(range(1, len(w) - k + 2)) i from d, k where len(w) >= k),
h as (select r, i, s.k, item from s join g on s.k = g.k and array_to_string(w[i:i + s.k - 1], ' ') = g.t),
n as (select r, count(distinct p) n_hit from (select r, unnest(range(i, i + k)) p from h) group by r),
m as (select r, count(distinct item) n_items, string_agg(distinct item, ',' order by item) items from h group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) contaminated
from d left join n using (r) left join m using (r)
"""

_NINE = """
with p as (select page_id, coalesce(html, '') h from pages),
q as (select page_id, strlen(h) n, sha256(h) d from p),
f as (select d, min(page_id) f, count(*) c from q where n >= 100 group by d)
select page_id, n::bigint payload_bytes, q.d payload_digest,
  case when f.c > 1 and page_id <> f.f then 'revisit' else 'response' end record_type,
  case when f.c > 1 and page_id <> f.f then f.f end refers_to
from q left join f using (d)
"""

_PHRASES = ", ".join(f"({i}, '{p}', '{label}', {len(p.split())}, {str(p in BASE).lower()})" for i, (p, label) in enumerate({**BASE, **MORE}.items()))
_TEN = f"""
with d as (select row_number() over () r, doc_id, {_WORDS} w from documents),
t(i, phrase, label, k, base) as (values {_PHRASES}),
s as (select r, w, unnest(range(1, len(w) + 1)) pos from d where len(w) > 0),
h as (select r, pos - 1 pos, t.* from s join t on w[pos] = split_part(phrase, ' ', 1) and array_to_string(w[pos:pos + k - 1], ' ') = phrase),
p as (select r, count(*) filter (base) n_base, min(pos) filter (base) first_word, max(pos) filter (base) last_word,
  string_agg(distinct label, ',' order by label) filter (base) base_labels, string_agg(distinct label, ',' order by label) labels from h group by r),
v as (select r, sum(k) weight from (select distinct r, i, k from h) group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word::bigint first_word, last_word::bigint last_word,
  coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, (coalesce(weight, 0) / (coalesce(weight, 0) + 2))::double score
from d left join p using (r) left join v using (r)
"""

_ELEVEN = f"""
with d as (select coalesce(lang, 'und') lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) piece from documents),
w as (select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') w from d),
n as (select lang, sum(len(w)) n from w group by lang),
g as (select lang, k, w, unnest(range(1, len(w) - k + 2)) i from w, (values (1), (2), (3), (4)) t(k) where len(w) >= k),
f as (select lang, k, array_to_string(w[i:i + k - 1], ' ') phrase, count(*) f from g group by all having count(*) >= 30),
c as (select lang, k, phrase, f a, string_split(phrase, ' ') w from f where k > 1),
s as (select c.*, i, l.f l, r.f r, 2000000::hugeint * a // (l.f + r.f) score from (select *, unnest(range(1, k)) i from c) c
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.i], ' ') join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.i + 1:c.k], ' ')),
m as (select * from s qualify row_number() over (partition by lang, phrase order by score, i) = 1),
o as (select lang, array_to_string(w[i:i + j - 1], ' ') phrase, max(a) over_a from
  (select *, unnest(range(1, k - j + 2)) i from c, (values (2), (3)) t(j) where j < k) group by all)
select m.lang, row_number() over (partition by m.lang order by score desc, a desc, m.phrase) rank, m.phrase, a, l, r, n::bigint n, score::bigint score
from m left join o on o.lang = m.lang and o.phrase = m.phrase join n on n.lang = m.lang where over_a is null or 100 * over_a < 80 * a
qualify rank <= 2000
"""

_TWELVE = """
with d as (select row_number() over () r, doc_id, coalesce(doc_id, 9223372036854775807) o, string_split(coalesce(text, ''), chr(10)) w from documents),
l as (select r, o, i, w[i] t, translate(trim(w[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k
  from (select *, unnest(range(1, len(w) + 1)) i from d)),
f as (select k, min(o) f from l where length(k) >= 10 group by k),
g as (select r, i, t, length(k) >= 10 and o <> f gone from l left join f using (k)),
s as (select r, count(*) n, count(*) filter (gone) x, coalesce(string_agg(t, chr(10) order by i) filter (not gone or gone is null), '') kept from g group by r)
select doc_id, n::bigint n_lines, x::bigint n_dropped, sha256(kept) kept_sha256 from d join s using (r)
"""

_LETTERS = r"list_filter(string_split_regex(" + _LOWER.format("coalesce(text, '')") + r", '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_THIRTEEN = f"""
with d as (select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source, {_LETTERS} w from documents),
c as (select lang, source, term, count(*) n, count(distinct r) docs from (select r, lang, source, unnest(w) term from d) group by all),
k as (select lang, term, sum(n)::hugeint m from c group by all having sum(docs) >= 10),
g as (select distinct lang, source from d),
v as (select lang, count(*)::hugeint v, sum(m) whole from k group by lang),
s as (select lang, source, sum(n)::hugeint total from c join k using (lang, term) group by all),
e as (select g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint n,
  1 + (1000000000 * (coalesce(c.n, 0)::hugeint + 2)) // (coalesce(s.total, 0) + 2 * v) p, 1 + (1000000000 * (k.m + 2)) // (whole + 2 * v) q
  from g join k using (lang) join v using (lang) left join s on s.lang = g.lang and s.source = g.source
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
x as (select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) value from e a join e b using (lang, term)
  where a.source <> b.source group by all),
y as (select a.lang, a.source, b.source item, coalesce(value, 0) value from g a join g b on a.lang = b.lang and a.source <> b.source
  left join x on x.lang = a.lang and x.source = a.source and x.item = b.source),
t as (select lang, source, term item, (p - q) * (p - q) // (p + q) value from e where n > 0 and p > q),
u as (select lang, source, 'pair' part, item, value, row_number() over (partition by lang, source order by value desc, item) rank from y
  union all select * from (select lang, source, 'term' part, item, value, row_number() over (partition by lang, source order by value desc, item) rank from t) where rank <= 10)
select lang, source, part, item, value::bigint as value, rank::int as rank from u
"""

SQL = {
    "op1_decontamination": _ONE, "op9_warc": _NINE, "op10_licences": _TEN, "op11_collocations": _ELEVEN,
    "op12_line_dedup": _TWELVE, "op13_divergence": _THIRTEEN,
}
