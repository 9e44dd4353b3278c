"""SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

from millrace.llm import hosts, mixing
from millrace.llm.queries import RULES

CONTENT_SORT = r"""
with d as (select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as t from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by t) as group_size, row_number() over w = 1 as kept, sha256(t) as text_sha256
from d window w as (partition by t order by chars desc, doc_id rows between unbounded preceding and unbounded following)
"""

_HASH = f"cast('0x' || substr(md5({{0}}), 1, {mixing.DIGITS}) as bigint) / cast({16**mixing.DIGITS} as double)"
MIXING = f"""
with r as (select source, count(*) as n, sum(count(*)) over () / cast(count(*) over () as double) / count(*) as rate from documents group by source),
p as (select source, unnest(range(0, cast(ceil(rate + 12 * sqrt(rate) + 40) as bigint) + 1)) as i, rate from r),
c as (select source, i, sum(exp(-rate + i * ln(rate) - lgamma(i + 1))) over (partition by source order by i) as cdf from p),
d as (select *, {_HASH.format(f"'{mixing.SEED}:' || doc_id")} as u from documents),
k as (select d.doc_id, (select count(*) from c where c.source = d.source and c.cdf <= d.u) as copies from d),
x as (select doc_id, unnest(range(1, copies + 1)) as copy from k where copies > 0)
select d.doc_id, d.text, d.lang, d.source, d.n_chars, cast(x.copy as integer) as copy, {_HASH.format(f"'{mixing.SEED}-place:' || d.doc_id || ':' || x.copy")} as place
from x join d using (doc_id)
"""


PHRASES = r"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
s as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
p as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from s),
t as (select lang, sum(len(w)) as n from p group by lang),
i as (select lang, w, unnest(range(1, len(w) + 1)) as i from p),
g as (select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase from i, (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(w)),
f as (select lang, k, phrase, count(*) as a from g group by all having count(*) >= 30),
c as (select lang, k, phrase, a, string_split(phrase, ' ') as w from f where k > 1),
u as (select lang, k, phrase, a, w, unnest(range(1, k)) as cut from c),
b as (select u.lang, u.phrase, u.a, u.cut, l.a as l, r.a as r, (2000000 * cast(u.a as hugeint)) // (l.a + r.a) as score
  from u join f l on l.lang = u.lang and l.phrase = array_to_string(list_slice(w, 1, cut), ' ') join f r on r.lang = u.lang and r.phrase = array_to_string(list_slice(w, cut + 1, u.k), ' ')),
e as (select * from b qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
v as (select lang, a, k, w, unnest(range(2, k)) as s from c where k > 2),
y as (select lang, a, w, k, s, unnest(range(1, k - s + 2)) as i from v),
x as (select lang, array_to_string(list_slice(w, i, i + s - 1), ' ') as phrase, max(a) as longer from y group by all),
z as (select e.* from e left join x using (lang, phrase) where longer is null or 100 * cast(longer as hugeint) < 80 * cast(a as hugeint)),
o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from z)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from o join t using (lang) where rank <= 2000
"""



def _vector_codes() -> str:
    """Five assignments with four updates between them, each distance by the components; ``vec_id`` is unique in the table."""
    steps = [
        """v as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as z from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0)""",
        "p as (select vec_id, label, part, list_slice(z, part * len(z) // 4 + 1, (part + 1) * len(z) // 4) as w from v, (select unnest([0, 1, 2, 3]) as part))",
        "b0 as (select part, row_number() over (partition by part order by vec_id) - 1 as e, w as c from p qualify row_number() over (partition by part order by vec_id) <= 256)",
    ]
    for i in range(5):
        steps.append(f"d{i} as (select vec_id, label, part, e, w, list_sum(list_transform(list_zip(w, c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) as far from p join b{i} using (part))")
        steps.append(f"a{i} as (select * from d{i} qualify row_number() over (partition by vec_id, part order by far, e) = 1)")
        if i < 4:
            steps.append(f"u{i} as (select part, e, unnest(w) as x, unnest(range(1, len(w) + 1)) as pos from a{i})")
            steps.append(f"s{i} as (select part, e, pos, cast(sum(x) as bigint) as s, count(*) as n from u{i} group by all)")
            steps.append(f"m{i} as (select part, e, list((s - ((s % n) + n) % n) // n order by pos) as c from s{i} group by all)")
            steps.append(f"b{i + 1} as (select part, e, coalesce(m{i}.c, b{i}.c) as c from b{i} left join m{i} using (part, e))")
    steps.append("h as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, e)) as codebooks_sha256 from b4)")
    steps.append("r as (select vec_id, label, string_agg(format('{:02x}', e), '' order by part) as code, sum(far) as error from a4 group by all)")
    return f"with {', '.join(steps)} select vec_id, code, cast(error as bigint) as error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from r, h"


def _url_filter() -> str:
    rule = "case " + " ".join(
        f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{v}|{h}{p}'" for v, h, p in sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    ) + " end"

    def level(name: str, own: str, above: str, members: str, parents: str) -> str:
        lo, hi = hosts.SCATTER
        return f"""
{name}_j as (select m.*, p.prior from {members} m join {parents} p using ({above})),
{name}_i as (select {above}, count(*) c, sum(n) al, sum(cast(n as double) * n) sq, sum(n * pow(k / n - prior, 2)) sp, sum(n * prior * (1 - prior)) no from {name}_j where n > 0 group by {above}),
{name}_t as (select sum(c - 1) fr, sum(al) al, sum(sq / al) sh, sum(sp) sp, sum(no) no from {name}_i),
{name}_s as (select 1 / (case when no / al * (al - sh - fr) > 0 then least(greatest((sp - no / al * fr) / (no / al * (al - sh - fr)), {lo}), {hi}) else {hi} end) - 1 as st from {name}_t),
{name} as (select {own}, st * prior + k as a, st * (1 - prior) + n - k as b, (st * prior + k) / (st + n) as prior from {name}_j, {name}_s)"""

    return f"""
with u as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path from pages),
o as (select u.page_id, case when quality = 1 and toxic = 0 then 1 else 0 end as good from u join labels on doc_id = try_cast(regexp_extract(path, '^/[a-z]+/([0-9]{{1,18}})', 1) as bigint)),
hc as (select host, count(good) as n, coalesce(sum(good), 0) as k, regexp_replace(host, ':[0-9]*$', '') as bare from u left join o using (page_id) group by host),
hosts as (select *, case when contains(bare, '.') then array_to_string(list_slice(string_split(bare, '.'), -2, -1), '.') else bare end as domain from hc),
domains as (select domain, sum(n) as n, sum(k) as k, string_split(domain, '.')[-1] as suffix from hosts group by domain),
suffixes as (select suffix, sum(n) as n, sum(k) as k, 0 as root from domains group by suffix),
top as (select root, (sum(k) + 1) / (sum(n) + 2) as prior from suffixes group by root),
{level("s", "suffix", "root", "suffixes", "top")},
{level("d", "domain", "suffix", "domains", "s")},
{level("h", "host", "domain", "hosts", "d")},
b as (select host, prior - {hosts.Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from h),
r as (select page_id, host, path, {rule} as found, bound from u join b using (host))
select page_id, host, path, split_part(found, '|', 2) as rule, case when found is not null then split_part(found, '|', 1) when bound >= {hosts.LIMIT} then 'allow' else 'block' end as verdict from r
"""


ORACLES = {"op4_mixing": MIXING, "op5_content_sort": CONTENT_SORT, "op10_url_filter": _url_filter(), "op11_vector_codes": _vector_codes(), "op13_phrases": PHRASES}
