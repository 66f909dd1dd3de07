"""What DuckDB says for the operators that SQL can express."""

from __future__ import annotations

from . import chat
from .quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)}))


def _limits() -> str:
    """The table of rules as SQL over the counts."""
    out = []
    for _, ratio, least, most in RULES:
        top, bottom = ratio.split(" / ")
        value = f"({top} / nullif({bottom}, 0))"
        out += [f"coalesce({value} >= {least}, true)"] * (least is not None) + [f"coalesce({value} <= {most}, true)"] * (most is not None)
    return " and ".join(out)


QUALITY_RULES = rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
tri as (select doc_id, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
rep as (select doc_id, i from tri qualify count(*) over (partition by doc_id, a, b, c) > 1),
cov as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from rep) group by 1),
k as (select w.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
  coalesce(cov.n, 0) as n_repeat_words, len(ls) as n_lines, len(list_filter(ws, lambda x: list_contains([{_STOPS}], x))) as n_stop_words, length(t) - length(replace(t, '!', '')) as n_exclamations from w left join cov using (doc_id)),
b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from k)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed, not base_failed and {_limits()} as kept from b
"""

NEAR_DUPLICATES = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
c as (select a.doc_id as a, b.doc_id as b, count(*) as hits from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * hits >= 75 * (x.n + y.n - hits)),
e as (select a, b from l union all select b, a from l),
reach as (select doc_id as id, doc_id as other from documents union select reach.id, e.b from reach join e on e.a = reach.other),
m as (select id, min(other) as component_id from reach group by 1)
select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept from documents d left join n using (doc_id) join m on m.id = d.doc_id
"""

EMBEDDINGS = """
with recursive v as (select vec_id, label, embedding::double[] as e, list_dot_product(embedding::double[], embedding::double[]) as q from embeddings where embedding is not null and label is not null),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where a.q > 0 and b.q > 0 and list_dot_product(a.e, b.e) / sqrt(a.q * b.q) >= 0.98),
reach as (select vec_id as id, vec_id as other from embeddings union select reach.id, l.b from reach join l on l.a = reach.other),
m as (select id, min(other) as component_id from reach group by 1), n as (select a as vec_id, count(*) as n from l group by 1)
select e.vec_id, coalesce(n.n, 0) as n_links, component_id, e.vec_id = component_id as kept from embeddings e join m on m.id = e.vec_id left join n on n.vec_id = e.vec_id
"""

ORACLES = {"op5_preference_format": chat.ORACLE, "op8_minhash_near_dedup": NEAR_DUPLICATES, "op9_embedding_near_dedup": EMBEDDINGS, "op10_quality_rules": QUALITY_RULES}
