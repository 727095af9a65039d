"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from textlens.llm import mixing

_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+')"
_ASCII_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                r"'[^\x20\x09-\x0D]+')")
_RAW_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _shingled(table: str, key: str, name: str, words: str = _WORDS) -> str:
    return f"""{name}_w as (select {key}, {words} as w from {table}),
{name} as (select distinct {key}, array_to_string(list_slice(w, i, i + 4), ' ') as s
  from (select {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from {name}_w where len(w) > 0))"""


#: More than raking needs on any of the tables to bring every marginal to its target.
SWEEPS = 60


def _op1() -> str:
    topic = "case when text is null then 'none' " + " ".join(
        f"when contains(text, '{mark}') then '{t}'" for t, mark in mixing.TOPIC_MARKS) + " else 'prose' end"
    dims = ("source", "lang", "topic")
    ctes = [f"""d as (select doc_id, source, lang, {topic} as topic, greatest(len({_RAW_WORDS}), 1) as tokens from documents)""",
            "c as (select source, lang, topic, sum(tokens)::bigint as tokens from d group by all)"]
    for dim in dims:
        t = mixing.TARGETS[dim]
        ctes.append(f"h_{dim} as (select {dim}, sum(tokens) as have from c group by all)")
        if isinstance(t, dict):
            given = "case " + " ".join(f"when {dim} = '{k}' then {v}" for k, v in t.items()) + " end"
            ctes.append(f"g_{dim} as (select {dim}, have, {given} as given from h_{dim})")
            ctes.append(f"""r_{dim} as (select {dim}, coalesce(given, greatest(0, 1 - coalesce((select sum(given) from g_{dim}), 0))
  * have / (select sum(have) from g_{dim} where given is null)) as raw from g_{dim})""")
        else:
            ctes.append(f"r_{dim} as (select {dim}, pow(have, {t}) as raw from h_{dim})")
        ctes.append(f"t_{dim} as (select {dim}, raw / sum(raw) over () as want_{dim} from r_{dim})")
    ctes.append("x0 as materialized (select c.*, want_source, want_lang, want_topic, tokens::double as weight from c "
                + " ".join(f"join t_{x} on c.{x} is not distinct from t_{x}.{x}" for x in dims) + ")")
    n = 0
    for _ in range(SWEEPS):
        for dim in dims:
            ctes.append(f"""x{n + 1} as materialized (select * exclude (weight), case when sum(weight) over (partition by {dim}) > 0
  then weight * want_{dim} / sum(weight) over (partition by {dim}) else 0 end as weight from x{n})""")
            n += 1
    ctes.append(f"s0 as materialized (select {mixing.BUDGET} * sum(tokens) / sum(weight) as scale from x{n})")
    for k in range(12):
        ctes.append(f"""s{k + 1} as materialized (select coalesce(greatest(any_value(scale), ({mixing.BUDGET} * sum(tokens)
  - coalesce(sum(tokens) filter (weight * scale >= tokens), 0)) / sum(weight) filter (weight * scale < tokens)), any_value(scale)) as scale
  from x{n}, s{k})""")
    ctes.append(f"p as (select source, lang, topic, least(1.0, weight * scale / tokens) as p from x{n}, s12)")
    return "with " + ",\n".join(ctes) + f"""
select d.doc_id, d.source, d.lang, d.topic, d.tokens::bigint as tokens, round(p.p, 6) as p,
  cast('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.doc_id::varchar, '')), 1, 13) as bigint) / 4503599627370496.0 < p.p as kept
from d join p on d.source is not distinct from p.source and d.lang is not distinct from p.lang and d.topic = p.topic"""


#: Embeddings that take part in operators 11 and 12, as whole numbers.
_WHOLE = """list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""

_OP13 = r"""with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
f as (select doc_id, part, (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * (doc_id > min(doc_id) over (partition by text))::int as fails,
    coalesce(doc_id in (select doc_id from labels where quality = 1), false) as good,
    coalesce(doc_id in (select doc_id from labels where toxic = 1), false) as toxic from t),
c as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by all),
l as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as l(name, bit)),
o as (select a.name || b.name || c.name || d.name || e.name as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from l a join l b on b.bit <> a.bit join l c on c.bit not in (a.bit, b.bit) join l d on d.bit not in (a.bit, b.bit, c.bit)
  join l e on e.bit not in (a.bit, b.bit, c.bit, d.bit)),
s as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[:step - 1]), 0)::int as before
  from (select *, unnest(range(1, 6)) as step from o)),
r as (select part, filter_order, step, bit,
    coalesce(sum(n) filter (fails & (before | bit) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (fails & before = 0 and fails & bit > 0), 0)::bigint as removed,
    coalesce(sum(n) filter (fails & before > 0 and fails & bit > 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (fails = bit), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (fails & before = 0 and fails & bit > 0), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (fails & before = 0 and fails & bit > 0), 0)::bigint as toxic_lost
  from c cross join s group by part, filter_order, step, bit)
select * exclude (bit), sum(removed) over (partition by part, bit)::bigint as shapley from r"""

_COMPONENTS = """reach(a, b) as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
comp as (select a as id, least(a, min(b)) as component_id from reach group by a)"""

ORACLES = {
    "op1_mixing": _op1(),
    "op3_embedding_near_dedup": f"""with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null),
links as (select x.vec_id as a, y.vec_id as b from v x join v y on x.label = y.label and x.vec_id <> y.vec_id
  and list_cosine_similarity(x.e, y.e) >= 0.93),
{_COMPONENTS}, n as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n.n, 0) as n_links, coalesce(component_id, vec_id) as component_id,
  coalesce(component_id, vec_id) = vec_id as kept
from embeddings left join n on n.a = vec_id left join comp on comp.id = vec_id""",
    "op6_substring_dedup": f"""with w as (select doc_id, {_RAW_WORDS} as w from documents),
g as (select doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') as s
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from w where len(w) >= 50)),
f as (select s, min(doc_id) as first from g group by s),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as i from g join f using (s) where f.first < doc_id),
n as (select doc_id, count(*) as n from gone group by doc_id),
k as (select doc_id, string_agg(x, ' ' order by i) as kept from (select doc_id, i, w[i] as x from
  (select doc_id, w, unnest(range(1, len(w) + 1)) as i from w)) anti join gone using (doc_id, i) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join n using (doc_id) left join k using (doc_id)""",
    "op7_ngram_jaccard": f"""with recursive {_shingled("documents", "doc_id", "sh", _ASCII_WORDS)},
sz as (select doc_id, count(*) as n from sh group by doc_id),
c as (select x.doc_id as a, y.doc_id as b, count(*) as k from sh x join sh y on x.s = y.s and x.doc_id <> y.doc_id group by all),
links as (select a, b from c join sz p on p.doc_id = a join sz q on q.doc_id = b where 100 * k >= 75 * (p.n + q.n - k)),
{_COMPONENTS}
select d.doc_id, coalesce(sz.n, 0) as n_shingles, coalesce(component_id, d.doc_id) as component_id
from documents d left join sz using (doc_id) left join comp on comp.id = d.doc_id""",
    "op9_decontamination": f"""with {_shingled("documents", "doc_id", "ds")}, {_shingled("benchmark", "item_id", "bs")},
n as (select item_id, count(*) as n_item from bs group by item_id),
k as (select doc_id, item_id, count(*) as n_common from ds join bs using (s) group by all)
select doc_id, item_id, n_item, n_common, round(n_common / n_item, 6) as containment
from k join n using (item_id) where 100 * n_common >= 75 * n_item""",
    "op11_topk_search": f"""with v as (select vec_id, {_WHOLE}),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score from v q join v c on q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s
qualify rank <= 5""",
    "op12_hard_negatives": f"""with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  {_WHOLE} and label is not null),
s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.e, c.e)::bigint as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id, row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id)::int as rank,
  s.vec_id as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
qualify rank <= 3""",
    "op13_filter_audit": _OP13,
}
