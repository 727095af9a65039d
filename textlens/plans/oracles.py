"""DuckDB SQL that computes the same result as each registered query.

The oracles are written independently of the Spark code (plain SQL with
windows, recursive CTEs and brute-force joins) and share only the fixed
regex literals and the view definitions.
"""

from __future__ import annotations

from textlens.constants import NA_TOKENS
from textlens.functions.text import (EDGE_WS_RE, MENTION_RE, URL_RE, WORD_TOKEN_RE,
                                     WS_RUN_RE)
from textlens.sources.tables import CORPUS_SQL, SCORES_SQL, SPLIT_INPUT_SQL


def clean_sql(expr: str) -> str:
    s = f"regexp_replace({expr}, '{URL_RE}', '', 'g')"
    s = f"regexp_replace({s}, '{MENTION_RE}', '', 'g')"
    s = f"regexp_replace({s}, '{WS_RUN_RE}', ' ', 'g')"
    return f"trim({s})"


def words_sql(expr: str) -> str:
    return f"(case when {expr} = '' then 0 else len(string_split({expr}, ' ')) end)"


def cap_sql(expr: str) -> str:
    return f"(upper(substr({expr}, 1, 1)) || lower(substr({expr}, 2)))"


def _default_map(l: str) -> str:
    return (f"coalesce(case {l} when '0' then 'Positive' when '1' then 'Neutral' "
            f"when '2' then 'Negative' end, case when regexp_matches({l}, '^-?[0-9]+$') then "
            f"case try_cast({l} as bigint) when 0 then 'Positive' when 1 then 'Neutral' "
            f"when 2 then 'Negative' end end, {l})")


def _src4_map(l: str) -> str:
    return (f"coalesce(case {l} when '0' then 'Neutral' when '1' then 'Positive' "
            f"when '2' then 'Negative' end, {l})")


# corpus rows after F1 + label mapping + capitalise + clean (no allow-list yet)
NORMALIZED_CTE = f"""
corpus as ({CORPUS_SQL}),
n0 as (select row_id, source_file, text,
         regexp_replace(label_raw, '{EDGE_WS_RE}', '', 'g') as l
       from corpus where text is not null and label_raw is not null),
n1 as (select row_id, source_file, text,
         case when source_file = 'src4' then {_src4_map('l')} else {_default_map('l')} end as m
       from n0),
normalized as (select row_id, source_file, {clean_sql('text')} as text, {cap_sql('m')} as sentiment
       from n1)
"""

CURATED_CTE = NORMALIZED_CTE + f""",
usable as (select * from normalized where sentiment in ('Positive', 'Neutral', 'Negative')),
long_rows as (select * from usable where {words_sql('text')} >= 4),
ranked as (select *, count(distinct sentiment) over (partition by lower(text)) as nl,
             row_number() over (partition by lower(text) order by row_id) as rn from long_rows),
curated as (select row_id, text, sentiment, source_file,
              cast(case sentiment when 'Positive' then 0 when 'Neutral' then 1 else 2 end as integer) as label_id
            from ranked where nl = 1 and rn = 1)
"""

ORACLES: dict[str, str] = {}

ORACLES["clean_text"] = f"""
select doc_id, {clean_sql('text')} as cleaned, cast({words_sql(clean_sql('text'))} as integer) as n_words
from documents
"""

ORACLES["map_labels"] = "with " + NORMALIZED_CTE + """
select row_id, sentiment, sentiment in ('Positive', 'Neutral', 'Negative') as is_known from normalized
"""

ORACLES["curate_corpus"] = "with " + CURATED_CTE + "select * from curated"

ORACLES["curation_funnel"] = "with " + CURATED_CTE + f""",
keys as (select lower(text) k, count(*) n, count(distinct sentiment) nl from long_rows group by 1)
select (select count(*) from corpus) as n_input,
       (select count(*) from usable) as n_usable,
       (select count(*) from usable where {words_sql('text')} < 4) as n_short,
       (select coalesce(sum(n), 0) from keys where nl > 1)::bigint as n_conflicting,
       (select coalesce(sum(n - 1), 0) from keys where nl = 1)::bigint as n_duplicate,
       (select count(*) from keys where nl = 1) as n_kept
"""

ORACLES["label_distribution"] = "with " + CURATED_CTE + """
select sentiment, count(*) as n from curated group by sentiment
"""

ORACLES["conflicting_texts"] = "with " + CURATED_CTE + """
select lower(text) as text_key, count(*) as n_rows, count(distinct sentiment) as n_labels,
       array_to_string(list_sort(list_distinct(list(sentiment))), ',') as labels
from long_rows group by lower(text) having count(distinct sentiment) > 1
"""

# --- metrics -------------------------------------------------------------------

_LABELS3 = "(values ('Positive', 0), ('Neutral', 1), ('Negative', 2)) as lab(label, id)"
_SCORES = f"scores as ({SCORES_SQL})"

_PER_CLASS = f"""
grid as (select a.label as actual, p.label as predicted from {_LABELS3.replace('lab(', 'a(')}
         cross join {_LABELS3.replace('lab(', 'p(')}),
cm as (select g.actual, g.predicted, count(s.doc_id) as n from grid g
       left join scores s on s.actual = g.actual and s.predicted = g.predicted group by all),
pc as (select l.label, l.id,
         (select sum(n) from cm where actual = l.label and predicted = l.label) as tp,
         (select sum(n) from cm where actual = l.label) as support,
         (select sum(n) from cm where predicted = l.label) as npred
       from {_LABELS3.replace('lab(', 'l(')}),
m as (select label, id, support, npred, tp,
        case when npred > 0 then tp / npred else 0.0 end as precision,
        case when support > 0 then tp / support else 0.0 end as recall,
        case when support + npred > 0 then 2.0 * tp / (support + npred) else 0.0 end as f1
      from pc)
"""

ORACLES["confusion_matrix"] = f"with {_SCORES}, {_PER_CLASS} select actual, predicted, n from cm"

ORACLES["classification_report"] = f"""
with {_SCORES}, {_PER_CLASS},
tot as (select sum(support) as total, sum(tp) as correct from m)
select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
       cast(support as bigint) as support from m
union all select 'accuracy', null::double, null::double,
       round(case when total > 0 then correct / total else 0.0 end, 6), cast(total as bigint) from tot
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       cast((select total from tot) as bigint) from m
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       cast(sum(support) as bigint) from m
"""

ORACLES["epoch_metrics"] = f"""
with {_SCORES},
sl as (select lang as slice, actual, predicted from scores
       union all select 'all', actual, predicted from scores),
per as (select s.slice, l.label,
          count_if(s.actual = l.label and s.predicted = l.label) as tp,
          count_if(s.actual = l.label) as support, count_if(s.predicted = l.label) as npred
        from sl s cross join {_LABELS3.replace('lab(', 'l(')} group by all)
select slice, cast(sum(support) as bigint) as n,
  round(sum(tp) / sum(support), 6) as accuracy,
  round(avg(case when support + npred > 0 then 2.0 * tp / (support + npred) end), 6) as macro_f1
from per group by slice
"""

ORACLES["class_weights"] = "with " + CURATED_CTE + """,
c as (select l.id as label_id, l.label, (select count(*) from curated where label_id = l.id) as n
      from (values ('Positive', 0), ('Neutral', 1), ('Negative', 2)) as l(label, id)),
w as (select *, 1.0 / (case when n > 0 then n else 1 end) as inv from c)
select cast(label_id as integer) as label_id, label, cast(n as bigint) as n,
  round(inv / (select sum(inv) from w) * 3, 6) as inverse_weight,
  round(case when n > 0 then (select sum(n) from w) / ((select count_if(n > 0) from w) * n) end, 6)
    as balanced_weight
from w
"""

RUN_LOG_DUCK = """
run_log as (select user_id as run_id,
  cast(date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as bigint) as epoch,
  avg(case when event_type <> 'view' then value end) / 100.0 as eval_loss,
  avg(value - floor(value)) as eval_accuracy,
  avg(cast(json_extract_string(props, '$.k') as double)) / 100.0 as eval_macro_f1
  from events group by all)
"""

ORACLES["best_epoch"] = f"""
with recursive {RUN_LOG_DUCK},
ev as (select run_id, epoch, eval_macro_f1 as f1,
         row_number() over (partition by run_id order by epoch) as i
       from run_log where eval_loss is not null),
walk(run_id, i, epoch, best, best_epoch, since, stopped) as (
  select run_id, i, epoch, f1, epoch, 0, false from ev where i = 1
  union all
  select w.run_id, e.i, e.epoch,
    case when e.f1 > w.best then e.f1 else w.best end,
    case when e.f1 > w.best then e.epoch else w.best_epoch end,
    case when e.f1 > w.best then 0 else w.since + 1 end,
    (case when e.f1 > w.best then 0 else w.since + 1 end) = 3
  from walk w join ev e on e.run_id = w.run_id and e.i = w.i + 1
  where not w.stopped)
select run_id, count(*) as n_evals, arg_max(best_epoch, i) as best_epoch,
  round(arg_max(best, i), 6) as best_macro_f1, max(case when stopped then epoch end) as stopped_epoch
from walk group by run_id
"""

# --- grouped split ---------------------------------------------------------------

_SPLIT = f"split_input as ({SPLIT_INPUT_SQL})"

ORACLES["group_label_counts"] = f"""
with {_SPLIT} select dup_group, count_if(label_id = 0) as c0, count_if(label_id = 1) as c1,
  count_if(label_id = 2) as c2 from split_input group by dup_group
"""

ORACLES["split_targets"] = f"""
with {_SPLIT} select label_id, count(*) as n_rows, round(count(*) * cast(0.2 as double), 6) as target
from split_input group by label_id
"""

def split_walk(rows_cte: str) -> str:
    """Sequential greedy walk (md5 order) over a CTE ``split_input`` given by
    ``rows_cte``; defines ``split``."""
    return f"""
recursive {rows_cte},
t as (select count_if(label_id = 0) * cast(0.2 as double) as t0, count_if(label_id = 1) * cast(0.2 as double) as t1,
             count_if(label_id = 2) * cast(0.2 as double) as t2 from split_input),
g as (select dup_group, count_if(label_id = 0) as c0, count_if(label_id = 1) as c1, count_if(label_id = 2) as c2,
        row_number() over (order by md5('42:' || cast(dup_group as varchar)), dup_group) as rn
      from split_input group by dup_group),
walk(rn, r0, r1, r2, took, dup_group) as (
  select cast(0 as bigint), cast(0 as bigint), cast(0 as bigint), cast(0 as bigint), false, cast(null as bigint)
  union all
  select g.rn,
    case when w.r0 + g.c0 <= t.t0 and w.r1 + g.c1 <= t.t1 and w.r2 + g.c2 <= t.t2 then w.r0 + g.c0 else w.r0 end,
    case when w.r0 + g.c0 <= t.t0 and w.r1 + g.c1 <= t.t1 and w.r2 + g.c2 <= t.t2 then w.r1 + g.c1 else w.r1 end,
    case when w.r0 + g.c0 <= t.t0 and w.r1 + g.c1 <= t.t1 and w.r2 + g.c2 <= t.t2 then w.r2 + g.c2 else w.r2 end,
    w.r0 + g.c0 <= t.t0 and w.r1 + g.c1 <= t.t1 and w.r2 + g.c2 <= t.t2,
    g.dup_group
  from walk w join g on g.rn = w.rn + 1 cross join t),
split as (select r.row_id, r.dup_group, r.label_id,
            case when w.took then 'val' else 'train' end as split
          from split_input r left join walk w on w.dup_group = r.dup_group)
"""


SPLIT_WALK = split_walk(_SPLIT)

ORACLES["grouped_split"] = f"with {SPLIT_WALK} select * from split"

SPLIT_SUMMARY_SELECT = """
select count_if(split = 'train') as n_train, count_if(split = 'val') as n_val,
  round(count_if(split = 'val') / count(*), 6) as achieved,
  count_if(split = 'val' and label_id = 0) as val_0, count_if(split = 'val' and label_id = 1) as val_1,
  count_if(split = 'val' and label_id = 2) as val_2,
  concat_ws(',', case when count_if(label_id = 0) > 0 and count_if(split = 'val' and label_id = 0) = 0 then 'Positive' end,
                 case when count_if(label_id = 1) > 0 and count_if(split = 'val' and label_id = 1) = 0 then 'Neutral' end,
                 case when count_if(label_id = 2) > 0 and count_if(split = 'val' and label_id = 2) = 0 then 'Negative' end)
    as empty_labels
from split
"""

ORACLES["split_summary"] = f"with {SPLIT_WALK} {SPLIT_SUMMARY_SELECT}"

# --- scoring and audit -------------------------------------------------------------


def tokens_sql(cleaned: str) -> str:
    return f"regexp_extract_all(lower({cleaned}), '{WORD_TOKEN_RE}')"


MODEL_CTE = f"""
labelled as (select d.doc_id, d.text,
    case when l.toxic = 1 then 2 when l.quality = 1 then 0 else 1 end as label_id
  from labels l join documents d on l.doc_id = d.doc_id),
lt as (select label_id, unnest(list_distinct({tokens_sql(clean_sql('text'))})) as term from labelled),
per as (select term, count(*) as n, count_if(label_id = 0) as n0, count_if(label_id = 1) as n1,
          count_if(label_id = 2) as n2 from lt group by term having count(*) >= 2),
w as (select term, ln((n0 + 1) / (n + 3)) as w0, ln((n1 + 1) / (n + 3)) as w1,
        ln((n2 + 1) / (n + 3)) as w2 from per),
prior as (select count(*) as n, count_if(label_id = 0) as n0, count_if(label_id = 1) as n1,
            count_if(label_id = 2) as n2 from labelled),
b as (select ln((n0 + 1) / (n + 3)) as b0, ln((n1 + 1) / (n + 3)) as b1, ln((n2 + 1) / (n + 3)) as b2
      from prior)
"""


def scored_cte(name: str, src: str, id_col: str, cleaned: str) -> str:
    """Logits, prediction and confidence for ``src`` rows keyed by ``id_col``."""
    return f"""
{name}_t as (select {id_col} as rid, unnest({tokens_sql(cleaned)}) as term from {src}),
{name}_s as (select rid, sum(w0) as s0, sum(w1) as s1, sum(w2) as s2
             from {name}_t join w using (term) group by rid),
{name}_l as (select r.{id_col} as rid, b.b0 + coalesce(s.s0, 0) as l0, b.b1 + coalesce(s.s1, 0) as l1,
               b.b2 + coalesce(s.s2, 0) as l2
             from {src} r left join {name}_s s on s.rid = r.{id_col} cross join b),
{name} as (select rid,
    case when l0 >= l1 and l0 >= l2 then 'Positive' when l1 >= l2 then 'Neutral' else 'Negative' end as pred,
    1.0 / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2)))
      as confidence
  from {name}_l)
"""


ORACLES["score_linear"] = f"""
with {MODEL_CTE}, {scored_cte('sc', 'documents', 'doc_id', clean_sql("coalesce(text, '')"))}
select rid as doc_id, pred, round(confidence, 6) as confidence from sc
"""

# the same model and rows as score_linear, by another plan
ORACLES["score_projection"] = ORACLES["score_linear"]


def slots_sql(terms: str) -> str:
    """The slot of each term of a list: the 18 leading bits of its md5."""
    return f"list_transform({terms}, lambda x: cast('0x' || substr(md5(x), 1, 5) as integer) >> 2)"


def hashed_model_cte(src: str) -> str:
    """The lexicon model by slot, of the rows (text, label_id) of ``src``."""
    return f"""
hm_lt as (select label_id, unnest(list_distinct({slots_sql(tokens_sql(clean_sql('text')))})) as slot from {src}),
hm_w as (select slot, ln((count_if(label_id = 0) + 1) / (count(*) + 3)) as w0, ln((count_if(label_id = 1) + 1) / (count(*) + 3)) as w1,
           ln((count_if(label_id = 2) + 1) / (count(*) + 3)) as w2 from hm_lt group by slot having count(*) >= 2),
hm_b as (select ln((count_if(label_id = 0) + 1) / (count(*) + 3)) as b0, ln((count_if(label_id = 1) + 1) / (count(*) + 3)) as b1,
           ln((count_if(label_id = 2) + 1) / (count(*) + 3)) as b2 from {src})"""


def argmax_sql(name: str, logits: str, id_col: str) -> str:
    """Prediction and confidence from the logits l0, l1, l2."""
    return f"""
{name} as (select {id_col}, case when l0 >= l1 and l0 >= l2 then 'Positive' when l1 >= l2 then 'Neutral' else 'Negative' end as pred,
    1.0 / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2))) as confidence
  from {logits})"""


def hashed_scores_cte(src: str, id_col: str) -> str:
    cleaned = clean_sql("coalesce(text, '')")
    return f"""
hs_s as (select {id_col}, unnest({slots_sql(tokens_sql(cleaned))}) as slot from {src}),
hs_sum as (select {id_col}, sum(w0) as s0, sum(w1) as s1, sum(w2) as s2 from hs_s join hm_w using (slot) group by all),
hs_l as (select r.{id_col}, b0 + coalesce(s0, 0) as l0, b1 + coalesce(s1, 0) as l1, b2 + coalesce(s2, 0) as l2
  from {src} r left join hs_sum using ({id_col}) cross join hm_b),
{argmax_sql('hs', 'hs_l', id_col)}"""


_LABELLED_CTE = """labelled as (select d.doc_id, d.text, d.n_chars,
    case when l.toxic = 1 then 2 when l.quality = 1 then 0 else 1 end as label_id
  from labels l join documents d on l.doc_id = d.doc_id)"""

ORACLES["score_hashed"] = f"""
with {_LABELLED_CTE}, {hashed_model_cte('labelled')}, {hashed_scores_cte('documents', 'doc_id')}
select doc_id, pred, round(confidence, 6) as confidence from hs
"""

REPORT_SELECT = """
tot as (select sum(support) as total, sum(tp) as correct from m)
select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
       cast(support as bigint) as support from m
union all select 'accuracy', null::double, null::double,
       round(case when total > 0 then correct / total else 0.0 end, 6), cast(total as bigint) from tot
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       cast((select total from tot) as bigint) from m
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       cast(sum(support) as bigint) from m
"""

_NAME = "['Positive', 'Neutral', 'Negative'][label_id + 1]"

_STORED = "with " + split_walk(_LABELLED_CTE + """,
split_input as (select doc_id as row_id, n_chars as dup_group, label_id from labelled)""") + f""",
ev_train as (select l.text, l.label_id from split s join labelled l on l.doc_id = s.row_id where split = 'train'),
ev_val as (select s.row_id, l.text, l.label_id from split s join labelled l on l.doc_id = s.row_id where split = 'val'),
{hashed_model_cte('ev_train')}, {hashed_scores_cte('ev_val', 'row_id')},
scores as (select row_id as doc_id, {_NAME} as actual, pred as predicted from hs join ev_val using (row_id)),
{_PER_CLASS}"""

ORACLES["evaluate_stored"] = _STORED + ", " + REPORT_SELECT

ORACLES["run_report"] = _STORED + f""",
rep as (with {REPORT_SELECT}), sm as ({SPLIT_SUMMARY_SELECT}),
long as (
  select 'parameter' as section, 'test_size' as name, 0.2::double as value union all select 'parameter', 'seed', 42
  union all select 'split', c, v from (select unnest(['n_train', 'n_val', 'achieved', 'val_0', 'val_1', 'val_2']) as c,
    unnest([n_train::double, n_val::double, achieved::double, val_0::double, val_1::double, val_2::double]) as v from sm)
  union all select 'train_label', {_NAME}, count(*) from ev_train group by label_id
  union all select 'report', label || '.' || c, v from (select label, unnest(['precision', 'recall', 'f1', 'support']) as c,
    unnest([precision, recall, f1, support::double]) as v from rep)
  union all select 'confusion', actual || '.' || predicted, n from cm)
select section, name, value from long where value is not null"""

ORACLES["label_table"] = f"""
with {MODEL_CTE}, {scored_cte('sc', 'documents', 'doc_id', clean_sql("coalesce(text, '')"))}
select d.doc_id, d.lang, d.source, sc.pred as sentiment, round(sc.confidence, 4) as confidence
from documents d join sc on sc.rid = d.doc_id
"""

ORACLES["audit_candidates"] = f"""
with {MODEL_CTE}, {CURATED_CTE.strip()},
a0 as (select row_id, source_file, {clean_sql('text')} as text,
         {cap_sql(f"regexp_replace(sentiment, '{EDGE_WS_RE}', '', 'g')")} as label
       from curated where text is not null and sentiment is not null),
a1 as (select * from a0 where label in ('Positive', 'Neutral', 'Negative')),
seen as (select distinct {clean_sql('text')} as text from labelled where text is not null),
a2 as (select * from a1 where text not in (select text from seen)),
{scored_cte('sc', 'a2', 'row_id', clean_sql('text'))}
select a2.source_file as source, a2.text, a2.label as sentiment, sc.pred, round(sc.confidence, 6) as conf,
  a2.row_id
from a2 join sc on sc.rid = a2.row_id
where sc.pred <> a2.label and sc.confidence >= 0.9
"""

ORACLES["audit_ranked"] = f"""
select *, row_number() over (order by conf desc, text, row_id) as rank from ({ORACLES['audit_candidates']})
"""

# --- ingest: extraction --------------------------------------------------------------

CONV_CTE = """
t as (select conv_id, turn, text, 1700000000 + conv_id * 3600 + turn * 60 as ts,
        cast(conv_id as varchar) || '_' || cast(turn as varchar) as id,
        case when conv_id % 5 = 0 then null else 'user_' || cast(conv_id % 50 as varchar) end as handle,
        ['x', 'instagram', 'tiktok'][(conv_id % 3) + 1] as platform,
        row_number() over (partition by conv_id order by turn) - 1 as k,
        count(*) over (partition by conv_id) - 1 as n_comments
      from conversations),
posts as (select * from t where k = 0),
comments as (select * from t where k > 0)
"""


def iso_duck(ts: str) -> str:
    return f"strftime(to_timestamp({ts}), '%Y-%m-%dT%H:%M:%S+00:00')"


def _post_oracle(platform: str, handle: str, name: str, url: str, like: str, share: str, view: str) -> str:
    return f"""
with {CONV_CTE}
select conv_id, platform, platform || '-' || cast(conv_id % 8 as varchar) as batch_id, id as platform_post_id,
  {handle} as author_handle, {name} as author_name, coalesce(text, '') as content, {url} as url,
  cast({like} as bigint) as like_count, cast(0 as bigint) as comment_count, cast({share} as bigint) as share_count,
  cast({view} as bigint) as view_count, {iso_duck('ts')} as published_at,
  '2024-01-01T00:00:00+00:00' as crawled_at, cast(n_comments as bigint) as n_comments
from posts where platform = '{platform}' and conv_id % 17 <> 5
"""


ORACLES["extract_x"] = _post_oracle(
    "x", "handle", "cast(null as varchar)",
    "case when handle is not null then 'https://x.com/' || handle || '/status/' || id end",
    "conv_id % 11", "2 + conv_id % 3", "conv_id * 10")
ORACLES["extract_instagram"] = _post_oracle(
    "instagram", "handle", "cast(null as varchar)",
    "case when conv_id % 4 <> 0 then 'https://www.instagram.com/p/c' || cast(conv_id as varchar) || '/' end",
    "conv_id % 11", "0", "0")
ORACLES["extract_tiktok"] = _post_oracle(
    "tiktok", "handle", "'nn'",
    "case when handle is not null then 'https://www.tiktok.com/@' || handle || '/video/' || id end",
    "conv_id % 11", "0", "conv_id * 10")

ORACLES["extract_comments"] = f"""
with {CONV_CTE}
select conv_id, platform, cast(k - 1 as bigint) as pos, id as platform_comment_id,
  case when platform = 'x' then null else handle end as author_handle, coalesce(text, '') as content,
  cast(0 as bigint) as like_count, {iso_duck('ts')} as published_at
from comments where conv_id % 17 <> 5
"""

ORACLES["extract_failures"] = f"""
with {CONV_CTE}
select conv_id, platform, platform || '-' || cast(conv_id % 8 as varchar) as batch_id,
  case platform when 'x' then 'bad:post.legacy.created_at' when 'instagram' then 'bad:post.taken_at'
    else 'bad:post.createTime' end as error
from posts where conv_id % 17 = 5
"""

# --- ingest: labelling, batches, upsert ----------------------------------------------

_ENV = """
env as (select conv_id, platform, platform || '-' || cast(conv_id % 8 as varchar) as batch_id,
          case when conv_id % 8 < 5 then 'pending' else 'processed' end as status,
          conv_id % 17 = 5 as bad from posts)
"""

ORACLES["label_posts"] = f"""
with {MODEL_CTE}, {CONV_CTE},
txt as (select conv_id, k as pos, {clean_sql("coalesce(text, '')")} as ctext,
          cast(conv_id as varchar) || '#' || cast(k as varchar) as tid from t where conv_id % 17 <> 5),
{scored_cte('sc', 'txt', 'tid', 'ctext')}
select txt.conv_id, cast(txt.pos as bigint) as pos, lower(sc.pred) as sentiment,
  round(sc.confidence, 6) as sentiment_score, 'lexicon-v1' as model_version
from txt join sc on sc.rid = txt.tid
"""

ORACLES["label_posts_repeats"] = f"""
with {MODEL_CTE}, {CONV_CTE},
copies as (select conv_id, k, 1 as copy, coalesce(text, '') as text from t union all
           select conv_id, k, 2, case when k = 0 then coalesce(text, '') || ' ' || coalesce(text, '') else coalesce(text, '') end
           from t),
txt as (select conv_id, copy, k as pos, {clean_sql("text")} as ctext,
          concat_ws('#', conv_id, k, copy) as tid from copies where conv_id % 17 <> 5),
{scored_cte('sc', 'txt', 'tid', 'ctext')}
select txt.conv_id, txt.copy, cast(txt.pos as bigint) as pos, lower(sc.pred) as sentiment,
  round(sc.confidence, 6) as sentiment_score, 'lexicon-v1' as model_version
from txt join sc on sc.rid = txt.tid
"""

ORACLES["pending_batches"] = f"""
with {CONV_CTE}, {_ENV}
select platform, batch_id, count(*) as n_docs, count_if(status = 'pending') as n_pending
from env group by platform, batch_id having count_if(status = 'pending') > 0
"""

ORACLES["batch_outcomes"] = f"""
with {CONV_CTE}, {_ENV},
pb as (select platform, batch_id from env group by all having count_if(status = 'pending') > 0)
select platform, batch_id, count(*) as n_docs, count_if(bad) as n_failed,
  case when count_if(bad) = 0 then 'processed' else 'pending' end as status
from env join pb using (platform, batch_id) group by platform, batch_id
"""

ORACLES["ingest_summary"] = f"""
with {CONV_CTE}, {_ENV},
pb as (select platform, batch_id from env group by all having count_if(status = 'pending') > 0),
o as (select platform, batch_id, count(*) as n_docs, count_if(bad) as n_failed
      from env join pb using (platform, batch_id) group by all)
select platform, count(*) as n_pending_batches, cast(count_if(n_failed = 0) as bigint) as n_processed,
  cast(sum(n_docs) as bigint) as n_docs, cast(sum(n_failed) as bigint) as n_failed
from o group by platform
"""

ORACLES["ingest_targets"] = f"""
with {CONV_CTE}, {_ENV},
pb as (select platform, batch_id, min(conv_id % 8) = 3 as other from env where status = 'pending' group by all)
select platform, count(*) as n_pending, count_if(not other) as n_target, count_if(other) as n_skipped from pb group by platform
"""

_PAYLOAD_CTE = f"""{MODEL_CTE}, {CONV_CTE},
txt as (select conv_id, k as pos, {clean_sql("coalesce(text, '')")} as ctext,
          cast(conv_id as varchar) || '#' || cast(k as varchar) as tid from t where conv_id % 17 <> 5),
{scored_cte('sc', 'txt', 'tid', 'ctext')},
told as (select txt.conv_id, txt.pos, 'lexicon-v1' as model_version, lower(sc.pred) as sentiment,
           round(sc.confidence, 6) as sentiment_score, true as raw_is_object from txt join sc on sc.rid = txt.tid)"""

ORACLES["payload_posts"] = f"""
with {_PAYLOAD_CTE},
flat as ({' union all '.join(f"select * exclude (batch_id, n_comments) from ({ORACLES['extract_' + p]})"
                             for p in ('x', 'instagram', 'tiktok'))})
select flat.*, told.* exclude (conv_id, pos) from flat join told on told.conv_id = flat.conv_id and told.pos = 0
"""

ORACLES["payload_comments"] = f"""
with {_PAYLOAD_CTE}, flat as (select * exclude (platform) from ({ORACLES['extract_comments']}))
select flat.*, told.* exclude (conv_id, pos) from flat join told on told.conv_id = flat.conv_id and told.pos = flat.pos + 1
"""

ORACLES["upsert_posts"] = f"""
with {MODEL_CTE}, {CONV_CTE},
txt as (select conv_id, {clean_sql("coalesce(text, '')")} as ctext from posts where conv_id % 17 <> 5),
{scored_cte('sc', 'txt', 'conv_id', 'ctext')}
select p.platform, p.id as platform_post_id,
  cast(case when p.conv_id % 8 < 5 then 2 else 1 end as bigint) as delivery,
  lower(sc.pred) as sentiment, cast(p.n_comments as bigint) as n_comments
from posts p join sc on sc.rid = p.conv_id where p.conv_id % 17 <> 5
"""

# --- near duplicates (brute force: every pair sharing a term) --------------------------

def near_dup_cte(src: str = "documents", id_col: str = "doc_id", text_col: str = "text") -> str:
    """Brute-force near-duplicate pairs over ``src`` (every pair sharing a term)."""
    return f"""
nd_docs as (select {id_col} as doc_id,
    trim(regexp_replace(regexp_replace(lower({text_col}), '[^a-z0-9# ]+', ' ', 'g'), ' +', ' ', 'g')) as form
  from {src}),
nd_forms as (select form, min(doc_id) as rep, count(*) as m from nd_docs group by form),
nd_toks as (select rep, m, list_filter(string_split_regex(form, '[^a-z0-9]+'), lambda x: length(x) >= 2) as t
            from nd_forms),
nd_grams as (select rep, m, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) as term
             from nd_toks),
nd_tf as (select rep, m, term, count(*) as tf from nd_grams group by all),
nd_df as (select term, sum(m) as df from nd_tf group by term),
nd_n as (select count(*) as n from {src}),
nd_w0 as (select rep, term, tf, df, tf * (ln((1 + n) / (1 + df)) + 1) as w from nd_tf join nd_df using (term) cross join nd_n),
nd_nrm as (select rep, sqrt(sum(w * w)) as nr from nd_w0 group by rep),
nd_w as (select rep, term, tf, df, w / nr as w from nd_w0 join nd_nrm using (rep)),
nd_pairs as (select a.rep as rep_a, b.rep as rep_b, sum(a.w * b.w) as sim
             from nd_w a join nd_w b on a.term = b.term and a.rep < b.rep
             group by all having sum(a.w * b.w) >= 0.8 - 1e-9)
"""


NEAR_DUP_CTE = near_dup_cte()

ORACLES["tfidf_top_terms"] = f"""
with {NEAR_DUP_CTE},
ranked as (select d.doc_id, w.term, w.tf, w.df, w.w,
             row_number() over (partition by d.doc_id order by w.w desc, w.term) as rank
           from nd_docs d join nd_forms f using (form) join nd_w w on w.rep = f.rep)
select doc_id, cast(rank as integer) as rank, term, cast(tf as bigint) as tf, cast(df as bigint) as df,
  round(w, 6) as weight from ranked where rank <= 5
"""

ORACLES["near_dup_pairs"] = f"""
with {NEAR_DUP_CTE}
select p.rep_a, p.rep_b, round(p.sim, 6) as similarity, fa.m as copies_a, fb.m as copies_b
from nd_pairs p join nd_forms fa on fa.rep = p.rep_a join nd_forms fb on fb.rep = p.rep_b
"""

GROUPS_TAIL = """,
nd_edges as (select rep_a as a, rep_b as b from nd_pairs union all select rep_b, rep_a from nd_pairs),
nd_reach(node, comp) as (select a, a from nd_edges
                         union select e.b, r.comp from nd_reach r join nd_edges e on e.a = r.node),
nd_comp as (select node, min(comp) as comp from nd_reach group by node),
nd_nonempty as (select distinct rep from nd_w),
nd_groups as (select d.doc_id,
    case when ne.rep is null then d.doc_id else coalesce(c.comp, f.rep) end as dup_group
  from nd_docs d join nd_forms f using (form) left join nd_nonempty ne on ne.rep = f.rep
  left join nd_comp c on c.node = f.rep)
"""

NEAR_DUP_GROUPS_CTE = NEAR_DUP_CTE + GROUPS_TAIL

ORACLES["near_dup_groups"] = f"with recursive {NEAR_DUP_GROUPS_CTE} select doc_id, dup_group from nd_groups"

ORACLES["cluster_stats"] = f"""
with recursive {NEAR_DUP_GROUPS_CTE},
sizes as (select dup_group, count(*) as size from nd_groups group by dup_group)
select count(*) as n_groups, cast(coalesce(sum(case when size > 1 then size end), 0) as bigint) as n_clustered,
  max(size) as largest, cast(sum(size) as bigint) as n_rows from sizes
"""

ORACLES["ingest_stream"] = f"""
with {MODEL_CTE}, {CONV_CTE},
txt as (select conv_id, {clean_sql("coalesce(text, '')")} as ctext from posts
        where conv_id % 17 <> 5 and conv_id % 8 < 5),
{scored_cte('sc', 'txt', 'conv_id', 'ctext')}
select p.platform, p.id as platform_post_id, lower(sc.pred) as sentiment,
  round(sc.confidence, 6) as sentiment_score, cast(p.n_comments as bigint) as n_comments
from posts p join sc on sc.rid = p.conv_id
"""

ORACLES["ingest_late_arrivals"] = f"""
with {CONV_CTE}, {_ENV}
select platform, batch_id, count(*) as n_docs, count_if(bad) as n_failed,
  case when count_if(bad) = 0 then 'processed' else 'pending' end as status, count_if(not bad) as n_posts
from env where status = 'pending' group by platform, batch_id
"""

ORACLES["ingest_stream_retry"] = f"""
with {CONV_CTE}, {_ENV}
select platform, batch_id, count(*) as n_docs, cast(0 as bigint) as n_failed, 'processed' as status, count(*) as n_posts
from env where status = 'pending' group by platform, batch_id
"""

ORACLES["csv_curate_corpus"] = "with " + CURATED_CTE + "select text, sentiment, source_file from curated"


_NA = ", ".join("'" + x + "'" for x in NA_TOKENS)

_BATCHES_CTE = f"""
corpus as ({CORPUS_SQL}),
b0 as (select row_id, row_id % 6 as batch, source_file, label_raw,
    replace(replace(text, '. ', concat('.', chr(10))), ' the ', ' "the" ') as text from corpus),
b1 as (select row_id, cast(batch as integer) as batch, source_file, case when label_raw in ({_NA}) then null else label_raw end as label_raw,
    case when batch in (2, 3) then regexp_replace(text, '[^\\x{{00}}-\\x{{FF}}]', '?', 'g') else text end as text from b0),
b2 as (select row_id, batch, label_raw, case when batch <> 3 and source_file not in ({_NA}) then source_file end as source_file,
    case when text in ({_NA}) then null else text end as text from b1)"""

ORACLES["csv_dialects"] = f"""
with {_BATCHES_CTE} select batch, md5(text) as text_md5, label_raw, source_file from b2 where batch <> 5
"""

ORACLES["csv_folder_report"] = f"""
with {_BATCHES_CTE},
n0 as (select *, regexp_replace(label_raw, '{EDGE_WS_RE}', '', 'g') as l from b2),
n1 as (select *, {cap_sql(f"(case when source_file = 'src4' then {_src4_map('l')} else {_default_map('l')} end)")} as label from n0)
select batch, case when batch in (1, 3) then chr(9) else ',' end as sep,
  count_if(batch <> 5 and text is not null and label in ('Positive', 'Neutral', 'Negative')) as n_usable,
  bool_or(contains(text, chr(10))) as multiline, batch = 5 as unlabelled
from n1 group by batch
"""


# --- the reference flow: curate -> near-duplicate groups -> grouped split -----------------

_CORPUS_GROUPS = CURATED_CTE.strip() + ", " + near_dup_cte("curated", "row_id", "text").strip() + GROUPS_TAIL

ORACLES["corpus_dup_groups"] = f"with recursive {_CORPUS_GROUPS} select doc_id as row_id, dup_group from nd_groups"

ORACLES["corpus_split_summary"] = "with " + split_walk(
    _CORPUS_GROUPS + """, split_input as (select c.row_id, g.dup_group, c.label_id
                         from curated c join nd_groups g on g.doc_id = c.row_id)""") + SPLIT_SUMMARY_SELECT


# --- the baseline: the same features and gradient steps --------------------------------------

def baseline_cte(steps: int) -> str:
    """Predictions ``bl`` (row_id, pred, confidence) of the validation rows after ``steps`` accelerated gradient steps.

    The intercept is slot -1, which every row holds with weight 1 and which is not regularised.
    """
    tokens = tokens_sql(clean_sql("text"))
    ctes = [f"""bl_t as (select row_id, s.label_id, split, {tokens} as t from split s join curated c using (row_id))""",
            f"""bl_g as (select row_id, unnest({slots_sql("t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])")}) as slot from bl_t)""",
            "bl_tf as (select row_id, slot, count(*) as tf from bl_g group by all)",
            "bl_n as (select count(*)::double as n from bl_t where split = 'train')",
            """bl_idf as (select slot, ln((1 + any_value(n)) / (1 + count(*))) + 1 as idf from bl_tf join bl_t using (row_id) cross join bl_n
  where split = 'train' group by slot having count(*) >= 2)""",
            "bl_w as (select row_id, slot, (1 + ln(tf)) * idf as x from bl_tf join bl_idf using (slot))",
            """bl_x as materialized (select row_id, slot, x / sqrt(sum(x * x) over (partition by row_id)) as x from bl_w
  union all select row_id, -1, 1.0 from bl_t)""",
            """bl_y as materialized (select row_id, label_id, (select n from bl_n) / ((select count(distinct label_id) from bl_t where split = 'train')
    * count(*) over (partition by label_id)) as b from bl_t where split = 'train')""",
            """st0 as materialized (select slot, 0.0::double as w0, 0.0::double as w1, 0.0::double as w2, 0.0::double as v0, 0.0::double as v1,
    0.0::double as v2 from (select slot from bl_idf union all select -1))"""]
    t = 1.0
    for i in range(steps):
        new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        factor, t = (t - 1) / new, new
        top = "greatest(l0, l1, l2)"
        ctes.append(f"""er{i} as materialized (select row_id, {', '.join(f"b * (exp(l{k} - {top}) / (exp(l0 - {top}) + exp(l1 - {top}) + exp(l2 - {top})) - (label_id = {k})::int) as e{k}" for k in range(3))}
  from (select row_id, label_id, b, sum(x * v0) as l0, sum(x * v1) as l1, sum(x * v2) as l2
    from bl_y join bl_x using (row_id) join st{i} using (slot) group by all))""")
        grad = ", ".join(f"sum(x * e{k}) as g{k}" for k in range(3))
        step = "(1 / (1 + 1 / n) / n)"
        ws = ", ".join(f"v{k} - {step} * (coalesce(g{k}, 0) + case when slot = -1 then 0 else v{k} end) as n{k}" for k in range(3))
        ctes.append(f"""st{i + 1} as materialized (select slot, {', '.join(f'n{k} as w{k}' for k in range(3))},
    {', '.join(f'n{k} + {factor!r} * (n{k} - w{k}) as v{k}' for k in range(3))}
  from (select slot, w0, w1, w2, {ws} from st{i} left join (select slot, {grad} from er{i} join bl_x using (row_id) group by slot)
    using (slot) cross join bl_n))""")
    ctes.append(f"""bl_l as (select row_id, sum(x * w0) as l0, sum(x * w1) as l1, sum(x * w2) as l2
  from bl_t join bl_x using (row_id) join st{steps} using (slot) where split = 'val' group by row_id)""")
    return ",\n".join(ctes) + "," + argmax_sql("bl", "bl_l", "row_id")


_BASELINE = "with " + split_walk(
    _CORPUS_GROUPS + """, split_input as (select c.row_id, g.dup_group, c.label_id
                         from curated c join nd_groups g on g.doc_id = c.row_id)""") + ", " + baseline_cte(30)

ORACLES["baseline_scores"] = _BASELINE + " select row_id, pred, round(confidence, 6) as confidence from bl"

ORACLES["baseline_metrics"] = _BASELINE + f""",
scores as (select row_id as doc_id, {_NAME} as actual, pred as predicted from bl join bl_t using (row_id)),
{_PER_CLASS}, {REPORT_SELECT}"""
