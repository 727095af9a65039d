"""Driver tables and the derived views the queries run on.

Every view is a lazy DataFrame over the parquet tables; nothing is made up
or held on the driver.  The SQL text of each view is shared with the DuckDB
oracles (``textlens.plans.oracles``) so both engines see the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textlens.session import apply_defaults

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_texts(spark: SparkSession, sf_dir: str, name: str, id_col: str) -> DataFrame:
    """A table of texts, dealt by row id.

    A scan is split at row groups only, so a file of few, large ones leaves all
    work on its texts to few tasks.  Cleaning and tokenising a text costs some
    thirty times as much as moving it, so texts are always dealt first.
    """
    return read_table(spark, sf_dir, name).repartition(id_col)


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    apply_defaults(spark)
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


# Mixed numeric, named, invalid and null labels; origin 'src4' plays the batch
# with the other numeric convention (see CORPUS_CONVENTIONS).
CORPUS_SQL = """
select doc_id as row_id, text, source as source_file,
  case doc_id % 10 when 9 then '  POSITIVE ' when 8 then 'positif' when 7 then null
       else cast(doc_id % 3 as varchar(8)) end as label_raw
from documents
"""

CORPUS_CONVENTIONS = {"src4": {"0": "Neutral", "1": "Positive", "2": "Negative"}}

# (actual, predicted) label names for the metric operators.
SCORES_SQL = """
select l.doc_id, d.lang,
  case when l.toxic = 1 then 'Negative' when l.quality = 1 then 'Positive' else 'Neutral' end as actual,
  case when d.n_chars % 7 = 0 then 'Negative' when d.n_chars % 7 < 5 then 'Positive' else 'Neutral' end as predicted
from labels l join documents d on l.doc_id = d.doc_id
"""

# Rows with a group (customer) and a label (order status) for the grouped split.
SPLIT_INPUT_SQL = """
select o_orderkey as row_id, o_custkey as dup_group,
  case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as label_id
from orders
"""

# Training run log: one run per user, one epoch per day of the month; an
# epoch has an eval loss when it logged any non-'view' event.
RUN_LOG_SQL = """
select user_id as run_id,
  cast(datediff(cast(ts as date), date '2024-01-01') + 1 as bigint) as epoch,
  avg(case when event_type <> 'view' then value end) / 100.0 as eval_loss,
  avg(cast(value as double) - floor(value)) as eval_accuracy,
  avg(cast(get_json_object(props, '$.k') as double)) / 100.0 as eval_macro_f1
from events
group by user_id, datediff(cast(ts as date), date '2024-01-01') + 1
"""

#: the envelopes that carry no readable time
FAULTY = "conv_id % 17 = 5"

# Raw post+comments envelopes of three platforms, built from conversations:
# lowest turn = the post, later turns = comments.  Spark SQL only (the DuckDB
# oracles derive expected values from conversations directly).
ENVELOPES_SQL = """
with t as (select conv_id, turn, text, 1700000000 + conv_id*3600 + turn*60 as ts, concat(conv_id,'_',turn) as id,
           if(conv_id % 5 = 0, null, concat('user_', conv_id % 50)) as handle from conversations),
c as (select conv_id, sort_array(collect_list(struct(turn, id, text, ts, handle))) as a from t group by conv_id),
p as (select conv_id, a[0] as p, slice(a, 2, size(a)) as cs,
      element_at(array('x','instagram','tiktok'), cast(conv_id % 3 as int)+1) as platform from c)
select conv_id, platform, concat(platform,'-',conv_id % 8) as batch_id,
 if(conv_id % 8 < 5,'pending','processed') as status, '2024-01-01T00:00:00Z' as extracted_at,
 case platform
 when 'x' then to_json(named_struct('post', named_struct('rest_id', p.id, 'legacy', named_struct('id_str', p.id,
   'full_text', p.text, 'created_at', if(conv_id % 17 = 5, 'bad',
   date_format(timestamp_seconds(p.ts), 'EEE MMM dd HH:mm:ss Z yyyy')), 'favorite_count', conv_id % 11,
   'retweet_count', 2, 'quote_count', conv_id % 3), 'core', named_struct('user_results', named_struct('result',
   named_struct('core', named_struct('screen_name', p.handle)))), 'views', named_struct('count', cast(conv_id*10 as string))),
   'comments', transform(cs, x -> named_struct('legacy', named_struct('id_str', x.id, 'full_text', x.text,
   'created_at', date_format(timestamp_seconds(x.ts), 'EEE MMM dd HH:mm:ss Z yyyy'))))))
 when 'instagram' then to_json(named_struct('post', named_struct('pk', p.id, 'code', if(conv_id % 4 = 0, '', concat('c', conv_id)),
   'taken_at', if(conv_id % 17 = 5, null, p.ts), 'caption', named_struct('text', p.text),
   'user', named_struct('username', p.handle), 'like_count', conv_id % 11),
   'comments', transform(cs, x -> named_struct('pk', x.id, 'text', x.text, 'created_at', x.ts, 'user', named_struct('username', x.handle)))))
 else to_json(named_struct('post', named_struct('id', p.id, 'desc', p.text, 'createTime', if(conv_id % 17 = 5, null, p.ts),
   'author', named_struct('uniqueId', p.handle, 'nickname', 'nn'),
   'stats', named_struct('diggCount', conv_id % 11, 'playCount', conv_id * 10)),
   'comments', transform(cs, x -> named_struct('cid', x.id, 'text', x.text, 'create_time', x.ts, 'user', named_struct('nickname', x.handle)))))
 end as raw_payload
from p
"""


def _view(spark: SparkSession, sf_dir: str, sql: str, needs: tuple[str, ...]) -> DataFrame:
    register_tables(spark, sf_dir, needs)
    return spark.sql(sql)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled corpus, dealt by row id (see ``read_texts``)."""
    return _view(spark, sf_dir, CORPUS_SQL, ("documents",)).repartition("row_id")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SCORES_SQL, ("documents", "labels"))


def split_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SPLIT_INPUT_SQL, ("orders",))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RUN_LOG_SQL, ("events",))


def envelopes(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """Every conversation as an envelope; ``faults=False`` mends those with a bad time."""
    sql = ENVELOPES_SQL if faults else ENVELOPES_SQL.replace(FAULTY, "false")
    return _view(spark, sf_dir, sql, ("conversations",))
