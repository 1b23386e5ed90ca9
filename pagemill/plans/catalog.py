"""The operators on the test tables, each with the SQL that gives the same rows.

Views of the tables: events are traffic records (project ``event_type``, title ``$.k``) and
revisions (page ``$.k``, user ``user_id``); documents and conversations are lines and
comments; orders linking to parts, and keys linking to users, are link graphs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill import sources
from pagemill.functions.tags import KEYWORDS, mask_text, tag_mask
from pagemill.functions.text import squeeze
from pagemill.lineage import cut_lineage, scratch_path, settle, spread_scan
from pagemill.operators import balance, counts, edits, ranking, trends
from pagemill.operators.numbering import number_in_order, number_rows
from pagemill.sources import sinks
from pagemill.sources.line_places import line_at, number_lines
from pagemill.sources.text import titles

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

FIRST_DAY, N_DAYS = date(2024, 1, 1), 30


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


# --- views -------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key() -> Column:
    return F.get_json_object("props", "$.k")


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("project"),
        key().alias("title"),
        F.floor("value").cast("bigint").alias("views"),
        F.to_date("ts").alias("day"),
    )


TRAFFIC = """traffic as (
  select event_type as project, json_extract_string(props, '$.k') as title,
         cast(floor(value) as bigint) as views, cast(ts as date) as day
  from events)"""


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("rev_id"),
        key().cast("bigint").alias("page_id"),
        F.col("user_id").cast("string").alias("user"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("ts"),
        F.col("event_type").alias("comment"),
    )


REVISIONS = """revisions as (
  select event_id as rev_id, cast(json_extract_string(props, '$.k') as bigint) as page_id,
         cast(user_id as varchar) as "user", strftime(ts, '%Y%m%d%H%M%S') as ts, event_type as comment
  from events)"""


def document_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is an edit of its language by its source."""
    return spread_scan(table(spark, sf_dir, "documents").drop("n_chars")).select(
        F.col("doc_id").alias("rev_id"),
        F.col("lang").alias("page_id"),
        F.col("source").alias("user"),
        F.lpad(F.col("doc_id").cast("string"), 14, "0").alias("ts"),
        F.col("text").alias("comment"),
    )


def turn_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn is an edit of its conversation by its role."""
    return table(spark, sf_dir, "conversations").select(
        F.col("turn").alias("rev_id"),
        F.col("conv_id").alias("page_id"),
        F.col("role").alias("user"),
        F.lpad(F.col("turn").cast("string"), 14, "0").alias("ts"),
        F.col("text").alias("comment"),
    )


SPACE = r"[ \t\n\x0B\f\r]+"


def glued_sql(text: str) -> str:
    return f"lower(regexp_replace({text}, '{SPACE}', '', 'g'))"


def tags_sql(c: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"case when contains({c}, '{k}') then '{k}' end" for k in KEYWORDS) + ")"


def as_text(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as text, since list types differ between the engines."""
    for c in arrays:
        df = df.withColumn(c, F.array_join(c, " "))
    return df


# --- counts ------------------------------------------------------------------------


@query(r"""
select word, cast(count(*) as bigint) as n
from (select unnest(string_split_regex(text, '[ \t\n\r\f]+')) as word from documents)
where word <> '' group by word""")
def word_count(spark, sf_dir):
    return counts.word_count(spread_scan(table(spark, sf_dir, "documents").select("text")), "text")


@query(f"with {TRAFFIC} select title, cast(sum(views) as bigint) as accesses from traffic group by title")
def access_count(spark, sf_dir):
    return counts.access_count(traffic(spark, sf_dir))


@query(f"with {TRAFFIC} select project, title, cast(sum(views) as bigint) as accesses from traffic group by all")
def access_count_by_project(spark, sf_dir):
    return counts.access_count(traffic(spark, sf_dir), by_project=True)


@query(f"""with {TRAFFIC}
select title, cast(sum(views) as bigint) as accesses from traffic where project = 'view' group by title""")
def access_count_one_project(spark, sf_dir):
    return counts.access_count(traffic(spark, sf_dir), project="view")


@query(f"""with {TRAFFIC}
select title, cast(sum(views) as bigint) as accesses from traffic group by title
order by accesses desc, title desc limit 15""")
def top_pages(spark, sf_dir):
    return counts.top_pages(counts.access_count(traffic(spark, sf_dir)))


# --- trends ------------------------------------------------------------------------

DAILY = f"""{TRAFFIC}, daily as (
  select title, cast(greatest(day - date '2024-01-01', 0) as integer) as day, cast(sum(views) as bigint) as n
  from traffic group by all)"""


def daily(spark, sf_dir):
    return trends.daily_counts(traffic(spark, sf_dir), FIRST_DAY, N_DAYS)


@query(f"with {DAILY} select title, day, n from daily")
def daily_counts(spark, sf_dir):
    return daily(spark, sf_dir)


@query(f"""with {TRAFFIC}
select title, cast(greatest(day - date '2024-01-11', 0) as integer) as day, cast(sum(views) as bigint) as n
from traffic group by all""")
def daily_counts_clamped(spark, sf_dir):
    return trends.daily_counts(traffic(spark, sf_dir), date(2024, 1, 11), 20)


@query(f"""with {TRAFFIC}
select title, cast(day - date '2024-01-11' as integer) as day, cast(sum(views) as bigint) as n
from traffic where day between date '2024-01-11' and date '2024-01-20' group by all""")
def daily_counts_inside(spark, sf_dir):
    return trends.daily_counts(traffic(spark, sf_dir), date(2024, 1, 11), 10, early="drop", late="drop")


@query(f"with {TRAFFIC} select project, title, views, day from traffic where day > date '2024-01-20'")
def late_records(spark, sf_dir):
    return trends.late_records(traffic(spark, sf_dir), date(2024, 1, 11), 10)


SPARSE = f"""{DAILY}, series as (
  select title, max(n) as peak,
         string_agg(day || '-' || n, ' ' order by day) filter (where n > 0) as series
  from daily group by title having max(n) > 600)"""


@query(f"with {SPARSE} select title, peak, series from series")
def trend_sparse(spark, sf_dir):
    return trends.trend(daily(spark, sf_dir), threshold=600)


@query(f"with {SPARSE} select title || chr(9) || series || ' ' as value from series")
def trend_lines(spark, sf_dir):
    return sinks.trend_lines(trend_sparse(spark, sf_dir))


@query(f"""with {DAILY}, slots as (
  select t.title, d.day, coalesce(daily.n, 0) as n
  from (select distinct title from daily) t cross join (select cast(range as integer) as day from range(30)) d
  left join daily on daily.title = t.title and daily.day = d.day)
select title, max(n) as peak, string_agg(cast(n as varchar), ' ' order by day) as days from slots group by title""")
def trend_dense(spark, sf_dir):
    return as_text(trends.dense_trend(daily(spark, sf_dir), N_DAYS), "days")


@query(f"""with {TRAFFIC}, daily as (
  select title, cast(day - date '2024-01-11' as integer) as day, cast(sum(views) as bigint) as n
  from traffic where day between date '2024-01-11' and date '2024-01-20' group by all)
select title, max(n) as peak, string_agg(day || '-' || n, ' ' order by day) filter (where n > 0) as series
from daily group by title having max(n) > 600""")
def trend_from_files(spark, sf_dir):
    """Records written as gzip files by day, of which ten days are read."""
    path = scratch_path(spark, "traffic")
    sinks.write_pagecounts(traffic(spark, sf_dir).withColumn("bytes", F.lit(0)), path)
    first, last = date(2024, 1, 11), date(2024, 1, 20)
    records = sources.read_pagecounts(spark, path, first_day=first, last_day=last)
    return trends.trend(trends.daily_counts(records, first, 10), threshold=600)


def undated_traffic(spark, sf_dir):
    """Traffic files by day, of which errors lie in files without a date; the folder."""
    path = scratch_path(spark, "traffic")
    records = traffic(spark, sf_dir).withColumn("bytes", F.lit(0))
    dated = F.col("project") != "error"
    sinks.write_pagecounts(records.where(dated), path)
    lines = records.where(~dated).select(F.concat_ws(" ", "project", "title", "views", "bytes").alias("value"))
    lines.write.mode("append").option("mapreduce.output.basename", "pagecounts-undated1").text(path)
    return path


@query(f"""with {TRAFFIC}
select day, case when day is null then 'undated' when day < date '2024-01-11' then 'early'
                 when day > date '2024-01-20' then 'late' else 'in' end as place, count(*) as records
from (select case when project <> 'error' then day end as day from traffic) group by all""")
def traffic_manifest(spark, sf_dir):
    """Which files a read of ten days takes, and how many records each day's files hold."""
    path = undated_traffic(spark, sf_dir)
    files = sources.traffic_manifest(spark, path, date(2024, 1, 11), date(2024, 1, 20))
    lines = sources.read_lines(spark, path).groupBy(F.col("_metadata.file_path").alias("file")).count()
    return files.join(lines, "file").groupBy("day", "place").agg(F.sum("count").alias("records"))


@query(f"""with {TRAFFIC}
select title, cast(sum(views) as bigint) as accesses, 0 as rejected
from traffic where project <> 'error' and day between date '2024-01-11' and date '2024-01-20' group by title
union all
select title, 0 as accesses, count(*) as rejected from traffic where project = 'error' group by title""")
def undated_rejects(spark, sf_dir):
    """Ten days of records, and the lines of undated files rejected whatever days are asked for."""
    good, bad = sources.read_pagecounts(
        spark, undated_traffic(spark, sf_dir), mode="reject", first_day=date(2024, 1, 11), last_day=date(2024, 1, 20)
    )
    title = F.split("value", " ")[1].alias("title")
    rejected = bad.where("reason = 'no date in file name'").groupBy(title).agg(F.count(F.lit(1)).alias("rejected"))
    zero = F.lit(0).cast("bigint")
    accepted = counts.access_count(good).withColumn("rejected", zero)
    return accepted.unionByName(rejected.withColumn("accesses", zero))


# --- edits -------------------------------------------------------------------------

KEY = {"page": "page_id", "user": '"user"'}
OTHER = {"page": '"user"', "user": "page_id"}


def history_sql(by: str, part: str) -> str:
    return f"""{REVISIONS}, placed as (
  select *, cast({part} as bigint) as part
  from (select *, row_number() over (partition by {KEY[by]} order by ts, rev_id) as n from revisions)),
latest as (
  select {KEY[by]}, {tags_sql("arg_max(" + glued_sql("comment") + ", n)")} as actions
  from placed where {glued_sql("comment")} <> '' group by all),
packed as (
  select {KEY[by]}, part, cast(count(*) as bigint) as edits, string_agg(ts, ' ' order by n) as timestamps,
         string_agg(cast({OTHER[by]} as varchar), ' ' order by n) as others
  from placed group by all),
totals as (select {KEY[by]}, cast(count(*) as bigint) as total from revisions group by all),
history as (
  select packed.*, total, coalesce(actions, '') as actions
  from packed join totals using ({KEY[by]}) left join latest using ({KEY[by]}))"""


def counts_sql(by: str, order: str) -> str:
    return f"""with {REVISIONS}, counted as (
  select {KEY[by]}, cast(count(*) as bigint) as edits from revisions group by all)
select *, row_number() over (order by {order}) as position from counted"""


def in_order(df: DataFrame) -> DataFrame:
    """With the place of each row in the order that ``df`` has, so that a wrong order shows."""
    return number_in_order(df, "position")


@query(counts_sql("page", "page_id"))
def edits_by_page(spark, sf_dir):
    return in_order(edits.sort_edits(edits.edit_counts(revisions(spark, sf_dir), "page"), "page", "key"))


@query(counts_sql("user", '"user"'))
def edits_by_user(spark, sf_dir):
    return in_order(edits.sort_edits(edits.edit_counts(revisions(spark, sf_dir), "user"), "user", "key"))


@query(counts_sql("user", 'edits, "user"'))
def users_by_edits(spark, sf_dir):
    return in_order(edits.sort_edits(edits.edit_counts(revisions(spark, sf_dir), "user"), "user", "edits"))


@query(f"""with {REVISIONS}
select page_id, ts, rev_id, "user", row_number() over (order by page_id, ts, rev_id) as position from revisions""")
def edit_log_by_page(spark, sf_dir):
    return in_order(edits.edit_log(revisions(spark, sf_dir), "page"))


@query(f"with {history_sql('page', '0')} select * from history")
def history_by_page(spark, sf_dir):
    return as_text(edits.edit_history(revisions(spark, sf_dir), "page"), "timestamps", "others", "actions")


@query(f"with {history_sql('user', '0')} select * from history")
def history_by_user(spark, sf_dir):
    return as_text(edits.edit_history(revisions(spark, sf_dir), "user"), "timestamps", "others", "actions")


@query(f"with {history_sql('user', '(n - 1) // 64')} select * from history")
def history_parts_by_user(spark, sf_dir):
    """Histories of more than 64 edits continue in further rows."""
    history = edits.edit_history(revisions(spark, sf_dir), "user", part_edits=64)
    return as_text(history, "timestamps", "others", "actions")


@query(f"""with {history_sql('page', '0')}
select page_id || chr(9) || concat_ws('!@#', edits, timestamps, others, actions) as value from history""")
def history_lines(spark, sf_dir):
    history = edits.edit_history(revisions(spark, sf_dir), "page")
    return sinks.history_lines(edits.sort_edits(history, "page", "edits"), "page")


@query(f"with {REVISIONS} select page_id, cast(count(*) as bigint) as edits from revisions group by page_id")
def edit_counts_from_lines(spark, sf_dir):
    """Counts read back from a history of which busy pages are saved in parts."""
    history = edits.edit_history(revisions(spark, sf_dir), "page", part_edits=100)
    return sources.parse_edit_counts(sinks.history_lines(history, "page"))


@query(f"with {history_sql('page', '(n - 1) // 64')} select * from history")
def history_round_trip(spark, sf_dir):
    """All parts of a history written as text lines, and read back whole."""
    history = edits.edit_history(revisions(spark, sf_dir), "page", part_edits=64)
    path = scratch_path(spark, "history")
    sinks.write_lines(sinks.history_lines(history, "page"), path)
    return as_text(sources.read_history(spark, path, "page"), "timestamps", "others", "actions")


# Names that hold what separates names, fields, and lines.
AWKWARD = "'u' || chr(92) || ' ' || {} || '!@#' || chr(9) || 's'"


def awkward(name: Column) -> Column:
    return F.concat(F.lit("u\\ "), name.cast("string"), F.lit("!@#\ts"))


def awkward_sql(by: str) -> str:
    """Histories by page or by user, whose users have awkward names."""
    return history_sql(by, "(n - 1) // 64").replace(
        'cast(user_id as varchar) as "user"', f"{AWKWARD.format('user_id')} as \"user\""
    )


def awkward_round_trip(spark, sf_dir, by):
    edited = revisions(spark, sf_dir).withColumn("user", awkward(F.col("user")))
    path = scratch_path(spark, "history")
    sinks.write_lines(sinks.history_lines(edits.edit_history(edited, by, part_edits=64), by), path)
    return as_text(sources.read_history(spark, path, by), "timestamps", "others", "actions")


@query(f"with {awkward_sql('user')} select * from history")
def history_round_trip_by_user(spark, sf_dir):
    """Histories of users with spaces, tabs, backslashes and separators in their names."""
    return awkward_round_trip(spark, sf_dir, "user")


@query(f"with {awkward_sql('page')} select * from history")
def history_round_trip_of_names(spark, sf_dir):
    """The same names within the histories of pages."""
    return awkward_round_trip(spark, sf_dir, "page")


@query(f"""with {history_sql('page', '0')}
select row_number() over (order by total, page_id) as position,
       page_id || chr(9) || concat_ws('!@#', edits, timestamps, others, actions) as value from history""")
def history_in_one_file(spark, sf_dir):
    """Sorted histories in a single file that the file system joined of parts, read in file order."""
    history = edits.sort_edits(edits.edit_history(revisions(spark, sf_dir), "page"), "page", "edits")
    path = scratch_path(spark, "merged")
    sinks.write_merged(sinks.history_lines(history, "page"), path)
    return number_lines(spark, path, "position")


@query(f"""with {REVISIONS}, counted as (
  select page_id, count(*) as n, min(ts) || '  ' || max(ts) as times from revisions group by page_id)
select row_number() over (order by n, page_id || ': ' || times) as position, cast(n as bigint) as n,
       page_id || ': ' || times as rest from counted""")
def lines_by_count(spark, sf_dir):
    """Saved lines sorted by the number in front; the rest of each keeps its spacing."""
    counted = revisions(spark, sf_dir).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    rest = F.concat(F.col("page_id").cast("string"), F.lit(": "), "first", F.lit("  "), "last")
    lines = sources.parse_counted(sinks.key_value_lines(counted, "n", rest))
    return in_order(lines.orderBy("n", "rest"))


@query(f"""select doc_id, {tags_sql("c")} as tags, concat_ws(' ', {", ".join(
    f"case when contains(lower(text), '{k}') then '{k}' end" for k in KEYWORDS)}) as word_safe_tags
from (select doc_id, text, {glued_sql("text")} as c from documents)""")
def action_tags(spark, sf_dir):
    text = F.col("text")
    masks = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", tag_mask(text).alias("tags"), tag_mask(text, word_safe=True).alias("word_safe_tags")
    )
    return masks.select("doc_id", *(mask_text(F.col(c)).alias(c) for c in ("tags", "word_safe_tags")))


def last_sql(tab: str, by: str, name: str, order: str) -> str:
    return f"""select {by} as {name}, {tags_sql("c")} as actions
from (select {by}, coalesce(arg_max({glued_sql("text")}, {order}) filter (where {glued_sql("text")} <> ''), '') as c
      from {tab} group by {by})"""


def union_sql(tab: str, by: str, name: str) -> str:
    hits = ", ".join(f"case when bool_or(contains(c, '{k}')) then '{k}' end" for k in KEYWORDS)
    return f"""select {by} as {name}, concat_ws(' ', {hits}) as actions
from (select {by}, {glued_sql("text")} as c from {tab}) group by {by}"""


@query(last_sql("documents", "source", '"user"', "doc_id"))
def last_actions_by_source(spark, sf_dir):
    return as_text(edits.last_actions(document_revisions(spark, sf_dir), "user"), "actions")


@query(union_sql("documents", "source", '"user"'))
def all_actions_by_source(spark, sf_dir):
    return as_text(edits.all_actions(document_revisions(spark, sf_dir), "user"), "actions")


@query(last_sql("conversations", "conv_id", "page_id", "turn"))
def last_actions_by_conversation(spark, sf_dir):
    return as_text(edits.last_actions(turn_revisions(spark, sf_dir), "page"), "actions")


@query(union_sql("conversations", "conv_id", "page_id"))
def all_actions_by_conversation(spark, sf_dir):
    return as_text(edits.all_actions(turn_revisions(spark, sf_dir), "page"), "actions")


# --- titles and balance ------------------------------------------------------------

PART_TITLES = """titles as (
  select cast(row_number() over (order by p_name, p_partkey) as bigint) as page_id, p_name as title from part)"""


def part_titles(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_name", "p_partkey")
    return number_rows(parts, ["p_name", "p_partkey"], "page_id").select("page_id", F.col("p_name").alias("title"))


@query(f"with {PART_TITLES} select page_id, title from titles")
def numbered_titles(spark, sf_dir):
    return part_titles(spark, sf_dir)


@query(f"with {PART_TITLES} select page_id, title from titles")
def titles_from_files(spark, sf_dir):
    """The same titles, numbered by their line in sorted text files."""
    path = scratch_path(spark, "titles")
    lines = table(spark, sf_dir, "part").orderBy("p_name", "p_partkey").select("p_name")
    sinks.write_lines(lines, path)
    return sources.read_titles(spark, path)


@query(f"""with {PART_TITLES},
edits as (select l_orderkey as page_id, cast(count(*) as bigint) as edits from lineitem group by l_orderkey)
select coalesce(titles.page_id, edits.page_id) as page_id, coalesce(title, '') as title, coalesce(edits, 0) as edits
from titles full join edits on titles.page_id = edits.page_id""")
def title_edits(spark, sf_dir):
    """Every line item is an edit of the page with its order's number."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_id"))
    return balance.title_edits(part_titles(spark, sf_dir), edits.edit_counts(lines, "page"))


BALANCE = """titles as (
  select cast(row_number() over (order by c_name) as bigint) as page_id, c_name as title from customer),
edits as (select o_custkey + 1 as page_id, count(*) as edits from orders group by all),
accesses as (
  select 'Customer#' || lpad(cast(user_id as varchar), 9, '0') as title,
         cast(sum(cast(floor(value) as bigint)) as bigint) as accesses
  from events group by all),
balances as (
  select title, coalesce(e.edits, 0) / cast(nullif(accesses, 0) as double) as ratio,
         cast(coalesce(e.edits, 0) as bigint) as edits, accesses
  from accesses left join (
    select title, sum(edits.edits) as edits from titles join edits using (page_id) group by title) e using (title))"""


@query(f"with {BALANCE} select title, ratio, edits, accesses from balances")
def edit_view_balance(spark, sf_dir):
    """Customers are numbered titles, their orders edits by number, events accesses by title."""
    titles = number_rows(table(spark, sf_dir, "customer").select("c_name"), ["c_name"], "page_id")
    orders = table(spark, sf_dir, "orders").select((F.col("o_custkey") + 1).alias("page_id"))
    views = table(spark, sf_dir, "events").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("title"),
        F.floor("value").cast("bigint").alias("views"),
    )
    return balance.edit_view_balance(
        titles.withColumnRenamed("c_name", "title"), edits.edit_counts(orders, "page"), counts.access_count(views)
    )


@query(f"""with {BALANCE}, seen as (
  select title, edits, case when right(title, 1) = '7' then 0 else accesses end as accesses from balances)
select title, edits / cast(nullif(accesses, 0) as double) as ratio,
       case when accesses > 0 then '' when edits = 0 then 'NaN' else 'Infinity' end as undefined, edits, accesses
from seen""")
def balance_lines(spark, sf_dir):
    """Lines of the sink, parsed again: numbers print differently in other engines.

    Titles that end in a 7 count as never seen, so their ratio is written as a word.
    """
    seen = edit_view_balance(spark, sf_dir).withColumn(
        "accesses", F.when(F.endswith("title", F.lit("7")), F.lit(0).cast("bigint")).otherwise(F.col("accesses"))
    )
    seen = seen.withColumn("ratio", balance.ratio(F.col("edits"), F.col("accesses")))
    fields = F.split(F.substring_index("value", "\t", -1), " ")
    ratio = fields[0]
    word = ratio.isin("NaN", "Infinity")
    return sinks.balance_lines(seen).select(
        F.substring_index("value", "\t", 1).alias("title"),
        F.when(~word, ratio.cast("double")).alias("ratio"),
        F.when(word, ratio).otherwise("").alias("undefined"),
        fields[1].cast("bigint").alias("edits"),
        fields[2].cast("bigint").alias("accesses"),
    )


@query(f"""with {BALANCE} select replace(title, '#', ' ') as title, ratio, edits, accesses from balances""")
def balance_from_text(spark, sf_dir):
    """The same from its three inputs as text, with runs of spaces in titles, all read back."""
    paths = [scratch_path(spark, name) for name in ("titles", "history", "accesses")]
    customers = table(spark, sf_dir, "customer").orderBy("c_name")
    spaced = lambda title, gap: F.replace(title, F.lit("#"), F.lit(gap))
    sinks.write_lines(customers.select(spaced(F.col("c_name"), "   ").alias("value")), paths[0])
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rev_id"),
        (F.col("o_custkey") + 1).alias("page_id"),
        F.lit("clerk").alias("user"),
        F.lpad(F.col("o_orderkey").cast("string"), 14, "0").alias("ts"),
        F.lit(None).cast("string").alias("comment"),
    )
    sinks.write_lines(sinks.history_lines(edits.edit_history(orders, "page", part_edits=10), "page"), paths[1])
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    # Two spellings of each title, which add up.
    gap = F.when(F.col("event_id") % 2 == 0, spaced(name, "  ")).otherwise(spaced(name, " "))
    views = table(spark, sf_dir, "events").select(gap.alias("title"), F.floor("value").cast("bigint").alias("views"))
    sinks.write_lines(sinks.key_value_lines(counts.access_count(views), "title", "accesses"), paths[2])
    return balance.edit_view_balance(
        sources.read_titles(spark, paths[0]),
        sources.read_edit_counts(spark, paths[1]),
        sources.read_access_counts(spark, paths[2]),
    )


@query(f"""with {TRAFFIC}
select title, edits / cast(nullif(accesses, 0) as double) as ratio, edits, accesses
from (select title, cast(count(*) filter (where project not in ('view', 'click')) as bigint) as edits,
             cast(sum(views) filter (where project in ('view', 'click')) as bigint) as accesses
      from traffic group by title) where accesses is not null""")
def balance_of_events(spark, sf_dir):
    """Views and clicks are accesses of a title, all other events are edits."""
    records = traffic(spark, sf_dir)
    seen = F.col("project").isin("view", "click")
    changed = records.where(~seen).groupBy("title").agg(F.count(F.lit(1)).alias("edits"))
    return balance.balance(changed, counts.access_count(records.where(seen)))


# --- link graphs -------------------------------------------------------------------


def key_links(spark, sf_dir):
    return table(spark, sf_dir, "events").select(key().cast("bigint").alias("src"), F.col("user_id").alias("dst"))


def order_links(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))


KEY_LINKS = "e as (select cast(json_extract_string(props, '$.k') as bigint) as src, user_id as dst from events)"
ORDER_LINKS = "e as (select l_orderkey as src, l_partkey as dst from lineitem)"


def ranks_sql(links: str, runs: int) -> str:
    steps = [
        f"""r{i} as materialized (
  select v.id, 0.15::double + 0.85::double * coalesce(s.received, 0) as rank
  from v left join (
    select w.dst, sum(r.rank / deg.links * w.m) as received
    from w join r{i - 1} r on r.id = w.src join deg on deg.src = w.src group by w.dst) s on s.dst = v.id)"""
        for i in range(1, runs + 1)
    ]
    return f"""{links},
w as materialized (select src, dst, count(*) as m from e group by all),
deg as materialized (select src, sum(m) as links from w group by src),
v as materialized (select src as id from w union select dst from w),
r0 as (select id, 1.0::double as rank from v),
{", ".join(steps)}, ranks as (select id, round(rank, 6) as rank from r{runs})"""


def rounded(ranks: DataFrame) -> DataFrame:
    """Six decimals: the order of summation is not fixed."""
    return ranks.withColumn("rank", F.round("rank", 6))


@query(f"""with {ORDER_LINKS}, v as (select src as id from e union select dst from e)
select id, cast(coalesce(n, 0) as bigint) as links
from v left join (select src, count(*) as n from e group by src) on src = id""")
def out_degree(spark, sf_dir):
    return ranking.out_degree(order_links(spark, sf_dir))


@query(f"with {ranks_sql(KEY_LINKS, 5)} select * from ranks")
def page_rank(spark, sf_dir):
    return rounded(ranking.page_rank(key_links(spark, sf_dir), runs=5))


@query(f"with {ranks_sql(ORDER_LINKS, 3)} select * from ranks")
def page_rank_parts(spark, sf_dir):
    return rounded(ranking.page_rank(order_links(spark, sf_dir), runs=3))


@query(f"with {ranks_sql(KEY_LINKS, 5)} select * from ranks")
def page_rank_spread(spark, sf_dir):
    """Sources with more than 20 targets send their rank in several shares of the links."""
    return rounded(ranking.page_rank(key_links(spark, sf_dir), runs=5, spread_links=20))


@query(f"with {ranks_sql(KEY_LINKS, 5)} select * from ranks")
def page_rank_resumed(spark, sf_dir):
    """Two steps, saved as text lines, then three more from the lines."""
    links = key_links(spark, sf_dir)
    half = ranking.page_rank(links, runs=2)
    lists = sinks.link_lists(ranking.merge_edges(links), ranking.out_degree(links), line_links=50)
    saved = cut_lineage(sinks.rank_lines(half, lists))
    start, links = sources.parse_ranks(saved)
    links, pages = sources.explode_links(links)
    ranks = ranking.page_rank(links, runs=3, pages=pages, start=start)
    return rounded(ranks.withColumn("id", F.col("id").cast("bigint")))


@query(f"""with {ranks_sql(ORDER_LINKS, 1)}
select p_partkey as page_id, p_name as title, rank from part join ranks on id = p_partkey""")
def rank_names(spark, sf_dir):
    titles = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), F.col("p_name").alias("title"))
    return rounded(balance.rank_names(ranking.page_rank(order_links(spark, sf_dir), runs=1), titles))


@query(f"with {PART_TITLES} select page_id, title from titles where page_id = 100")
def page_name(spark, sf_dir):
    return balance.page_names(part_titles(spark, sf_dir), 100)


@query(f"with {PART_TITLES} select page_id, title from titles where page_id = 100")
def page_name_from_files(spark, sf_dir):
    """One title of sorted text files, read from the block that holds it."""
    path = scratch_path(spark, "titles")
    sinks.write_lines(table(spark, sf_dir, "part").orderBy("p_name", "p_partkey").select("p_name"), path)
    return sources.read_title(spark, path, 100)


# Orders as titles, blown up to several files above 4 MB, and some of their numbers.
ORDER_TITLES = """titles as (
  select cast(row_number() over (order by o_orderkey) as bigint) as page_id,
         'Order ' || o_orderkey as title from orders)"""
ORDER_IDS = (1, 777, 3750, 3751, 7501, 11_249, 14_000, 15_000)


def order_title_files(spark, sf_dir, **options):
    path = scratch_path(spark, "titles")
    title = F.concat(F.lit("Order  "), F.rpad(F.col("o_orderkey").cast("string"), 1200, " "))
    lines = table(spark, sf_dir, "orders").repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey")
    lines.select(title.alias("value")).write.options(**options).text(path)
    return path


@query(f"with {ORDER_TITLES} select page_id, title from titles where page_id in {ORDER_IDS}")
def page_names_of_large_files(spark, sf_dir):
    """Titles of several large files by their numbers, through a saved index of their lines."""
    path, index = order_title_files(spark, sf_dir), scratch_path(spark, "index")
    sources.index_titles(spark, path, index)
    found = [sources.read_title(spark, path, i, index) for i in ORDER_IDS]
    return functools.reduce(DataFrame.unionByName, found)


@query(f"with {ORDER_TITLES} select page_id, title from titles where page_id in {ORDER_IDS[:4]}")
def page_names_of_gzip_files(spark, sf_dir):
    """The same of compressed files, which a task reads up to the line."""
    path = order_title_files(spark, sf_dir, compression="gzip")
    index = settle(spark, lambda: sources.line_index(spark, path))
    return functools.reduce(DataFrame.unionByName, [titles(line_at(spark, index, i)) for i in ORDER_IDS[:4]])


@query(f"with {ORDER_TITLES} select page_id, title from titles")
def titles_of_large_files(spark, sf_dir):
    """All titles of several files above 4 MB, numbered without shuffling or saving a line."""
    return sources.read_titles(spark, order_title_files(spark, sf_dir))


# --- records parsed from lines -----------------------------------------------------


# The largest bigint less a number of up to seven digits: 19 digits.
LONG = 9223372036854775807


def traffic_lines(spark, sf_dir):
    """Records as text; an ``error`` event has no number of views, and views have leading zeros
    and bytes 19 digits."""
    views = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.lpad(F.floor("value").cast("bigint").cast("string"), 25, "0")
    )
    return table(spark, sf_dir, "events").select(
        F.concat_ws(" ", "event_type", key(), views, (F.lit(LONG) - F.col("event_id")).cast("string")).alias("value")
    )


@query(f"""with {TRAFFIC}
select project, title, views, bytes from (
  select event_type as project, json_extract_string(props, '$.k') as title,
         cast(floor(value) as bigint) as views, 9223372036854775807 - event_id as bytes
  from events) where project <> 'error'""")
def traffic_from_lines(spark, sf_dir):
    good, _ = sources.parse_pagecounts(traffic_lines(spark, sf_dir), mode="reject")
    return good


@query("""
select concat_ws(' ', event_type, json_extract_string(props, '$.k'), 'n/a', 9223372036854775807 - event_id) as value,
       'views is not a number' as reason
from events where event_type = 'error'""")
def traffic_rejects(spark, sf_dir):
    _, bad = sources.parse_pagecounts(traffic_lines(spark, sf_dir), mode="reject")
    return bad


@query(f"""
select conv_id * 1000 + turn as rev_id, conv_id as page_id, turn as text_id,
       trim(regexp_replace(text, '{SPACE}', ' ', 'g')) as comment, turn as user_id, role as "user",
       lpad(cast(turn as varchar), 14, '0') as ts, 1 as minor
from conversations""")
def revisions_from_lines(spark, sf_dir):
    """Turns written as revision records with runs of spaces, and parsed again."""
    turn = F.col("turn").cast("string")
    line = F.concat_ws(
        "   ",
        (F.col("conv_id") * 1000 + F.col("turn")).cast("string"),
        F.col("conv_id").cast("string"),
        turn,
        "text",
        turn,
        "role",
        F.lpad(turn, 14, "0"),
        F.lit("1 0 NULL NULL"),
    )
    return sources.parse_revisions(table(spark, sf_dir, "conversations").select(line.alias("value")))


# An href of an anchor, quoted either way or not at all, wherever it stands in the tag.
HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?([^"'\s>]+)"""
HREFS = f"regexp_extract_all(html, '{HREF.replace(chr(39), chr(39) * 2)}', 1)"


@query(f"""
select cast(page_id as varchar) as src, dst, cast(count(*) as bigint) as m
from (select page_id, unnest({HREFS}) as dst from pages) group by all""")
def links_from_lines(spark, sf_dir):
    """Pages written as adjacency lines of their link targets, and parsed again."""
    targets = F.array_join(F.regexp_extract_all("html", F.lit(HREF), 1), " ")
    lines = table(spark, sf_dir, "pages").select(
        F.concat(F.col("page_id").cast("string"), F.lit(": "), squeeze(targets)).alias("value")
    )
    edges, _ = sources.explode_links(sources.parse_links(lines))
    return ranking.merge_edges(edges)
