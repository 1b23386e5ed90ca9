"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    langid,
    licenses,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    secrets,
    substring_dedup,
    url_filter,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.language_id(docs, drop=("text", "lang"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), drop=("text",))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_dedup(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents have no paths: source and language stand for the directories they come from."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"))
    found = licenses.license_scan(docs.select("doc_id", "text", path.alias("path")))
    return found.select("doc_id", "path", "license", "license_from", "cosine", "license_words")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), drop=("text",))
    return found.select("doc_id", "text_score", "meta_score", "quality_score", "good")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of(kind: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"] == kind)

    base = F.filter("secrets", lambda s: s["nth"] < len(secrets.BASE))
    return found.select(
        "doc_id",
        *(F.size(of(rule.kind)).cast("bigint").alias(f"n_{rule.kind}") for rule in secrets.BASE),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("secrets")).alias("spans"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt(turns))
    return found.withColumnRenamed("saved_bytes", "saved_tokens")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


_ALL = (
    op1_language_id,
    op2_decontaminate,
    op3_exact_dedup,
    op4_near_dedup,
    op5_substring_dedup,
    op6_license_scan,
    op7_quality,
    op8_mixing,
    op9_secret_scan,
    op10_url_filter,
    op11_prefix_trie,
    op12_collocations,
    op13_best_fit_packing,
)
QUERIES = {f.__name__: f for f in _ALL}

# --- the same in SQL ---------------------------------------------------------------

_ITEM_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SQL: dict[str, str] = {}

SQL["op2_decontaminate"] = f"""
with items as (select cast(item_id as varchar) as item, {_ITEM_WORDS} as w from benchmark),
windows as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i + 1 : i + 10], ' ') as s
  from (select item, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) as i from items where len(w) > 0)),
docs as (select doc_id, coalesce({_ITEM_WORDS}, []) as w from documents),
places as (
  select doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') as s
  from (select doc_id, w, n, unnest(range(0, len(w) - n + 1)) as i from docs cross join (select distinct n from windows))),
hits as (select doc_id, i, n, item from places join windows using (n, s)),
words as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (doc_id) left join found using (doc_id)"""

SQL["op3_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))"""

SQL["op5_substring_dedup"] = r"""
with docs as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
windows as (
  select doc_id, i, array_to_string(w[i : i + 49], ' ') as s
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from docs)),
least_doc as (select s, min(doc_id) as least_id from windows group by s),
cut as (
  select distinct doc_id, unnest(range(i, i + 50)) as j from windows join least_doc using (s) where doc_id > least_id),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as j from docs),
left_over as (
  select doc_id, string_agg(word, ' ' order by j) as kept, count(*) as n
  from words anti join cut using (doc_id, j) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from docs left join left_over using (doc_id)"""


def _spans_sql(nth: int, rule: secrets.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return rf"""
  select doc_id, {nth} as nth, '{rule.kind}' as kind, m.i,
         len(m.gap) + len(coalesce(m.hit, '')) as step, len(m.hit) as size, len(m.part) >= {rule.least} as counts
  from (select doc_id, unnest(list_transform(
    list_zip(string_split_regex(t, '{pattern}'), regexp_extract_all(t, '{pattern}', 0),
             regexp_extract_all(t, '{pattern}', {rule.group}),
             range(0, len(string_split_regex(t, '{pattern}')))),
    lambda x: {{'gap': x[1], 'hit': x[2], 'part': x[3], 'i': x[4]}})) as m
    from texts where regexp_matches(t, '{pattern}'))"""


SQL["op9_secret_scan"] = f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
matches as ({" union all ".join(_spans_sql(n, r) for n, r in enumerate(secrets.RULES))}),
placed as (
  select *, cast(sum(step) over (partition by doc_id, nth order by i) as bigint) as stop from matches),
spans as (
  select doc_id, nth, kind, stop - size as start, kind || ':' || (stop - size) || ':' || stop as span
  from placed where size is not null and counts),
per_doc as (
  select doc_id, count(*) filter (where nth = 0) as n_assign, count(*) filter (where nth = 1) as n_access,
         count(*) filter (where nth = 2) as n_hex,
         string_agg(span, ',' order by start, nth) filter (where nth < 3) as base,
         string_agg(span, ',' order by start, nth) as spans
  from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join per_doc using (doc_id)"""


def _rules_sql(says: dict[str, str]) -> str:
    """The longest rule that fits first."""
    cases = []
    for rule in sorted(says, key=len, reverse=True):
        host, path = rule[: rule.index("/")], rule[rule.index("/") :]
        cases.append(
            f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}') then '{says[rule]}'"
        )
    return f"case {' '.join(cases)} end"


SQL["op10_url_filter"] = rf"""
with parts as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages)
select page_id, host, path, {_rules_sql({r: r for _, r in url_filter.RULES})} as rule,
       coalesce({_rules_sql({r: v for v, r in url_filter.RULES})},
                case when list_has_any(string_split_regex(host, '[.-]'), {list(url_filter.LISTED_WORDS)})
                     then 'block' else 'allow' end) as verdict
from parts"""


SQL["op12_collocations"] = r"""
with docs as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
pieces as (
  select lang, regexp_extract_all(p, '[^\x20\x09]+') as w
  from (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as p from docs)),
places as (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from pieces, unnest([1, 2, 3, 4]) as s(size)),
counts as (
  select lang, size, array_to_string(w[i : i + size - 1], ' ') as phrase, count(*) as f
  from places group by all),
totals as (select lang, cast(sum(f) as bigint) as n from counts where size = 1 group by lang),
candidates as (
  select lang, size, phrase, string_split(phrase, ' ') as w, f as a from counts where size > 1 and f >= 30),
cuts as (
  select lang, size, phrase, w, a, k, array_to_string(w[1 : k], ' ') as first, array_to_string(w[k + 1 : size], ' ') as rest
  from (select *, unnest(range(1, size)) as k from candidates)),
scored as (
  select c.*, x.f as l, y.f as r, cast((cast(2000000 as hugeint) * a) // (cast(x.f as hugeint) + y.f) as bigint) as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = c.first and x.size = c.k
              join counts y on y.lang = c.lang and y.phrase = c.rest and y.size = c.size - c.k),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
within as (
  select distinct lang, a, array_to_string(w[i : i + m - 1], ' ') as phrase
  from (select lang, size, w, a, m, unnest(range(1, size - m + 2)) as i
        from candidates, unnest([2, 3]) as s(m) where m < size)),
kept as (
  select * from weakest c where not exists (
    select 1 from within x where x.lang = c.lang and x.phrase = c.phrase
      and cast(100 as hugeint) * x.a >= cast(80 as hugeint) * c.a)),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000"""

# CRC-32 of a text of ASCII digits, bit by bit (fixed values: its polynomial and start).
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c, ''), lambda x: ascii(x)::bigint)), "
    "lambda a, b: list_reduce(list_prepend(xor(a, b), range(0, 8)), "
    "lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)

SQL["op11_prefix_trie"] = f"""
with turns as (
  select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') as said
  from conversations where conv_id is not null),
own as (
  select c, list({{'said': said, 'size': octet_length(encode(text))}} order by turn nulls first, sha256(said)) as t
  from turns group by c),
heads as (select c, cast({_CRC.replace("(c, '')", "(cast(c as varchar), '')")} % 9 as int) as h from own),
built as (
  select o.c, list_concat(coalesce(b.t[1 : h], []), o.t[h + 1 :]) as t
  from own o join heads using (c) left join own b on b.c = o.c - o.c % 5),
prefixes as (
  select c, d, len(t) as n, list_transform(t[1 : d], lambda x: x.said) as p, case when d > 0 then t[d].size else 0 end as size
  from (select c, t, unnest(range(0, len(t) + 1)) as d from built)),
nodes as (
  select p, d, min(c) as conv_id, count(*) as n_convs, any_value(size) as size,
         sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where n = d), '')) as ends_sha256
  from prefixes group by p, d),
placed as (
  select a.p, a.d, b.p as parent, b.conv_id as parent_conv_id
  from nodes a left join nodes b on b.d = a.d - 1 and b.p = a.p[1 : a.d - 1]),
children as (select parent as p, count(*) as n_children from placed where parent is not null group by parent),
under as (
  select a.p, sum(case when k.n_children is null then 1 else 0 end) as n_leaves, sum((b.n_convs - 1) * b.size) as saved
  from (select p, d, unnest(range(0, d + 1)) as up from nodes) x
  join nodes b on b.p = x.p join nodes a on a.d = x.up and a.p = x.p[1 : x.up]
  left join children k on k.p = b.p group by a.p)
select conv_id, cast(d as bigint) as depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children,
       cast(n_leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens, ends_sha256
from nodes join placed using (p, d) join under using (p) left join children using (p)"""
