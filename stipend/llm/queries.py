"""Registered queries of the operators, with production parameters, and their SQL."""

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import stipend
from stipend.llm import (
    langid, lexical, lines, minhash, mixing, packing, pii, quality, rules, simhash, spelling, topk, urls,
)

#: Rank file of the vocabulary of byte_bpe_50k.json.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Key of the registered pseudonym query; a real run takes its own from a secret store.
PSEUDONYM_KEY = "registered-query"

SHINGLE_WORDS, MAX_DISTANCE = 3, 3

#: The registered query takes a letter from one in so many words of a document.
TYPO_EVERY = 97

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(stipend.__file__).parent
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='stipend-')}/stipend", "zip", package.parent, package.name)
        context.addPyFile(archive)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"), SHINGLE_WORDS, MAX_DISTANCE)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.train(docs.where(~langid.held_out("doc_id")))
    return langid.predict(docs, model).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score", "spans")


def op3_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    given = spark.createDataFrame(urls.RULES, "verdict string, rule string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.url_verdicts(pages, given).select("page_id", "host", "path", "rule", "verdict")


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.drop_lines(docs)


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    judged = quality.classify(docs, table(spark, folder, "labels"))
    return judged.select("doc_id", "p_bad", "kept")


def op7_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymise(table(spark, folder, "documents"), PSEUDONYM_KEY)


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), VOCABULARY)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(table(spark, folder, "documents"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 20)


def op12_spelling_forms(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_forms(spelling.word_counts(table(spark, folder, "documents"), TYPO_EVERY))


def op13_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicate_groups(table(spark, folder, "documents"), words=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_dedup, op2_language_id, op3_exact_topk, op4_url_filter, op5_line_dedup,
        op6_quality_classifier, op7_pii_pseudonyms, op8_best_fit_packing, op9_mixing,
        op10_quality_rules, op11_lexical_search, op12_spelling_forms, op13_minhash_dedup,
    )
}

SQL: dict[str, str] = {}

SQL["op3_exact_topk"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.vec_id as query_id, b.vec_id,
           cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id
    where a.vec_id % 100 = 0
)
select query_id,
       cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as "rank",
       vec_id, score
from scored
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
"""

SQL["op4_url_filter"] = """
with split as (
    select page_id,
           translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) as path
    from pages
),
rules(verdict, rule, rule_host, rule_path) as (values
    ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
    ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
),
numbered as (select row_number() over () as n, * from split)
select any_value(page_id) as page_id, any_value(host) as host, any_value(path) as path,
       arg_max(rule, length(rule)) as rule, coalesce(arg_max(verdict, length(rule)), 'allow') as verdict
from numbered left join rules
  on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
group by n
"""

SQL["op10_quality_rules"] = r"""
with docs as (
    select row_number() over () as n, doc_id, source, coalesce(text, '') as text from documents
),
words as (
    select n, unnest(w) as word, generate_subscripts(w, 1) as i
    from (select n, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from docs)
),
windows as (
    select n, i, array_agg(word) over (
        partition by n order by i rows between current row and 7 following) as win
    from words
),
twice as (
    select n, i from (select n, i, count(*) over (partition by n, win) as c, len(win) as size from windows)
    where c > 1 and size = 8
),
repeated as (
    select n, count(distinct i + k) as n_repeat_words from twice, range(8) r(k) group by n
),
lines as (
    select n, source, line,
           len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words,
           lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) as norm
    from (select n, source, unnest(string_split(text, chr(10))) as line from docs)
    where regexp_matches(line, '[^\x20\x09-\x0D]')
),
frequent as (
    select source, norm from lines group by source, norm having count(distinct n) > 10
),
lost as (
    select n, sum(words) as lost_words
    from lines l join frequent f on l.norm = f.norm and l.source is not distinct from f.source
    group by n
),
dup as (select n, count(*) - count(distinct line) as n_dup_lines from lines group by n),
counted as (
    select doc_id,
           cast(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as bigint) as n_words,
           cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
           cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
           cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
           cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
           cast(coalesce(lost_words, 0) as bigint) as lost_words
    from docs left join dup using (n) left join repeated using (n) left join lost using (n)
),
judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (lost_words > 0 and (
           100 * lost_words > 50 * n_words or n_words - lost_words < 20)) as kept,
       lost_words
from judged
"""

SQL["op11_lexical_search"] = r"""
with docs as (
    select row_number() over () as r, doc_id, list_transform(
        regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as terms
    from documents
),
items as (
    select row_number() over () as i, item_id, unnest(list_transform(
        regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) as term
    from benchmark
),
wanted as (select i, item_id, term, cast(count(*) as bigint) as times from items group by all),
total as (
    select cast(count(*) filter (len(terms) > 0) as bigint) as nn, cast(sum(len(terms)) as bigint) as ll from docs
),
tf as (
    select r, doc_id, term, cast(count(*) as bigint) as tf, cast(any_value(size) as bigint) as n
    from (select r, doc_id, len(terms) as size, unnest(terms) as term from docs)
    where term in (select term from wanted)
    group by r, doc_id, term
),
weights as (
    select term, cast(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) as bigint) as w
    from tf, total group by term
),
scored as (
    select i, any_value(item_id) as item_id, r, any_value(doc_id) as doc_id, cast(sum(
        times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // ll)))) as bigint) as score
    from wanted join tf using (term) join weights using (term), total
    group by i, r
)
select item_id, cast(row_number() over (partition by i order by score desc, doc_id) as integer) as "rank", doc_id, score
from scored where score > 0
qualify row_number() over (partition by i order by score desc, doc_id) <= 20
"""

SQL["op12_spelling_forms"] = r"""
with recursive crc_table as (
    select list(c order by b) as t from (
        select b, list_reduce(list_prepend(cast(b as bigint), [cast(k as bigint) for k in range(8)]),
            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
        from range(256) r(b))
),
runs as (
    select doc_id, run, count(*) as n from (
        select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
        from documents)
    group by all
),
hashed as (
    select run, n, xor(list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(doc_id || ':' || run, ''),
            lambda c: case when unicode(c) < 128 then [cast(unicode(c) as bigint)]
                           else [cast(195 as bigint), cast(unicode(c) - 64 as bigint)] end))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
    from runs, crc_table
),
words as (
    select word, cast(sum(n) as bigint) as n from (
        select n, case when h % 97 = 0
            then substring(run, 1, cast(h % length(run) as bigint)) || substring(run, cast(h % length(run) as bigint) + 2)
            else run end as word
        from hashed)
    group by word having length(word) >= 5 and sum(n) >= 3
),
cut as (
    select word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
),
near as (
    select distinct * from (
        select a.word as word, a.n as n, b.word as other, b.n as n_other
        from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
        union all
        select a.word, a.n, b.word, b.n from cut a join words b on a.rest = b.word
        union all
        select b.word, b.n, a.word, a.n from cut a join words b on a.rest = b.word)
),
best as (
    select word, any_value(n) as n, count(*) as n_near,
           first(other order by n_other desc, other) as other, max(n_other) as n_other
    from near group by word
),
formed as (
    select w.word, w.n, coalesce(n_near, 0) as n_near,
           case when n_other >= 2 * w.n then other end as form, case when n_other >= 2 * w.n then n_other end as form_n
    from words w left join best using (word)
),
chain as (
    select word, word as last from formed
    union all
    select chain.word, form from chain join formed on chain.last = formed.word where form is not null
),
roots as (
    select chain.word, last as root from chain join formed f on chain.last = f.word where form is null
)
select word, form, root, n, cast(n_near as bigint) as n_near, cast(form_n as bigint) as form_n
from formed join roots using (word)
"""

SQL["op13_minhash_dedup"] = r"""
with recursive docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
),
sets as (
    select r, doc_id, list_sort(list_distinct(case when len(w) < 2 then w else list_transform(
        range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end)) as s
    from docs
),
nodes as (select min(r) as node, min(doc_id) as least_id, s, len(s) as n from sets where len(s) > 0 group by s),
held as (select node, n, unnest(s) as h from nodes),
often as (select h, count(*) as times from held group by h),
firsts as (
    select node, n, h from held join often using (h)
    qualify row_number() over (partition by node order by times, h) <= n - (80 * n + 99) // 100 + 1
),
pairs as (
    select distinct a.node as a, b.node as b from firsts a join firsts b using (h)
    where a.node < b.node and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
),
links as (
    select a, b from (
        select a, b, len(list_intersect(x.s, y.s)) as c, x.n + y.n as sizes
        from pairs join nodes x on a = x.node join nodes y on b = y.node)
    where 100 * c >= 80 * (sizes - c)
),
edges as (select a, b from links union select b, a from links),
reached as (
    select node as a, node as b from nodes
    union
    select r.a, e.b from reached r join edges e on r.b = e.a
),
components as (select a as node, min(least_id) as component_id from reached join nodes on b = node group by a)
select doc_id, cast(len(s) as bigint) as n_shingles,
       case when len(s) > 0 then component_id else doc_id end as component_id,
       len(s) = 0 or coalesce(doc_id = component_id, false) as kept
from sets left join nodes using (s) left join components using (node)
"""
