"""Registered queries of the operators, with production parameters, over
whole tables; ``ORACLE`` has DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bm25_decontam import contaminated
from .common import id_remainder
from .exact_dedup import exact_dedup
from .filter_audit import filter_audit
from .fuzzy_lines import dedup_lines
from .group_join import jaccard_components
from .hd_langid import identify
from .license_scan import scan_licenses
from .mixing import mix
from .kd_sharding import kd_shards
from .permuterm import spelling_variants, word_counts
from .quality_gam import quality_scores
from .simhash import simhash_components
from .suffix_dedup import strip_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


ORACLE["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents"""


@query
def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(_table(spark, sf_dir, "documents"), shards=8)


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
                          held_out=id_remainder("doc_id", 5) == 0)


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id", 4) == 2
    return identify(_table(spark, sf_dir, "documents"), train=~held_out).withColumn("held_out", held_out)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


MIX = {"lang_weights": {"en": 4, "de": 2, "fr": 2, "es": 2}, "seed": 11}


def domain_of_source() -> Column:
    """Four domains of sources, by the first hex digit of the md5 of their names."""
    digit = F.substring(F.md5("source"), 1, 1)
    return F.when(digit < "4", "domain0").when(digit < "8", "domain1").when(digit < "c", "domain2").otherwise("domain3")


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), domain=domain_of_source(), budget=lambda total: total * 3 // 4, epochs=3, **MIX)


def _fill_sql(name: str, nodes: str, parent: str, names: str) -> str:
    """DuckDB steps that share out parent_budget among the rows of ``nodes``."""
    order = f"ORDER BY weight = 0, capacity / greatest(weight, 1)::DOUBLE, capacity, {names}"
    return f"""
{name}_1 AS (SELECT *, coalesce(sum(capacity) OVER (PARTITION BY {parent} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER (PARTITION BY {parent} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
    FROM ({nodes})),
{name}_2 AS (SELECT *, weight > 0 AND capacity::HUGEINT * rest <= weight::HUGEINT * (parent_budget - used) AS full_ FROM {name}_1),
{name}_3 AS (SELECT *, parent_budget - coalesce(sum(CASE WHEN full_ THEN capacity END) OVER (PARTITION BY {parent}), 0) AS open_budget,
    coalesce(sum(CASE WHEN NOT full_ THEN weight END) OVER (PARTITION BY {parent}), 0) AS open_weight FROM {name}_2),
{name} AS (SELECT * EXCLUDE (parent_budget), CASE WHEN full_ THEN capacity WHEN weight = 0 THEN 0
    ELSE open_budget::HUGEINT * weight // open_weight END::BIGINT AS budget FROM {name}_3)"""


ORACLE["op8_mixing"] = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    greatest(1, (strlen(coalesce(text, '')) + 3) // 4)::BIGINT AS tokens, substring(md5(coalesce(source, '')), 1, 1) AS x FROM documents),
docs AS (SELECT * EXCLUDE (x), CASE WHEN x < '4' THEN 'domain0' WHEN x < '8' THEN 'domain1' WHEN x < 'c' THEN 'domain2' ELSE 'domain3' END AS domain FROM d),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * 3 AS capacity FROM docs GROUP BY ALL),""" + ",".join([
    _fill_sql("dom", "SELECT domain, sum(capacity)::BIGINT AS capacity, 1 AS weight, (SELECT sum(tokens)::BIGINT * 3 // 4 FROM leaf) AS parent_budget FROM leaf GROUP BY domain", "1", "domain"),
    _fill_sql("lan", "SELECT l.domain, lang, sum(l.capacity)::BIGINT AS capacity, CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END AS weight, any_value(dom.budget) AS parent_budget FROM leaf l JOIN dom USING (domain) GROUP BY l.domain, lang", "domain", "domain, lang"),
    _fill_sql("src", "SELECT l.*, 1 AS weight, lan.budget AS parent_budget FROM leaf l JOIN lan USING (domain, lang)", "domain, lang", "domain, lang, source")]) + """,
o AS (SELECT docs.*, src.tokens AS leaf_tokens, src.budget AS leaf_budget, src.budget // src.tokens AS rounds, src.budget % src.tokens AS part_budget,
    md5(concat_ws('-', '11', (src.budget // src.tokens)::VARCHAR, coalesce(doc_id::VARCHAR, ''), docs.tokens::VARCHAR)) AS h
    FROM docs JOIN src USING (domain, lang, source)),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM o)
SELECT doc_id, domain, lang, source, tokens, leaf_tokens, leaf_budget,
    (rounds + CASE WHEN part_budget > 0 AND 2 * run - tokens <= 2 * part_budget THEN 1 ELSE 0 END)::BIGINT AS copies FROM r"""


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strip_repeats(_table(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents"), min_words=1)


@query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), words=5)


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

# sets joined on their shingles, links closed by a recursive step
ORACLE["op11_ngram_join"] = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, {WORDS_SQL.format(text=LOWER_SQL)} AS ws FROM documents),
s AS (SELECT DISTINCT k, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM d),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
e AS (SELECT p.a, p.b FROM (SELECT x.k AS a, y.k AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.k <> y.k GROUP BY ALL) p
    JOIN n na ON na.k = p.a JOIN n nb ON nb.k = p.b WHERE 100 * p.c >= 80 * (na.n + nb.n - p.c)),
r AS (SELECT k, k AS at FROM d UNION SELECT r.k, e.b FROM r JOIN e ON r.at = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN r USING (k) JOIN d o ON o.k = r.at LEFT JOIN n ON n.k = d.k GROUP BY d.k, d.doc_id"""


SLIP = 97       # fixed value: how many of the hashes lose a letter


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(_table(spark, sf_dir, "documents"), damage=SLIP))


# crc32 from its polynomial, near words by single deletions at a place, roots by a recursive step
ORACLE["op12_spelling_variants"] = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, x: CASE WHEN c % 2 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
raw AS (SELECT doc_id, unnest(regexp_extract_all({LOWER_SQL}, '[a-zÀ-ÿ]+')) AS w FROM documents),
per AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM raw GROUP BY doc_id, w),
hashed AS (SELECT w, n, xor(4294967295, list_reduce(list_transform(range(1, len(x)::BIGINT, 2), lambda i: ('0x' || x[i:i + 1])::BIGINT),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295)) AS h FROM per, crc),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % {SLIP} = 0 THEN w[:h % len(w)] || w[h % len(w) + 2:] ELSE w END AS word, n
    FROM hashed) GROUP BY word HAVING sum(n) >= 3 AND len(word) >= 5),
del AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS less FROM words, unnest(range(1, len(word) + 1)) u(i)),
near AS (SELECT a.word, b.word AS near, b.n FROM del a JOIN del b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM del a JOIN words b ON a.less = b.word
    UNION SELECT b.word, a.word, a.n FROM del a JOIN words b ON a.less = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, encode(near))) AS near, max(n) AS near_n FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
    CASE WHEN near_n >= 2 * w.n THEN near_n END::BIGINT AS form_n FROM words w LEFT JOIN best USING (word)),
way AS (SELECT word, word AS at FROM forms UNION ALL SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN way USING (word)
JOIN forms last ON last.word = way.at AND last.form IS NULL"""


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


ORACLE["op13_filter_audit"] = f"""
WITH lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS_SQL.format(text="coalesce(text, '')")} AS ws, coalesce(good, 0) AS good,
    coalesce(toxic, 0) AS toxic, coalesce(min(doc_id) OVER (PARTITION BY coalesce(text, '')) < doc_id, false) AS e FROM documents LEFT JOIN lab USING (doc_id)),
m AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
    100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t), regexp_matches(t, '[#$%&*|]'), e][i]) AS fails FROM d),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT [a.x, b.x, c.x, p.x, q.x] AS ord FROM f a, f b, f c, f p, f q WHERE len(list_distinct([a.x, b.x, c.x, p.x, q.x])) = 5),
steps AS (SELECT array_to_string(ord, '') AS filter_order, step, ord[step] AS x, ord[:step - 1] AS before FROM o, unnest(range(1, 6)) u(step)),
r AS (SELECT part, filter_order, step, x, sum(CASE WHEN NOT list_has_any(fails, list_append(before, x)) THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN list_contains(fails, x) AND NOT list_has_any(fails, before) THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN list_contains(fails, x) AND list_has_any(fails, before) THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = [x] THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN list_contains(fails, x) AND NOT list_has_any(fails, before) THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN list_contains(fails, x) AND NOT list_has_any(fails, before) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM g, steps GROUP BY part, filter_order, step, x)
SELECT * EXCLUDE (x), sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley FROM r"""
