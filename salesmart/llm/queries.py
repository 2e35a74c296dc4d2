"""The registered queries ``opN_<name>`` and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import (
    bpe, decision_list, decontaminate, filter_audit, html_extract, line_dedup, mixing, passages, quality, secrets, simhash, source_audit, url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


@query
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.report(table(spark, sf_dir, "pages"))


@query
def op5_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


SQL["op8_line_dedup"] = r"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE regexp_matches(text, '[^\x20\x09-\x0D]')),
lines AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
numbered AS (SELECT *, sum(CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id, text ORDER BY pos) AS no FROM lines),
piece AS (SELECT doc_id, text, dense_rank() OVER (PARTITION BY doc_id, text ORDER BY no) - 1 AS k,
    string_agg(line, chr(10) ORDER BY pos) AS raw FROM numbered GROUP BY doc_id, text, no),
p AS (SELECT *, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line, count(*) OVER (PARTITION BY doc_id, text) AS n,
    list(trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) OVER (PARTITION BY doc_id, text ORDER BY k
      ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS next FROM piece),
run AS (SELECT doc_id, text, k AS start, least(3, n) AS size, next AS content FROM p WHERE k <= n - least(3, n)
    UNION SELECT doc_id, text, k, 1, [line] FROM p WHERE length(line) >= 250),
later AS (SELECT doc_id, text, start, size FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, start) AS r FROM run) WHERE r > 1),
dead AS (SELECT DISTINCT doc_id, text, unnest(generate_series(start, start + size - 1)) AS k FROM later),
done AS (SELECT p.doc_id, p.text, count(*) AS n_lines, count(dead.k) AS n_deleted,
    coalesce(string_agg(p.raw, chr(10) ORDER BY p.k) FILTER (WHERE dead.k IS NULL), '') AS shown
    FROM p LEFT JOIN dead ON p.doc_id = dead.doc_id AND p.text = dead.text AND p.k = dead.k GROUP BY p.doc_id, p.text)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted,
    coalesce(shown, d.text) AS text
FROM documents d LEFT JOIN done ON d.doc_id = done.doc_id AND d.text = done.text
"""


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op9_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.rid, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
    coalesce(pos.n_hit, 0) > 0 AND 20 * coalesce(pos.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN items USING (rid)
"""


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


#: Rank file of the tokenizer that op11 uses, among the installed public ones.
TOKENIZER = "byte_bpe_50k.tiktoken"


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(TOKENIZER))
    return bpe.report(table(spark, sf_dir, "documents"), bpe.tables(ranks, public_tokenizers.PATTERN))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op12_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails
    FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, [ascii(y) - 64 FOR y IN string_split(left(filter_order, step - 1), '')] AS before,
    ascii(filter_order[step]) - 64 AS own FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
g AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
r AS (SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS bad,
    len([1 FOR b IN before IF fails[b]]) = 0 AS alive, len([1 FOR b IN fails IF b]) = 1 AS single FROM g, s),
c AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
    CAST(coalesce(sum(n) FILTER (alive AND NOT bad), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (alive AND bad), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (NOT alive AND bad), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (bad AND single), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (alive AND bad AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (alive AND bad AND toxic), 0) AS BIGINT) AS toxic_lost FROM r GROUP BY ALL)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM c
"""


@query
def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.report(table(spark, sf_dir, "documents"))


SQL["op13_source_audit"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
lt AS (SELECT lang, sum(lang_n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM d) d),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * lt.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (lt.total + 2 * lt.v) AS q
    FROM g JOIN lt USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
two AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(two.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN two ON two.lang = a.lang AND two.source = a.source AND two.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
