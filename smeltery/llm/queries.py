"""The corpus operators on their whole tables, one named query each, and SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import alignment, decontaminate, langid, lines, lm, mixing, quality, secrets, sharding, simhash, trie, urls, vafile
from smeltery.llm.common import id_remainder, stored, table, word_count

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_sharding(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return sharding.shard(table(spark, d, "documents"), shards=16).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_mixing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    return mixing.mix(sized).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source"
    )


def op5_decontamination(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op6_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    remainder = id_remainder(F.col("doc_id"), 3)
    filters = langid.learn(docs.where(remainder != 1))
    held_out = F.coalesce(remainder == 1, F.lit(False)).alias("held_out")
    found = langid.predict(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out, "lang_pred", "score")


def op7_exact_top_k(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    found = vafile.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op8_url_filters(spark: SparkSession, d: str) -> DataFrame:
    return urls.judge(table(spark, d, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op9_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    featured = stored(quality.with_statistics(docs), "quality-statistics")
    labels = table(spark, d, "labels").select("doc_id", "quality")
    remainder = id_remainder(F.col("doc_id"), 4)
    model = quality.fit(featured.where(remainder != 2).join(labels, "doc_id"), "quality")
    return quality.score(featured, model).select(
        "doc_id",
        F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op3_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    remainder = id_remainder(F.col("doc_id"), 10)
    model, counts = lm.fit(docs.where(remainder != 0), word_context=True)
    return lm.score(docs, model, counts).select(
        "doc_id",
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op10_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs).select("doc_id", F.col("source").alias("host"), "n_lines", "n_dropped", "text")


def op11_secret_scans(spark: SparkSession, d: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, d, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin([kind for kind, *_ in secrets.PATTERNS]))
    return found.select(
        "doc_id",
        *[secrets.count_of(spans, kind).alias(f"n_{kind}") for kind, *_ in secrets.PATTERNS],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"),
    )


def op12_cross_tokenizer_alignment(spark: SparkSession, d: str) -> DataFrame:
    aligned = alignment.align(table(spark, d, "documents").select("doc_id", "text"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    narrow = aligned.select("doc_id", *alignment.COUNTS, digest.alias("groups_sha256"), *alignment.PAIRS)
    return alignment.link_scores(narrow)


def op13_conversation_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return trie.prefix_trie(table(spark, d, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_sharding,
        op3_lm_scoring,
        op4_mixing,
        op5_decontamination,
        op6_language_id,
        op7_exact_top_k,
        op8_url_filters,
        op9_quality_classifier,
        op10_line_dedup,
        op11_secret_scans,
        op12_cross_tokenizer_alignment,
        op13_conversation_prefix_trie,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_URL_RULES = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))


def _rule_case(index: int) -> str:
    fits = "WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{then}'"
    cases = [fits.format(h=r[1], p=r[2], then=(r[0], r[1] + r[2])[index]) for r in _URL_RULES]
    return f"CASE {' '.join(cases)} END"


#: CRC-32 of an id in decimal, bit by bit.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), list_transform(range(8), lambda i: CAST(i AS BIGINT))),
        lambda bits, i: xor(bits >> 1, CASE WHEN bits & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT)"""

_TEST_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

SQL: dict[str, str] = {
    "op5_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TEST_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_TEST_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
            FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
        runs AS (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM d, (SELECT DISTINCT n FROM windows) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)),
        hits AS (SELECT DISTINCT r, i, n, item_id FROM runs JOIN windows USING (n, g)),
        words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
        found AS (
            SELECT r, count(DISTINCT item_id) AS n_items,
                string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM hits GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)
    """,
    "op7_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(coalesce(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])), 0) AS BIGINT) AS score
            FROM v AS q, v AS c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
        WHERE rank <= 20
    """,
    "op8_url_filters": rf"""
        WITH RECURSIVE rest AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM rest),
        parsed AS (
            SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM hosts),
        ruled AS (
            SELECT *, {_rule_case(1)} AS rule, {_rule_case(0)} AS action,
                list_transform(
                    list_filter(string_split(path, '/'), lambda x: x <> ''),
                    lambda x: CASE WHEN length(x) > {urls.LITERAL} THEN '*' ELSE regexp_replace(x, '[0-9]+', '{{n}}', 'g') END
                ) AS segments FROM parsed),
        tree AS (
            SELECT 0 AS level, host, segments, '' AS template, count(*) AS pages, count(action) AS labels,
                count(*) FILTER (action = 'block') AS blocked
            FROM ruled GROUP BY host, segments
            UNION ALL
            SELECT level + 1, host, segments, template || CASE WHEN own = '' THEN ''
                    WHEN kids > {urls.KIDS} AND p < {urls.THIN} * kids THEN '/*'
                    WHEN l >= {urls.LABELS} AND (b / l - usual) * (b / l - usual) * l
                        <= {urls.DEVIATIONS}::DOUBLE * greatest(usual * (1 - usual), {urls.VARIANCE}::DOUBLE) THEN '/+'
                    ELSE '/' || own END, pages, labels, blocked
            FROM (
                SELECT *, count(DISTINCT own) OVER node AS kids, sum(pages) OVER node AS p, sum(labels) OVER child AS l,
                    CAST(sum(blocked) OVER child AS DOUBLE) AS b,
                    CAST(sum(blocked) OVER node AS DOUBLE) / nullif(sum(labels) OVER node, 0) AS usual
                FROM (SELECT *, coalesce(segments[level + 1], '') AS own FROM tree)
                WINDOW node AS (PARTITION BY host, template), child AS (PARTITION BY host, template, own))
            WHERE level < (SELECT max(len(segments)) FROM ruled)),
        leaves AS (SELECT * FROM tree WHERE level = (SELECT max(len(segments)) FROM ruled)),
        judged AS (
            SELECT host, template, CASE WHEN (sum(blocked) + {urls.PRIOR * urls.PRIOR_WEIGHT}::DOUBLE)
                / (sum(labels) + {urls.PRIOR_WEIGHT}::DOUBLE) >= {urls.PURE}::DOUBLE THEN 'block' ELSE 'allow' END AS verdict
            FROM leaves GROUP BY ALL),
        known AS (SELECT t.host, t.segments, j.verdict FROM leaves AS t JOIN judged AS j USING (host, template))
        SELECT page_id, r.host, path, rule, coalesce(action, k.verdict) AS verdict
        FROM ruled AS r JOIN known AS k ON r.host = k.host AND r.segments = k.segments
    """,
    "op10_line_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
        counts AS (
            SELECT source, line, count(DISTINCT r) AS n FROM (SELECT r, source, unnest(lines) AS line FROM d)
            WHERE trim(line) <> '' GROUP BY ALL),
        totals AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
        found AS (
            SELECT counts.source, list(line) AS dropped FROM counts JOIN totals ON counts.source IS NOT DISTINCT FROM totals.source
            WHERE n >= {lines.LEAST} AND CAST(n AS DOUBLE) / total > {lines.RATIO}::DOUBLE GROUP BY counts.source),
        kept AS (
            SELECT doc_id, d.source, lines, CASE WHEN dropped IS NULL THEN lines
                ELSE list_filter(lines, lambda x: NOT list_contains(dropped, x)) END AS stay
            FROM d LEFT JOIN found ON d.source IS NOT DISTINCT FROM found.source)
        SELECT doc_id, source AS host, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
            CAST(coalesce(len(lines) - len(stay), 0) AS BIGINT) AS n_dropped, array_to_string(stay, chr(10)) AS text
        FROM kept
    """,
    "op13_conversation_prefix_trie": f"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h FROM t GROUP BY conv_id),
        turns AS (
            SELECT c.conv_id, t.p AS d, role, text FROM c JOIN t ON t.conv_id = c.base AND t.p <= c.h
            UNION ALL
            SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.p - c.h AS d, role, text
            FROM c JOIN t USING (conv_id) LEFT JOIN c AS b ON b.conv_id = c.base WHERE t.p > c.h),
        paths AS (
            SELECT conv_id, d, strlen(text) AS bytes, list({{'role': role, 'text': text}}) OVER (
                PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS seq FROM turns
            UNION ALL SELECT conv_id, 0, 0, [] FROM c),
        members AS (SELECT conv_id, d, bytes, min(conv_id) OVER (PARTITION BY d, seq) AS node FROM paths),
        nodes AS (SELECT node, d, count(*) AS n, any_value(bytes) AS bytes FROM members GROUP BY node, d),
        up AS (
            SELECT nodes.node, nodes.d, n, nodes.bytes, m.node AS top, m.d AS top_d
            FROM nodes JOIN members AS m ON m.conv_id = nodes.node AND m.d <= nodes.d),
        kids AS (SELECT top AS node, top_d AS d, count(*) AS kids FROM up WHERE d = top_d + 1 GROUP BY ALL),
        totals AS (
            SELECT top AS node, top_d AS d, count(*) FILTER (kids IS NULL) AS n_leaves, sum((n - 1) * bytes) AS saved
            FROM up LEFT JOIN kids USING (node, d) GROUP BY ALL),
        ends AS (
            SELECT node, d, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
            FROM members JOIN (SELECT conv_id, max(d) AS d FROM members GROUP BY conv_id) USING (conv_id, d) GROUP BY node, d)
        SELECT nodes.node AS conv_id, CAST(nodes.d AS BIGINT) AS depth, up.top AS parent_conv_id,
            CAST(nodes.n AS BIGINT) AS n_convs, CAST(coalesce(kids, 0) AS BIGINT) AS n_children,
            CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes JOIN totals USING (node, d) LEFT JOIN kids USING (node, d) LEFT JOIN ends USING (node, d)
        LEFT JOIN up ON up.node = nodes.node AND up.d = nodes.d AND up.top_d = nodes.d - 1
    """,
}
