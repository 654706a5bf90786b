"""The operators of this subpackage as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sales_engine.llm import quality, toxicity
from sales_engine.llm.collocations import collocations
from sales_engine.llm.contamination import mark_contaminated
from sales_engine.llm.exact import with_copies
from sales_engine.llm.fertility import judge_fertility
from sales_engine.llm.importance import resample
from sales_engine.llm.packing import pack
from sales_engine.llm.repeats import remove_repeats
from sales_engine.llm.sampling import round_trip
from sales_engine.llm.simhash import fingerprint_hex, near_components
from sales_engine.llm.url_rules import judge_urls
from sales_engine.llm.vocabularies import byte_bpe, pieces_model
from sales_engine.llm.warc import read_warc, write_warc
from sales_engine.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge_fertility(docs, byte_bpe(), pieces_model(), language="lang").drop("lang")


def op2_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(texts(spark, sf_dir), keep_text=False, run_words=51).drop("text")


def op3_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, weights).drop("text")


def op4_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(texts(spark, sf_dir), byte_bpe())


def op5_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = scratch_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), archive)
    return read_warc(spark, archive, payload=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(texts(spark, sf_dir), carry_text=False)


def op7_deletion_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_components(texts(spark, sf_dir), carry_text=False)
    return found.select("doc_id", fingerprint_hex(found.fingerprint).alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("text")


def op9_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(texts(spark, sf_dir), pieces_model())


URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op10_interval_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_window_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_contaminated(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"), carry_text=False)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"), carry_text=False)


QUERIES: dict[str, Query] = {
    "op1_fertility": op1_fertility,
    "op2_prefix_free_dedup": op2_prefix_free_dedup,
    "op3_ftrl_quality": op3_ftrl_quality,
    "op4_tier_packing": op4_tier_packing,
    "op5_sharded_warc": op5_sharded_warc,
    "op6_bloom_dedup": op6_bloom_dedup,
    "op7_deletion_simhash": op7_deletion_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_sampled_pieces": op9_sampled_pieces,
    "op10_interval_url_rules": op10_interval_url_rules,
    "op11_window_decontamination": op11_window_decontamination,
    "op12_collocations": op12_collocations,
    "op13_importance_resampling": op13_importance_resampling,
}

SQL: dict[str, str] = {
    "op5_sharded_warc": """
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        groups AS (SELECT hex, max(page_id) AS last_id FROM hashed GROUP BY hex),
        bits AS (
            SELECT hex, last_id, string_agg(CASE substr(hex, i, 1)
                WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011'
                WHEN '4' THEN '0100' WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111'
                WHEN '8' THEN '1000' WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011'
                WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110' ELSE '1111' END, '' ORDER BY i) AS b
            FROM groups, (SELECT unnest(range(1, 41)) AS i) AS places GROUP BY hex, last_id),
        digests AS (
            SELECT hex, last_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * CAST(substr(b, 5 * k + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * k + 2, 1) AS INT)
                  + 4 * CAST(substr(b, 5 * k + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * k + 4, 1) AS INT)
                  + CAST(substr(b, 5 * k + 5, 1) AS INT), 1), '' ORDER BY k) AS payload_digest
            FROM bits, (SELECT unnest(range(0, 32)) AS k) AS digits GROUP BY hex, last_id)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = last_id THEN NULL ELSE last_id END AS refers_to
        FROM hashed JOIN digests USING (hex)""",
    "op6_bloom_dedup": """
        WITH hashed AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)""",
    "op10_interval_url_rules": r"""
        WITH rests AS (
            SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
        rules(action, rule_host, rule_path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
            ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        fits AS (
            SELECT page_id, host, path, rule_host || rule_path AS rule, action,
                row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC) AS place
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
        FROM parts p LEFT JOIN fits f ON f.place = 1 AND f.page_id IS NOT DISTINCT FROM p.page_id
            AND f.host = p.host AND f.path = p.path""",
    "op11_window_decontamination": r"""
        WITH split AS (
            SELECT doc_id, row_number() OVER () AS r, list_filter(string_split(regexp_replace(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
                lambda x: x <> '') AS w FROM documents),
        items AS (
            SELECT item_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
                lambda x: x <> '') AS w FROM benchmark),
        starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM items WHERE len(w) > 0),
        windows AS (
            SELECT DISTINCT item_id, array_to_string(w[p:p + 9], ' ') AS gram, least(len(w), 10) AS n FROM starts),
        sizes AS (SELECT DISTINCT n FROM windows),
        places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM split),
        hits AS (
            SELECT r, p, n, item_id FROM (
                SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS gram FROM places, sizes WHERE p + n - 1 <= len(w))
            JOIN windows USING (gram, n)),
        hit_words AS (
            SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS place FROM hits) GROUP BY r),
        hit_items AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM split LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]'), lambda x: x <> '') AS w FROM pieces),
        grams AS (
            SELECT lang, size, array_to_string(w[p:p + size - 1], ' ') AS phrase
            FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM split), (SELECT unnest([1, 2, 3, 4]) AS size)
            WHERE p + size - 1 <= len(w)),
        f AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 30),
        cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
        parts AS (
            SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r,
                CAST(CAST(2000000 AS HUGEINT) * c.a // (l.a + r.a) AS BIGINT) AS score
            FROM cuts c
            JOIN f l ON l.lang = c.lang AND l.size = k AND l.phrase = array_to_string(w[1:k], ' ')
            JOIN f r ON r.lang = c.lang AND r.size = c.size - k AND r.phrase = array_to_string(w[k + 1:c.size], ' ')),
        best AS (
            SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_parts AS (
            SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, a
            FROM (SELECT *, unnest(range(1, size + 1)) AS i FROM candidates), (SELECT unnest([2, 3]) AS n)
            WHERE n < size AND i + n - 1 <= size),
        within AS (SELECT lang, phrase, max(a) AS m FROM inner_parts GROUP BY ALL)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
        FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN within i ON i.lang = b.lang AND i.phrase = b.phrase
        WHERE m IS NULL OR CAST(100 AS HUGEINT) * m < CAST(80 AS HUGEINT) * a
        QUALIFY rank <= 2000""",
    "op13_importance_resampling": r"""
        WITH texts AS (
            SELECT true AS wanted, 0 AS doc_id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents),
        split AS (
            SELECT wanted, doc_id, row_number() OVER () AS r, list_filter(string_split(regexp_replace(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
                lambda x: x <> '') AS w FROM texts),
        runs AS (
            SELECT wanted, r, array_to_string(w[p:p + n - 1], ' ') AS feature
            FROM (SELECT wanted, r, w, unnest(range(1, len(w) + 1)) AS p FROM split), (SELECT unnest([1, 2, 3]) AS n)
            WHERE p + n - 1 <= len(w)),
        bits AS (SELECT feature, CAST(encode(feature) AS BIT) AS b FROM (SELECT DISTINCT feature FROM runs)),
        crc AS (
            SELECT feature, xor(4294967295, list_reduce(
                list_transform(range(0, bit_length(b)), lambda i: CAST(get_bit(b, CAST(i - i % 8 + 7 - i % 8 AS INT)) AS BIGINT)),
                lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)), CAST(4294967295 AS BIGINT))) % 10000 AS bucket
            FROM bits),
        found AS (SELECT wanted, r, bucket FROM runs JOIN crc USING (feature)),
        counts AS (
            SELECT b.bucket, count(*) FILTER (NOT wanted) AS s, count(*) FILTER (wanted) AS t
            FROM (SELECT unnest(range(0, 10000)) AS bucket) b LEFT JOIN found f ON f.bucket = b.bucket GROUP BY b.bucket),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE)
                / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM counts),
        weights AS (
            SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM found JOIN gains USING (bucket) GROUP BY r),
        scored AS (
            SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT)
                    AS DOUBLE) + 0.5) / 4294967296.0))) AS BIGINT) AS score
            FROM split LEFT JOIN weights USING (r) WHERE NOT wanted),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
                count(*) FILTER (n_words >= 20) OVER () AS many FROM scored)
        SELECT doc_id, n_features, weight, score,
            CASE WHEN n_words >= 20 AND place <= 5 * many // 100 THEN place END AS rank FROM ranked""",
}
