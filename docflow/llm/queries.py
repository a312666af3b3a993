"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.common import in_fold, table
from docflow.llm.cover_tree import linked_vectors
from docflow.llm.fingerprints import fingerprints
from docflow.llm.language import fit_language_model, identify_language
from docflow.llm.line_dedup import drop_recurring_lines
from docflow.llm.mixing import mixed
from docflow.llm.near_dedup import near_duplicates
from docflow.llm.packing import pack
from docflow.llm.quality import fit_quality_model, score_quality
from docflow.llm.token_files import read_token_files, write_token_files
from docflow.llm.toxicity import score_toxicity
from docflow.llm.url_filters import filter_urls
from docflow.llm.vector_codes import compress
from docflow.llm.whitening import whiten
from docflow.session import scratch_dir, ship_package


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    model = fit_quality_model(docs, labels.where(in_fold(F.col("doc_id"), held_out=False)))
    scores = score_quality(docs, model)
    return scores.select(
        "doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Pages against lists of the hosts, domains and first path segments that they have.

    The tables hold neither dates nor lists: a page is fetched on a day of the year given
    by its id, and the lists' history is derived from the table by hashes of the patterns.
    """
    pages = table(spark, folder, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.expr("date_add(DATE'2024-01-01', cast(page_id % 366 AS int))"))
    host = F.lower(F.regexp_extract("url", "://([^/?#]+)", 1))
    section = F.regexp_extract("url", "://[^/?#]+/([^/?#]+)", 1)
    patterns = pages.select(F.explode(F.array(
        host, F.concat_ws("/", host, section), F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    )).alias("pattern")).where("pattern <> ''").distinct()
    number = "cast(conv(substring(md5(pattern), {}, 4), 16, 10) AS int)"
    first = f"date_add(DATE'2024-01-01', {number.format(1)} % 200)"
    entries = patterns.select("pattern", F.expr(f"concat('list', {number.format(9)} % 3)").alias("list"), F.explode(F.array(
        F.struct(F.expr(first).alias("day"), F.lit("add").alias("action")),
        F.struct(F.expr(f"date_add({first}, 1 + {number.format(5)} % 60)").alias("day"), F.lit("remove").alias("action")),
        F.struct(F.expr(f"date_add({first}, 100 + {number.format(5)} % 60)").alias("day"), F.lit("add").alias("action")),
    )).alias("e")).where(f"{number.format(13)} % 4 = 0").select("list", "pattern", "e.day", "e.action")
    return filter_urls(captures, entries)


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(table(spark, folder, "documents"))[0].drop("key")


def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return near_duplicates(table(spark, folder, "documents"))


def op5_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return linked_vectors(table(spark, folder, "embeddings"))


def op6_sequence_packing(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return fingerprints(table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs)


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = fit_language_model(docs.where(in_fold(F.col("doc_id"), held_out=False)))
    labelled = identify_language(docs.select("doc_id", "text"), model)
    return labelled.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return whiten(table(spark, folder, "embeddings"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return compress(table(spark, folder, "embeddings"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    scores = score_toxicity(docs, labels.where(~held_out))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Links by counting the shingles that two documents share, then the smallest id reachable.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
    SELECT doc_id,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE
               WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
               WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
               ELSE [] END) AS s
    FROM words
), sizes AS MATERIALIZED (
    SELECT doc_id, count(s) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sizes s JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.n
"""

#: The state of a pattern on a day is that of its latest entry: no intervals.
URL_FILTERS_SQL = r"""
WITH parsed AS MATERIALIZED (
    SELECT page_id, url, DATE '2024-01-01' + (page_id % 366)::INTEGER AS fetched,
           lower(regexp_extract(url, '://([^/?#]+)', 1)) AS host,
           list_filter(string_split(lower(regexp_extract(url, '://[^/?#]+(/[^?#]*)', 1)), '/'), lambda s: s <> '') AS path,
           regexp_extract(url, '://[^/?#]+/([^/?#]+)', 1) AS section
    FROM pages
), patterns AS (
    SELECT DISTINCT pattern FROM (
        SELECT unnest([host, concat_ws('/', host, section), regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1)]) AS pattern FROM parsed
    ) WHERE pattern <> ''
), hashed AS (
    SELECT lower(rtrim(pattern, '/')) AS pattern, [('0x' || substring(md5(pattern), p, 4))::INTEGER FOR p IN [1, 5, 9, 13]] AS h FROM patterns
), listed AS (
    SELECT 'list' || (h[3] % 3) AS list, pattern, DATE '2024-01-01' + h[1] % 200 AS start, h[2] % 60 AS k FROM hashed WHERE h[4] % 4 = 0
), entries AS MATERIALIZED (
    SELECT DISTINCT list, pattern, unnest([start, start + 1 + k, start + 100 + k]) AS day, unnest(['add', 'remove', 'add']) AS action FROM listed
), asked AS (
    SELECT DISTINCT url, fetched, unnest(list_concat(
        list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
        list_transform(range(1, len(path) + 1), lambda i: host || '/' || array_to_string(path[1:i], '/')))) AS pattern
    FROM parsed
), latest AS (
    SELECT url, fetched, list, pattern, arg_max(action, (day, action)) AS action
    FROM asked JOIN entries USING (pattern) WHERE day <= fetched GROUP BY ALL
), hits AS (
    SELECT url, fetched, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM latest WHERE action = 'add' GROUP BY ALL
)
SELECT page_id, url, fetched, coalesce(lists, '') AS lists, lists IS NOT NULL AS blocked
FROM parsed LEFT JOIN hits USING (url, fetched)
"""

#: Targets, streams of words, the golden-ratio schedule, and the slots of each document's pieces.
SOURCE_MIXING_SQL = r"""
WITH sized AS MATERIALIZED (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, 2 * source_size AS room,
           (3 * sum(source_size) OVER () - 2 * coalesce(sum(2 * source_size) OVER w, 0))::DOUBLE / 2
           / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
    FROM sources
    WINDOW w AS (ORDER BY 2 * source_size / weight::DOUBLE, weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levelled AS (
    SELECT *, (SELECT arg_min(level, room / weight) FROM ordered WHERE room > weight * level) AS final FROM ordered
), targets AS MATERIALIZED (
    SELECT source, source_size, least(room::DOUBLE, coalesce(weight * final, room::DOUBLE)) AS target FROM levelled
), quotas AS MATERIALIZED (
    SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS source_no, ceil(floor(target) / 1024)::BIGINT AS blocks FROM targets
), shares AS (
    SELECT source_no, blocks, (until - blocks) * 4294967296::HUGEINT // greatest(total, 1) AS low, until * 4294967296::HUGEINT // greatest(total, 1) AS high
    FROM (SELECT *, (sum(blocks) OVER (ORDER BY source_no))::HUGEINT AS until, (sum(blocks) OVER ())::HUGEINT AS total FROM quotas)
), ranked AS MATERIALIZED (
    SELECT slot, source_no, blocks, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS rank
    FROM (SELECT slot, slot % 4294967296 * 1640531527 % 4294967296 AS point FROM (SELECT unnest(range(sum(blocks)::BIGINT)) AS slot FROM quotas))
    JOIN shares ON point >= low AND point < high
), missing AS (
    SELECT source_no, rank, row_number() OVER (ORDER BY source_no, rank) AS n FROM (
        SELECT q.source_no, unnest(range((SELECT count(*) FROM ranked r WHERE r.source_no = q.source_no AND r.rank < q.blocks), q.blocks)) AS rank FROM quotas q)
), schedule AS MATERIALIZED (
    SELECT slot, source_no, rank FROM ranked WHERE rank < blocks
    UNION ALL
    SELECT slot, m.source_no, m.rank FROM missing m
    JOIN (SELECT slot, row_number() OVER (ORDER BY slot) AS n FROM ranked WHERE rank >= blocks) USING (n)
), streams AS MATERIALIZED (
    SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS most, source_no,
           coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5('mix|' || doc_id), doc_id, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source
), pieces AS (
    SELECT source_no, before, unnest(range((start // 1024)::BIGINT, ((least(start + size, most) - 1) // 1024 + 1)::BIGINT)) AS rank
    FROM (SELECT *, before + unnest([0, source_size]) AS start FROM streams WHERE size > 0) WHERE start < most
), placed AS (
    SELECT source_no, before, min(slot) AS first_slot, count(*) AS slots FROM pieces JOIN schedule USING (source_no, rank) GROUP BY ALL
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(s.before + size, most) - s.before)
        + greatest(0, least(s.before + source_size + size, most) - s.before - source_size))::BIGINT AS taken,
       first_slot::BIGINT AS first_slot, coalesce(slots, 0)::BIGINT AS slots
FROM streams s LEFT JOIN placed p ON s.source_no = p.source_no AND s.before = p.before AND s.size > 0
"""

#: All pairs of usable vectors by cosine, then the smallest id reachable.
LINKED_VECTORS_SQL = r"""
WITH RECURSIVE usable AS MATERIALIZED (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.9
), reach AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, coalesce(any_value(c.n), 0)::BIGINT AS n_links, min(r.other) AS component_id, r.vec_id = min(r.other) AS kept
FROM reach r LEFT JOIN counted c USING (vec_id) GROUP BY r.vec_id
"""

#: Leaves, templates and first places as text instead of hashes.
RECURRING_LINES_SQL = r"""
WITH lines AS MATERIALIZED (
    SELECT doc_id, text, line_no, line,
           list_filter(string_split(plain, ' '), lambda t: t <> '') AS raw,
           list_filter(string_split(regexp_replace(plain, '(^| )[^ ]*[0-9][^ ]*', '\1<*>', 'g'), ' '), lambda t: t <> '') AS tokens
    FROM (SELECT *, translate(lower(line), chr(9) || chr(13) || chr(12) || chr(11), '    ') AS plain
          FROM (SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS line_no,
                       unnest(string_split(text, chr(10))) AS line FROM documents))
), leaved AS MATERIALIZED (
    SELECT *, {'n': len(tokens), 'lead': tokens[1:3]} AS leaf,
           len(list_filter(raw, lambda t: regexp_matches(t, '[0-9]'))) > 0
           AND 2 * len(list_filter(tokens, lambda t: regexp_matches(t, '\p{L}'))) <= len(tokens) AS is_data
    FROM lines WHERE len(tokens) > 0
), counted AS MATERIALIZED (
    SELECT leaf, tokens, count(DISTINCT {'d': doc_id, 't': text}) AS documents FROM leaved GROUP BY ALL
), placed AS MATERIALIZED (
    SELECT leaf, tokens, documents, unnest(range(1, len(tokens) + 1)) AS pos, unnest(tokens) AS token FROM counted
), support AS (
    SELECT leaf, pos, token, sum(documents) AS s FROM placed GROUP BY ALL
), merged AS MATERIALIZED (
    SELECT leaf, tokens,
           count(*) FILTER (s >= 5 AND token <> '<*>') AS fixed,
           count(*) FILTER (s >= 5 AND token <> '<*>' AND pos > 3) AS fixed_after,
           list(CASE WHEN s >= 5 THEN token ELSE '<*>' END ORDER BY pos) AS words
    FROM placed JOIN support USING (leaf, pos, token) GROUP BY leaf, tokens
), named AS MATERIALIZED (
    SELECT doc_id, text, line_no, leaf,
           CASE WHEN fixed >= 0.75 * len(tokens) AND fixed_after >= 0.75 * greatest(0, len(tokens) - 3) THEN {'kind': 'template', 'w': words}
                WHEN is_data THEN {'kind': 'data', 'w': raw}
                ELSE {'kind': 'line', 'w': tokens} END AS template
    FROM leaved JOIN merged USING (leaf, tokens)
), recurring AS MATERIALIZED (
    SELECT leaf, template, min({'d': doc_id, 'l': line_no}) AS first FROM named
    GROUP BY ALL HAVING count(DISTINCT {'d': doc_id, 't': text}) >= 5
), dropped AS MATERIALIZED (
    SELECT DISTINCT doc_id, text, line_no FROM named JOIN recurring USING (leaf, template)
    WHERE {'d': doc_id, 'l': line_no} <> first
)
SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (d.line_no IS NULL), '') AS text,
       count(d.line_no)::INTEGER AS dropped_lines
FROM lines l LEFT JOIN dropped d ON l.doc_id = d.doc_id AND l.text = d.text AND l.line_no = d.line_no
GROUP BY l.doc_id, l.text
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_url_filters": op2_url_filters,
    "op3_source_mixing": op3_source_mixing,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_cover_tree": op5_cover_tree,
    "op6_sequence_packing": op6_sequence_packing,
    "op7_fingerprints": op7_fingerprints,
    "op8_line_dedup": op8_line_dedup,
    "op9_token_files": op9_token_files,
    "op10_language_id": op10_language_id,
    "op11_whitening": op11_whitening,
    "op12_vector_codes": op12_vector_codes,
    "op13_toxicity": op13_toxicity,
}

#: The same in SQL, where SQL can express it.
ORACLE: dict[str, str] = {
    "op2_url_filters": URL_FILTERS_SQL,
    "op3_source_mixing": SOURCE_MIXING_SQL,
    "op4_minhash_near_dedup": NEAR_DUPLICATES_SQL,
    "op5_cover_tree": LINKED_VECTORS_SQL,
    "op8_line_dedup": RECURRING_LINES_SQL,
}
