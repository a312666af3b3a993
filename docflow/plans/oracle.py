"""The same results in plain SQL, to check the queries against another engine.

The SQL reads the tables by name. Queries over the folder itself name its path.
"""

from __future__ import annotations

FOLDER = "/root/testdata/sf0.01"

# Steps of the page conversion as (pattern, replacement), for pages with the tags
# the tables hold. Written tag by tag, unlike the engine's expression.
_HIDDEN = [
    (r"(?s)<!--.*?(?:-->|\z)", ""),
    (r"(?is)<script[^>]*>.*?(?:</script>|\z)", ""),
    (r"(?is)<style[^>]*>.*?(?:</style>|\z)", ""),
    (r"(?is)<head>.*?</head>", " "),
]
_BOILERPLATE = [
    (r"(?is)<nav>.*?</nav>", " "),
    (r"(?is)<footer>.*?</footer>", " "),
]
_TAGS = [
    (r"[ \t\r\n\f\v]+", " "),
    (r"(?i)<h1>", "\n\n# "),
    (r"(?i)<h2>", "\n\n## "),
    (r"(?i)<li>", "\n- "),
    (r"(?i)<br>", "\n"),
    (r"(?i)</?(?:p|h1|h2|div|ul|article|body|nav|footer)(?: [^>]*)?>", "\n\n"),
    (r'(?is)<a href="([^"]*)">(.*?)</a>', r"[\2](\1)"),
    (r"</?[a-zA-Z!][^>]*(?:>|\z)", ""),
]
_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"),
]
_BLANKS = [(" {2,}", " "), (r" ?\n ?", "\n"), (r"\n- ?\n+", "\n- "), (r"\n{3,}", "\n\n")]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _markdown(html: str, boilerplate: bool = True, extra: list | None = None) -> str:
    sql = html
    for pattern, new in _HIDDEN + (_BOILERPLATE if boilerplate else []) + (extra or []) + _TAGS:
        sql = f"regexp_replace({sql}, {_quoted(pattern)}, {_quoted(new)}, 'g')"
    for old, new in _ENTITIES:
        sql = f"replace({sql}, {_quoted(old)}, {_quoted(new)})"
    for pattern, new in _BLANKS:
        sql = f"regexp_replace({sql}, {_quoted(pattern)}, {_quoted(new)}, 'g')"
    return f"trim({sql}, chr(10) || ' ')"


_NAME = r"regexp_extract(regexp_replace({0}, '[?#].*$', ''), '([^/]*)/*$', 1)"
_SUFFIX = r"regexp_extract({0}, '^.+(\.[^.]+)$', 1)"
URL_NAME = _NAME.format("url")
URL_SUFFIX = _SUFFIX.format(URL_NAME)
COMPLETE = r"regexp_matches(html, '(?is)</html>(\s|<!--.*?-->)*\z')"

PAGE_METADATA = f"""to_json(map(
    ['file_name', 'file_size', 'file_extension', 'file_path', 'num_pages', 'confidence_score'],
    [{URL_NAME}, CAST(octet_length(encode(html)) AS VARCHAR), {URL_SUFFIX}, url, '0', '0.0']))"""



def _page_results(complete: str) -> str:
    return f"""
SELECT url AS document_path,
       {complete} AS success,
       CASE WHEN {complete} THEN {_markdown("html")} ELSE '' END AS content,
       CASE WHEN {complete} THEN CAST({PAGE_METADATA} AS VARCHAR) ELSE '{{}}' END AS metadata,
       CASE WHEN NOT ({complete}) THEN 'Invalid file' END AS error_message
FROM pages"""


RESULTS = _page_results(COMPLETE)


def _decoded(text: str) -> str:
    for old, new in _ENTITIES:
        text = f"replace({text}, {_quoted(old)}, {_quoted(new)})"
    return text


_TITLE = _decoded("trim(regexp_replace(regexp_extract(html, '(?s)<title>([^<]*)</title>', 1), '[ \\t\\r\\n]+', ' ', 'g'))")


def _cut(column: str) -> str:
    return f"CASE WHEN length({column}) > 50 THEN left({column}, 47) || '...' ELSE {column} END AS {column}"


TEXT_PATH = "source || '/' || doc_id || '.txt'"


def _text_results(success: str, pages: str, score: str, error: str) -> str:
    return f"""
SELECT {TEXT_PATH} AS document_path,
       {success} AS success,
       CASE WHEN {success} THEN CAST(length(text) AS VARCHAR) ELSE '' END AS content,
       CASE WHEN {success} THEN CAST(to_json(map(
           ['file_name', 'file_size', 'file_extension', 'file_path', 'num_pages', 'confidence_score'],
           [doc_id || '.txt', CAST(octet_length(encode(text)) AS VARCHAR), '.txt', {TEXT_PATH},
            {pages}, '{score}'])) AS VARCHAR) ELSE '{{}}' END AS metadata,
       CASE WHEN NOT ({success})
            THEN 'Error processing ' || {TEXT_PATH} || ': ' || {error} END AS error_message
FROM documents"""


ORDER_PATH = "'order/' || o_orderkey || '.html'"


def _order_image(mode: str) -> str:
    images = {
        "placeholder": "'<!-- image --><!-- image -->'",
        "referenced": "'<!-- image -->![Image](https://img.example/' || o_orderkey || '.png)'",
        "embedded": "'![Image](data:image/png;base64,' || base64(encode(o_orderstatus)) || ')<!-- image -->'",
    }[mode]
    return f"'## Order ' || o_orderkey || chr(10) || chr(10) || {images}"


# Tables are files, or folders of part files.
_FILES = f"read_blob('{FOLDER}/**/*.parquet')"
_FILE_NAME = "regexp_extract(filename, '([^/]*)$', 1)"

ORACLE: dict[str, str] = {
    "convert_pages": RESULTS,
    "convert_all_pages": _page_results("true"),
    "html_to_markdown": f"SELECT page_id, {_markdown('html')} AS content FROM pages",
    "html_to_markdown_full": (
        f"SELECT page_id, {_markdown('html', boilerplate=False)} AS content FROM pages"
    ),
    "table_markdown": f"""
SELECT {ORDER_PATH} AS document_path,
       {_order_image("embedded")} || chr(10) || chr(10)
       || '| Key | State \\| S | Priority |' || chr(10) || '|---|---|---|' || chr(10)
       || '| ' || o_orderkey || ' | ' || o_orderstatus || ' | ' || o_orderpriority || ' |'
       || chr(10) || chr(10) || 'End <here>' AS content
FROM orders""",
    "list_markdown": """
SELECT o_orderkey,
       concat_ws(chr(10), 'Order', '', (o_orderkey % 100) || '. ' || o_orderkey, '    - ' || o_orderstatus, '    - ' || o_orderpriority,
                 '        1. x', '        2. y', '    tail', (o_orderkey % 100 + 1) || '. last', '', '```',
                 '  ' || o_orderkey || chr(9) || o_orderstatus, '', '  end', '```') AS content
FROM orders""",
    "image_modes": f"""
SELECT {ORDER_PATH} AS document_path,
       {_order_image("placeholder")} || {{rest}} AS placeholder,
       {_order_image("referenced")} || {{rest}} AS referenced
FROM orders""".format(
        rest="chr(10) || chr(10) || 'Key State | S Priority' || chr(10) || o_orderkey || ' ' || o_orderstatus || ' '"
        " || o_orderpriority || chr(10) || chr(10) || 'End <here>'"
    ),
    "page_charsets": f"SELECT url AS document_path, true AS success, {_markdown('html')} AS content FROM pages",
    "page_metadata": f"""
WITH titled AS (SELECT page_id, url, {_TITLE} AS title FROM pages)
SELECT url AS document_path, CAST(CASE
    WHEN page_id % 2 = 0 AND title <> '' THEN to_json(map(['description', 'og:url', 'title'], ['Page ' || page_id || ' & more > less', 'u' || page_id, title]))
    WHEN page_id % 2 = 0 THEN to_json(map(['description', 'og:url'], ['Page ' || page_id || ' & more > less', 'u' || page_id]))
    WHEN title <> '' THEN to_json(map(['title'], [title])) END AS VARCHAR) AS document_metadata
FROM titled""",
    "document_blocks": f"""
WITH blocks AS (
    SELECT document_path, unnest(string_split(content, chr(10) || chr(10))) AS text,
           generate_subscripts(string_split(content, chr(10) || chr(10)), 1) - 1 AS pos
    FROM ({RESULTS}) WHERE success)
SELECT document_path, CAST(pos AS INTEGER) AS pos,
       CASE WHEN regexp_matches(text, '^#{{1,6}} ') THEN 'heading'
            WHEN text LIKE '- %' THEN 'list'
            WHEN text LIKE '| %' THEN 'table'
            WHEN text LIKE '![%' OR text = '<!-- image -->' THEN 'image'
            ELSE 'paragraph' END AS kind,
       text
FROM blocks WHERE text <> ''""",
    "document_tables": f"""
WITH cells AS (
    SELECT {ORDER_PATH} AS document_path, r.r AS "row", c.c AS col,
           CASE WHEN r.r = 0 THEN ['Key', 'State | S', 'Priority'][c.c + 1]
                ELSE [CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority][c.c + 1] END AS text
    FROM orders, (VALUES (0), (1)) r(r), (VALUES (0), (1), (2)) c(c))
SELECT document_path, 0 AS "table", "row", col, text FROM cells""",
    "table_spans": f"""
WITH laid AS (
    SELECT {ORDER_PATH} AS document_path, unnest(CASE o_orderkey % 5
        WHEN 0 THEN [(0, 0, 1, across, k), (0, across, 2, 1, 'S'), (1, 0, 1, 1, s),
                     (1, CASE WHEN across = 1 THEN 2 ELSE 1 END, 1, 1, 'x')]
        WHEN 1 THEN [(0, 0, least(down, 3), 1, 'side'), (0, 1, 1, 1, k), (1, 1, 1, 1, 'b'),
                     (2, CASE WHEN down > 2 THEN 1 ELSE 0 END, 1, 1, s), (2, CASE WHEN down > 2 THEN 2 ELSE 1 END, 1, 1, 'c')]
        WHEN 2 THEN [(0, 0, 3, 1, 'a'), (0, 1, 1, 2, k), (1, 1, 2, 1, 'c'), (1, 2, 1, 1, s), (2, 2, 1, 1, 'e')]
        WHEN 3 THEN [(0, 0, 3, 1, k), (0, 1, 1, 1, 'b'), (0, 2, 1, 1, 'c'), (1, 1, 1, 1, s), (2, 1, 1, 1, 'e')]
        ELSE [(0, 0, 2, 1, k), (0, 1, 2, 1, s), (2, 0, 1, 1, 'next')] END) AS c
    FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS s,
                 CAST(o_orderkey % 3 + 2 AS INTEGER) AS down, CAST(o_orderkey % 4 + 1 AS INTEGER) AS across FROM orders))
SELECT document_path, 0 AS "table", c[1] AS "row", c[2] AS col, c[3] AS row_span, c[4] AS col_span, c[5] AS text FROM laid""",
    "validate_suffix": f"""
SELECT url AS document_path, {URL_NAME} AS file_name, {URL_SUFFIX} AS suffix,
       lower({URL_SUFFIX}) = '.html' AS is_valid
FROM pages""",
    "validate_documents": f"""
WITH checked AS (
    SELECT url, CASE WHEN lower({URL_SUFFIX}) <> '.html' THEN 'suffix'
                     WHEN html = '' THEN 'empty'
                     WHEN NOT {COMPLETE} THEN 'truncated' END AS failed_rule
    FROM pages)
SELECT url AS document_path, failed_rule IS NULL AS is_valid, failed_rule,
       CASE WHEN failed_rule IS NOT NULL THEN 'Invalid file' END AS error_message
FROM checked""",
    "file_metadata": f"""
SELECT {URL_NAME} AS file_name, CAST(octet_length(encode(html)) AS BIGINT) AS file_size,
       {URL_SUFFIX} AS file_extension, url AS file_path
FROM pages""",
    "document_metadata": f"""
WITH m AS (
    SELECT {TEXT_PATH} AS path,
           ['file_name', 'file_size', 'file_extension', 'file_path', 'num_pages', 'confidence_score'] AS k,
           [doc_id || '.txt', CAST(octet_length(encode(text)) AS VARCHAR), '.txt', {TEXT_PATH},
            CAST(n_chars // 1000 AS VARCHAR),
            CASE WHEN n_chars < 1000 THEN '0.5' WHEN n_chars < 5000 THEN '0.75' ELSE '0.0' END] AS v,
           lang
    FROM documents)
SELECT path AS document_path,
       CAST(CASE WHEN lang = 'en' THEN to_json(map(k, v))
            ELSE to_json(map(list_append(k, 'document_metadata'), list_append(v, 'lang=' || lang)))
            END AS VARCHAR) AS metadata
FROM m""",
    "metadata_stringify": """
SELECT doc_id,
       CAST(to_json(map(['lang', 'n_chars', 'long'],
           [CASE WHEN lang = 'en' THEN '' ELSE lang END, CAST(n_chars AS VARCHAR),
            CASE WHEN n_chars > 500 THEN 'true' ELSE '' END])) AS VARCHAR) AS metadata,
       CASE WHEN lang = 'de' THEN '{}'
            WHEN source = 'src0' THEN '{"source":""}'
            ELSE '{"source":"' || source || '"}' END AS given_metadata
FROM documents""",
    "status_summary": f"""
SELECT count(*) AS total, count(*) FILTER (WHERE {COMPLETE}) AS succeeded,
       count(*) FILTER (WHERE NOT {COMPLETE}) AS failed
FROM pages""",
    "failures_report": f"""
SELECT url AS document_path, 'Invalid file' AS error_message FROM pages WHERE NOT {COMPLETE}""",
    "successes": f"SELECT document_path, metadata FROM ({RESULTS}) WHERE success",
    "preview": f"""
SELECT {_cut("document_path")}, CAST(success AS VARCHAR) AS success, {_cut("content")},
       {_cut("metadata")}, {_cut("error_message")}
FROM ({RESULTS} ORDER BY url LIMIT 20)""",
    "preview_uncut": f"""
SELECT document_path, CAST(success AS VARCHAR) AS success, content, metadata, error_message
FROM ({RESULTS} ORDER BY url LIMIT 40)""",
    "convert_python": _text_results(
        "length(text) >= 100",
        "CAST(1 + length(text) // 1000 AS VARCHAR)",
        "0.5",
        "'only ' || length(text) || ' characters'",
    ),
    "convert_timeout": _text_results("length(text) >= 30", "'0'", "0.0", "'timed out after 3 s'"),
    "convert_isolated": _text_results(
        "length(text) >= 100", "'0'", "0.0", "'converter process ended with exit code -9'"
    ),
    "list_documents": f"SELECT {_FILE_NAME} AS file_name, size AS file_size FROM {_FILES}",
    "tree_listing": """
SELECT coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, 'shelf' || doc_id % 5 AS shelf,
       CAST(sum(length(CAST(doc_id AS VARCHAR)) + 1) AS BIGINT) AS bytes
FROM documents GROUP BY ALL""",
    "read_content": f"""
SELECT {_FILE_NAME} AS file_name, size AS file_size,
       CAST(octet_length(content) AS BIGINT) AS content_bytes FROM {_FILES}""",
    "check_paths": """
WITH paths AS (
    SELECT CASE doc_id % 3 WHEN 0 THEN 'file' WHEN 1 THEN 'folder' ELSE 'missing ' || doc_id END AS path, doc_id % 3 AS k FROM documents)
SELECT k <> 2 AS "exists", CASE k WHEN 1 THEN 'is_file' WHEN 2 THEN 'exists' END AS failed_rule,
       count(*) AS documents, count(DISTINCT path) AS paths
FROM paths GROUP BY k""",
    "job_failures": f"""
SELECT {_FILE_NAME} AS file_name, size || ' bytes' AS reason FROM {_FILES} WHERE size > 10000""",
    "documents_source": "SELECT doc_id FROM documents WHERE doc_id % 5 = 3",
    "convert_directory": f"""
SELECT {_FILE_NAME} AS file_name, true AS success, CAST(size AS VARCHAR) AS content,
       CAST(NULL AS VARCHAR) AS error_message
FROM {_FILES}""",
    "job_resumed": f"""
SELECT {_FILE_NAME} AS file_name, CAST(size AS VARCHAR) AS content, CAST(1 AS BIGINT) AS times FROM {_FILES}""",
    "dealing_by_size": """
SELECT count(*) AS documents, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, true AS even FROM documents""",
    "jsonl_roundtrip": RESULTS,
    "jsonl_overwrite": RESULTS,
    "stream_convert": RESULTS,
    "stream_every_file": """
SELECT coalesce(source, 'none') AS kind, CAST(sum(length(CAST(doc_id AS VARCHAR)) + 1) AS BIGINT) AS bytes, true AS success
FROM documents GROUP BY ALL
UNION ALL SELECT '_SUCCESS', NULL, false""",
    "stream_documents": f"""
SELECT {_FILE_NAME} AS file_name, true AS success, CAST(size AS VARCHAR) AS content FROM {_FILES}
WHERE regexp_extract(filename, '/(pages[.]parquet(/[^/]*)?)$', 1) <> ''""",
}
