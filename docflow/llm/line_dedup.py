"""Line dedup by log templates: a parse tree of fixed depth, in DataFrame operations.

A line's leaf is its number of tokens and its first ``LEADING`` tokens; tokens with a
digit count as ``<*>``. Within a leaf, a token that few documents have at its position
is a variable field, too. Lines that agree in all that remains are one template, if
enough of it is fixed. Other lines stand for themselves: with their numbers, unless they
are mostly words. A template that occurs in several documents is dropped from all places
but its first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import staged

LEADING = 3
ANY = "<*>"
#: Tokens with a digit; a token is looked at once, from its beginning.
_NUMBERED = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def _tokens(masked):
    return F.array_remove(F.split(masked, " "), "")


def _plain(line):
    """A line with blanks for other white space."""
    return F.trim(F.translate(line, "\t\r\f\v", "    "))


def _masked(plain):
    """A plain lower-case line without numbers."""
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, _NUMBERED, ANY)).otherwise(plain)


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, key, line_no, leaf, line`` (a hash) of every line that has a token.

    ``own`` is a hash of the line with its numbers, where words are no more than half of
    it: such lines are data, and null where the numbers are fields of a text.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("key"), F.posexplode(F.split(F.lower("text"), "\n")).alias("line_no", "raw"))
    plain = lines.select("doc_id", "key", "line_no", _plain(F.col("raw")).alias("plain")).where("plain <> ''")
    tokens = plain.withColumn("tokens", _tokens(_masked(F.col("plain"))))
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, LEADING))
    words = F.size(F.filter("tokens", lambda t: t.rlike(r"\p{L}")))
    is_data = F.col("plain").rlike("[0-9]") & (2 * words <= F.size("tokens"))
    own = F.when(is_data, F.xxhash64(_tokens(F.col("plain"))))
    return tokens.select("doc_id", "key", "line_no", leaf.alias("leaf"), F.xxhash64("tokens").alias("line"), own.alias("own"))


def _documents(rows: DataFrame, *keys: str) -> DataFrame:
    """The number of documents in which each value of ``keys`` occurs."""
    return rows.groupBy(*keys, "doc_id", "key").agg(F.lit(1).alias("one")).groupBy(*keys).agg(F.count("*").alias("documents"))


def _generalised(docs: DataFrame, distinct: DataFrame, min_documents: int, least_fixed: float) -> DataFrame:
    """``leaf, line, template`` for the lines of ``distinct`` that are a template of their leaf.

    ``distinct`` has ``leaf, line, documents`` and one place (``at``) of each line.
    """
    wanted = distinct.groupBy(F.col("at.doc_id").alias("_id"), F.col("at.key").alias("_key")).agg(
        F.collect_list(F.struct(F.col("at.line_no").alias("line_no"), "leaf", "line", "documents")).alias("wanted")
    )
    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["_id"]) & (F.xxhash64(docs["text"]) == wanted["_key"]))
    texts = found.withColumn("parts", F.split(F.lower("text"), "\n")).select("parts", F.explode("wanted").alias("w"))
    tokens = _tokens(_masked(_plain(F.expr("parts[w.line_no]"))))
    # Rows that repeat a document bring its lines again.
    lines = texts.select("w.leaf", "w.line", "w.documents", tokens.alias("tokens")).dropDuplicates(["leaf", "line"])
    lines = staged(lines, "leaf-lines")
    placed = lines.select("leaf", "line", "documents", F.posexplode("tokens").alias("position", "token"))
    support = placed.groupBy("leaf", "position", "token").agg(F.sum("documents").alias("support"))
    fixed = support.where((F.col("support") >= min_documents) & (F.col("token") != ANY)).drop("support").withColumn("fixed", F.lit(True))
    marked = placed.join(fixed, ["leaf", "position", "token"], "left")
    word = F.when(F.col("fixed"), F.col("token")).otherwise(F.lit(ANY))
    after = F.col("position") >= LEADING
    merged = marked.groupBy("leaf", "line").agg(
        F.count("fixed").alias("fixed"), F.count("*").alias("length"),
        F.count(F.when(after, F.col("fixed"))).alias("fixed_after"), F.count(F.when(after, True)).alias("length_after"), F.sort_array(F.collect_list(F.struct("position", word.alias("word")))).alias("words")
    )
    # The leading tokens are alike in all lines of a leaf: they say nothing about the rest.
    enough = (F.col("fixed") >= least_fixed * F.col("length")) & (F.col("fixed_after") >= least_fixed * F.col("length_after"))
    return merged.where(enough).select("leaf", "line", F.xxhash64("leaf", "words.word").alias("template"))


def recurring_lines(docs: DataFrame, min_documents: int = 5, least_fixed: float = 0.75) -> DataFrame:
    """``doc_id, key, line_no`` of every place of a recurring template but its first."""
    lines = staged(_lines(docs.select("doc_id", "text")), "lines")
    leaves = _documents(lines, "leaf").where(F.col("documents") >= min_documents)
    # A template stays within its leaf: lines of other leaves cannot recur.
    lines = staged(lines.join(leaves.select("leaf"), "leaf", "left_semi"), "hot-lines")
    place = F.struct("doc_id", "key", "line_no")
    distinct = _documents(lines, "leaf", "line").join(lines.groupBy("leaf", "line").agg(F.min(place).alias("at")), ["leaf", "line"])
    templates = _generalised(docs, distinct, min_documents, least_fixed)
    named = lines.join(templates, ["leaf", "line"], "left").select(
        "doc_id", "key", "line_no", F.coalesce("template", "own", F.xxhash64("leaf", "line")).alias("template")
    )
    named = staged(named, "named-lines")
    firsts = named.groupBy("template").agg(F.min(place).alias("first"))
    recurring = _documents(named, "template").where(F.col("documents") >= min_documents).join(firsts, "template").select("template", "first")
    return named.join(recurring, "template").where(~place.eqNullSafe(F.col("first"))).select("doc_id", "key", "line_no")


def drop_recurring_lines(docs: DataFrame, min_documents: int = 5, least_fixed: float = 0.75) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, and ``dropped_lines``, their number.

    Lines end at a line feed. A template recurs if it occurs in ``min_documents``
    documents; it has at least ``least_fixed`` of its tokens fixed, and of those after the
    leading ones, or differs in numbers only and is mostly words. Rows of numbers, dates and sums are one template only if
    they are equal. The first place (by doc_id, hash of the text, line) keeps it. Case and
    white space other than between tokens don't matter; blank lines stay. Null texts
    stay null, all rows stay, also those whose text becomes empty. Rows with the same id
    and text count as one document and get the same result; a null id is an id of its
    own. A column ``dropped_lines`` of the input is replaced.
    """
    drops = recurring_lines(docs, min_documents, least_fixed)
    sorted_drops = drops.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))
    # One byte per line up to the last one dropped, so that a line is looked up in constant time.
    marks = F.expr("cast(array_join(transform(gone, (x, i) -> concat(repeat('0', x - if(i = 0, 0, gone[i - 1] + 1)), '1')), '') AS binary)")
    marked = sorted_drops.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), marks.alias("_marks"), F.size("gone").alias("_count"))
    rows = docs.drop("dropped_lines")
    joined = rows.join(marked, rows["doc_id"].eqNullSafe(marked["_id"]) & (F.xxhash64(rows["text"]) == marked["_key"]), "left")
    left = F.expr("array_join(filter(split(text, '\\n'), (x, i) -> i >= octet_length(_marks) OR substring(_marks, i + 1, 1) = X'30'), '\\n')")
    return joined.select(
        *[F.when(F.col("_marks").isNull(), rows[c]).otherwise(left).alias(c) if c == "text" else rows[c] for c in rows.columns],
        F.coalesce("_count", F.lit(0)).alias("dropped_lines"),
    )
