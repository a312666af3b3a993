"""Every operator query against SQL in another engine, or against a plain computation."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from docflow.llm import queries as q
from docflow.llm.common import in_fold, table
from docflow.llm.language import fit_language_model
from pyspark.sql import functions as F
from tokenizers import Tokenizer

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return connection


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in table(spark, DATA, "documents").collect()}


@pytest.mark.parametrize("name", q.ORACLE)
def test_query(spark, sql, name):
    df = q.QUERIES[name](spark, DATA)
    relation = sql.sql(q.ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in relation.fetchall()]
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, expected))


def encoded(texts, name, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    ids = sorted(texts)
    done = tokenizer.encode_batch([texts[i] for i in ids], add_special_tokens=False)
    return {i: np.array([*e.ids, end], "<u4") for i, e in zip(ids, done, strict=True)}


def test_packing_places_every_id_once(spark, texts):
    ids = encoded(texts, "word_bpe_49k.json", 2)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in q.op6_sequence_packing(spark, DATA).collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[doc])
            assert r.ids_crc32 == zlib.crc32(ids[doc][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[doc])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding == 0


def test_token_files_give_back_every_id(spark, texts):
    ids = encoded(texts, "byte_bpe_50k.json", 0)
    rows = {r.doc_id: r for r in q.op9_token_files(spark, DATA).collect()}
    at = 0
    for doc in sorted(ids):
        assert (rows[doc].start, rows[doc].n_tokens, rows[doc].ids_crc32) == (at, len(ids[doc]), zlib.crc32(ids[doc].tobytes()))
        at += len(ids[doc])
    assert len(rows) == len(ids)


def test_fingerprints_against_the_definition(spark, texts):
    rows = {r.doc_id: r for r in q.op7_fingerprints(spark, DATA).collect()}
    ids, by_text = sorted(texts), defaultdict(set)
    for doc, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, half, row = texts[doc], len(texts[doc]) // 2, rows[doc]
        changed = text[: len(text) - half] + texts[after][:half]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        same = sum(row.fingerprint[k : k + 4] == rows[after].fingerprint[k : k + 4] for k in range(0, 256, 4))
        assert row.near_next == same / 64
        by_text[text].add(row.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())

    def shingles(t):
        words = t.encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    wrong = []
    for doc, after in zip(ids, ids[1:], strict=False):
        text, half = texts[doc], len(texts[doc]) // 2
        a, b = shingles(text), shingles(text[: len(text) - half] + texts[after][:half])
        if a and b:
            wrong.append(abs(len(a & b) / len(a | b) - rows[doc].near_edited))
    assert np.mean(wrong) < 0.08


def test_language_of_held_out_documents(spark):
    rows = q.op10_language_id(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.97
    assert rows.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert rows.where(F.col("held_out") != in_fold(F.col("doc_id"))).count() == 0


def test_quality_of_held_out_documents(spark):
    rows = q.op1_quality(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out").toPandas()
    good, bad = rows[rows.quality == 1].score.values, rows[rows.quality == 0].score.values
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert ((rows.score >= 0.7) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()


def test_folds_are_those_of_the_definition(spark):
    for row in spark.range(50).select("id", in_fold(F.col("id")).alias("held")).collect():
        assert row.held == (zlib.crc32(str(row.id).encode()) % 4 == 2)


def test_language_sets_and_hits_against_python_sets(spark):
    """The filters' languages of each n-gram, hits and predictions, from n-grams counted one by one."""
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, DATA, "documents").orderBy("doc_id").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language_model(docs)

    def grams(text):
        plain = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
        plain = re.sub(" +", " ", plain)
        return [plain[i : i + n] for n in model.orders for i in range(len(plain) - n + 1)]

    counts = defaultdict(Counter)
    for _, text, lang in rows:
        counts[lang].update(grams(text))
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    known = defaultdict(set)
    for gram in set().union(*counts.values()):
        rates = {lang: c[gram] / totals[lang] for lang, c in counts.items() if gram in c}
        known[gram] = {lang for lang, rate in rates.items() if counts[lang][gram] >= 2 and rate >= 0.3 * max(rates.values())}
    assert model.languages == sorted(counts)
    total, hits = model.hits([r[1] for r in rows])
    for i, (_, text, _) in enumerate(rows):
        found = grams(text)
        exact = np.array([sum(lang in known[g] for g in found) for lang in model.languages])
        assert total[i] == len(found)
        # A Bloom filter loses none; what it adds is within its rate of false positives.
        spare = hits[i] - exact
        assert (spare >= 0).all() and (spare <= 10 + 3 * model.false_rate * len(found)).all()
        names, score = model.predict([text])
        if exact.max():
            assert names[0] == model.languages[int(exact.argmax())] or sorted(exact)[-1] - sorted(exact)[-2] <= spare.max()
            assert abs(score[0] - exact.max() / exact.sum()) < 0.02


def test_quality_scores_against_loops(spark):
    """Buckets, context vectors, pooled vectors and the network, token by token."""
    from docflow.llm import quality

    rows = [(r.doc_id, r.text) for r in table(spark, DATA, "documents").orderBy("doc_id").limit(40).collect()]
    rows += [(1000, None), (1001, ""), (1002, "ONE one one TWO 3 4x5 !! ?? é É")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = {}
    tokens = {}
    for doc, text in rows:
        data = (text or "").encode()
        words = re.findall(rb"[A-Za-z\x80-\xff]+|[^A-Za-z\x80-\xff\x20\x09-\x0d]+", data)
        bucket, bounds = quality.tokens(pa.array([text], pa.string()))
        assert bounds.tolist() == [0, len(words)]
        for i, (word, b) in enumerate(zip(words, bucket.tolist(), strict=True)):
            letters = re.fullmatch(rb"[A-Za-z\x80-\xff]+", word) is not None
            before = [w for w in words[:i] if re.fullmatch(rb"[A-Za-z\x80-\xff]+", w)]
            lower = word.lower()
            if letters and before and before[-1].lower() == lower:
                assert b == quality.REPEATED
            elif re.search(rb"[0-9]", word):
                assert b == quality.NUMBER
            elif len(word) > 1 and re.fullmatch(rb"[A-Z]+", word):
                assert b == quality.CAPITALS
            else:
                assert b >= quality.RESERVED and ids.setdefault(lower, b) == b
        tokens[doc] = bucket.tolist()
    index = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    for b in range(quality.BUCKETS):
        for place, sign in zip(quality._PLACES[b], quality._SIGNS[b], strict=True):
            index[b, place] = sign
    context = np.zeros_like(index)
    for found in tokens.values():
        for i, b in enumerate(found):
            for j in range(max(0, i - quality.WINDOW), min(len(found), i + quality.WINDOW + 1)):
                if i != j:
                    context[b] += index[found[j]]
    norms = np.sqrt((context**2).sum(1))
    context[norms > 0] /= norms[norms > 0][:, None]
    assert np.allclose(quality.context_vectors(docs), context, atol=1e-6)
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in rows], "doc_id long, label int")
    model = quality.fit_quality_model(docs, labels)
    w1, b1, w2, b2 = model.parameters
    for r in quality.score_quality(docs, model).collect():
        seen = np.array([[*context[b], *index[b]] for b in tokens[r.doc_id]]).reshape(-1, 2 * quality.DIMENSIONS)
        pooled = np.concatenate([seen.mean(0), seen.std(0), [math.log1p(len(seen))]]) if len(seen) else np.zeros(4 * quality.DIMENSIONS + 1)
        hidden = [math.tanh(sum((pooled - model.center) / model.scale * w1[:, k]) + b1[k]) for k in range(len(b1))]
        logit = sum(h * w for h, w in zip(hidden, w2, strict=True)) + float(b2)
        assert abs(r.score - 1 / (1 + math.exp(-logit / model.temperature))) < 1e-3
