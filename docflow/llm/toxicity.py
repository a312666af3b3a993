"""Toxicity by weak supervision: lexicon and pattern voters, a label model, a linear classifier.

Words, and beginnings of words, that toxic training documents have far more often than
others are the terms of small lexicons. Each lexicon is several voters, which vote for
toxic from one hit, from three, or from a share of the words; patterns of capitals,
marks and repetitions vote, too. ``label_model`` learns from the votes on all documents
how accurate and how correlated the voters are, and gives posterior labels; a linear
classifier on the hits learns these. Texts are read once for the votes and hits of all
documents, and once to find the training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import hash_spans, minhash, shingle_sets, slices, staged, utf8
from docflow.llm.label_model import LabelModel, fit_label_model, pair_counts

#: Documents of each label that terms are learned from, and of each posterior label that
#: the classifier is, at most.
TRAINING_ROWS = 10_000
#: Bytes of the beginnings of words; 0 stands for whole words.
KINDS = (0, 4, 5, 6, 7)
#: Terms of each kind, the documents that must have one, how many times more often, and
#: the logarithm of the likelihood ratio beyond that of the number of terms tried.
TERMS, LEAST_DOCUMENTS, LEAST_LIFT, LEAST_EVIDENCE = 160, 3, 2.0, 2.0
#: Terms of each kind that are counted in documents that are not toxic.
CANDIDATES = 20_000
LEXICONS_OF_WORDS, LEXICONS_OF_BEGINNINGS = 4, 2
RIDGE, NEWTON_STEPS = 1e-3, 12
#: Votes of a lexicon: hits, or hits per word.
HITS, SHARE = (1, 3), 0.01
#: Patterns and the share of tokens from which each votes.
PATTERNS = {"capitals": 0.1, "repeated": 0.05, "marks": 0.5, "exclamations": 0.02, "digits": 0.1, "long": 0.05}
LONG_WORD = 24

_SPACE, _MARK, _LETTER = 0, 1, 2
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_SALTS = np.random.default_rng(29).integers(1, 1 << 63, len(KINDS), np.uint64)


class Texts:
    """The words of a batch of texts: where they are, whose they are, and their terms."""

    def __init__(self, column: pa.Array):
        self.data, offsets = utf8(column)
        self.rows = len(column)
        kind = _KIND[self.data]
        change = np.zeros(len(self.data) + 1, bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[offsets] = True
        bounds = np.flatnonzero(change)
        starts, ends = bounds[:-1], bounds[1:]
        row = np.searchsorted(offsets, starts, "right") - 1
        kinds = kind[starts]
        self.tokens = np.bincount(row[kinds != _SPACE], minlength=self.rows)
        words = kinds == _LETTER
        self.marks = np.bincount(row[kinds == _MARK], minlength=self.rows)
        self.starts, self.ends, self.row = starts[words], ends[words], row[words]
        self.words = np.bincount(self.row, minlength=self.rows)
        self.hashes = hash_spans(self.data, self.starts, self.ends)
        self.offsets = offsets

    def terms(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each kind its number, and the rows and hashes of all terms in the texts."""
        size = self.ends - self.starts
        for k, length in enumerate(KINDS):
            if length:
                has = size > length
                hashes = hash_spans(self.data, self.starts[has], self.starts[has] + length)
            else:
                has, hashes = slice(None), self.hashes
            yield k, self.row[has], hashes ^ _SALTS[k]

    def patterns(self) -> np.ndarray:
        """The share of each pattern among the tokens of each row."""
        count = lambda rows: np.bincount(rows, minlength=self.rows)
        within = lambda flags: (c := np.concatenate([[0], np.cumsum(flags)]))[self.ends] - c[self.starts]
        size = self.ends - self.starts
        upper = (self.data >= 65) & (self.data <= 90)
        capitals = (size > 1) & (within(upper) == size)
        again = np.flatnonzero((self.hashes[1:] == self.hashes[:-1]) & (self.row[1:] == self.row[:-1])) + 1
        of_bytes = lambda flags: (c := np.concatenate([[0], np.cumsum(flags)]))[self.offsets[1:]] - c[self.offsets[:-1]]
        found = [
            count(self.row[capitals]), count(self.row[again]), self.marks, of_bytes(self.data == 33),
            of_bytes((self.data >= 48) & (self.data <= 57)), count(self.row[size > LONG_WORD]),
        ]
        return np.array(found, np.float64).T / np.maximum(self.tokens, 1)[:, None]


@dataclass
class Lexicons:
    """Terms by their hashes, in rising order, and the lexicon of each."""

    hashes: np.ndarray
    lexicon: np.ndarray
    count: int

    @property
    def voters(self) -> int:
        return self.count * (len(HITS) + 1) + len(PATTERNS)

    def hits(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, term, count`` of every term in every row, in this order."""
        rows, terms = [], []
        for _, row, h in texts.terms():
            at = np.searchsorted(self.hashes, h)
            found = np.flatnonzero(self.hashes[np.minimum(at, len(self.hashes) - 1)] == h) if len(self.hashes) else []
            rows.append(row[found])
            terms.append(at[found])
        pair, count = np.unique(np.concatenate(rows) * max(1, len(self.hashes)) + np.concatenate(terms), return_counts=True)
        return *np.divmod(pair, max(1, len(self.hashes))), count

    def votes(self, texts: Texts, row: np.ndarray, term: np.ndarray, count: np.ndarray, patterns: np.ndarray) -> np.ndarray:
        """A mask per row: of each lexicon its votes, then those of the patterns."""
        hits = np.zeros((texts.rows, self.count))
        np.add.at(hits, (row, self.lexicon[term]), count)
        cast = [hits >= n for n in HITS] + [(hits > 0) & (hits >= SHARE * texts.words[:, None])]
        each = np.stack(cast, 2).reshape(texts.rows, -1)
        each = np.column_stack([each, patterns >= np.array(list(PATTERNS.values()))])
        return (each.astype(np.int64) << np.arange(self.voters)).sum(1)


def training_documents(docs: DataFrame, labelled: DataFrame, most: int = TRAINING_ROWS) -> tuple[DataFrame, list[float]]:
    """``text, label`` of at most ``most`` documents of each label, and what one of each stands for.

    Drawn by a hash of their ids. Ids with both labels, null texts and labels other than
    0 and 1 are left out. Of documents with the same smallest shingle, which nearly all
    near copies of one document have, one stays. Ids that are repeated don't exceed the bound.
    """
    usable = labelled.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(
        F.min("label").cast("int").alias("label"), F.max("label").alias("_most")
    ).where("label = _most").drop("_most")
    totals = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    drawn = [usable.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    # At most ``most`` ids of each label.
    ids = staged(drawn[0].unionByName(drawn[1]), "drawn-ids")
    keyed = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(ids), "doc_id").withColumn("key", F.xxhash64("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                least = minhash(shingle_sets(part.column("text")), 2).astype(np.int64)
                columns = [part.column(c) for c in ("doc_id", "key", "label")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(least[:, 0] << 31 ^ least[:, 1])], ["doc_id", "key", "label", "sketch"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sketched = keyed.mapInArrow(sketch, f"doc_id {id_type}, key long, label int, sketch long")
    one = sketched.groupBy("label", "sketch").agg(F.min(F.struct(F.xxhash64("doc_id", "key").alias("h"), "doc_id", "key")).alias("of"))
    chosen = [one.where(F.col("label") == y).orderBy("of").limit(most) for y in (0, 1)]
    # At most ``most`` rows of each label.
    chosen = staged(chosen[0].unionByName(chosen[1]).select("of.doc_id", "of.key", "label"), "chosen-ids")
    sample = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).join(F.broadcast(chosen), ["doc_id", "key"])
    sample = staged(sample.groupBy("doc_id", "key", "label").agg(F.first("text").alias("text")).select("text", "label"), "training-documents")
    kept = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    return sample, [totals.get(y, 0) / max(1, kept.get(y, 0)) for y in (0, 1)]


def _term_counts(sample: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """``kind, term, documents``: how many texts have each term, or each of ``among``."""
    given = sample.sparkSession.sparkContext.broadcast(among)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                texts = Texts(part.column("text"))
                for k, row, h in texts.terms():
                    if given.value is not None:
                        at = np.minimum(np.searchsorted(given.value, h), max(0, len(given.value) - 1))
                        found = given.value[at] == h if len(given.value) else np.zeros(len(h), bool)
                        row, h = row[found], h[found]
                    order = np.lexsort([row, h])
                    row, h = row[order], h[order]
                    first = np.ones(len(h), bool)
                    first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                    terms, n = np.unique(h[first], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(terms), k, np.int32)), pa.array(terms.view(np.int64)), pa.array(n, pa.int64())], ["kind", "term", "documents"]
                    )

    return sample.select("text").mapInArrow(count, "kind int, term long, documents long").groupBy("kind", "term").agg(F.sum("documents").alias("documents"))


def learn_lexicons(sample: DataFrame) -> Lexicons:
    """Lexicons of the terms that best tell the sample's documents with label 1 from the others.

    Terms are ranked by their likelihood ratio; the driver holds those of each kind that
    are kept. Without documents of both labels there are none.
    """
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    lexicon_count = LEXICONS_OF_WORDS + LEXICONS_OF_BEGINNINGS * (len(KINDS) - 1)
    if len(sizes) < 2:
        return Lexicons(np.zeros(0, np.uint64), np.zeros(0, np.int64), lexicon_count)
    toxic = staged(_term_counts(sample.where("label = 1")).where(F.col("documents") >= LEAST_DOCUMENTS), "toxic-terms")
    often = [toxic.where(F.col("kind") == k).orderBy(F.desc("documents"), "term").limit(CANDIDATES).toPandas() for k in range(len(KINDS))]
    among = np.unique(np.concatenate([o["term"].to_numpy(np.int64).view(np.uint64) for o in often]))
    others = _term_counts(sample.where("label = 0"), among).toPandas()
    clean = dict(zip(others["term"], others["documents"], strict=True))
    hashes, lexicon, first = [], [], 0
    for k, found in enumerate(often):
        a = found["documents"].to_numpy(np.float64)
        b = np.array([clean.get(t, 0) for t in found["term"]], np.float64)
        p, q = (a + 0.5) / (sizes[1] + 1), (b + 0.5) / (sizes[0] + 1)
        ratio = a * np.log(p / q) + (sizes[1] - a) * np.log((1 - p) / (1 - q))
        # Of very many terms, some are frequent by chance: the ratio must make up for their number.
        least = np.log(max(1, len(found))) + LEAST_EVIDENCE
        best = [i for i in np.lexsort([found["term"], -ratio]) if p[i] >= LEAST_LIFT * q[i] and ratio[i] >= least][:TERMS]
        folds = LEXICONS_OF_BEGINNINGS if KINDS[k] else LEXICONS_OF_WORDS
        hashes += [int(np.int64(found["term"].iloc[i]).view(np.uint64)) for i in best]
        lexicon += [first + rank % folds for rank in range(len(best))]
        first += folds
    order = np.argsort(np.array(hashes, np.uint64))
    return Lexicons(np.array(hashes, np.uint64)[order], np.array(lexicon, np.int64)[order], lexicon_count)


def cast_votes(docs: DataFrame, lexicons: Lexicons, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` with ``votes, terms, counts, words, patterns`` of each whole text, null as empty."""
    given = docs.sparkSession.sparkContext.broadcast(lexicons)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column("text"))
                row, term, count = given.value.hits(texts)
                patterns = texts.patterns()
                votes = given.value.votes(texts, row, term, count, patterns)
                ends = pa.array(np.searchsorted(row, np.arange(texts.rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (term, count)]
                shares = pa.ListArray.from_arrays(pa.array(np.arange(texts.rows + 1, dtype=np.int32) * len(PATTERNS)), pa.array(patterns.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), pa.array(votes), *lists, pa.array(texts.words.astype(np.int64)), shares],
                    [*columns, "votes", "terms", "counts", "words", "patterns"],
                )

    types = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in columns).replace(", , ", ", ")
    schema = f"{types}votes long, terms array<int>, counts array<int>, words long, patterns array<double>"
    return docs.select(*columns, "text").mapInArrow(vote, schema)


def features(batch: pa.RecordBatch, terms: int) -> np.ndarray:
    """Per row the logarithm of each term's count, that of all hits per word, and the patterns."""
    n = batch.num_rows
    out = np.zeros((n, terms + 1 + len(PATTERNS)), np.float32)
    found = batch.column("terms")
    row = np.repeat(np.arange(n), np.diff(found.offsets.to_numpy()))
    counts = batch.column("counts").flatten().to_numpy()
    out[row, found.flatten().to_numpy()] = np.log1p(counts)
    hits = np.bincount(row, counts, minlength=n)
    out[:, terms] = np.log1p(100 * hits / np.maximum(batch.column("words").to_numpy(), 1))
    out[:, terms + 1 :] = batch.column("patterns").flatten().to_numpy().reshape(n, -1)
    return out


def train_linear(x: np.ndarray, target: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights, the last one a constant, of a logistic regression on soft labels by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    weights = weights / weights.sum()
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-9
    share = np.clip((weights * target).sum(), 1e-6, 1 - 1e-6)
    w[-1] = np.log(share / (1 - share))

    def loss(v):
        z = x @ v
        return (weights * (np.logaddexp(0, z) - target * z)).sum() + (ridge * v * v).sum() / 2

    now = loss(w)
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (weights * (p - target)) + ridge * w
        curve = x.T @ (x * (weights * p * (1 - p))[:, None]) + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        rate = 1.0
        while rate > 1e-4 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        before, now = now, loss(w)
        if before - now < 1e-10:
            break
    return w


@dataclass
class ToxicityModel:
    lexicons: Lexicons
    labels: LabelModel
    weights: np.ndarray


def _arrow(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([r.asDict() for r in rows], schema)


_ROW = pa.schema([
    ("votes", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
    ("words", pa.int64()), ("patterns", pa.list_(pa.float64())), ("posterior", pa.float64()),
])


def fit_toxicity_model(docs: DataFrame, labelled: DataFrame, training_rows: int = TRAINING_ROWS) -> tuple[ToxicityModel, DataFrame]:
    """The model, and the votes and hits of all ``docs`` (``doc_id, text``), which it learns from.

    ``labelled`` has ``doc_id, label``. Lexicons come from ``training_rows`` labelled
    documents of each label at most; the label model from the votes on all documents; the
    classifier from ``training_rows`` documents of each posterior label at most, drawn by a
    hash of id, votes and hits and weighted by what they stand for.
    """
    sample, stands_for = training_documents(docs, labelled, training_rows)
    lexicons = learn_lexicons(sample)
    voted = staged(cast_votes(docs, lexicons, "doc_id"), "votes")
    known = cast_votes(sample, lexicons, "label").groupBy("label", "votes").count().toPandas()
    anchors = np.zeros((2, lexicons.voters + 1, lexicons.voters + 1))
    for y in (0, 1):
        rows = known[known["label"] == y]
        anchors[y] = pair_counts(rows["votes"].to_numpy(np.int64), stands_for[y] * rows["count"].to_numpy(np.float64), lexicons.voters)
    histogram = staged(voted.groupBy("votes").agg(F.count("*").alias("n")), "votes-histogram")
    labels = fit_label_model(histogram, anchors, lexicons.voters)
    given = docs.sparkSession.sparkContext.broadcast(labels)

    def posterior(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(given.value.posterior(batch.column("votes").to_numpy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "posterior"])

    def with_posterior(df: DataFrame) -> DataFrame:
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInArrow(posterior, f"{types}, posterior double")

    toxic = F.col("posterior") >= 0.5
    totals = {r["toxic"]: r["n"] for r in with_posterior(histogram).groupBy(toxic.alias("toxic")).agg(F.sum("n").alias("n")).collect()}
    x, target, weights = [], [], []
    order = F.xxhash64("doc_id", "votes", "terms", "counts", "words")
    judged = with_posterior(voted.select(*_ROW.names[:-1], order.alias("h")))
    for y in (False, True):
        rows = judged.where(toxic == F.lit(y)).orderBy("h").limit(training_rows).drop("h").collect()
        if rows:
            batch = _arrow(rows, _ROW)
            x.append(features(batch, len(lexicons.hashes)))
            target.append(batch.column("posterior").to_numpy())
            weights.append(np.full(len(rows), totals[y] / len(rows)))
    width = len(lexicons.hashes) + 1 + len(PATTERNS)
    linear = train_linear(np.concatenate(x), np.concatenate(target), np.concatenate(weights)) if x else np.zeros(width + 1)
    return ToxicityModel(lexicons, labels, linear), voted


def score_votes(voted: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` by the linear classifier, from the staged hits."""
    given = voted.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = given.value.weights
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                z = features(part, len(given.value.lexicons.hashes)) @ w[:-1] + w[-1]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    return voted.mapInArrow(score, f"doc_id {voted.schema['doc_id'].dataType.simpleString()}, score double")


def score_toxicity(docs: DataFrame, labelled: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, score`` of every whole text: the chance that it is toxic.

    Reads ``doc_id`` and ``text`` of ``docs`` and ``doc_id`` and ``label`` of ``labelled``;
    other columns are not read. Null texts are scored as empty ones; repeated rows and
    null ids get a score each, equal texts equal ones. Without documents of both labels
    there are no lexicons, and the patterns alone vote. An empty table gives no rows.
    Scores of equal weight don't depend on the order of rows.
    """
    model, voted = fit_toxicity_model(docs.select("doc_id", "text"), labelled, training_rows)
    return score_votes(voted, model)
