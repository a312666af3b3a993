"""Language identification by bit-sliced Bloom filters of character n-grams.

One table holds the filters of all languages: bit ``l`` of a slot belongs to language
``l``, so that the AND of an n-gram's slots is the set of all languages that contain
it. A document's n-grams are looked up, the bits counted per language, the counts
corrected for each filter's rate of false positives, and the highest one decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import mix, slices

UNDETERMINED = "und"
#: Bytes of text looked up at a time. Each takes about 100 bytes of memory meanwhile.
SLICE = 1 << 17
_FACTOR = np.random.default_rng(5).integers(1, 1 << 63, 8, np.uint64) | np.uint64(1)
_LETTER = None


def _letters() -> np.ndarray:
    """By code point, whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def ngrams(texts: list[str | None], orders: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashes of all n-grams and the row of each one.

    Letters are lower-cased and every run of other characters is one blank; each text
    also begins and ends with one. N-grams don't span two texts.
    """
    parts = [np.frombuffer(f" {(t or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    points = np.concatenate(parts)
    letter = _letters()[points]
    kept = letter.copy()
    kept[0] = True
    kept[1:] |= letter[:-1] | (row[1:] != row[:-1])
    points = np.where(letter, points, 32)[kept].astype(np.uint64)
    row = row[kept]
    for n in orders:
        count = max(0, len(points) - n + 1)
        h = np.full(count, n, np.uint64)
        for j in range(n):
            h += points[j : j + count] * _FACTOR[j]
        whole = row[:count] == row[n - 1 :] if count else np.zeros(0, bool)
        if n == 1:
            whole = whole & (points != 32)
        yield mix(h[whole]), row[:count][whole]


def _positions(h: np.ndarray, k: int, slots: int) -> list[np.ndarray]:
    """The ``k`` slots of each hash, by double hashing."""
    step = (h >> np.uint64(33)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64) for i in range(k)]


@dataclass
class LanguageModel:
    """The filters (words of 64 languages x slots) and the names of their bits."""

    languages: list[str]
    filters: np.ndarray
    orders: tuple[int, ...]
    hashes: int

    def __post_init__(self):
        bits = [(self.filters[i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(len(self.languages))]
        self.false_rate = np.array([b.mean() ** self.hashes for b in bits])
        if len(self.languages) <= 8:
            self.filters = self.filters.astype(np.uint8)

    def hits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of each text, and for each language the number it contains."""
        total, hits = np.zeros(len(texts)), np.zeros((len(texts), len(self.languages)))
        for h, row in ngrams(texts, self.orders):
            total += np.bincount(row, minlength=len(texts))
            at = _positions(h, self.hashes, self.filters.shape[1])
            for w, bits in enumerate(self.filters):
                mask = bits[at[0]]
                for more in at[1:]:
                    mask &= bits[more]
                for i in range(w * 64, min(len(self.languages), w * 64 + 64)):
                    has = (mask >> mask.dtype.type(i % 64)) & mask.dtype.type(1)
                    hits[:, i] += np.bincount(row, has, minlength=len(texts))
        return total, hits

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its share of all languages' corrected hits."""
        total, hits = self.hits(texts)
        rate = np.minimum(self.false_rate, 0.999)
        true = np.clip((hits - total[:, None] * rate) / (1 - rate), 0, None) + 1e-9
        best = true.argmax(1) if len(texts) else np.zeros(0, int)
        score = true.max(1) / true.sum(1)
        no_letter = np.array([not any(map(str.isalpha, t or "")) for t in texts], bool)
        names = [UNDETERMINED if empty else self.languages[i] for i, empty in zip(best, no_letter, strict=True)]
        return names, np.where(no_letter, 0.0, score)


def fit_language_model(
    labelled: DataFrame,
    rows_per_language: int = 4000,
    orders: tuple[int, ...] = (2, 3, 4),
    slots: int = 1 << 20,
    hashes: int = 3,
    least_count: int = 2,
    least_share: float = 0.3,
) -> LanguageModel:
    """Learns the filters from ``text`` and ``lang``; rows without either are left out.

    The fit reads a sample bounded by ``rows_per_language`` (on average, drawn by a hash
    of the text). A language contains an n-gram that occurs in it ``least_count`` times
    and at ``least_share`` of the rate of the language in which it is most frequent.
    Only the table of ``slots`` slots reaches the driver, whatever the size of the input.
    """
    if len(orders) == 0 or slots & (slots - 1):
        raise ValueError("orders must name at least one length and slots be a power of two")
    rows = labelled.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((1, slots), np.uint64), orders, hashes)
    share = F.create_map(*[F.lit(x) for l in languages for x in (l, min(1.0, rows_per_language / counts[l]))])
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {l: i for i, l in enumerate(languages)}
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                lang = np.array([code[l] for l in part.column("lang").to_pylist()])
                for h, row in ngrams(part.column("text").to_pylist(), orders):
                    for i in np.unique(lang):
                        gram, n = np.unique(h[lang[row] == i], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(gram.view(np.int64)), pa.array(np.full(len(gram), i, np.int32)), pa.array(n)], ["gram", "lang_no", "n"]
                        )

    found = rows.where(drawn).mapInArrow(count, "gram long, lang_no int, n long").groupBy("gram", "lang_no").agg(F.sum("n").alias("n"))
    totals = {r["lang_no"]: r["n"] for r in found.groupBy("lang_no").agg(F.sum("n").alias("n")).collect()}
    rate = F.create_map(*[F.lit(x) for i in range(len(languages)) for x in (i, 1.0 / max(1, totals.get(i, 0)))])
    by_gram = (
        found.withColumn("rate", F.col("n") * rate[F.col("lang_no")])
        .groupBy("gram")
        .agg(F.max("rate").alias("most"), F.collect_list(F.struct("lang_no", "n", "rate")).alias("each"))
        .select("gram", "most", F.explode("each").alias("e"))
        .where((F.col("e.n") >= least_count) & (F.col("e.rate") >= least_share * F.col("most")))
    )

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("gram").to_numpy(zero_copy_only=False).view(np.uint64)
            lang = batch.column("lang_no").to_numpy(zero_copy_only=False)
            for at in _positions(h, hashes, slots):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(lang // 64), pa.array(np.left_shift(np.int64(1), (lang % 64).astype(np.int64)))], ["slot", "word", "mask"]
                )

    filled = by_gram.select("gram", F.col("e.lang_no").alias("lang_no")).mapInArrow(bits, "slot long, word int, mask long")
    cells = filled.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toPandas()
    filters = np.zeros((-(-len(languages) // 64), slots), np.uint64)
    filters[cells["word"].to_numpy(), cells["slot"].to_numpy()] = cells["mask"].to_numpy().view(np.uint64)
    return LanguageModel(languages, filters, orders, hashes)


def identify_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    The whole text counts. A text that is null or has no letter is ``und`` with score 0.
    If no n-gram is known, the first language by name is returned with a low score; a
    model without languages makes every row ``und``. Rows with any null are kept.
    """
    spark = docs.sparkSession
    docs = docs.drop("lang_pred", "score")
    given = spark.sparkContext.broadcast(model)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "lang_pred string, score double"])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = given.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                names, score = known.predict(texts) if known.languages else ([UNDETERMINED] * len(texts), np.zeros(len(texts)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(score)], [*part.schema.names, "lang_pred", "score"]
                )

    return docs.mapInArrow(label, schema)
