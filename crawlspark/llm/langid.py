"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's subwords are the byte 2-, 3- and 4-grams of its lower-cased letters (blanks mark word
ends); each is hashed to a bucket with a small embedding. The mean embedding goes into a
linear softmax. Both are trained together by stochastic gradient descent in numpy from
a bounded sample of labelled rows.

Two signals reject a text: a low softmax score, and subwords that are rare in every learned language (`rarity`),
as a softmax is sure of texts unlike all it learned, too. The temperature and both bounds come from sampled
rows, each scored without having been learned from. Fewer than `CALIBRATED` such rows set no bound.
All languages are learned as long as the bound on sampled rows (`most_rows`) leaves each `CALIBRATED` of them: 4,000
languages. Texts of rarer ones are rejected as those of unknown languages are.

Texts that are null or hold no letter get `und` with score 0 and are rejected; if no row is
labelled, every text is `und`. Equally likely languages go to the first in name order.
Texts of any length are read whole, in pieces. Repeated rows and ties in doc_id give one row
each; an empty table gives an empty result; other columns are not looked at.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import arrow_rows, bound_batches

BUCKETS = 8192
DIMENSIONS = 16
ORDERS = (2, 3, 4)
PIECE = 1 << 16
FOLDS = 5
CALIBRATED = 20
#: Subwords as usual as the language's own that every text counts as having besides its own: short texts show little.
USUAL = 50
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")

_FOLD = np.full(256, 32, np.uint64)
_FOLD[97:123] = range(97, 123)
_FOLD[128:] = range(128, 256)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def subword_counts(data: bytes) -> np.ndarray:
    """How often each bucket occurs in a text."""
    counts = np.zeros(BUCKETS, np.int64)
    folded = data.decode("utf-8", "replace").lower().encode("utf-8", "replace")
    longest = max(ORDERS)
    for start in range(0, max(len(folded), 1), PIECE):
        # A piece ends with the first bytes of the next, so that no subword is lost or counted twice.
        codes = _FOLD[np.frombuffer(folded[start:start + PIECE + longest - 1], np.uint8)]
        if start == 0:
            codes = np.r_[np.uint64(32), codes]
        grams = codes
        for order in range(2, longest + 1):
            if len(codes) < order:
                break
            grams = (grams[:len(codes) - order + 1] << np.uint64(8)) | codes[order - 1:]
            if order in ORDERS:
                own = grams[:PIECE + (start == 0)]
                own = own[own != (1 << 8 * order) // 255 * 32]
                counts += np.bincount((((own + np.uint64(order)) * _MIX) >> np.uint64(51)).astype(np.int64),
                                      minlength=BUCKETS)
    return counts


class Sample:
    """Bucket counts of the sampled texts, held as the buckets that occur; rows become dense a few at a time."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.buckets = [buckets for buckets, _ in rows]
        self.counts = [counts for _, counts in rows]
        self.totals = np.array([counts.sum() for _, counts in rows], np.float64)

    def shares(self, rows: np.ndarray) -> np.ndarray:
        dense = np.zeros((len(rows), BUCKETS))
        for place, row in enumerate(rows.tolist()):
            dense[place, self.buckets[row]] = self.counts[row] / max(1, self.totals[row])
        return dense

    def scores(self, rows: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
        return np.concatenate([self.shares(rows[start:start + 256]) @ table for start in range(0, len(rows), 256)]) + bias


class LanguageModel:
    """Trained weights: `table` gives each bucket's share of every language's score, `excess` its rarity there in bits."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, least: float,
                 excess: np.ndarray | None = None, most: float = np.inf):
        self.languages, self.table, self.bias = languages, table, bias
        self.temperature, self.least = temperature, least
        self.excess, self.most = np.zeros_like(table) if excess is None else excess, most

    def predict(self, data: bytes | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether the text is rejected."""
        if data is None or not self.languages or not LETTER.search(data.decode("utf-8", "replace")):
            return UNKNOWN, 0.0, True
        counts = subword_counts(data)
        used = np.flatnonzero(counts)
        scores = counts[used] @ self.table[used] / max(1, counts.sum()) + self.bias
        scores = np.exp((scores - scores.max()) / self.temperature)
        best = int(scores.argmax())
        score = float(scores[best] / scores.sum())
        rarity = float((counts[used] @ self.excess[used]).min() / (counts.sum() + USUAL))
        return self.languages[best], score, score < self.least or rarity > self.most


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def _descend(sample: Sample, labels: np.ndarray, used: np.ndarray, classes: int, epochs: int, rate: float,
             rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Table and bias learned from the rows `used`, in another order each epoch."""
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weight, bias = rng.normal(0, 0.1, (DIMENSIONS, classes)), np.zeros(classes)
    # Rare languages weigh as much as frequent ones.
    balance = len(used) / (classes * np.maximum(1, np.bincount(labels[used], minlength=classes)))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        shuffled = rng.permutation(used)
        for start in range(0, len(shuffled), 32):
            batch = shuffled[start:start + 32]
            inputs = sample.shares(batch)
            hidden = inputs @ embed
            error = _softmax(hidden @ weight + bias)
            error[np.arange(len(batch)), labels[batch]] -= 1
            error *= balance[labels[batch]][:, None] / len(batch)
            to_hidden = error @ weight.T
            weight -= step * hidden.T @ error
            bias -= step * error.sum(axis=0) * 0.1
            buckets = np.flatnonzero(inputs.any(axis=0))
            # Bucket shares are small: the embeddings take larger steps.
            embed[buckets] -= step * 50 * (inputs[:, buckets].T @ to_hidden)
    return embed @ weight, bias


def _rarity(sample: Sample, labels: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits by which each bucket is rarer than usual in each language, and the rarity of each row.

    A bucket's frequency is the mean of its shares in the language's texts, with one even text more.
    Each row is measured without its own share.
    """
    sums = np.full((BUCKETS, classes), 1 / BUCKETS)
    own_shares = [counts / max(1, total) for counts, total in zip(sample.counts, sample.totals)]
    for used, share, label in zip(sample.buckets, own_shares, labels):
        sums[used, label] += share
    texts = np.bincount(labels, minlength=classes) + 1.0
    bits = np.zeros((len(labels), classes))
    for row, label in enumerate(labels):
        used = sample.buckets[row]
        own, others = sums[used], texts.copy()
        own[:, label] = np.maximum(1 / BUCKETS, own[:, label] - own_shares[row])
        others[label] -= 1
        bits[row] = sample.counts[row] @ -np.log2(own / others)
    sizes = sample.totals
    means = bits[np.arange(len(labels)), labels] / np.maximum(1, sizes)
    filled = [(labels == label) & (sizes > 0) for label in range(classes)]
    usual = np.array([means[some].mean() if some.any() else np.log2(BUCKETS) for some in filled])
    return -np.log2(sums / texts) - usual, ((bits - sizes[:, None] * usual) / (sizes[:, None] + USUAL)).min(axis=1)


def fit(sample: Sample, labels: np.ndarray, languages: list[str], epochs: int = 12, rate: float = 2.0,
        reject: float = 0.001, seed: int = 7) -> LanguageModel:
    """Trains on four fifths of the rows; every fifth in turn is scored by what the rest teaches, to calibrate on all rows.

    `reject` is the share of calibration rows that may fall outside either
    bound; scores count for rows whose own language leads. Of fewer than 1 / `reject` rows none does.
    """
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    classes, fold = len(languages), len(order) // FOLDS
    model, scores, gold = None, [], []
    for place in range(FOLDS if fold else 1):
        low, high = place * fold, len(order) if place == FOLDS - 1 else (place + 1) * fold
        held, used = order[low:high], np.r_[order[:low], order[high:]] if fold else order
        table, bias = _descend(sample, labels, used, classes, epochs, rate, rng)
        # The model is that of the first fifth.
        model = model or (table, bias)
        held = held if fold else used
        scores.append(sample.scores(held, table, bias))
        gold.append(labels[held])
    table, bias = model
    scores, gold = np.concatenate(scores), np.concatenate(gold)
    tried = np.geomspace(0.02, 4, 60)
    # Platt's targets: rows that are all told apart do not make the softmax sure without bound.
    target = np.full(scores.shape, 1 / (len(gold) + 2) / max(1, classes - 1))
    target[np.arange(len(gold)), gold] = (len(gold) + 1) / (len(gold) + 2)
    losses = [-(target * np.log(np.maximum(1e-12, _softmax(scores / t)))).sum(axis=1).mean() for t in tried]
    temperature = float(tried[int(np.argmin(losses))])
    sure = _softmax(scores / temperature)
    own = sure.max(axis=1)[sure.argmax(axis=1) == gold]
    least = float(np.quantile(own, reject, method="lower")) if len(own) >= CALIBRATED else 0.0
    excess, rarity = _rarity(sample, labels, classes)
    most = float(np.quantile(rarity, 1 - reject, method="higher")) if len(rarity) >= CALIBRATED else np.inf
    return LanguageModel(languages, table.astype(np.float32), bias, temperature, least, excess.astype(np.float32), most)


def held_out(documents: DataFrame) -> Column:
    """True for documents that are never learned from: crc32(doc_id) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, per_language: int = 400, most_rows: int = 80_000) -> LanguageModel:
    """Model from about `per_language` distinct rows of each language that are not held out, about `most_rows` in all.

    Rows are drawn by a hash of doc_id and text, so rows that share a doc_id or have none are drawn one by one, and
    copies of a row count once. Only bucket counts of the drawn rows reach the driver, never more than 8192 numbers a row.
    Beyond `most_rows` / `per_language` languages each has a smaller share, down to `CALIBRATED` rows.
    """
    bound_batches(documents.sparkSession)
    labelled = documents.where("text is not null and lang is not null").where(~held_out(documents))
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_rows // CALIBRATED).collect()
    languages = sorted(row["lang"] for row in sizes)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    wanted = min(per_language, most_rows // len(languages))
    shares = documents.sparkSession.createDataFrame(
        [(row["lang"], min(1.0, wanted / row["count"])) for row in sizes], "lang string, share double")
    drawn = F.xxhash64("doc_id", "text", F.lit("language"))
    sample = (labelled.select("lang", "text", drawn.alias("drawn")).join(F.broadcast(shares), "lang")
              .where(F.pmod("drawn", F.lit(1 << 20)) / F.lit(float(1 << 20)) < F.col("share"))
              .groupBy("lang", "drawn").agg(F.first("text").alias("text")).select("lang", "text"))

    def count(rows):
        for lang, data in rows:
            counts = subword_counts(data)
            buckets = np.flatnonzero(counts)
            yield lang, buckets.astype(np.int16).tobytes(), counts[buckets].astype(np.int32).tobytes()

    schema = pa.schema([("lang", pa.binary()), ("buckets", pa.binary()), ("counts", pa.binary())])
    rows = sample.mapInArrow(arrow_rows(count, schema), "lang binary, buckets binary, counts binary").collect()
    rows = sorted((bytes(row[0]).decode(), bytes(row[1]), bytes(row[2])) for row in rows)
    if not rows:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    places = {lang: place for place, lang in enumerate(languages)}
    labels = np.array([places[lang] for lang, _, _ in rows])
    return fit(Sample([(np.frombuffer(buckets, np.int16), np.frombuffer(counts, np.int32))
                       for _, buckets, counts in rows]), labels, languages)


def identify(documents: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score`, `rejected` per row, from the text alone."""
    bound_batches(documents.sparkSession)
    model = model or train(documents)

    def work(rows):
        for doc_id, held, data in rows:
            yield doc_id, held, *model.predict(data)

    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("rejected", pa.bool_())])
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(documents).alias("held_out"),
                            "text").mapInArrow(
        arrow_rows(work, schema), "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(documents: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """The rows of `documents` whose language is not rejected, with all their columns."""
    bound_batches(documents.sparkSession)
    model = model or train(documents)

    def rejects(batches):
        for batch in batches:
            texts = (text.as_py() for text in batch.column(0).cast(pa.binary()))
            yield batch.filter(pa.array([not model.predict(data)[2] for data in texts], pa.bool_()))

    order = ["text", *[name for name in documents.columns if name != "text"]]
    df = documents.select(*order)
    return df.mapInArrow(rejects, df.schema).select(*documents.columns)
