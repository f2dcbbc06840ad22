"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

Features of a text are n-grams over two views of its words: the words themselves (single words and pairs) and their forms,
that is case, digits, the run of signs at the end, and whether the word repeats the one before (one to three in a row).
Every n-gram is hashed into a vector of fixed size and counts by its share of the text's words. The same vectorised code
makes the features for training and for scoring; a score is the sparse dot product of the shares with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.llm.base import id_back, id_text, in_slices, query, table, whole_text
from haulage.llm.words import kept_with

#: Size of the weight vector (a power of two); the last place is the constant feature.
PLACES = 1 << 18
#: Most labelled rows that are trained on, passes over them, and the constants of the updates.
SAMPLE, PASSES, ALPHA, BETA, L1, L2 = 8000, 4, 0.5, 1.0, 0.02, 0.05
#: A document is predicted to be good from this score on.
THRESHOLD = 0.3
#: Scale of the shares, so that a form that makes up a text weighs about as much as the constant.
SCALE = 4.0
#: Words whose hash and form are kept per Python worker.
KEPT_WORDS = 150_000
#: Characters of text whose n-grams are made at once.
SLICE = 1 << 20

SIGNS = "#*$%&|<>"


def form_of(word: str) -> int:
    """Number of a word's form: case and digits (6 kinds) times the signs at its end (6 kinds)."""
    core = word.rstrip(".,;:!?#*$%&|<>\"')")
    tail = word[len(core):]
    if not core:
        kind = 0
    elif any(map(str.isdigit, core)):
        kind = 1
    elif core.islower():
        kind = 2
    elif core.isupper() and len(core) > 1:
        kind = 3
    elif core.istitle() or core[:1].isupper():
        kind = 4
    else:
        kind = 5
    last = 5 if len(tail) > 4 else 4 if any(s in tail for s in SIGNS) else 3 if "!" in tail or "?" in tail else 2 if "." in tail else 1 if tail else 0
    return kind * 6 + last


class Words:
    """Hash and form of words, looked up by word."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.hashes, self.forms = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        import xxhash

        if len(self.number) > KEPT_WORDS:
            self.__init__()
        for word in set(words).difference(self.number):
            at = len(self.number)
            if at == len(self.hashes):
                self.hashes, self.forms = np.concatenate([self.hashes, np.zeros_like(self.hashes)]), np.concatenate([self.forms, np.zeros_like(self.forms)])
            self.number[word] = at
            self.hashes[at], self.forms[at] = xxhash.xxh3_64_intdigest(word.lower()), form_of(word)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        return self.hashes[numbers], self.forms[numbers]


def mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """Places of hashed n-grams; ``salt`` keeps the kinds of n-grams apart."""
    values = (values + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return (values >> np.uint64(40)).astype(np.int64) % (PLACES - 1)


def places_of(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all n-grams of some texts, the text each belongs to, and the number of words of each text."""
    split = [t.split() for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    hashes, forms = words.of([w for s in split for w in s])
    text = np.repeat(np.arange(len(texts)), counts)
    same = np.zeros(len(hashes), np.uint64)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    forms = forms * np.uint64(2) + same
    places, owners = [mixed(hashes, 1), mixed(forms, 2)], [text, text]
    for gap in (1, 2):
        inside = text[gap:] == text[:-gap] if len(text) > gap else np.zeros(0, bool)
        if gap == 1:
            pair = hashes[:-1] * np.uint64(31) + hashes[1:] if len(text) > 1 else hashes[:0]
            places.append(mixed(pair[inside], 3))
            owners.append(text[gap:][inside])
        rows = forms[:len(forms) - gap].copy()
        for k in range(1, gap + 1):
            rows = rows * np.uint64(128) + forms[k:len(forms) - gap + k]
        places.append(mixed(rows[inside], 3 + gap))
        owners.append(text[gap:][inside])
    return np.concatenate(places), np.concatenate(owners), counts


def scored(texts: list[str], weights: np.ndarray, words: Words) -> np.ndarray:
    """Probability of good quality of each text; a text without words has that of the constant feature alone."""
    places, owners, counts = places_of(texts, words)
    sums = np.bincount(owners, weights[places], len(texts))
    total = np.clip(weights[-1] + SCALE * sums / np.maximum(counts, 1), -35, 35)
    return 1 / (1 + np.exp(-total))


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights after the updates over sparse examples (places, values, label), in the order given."""
    z, n = np.zeros(PLACES), np.zeros(PLACES)

    def weights(at):
        own, seen = z[at], n[at]
        return np.where(np.abs(own) <= L1, 0.0, -(own - np.sign(own) * L1) / ((BETA + np.sqrt(seen)) / ALPHA + L2))

    for _ in range(PASSES):
        for at, values, label in examples:
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            seen = n[at]
            z[at] += g - (np.sqrt(seen + g * g) - np.sqrt(seen)) / ALPHA * w
            n[at] = seen + g * g
    return weights(np.arange(PLACES))


def held_out(doc_id="doc_id"):
    """Rows that are never trained on: those whose crc32 of the id as text is a multiple of 5, and those without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights learnt from at most ``sample`` labelled rows outside the held-out fold, chosen and ordered by a hash of the id.

    Without any such row all weights are 0 and every score is 0.5. Rows with a null label are left out; of several labels
    for an id the smallest holds. The sample is bounded, and so is the one task that learns from it in order.
    """
    usable = labels.where(F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = usable.withColumn("turn", F.xxhash64(F.lit(7), "doc_id")).orderBy("turn", "doc_id").limit(sample)
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen.withColumnRenamed("doc_id", "_doc_id")), F.col("doc_id") == F.col("_doc_id"))
    ordered = rows.select("turn", "doc_id", "label", "text").repartition(1).sortWithinPartitions("turn", "doc_id", "text")

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, examples = Words(), []
        for frame in in_slices(batches, SLICE):
            places, owners, counts = places_of(frame["text"].tolist(), words)
            order = np.argsort(owners, kind="stable")
            cuts = np.searchsorted(owners[order], np.arange(len(frame) + 1))
            for i, label in enumerate(frame["label"]):
                at, times = np.unique(places[order[cuts[i]:cuts[i + 1]]], return_counts=True)
                examples.append((np.append(at, PLACES - 1), np.append(SCALE * times / max(counts[i], 1), 1.0), int(label > 0)))
        if examples:
            yield pd.DataFrame({"weights": [ftrl(examples).astype("<f4").tobytes()]})

    row = ordered.mapInPandas(learn, "weights binary").first()
    return np.zeros(PLACES, np.float32) if row is None else np.frombuffer(row.weights, "<f4")


def with_scores(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``(doc_id, text)``; null texts are empty. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        words = kept_with(xxhash, "word forms", Words)
        for frame in in_slices(batches, SLICE):
            score = scored(frame["text"].tolist(), shared.value, words)
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "held_out": frame["held_out"].to_numpy(), "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)})

    texts = docs.select(id_text("doc_id"), held_out().alias("held_out"), whole_text().alias("text"))
    return id_back(texts.mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int"), "doc_id")


def good(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with all their columns and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        import pyarrow as pa
        import xxhash

        words = kept_with(xxhash, "word forms", Words)
        for batch in batches:
            texts, keep, start, size = batch.column("text").to_pylist(), [], 0, 0
            for i, text in enumerate(texts):
                size += len(text or "")
                if size >= SLICE or i == len(texts) - 1:
                    keep.append(scored([t or "" for t in texts[start:i + 1]], shared.value, words) >= THRESHOLD)
                    start, size = i + 1, 0
            yield batch.filter(pa.array(np.concatenate(keep))) if keep else batch

    return docs.mapInArrow(run, docs.schema)


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return with_scores(docs, trained(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))
