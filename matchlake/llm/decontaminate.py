"""Training documents that hold benchmark items: BM25 with block-max bounds, then overlap.

The index holds, per term, the items with their BM25 weights, divided by the item's score
against its own text, so that a passage with all of an item's words scores 1. Items stand in
blocks, and per term and block the largest weight is kept. Every passage of every document is
a query: blocks whose bounds add up to less than the threshold are skipped, in the others every
item above it is retrieved. A retrieved item counts if its five-word shingles are in the
passage, over the whole item as well as over its question and its answer (its last sentence).

The index is built in shards of bounded size, and each is broadcast; more items make more
shards, and the documents are scanned once for each. Spark counts the words of the whole
benchmark first, and a shard gets the counts of its own words, so weights and passages do not
depend on how items fall into shards.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, filled_id, free_names, keyed, saved, text_key

SHINGLE_WORDS = 5
SIMILARITY = 0.8
PART_SIMILARITY = 0.5  # of question and answer each
THRESHOLD = 0.6  # of an item's score against itself; 0.8 of the shingles hold more of its words
BLOCK = 8
SHARD_ITEMS = 2_000
SHARD_BYTES = 8 << 20
K1, B = 1.2, 0.75
KEY = ["__held_id", "__held_text"]

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased; ASCII punctuation and white space separate words."""
    return (text or "").encode("utf-8", "replace").translate(_WORDS).split()


def shingles(words: list[bytes]) -> set[bytes]:
    """Five-word shingles; fewer words are one shingle."""
    n = min(SHINGLE_WORDS, len(words))
    return {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence is the answer; a single sentence is both."""
    parts = [p for p in _SENTENCE.split(text.strip()) if words_of(p)]
    if len(parts) < 2:
        return words_of(text), words_of(text)
    return words_of(" ".join(parts[:-1])), words_of(parts[-1])


@dataclass
class Item:
    item_id: int
    whole: set[bytes]
    question: set[bytes]
    answer: set[bytes]

    def overlaps(self, words: list[bytes]) -> bool:
        joined = b" " + b" ".join(words) + b" "

        def share(wanted: set[bytes]) -> float:
            return sum(b" " + s + b" " in joined for s in wanted) / len(wanted)

        return (
            share(self.whole) >= SIMILARITY
            and share(self.question) >= PART_SIMILARITY
            and share(self.answer) >= PART_SIMILARITY
        )


@dataclass(frozen=True)
class Corpus:
    """The whole benchmark: items, their mean and largest length, items per word."""

    n: int
    mean: float
    longest: int
    frequency: dict[bytes, int]


class Index:
    """One shard of the inverted index; without ``corpus`` its items are all there are."""

    def __init__(self, items: list[tuple[int, str]], corpus: Corpus | None = None):
        texts = [(i, t, words_of(t)) for i, t in items]
        texts = [x for x in texts if x[2]]
        self.items = [
            Item(i, shingles(w), *(shingles(p) for p in question_and_answer(t))) for i, t, w in texts
        ]
        counts = [Counter(w) for _, _, w in texts]
        if corpus is None:
            lengths = [len(w) for _, _, w in texts] or [1]
            own = Counter(w for c in counts for w in c)
            corpus = Corpus(len(texts), float(np.mean(lengths)), max(lengths), own)
        self.step = corpus.longest + SHINGLE_WORDS
        n, mean = corpus.n, corpus.mean
        idf = {w: np.log1p((n - f + 0.5) / (f + 0.5)) for w, f in corpus.frequency.items()}
        self.terms = {w: k for k, w in enumerate(sorted(idf))}
        self.postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        blocks = -(-len(texts) // BLOCK)
        self.block_max = np.zeros((len(self.terms), blocks), np.float32)
        for item, count in enumerate(counts):
            length = sum(count.values())
            weight = {
                w: idf[w] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
                for w, tf in count.items()
            }
            whole = sum(weight.values())
            for w, x in weight.items():
                term = self.terms[w]
                self.postings[term].append((item, x / whole))
                block = item // BLOCK
                self.block_max[term, block] = max(self.block_max[term, block], x / whole)

    def matches(self, text: str | None) -> list[int]:
        """Ids of the items that the text holds."""
        words = words_of(text)
        get = self.terms.get
        found = np.array([get(w, -1) for w in words], np.int64)
        at = np.flatnonzero(found >= 0)
        if not len(at):
            return []
        # passages overlap: each is two steps long, so every item's span lies within one
        pairs = np.unique((at // self.step) * len(self.terms) + found[at])
        steps, terms = np.divmod(pairs, len(self.terms))
        first = np.flatnonzero(np.r_[True, steps[1:] != steps[:-1]])
        bounds = np.zeros((len(words) // self.step + 2, self.block_max.shape[1]), np.float32)
        bounds[steps[first]] = np.add.reduceat(self.block_max[terms], first, axis=0)
        candidates = np.argwhere(bounds[:-1] + bounds[1:] >= THRESHOLD)
        open_blocks = defaultdict(set)
        for step, block in candidates.tolist():
            open_blocks[step].add(block)
        out = set()
        for step, blocks in open_blocks.items():
            own = np.unique(terms[(steps == step) | (steps == step + 1)])
            scores: dict[int, float] = defaultdict(float)
            for term in own.tolist():
                for item, weight in self.postings[term]:
                    if item // BLOCK in blocks:
                        scores[item] += weight
            passage = words[step * self.step : (step + 2) * self.step]
            out.update(
                self.items[i].item_id
                for i, score in scores.items()
                if score >= THRESHOLD and self.items[i].overlaps(passage)
            )
        return sorted(out)


def _items(benchmark: DataFrame) -> DataFrame:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string"))
    return rows.where("item_id IS NOT NULL AND text IS NOT NULL").distinct()


def _word_counter():
    @F.pandas_udf("length long, words array<binary>")
    def count(texts: pd.Series) -> pd.DataFrame:
        found = [words_of(t) for t in texts]
        rows = [(len(w), sorted(set(w))) for w in found]
        return pd.DataFrame(rows, columns=["length", "words"])

    return count


def corpora(benchmark: DataFrame):
    """A function from a shard's items to the ``Corpus`` with the counts of their words."""
    spark = benchmark.sparkSession
    counted = saved(
        _items(benchmark).select(_word_counter()("text").alias("item")).select("item.*").where("length > 0"),
        "benchmark-words",
    )
    n, mean, longest = counted.agg(F.count("*"), F.avg("length"), F.max("length")).first()
    frequency = saved(
        counted.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")),
        "benchmark-frequency",
    )

    def of(items: list[tuple[int, str]]) -> Corpus:
        own = sorted({w for _, text in items for w in words_of(text)})
        wanted = spark.createDataFrame([(w,) for w in own], "word binary")
        rows = frequency.join(F.broadcast(wanted), "word").collect()
        return Corpus(n, mean or 1.0, longest or 1, {bytes(r.word): r.n for r in rows})

    return of


def shards(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in lists of bounded length and size, fetched one after the other."""
    held, size = [], 0
    for row in _items(benchmark).orderBy("item_id", "text").toLocalIterator():
        if held and (len(held) >= SHARD_ITEMS or size + len(row.text) > SHARD_BYTES):
            yield held
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += len(row.text)
    if held:
        yield held


def held_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``id_key, text_hash, item_ids`` of the documents that hold items.

    One shard of the index after the other: each is broadcast, its hits are stored, and it is
    let go before the next.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        filled_id(F.col("doc_id")).alias(KEY[0]),
        text_key(F.col("text")).alias(KEY[1]),
        F.col("text").cast("string").alias("text"),
    )
    hits = spark.createDataFrame([], f"{KEY[0]} long, {KEY[1]} long, item_id long")
    corpus_of = corpora(benchmark)
    for items in shards(benchmark):
        # plain values: a class of this package could not be read where executors have no copy of it
        shared = spark.sparkContext.broadcast((items, astuple(corpus_of(items))))
        found = rows.select(*KEY, F.explode(_matcher(shared)("text")).alias("item_id"))
        hits = hits.unionByName(saved(found, "held-items"))
        shared.unpersist()
    return hits.groupBy(*KEY).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))


def _matcher(shard):
    @F.pandas_udf("array<long>")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items, corpus = shard.value
        index = Index(items, Corpus(*corpus))
        for texts in batches:
            yield pd.Series([index.matches(t) for t in texts])

    return match


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_ids, n_items, contaminated`` of every document.

    A null or empty text holds nothing; items without an id or words are left out; items with
    the same id are one item; repeated documents get a row each; empty tables on either side
    give no matches; other columns are ignored.
    """
    held = saved(held_items(docs, benchmark), "contaminated")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        filled_id(F.col("doc_id")).alias(KEY[0]),
        text_key(F.col("text")).alias(KEY[1]),
    )
    none = F.array().cast("array<long>")
    return rows.join(held, KEY, "left").select(
        "doc_id",
        F.coalesce("item_ids", none).alias("item_ids"),
        F.size(F.coalesce("item_ids", none)).alias("n_items"),
        F.col("item_ids").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    Null and empty texts stay; repeated rows stay or go together; otherwise as ``contaminated``.
    """
    names = free_names(docs, *KEY)
    held = held_items(docs, benchmark).select(*KEY).toDF(*names)
    return keyed(docs, names).join(saved(held, "contaminated"), names, "left_anti").drop(*names)
