"""Brown class-based bigram model: exchange clustering of words, smoothed text probability.

    P(w | v) = P(known) * P(class(w) | class(v)) * count(w) / count(class(w))

with extra outcomes for unknown words. Together they have the share of training tokens seen once
(Good and Turing); there are taken to be as many of them as known words and one more, equally
likely, so that a word never seen costs more than a rare known one. Class transitions are
smoothed by adding one.

Texts are read once and kept as integers in chunks of bounded size, each with a vocabulary
of its own. Words are brought together by their 64-bit hash, in parts; a part remembers which
of its words every chunk has, and in which order. In an exchange sweep the chunks count the
contexts of their words (the current classes before and after them), one chunk sending each
of its words once, however often it stands there; the parts add the contexts up, and every
word moves to the class that raises the likelihood of its contexts most, all words at a time.
The classes go back to the chunks, a byte a word, where the next sweep counts under them and,
after ``SWEEPS`` of them, every text is scored. Chunks and parts stay where they are: both are
partitioned once and kept on disk, so that a sweep shuffles classes and contexts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, discard, fold, saved

HELD_OUT = (7, 2)  # rows with this remainder of crc32(doc_id) are not learned from
CLASSES = 32  # class 0 is the end of a text
SLOTS = 2 * CLASSES  # contexts of a word: classes before it, then classes after it
UNKNOWN = CLASSES
SWEEPS = 6
CHUNK_BYTES = 24 << 20
WORDS_PER_PART = 400_000
END = 0  # its number in every chunk
END_HASH = xxhash.xxh64_intdigest(b" ")  # no word holds a space

CHUNK = "chunk long, tokens binary, lengths binary, ids binary, flags binary, words binary, first binary"
WORDS = "part int, chunk long, words binary, counts binary"
PLACES = (
    "part int, counts binary, chunks binary, sizes binary, places binary, "
    "tokens long, known long, once long"
)
BLOCK = "part int, chunk long, classes binary, owned binary, slots binary, seen binary"
VECTORS = (
    "part int, counts binary, first binary, owners binary, slots binary, seen binary, "
    "chunks binary, sizes binary, places binary"
)
CLASS_MAP = "chunk long, part int, classes binary, counts binary"
SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base double, emission double, "
    "pairs binary, seen binary, k int, n long"
)


def _of(raw, kind: str) -> np.ndarray:
    return np.frombuffer(bytes(raw), kind)


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit integers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view("u1").reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(raw) -> np.ndarray:
    raw = bytes(raw)
    size = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], 4 * size, "zstd", asbytes=True), "u1")
    return planes.reshape(4, size).T.copy().view("<u4").ravel().astype(np.int64)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.array([], int)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


# --- reading the texts ----------------------------------------------------------------


class Chunk:
    """Texts as numbers of the chunk's own vocabulary, each followed by the end."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {b" ": END}
        self.tokens, self.ids, self.flags, self.size = [], [], [], 0

    def add(self, doc_id: int | None, text: str | None, held_out: bool) -> None:
        raw = (text or "").encode("utf-8", "replace").lower()
        numbers = self.vocabulary
        own = [numbers.setdefault(w, len(numbers)) for w in raw.split()]
        own.append(END)
        self.tokens.append(np.array(own, "<i4"))
        self.ids.append(0 if doc_id is None else doc_id)
        self.flags.append(held_out + 2 * (doc_id is None))
        self.size += len(raw) + 16

    def row(self, number: int) -> tuple:
        digest = xxhash.xxh64_intdigest
        words = np.array([digest(w) for w in self.vocabulary], "<u8")
        # to begin with, words with the same ending share a class
        first = np.array([1 + digest(w[-2:]) % (CLASSES - 1) for w in self.vocabulary], "u1")
        first[END] = 0
        return (
            number,
            _packed(np.concatenate(self.tokens)),
            np.array([len(t) for t in self.tokens], "<i4").tobytes(),
            np.array(self.ids, "<i8").tobytes(),
            np.array(self.flags, "u1").tobytes(),
            words.tobytes(),
            first.tobytes(),
        )


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 24
    chunk = Chunk()
    for batch in batches:
        for doc_id, text, held_out in zip(batch["doc_id"], batch["text"], batch["held_out"]):
            chunk.add(None if pd.isna(doc_id) else int(doc_id), text, bool(held_out))
            if chunk.size >= CHUNK_BYTES:
                yield pd.DataFrame([chunk.row(number)], columns=_names(CHUNK))
                number, chunk = number + 1, Chunk()
    if chunk.size:
        yield pd.DataFrame([chunk.row(number)], columns=_names(CHUNK))


class Texts:
    """A kept chunk, opened."""

    def __init__(self, row):
        self.chunk = int(row.chunk)
        self.tokens = _unpacked(row.tokens)
        self.lengths = _of(row.lengths, "<i4").astype(np.int64)
        self.flags = _of(row.flags, "u1")
        self.before = np.concatenate(([END], self.tokens[:-1]))  # a text begins after an end
        self.learned = np.repeat(self.flags & 1 == 0, self.lengths)


# --- words and their contexts ---------------------------------------------------------


def _by_part(row, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's words (numbers) part by part, and where each part begins."""
    part = (_of(row.words, "<u8") % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _words(parts: int):
    def run(chunks: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunks.itertuples():
            texts, (order, edges) = Texts(row), _by_part(row, parts)
            words = _of(row.words, "<u8")[order]
            counts = np.bincount(texts.tokens[texts.learned], minlength=len(words))[order]
            out += [
                (p, texts.chunk, words[a:b].tobytes(), counts[a:b].astype("<i4").tobytes())
                for p, (a, b) in enumerate(zip(edges, edges[1:]))
                if b > a
            ]
        return pd.DataFrame(out, columns=_names(WORDS))

    return run


def _places(blocks: pd.DataFrame) -> pd.DataFrame:
    """The words of one part: counts over all chunks, and which of them every chunk has."""
    words = np.concatenate([_of(b, "<u8") for b in blocks["words"]])
    distinct, place = np.unique(words, return_inverse=True)
    counts = np.concatenate([_of(b, "<i4") for b in blocks["counts"]])
    total = np.bincount(place, counts, len(distinct)).astype("<i8")
    sizes = np.array([len(b) // 8 for b in blocks["words"]], "<i4")
    return pd.DataFrame(
        [
            (
                blocks["part"].iloc[0], total.tobytes(), blocks["chunk"].to_numpy("<i8").tobytes(),
                sizes.tobytes(), place.astype("<i4").tobytes(),
                total.sum(), (total > 0).sum(), (total == 1).sum(),
            )
        ],
        columns=_names(PLACES),
    )


def _pairs(owners: np.ndarray, classes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``owner * CLASSES + class`` in order, and how often each occurs."""
    keys = owners * CLASSES + classes
    if size * CLASSES > max(1 << 22, 4 * len(keys)):
        return np.unique(keys, return_counts=True)
    seen = np.bincount(keys)
    keys = np.flatnonzero(seen)
    return keys, seen[keys]


def _own_classes(row, maps: pd.DataFrame, order: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Classes of a chunk's words: the first ones as long as there are no others."""
    classes = _of(row.first, "u1").astype(np.int64)
    for part, own in zip(maps["part"], maps["classes"]):
        classes[order[edges[part] : edges[part + 1]]] = _of(own, "u1")
    return classes


def _contexts(parts: int):
    """Contexts of a chunk's words under the current classes, a block for each part."""

    def run(chunks: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunks.itertuples():
            texts, (order, edges) = Texts(row), _by_part(row, parts)
            classes = _own_classes(row, maps, order, edges)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            tokens, before = texts.tokens[texts.learned], texts.before[texts.learned]
            left, n_left = _pairs(place[tokens], classes[before], len(order))
            right, n_right = _pairs(place[before], classes[tokens], len(order))
            keys = np.concatenate(
                (
                    left // CLASSES * SLOTS + left % CLASSES,
                    right // CLASSES * SLOTS + CLASSES + right % CLASSES,
                )
            )
            by_key = np.argsort(keys, kind="stable")
            owners, slots = np.divmod(keys[by_key], SLOTS)
            seen = np.concatenate((n_left, n_right))[by_key].astype("<i4")
            owned, slots = np.bincount(owners, minlength=len(order)).astype("u1"), slots.astype("u1")
            inner = np.searchsorted(owners, edges)
            classes = classes[order].astype("u1")
            out += [
                (
                    p, texts.chunk, classes[a:b].tobytes(), owned[a:b].tobytes(),
                    slots[c:d].tobytes(), seen[c:d].tobytes(),
                )
                for p, (a, b, c, d) in enumerate(zip(edges, edges[1:], inner, inner[1:]))
                if b > a
            ]
        return pd.DataFrame(out, columns=_names(BLOCK))

    return run


def _gather(places: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
    """The words of one part with their classes and their contexts over all chunks."""
    out = []
    for row in places.itertuples():
        place, sizes = _of(row.places, "<i4").astype(np.int64), _of(row.sizes, "<i4")
        at = dict(zip(_of(row.chunks, "<i8").tolist(), (np.cumsum(sizes) - sizes).tolist()))
        first = np.zeros(len(row.counts) // 8, "u1")
        keys, seen = [], []
        for b in blocks.itertuples():
            own = place[at[b.chunk] : at[b.chunk] + len(b.classes)]
            first[own] = _of(b.classes, "u1")
            keys.append(np.repeat(own * SLOTS, _of(b.owned, "u1")) + _of(b.slots, "u1"))
            seen.append(_of(b.seen, "<i4").astype(np.int64))
        keys, seen = _sum_by(np.concatenate(keys), np.concatenate(seen))
        out.append(
            (
                row.part, row.counts, first.tobytes(), (keys // SLOTS).astype("<i4").tobytes(),
                (keys % SLOTS).astype("u1").tobytes(), seen.astype("<i8").tobytes(),
                row.chunks, row.sizes, row.places,
            )
        )
    return pd.DataFrame(out, columns=_names(VECTORS))


# --- exchange sweeps ------------------------------------------------------------------


def assign(row, contexts: np.ndarray | None) -> np.ndarray:
    """Classes of a part's words: the first ones, or the best under the counts so far.

    ``contexts[s, c]``: how often class c had context s; the last line has the class sizes.
    """
    first = _of(row.first, "u1").astype(np.int64)
    if contexts is None:
        return first
    # what a word's contexts lose or gain in a class is linear in their log shares there
    weight = np.log((contexts[:SLOTS] + 0.5) / (contexts[SLOTS] + 0.5 * CLASSES))
    scores = np.zeros((len(first), CLASSES))
    owners, slots, seen = _of(row.owners, "<i4"), _of(row.slots, "u1"), _of(row.seen, "<i8")
    for at in range(0, len(owners), 1 << 17):
        own = owners[at : at + (1 << 17)]
        gain = seen[at : at + (1 << 17), None] * weight[slots[at : at + (1 << 17)]]
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        scores[own[start]] += np.add.reduceat(gain, start, axis=0)
    best = 1 + scores[:, 1:].argmax(axis=1)
    return np.where(first == 0, 0, best)


def _context_counts(contexts: np.ndarray | None):
    """Counts of contexts by class, class sizes, and three numbers about all words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((SLOTS + 1) * CLASSES + 3, np.int64)
        for batch in batches:
            for row in batch.itertuples():
                classes, counts = assign(row, contexts), _of(row.counts, "<i8")
                owners, slots, seen = (
                    _of(row.owners, "<i4"), _of(row.slots, "u1").astype(np.int64), _of(row.seen, "<i8"),
                )
                np.add.at(total, slots * CLASSES + classes[owners], seen)
                np.add.at(total, SLOTS * CLASSES + classes, counts)
                total[-3:] += (counts.sum(), (counts > 0).sum(), (counts == 1).sum())
        k = np.flatnonzero(total)
        yield pd.DataFrame({"k": k.astype(np.int32), "n": total[k]})

    return run


def _summed(counts: DataFrame, size: int) -> np.ndarray:
    """At most ``size`` sums, fetched."""
    out = np.zeros(size, np.int64)
    for row in counts.groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[row.k] = row.n
    return out


def _class_maps(contexts: np.ndarray, counted: bool):
    """The classes that a part's words move to, for each chunk that has some of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                classes, counts = assign(row, contexts), _of(row.counts, "<i8")
                places = _of(row.places, "<i4")
                edges = np.concatenate(([0], np.cumsum(_of(row.sizes, "<i4"))))
                out = [
                    (
                        int(chunk), row.part, classes[places[a:b]].astype("u1").tobytes(),
                        counts[places[a:b]].tobytes() if counted else b"",
                    )
                    for chunk, a, b in zip(_of(row.chunks, "<i8"), edges, edges[1:])
                ]
                yield pd.DataFrame(out, columns=_names(CLASS_MAP))

    return run


# --- scoring --------------------------------------------------------------------------


def _scorer(tokens_learned: int, distinct: int, parts: int):
    width = CLASSES + 1
    ratio = np.log10(tokens_learned + distinct + 1)

    def run(chunks: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunks.itertuples():
            texts, (order, edges) = Texts(row), _by_part(row, parts)
            classes, counts = _own_classes(row, maps, order, edges), np.zeros(len(order), np.int64)
            for part, seen in zip(maps["part"], maps["counts"]):
                counts[order[edges[part] : edges[part + 1]]] = _of(seen, "<i8")
            classes[counts == 0] = UNKNOWN
            starts = np.cumsum(texts.lengths) - texts.lengths
            known = np.add.reduceat((counts > 0)[texts.tokens].astype(np.int64), starts)
            base = np.add.reduceat(np.log10(counts + 1)[texts.tokens], starts) - texts.lengths * ratio
            emission = np.add.reduceat(np.log10(np.maximum(counts, 1))[texts.tokens], starts)
            pair = classes[texts.before] * width + classes[texts.tokens]
            learned = np.bincount(pair[texts.learned], minlength=width * width)
            doc = np.repeat(np.arange(len(starts)), texts.lengths)
            keys, seen = np.unique(doc * width * width + pair, return_counts=True)
            edges = np.searchsorted(keys, np.arange(len(starts) + 1) * width * width)
            pairs, seen = (keys % (width * width)).astype("<u2"), seen.astype("<i4")
            ids = _of(row.ids, "<i8").tolist()
            for i, (doc_id, flag) in enumerate(zip(ids, texts.flags.tolist())):
                own = slice(edges[i], edges[i + 1])
                out.append(
                    (
                        None if flag & 2 else doc_id, bool(flag & 1), texts.lengths[i], known[i], base[i],
                        emission[i], pairs[own].tobytes(), seen[own].tobytes(), None, None,
                    )
                )
            none = (None,) * 8
            out.extend((*none, k, learned[k]) for k in np.flatnonzero(learned).tolist())
        frame = pd.DataFrame(out, columns=_names(SCORED))
        return frame.astype(
            {"doc_id": "Int64", "n_tokens": "Int64", "n_known": "Int64", "k": "Int32", "n": "Int64"}
        )

    return run


def log_transitions(pairs: np.ndarray, once: int, distinct: int) -> np.ndarray:
    """log10 of P(outcome | class before) over the class size, flat by pair of classes; an
    unknown word is one of ``distinct + 1``."""
    width = CLASSES + 1
    counts = pairs.reshape(width, width)[:CLASSES, :CLASSES].astype(float)
    sizes, total = counts.sum(axis=0), counts.sum()
    if not total:  # nothing was learned: the unknown word is the only outcome
        return np.zeros(width * width)
    # an unknown word before tells nothing about the class that follows
    given = np.vstack((counts, sizes)) + (sizes > 0)
    given /= given.sum(axis=1, keepdims=True)
    unseen = (once + 1) / (total + 2)
    out = np.zeros((width, width))
    with np.errstate(divide="ignore"):
        out[:, :CLASSES] = np.log10(given * (1 - unseen) / np.maximum(sizes, 1))
    out[:, UNKNOWN] = np.log10(unseen / (distinct + 1))
    return out.ravel()


def _finish(logs: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = [
                e + float(logs[_of(p, "<u2")] @ _of(s, "<i4"))
                for e, p, s in zip(batch["emission"], batch["pairs"], batch["seen"])
            ]
            yield batch.drop(columns=["emission", "pairs", "seen"]).assign(score=score)

    return run


def score_documents(docs: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """One row per document.

    Columns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: tokens
    with the end, those seen in training, all training tokens, the add-one unigram and the
    class model's log10 probability. A null or empty text is its end alone; a null id counts as
    not held out; repeated rows are learned from and scored each; an empty table gives no rows;
    if no row is for training, every token is unknown and both scores are 0. Other columns are
    ignored. Words are told apart by a 64-bit hash.
    """
    bounded_batches(docs.sparkSession)
    modulus, held_out = HELD_OUT
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (fold(F.col("doc_id"), modulus) == held_out).alias("held_out"),
    )
    spark = docs.sparkSession
    places_at = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the partitioning is known to Spark as long as the rows are kept: joins by chunk move the classes
    chunks = rows.mapInPandas(_encode, CHUNK).repartition(places_at, "chunk").persist(StorageLevel.DISK_ONLY)
    words = chunks.agg(F.sum(F.octet_length("words") / 8)).first()[0] or 0
    parts = 1 + int(words) // WORDS_PER_PART
    found = chunks.groupBy("chunk").applyInPandas(_words(parts), WORDS).groupBy("part")
    places = found.applyInPandas(_places, PLACES).repartition(places_at, "part").persist(StorageLevel.DISK_ONLY)
    sums = places.agg(F.sum("tokens"), F.sum("known"), F.sum("once")).first()
    tokens_learned, distinct, once = (n or 0 for n in sums)
    size = (SLOTS + 1) * CLASSES
    maps, by_chunk, by_part = spark.createDataFrame([], CLASS_MAP), chunks.groupBy("chunk"), places.groupBy("part")
    for sweep in range(sweeps):
        before = maps
        blocks = by_chunk.cogroup(before.groupBy("chunk")).applyInPandas(_contexts(parts), BLOCK)
        vectors = saved(
            by_part.cogroup(blocks.groupBy("part")).applyInPandas(_gather, VECTORS), "class-lm-vectors"
        )
        slim = vectors.select("counts", "first", "owners", "slots", "seen")
        found = _summed(slim.mapInPandas(_context_counts(None), "k int, n long"), size + 3)
        contexts = found[:size].reshape(SLOTS + 1, CLASSES)
        moved = _class_maps(contexts, counted=sweep == sweeps - 1)
        maps = saved(vectors.mapInPandas(moved, CLASS_MAP), "class-lm-classes")
        discard(vectors)
        if sweep:
            discard(before)
    scored = saved(
        by_chunk.cogroup(maps.groupBy("chunk")).applyInPandas(_scorer(tokens_learned, distinct, parts), SCORED),
        "class-lm-scored",
    )
    places.unpersist()
    chunks.unpersist()
    pairs = _summed(scored.where("k IS NOT NULL").select("k", "n"), (CLASSES + 1) ** 2)
    return (
        scored.where("k IS NULL")
        .select("doc_id", "held_out", "n_tokens", "n_known", "base", "emission", "pairs", "seen")
        .mapInPandas(
            _finish(log_transitions(pairs, once, distinct)),
            "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double",
        )
        .select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens_learned).cast("long").alias("train_tokens"),
            F.col("base").alias("base_score"), "score",
        )
    )
