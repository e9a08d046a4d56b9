"""Spelling variants: words one edit apart, found by K-d trees over letter counts.

One letter replaced changes a word's letter counts by one up and one down (L1 distance two), one
inserted or deleted by one (distance one). So the words of each length are put in a K-d tree
over their counts, and a word searches the tree of its own length and that of the next: boxes
out of range are pruned, what is left is compared by counts, and survivors by letter order.

The upper levels of the trees, drawn from a bounded sample of words, say which leaf a word is
stored in and which leaves it must visit; every word is stored. A leaf's task goes on splitting
its words and carries all visitors down together. Leaves with too many words or visitors are cut
into parts and batches that all meet. Pairs never leave a task: it sends each word's number of
near words and the most frequent of them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, saved

LEAST_LENGTH, LEAST_COUNT = 7, 2
FORM_FACTOR = 10
DROP_MODULUS = 31
LEAF = 5_000  # words wanted in a leaf of the upper levels
MOST_LEAVES, SAMPLE_WORDS = 8_192, 400_000  # bound what the driver and a broadcast hold
PART, BATCH = 10_000, 60_000  # words and visitors in a task
LAST = 12  # words that are compared with all visitors that reach them
HELD_WORDS = 1_000_000  # counts a task keeps before it hands them on
CELLS = 1 << 20
TOGETHER = 1 << 20  # letters of the words that go down the upper levels at a time
SAME, LONGER = 0, 1  # what a visitor looks for: words of its length, or one letter longer
FOUND = "word string, n_near long, best_n long, best string"

# Code points of words: a-z and U+00C0 to U+00FF. Capitals A-Z become small, all else parts words.
_LETTERS = np.r_[97:123, 0xC0:0x100]
_SPLIT = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_COLUMN = np.zeros(256, np.int64)
_COLUMN[_LETTERS] = np.arange(len(_LETTERS))


# --- words of the corpus ----------------------------------------------------------------------


def runs(text: str | None) -> Counter:
    """Lower-cased runs of letters, as Latin-1 bytes: one byte is one code point."""
    return Counter((text or "").encode("latin-1", "replace").translate(_SPLIT).split())


def dropped(run: bytes, prefix_crc: int) -> bytes:
    """The run, without one letter where the hash of its document and itself says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix_crc)
    if h % DROP_MODULUS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[bytes, int] = {}

    def frame() -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("latin-1") for w in held], "n": list(held.values())})

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            prefix = zlib.crc32(b"%s:" % (b"" if pd.isna(doc_id) else b"%d" % int(doc_id)))
            for run, n in runs(text).items():
                if len(run) >= LEAST_LENGTH:
                    word = dropped(run, prefix)
                    if len(word) >= LEAST_LENGTH:
                        held[word] = held.get(word, 0) + n
        if len(held) >= HELD_WORDS:
            yield frame()
            held.clear()
    if held:
        yield frame()


def words(docs: DataFrame) -> DataFrame:
    """``word, n``: words long and frequent enough, with their occurrences."""
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = own.mapInPandas(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def _raw(words) -> list[bytes]:
    return [w.encode("latin-1") for w in words]


def letter_counts(raw: list[bytes]) -> np.ndarray:
    """One row of letter counts per word."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    cells = np.repeat(np.arange(len(raw)), sizes) * len(_LETTERS)
    cells += _COLUMN[np.frombuffer(b"".join(raw), np.uint8)]
    return np.bincount(cells, minlength=len(raw) * len(_LETTERS)).reshape(len(raw), -1).astype(np.int32)


# --- trees --------------------------------------------------------------------------------------


def _halves(counts: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """The letter and count that part the rows most evenly, and which rows are at most that."""
    best, half = None, len(counts) / 2
    for letter in np.flatnonzero(counts.min(axis=0) != counts.max(axis=0)):
        upto = np.cumsum(np.bincount(counts[:, letter]))
        upto = upto[upto < len(counts)]
        at = int(np.abs(upto - half).argmin())
        if best is None or abs(upto[at] - half) < best[0]:
            best = abs(upto[at] - half), int(letter), at
    if best is None:
        return None
    _, letter, at = best
    return letter, at, counts[:, letter] <= at


class Visitors:
    """Rows on their way down a tree, with how far their counts are from the box they are in:
    ``up`` letters missing, ``down`` letters too many."""

    def __init__(self, counts: np.ndarray, kind: np.ndarray):
        self.letters = _columns(counts)
        self.kind = kind
        self.rows = np.arange(len(counts), dtype=np.int32)
        self.up = np.zeros(len(counts), self.letters.dtype)
        self.down = np.zeros(len(counts), self.letters.dtype)

    def below(self, letter: int, low: int, high: int, old_low: int, old_high: int) -> Visitors:
        """Those that can still be in range once the box spans ``low`` to ``high`` in a letter."""
        x = self.letters[letter][self.rows]
        up, down = self.up, self.down
        if low != old_low:
            up = up + np.maximum(low - x, 0) - np.maximum(old_low - x, 0)
        if high != old_high:
            down = down + np.maximum(x - high, 0) - np.maximum(x - old_high, 0)
        # a replaced letter is one up and one down, a longer word has one more and none less
        near = (up <= 1) & (down <= self.most_down())
        out = object.__new__(Visitors)
        out.letters, out.kind = self.letters, self.kind
        out.rows, out.up, out.down = self.rows[near], up[near], down[near]
        return out

    def most_down(self) -> np.ndarray:
        return self.kind[self.rows] == SAME


TOP_COUNT = 127  # more than any count that is split at, unless counts are wide


def _columns(counts: np.ndarray) -> np.ndarray:
    """Letter by letter, in one byte where no count or sum of differences passes it."""
    narrow = not len(counts) or counts.sum(axis=1).max() <= 60
    return np.ascontiguousarray(counts.T.astype(np.int8 if narrow else np.int32))


def _split_box(box: dict, letter: int, at: int) -> tuple[tuple[int, int], dict, dict]:
    low, high = box.get(letter, (0, TOP_COUNT))
    return (low, high), {**box, letter: (low, at)}, {**box, letter: (at + 1, high)}


def plant(counts: np.ndarray, wanted: float) -> tuple | int:
    """Upper levels over a sample: ``(letter, count, left, right)`` or a leaf's number."""
    numbers = iter(range(len(counts) + 1))

    def grow(own: np.ndarray):
        halves = _halves(own) if len(own) > wanted else None
        if halves is None:
            return next(numbers)
        letter, at, left = halves
        return letter, at, grow(own[left]), grow(own[~left])

    return grow(counts)


def leaf_of(tree, counts: np.ndarray) -> np.ndarray:
    """The leaf that stores each row."""
    out = np.zeros(len(counts), np.int64)

    def go(node, rows: np.ndarray) -> None:
        if isinstance(node, int):
            out[rows] = node
        elif len(rows):
            letter, at, left, right = node
            small = counts[rows, letter] <= at
            go(left, rows[small])
            go(right, rows[~small])

    go(tree, np.arange(len(counts)))
    return out


def leaves_in_range(tree, visitors: Visitors) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves with the rows whose range meets their boxes."""

    def go(node, who: Visitors, box: dict):
        if not len(who.rows):
            return
        if isinstance(node, int):
            yield node, who.rows
            return
        letter, at, left, right = node
        old, low_box, high_box = _split_box(box, letter, at)
        yield from go(left, who.below(letter, *low_box[letter], *old), low_box)
        yield from go(right, who.below(letter, *high_box[letter], *old), high_box)

    yield from go(tree, visitors, {})


def _candidates(stored: np.ndarray, visitors: Visitors) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of visitors and of stored words whose counts are in range."""
    # letters that no stored word has add up; the others are compared one by one
    held = np.flatnonzero(stored.any(axis=0))
    ours, theirs = _columns(stored)[held], visitors.letters[held]
    others = visitors.letters.sum(axis=0, dtype=np.int32) - theirs.sum(axis=0, dtype=np.int32)
    wanted = np.where(visitors.kind == SAME, 2, 1) - others

    def go(own: np.ndarray, who: Visitors, box: dict):
        if not len(who.rows):
            return
        halves = _halves(stored[own]) if len(own) > LAST else None
        if halves is None:
            yield from compare(own, who.rows)
            return
        letter, at, left = halves
        old, low_box, high_box = _split_box(box, letter, at)
        yield from go(own[left], who.below(letter, *low_box[letter], *old), low_box)
        yield from go(own[~left], who.below(letter, *high_box[letter], *old), high_box)

    def compare(own: np.ndarray, rows: np.ndarray):
        words = ours[:, own]
        alike = (words == words[:, :1]).all(axis=1)
        # the letters these words agree in first: few visitors are left for the pairs
        apart = np.abs(theirs[alike][:, rows] - words[alike][:, :1]).sum(axis=0, dtype=np.int32)
        left = wanted[rows] - apart
        rows, left = rows[left >= 0], left[left >= 0]
        step = max(1, CELLS // words.size)
        for k in range(0, len(rows), step):
            near = rows[k : k + step]
            apart = np.abs(theirs[~alike][:, near, None] - words[~alike][:, None]).sum(axis=0, dtype=ours.dtype)
            v, s = np.nonzero(apart == left[k : k + step, None])
            yield near[v], own[s]

    yield from go(np.arange(len(stored)), visitors, {})


# --- letter order ---------------------------------------------------------------------------------


def _table(raw: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), length)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether one letter more makes each row of ``short`` the row of ``long``."""
    alike_before = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    alike_after = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return alike_before + alike_after >= short.shape[1]


def _verified(asked: dict[int, np.ndarray], spot: np.ndarray, stored: np.ndarray, kind, pairs) -> Iterator:
    length = stored.shape[1]
    for v, s in pairs:
        step = max(1, CELLS // length)
        for k in range(0, len(v), step):
            rows, own = v[k : k + step], s[k : k + step]
            for what, test in ((SAME, one_replaced), (LONGER, one_inserted)):
                pick = kind[rows] == what
                if pick.any():
                    a, b = rows[pick], own[pick]
                    right = test(asked[what][spot[a]], stored[b])
                    yield what, a[right], b[right]


# --- one leaf ---------------------------------------------------------------------------------------


def _most_frequent(of: np.ndarray, near: np.ndarray, names: list[str], words: list[str], n: np.ndarray) -> list[tuple]:
    """Per word of ``of``: its number of near words and the first of them by count, then name."""
    if not len(of):
        return []
    order = np.lexsort((near, -n[near], of))
    of, near = of[order], near[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    times = np.diff(np.r_[first, len(of)])
    return [
        (names[w], int(t), int(n[v]), words[v])
        for w, t, v in zip(of[first].tolist(), times, near[first].tolist())
    ]


def _found(rows: list[tuple]) -> pd.DataFrame:
    kinds = {"word": object, "n_near": "int64", "best_n": "int64", "best": object}
    return pd.DataFrame(rows, columns=list(kinds)).astype(kinds)


def _search_leaf(stored: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    if not len(stored) or not len(asked):
        return _found([])
    # in order of the words, so that numbers order them too
    stored, asked = stored.sort_values("word"), asked.sort_values("word")
    stored_raw, asked_raw = _raw(stored["word"]), _raw(asked["word"])
    kind = asked["kind"].to_numpy()
    length = len(stored_raw[0])
    tables, spot = {}, np.zeros(len(asked), np.int64)
    for what in (SAME, LONGER):
        own = np.flatnonzero(kind == what)
        spot[own] = np.arange(len(own))
        tables[what] = _table([asked_raw[i] for i in own], length - what)
    found = _verified(
        tables, spot, _table(stored_raw, length), kind,
        _candidates(letter_counts(stored_raw), Visitors(letter_counts(asked_raw), kind)),
    )
    parts = list(found)
    if not parts:
        return _found([])
    v, s = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    names, words_ = asked["word"].tolist(), stored["word"].tolist()
    rows = _most_frequent(v, s, names, words_, stored["n"].to_numpy())
    # a longer word has the shorter one near it too
    longer = kind[v] == LONGER
    rows += _most_frequent(s[longer], v[longer], words_, names, asked["n"].to_numpy())
    return _found(rows)


# --- the table, in Spark -----------------------------------------------------------------------------


def _trees(found: DataFrame) -> dict[int, tuple]:
    """Upper levels for the lengths with more words than a leaf."""
    total = found.count()
    leaf = max(LEAF, -(-total // MOST_LEAVES))
    sizes = found.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("size"))
    large = sizes.where(F.col("size") > leaf).collect()  # at most MOST_LEAVES rows
    share = min(1.0, SAMPLE_WORDS / max(total, 1))
    drawn = found.where(F.pmod(F.xxhash64("word"), F.lit(1 << 31)) < share * (1 << 31))
    sample = drawn.where(F.length("word").isin([r.length for r in large])).select("word").toPandas()["word"]
    raw = _raw(sample)
    by_length: dict[int, list[bytes]] = {r.length: [] for r in large}
    for word in sorted(raw):
        by_length[len(word)].append(word)
    return {n: plant(letter_counts(own), leaf * share) for n, own in by_length.items()}


def _together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches joined to larger ones, since each is split over all trees and leaves."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += int(batch["word"].str.len().sum())
        if size >= TOGETHER:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _by_length(raw: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    for length in np.unique(sizes):
        own = np.flatnonzero(sizes == length)
        yield int(length), own, letter_counts(raw[own].tolist())


def _stored(trees):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _together(batches):
            lengths, leaf = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length, own, counts in _by_length(np.array(_raw(batch["word"]), object)):
                lengths[own] = length
                leaf[own] = leaf_of(trees.value.get(length) or 0, counts)
            yield batch.assign(length=lengths, leaf=leaf)

    return run


def _asked(trees):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _together(batches):
            parts = []
            for length, own, counts in _by_length(np.array(_raw(batch["word"]), object)):
                for what in (SAME, LONGER):
                    tree = trees.value.get(length + what) or 0
                    for leaf, rows in leaves_in_range(tree, Visitors(counts, np.full(len(own), what))):
                        parts.append((own[rows], *(np.full(len(rows), x) for x in (length + what, leaf, what))))
            rows, lengths, leaf, kind = (np.concatenate(p) for p in zip(*parts))
            yield batch.iloc[rows].assign(length=lengths, leaf=leaf, kind=kind)

    return run


def near_words(found: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have near words."""
    trees = found.sparkSession.sparkContext.broadcast(_trees(found))
    place = ["length", "leaf"]
    stored = saved(
        found.mapInPandas(_stored(trees), "word string, n long, length long, leaf long"), "spelling-stored"
    )
    asked = saved(
        found.mapInPandas(_asked(trees), "word string, n long, length long, leaf long, kind int"), "spelling-asked"
    )
    sizes = stored.groupBy(*place).agg(F.ceil(F.count("*") / PART).alias("parts"))
    loads = asked.groupBy(*place).agg(F.ceil(F.count("*") / BATCH).alias("batches"))
    both = saved(sizes.join(loads, place), "spelling-leaves")
    leaves = both.select(*place, F.col("parts").alias("p"), F.col("batches").alias("b"))

    def every(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    key = [*place, "part", "batch"]
    spread = stored.join(both, place).withColumn("part", F.pmod(F.xxhash64("word"), "parts"))
    spread = spread.withColumn("batch", every("batches")).select(*key, "word", "n")
    sent = asked.join(leaves, place).withColumn("batch", F.pmod(F.xxhash64("word"), "b"))
    sent = sent.withColumn("part", every("p")).select(*key, "word", "n", "kind")
    near = spread.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(_search_leaf, FOUND)
    first = F.min(F.struct((-F.col("best_n")).alias("minus_n"), "best"))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return near.select("word", "n_near", (-F.col("first.minus_n")).alias("best_n"), "first.best")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: every round follows twice as many forms.

    A form is ten times as frequent, so chains are short and have no circles."""
    links = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        next_ = links.select(F.col("word").alias("over"), F.col("root").alias("next"))
        step = links.join(next_, F.col("root") == F.col("over"), "left")
        moved = saved(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                      "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        links = moved.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are runs of ``[A-Za-z]`` and U+00C0 to U+00FF of whole texts, A-Z lower-cased, some
    with a letter dropped by the hash of ``<doc_id>:<run>`` (no digits for a null id), with at
    least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences. Two are near if one code
    point inserted, deleted or replaced makes one the other. The form is the most frequent near
    word (ties: the smallest in code-point order) if it is ``FORM_FACTOR`` times as frequent,
    else null; the root is where the forms end, the word itself without one. Null and empty
    texts have no words, repeated rows count each, an empty table gives no rows, other columns
    are ignored. A text is taken whole.
    """
    found = saved(words(docs), "spelling-words")
    near = saved(near_words(found), "spelling-near")
    joined = found.join(near, "word", "left").withColumn("is_form", F.col("best_n") >= FORM_FACTOR * F.col("n"))
    joined = saved(
        joined.select(
            "word",
            F.when(F.col("is_form"), F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("is_form"), F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(joined.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    return joined.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
