"""Alignment of two tokenizers' tokens over the same texts, with corpus counts of id pairs.

Side A is a byte-level BPE over the text with a space before it, side B a piece model that adds
this space itself, so both cover the same bytes. Batch by batch, and keyed by document, an as-of
merge finds for each token start the other side's covering token; the union of both directions
is all overlaps, and places where both sides have a token end cut the tokens into groups.

How often an id pair is linked in the whole corpus takes a second step. Texts are kept as chunks
of bounded size, each with its distinct pairs; a chunk asks for the count of each of its pairs
once, however often it stands there, and gets them back for its documents' sums.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, saved
from matchlake.llm.tokens import _ALPHABET, _kept_by_worker, gathered, vocabulary_path

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
BATCH_CHARS = 2 << 20  # texts merged at a time
CHUNK_CHARS, CHUNK_ROWS = 16 << 20, 50_000
SIDE_BITS = 32  # an id pair is one long
CHUNKS = (
    "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, groups_sha256 array<string>, size array<long>, pairs array<long>, "
    "times array<long>, refs binary, seen binary"
)
GROUPS = "doc_id long, start long, end long, a_ids array<long>, b_ids array<long>"
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)
_BYTES = {chr(_ALPHABET.get(b, b)): b for b in range(256)}
# Texts of these characters only are split alike by every Unicode version.
_PLAIN = re.compile("[ -~\t\n\rÀ-ɏ]*")
# A space beside other white space, or at an end, may be a token together with it.
_LOOSE = re.compile(r"\A\s| \s| \Z")
CACHED_WORDS = 500_000
WRONG = (b"", b"")


# --- the two sides ------------------------------------------------------------------------


class Sides:
    """Ids of texts on both sides, and the bytes of every id."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(byte_path)
        self.tokenizer.encode_special_tokens = True
        with open(byte_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = {t: bytes(map(_BYTES.__getitem__, t)) for t in model["vocab"] if set(t) <= _BYTES.keys()}
        self.a = [b""] * (max(model["vocab"].values()) + 1)
        for token, raw in vocabulary.items():
            self.a[model["vocab"][token]] = raw
        self.quick = self._quick(model, vocabulary)
        self.seen: dict[str, tuple[bytes, bytes]] = _kept_by_worker((byte_path, piece_path))
        self.pieces = SentencePieceProcessor(model_file=piece_path)
        self.b = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i in range(self.pieces.get_piece_size())
            for p in [self.pieces.id_to_piece(i)]
        ]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, t)), np.int64) for t in (self.a, self.b))
        # no piece goes on over a space, so a word with the space before it has its own pieces
        self.by_word = not any(" " in p.decode("utf-8", "replace").lstrip(" ") for p in self.b)
        # an id and what follows it in the text form of groups
        self.a_texts, self.b_texts = (
            [np.array([b"%d" % i + mark for i in range(len(t))], object) for mark in marks]
            for t, marks in ((self.a, (b",", b"|")), (self.b, (b",", b";")))
        )

    def _quick(self, model: dict, vocabulary: dict[str, bytes]):
        """The same merges in a faster library, where ids follow the order of the merges."""
        import tiktoken
        from public_tokenizers import PATTERN

        merged = [m.replace(" ", "", 1) if isinstance(m, str) else "".join(m) for m in model["merges"]]
        first = min((model["vocab"][m] for m in merged), default=0)
        if [model["vocab"][m] for m in merged] != list(range(first, first + len(merged))):
            return None
        ranks = {raw: model["vocab"][token] for token, raw in vocabulary.items()}
        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, text: str) -> list[int]:
        text = " " + text
        if self.quick is not None and _PLAIN.fullmatch(text):
            return self.quick.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, unless either side's bytes are not the text's."""
        raw = (" " + text).encode("utf-8", "replace")
        a, b = self.a_ids(text), self.pieces.encode(text, num_threads=1)
        if b"".join(map(self.a.__getitem__, a)) != raw or b"".join(map(self.b.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)

    def _of_words(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """As ``of``: no token of either side goes on over a single space, so texts are looked up
        word by word, and a worker keeps the words it has seen."""
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words = parts.flatten().dictionary_encode()
        known, which = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy()
        if len(self.seen) > CACHED_WORDS:
            self.seen.clear()
        own = list(map(self.seen.get, known))
        if None in own:
            self._learn([w for w, pair in zip(known, own) if pair is None])
            own = [self.seen[w] if pair is None else pair for w, pair in zip(known, own)]
        ends = parts.offsets.to_numpy()
        wrong = np.r_[0, np.cumsum(np.array([not pair[0] for pair in own], bool)[which])][ends]
        sides = []
        for ids in zip(*own):
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            flat = gathered(np.frombuffer(b"".join(ids), np.int32), sizes, which)
            sides.append(np.split(flat, np.r_[0, np.cumsum(sizes[which])][ends][1:-1]))
        return [None if bad else pair for bad, *pair in zip(np.diff(wrong).tolist(), *sides)]

    def _learn(self, words: list[str]) -> None:
        """Ids of words as bytes, or ``WRONG`` where either side does not give the word back."""
        a_bytes, b_bytes, plain = self.a.__getitem__, self.b.__getitem__, _PLAIN.fullmatch
        for word, b in zip(words, self.pieces.encode(words, num_threads=1)):
            quick = self.quick is not None and plain(word)
            a = self.quick.encode_ordinary(" " + word) if quick else self.a_ids(word)
            raw = (" " + word).encode("utf-8", "replace")
            same = b"".join(map(a_bytes, a)) == raw == b"".join(map(b_bytes, b))
            self.seen[word] = (array("i", a).tobytes(), array("i", b).tobytes()) if same else WRONG

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of every text; none for one that either side does not give back."""
        found: list = [None] * len(texts)
        worded = [i for i, t in enumerate(texts) if t and self.by_word and not _LOOSE.search(t)]
        for i, pair in zip(worded, self._of_words([texts[i] for i in worded]) if worded else []):
            found[i] = pair
        for i in set(range(len(texts))).difference(worded):
            found[i] = self.of(texts[i]) if texts[i] else None
        empty = np.array([], np.int32)
        return [pair or (empty, empty) for pair in found]


def _tokens(ids: list[np.ndarray], sizes: np.ndarray, name: str) -> pd.DataFrame:
    """One row per token: document, its place over all texts' bytes, id and number."""
    doc = np.repeat(np.arange(len(ids)), list(map(len, ids)))
    flat = np.concatenate([np.array([], np.int64), *ids])
    size = sizes[flat]
    at = np.cumsum(size) - size
    return pd.DataFrame({"doc": doc, "at": at, name: np.arange(len(doc)), f"{name}_id": flat})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Linked tokens as two arrays of numbers, and which tokens of A and of B begin a group.

    Both sides tile the bytes of every document, so the last token of the other side that does
    not start after a token's start covers it.
    """
    right_a, right_b = (t[["doc", "at", n]].assign(other=t["at"]) for t, n in ((a, "a"), (b, "b")))
    into_b = pd.merge_asof(a[["doc", "at", "a"]], right_b, on="at", by="doc")
    into_a = pd.merge_asof(b[["doc", "at", "b"]], right_a, on="at", by="doc")
    a_first = (into_b["other"] == into_b["at"]).to_numpy()
    b_first = (into_a["other"] == into_a["at"]).to_numpy()
    # equal starts are found from either side
    inside = into_a[~b_first]
    links_a = np.concatenate((into_b["a"], inside["a"])).astype(np.int64)
    links_b = np.concatenate((into_b["b"], inside["b"])).astype(np.int64)
    return links_a, links_b, a_first, b_first


class Aligned:
    """The alignment of some texts."""

    def __init__(self, texts: list[str | None], sides: Sides):
        self.sides, self.n = sides, len(texts)
        ids = sides.encode(texts)
        self.a = _tokens([a for a, _ in ids], sides.a_sizes, "a")
        self.b = _tokens([b for _, b in ids], sides.b_sizes, "b")
        self.links_a, self.links_b, self.a_first, self.b_first = overlaps(self.a, self.b)

    def per_document(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=self.n)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents with their distinct id pairs in order, and how often each is linked."""
        a, b = (t[f"{n}_id"].to_numpy() for t, n in ((self.a, "a"), (self.b, "b")))
        doc = self.a["doc"].to_numpy()[self.links_a]
        pair = (a[self.links_a] << SIDE_BITS) | b[self.links_b]
        order = np.lexsort((pair, doc))
        doc, pair = doc[order], pair[order]
        fresh = np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])][: len(doc)]
        first = np.flatnonzero(fresh)
        return doc[first], pair[first], np.diff(np.r_[first, len(doc)])

    def group_texts(self) -> list[bytes]:
        """Per document ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = np.cumsum(self.a_first) - 1, np.cumsum(self.b_first) - 1
        n = int(self.a_first.sum())
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        place_a = np.arange(len(group_a)) + (np.cumsum(in_b) - in_b)[group_a]
        place_b = np.arange(len(group_b)) + np.cumsum(in_a)[group_b]
        out = np.empty(len(group_a) + len(group_b), object)
        for place, ids, starts, texts in (
            (place_a, self.a["a_id"], self.a_first, self.sides.a_texts),
            (place_b, self.b["b_id"], self.b_first, self.sides.b_texts),
        ):
            last = np.r_[starts[1:], True][: len(starts)]
            out[place] = np.where(last, texts[1][ids.to_numpy()], texts[0][ids.to_numpy()])
        ends = np.cumsum(self.per_document(self.a["doc"]) + self.per_document(self.b["doc"])).tolist()
        pieces, begins = out.tolist(), [0, *ends[:-1]]
        return [b"".join(pieces[low:high])[:-1] for low, high in zip(begins, ends)]

    def group_rows(self) -> Iterator[tuple]:
        """Document, byte offsets in the text with its space, ids of both sides."""
        size = np.r_[self.a["at"].to_numpy(), self.sides.a_sizes[self.a["a_id"]].sum()]
        doc = self.a["doc"].to_numpy()
        begin = np.flatnonzero(self.a_first)
        begin_b = np.flatnonzero(self.b_first)
        base = size[np.searchsorted(doc, doc[begin])]
        a, b = self.a["a_id"].to_numpy(), self.b["b_id"].to_numpy()
        ends = size[np.r_[begin[1:], len(a)]] if len(begin) else begin
        parts = zip(np.split(a, begin)[1:], np.split(b, begin_b)[1:])
        for d, at, to, own, (ids_a, ids_b) in zip(doc[begin], size[begin], ends, base, parts):
            yield int(d), int(at - own), int(to - own), ids_a.tolist(), ids_b.tolist()


# --- chunks of texts ------------------------------------------------------------------------


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, so that their zeros lie together and compress."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw) -> np.ndarray:
    flat = np.frombuffer(bytes(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(flat.T).view("<u4").ravel().astype(np.int64)


class Chunk:
    def __init__(self):
        self.chars, self.rows = 0, 0
        self.columns: dict[str, list] = {}
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, ids: list, aligned: Aligned) -> None:
        doc, pair, times = aligned.pairs()
        a_docs = aligned.a["doc"].to_numpy()
        n_a, n_b = aligned.per_document(a_docs), aligned.per_document(aligned.b["doc"])
        own = {
            "doc_id": ids,
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": aligned.per_document(a_docs[aligned.a_first]),
            "n_links": aligned.per_document(a_docs[aligned.links_a]),
            "groups_sha256": [hashlib.sha256(t).hexdigest() if t else "" for t in aligned.group_texts()],
            "size": aligned.per_document(doc),
        }
        for name, values in own.items():
            self.columns.setdefault(name, []).extend(values)
        self.found.append((pair, times))

    def row(self, number: int) -> pd.DataFrame:
        pair, times = (np.concatenate(parts) for parts in zip(*self.found))
        pairs, refs = np.unique(pair, return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, refs, times)
        row = {
            "chunk": number, **self.columns, "pairs": pairs, "times": total,
            "refs": _planes(refs), "seen": _planes(times),
        }
        return pd.DataFrame({name: [value] for name, value in row.items()})


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list]]:
    """Ids and texts, as many at a time as their length allows."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids.append(None if pd.isna(doc_id) else int(doc_id))
            texts.append(text)
            size += len(text or "")
            if size >= BATCH_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _rows(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _paths(byte_path: str | None, piece_path: str | None) -> tuple[str, str]:
    return byte_path or vocabulary_path(BYTE_VOCABULARY), piece_path or vocabulary_path(PIECE_VOCABULARY)


def chunks(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Aligned documents in chunks, each with its distinct id pairs."""
    paths = _paths(byte_path, piece_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        sides, chunk = Sides(*paths), Chunk()
        number = TaskContext.get().partitionId() << 33
        for ids, texts in _batches(batches):
            chunk.add(ids, Aligned(texts, sides))
            chunk.chars += sum(len(t or "") for t in texts)
            chunk.rows += len(ids)
            if chunk.chars >= CHUNK_CHARS or chunk.rows >= CHUNK_ROWS:
                yield chunk.row(number)
                chunk, number = Chunk(), number + 1
        if chunk.rows:
            yield chunk.row(number)

    return saved(_rows(docs).mapInPandas(run, CHUNKS), "alignment-chunks")


def pair_counts(chunked: DataFrame) -> DataFrame:
    """``pair, a_id, b_id, n, best``: links of every id pair, and whether no other pair of the
    B id has more."""
    own = chunked.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = own.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    counts = saved(
        counts.select(
            "pair", F.shiftright("pair", SIDE_BITS).alias("a_id"),
            F.col("pair").bitwiseAND(F.lit((1 << SIDE_BITS) - 1)).alias("b_id"), "n",
        ),
        "alignment-counts",
    )
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))
    return counts.join(most, "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(of_chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    row = of_chunk.iloc[0]
    answers = answers.sort_values("place")
    refs, seen = _from_planes(row["refs"]), _from_planes(row["seen"])
    doc = np.repeat(np.arange(len(row["size"])), np.asarray(row["size"], np.int64))
    out = {name: row[name] for name in ("n_a", "n_b", "n_groups", "n_links")}
    for name, per_link in (("n_best", answers["best"].to_numpy(np.int64)), ("count_sum", answers["n"].to_numpy())):
        total = np.zeros(len(row["size"]), np.int64)
        np.add.at(total, doc, per_link[refs] * seen)
        out[name] = total
    doc_id = pd.array([None if pd.isna(i) else int(i) for i in row["doc_id"]], "Int64")
    return pd.DataFrame({"doc_id": doc_id, **out, "groups_sha256": row["groups_sha256"]})


def align(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.

    A null or empty text, and one that either side does not give back byte by byte, has no
    tokens: zeros and an empty digest. Strings of special tokens are plain text. Repeated rows
    count each; a null id stays null; pairs that tie for a B id's highest count are all best; an
    empty table gives no rows; other columns are ignored. A text is tokenised whole, by one task
    that holds its tokens.
    """
    chunked = chunks(docs, byte_path, piece_path)
    counts = saved(pair_counts(chunked).select("pair", "n", "best"), "alignment-pairs")
    asked = chunked.select(F.col("chunk").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("asker", "place", "n", "best")
    own = chunked.drop("pairs", "times")
    return own.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInPandas(_sums, RESULT)


def token_groups(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """One row per group: ``doc_id, start, end, a_ids, b_ids``; byte offsets count the space
    before the text. Rows as in ``align``; documents without tokens have none."""
    paths = _paths(byte_path, piece_path)
    names = [c.split()[0] for c in GROUPS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sides = Sides(*paths)
        for ids, texts in _batches(batches):
            rows = [(ids[doc], *rest) for doc, *rest in Aligned(texts, sides).group_rows()]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return _rows(docs).mapInPandas(run, GROUPS)
