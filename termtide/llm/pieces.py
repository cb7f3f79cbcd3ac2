"""SentencePiece encoding by Viterbi over shared prefixes, and decoding.

Spaces become the mark U+2581 and one mark is put before the text; as no piece has a
mark after another letter, a text falls apart into marked words that can be segmented
one by one. The distinct marked words of a slice of rows are sorted, which is a
depth-first walk of their trie: what one word shares with the one before is not worked
out again. At every depth the best score so far, the piece that ends there, and the
pieces still open (nodes of the vocabulary's trie) are kept; going back up forgets them.

Scores. A segmentation maximises the sum of its pieces' log-probabilities, as the
unigram model does; of equal sums, the one whose last piece is longer. A unigram
vocabulary brings its scores. A vocabulary of merges only has ranks, so that rank r
counts as -ln(r + 1), Zipf's law; its segmentation is the likeliest one under that,
and not the one that replaying the merges gives. A letter without a piece costs
``UNKNOWN`` more than the worst piece and becomes its UTF-8 bytes.

Definitions: a null or empty text has no pieces and decodes to the empty text.
Decoding gives back the text exactly, marks (U+2581) in it included: they are written as
bytes. Repeated rows are each encoded. Input columns named like a result column are
replaced, all others are carried along.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .exchange import slices
from .suffix_sort import ranges

MARK = "▁"
UNKNOWN = 10.0
LITERAL = f"x{MARK}"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces with scores, as a trie of dictionaries, and the bytes of every id."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], special: set[int]):
        self.scores = scores
        self.byte_ids = byte_ids
        self.root: dict = {}
        usable = [i for i in range(len(pieces)) if i not in special and i not in set(byte_ids.values())]
        for i in usable:
            if MARK in pieces[i].lstrip(MARK):
                raise ValueError(f"piece {pieces[i]!r} has a mark inside")
            node = self.root
            for letter in pieces[i]:
                node = node.setdefault(letter, {})
            # no letter is the empty string, so it can hold the piece that ends here
            node.setdefault("", (i, scores[i]))
        self.unknown = min((scores[i] for i in usable), default=0.0) - UNKNOWN
        as_bytes = {i: bytes([b]) for b, i in byte_ids.items()}
        raw = [as_bytes.get(i, b"" if i in special else p.replace(MARK, " ").encode()) for i, p in enumerate(pieces)]
        self.sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(raw), np.uint8)

    def bytes_ids(self, letter: str) -> list[int]:
        return [self.byte_ids[b] for b in letter.encode("utf-8", "surrogatepass")]


def load(model: str = MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece model file."""
    import sentencepiece

    model_ = sentencepiece.SentencePieceProcessor(model_file=model)
    size = model_.vocab_size()
    pieces, scores = [model_.id_to_piece(i) for i in range(size)], [model_.get_score(i) for i in range(size)]
    byte_ids = {int(pieces[i][1:-1], 16): i for i in range(size) if model_.is_byte(i)}
    special = {i for i in range(size) if model_.is_control(i) or model_.is_unknown(i)}
    usable = [i for i in range(size) if i not in special and not model_.is_byte(i)]
    ranked = all(float(scores[i]).is_integer() for i in usable)
    if ranked:
        for rank, i in enumerate(usable):
            scores[i] = -float(np.log(rank + 1))
    if len(byte_ids) < 256:
        raise ValueError("the vocabulary has no pieces for single bytes")
    return Vocabulary(pieces, scores, byte_ids, special)


def marked_words(text: str) -> list[str]:
    if not text:
        return []
    out: list[str] = []
    for i, part in enumerate(text.split(MARK)):
        if i:
            out.append(LITERAL)
        out += _WORDS.findall((MARK if i == 0 else "") + part.replace(" ", MARK))
    return out


def segment(words: list[str], vocabulary: Vocabulary) -> list[list[int]]:
    """Piece ids of each of the words, which are distinct and sorted."""
    root, unknown = vocabulary.root, vocabulary.unknown
    best, start, piece, open_ = [0.0], [0], [-1], [[]]
    before, out = "", []
    for word in words:
        if word == LITERAL:
            out.append(vocabulary.bytes_ids(MARK))
            continue
        depth, limit = 0, min(len(word), len(before))
        while depth < limit and word[depth] == before[depth]:
            depth += 1
        del best[depth + 1 :], start[depth + 1 :], piece[depth + 1 :], open_[depth + 1 :]
        for at in range(depth, len(word)):
            letter = word[at]
            top, begin, id_, alive = best[at] + unknown, at, -1, []
            # pieces that began earlier come first, so that of equal sums the longer last piece stays
            for first, node in open_[at]:
                below = node.get(letter)
                if below is not None:
                    alive.append((first, below))
                    end = below.get("")
                    if end is not None and best[first] + end[1] > top:
                        top, begin, id_ = best[first] + end[1], first, end[0]
            below = root.get(letter)
            if below is not None:
                alive.append((at, below))
                end = below.get("")
                if end is not None and best[at] + end[1] > top:
                    top, begin, id_ = best[at] + end[1], at, end[0]
            best.append(top)
            start.append(begin)
            piece.append(id_)
            open_.append(alive)
        before = word
        ids, at = [], len(word)
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                ids += reversed(vocabulary.bytes_ids(word[at - 1]))
            at = start[at]
        out.append(ids[::-1])
    return out


def encode_texts(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, end to end, and the offsets between texts."""
    number: dict[str, int] = {}
    lists = [marked_words(t or "") for t in texts]
    codes = np.fromiter((number.setdefault(w, len(number)) for words in lists for w in words), np.int64)
    ordered = sorted(number)
    found = segment(ordered, vocabulary)
    rank = np.empty(len(ordered), np.int64)
    rank[np.fromiter(map(number.__getitem__, ordered), np.int64, len(ordered))] = np.arange(len(ordered))
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((i for ids in found for i in ids), np.int32)
    starts = np.cumsum(sizes) - sizes
    seat = rank[codes]
    ids = flat[ranges(starts[seat], sizes[seat])] if len(seat) else np.zeros(0, np.int32)
    per_text = np.fromiter(map(len, lists), np.int64, len(lists))
    ends = np.concatenate([[0], np.cumsum(sizes[seat])])
    return ids, ends[np.concatenate([[0], np.cumsum(per_text)])]


def decode_ids(ids: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> list[bytes]:
    """The bytes of each text, without the space that stands for the mark in front."""
    sizes = vocabulary.sizes[ids]
    data = vocabulary.data[ranges(vocabulary.starts[ids], sizes)].tobytes() if len(ids) else b""
    ends = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
    return [data[a + 1 : b] if b > a else b"" for a, b in zip(ends, ends[1:])]


NEW_COLUMNS = T.StructType().add("n_pieces", "long").add("ids", T.ArrayType(T.IntegerType())).add("decoded_sha256", "string").add("round_trip", "boolean")


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """All rows with n_pieces, ids, the hash of the decoded ids and whether they decode to the text."""
    carried = [c for c in docs.columns if c.lower() not in NEW_COLUMNS.names]
    # bounded by the vocabulary
    held, size = docs.sparkSession.sparkContext.broadcast(vocabulary), len(carried)
    names = [*[f"c{i}" for i in range(size)], *NEW_COLUMNS.names]

    def run(batches):
        known = held.value
        for rows in slices(batches, size):
            texts = [t or "" for t in rows.column(size).to_pylist()]
            ids, offsets = encode_texts(texts, known)
            back = decode_ids(ids, offsets, known)
            new = [
                pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32())),
                pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string()), pa.array([b == t.encode("utf-8", "surrogatepass") for b, t in zip(back, texts)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*[rows.column(i) for i in range(size)], *new], names=names)

    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)] + NEW_COLUMNS.fields)
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], *NEW_COLUMNS.names)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """All rows with the text of their ids; bytes that are no UTF-8 become U+FFFD, null ids the empty text."""
    carried = [c for c in rows.columns if c.lower() != text_col.lower()]
    held, size = rows.sparkSession.sparkContext.broadcast(vocabulary), len(carried)

    def run(batches):
        for batch in batches:
            lists = [x or [] for x in batch.column(size).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            ids = np.fromiter((i for x in lists for i in x), np.int64)
            texts = [b.decode("utf-8", "replace") for b in decode_ids(ids, offsets, held.value)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(size)], pa.array(texts, pa.string())], names=[*[f"c{i}" for i in range(size)], "text"])

    schema = T.StructType([T.StructField(f"c{i}", rows.schema[c].dataType) for i, c in enumerate(carried)]).add("text", "string")
    plain = rows.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(ids_col).cast("array<int>").alias("__ids"))
    return plain.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], F.col("text").alias(text_col))
