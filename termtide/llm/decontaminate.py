"""Benchmark items found in documents within an edit-distance budget.

An item of m characters has a budget of k = floor(m * rate) errors. It is cut into
k + 1 pieces; if a passage is within k errors of the item, at least one piece stands in
it unchanged (pigeonhole). All pieces of a block of items are one Aho-Corasick
automaton. The pieces are the leaves of a tree whose nodes have c consecutive pieces and
a budget of c - 1: a part within its budget has a child within its own (pigeonhole once
more). So a hit climbs from its piece to the whole item as long as Myers' bit-parallel
algorithm finds the part around it within budget, and a chance hit ends after a few letters.
At the root it finds the smallest distance of any passage there: no match within the
budget is missed, and every reported distance is exact.

Items are taken in blocks of ``block_bytes`` at most, each of which is sent to all tasks
and held against all rows; documents are never shuffled.

Definitions: both sides are lower-cased and white space becomes one space. Null or empty
documents and items match nothing; an item whose budget is 0 must stand there exactly.
Items are told apart by their ids; items with one id, or equal rows, are each reported
under that id once, with the smallest distance. Null ids are kept as null; document ids
that are no whole numbers fail in the cast. Empty tables, on either side, find nothing.
Texts of any length are searched whole. ``find_leaks`` needs two names for the two ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .exchange import slices

RATE = 0.1
BLOCK_BYTES = 1 << 20


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces_of(length: int, budget: int) -> list[tuple[int, int]]:
    """Begin and end of budget + 1 parts of about equal length."""
    cuts = [length * i // (budget + 1) for i in range(budget + 2)]
    return list(zip(cuts, cuts[1:]))


def ancestors(parts: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """For each piece, the nodes above it but the root, from small to large: begin, end, budget."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    todo = [(0, len(parts))]
    while todo:
        low, high = todo.pop()
        if 1 < high - low < len(parts):
            for i in range(low, high):
                out[i].insert(0, (parts[low][0], parts[high - 1][1], high - low - 1))
        if high - low > 1:
            middle = (low + high) // 2
            todo += [(low, middle), (middle, high)]
    return out


def myers(pattern_bits: dict[str, int], m: int, text: str, begin: int, end: int, budget: int) -> tuple[int, int] | None:
    """Smallest distance of the pattern to a passage of text[begin:end], and where it first ends; None beyond the budget."""
    ones, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = ones, 0, m
    best, place = budget + 1, -1
    get = pattern_bits.get
    for at in range(begin, end):
        eq = get(text[at], 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(horizontal | plus) & ones
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & ones
        down = down << 1 & ones
        plus = down | ~(vertical | up) & ones
        minus = up & vertical
        if score < best:
            best, place = score, at + 1
            if best == 0:
                break
    return (best, place) if best <= budget else None


def _letter_bits(text: str) -> dict[str, int]:
    bits: dict[str, int] = {}
    for i, letter in enumerate(text):
        bits[letter] = bits.get(letter, 0) | 1 << i
    return bits


class Items:
    """A block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        self.ids, self.texts, self.bits, self.budgets, self.above, self.pairs = [], [], [], [], [], []
        self.part_bits: dict[tuple[int, int, int], dict[str, int]] = {}
        places: dict[str, list[tuple[int, int, int]]] = {}
        for id_, text in items:
            number, budget = len(self.ids), int(len(text) * rate)
            parts = pieces_of(len(text), budget)
            self.ids.append(id_)
            self.texts.append(text)
            self.bits.append(_letter_bits(text))
            self.budgets.append(budget)
            self.above.append(ancestors(parts))
            self.pairs.append([self._sibling(number, seat, part) for seat, part in enumerate(parts)])
            for seat, (begin, end) in enumerate(parts):
                places.setdefault(text[begin:end], []).append((number, seat, end))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()

    def _sibling(self, number: int, seat: int, part: tuple[int, int]) -> tuple[str, int, str, int] | None:
        """If the node above a piece is a pair: the halves of its other piece, near and far, and where they stand."""
        if not self.above[number][seat] or self.above[number][seat][0][2] != 1:
            return None
        begin, end, _ = self.above[number][seat][0]
        low, high = (part[1], end) if part[0] == begin else (begin, part[0])
        middle, whole = (low + high) // 2, self.texts[number]
        near, far = ((low, middle), (middle, high)) if part[0] == begin else ((middle, high), (low, middle))
        return whole[slice(*near)], near[0], whole[slice(*far)], far[0]

    def _climbs(self, text: str, at: int, number: int, seat: int) -> bool:
        """Whether every part above the piece, were the item to begin at ``at``, is within its budget near there."""
        pair = self.pairs[number][seat]
        if pair is not None:
            # with one error at most, one half stands unchanged: the near one in its place, or the far one next to it
            near, near_at, far, far_at = pair
            if not (text.startswith(near, max(0, at + near_at)) or any(text.startswith(far, max(0, at + far_at + shift)) for shift in (-1, 0, 1))):
                return False
        for begin, end, budget in self.above[number][seat]:
            bits = self.part_bits.get((number, begin, end))
            if bits is None:
                bits = self.part_bits[number, begin, end] = _letter_bits(self.texts[number][begin:end])
            if not myers(bits, end - begin, text, max(0, at + begin - budget), min(len(text), at + end + budget), budget):
                return False
        return True

    def matches(self, text: str) -> dict[int | None, tuple[int, int, int]]:
        """By item id: distance, end of the passage, budget."""
        if not text or not self.ids:
            return {}
        # where each item would begin if the piece stands where it was found
        begins: dict[int, dict[int, None]] = {}
        for last, where in self.automaton.iter(text):
            for number, seat, end in where:
                at = last + 1 - end
                own = begins.setdefault(number, {})
                if at not in own and self._climbs(text, at, number, seat):
                    own[at] = None
        found: dict[int | None, tuple[int, int, int]] = {}
        for number, places in begins.items():
            m, budget = len(self.texts[number]), self.budgets[number]
            spans: list[list[int]] = []
            for at in sorted(places):
                if spans and at - spans[-1][1] <= m + 2 * budget:
                    spans[-1][1] = at
                else:
                    spans.append([at, at])
            for low, high in spans:
                best = myers(self.bits[number], m, text, max(0, low - budget), min(len(text), high + m + budget), budget)
                if best and (self.ids[number] not in found or best < found[self.ids[number]][:2]):
                    found[self.ids[number]] = (*best, budget)
        return found


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    block, size = [], 0
    for row in items.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        text = normal(row["t"])
        if not text:
            continue
        if block and size + len(text.encode()) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["i"], text))
        size += len(text.encode())
    yield block


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (document id, item id, distance, budget, match_end) for each document row and item that it has."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    parts = []
    for block in _blocks(items, item_id, item_text, block_bytes):
        # bounded by block_bytes
        held = spark.sparkContext.broadcast(block)

        def search(batches, held=held):
            known = Items(held.value, rate)
            for batch in slices(batches, 1):
                out = [(doc, item, *match) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for item, match in known.matches(normal(text)).items()]
                types = [pa.int64()] * 5
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["doc", "item", "distance", "match_end", "budget"])

        parts.append(rows.mapInArrow(search, "doc long, item long, distance long, match_end long, budget long"))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.select(F.col("doc").alias(id_col), F.col("item").alias(item_id), "distance", "budget", "match_end")


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no item is found, unchanged."""
    spark, columns = docs.sparkSession, docs.columns
    kept = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(text_col).cast("string").alias("__text"))
    for block in _blocks(items, item_id, item_text, block_bytes):
        held = spark.sparkContext.broadcast(block)

        def keep(batches, held=held):
            known = Items(held.value, rate)
            for batch in slices(batches, len(columns)):
                yield batch.filter(pa.array([not known.matches(normal(text)) for text in batch.column(batch.num_columns - 1).to_pylist()], pa.bool_()))

        kept = kept.mapInArrow(keep, kept.schema)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
