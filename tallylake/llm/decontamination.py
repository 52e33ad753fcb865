"""Benchmark decontamination: rare n-grams as seeds, then Smith-Waterman alignment.

Seeds are pairs of words at most one word apart, the rarest of each item by their count over all
documents; they join the texts to the items that are aligned with them. The benchmark is a stated query set and is taken in blocks of bounded size, each of
which travels with the tasks; the documents stay where they are and nothing is
shuffled but the counts of the benchmark's own pairs. Seeds and bounds leave out only what
can't reach the similarity, so the matches are those of full alignment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallylake.llm.tables import Batches, map_batches
from tallylake.workspace import new_folder

BLOCK_WORDS = 250_000  # bound of a block of benchmark items
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SIMILARITY = 0.5  # of the score of a full copy
SHORT_ITEM = 8  # items of fewer words count only as full copies

WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Letters and digits only, in lower case, so case and punctuation don't hide a copy."""
    return WORD.findall(text.lower()) if text else []


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two id arrays and the passage position where it ends.

    One row of the Smith-Waterman table at a time; the gaps along a row are a running maximum.
    """
    width = len(passage)
    step = np.arange(width + 1) * -GAP
    above = np.zeros(width + 1, np.int64)
    best, best_end = 0, 0
    for word in item:
        row = np.zeros(width + 1, np.int64)
        row[1:] = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        row = np.maximum(np.maximum(row, above + GAP), 0)
        row = np.maximum.accumulate(row + step) - step
        end = int(row.argmax())
        if row[end] > best:
            best, best_end = int(row[end]), end
        above = row
    return best, best_end


def minimum(words: int) -> float:
    """The similarity an item of so many words must reach."""
    return MIN_SIMILARITY if words >= SHORT_ITEM else 1.0


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of several runs, one after the other."""
    shift = starts - np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.repeat(shift, lengths) + np.arange(lengths.sum())


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class Bags:
    """How often each item holds each of its values."""

    def __init__(self, items: list[np.ndarray]):
        bags = [np.unique(x, return_counts=True) for x in items]
        self.at = offsets(np.array([len(values) for values, _ in bags]))
        self.values = np.concatenate([values for values, _ in bags])
        self.counts = np.concatenate([counts for _, counts in bags])

    def shared(self, items: np.ndarray, held: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each of ``items`` how many of its values a text has that holds ``held`` so many times."""
        lengths = self.at[items + 1] - self.at[items]
        if not len(held) or not lengths.sum():
            return np.zeros(len(items), np.int64)
        bag = runs(self.at[items], lengths)
        place = np.minimum(np.searchsorted(held, self.values[bag]), len(held) - 1)
        there = np.where(held[place] == self.values[bag], times[place], 0)
        sums = offsets(np.minimum(there, self.counts[bag]))
        ends = offsets(lengths)
        return sums[ends[1:]] - sums[ends[:-1]]


class Block:
    """Some benchmark items, ready to be searched in texts.

    A match adds 2 to a score and nothing else adds to it, so an alignment that reaches the
    similarity asked for matches at least ``need`` of an item's words. Between two matches in a row that
    are more than one word apart, in text or item, lie costs of 2 or more; with a score of
    ``least`` or more, ``least / 2 - 1`` matches (rounded up) are therefore followed by another at most one
    word apart on both sides. Each of these is a pair of words that starts at another word of
    the item, so whichever ``len(item) - 1`` less that number, and one more, of the starts are taken, one of
    their pairs is in the text: those with the rarest pairs are the seeds. Two matches in a row that are not neighbours in text and item alike have a cost of 1 at least
    between them, so m matches and b pairs of neighbours score no more than m + b + 1.
    """

    def __init__(self, items: list[tuple[object, list[str]]]):
        self.ids: dict[str, int] = {}
        self.items = []
        for item_id, words in items:
            numbers = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            self.items.append((item_id, np.array(numbers, np.int64)))
        sizes = [len(x) for _, x in self.items]
        self.need = np.array([int(np.ceil(minimum(n) * n)) for n in sizes], np.int64)
        self.least = np.array([int(np.ceil(MATCH * minimum(n) * n)) for n in sizes], np.int64)
        self.words = Bags([x for _, x in self.items])
        self.pairs = Bags([self._pairs(x) for _, x in self.items])
        self.has_single = min(sizes) == 1
        self.grams = np.unique(np.concatenate([self._grams(x).ravel() for _, x in self.items]))
        self.choose_seeds(np.zeros(len(self.grams), np.int64))

    def _grams(self, numbers: np.ndarray) -> np.ndarray:
        """Codes of an item's pairs, a row per first word; the code of the word itself if it is the only one."""
        if len(numbers) == 1:
            return numbers[:, None]
        base = len(self.ids) + 1
        next_one = numbers[:-1] * base + numbers[1:]
        after_it = np.append(numbers[:-2] * base + numbers[2:], next_one[-1])
        return np.column_stack([next_one, after_it])

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        """The codes of a text's pairs, of neighbours and of words with one between."""
        base = len(self.ids) + 1
        at = np.flatnonzero(numbers)  # pairs of known words only
        known = numbers[at]
        found = [known] if self.has_single else []
        for apart in (1, 2):  # known words at most two places apart are at most two known words apart
            near = np.flatnonzero(at[apart:] - at[:-apart] <= 2)
            found.append(known[near] * base + known[near + apart])
        return np.concatenate(found)

    def _pairs(self, numbers: np.ndarray) -> np.ndarray:
        """Codes of the neighbouring words of a text that are both the block's."""
        first, second = numbers[:-1], numbers[1:]
        return (first * (len(self.ids) + 1) + second)[(first > 0) & (second > 0)]

    def numbers(self, text: str | None) -> np.ndarray:
        """The numbers of a text's words that are the block's, 0 for the others."""
        words = words_of(text)
        return np.fromiter(map(self.ids.get, words, repeat(0)), np.int64, len(words))

    def held_grams(self, text: str | None) -> np.ndarray:
        """The places among ``grams`` of those that a text holds, each as often as it does."""
        codes = self.codes(self.numbers(text))
        place = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        return place[self.grams[place] == codes]

    def choose_seeds(self, frequency: np.ndarray) -> None:
        """Per item the pairs of its rarest first words, so many that no match lacks them all."""
        codes, owners = [], []
        for k, (_, numbers) in enumerate(self.items):
            grams = self._grams(numbers)
            often = frequency[np.searchsorted(self.grams, grams)].sum(axis=1)
            near = max(1, -(-int(self.least[k]) // 2) - 1) if len(numbers) > 1 else 1
            rarest = np.argsort(often, kind="stable")[: len(grams) - near + 1]
            seeds = np.unique(grams[rarest])
            codes.append(seeds)
            owners.append(np.full(len(seeds), k, np.int64))
        found, owner = np.concatenate(codes), np.concatenate(owners)
        order = np.argsort(found, kind="stable")
        self.seed_owner = owner[order]  # by seed
        self.seeds, counts = np.unique(found, return_counts=True)
        self.seed_at = offsets(counts)

    def candidates(self, numbers: np.ndarray) -> np.ndarray:
        """The items of which a text holds a seed and, wherever they stand, enough words and pairs."""
        codes = np.unique(self.codes(numbers))
        at = np.minimum(np.searchsorted(self.seeds, codes), len(self.seeds) - 1)
        at = at[self.seeds[at] == codes]
        if not len(at):
            return at
        items = np.unique(self.seed_owner[runs(self.seed_at[at], self.seed_at[at + 1] - self.seed_at[at])])
        held = np.unique(numbers[numbers > 0], return_counts=True)
        words = self.words.shared(items, *held)
        enough = words >= self.need[items]
        items, words = items[enough], words[enough]
        pairs = self.pairs.shared(items, *np.unique(self._pairs(numbers), return_counts=True))
        return items[words + pairs + 1 >= self.least[items]]

    def passages(self, k: int, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word, end word) of the parts of a text outside which no alignment is good enough.

        Such an alignment starts and ends with a match, and its gaps cost no more than its matches
        allow, so it has ``need`` of the item's words within ``widest`` words of the text.
        """
        words = self.words.values[self.words.at[k] : self.words.at[k + 1]]
        need, size = int(self.need[k]), len(self.items[k][1])
        widest = size + int(MATCH * size * (1 - minimum(size)) / -GAP)
        at = np.flatnonzero(np.isin(numbers, words))
        first, last = at[: len(at) - need + 1], at[need - 1 :]
        near = last - first < widest
        first, last = first[near], last[near]
        if len(first):
            cut = np.flatnonzero(first[1:] > last[:-1])
            yield from zip(
                first[np.concatenate([[0], cut + 1])].tolist(),
                (last[np.concatenate([cut, [len(last) - 1]])] + 1).tolist(),
            )

    def matches(self, text: str | None) -> Iterator[tuple[object, float, int, int]]:
        """(item id, similarity, first word, end word) of every item found in a text."""
        numbers = self.numbers(text)
        for k in self.candidates(numbers).tolist():
            item_id, item = self.items[k]
            full, best = MATCH * len(item), (0, 0, 0)
            for low, high in self.passages(k, numbers):
                score, end = align(item, numbers[low:high])
                if score > best[0]:
                    best = (score, max(0, low + end - len(item)), low + end)
                if score == full:
                    break
            similarity = best[0] / full
            if similarity >= minimum(len(item)):
                yield item_id, similarity, best[1], best[2]


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    """The benchmark in blocks of about ``BLOCK_WORDS`` words; items without a word are left out."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    items, size = [], 0
    for row in rows.toLocalIterator():
        words = words_of(row["text"])
        if words:
            items.append((row["item_id"], words))
            size += len(words)
        if size >= BLOCK_WORDS:
            yield Block(items)
            items, size = [], 0
    if items:
        yield Block(items)


def seeded(docs: DataFrame, text: str, block: Block) -> Block:
    """``block`` with its seeds chosen by how often the documents hold each of its pairs."""

    def count(batches: Batches) -> Batches:
        total = np.zeros(len(block.grams), np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                np.add.at(total, block.held_grams(value), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["gram", "n"]
        )

    rows = map_batches(docs.select(F.col(text).alias("text")), count, "gram long, n long")
    frequency = np.zeros(len(block.grams), np.int64)
    for row in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most a block's pairs
        frequency[row["gram"]] = row["n"]
    block.choose_seeds(frequency)
    return block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, end_word): items found in documents.

    A row per document and item whose best alignment reaches half the score of a full
    copy; items of fewer than 8 words must be there in full. Clean documents have no row, nor have
    NULL or empty texts; repeated rows come out once each. Words are counted from 0.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    doc_kind = chosen.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema[item_id].dataType
    schema = (
        f"doc_id {doc_kind}, item_id {item_kind.simpleString()}, similarity double, "
        "first_word long, end_word long"
    )
    item_arrow = to_arrow_type(item_kind)
    path = None
    for block in blocks(benchmark, item_id, item_text):
        block = seeded(chosen, "text", block)

        def search(batches: Batches, block: Block = block) -> Batches:
            for batch in batches:
                rows, at = [], []
                for place, value in enumerate(batch.column(1).to_pylist()):
                    for match in block.matches(value):
                        rows.append(match)
                        at.append(place)
                item, similarity, first, end = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at, pa.int64())),
                        pa.array(item, item_arrow),
                        pa.array(similarity, pa.float64()),
                        pa.array(first, pa.int64()),
                        pa.array(end, pa.int64()),
                    ],
                    names=["doc_id", "item_id", "similarity", "first_word", "end_word"],
                )

        path = path or new_folder(docs.sparkSession, "benchmark-copies")
        map_batches(chosen, search, schema).write.mode("append").parquet(path)  # the block can go
    empty = docs.sparkSession.createDataFrame([], schema)
    return docs.sparkSession.read.schema(empty.schema).parquet(path) if path else empty


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents in which no benchmark item is found, all columns unchanged."""
    place = docs.columns.index(text)
    some = blocks(benchmark, item_id, item_text)
    block, more = next(some, None), next(some, None)
    if block is None:
        return docs
    if more is None:
        block = seeded(docs, text, block)

        def clean(batches: Batches) -> Batches:
            for batch in batches:
                texts = batch.column(place).to_pylist()
                kept = [next(block.matches(value), None) is None for value in texts]
                yield batch.filter(pa.array(kept, pa.bool_()))

        return map_batches(docs, clean, docs.schema)
    # the texts in which a block is found go by their digests, so no block is needed after its turn
    path = new_folder(docs.sparkSession, "benchmark-digests")
    chosen = docs.select(F.col(text).alias("text"))
    for part in chain([block, more], some):
        part = seeded(chosen, "text", part)

        def copies(batches: Batches, part: Block = part) -> Batches:
            for batch in batches:
                found = [next(part.matches(value), None) is not None for value in batch.column(0).to_pylist()]
                yield batch.filter(pa.array(found, pa.bool_()))

        digests = map_batches(chosen, copies, "text string").select(F.sha2("text", 256).alias("digest"))
        digests.distinct().write.mode("append").parquet(path)
    digests = docs.sparkSession.read.schema("digest string").parquet(path).distinct()
    return docs.join(digests, F.sha2(docs[text], 256) == digests["digest"], "left_anti")
