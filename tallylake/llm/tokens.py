"""Exact token counts at every prefix of a text, by dynamic programming over byte-level BPE.

A token sequence is what BPE makes of its text exactly when each neighbouring pair
is what BPE makes of that pair. So the last token of a prefix is the one
vocabulary entry that ends the prefix and fits the last token of the prefix before
it, and ``count[end] = count[end - len(token)] + 1``. The tables are made per
piece (the tokenizer first cuts a text into pieces that merges never cross) and
answer length, truncation and budget questions without encoding a text again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.tables import map_batches

PIECES_REMEMBERED = 1 << 19  # entries of each memory; together below 300 MB
LONGEST_REMEMBERED = 64  # bytes; longer pieces are counted each time they occur

# The published pattern that cuts a text into pieces.
PIECE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file, by its published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in set(plain))
    return symbols | {chr(256 + k): b for k, b in enumerate(others)}


class PrefixCounter:
    """Token counts of one byte-level BPE vocabulary file (``tokenizers`` JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte_of = _byte_symbols()
        as_bytes = lambda text: bytes(byte_of[c] for c in text)
        model = content["model"]
        self.vocabulary = {as_bytes(t) for t in model["vocab"]}
        self.merge_rank = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merge_rank[as_bytes(left), as_bytes(right)] = rank
        self.endings = {token[k:] for token in self.vocabulary for k in range(len(token))}
        self.pieces = regex.compile(PIECE)
        self.space = regex.compile(r"\p{White_Space}")
        self.special = [t["content"] for t in content["added_tokens"] if t["special"]]
        self.at_special = (
            regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        )
        self.pair_fits: dict[tuple[bytes, bytes], bool] = {}
        self.prefixes: dict[bytes, tuple[int, bytes]] = {}
        self.known: dict[str, int] = {}

    def _encode(self, text: bytes) -> list[bytes]:
        """Plain BPE of a short text: merge the lowest-ranked pair, leftmost first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.merge_rank.get(p, len(self.merge_rank)) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == len(self.merge_rank):
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _fits(self, left: bytes, right: bytes) -> bool:
        pair = (left, right)
        known = self.pair_fits.get(pair)
        if known is None:
            if len(self.pair_fits) >= PIECES_REMEMBERED:
                self.pair_fits.clear()
            whole = [left, right] if left else [right]
            known = self.pair_fits[pair] = self._encode(left + right) == whole
        return known

    def piece_table(self, piece: bytes) -> list[int]:
        """Tokens of every byte prefix of one piece; entry 0 is 0."""
        counts, last = [0], [b""]
        for end in range(1, len(piece) + 1):
            for start in range(end - 1, -1, -1):
                token = piece[start:end]
                if token not in self.endings:
                    raise ValueError(f"no token ends {piece[:end]!r}")
                if token in self.vocabulary and self._fits(last[start], token):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts

    def _prefix(self, prefix: bytes) -> tuple[int, bytes]:
        """(count, last token) of one prefix, from the few shorter ones it depends on."""
        known = self.prefixes.get(prefix)
        if known is not None:
            return known
        starts = []
        for start in range(len(prefix) - 1, -1, -1):
            token = prefix[start:]
            if token not in self.endings:
                break
            if token in self.vocabulary:
                starts.append(start)
        for start in reversed(starts):  # only one fits; long tokens are the likely ones
            count, last = self._prefix(prefix[:start]) if start else (0, b"")
            if self._fits(last, prefix[start:]):
                if len(self.prefixes) >= PIECES_REMEMBERED:
                    self.prefixes.clear()
                known = self.prefixes[prefix] = (count + 1, prefix[start:])
                return known
        raise ValueError(f"no token ends {prefix!r}")

    def _piece_count(self, piece: str) -> int:
        data = piece.encode()
        if len(data) > LONGEST_REMEMBERED:
            return self.piece_table(data)[-1]
        if len(self.known) >= PIECES_REMEMBERED:
            self.known.clear()
        count = self.known[piece] = self._prefix(data)[0]
        return count

    def _segments(self, text: str) -> list[str]:
        """Ordinary texts between special strings; each gap between two is one special token."""
        return self.at_special.split(text) if self.at_special else [text]

    def _ordinary(self, text: str) -> int:
        known, total = self.known, 0
        for piece in self.pieces.findall(text):
            count = known.get(piece)
            total += self._piece_count(piece) if count is None else count
        return total

    def count(self, text: str) -> int:
        """Tokens of a text, each special string in it being one."""
        segments = self._segments(text)
        return sum(map(self._ordinary, segments)) + len(segments) - 1

    def prefix_counts(self, text: str) -> list[int]:
        """``count(text[:p])`` for every p from 0 to the length of the text."""
        counts, base, at = [0], 0, 0
        segments = self._segments(text)
        for number, segment in enumerate(segments):
            counts += [base + c for c in self._segment_prefixes(segment)]
            at += len(segment)
            if number + 1 < len(segments):
                mark = self.at_special.match(text, at).group()
                # an unfinished special string is ordinary text behind the segment
                counts += [base + self._ordinary(segment + mark[:k]) for k in range(1, len(mark))]
                base += self._ordinary(segment) + 1
                counts.append(base)
                at += len(mark)
        return counts

    def _segment_prefixes(self, segment: str) -> list[int]:
        counts, before, run, run_base = [], 0, "", 0
        for piece in self.pieces.findall(segment):
            table = self.piece_table(piece.encode())
            size = 0
            for k, character in enumerate(piece, 1):
                size += len(character.encode())
                if self.space.match(character) and (k == 1 or run):
                    # space at the end of a prefix is one piece with the space before it
                    if not run:
                        run_base = before
                    run += character
                    counts.append(run_base + self._piece_count(run))
                elif piece[0] == "'" and len(piece) == 3 and k == 2:
                    counts.append(before + self._ordinary(piece[:2]))
                    run = ""
                else:
                    counts.append(before + table[size])
                    run = ""
            before += table[-1]
        return counts

    def cut(self, text: str, limit: int) -> int:
        """Code points in the longest prefix of at most ``limit`` tokens.

        A prefix that ends behind the start of a piece, with no space before that start, has
        at least the tokens of the pieces before it. So only the pieces between the last such
        start within the limit and the first one beyond it need their tables.
        """
        low = low_tokens = total = at = 0
        segments = self._segments(text)
        for number, segment in enumerate(segments):
            for piece in self.pieces.finditer(segment):
                start = at + piece.start()
                if start == at or not self.space.match(text[start - 1]):
                    if total > limit:
                        return low + self._last_within(text[low:start], limit - low_tokens)
                    low, low_tokens = start, total
                total += self._ordinary(piece.group())
            at += len(segment)
            if number + 1 < len(segments):
                at += len(self.at_special.match(text, at).group())
                total += 1
        return low + self._last_within(text[low:], limit - low_tokens)

    def _last_within(self, text: str, limit: int) -> int:
        return max(p for p, c in enumerate(self.prefix_counts(text)) if c <= limit)


@lru_cache(maxsize=2)
def counter(path: str | None = None) -> PrefixCounter:
    """The counter of a vocabulary file, made once per worker process."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 512,
    path: str | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fits_chars) of every whole text.

    ``fits_chars`` is the length in code points of the longest prefix within ``limit``
    tokens. Empty and NULL texts have no tokens; rows are independent, so ties and
    repeated rows come out once each, and columns other than the two named are ignored.
    ``path`` must name a file every executor can open; by default the installed one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in batches:
            tokens, fits = [], []
            for value in batch.column(1).to_pylist():
                value = value or ""
                n = counts.count(value)
                tokens.append(n)
                fits.append(len(value) if n <= limit else counts.cut(value, limit))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                    pa.array(fits, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars"],
            )

    chosen = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return map_batches(
        chosen,
        count,
        f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fits_chars long",
    )
