"""Numbers of tokens by a sentencepiece BPE vocabulary, without making the tokens.

Whole-token shortcut: the driver proves, once for a vocabulary, which of its strings encode alone as one token. A text is
cut into pre-tokens, those are looked up, and only the rest is merged.

Cuts are proven from the vocabulary too. Spaces stand as U+2581, with one before the text. No merge crosses a place where
no entry goes on, so a text is cut before and after characters that occur in no entry of two or more, and, if no entry has
U+2581 after another character, before each run of it. A character that is no entry counts as its bytes.

A null text is empty, and empty gives 0 tokens. Strings of special tokens inside a text are ordinary text. Null ids, repeated
rows and ties keep a row each; an empty table gives none; only doc_id and text are read, so other columns do not matter. A text
of any length is counted whole: about a megabyte of pre-tokens is held at once, and a single pre-token takes about 60 bytes for each character.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.scoring import scored

SPACE = "▁"
SHORT = 40  # symbols up to which merges need no heap
_BITS = 22
_TIED = (1 << _BITS) - 1
_NONE = 1 << 62
_PLACE = 40  # bits of a heap entry that hold the place


class PieceCounter:
    """Vocabulary, merges and proven whole tokens; made on the driver from a file, sent to tasks as a broadcast."""

    def __init__(self, path: str, cached: int = 100_000, part: int = 1 << 20):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [
            i for i in range(library.get_piece_size())
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        if any(library.is_unused(i) for i in usual):
            raise ValueError(f"{path}: unused entries are not supported")
        scores = {library.id_to_piece(i): library.get_score(i) for i in usual}
        self.cached, self.part = cached, part
        self._learn(scores)
        self._prove(library, list(scores))

    def _learn(self, scores: dict[str, float]) -> None:
        longer = [p for p in scores if len(p) > 1]
        self.joining = {c for p in longer for c in p}
        self.single = {p for p in scores if len(p) == 1}
        # A character of a longer entry can be merged even if it is no entry itself.
        self.number = {s: i for i, s in enumerate([*scores, *sorted(self.joining - self.single)])}
        self.tokens = [1 if s in scores else len(s.encode()) for s in self.number]
        if len(self.number) >= _TIED:
            raise ValueError(f"more than {_TIED} entries")
        # Entries of equal score are merged from the left, so they share a rank; what they make is kept apart.
        rank = {score: r for r, score in enumerate(sorted(set(scores.values()), reverse=True))}
        several = Counter(scores[p] for p in longer)
        self.merges: dict[int, int] = {}
        self.tied: dict[tuple[int, int], int] = {}
        for piece in longer:
            for k in range(1, len(piece)):
                left, right = self.number.get(piece[:k]), self.number.get(piece[k:])
                if left is not None and right is not None:
                    made = self.number[piece]
                    if several[scores[piece]] > 1:
                        self.tied[left, right], made = made, _TIED
                    self.merges[left << _BITS | right] = rank[scores[piece]] << _BITS | made
        self.spaced = all(SPACE not in p.lstrip(SPACE) for p in longer)
        self.whole: dict[str, int] = {}
        self._start()

    def _start(self) -> None:
        inner = "".join(map(re.escape, sorted(self.joining - {SPACE})))
        outer = "".join(map(re.escape, sorted(self.joining | {SPACE})))
        words = f"{SPACE}*[{inner}]+|{SPACE}+" if self.spaced else f"[{outer}]+"
        self._find = re.compile(f"{words}|[^{outer}]+").findall
        self._space = re.compile(f"(?<=[^{SPACE}]){SPACE}")
        self.known, self.old = dict(self.whole), {}

    def _prove(self, library, entries: list[str]) -> None:
        """List the entries that encode alone as one token, after comparing all with the library."""
        alone = [p for p in entries if not p.startswith(SPACE)]
        texts = [*(p.replace(SPACE, " ") for p in entries), *alone, "", " ", "a  b ", "Ⅰ ﬁ 　x\n\t​", "\x00<s>"]
        for text, made in zip(texts, library.encode(texts, num_threads=1), strict=True):
            if self.count(text) != len(made):
                raise ValueError(f"the vocabulary is not one of plain BPE with bytes: {text!r}")
        self.whole = {p: 1 for p in entries if self._find(p) == [p] and self.merged(p) == 1}
        self.known = dict(self.whole)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "old", "_find", "_space")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def merged(self, piece: str) -> int:
        """The tokens of a pre-token, by merging the best pair, the leftmost first, until none is left."""
        if piece[0] not in self.joining and piece[0] != SPACE:
            return sum(1 if c in self.single else len(c.encode()) for c in piece)
        number = self.number
        ids = [number[c] for c in piece]
        return (self._merged_short if len(ids) <= SHORT else self._merged_long)(ids)

    def _merged_short(self, ids: list[int]) -> int:
        """The best of all pairs is looked up anew for each merge, which few symbols do sooner than a heap."""
        merge = self.merges.get
        pairs = [merge(left << _BITS | right, _NONE) for left, right in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) < _NONE:
            i = pairs.index(best)
            made = best & _TIED
            if made == _TIED:
                made = self.tied[ids[i], ids[i + 1]]
            ids[i:i + 2] = (made,)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = merge(made << _BITS | ids[i + 1], _NONE)
            if i:
                pairs[i - 1] = merge(ids[i - 1] << _BITS | made, _NONE)
        return sum(map(self.tokens.__getitem__, ids))

    def _merged_long(self, symbols: list[int]) -> int:
        """A heap of ranks and places over a linked list; what has been merged since is skipped."""
        merge, ids = self.merges.get, array("i", symbols)
        n = len(ids)
        before, after = array("i", range(-1, n - 1)), array("i", [*range(1, n), -1])
        heap = []
        for i in range(n - 1):
            if (found := merge(ids[i] << _BITS | ids[i + 1], _NONE)) < _NONE:
                heap.append(found >> _BITS << _PLACE | i)
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            i = top & (1 << _PLACE) - 1
            j = after[i]
            if ids[i] < 0 or j < 0:
                continue
            found = merge(ids[i] << _BITS | ids[j], _NONE)
            if found >> _BITS != top >> _PLACE:
                continue  # stale
            made = found & _TIED
            ids[i], ids[j] = self.tied[ids[i], ids[j]] if made == _TIED else made, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (found := merge(ids[i] << _BITS | ids[k], _NONE)) < _NONE:
                    heapq.heappush(heap, found >> _BITS << _PLACE | i)
            h = before[i]
            if h >= 0 and (found := merge(ids[h] << _BITS | ids[i], _NONE)) < _NONE:
                heapq.heappush(heap, found >> _BITS << _PLACE | h)
        return sum(self.tokens[i] for i in ids if i >= 0)

    def _parts(self, text: str) -> Iterator[str]:
        """A long text in parts, cut before spaces where no merge crosses."""
        at = 0
        while self.spaced and len(text) - at > self.part:
            cut = self._space.search(text, at + self.part)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def count(self, text: str) -> int:
        total = 0
        if not text:
            return total
        for part in self._parts(SPACE + text.replace(" ", SPACE)):
            pieces = self._find(part)
            found = list(map(self.known.get, pieces))
            if None in found:
                if len(self.known) > len(self.whole) + self.cached:  # what is still in use moves from the old to the new
                    self.old, self.known = self.known, dict(self.whole)
                for i, ready in enumerate(found):
                    if ready is None:
                        piece = pieces[i]
                        found[i] = ready = self.known.get(piece) or self.old.get(piece) or self.merged(piece)
                        if len(piece) <= 64:
                            self.known[piece] = ready
            total += sum(found)
        return total


def judge(model: PieceCounter, texts: list[bytes]) -> list[pa.Array]:
    counts = [model.count(t.decode("utf-8", "replace")) for t in texts]
    return [pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64())]


def token_counts(documents: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether they are more than ``limit``."""
    counts = scored(documents, PieceCounter(path), judge, "n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
