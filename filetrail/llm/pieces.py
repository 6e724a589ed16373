"""SentencePiece encoding and decoding for models with merged pieces.

Encoding is exact and keeps no queue of merges: an Aho-Corasick automaton gives the
longest piece at each position; a piece may follow another only if re-merging both
leaves the border between them; where no piece can go on, the position is marked in a
bit field and the search goes back one piece. Runs of characters between borders that no
piece crosses are independent, so each is encoded once and kept in a bounded cache.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetrail.llm.store import hold, put, ship

SPACE = "▁"
CACHE = 600_000
ROWS = 500

_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")


class _Cache(dict):
    """Ids of texts, found when they are first asked for.

    Half of the entries are a younger generation; when it is full the older one goes, so
    frequent texts stay. Long texts aren't kept.
    """

    def __init__(self, find: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.find, self.old = find, {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        ids = self.old.get(text)
        if ids is None:
            ids = self.find(text)
        if len(text) <= 64:
            if len(self) >= CACHE // 2:
                self.old = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Pieces:
    """A SentencePiece model with merged pieces, byte pieces and unchanged texts."""

    def __init__(self, model_file: str):
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.end = sp.eos_id()
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {self.end, sp.bos_id(), sp.unk_id(), sp.pad_id(), *self.byte_id}
        self.id_of = {
            sp.id_to_piece(i): i for i in range(sp.get_piece_size())
            if i not in special and not sp.is_control(i) and not sp.is_unused(i)
        }
        merged = [p for p in self.id_of if len(p) > 1]
        self.score = {p: sp.get_score(self.id_of[p]) for p in merged}
        merged.sort(key=lambda p: -self.score[p])
        self._check(merged)
        #: Order in which pieces merge; single characters come first.
        self.rank = {p: 0 for p in self.id_of if len(p) == 1}
        self.rank |= {p: i for i, p in enumerate(merged, 1)}
        #: Neighbouring characters inside pieces; a text may be cut between any others.
        self.inside = {p[i:i + 2] for p in merged for i in range(len(p) - 1)}
        #: The two parts of each piece that merging its own characters makes.
        self.halves = {}
        for p in merged:
            made, last = self.merge(p)
            if len(made) == 1 and p.strip(SPACE):
                self.halves[p] = last
        usable = {p for p in self.id_of if len(p) == 1} | set(self.halves)
        #: The next shorter piece that starts in the same way.
        self.shorter = {
            p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in usable), None) for p in usable
        }
        # Of reversed pieces over reversed text: what ends at a place there starts at it here.
        self.automaton = ahocorasick.Automaton()
        for p in usable:
            self.automaton.add_word(p[::-1], p)
        self.automaton.make_automaton()
        self.fits: dict[tuple[str, str], bool] = {}
        self.runs = _Cache(self._run)
        #: By words that follow a single space.
        self.words = _Cache(lambda word: self.word(SPACE + word))

    def _check(self, merged: list[str]) -> None:
        sp = self.model
        ties = {p for a, b in pairwise(merged) if self.score[a] == self.score[b] for p in (a, b)}
        if (
            sp.unk_id() in self.byte_id
            or any(p.strip(SPACE) for p in ties)
            or any(re.search(f"[^{SPACE}]{SPACE}", p) for p in merged)
            or any(c not in self.id_of for p in merged for c in p)
            or sp.decode(sp.encode(" \t Ａé \n ")) != " \t Ａé \n "
            or sp.encode("a", out_type=str) != [SPACE + "a"]
        ):
            raise ValueError("not a model of merged words with byte pieces and unchanged texts")

    def merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Parts after all merges, best score first and leftmost; and the last merged pair."""
        part: list[str | None] = list(text)
        after = list(range(1, len(part) + 1))
        before = list(range(-1, len(part) - 1))
        queue: list[tuple[float, int, str, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(part):
                s = self.score.get(part[i] + part[j])
                if s is not None:
                    heapq.heappush(queue, (-s, i, part[i], part[j]))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        last = None
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if part[i] != a or j >= len(part) or part[j] != b:
                continue
            last = (a, b)
            part[i], part[j] = a + b, None
            after[i] = k = after[j]
            if k < len(part):
                before[k] = i
            offer(before[i], i)
            offer(i, k)
        return [p for p in part if p is not None], last

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging both texts as one leaves the border between them.

        Both are taken apart again from the merge made last to the first; at no time may
        the two parts at the border make a piece that would have been merged sooner.
        """
        key = (left, right)
        fits = self.fits.get(key)
        if fits is not None:
            return fits
        rank, limit, fits = self.rank, len(self.rank) + 1, True
        while True:
            both = rank.get(left + right)
            if both is not None and both < limit:
                fits = False
                break
            if len(left) == 1 and len(right) == 1:
                break
            # Of the same piece on both sides the left one was made first.
            if len(right) == 1 or (len(left) > 1 and rank[left] > rank[right]):
                limit = rank[left]
                left = self.halves[left][1]
            else:
                limit = rank[right] + 1
                right = self.halves[right][0]
        if len(self.fits) >= CACHE:
            self.fits.clear()
        self.fits[key] = fits
        return fits

    def search(self, text: str) -> list[str]:
        """Pieces of a text of known characters without inner runs of spaces.

        Places in ``longest`` count from the end of the text.
        """
        n = len(text)
        # At each place the automaton reports the longest piece first, so it is set last.
        longest = dict([*self.automaton.iter(text[::-1])][::-1])
        open_ = bytearray(b"\xff" * (n // 8 + 1))  # a cleared bit: no piece can go on here
        found: list[str] = []
        at, piece = 0, longest[n - 1]
        while True:
            end = at + len(piece)
            if open_[end >> 3] >> (end & 7) & 1 and (not found or self.compatible(found[-1], piece)):
                found.append(piece)
                if end == n:
                    return found
                at, piece = end, longest[n - 1 - end]
                continue
            shorter = self.shorter[piece]
            while shorter is None:
                # Nothing fits here: mark the place and try less of the piece before it.
                open_[at >> 3] &= ~(1 << (at & 7)) & 0xFF
                piece = found.pop()
                at -= len(piece)
                shorter = self.shorter[piece]
            piece = shorter

    def _run(self, run: str) -> tuple[int, ...]:
        """Ids of characters between two cuts."""
        if len(run) == 1 and run in self.id_of:
            return (self.id_of[run],)
        if run[0] not in self.id_of:
            return tuple(self.byte_id[b] for b in run.encode())
        if run.startswith(SPACE * 2):
            # Runs of spaces tie in score, so the order of their merges counts.
            return tuple(self.id_of[p] for p in self.merge(run)[0])
        return tuple(self.id_of[p] for p in self.search(run))

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of the spaces before a word and the word, up to the next space."""
        inside = self.inside
        cuts = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in inside]
        return tuple(chain.from_iterable(
            self.runs[word[a:b]] for a, b in pairwise((0, *cuts, len(word)))
        ))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, without an end id."""
        if not text:
            return []
        if text[0] == " " or "  " in text or SPACE in text:
            words = _SEGMENT.findall(SPACE + text.replace(" ", SPACE))
            return [*chain.from_iterable(map(self.word, words))]
        # Each word has one space before it; all the work on known words is done in C.
        return [*chain.from_iterable(map(self.words.__getitem__, text.split(" ")))]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


def load(model_file: str) -> Pieces:
    """The model, kept by the worker process until another operator's tasks begin."""
    return hold(("pieces", model_file), lambda: Pieces(model_file))


def _encode(batches: Iterator[pa.RecordBatch], model_file: str, names: list[str]):
    model = load(model_file)
    for whole in batches:
        for at in range(0, max(1, whole.num_rows), ROWS):
            batch = whole.slice(at, ROWS)
            ids = [[*model.encode(t), model.end] for t in batch.column("__text").to_pylist()]
            decoded = [model.decode(x) for x in ids]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])
            columns = [batch.column(c) for c in names]
            columns += [pa.ListArray.from_arrays(ends, flat), pa.array(decoded, pa.string())]
            yield pa.record_batch(columns, names=[*names, "ids", "decoded"])


def encode_decode(docs: DataFrame, model_file: str, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``ids``, ending with the end id, and the text ``decoded`` from them.

    The ids are those the sentencepiece library gives without sampling and without a
    start id. A null or empty text has the end id alone and decodes to the empty text.
    Texts of any length are encoded whole. Other columns pass through, the text only with
    ``keep_text``; columns named like the new ones are replaced. ``model_file`` must exist
    on every executor.
    """
    ship(docs.sparkSession)
    new = {"ids", "decoded", *(() if keep_text else ("text",))}
    names = [c for c in docs.columns if c.lower() not in new]
    given = docs.select(*(F.col(f"`{c}`") for c in names), F.col("text").alias("__text"))
    fields = put(given.drop("__text"), "ids array<int>, decoded string")
    return given.mapInArrow(lambda it: _encode(it, model_file, names), fields)
