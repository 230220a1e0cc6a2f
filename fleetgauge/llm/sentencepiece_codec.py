"""SentencePiece encoding as a max-plus scan over chunks of a text, and decoding.

A segmentation is a path through the lattice of vocabulary pieces. Its state at
a place is the last piece and how far that piece reaches beyond the place; a
step adds the next piece's weight. For a unigram model the weight is the
piece's score. For a merge (BPE) model it is 0 if the two pieces stay apart when
the merges are run over them, else minus infinity: a sequence whose neighbours
all stay apart is the merges' own result. Either way the chunk of a long text
is a matrix from the states at its left boundary to those at its right, with
max as addition and plus as multiplication; matrices combine in any grouping,
and once the states at all boundaries are known each chunk is traced back alone.

No piece goes on past a blank mark that follows another character (checked when
the model is loaded), so between such places pieces are words of their own and
every word is solved once per task. The new words of a slice of texts are solved
side by side: each round takes one step of every word's path as columns. Where a
word is longer than a chunk, the matrices carry its states across.

Defined results: a null text has null ids; an empty one none. Decoding gives
the text back exactly, except that U+2581 becomes a blank. A character that the model
lacks becomes its bytes. Columns named like the result are replaced.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm.text import slices
from fleetgauge.session import stored

BLANK = "▁"
GIANT = 1 << 20
CHUNK = 1 << 16
WORDS_KEPT = 30_000
PAIRS_KEPT = 30_000
ORDINARY = 64  # characters of a word that is solved beside others and kept
TOGETHER = 1 << 12  # words solved side by side
FEW = 32  # words left over that are solved one by one
SLICE_BYTES = 1 << 19
SLICE_IDS = 1 << 20
PAIR_BITS = 20  # of the places for answers about pairs, as columns
NO_CHARACTER = 0x1FFFFF
WORD = re.compile(f"{BLANK}+[^{BLANK}]*")

State = tuple[int, int]  # characters beyond the boundary, id of the last piece


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """A place in a table of ``2 ** bits`` for each key."""
    spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(64 - bits)).astype(np.int64)


class Trie:
    """All beginnings of pieces, followed from many places at once.

    Nodes are numbered from 1, the root is 0 and -1 is none. An open table
    holds the node after each node and character.
    """

    def __init__(self, begins: dict[str, int]):
        node = {p: i for i, p in enumerate(begins, 1)}
        keys = np.array([node.get(p[:-1], 0) << 21 | ord(p[-1]) for p in begins], np.int64)
        # The id of the piece that a node is, else -1; the last stands for no node.
        self.piece = np.array([-1, *begins.values(), -1], np.int64)
        self.bits = (4 * len(keys) + 1).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.nodes = np.full(1 << self.bits, -1, np.int64)
        at, left = slots(keys, self.bits), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == -1]
            self.keys[at[free]] = keys[free]
            placed = self.keys[at[left]] == keys[left]
            self.nodes[at[left[placed]]] = left[placed] + 1
            left = left[~placed]
            at[left] = self.next(at[left])

    def next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def after(self, nodes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        keys = nodes << 21 | characters
        at = slots(keys, self.bits)
        held = self.keys[at]
        # An empty slot holds no node.
        found = self.nodes[at]
        left = np.flatnonzero((held != keys) & (held != -1))
        while len(left):
            at[left] = self.next(at[left])
            held = self.keys[at[left]]
            found[left] = self.nodes[at[left]]
            left = left[(held != keys[left]) & (held != -1)]
        return found


class Lattice:
    """Pieces of a model with their weights in a path."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], merges: bool, unknown: int = 0):
        self.pieces, self.byte_ids, self.merges, self.unknown = pieces, byte_ids, merges, unknown
        self.scores = {p: s for p, (_, s) in pieces.items()}
        self.names = {i: p for p, (i, _) in pieces.items()}
        most = max([*self.names, *byte_ids], default=-1) + 1
        self.name_of = [self.names.get(i, "") for i in range(most)]
        # A code is a piece's id, or ``most`` and the number of a character that is no piece.
        self.most, self.base = most, most + 0x110000
        self.length_of = list(map(len, self.name_of))
        self.is_byte = np.zeros(most, bool)
        self.is_byte[byte_ids] = True
        self.longest = max(map(len, pieces), default=1)
        self.worst = min((s for _, s in pieces.values()), default=0.0) - 10.0
        # Two generations each: a full one replaces the older, so what is in use stays.
        self.apart: dict[int, bool] = {}
        self.older_apart: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.histories: dict[str, tuple | None] = {}
        # Every beginning of a piece, and its id if it is one itself, else -1.
        self.begins = {p[:k]: -1 for p in pieces for k in range(1, len(p))}
        self.begins.update((p, i) for p, (i, _) in pieces.items())
        self.inner_blank = any(BLANK in p.lstrip(BLANK) for p in pieces)

    # Each is made when first asked for: encoding needs two of them, decoding one.

    @cached_property
    def trie(self) -> Trie:
        return Trie(self.begins)

    @cached_property
    def pairs(self) -> np.ndarray:
        """The last pair asked for at each place, twice, and 1 more if it stays apart."""
        return np.full(1 << PAIR_BITS, -1, np.int64)

    @cached_property
    def spelled(self) -> pa.Array:
        """What an id adds to a text: a piece's characters, blanks for marks, or a lone byte."""
        spelled = [p.replace(BLANK, " ").encode() for p in self.name_of]
        for b, i in enumerate(self.byte_ids):
            spelled[i] = bytes([b])
        return pa.array(spelled, pa.large_binary())

    @classmethod
    def load(cls, path: str) -> Lattice:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        usable = [
            i
            for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in usable}
        bytes_ = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        by_bytes = bytes_ if all(model.is_byte(i) for i in bytes_) else []
        merges = not any(s != round(s) for _, s in pieces.values())
        return cls(pieces, by_bytes, merges, model.unk_id())

    def ids(self, piece: str) -> list[int]:
        if piece in self.pieces:
            return [self.pieces[piece][0]]
        return [self.byte_ids[b] for b in piece.encode()] if self.byte_ids else [self.unknown]

    def merge(self, text: str) -> list[str]:
        """The merges run over a short text: best score first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            scored = [
                (self.pieces[a + b][1], -i)
                for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in self.pieces
            ]
            if not scored:
                break
            at = -max(scored)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def history(self, piece: str) -> tuple | None:
        """The merges of a piece alone: scores, and its first and last part before each and at the end.

        None if they don't end with the piece. The scores end with minus infinity.
        """
        if piece not in self.histories:
            scores, parts = self.scores, list(piece)
            steps, firsts, lasts = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                best, at = None, 0
                for i in range(len(parts) - 1):
                    score = scores.get(parts[i] + parts[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if best is None:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                steps.append(best)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            whole = (steps + [-math.inf], firsts, lasts) if len(parts) == 1 else None
            if piece not in self.pieces:  # of lone characters there is no end
                return whole
            self.histories[piece] = whole
        return self.histories[piece]

    def stays_apart(self, last: str, piece: str) -> bool:
        """Whether the merges over both texts give the two.

        Each side merges as it does alone, best score first and leftmost among
        equals, unless a merge across comes before the next of either.
        """
        right = self.history(piece)
        if right is None or not last:
            return right is not None
        left = self.history(last)
        if left is None:
            return False
        (ahead, _, lasts), (behind, firsts, _) = left, right
        get, i, j = self.scores.get, 0, 0
        while True:
            a, b = ahead[i], behind[j]
            across = get(lasts[i] + firsts[j])
            if across is not None and across > a and across >= b:
                return False
            if a == b == -math.inf:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def step(self, last: str, piece: str) -> float | None:
        """Weight of a piece after another; None if it can't follow."""
        if not self.merges:
            return self.pieces[piece][1] if piece in self.pieces else self.worst
        before = self.code(last) + 1 if last else 0
        return 0.0 if self.fits(before, self.code(piece)) else None

    def code(self, piece: str) -> int:
        return self.pieces[piece][0] if piece in self.pieces else self.most + ord(piece)

    def name(self, code: int) -> str:
        return self.name_of[code] if code < self.most else chr(code - self.most)

    def fits(self, before: int, code: int) -> bool:
        """Whether two pieces stay apart; pairs seen before are looked up.

        ``before`` is the first piece's code and 1, or 0 at the start.
        """
        pair = before * self.base + code
        found = self.apart.get(pair)
        if found is None:
            found = self.older_apart.get(pair)
            if found is None:
                found = self.stays_apart(self.name(before - 1) if before else "", self.name(code))
            if len(self.apart) >= PAIRS_KEPT:
                self.older_apart, self.apart = self.apart, {}
            self.apart[pair] = found
        return found

    def edges(self, text: str, at: int) -> Iterator[str]:
        """Pieces that may begin at a place; a lone character always may."""
        yield text[at : at + 1]
        for length in range(2, min(self.longest, len(text) - at) + 1):
            if text[at : at + length] in self.pieces:
                yield text[at : at + length]

    def run(self, text: str, end: int, start: int, last: str) -> tuple[list[dict], dict]:
        """Best paths from one state up to the first place at or after ``end``.

        Returns for each place the best (weight, from, previous piece) by last
        piece, and the states beyond the end. A unigram model needs no last piece.
        """
        table: list[dict[str, tuple[float, int, str]]] = [{} for _ in range(len(text) + 1)]
        table[start][last] = (0.0, -1, "")
        for at in range(start, end):
            if not table[at]:
                continue
            for piece in self.edges(text, at):
                reached = table[at + len(piece)]
                for before, (weight, _, _) in table[at].items():
                    more = self.step(before, piece)
                    if more is None:
                        continue
                    found = (weight + more, at, before)
                    key = piece
                    if not self.merges:
                        rivals = [k for k in reached]
                        if rivals and reached[rivals[0]][0] >= found[0]:
                            continue
                        reached.clear()
                    if key not in reached or found[0] > reached[key][0]:
                        reached[key] = found
        return table, {
            (at - end, piece): entry[0]
            for at in range(end, len(text) + 1)
            for piece, entry in table[at].items()
        }

    def trace(self, table: list[dict], at: int, last: str, start: int) -> list[str]:
        out = []
        while at > start:
            out.append(last)
            _, at, last = table[at][last]
        return out[::-1]

    def word(self, text: str) -> array:
        """Ids of a whole word; words seen before are looked up."""
        return array("i", self.packed(text))

    def packed(self, text: str) -> bytes:
        """Ids of a whole word as 32-bit integers."""
        found = self.words.get(text)
        if found is None:
            found = self.older_words.get(text)
            if found is None:
                found = array("i", self.solved(text)).tobytes()
            if len(text) <= ORDINARY:
                self.make_room()
                self.words[text] = found
        return found

    def make_room(self) -> None:
        if len(self.words) >= WORDS_KEPT:
            self.older_words, self.words = self.words, {}

    def packed_all(self, texts: set[str]) -> dict[str, bytes]:
        """Ids of these words, and of others; new ones of ordinary length are solved side by side."""
        self.make_room()
        missing = texts.difference(self.words)
        new = missing.difference(self.older_words)
        self.words.update((w, self.older_words[w]) for w in missing.difference(new))
        long = {w: self.packed(w) for w in new if len(w) > ORDINARY}
        some = list(new.difference(long))
        for start in range(0, len(some), TOGETHER):
            part = some[start : start + TOGETHER]
            self.words.update(zip(part, self.paths(part)))
        return self.words | long if long else self.words

    def solved(self, text: str) -> list[int]:
        if len(text) > CHUNK:
            return self.long_word(text)
        if self.merges:
            return self.by_ids(self.only_path(text))
        table, ends = self.run(text, len(text), 0, "")
        _, last = max(ends, key=lambda s: (ends[s], s))
        return [i for p in self.trace(table, len(text), last, 0) for i in self.ids(p)]

    def by_ids(self, codes: list[int]) -> list[int]:
        """Ids for codes; a character that is no piece becomes its bytes."""
        if max(codes) < self.most:
            return codes
        return [i for c in codes for i in ([c] if c < self.most else self.ids(chr(c - self.most)))]

    def only_path(self, text: str) -> list[int]:
        """Codes on the path of finite weight through a word of a merge model, longest pieces first.

        A path from the start that stays apart is the merges' result for the text so
        far, so at most one reaches each place: one that leads nowhere is not tried twice.
        """
        size, most, base, length = len(text), self.most, self.base, self.length_of
        begins, seen, fits = self.begins.get, self.apart.get, self.fits
        path, options, dead, at, before = [], [], set(), 0, 0
        while at < size:
            code = begins(text[at])
            if code is None:
                found = [most + ord(text[at])]
            else:
                found = [code if code >= 0 else most + ord(text[at])]
                for stop in range(at + 2, size + 1):
                    code = begins(text[at:stop])
                    if code is None:
                        break
                    if code >= 0:
                        found.append(code)
            while True:
                while not found:
                    dead.add(at)
                    found, last = options.pop(), path.pop()
                    at -= length[last] if last < most else 1
                    before = path[-1] + 1 if path else 0
                code = found.pop()
                to = at + (length[code] if code < most else 1)
                if to in dead:
                    continue
                apart = seen(before * base + code)
                if fits(before, code) if apart is None else apart:
                    break
            options.append(found)
            path.append(code)
            at, before = to, code + 1
        return path

    def options(self, characters: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces that may begin at each place; a lone character always may.

        Returns every option's code, its length and the next shorter option of
        its place (-1 if none), and the longest option of each place.
        """
        nodes = self.trie.after(np.zeros(len(places), np.int64), characters[places])
        pieces = self.trie.piece[nodes]
        codes = [np.where(pieces >= 0, pieces, self.most + characters[places])]
        lengths, shorter = [np.ones(len(places), np.int64)], [np.full(len(places), -1)]
        longest, known = np.full(len(characters), -1), len(places)
        longest[places] = np.arange(known)
        for length in range(2, self.longest + 1):
            places, nodes = places[nodes >= 0], nodes[nodes >= 0]
            nodes = self.trie.after(nodes, characters[places + length - 1])
            pieces = self.trie.piece[nodes]
            found = places[pieces >= 0]
            codes.append(pieces[pieces >= 0])
            lengths.append(np.full(len(found), length))
            shorter.append(longest[found])
            longest[found] = np.arange(known, known + len(found))
            known += len(found)
        return np.concatenate(codes), np.concatenate(lengths), np.concatenate(shorter), longest

    def fit_all(self, before: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """``fits`` for columns."""
        pairs = before * self.base + codes
        at = slots(pairs, PAIR_BITS)
        held = self.pairs[at]
        if len(new := np.flatnonzero(held >> 1 != pairs)):
            found = map(self.fits, before[new].tolist(), codes[new].tolist())
            held[new] = pairs[new] << 1 | np.fromiter(found, bool, len(new))
            self.pairs[at[new]] = held[new]
        return (held & 1).astype(bool)

    def paths(self, words: list[str]) -> list[bytes]:
        """Packed ids of many short words, for a merge model by ``only_path`` for all side by side.

        The words lie in one row of places, each with an end of its own. Each
        round tries the next option of every word that is not at its end.
        """
        if not self.merges:
            return [array("i", self.solved(w)).tobytes() for w in words]
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.r_[0, ends[:-1] + 1]
        characters = np.full(ends[-1] + 1, NO_CHARACTER)
        inside = np.ones(len(characters), bool)
        inside[ends] = False
        characters[inside] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        codes, lengths, shorter, longest = self.options(characters, np.flatnonzero(inside))

        # For each place: the code before it and 1, where that piece begins, the option taken.
        before, came, taken = (np.zeros(len(characters), np.int64) for _ in range(3))
        dead = np.zeros(len(characters), bool)
        came[starts] = -1
        number, at, option = np.arange(len(words)), starts, longest[starts]
        while len(at) > FEW:
            while len(stuck := np.flatnonzero(option < 0)):
                dead[at[stuck]] = True
                at[stuck] = came[at[stuck]]
                if at.min() < 0:
                    raise ValueError("a word has no path through the model's pieces")
                option[stuck] = shorter[taken[at[stuck]]]
            to = at + lengths[option]
            goes = ~dead[to]
            goes[goes] = self.fit_all(before[at[goes]], codes[option[goes]])
            taken[at[goes]] = option[goes]
            came[to[goes]] = at[goes]
            before[to[goes]] = codes[option[goes]] + 1
            option = np.where(goes, longest[to], shorter[option])
            at = np.where(goes, to, at)
            left = at < ends[number]
            number, at, option = number[left], at[left], option[left]

        done = np.ones(len(words), bool)
        done[number] = False
        passed = np.zeros(len(characters), bool)
        at, stops = starts[done], ends[done]
        while len(at):
            passed[at] = True
            at = at + lengths[taken[at]]
            at, stops = at[at < stops], stops[at < stops]
        path = codes[taken[passed]].astype(np.int32)
        cuts = np.r_[0, np.cumsum(passed)[ends]]
        packed, bounds = path.tobytes(), (4 * cuts).tolist()
        out = [packed[a:b] for a, b in zip(bounds, bounds[1:])]
        for i in np.unique(np.searchsorted(cuts, np.flatnonzero(path >= self.most), side="right") - 1).tolist():
            out[i] = array("i", self.by_ids(path[cuts[i] : cuts[i + 1]].tolist())).tobytes()
        for i in number.tolist():
            out[i] = array("i", self.solved(words[i])).tobytes()
        return out

    def transfer(self, text: str, end: int, states) -> dict:
        """Matrix of a chunk: for each state at its left the states at its right.

        ``text`` is the chunk with what a piece may need beyond its end.
        """
        out = {}
        for over, last in states:
            out[(over, last)] = (
                {(over - end, last): 0.0} if over >= end else self.run(text, end, over, last)[1]
            )
        return out

    def long_word(self, text: str, chunk: int = CHUNK) -> list[int]:
        """A word of many chunks: matrices, then states from left to right, then traces."""
        cuts = list(range(0, len(text), chunk)) + [len(text)]
        reach = self.longest
        matrices, states = [], [(0, "")]
        for a, b in zip(cuts, cuts[1:]):
            matrix = self.transfer(text[a : b + reach], b - a, states)
            matrices.append(matrix)
            states = sorted({s for row in matrix.values() for s in row})
        best = chain(matrices, (0, ""))
        out: list[str] = []
        for (a, b), (left, right) in zip(zip(cuts, cuts[1:]), zip(best, best[1:])):
            out += self.path(text[a : b + reach], b - a, left, right)
        return [i for p in out for i in self.ids(p)]

    def path(self, text: str, end: int, left, right) -> list[str]:
        """Pieces that begin in a chunk, between the states at its two boundaries."""
        if left[0] >= end:
            return []
        table, _ = self.run(text, end, left[0], left[1])
        return self.trace(table, end + right[0], right[1], left[0])


def combine(first: dict, second: dict) -> dict:
    """Max-plus product of two chunks' matrices."""
    out: dict = {}
    for left, row in first.items():
        sums: dict = {}
        for middle, weight in row.items():
            for right, more in second.get(middle, {}).items():
                if right not in sums or weight + more > sums[right]:
                    sums[right] = weight + more
        out[left] = sums
    return out


def chain(matrices: list[dict], start) -> list:
    """The best state at every boundary, from the matrices of all chunks."""
    ahead = [{}]
    finals = {s for row in matrices[-1].values() for s in row if s[0] == 0}
    ahead = [{s: 0.0 for s in finals}]
    for matrix in reversed(matrices):
        best = {}
        for left, row in matrix.items():
            sums = [w + ahead[0][r] for r, w in row.items() if r in ahead[0]]
            if sums:
                best[left] = max(sums)
        ahead.insert(0, best)
    states = [start]
    for matrix, after in zip(matrices, ahead[1:]):
        row = matrix[states[-1]]
        states.append(max((r for r in row if r in after), key=lambda r: (row[r] + after[r], r)))
    return states


def prepared(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


def words_of(text: str) -> list[str]:
    """Cut a prepared text before every blank mark that follows another character.

    A run of blanks stays with the word after it.
    """
    return WORD.findall(text)


_loaded: dict[str, Lattice] = {}


def lattice(path: str) -> Lattice:
    if path not in _loaded:
        _loaded[path] = Lattice.load(path)
    return _loaded[path]


def encode_words(model: Lattice, texts: Iterable[list[str] | None]) -> list[bytes | None]:
    """Packed ids of texts that are given as words; None stays None."""
    texts = list(texts)
    known = model.packed_all(set().union(*filter(None, texts)))
    return [None if t is None else b"".join(map(known.__getitem__, t)) for t in texts]


def words_within(model: Lattice, text: str | None) -> list[str] | None:
    if text is None or not model.inner_blank:
        return None if text is None else words_of(prepared(text))
    return [prepared(text)] if text else []


ENCODED = T.StructField("ids", T.ArrayType(T.IntegerType()))


def _ids_array(rows: list[bytes | None]) -> pa.Array:
    sizes = np.array([len(r) // 4 if r is not None else 0 for r in rows], np.int64)
    flat = np.frombuffer(b"".join(filter(None, rows)), np.int32)
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    mask = pa.array([r is None for r in rows]) if any(r is None for r in rows) else None
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=mask)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = lattice(path)
    for batch in batches:
        row = batch.column("row")
        texts = pa.RecordBatch.from_arrays([row, row.field("text")], names=["row", "text"])
        for part in slices(texts, "text", SLICE_BYTES):
            ids = encode_words(model, (words_within(model, t) for t in part.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([part.column("row"), _ids_array(ids)], names=["row", "ids"])


def _encode_parts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = lattice(path)
    for batch in batches:
        for part in slices(batch, "part", SLICE_BYTES):
            ids = encode_words(model, map(words_of, part.column("part").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column("uid"), part.column("at"), _ids_array(ids)], names=["uid", "at", "ids"]
            )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut giant texts into parts at blanks, where a chunk has one state only."""
    for batch in batches:
        for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist()):
            whole, start, number = prepared(text), 0, 0
            while start < len(whole):
                stop = len(whole)
                if start + CHUNK < stop:
                    at = whole.find(BLANK, start + CHUNK)
                    while 0 < at < len(whole) and whole[at - 1] == BLANK:
                        at = whole.find(BLANK, at + 1)
                    stop = at if at > 0 else stop
                yield pa.RecordBatch.from_pydict(
                    {"uid": [uid], "at": [number], "part": [whole[start:stop]]},
                    schema=pa.schema([("uid", pa.int64()), ("at", pa.int32()), ("part", pa.string())]),
                )
                start, number = stop, number + 1


def encode(docs: DataFrame, model_path: str, giant: int = GIANT) -> DataFrame:
    """Add the ids of each text. The model file must be at that path on every executor.

    Texts of over ``giant`` characters are cut into chunks that any task may
    take; the ids of each are put together in order. Others stay where they are.
    """
    kept = [c for c in docs.columns if c != "ids"]
    rows = docs.select(F.struct(*kept).alias("row"), "text")
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), ENCODED])
    long = F.coalesce(F.length("text") > giant, F.lit(False))
    short = rows.where(~long).select("row").mapInArrow(partial(_encode, path=model_path), schema)
    whole = rows.where(long)
    if whole.isEmpty():
        return short.select("row.*", "ids")
    giants = stored(whole.withColumn("uid", F.monotonically_increasing_id()), "giants")
    parts = giants.select("uid", "text").mapInArrow(_parts, "uid long, at int, part string")
    coded = parts.repartition("uid", "at").mapInArrow(
        partial(_encode_parts, path=model_path), "uid long, at int, ids array<int>"
    )
    joined = coded.groupBy("uid").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "ids"))), lambda x: x["ids"])).alias("ids")
    )
    return short.unionByName(giants.join(joined, "uid").select("row", "ids")).select("row.*", "ids")


def decode_ids(model: Lattice, ids: list[int]) -> str:
    """Text of a sequence of ids; bytes that form no character become U+FFFD."""
    if not len(ids) or not model.is_byte[ids].any():
        return "".join(map(model.name_of.__getitem__, ids)).replace(BLANK, " ")[1:]
    byte_of = {i: b for b, i in enumerate(model.byte_ids)}
    out, run = [], bytearray()
    for i in ids:
        if i in byte_of:
            run.append(byte_of[i])
            continue
        out.append(run.decode(errors="replace"))
        run.clear()
        out.append(model.names.get(i, ""))
    out.append(run.decode(errors="replace"))
    return "".join(out).replace(BLANK, " ")[1:] if ids else ""


def decode_lists(model: Lattice, lists: pa.ListArray) -> pa.Array:
    """``decode_ids`` for a column: what the ids add, one after the other, is cut where rows end.

    Rows go one by one if a byte may belong to no character.
    """
    ids = lists.flatten()
    if not len(ids):
        return pc.if_else(lists.is_valid(), pa.scalar("", pa.string()), pa.scalar(None, pa.string()))
    taken = model.spelled.take(ids)
    where = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(ids) + 1]
    rows = np.r_[0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy())]
    ends = pa.py_buffer(np.ascontiguousarray(where[rows]))
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, ends, taken.buffers()[2]])
    try:
        if model.byte_ids and (np.diff(where) == 0).any():
            raise pa.ArrowInvalid("an id without text parts the bytes beside it")
        texts = whole.cast(pa.large_string())
        if model.is_byte[ids.to_numpy()].any():  # bytes may spell a blank mark
            texts = pc.replace_substring(texts, BLANK, " ")
        texts = pc.utf8_slice_codeunits(texts, 1).cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([decode_ids(model, x or []) for x in lists.to_pylist()], pa.string())
    return pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = lattice(path)
    for batch in batches:
        row = batch.column("row")
        counts = np.r_[0, np.cumsum(pc.list_value_length(row.field("ids")).fill_null(0).to_numpy())]
        start = 0
        while start < len(row):
            stop = int(np.searchsorted(counts, counts[start] + SLICE_IDS, side="right")) - 1
            part = row.slice(start, max(stop, start + 1) - start)
            yield pa.RecordBatch.from_arrays([part, decode_lists(model, part.field("ids"))], names=["row", "decoded"])
            start += len(part)


def decode(coded: DataFrame, model_path: str) -> DataFrame:
    """Add the text of each row's ids, as ``decoded``."""
    kept = [c for c in coded.columns if c != "decoded"]
    rows = coded.select(F.struct(*kept).alias("row"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(partial(_decode, path=model_path), schema).select("row.*", "decoded")
