"""Token ids as the tokenizers library gives them, with each distinct pre-token encoded once.

A byte-level vocabulary splits a text into pre-tokens and encodes each by itself. Texts of plain characters are split here,
many at once, and the library's model encodes what a worker has not seen before; all other texts go to the library whole.
Which characters are plain is derived below; tests compare each of them with the library.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: Characters that are handled at once; a longer text is cut between two words. Each takes about 45 bytes meanwhile.
CHUNK = 500_000
#: Texts that are handled at once, however short.
TEXTS = 20_000
#: Bytes of pre-tokens with their ids that a Python worker remembers. Beyond them it starts anew.
REMEMBER = 96_000_000

#: Blocks of characters whose classes and lower case are the same in every version of Unicode in use.
_BLOCKS = ((0x21, 0x7E), (0xA1, 0x24F), (0x370, 0x3FF), (0x400, 0x4FF), (0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC),
           (0x3001, 0x3003), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))


def plain_characters() -> dict[str, list[str]]:
    """Letters (L), numbers (N) and other signs (O) that stay as they are under NFC and lower to one plain character."""
    found = {
        c: kind if (kind := unicodedata.category(c)[0]) in "LN" else "O"
        for a, b in _BLOCKS
        for c in map(chr, range(a, b + 1))
        if unicodedata.category(c) not in ("Cn", "Mn", "Me", "Zs") and unicodedata.is_normalized("NFC", c)
    }
    # The lower case of a capital sigma depends on what follows.
    plain = {c: k for c, k in found.items() if found.get(c.lower()) == k and c != "Σ"}
    return {kind: [c for c, k in plain.items() if k == kind] for kind in "LNO"}


def _set(points: Iterable[int]) -> str:
    """The inside of a bracketed set of code points."""
    runs: list[list[int]] = []
    for point in sorted(points):
        if runs and runs[-1][1] == point - 1:
            runs[-1][1] = point
        else:
            runs.append([point, point])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in runs)


#: Classes of characters: none (the end of a text), letter, number, other sign, blank, other white space.
_END, _L, _N, _O, _SPACE, _WHITE = range(6)
_SIZE = 1 << 16


def _classes() -> np.ndarray:
    """The class of each plain character by code point; ``_END`` for all that are not plain."""
    table = np.full(_SIZE, _END, np.uint8)
    for kind, number in (("L", _L), ("N", _N), ("O", _O)):
        table[[ord(c) for c in plain_characters()[kind]]] = number
    table[[9, 10, 11, 12, 13]], table[32] = _WHITE, _SPACE
    return table


#: The settings of a tokenizer file under which texts are split here.
_SPACED = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_LOWERING = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_BARE = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _way(settings: dict) -> str:
    """spaced: a pre-token may begin with a blank; bare: lower case, white space dropped; library: any other tokenizer."""
    normal, split = settings["normalizer"], settings["pre_tokenizer"] or {}
    if normal is None and split.items() >= _SPACED.items():
        return "spaced"
    parts = split.get("pretokenizers", [])
    if (normal or {}).get("normalizers") == _LOWERING and len(parts) == 2:
        if all(part.items() >= known.items() for part, known in zip(parts, (_BARE, _BYTES))):
            return "bare"
    return "library"


def _byte_signs() -> dict[int, int]:
    """How byte-level vocabularies write each byte: printable ones as themselves, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return dict(zip(own + rest, own + [256 + i for i in range(len(rest))]))


def starts_of(points: np.ndarray, kinds: np.ndarray, way: str) -> np.ndarray:
    """Where pre-tokens begin in plain texts, each of which ends with a sign of class ``_END``.

    Runs of one class are pre-tokens. With ``spaced`` a blank belongs to the run that follows it, and the white space before
    it is one by itself; with ``bare`` each number is one by itself. An apostrophe that begins a run takes a short ending of
    English with it.
    """
    before = np.concatenate(([np.uint8(_END)], kinds[:-1]))
    after = np.concatenate((kinds[1:], [np.uint8(_END)]))
    white = kinds >= _SPACE
    solid_before, solid_after = before < _SPACE, (after < _SPACE) & (after != _END)
    change = (kinds != before) & ~white
    if way == "spaced":
        start = change & (before != _SPACE) | white & (solid_before | solid_after)
    else:
        start = change | (kinds == _N) | white & solid_before
    for at in np.flatnonzero((points == 39) & start).tolist():
        for ending in _ENDINGS:
            end = at + 1 + len(ending)
            if points[at + 1 : end].tolist() == [ord(c) for c in ending]:
                start[at + 1 : end] = False
                start[end] |= kinds[end] == _L
                break
    return np.flatnonzero(start | (kinds == _END))


class HashClash(ArithmeticError):
    """Two pre-tokens have the same hash; their texts have to go to the library."""


class _Column:
    """Values that are only added to. Room grows by a quarter when it is full."""

    def __init__(self, dtype):
        self.room, self.size = np.empty(1024, dtype), 0

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]

    def add(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.room):
            room = np.empty(max(end, len(self.room) * 5 // 4), self.room.dtype)
            room[: self.size] = self.values
            self.room = room
        self.room[self.size : end] = more
        self.size = end


class _Known:
    """The pre-tokens that were encoded, by hash: their code points, which tell equal hashes apart, and their ids."""

    def __init__(self):
        self.hashes, self.slots = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.points, self.ids = _Column(np.uint32), _Column(np.uint32)
        self.point_starts, self.point_counts = _Column(np.int32), _Column(np.int32)
        self.id_starts, self.id_counts = _Column(np.int32), _Column(np.int32)

    def __len__(self) -> int:
        return len(self.hashes)

    @property
    def nbytes(self) -> int:
        return sum((held.room if isinstance(held, _Column) else held).nbytes for held in vars(self).values())

    def find(self, hashes: np.ndarray, points: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The slot of each pre-token, -1 for new ones. ``points``: those of all, one after the other."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        slots = np.where(self.hashes[at] == hashes, self.slots[at], -1)
        seen = slots >= 0
        own, size = slots[seen], counts[seen]
        if not (self.point_counts.values[own] == size).all() or not np.array_equal(
            self.points.values[_runs(self.point_starts.values[own], size)], points[np.repeat(seen, counts)]
        ):
            raise HashClash("two pre-tokens have the same hash")
        return slots

    def add(self, hashes: np.ndarray, points: np.ndarray, counts: np.ndarray, lists: list[list[int]]) -> np.ndarray:
        """Take in new pre-tokens, with ascending hashes; returns their slots."""
        slots = np.arange(len(self.hashes), len(self.hashes) + len(hashes), dtype=np.int32)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.slots = np.insert(self.hashes, at, hashes), np.insert(self.slots, at, slots)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter((i for ids in lists for i in ids), np.uint32, int(sizes.sum()))
        self.point_starts.add(np.cumsum(counts) - counts + self.points.size)
        self.point_counts.add(counts)
        self.points.add(points)
        self.id_starts.add(np.cumsum(sizes) - sizes + self.ids.size)
        self.id_counts.add(sizes)
        self.ids.add(ids)
        return slots


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of runs, one after the other."""
    ends = np.cumsum(counts, dtype=np.int64)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


@dataclass(frozen=True)
class Split:
    """Plain texts as pre-tokens: the distinct ones, by ascending hash, which of them stands at each place, and how many
    places each text has."""

    text: str
    starts: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray
    points: np.ndarray
    which: np.ndarray
    per_text: np.ndarray

    def strings(self, chosen: np.ndarray | slice = slice(None)) -> list[str]:
        return [self.text[a : a + n] for a, n in zip(self.starts[chosen].tolist(), self.counts[chosen].tolist())]


def _powers(n: int) -> np.ndarray:
    """The weights of ``n`` places, modulo 2^64; none comes twice."""
    made = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    made[:1] = 1
    return np.multiply.accumulate(made)


class Encoder:
    """Encodes texts with the tokenizer in a file, without begin, end or added special tokens. With ``special=False`` special
    strings inside texts are plain text."""

    def __init__(self, path: str, special: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.way = _way(settings)
        self.special = [t["content"] for t in settings["added_tokens"] if special]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.model = self.tokenizer.model
        self.classes = _classes()
        self.odd = re.compile(f"[^{_set(np.flatnonzero(self.classes).tolist())}]")
        self.signs = _byte_signs()
        rng = np.random.default_rng(7)
        self.by_sign = rng.integers(1, 2**63, _SIZE, dtype=np.uint64)
        self.by_place = _powers(1024)
        self.known, self.remember = _Known(), REMEMBER

    def is_plain(self, text: str) -> bool:
        return self.way != "library" and not self.odd.search(text) and not any(s in text for s in self.special)

    def split(self, texts: list[str]) -> Split:
        """Raises ``HashClash`` where hashes do not tell pre-tokens apart."""
        joined = "\0".join(texts) + "\0"
        if self.way == "bare":
            joined = joined.lower()
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kinds = self.classes[points]
        starts = starts_of(points, kinds, self.way)
        counts = np.diff(starts, append=len(points))
        own = kinds[starts]
        ends = np.flatnonzero(own == _END)
        real = own != _END if self.way == "spaced" else (own != _END) & (own < _SPACE)
        per_text = np.diff(np.concatenate(([0], np.cumsum(real)[ends])))
        places = np.arange(len(points)) - np.repeat(starts, counts)
        longest = int(counts.max())
        by_place = self.by_place if longest <= len(self.by_place) else _powers(longest)
        hashes = np.add.reduceat(self.by_sign[points] * by_place[places], starts) + counts.astype(np.uint64)
        distinct, first, which = np.unique(hashes[real], return_index=True, return_inverse=True)
        starts, counts = starts[real], counts[real]
        # Equal hashes have to mean equal pre-tokens.
        if not (counts[first][which] == counts).all() or not np.array_equal(
            points[_runs(starts, counts)], points[_runs(starts[first][which], counts)]
        ):
            raise HashClash("two pre-tokens have the same hash")
        starts, counts = starts[first], counts[first]
        return Split(joined, starts, counts, distinct, points[_runs(starts, counts)], which, per_text)

    def pretokens(self, text: str) -> list[str]:
        """The pre-tokens of a text that is not plain, special strings among them, for files that keep white space."""
        if self.way != "spaced":
            raise ValueError("pre-tokens have no text of their own here")
        parts = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if self.special else [text]
        found = []
        for part in parts:
            if part in self.special:
                found.append(part)
            elif part:
                found += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return found

    @cached_property
    def single(self) -> frozenset[str]:
        """The pre-tokens that are one id: entries of the vocabulary that the model does not take apart."""
        back = {chr(sign): byte for byte, sign in self.signs.items()}
        tokenize, found = self.model.tokenize, set()
        for entry in self.tokenizer.get_vocab(with_added_tokens=False):
            if all(c in back for c in entry) and len(tokenize(entry)) == 1:
                try:
                    found.add(bytes(back[c] for c in entry).decode("utf-8"))
                except UnicodeDecodeError:
                    continue
        return frozenset(found)

    def lengths_of(self, pieces: list[str]) -> list[int]:
        """The number of ids of each pre-token, or text."""
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _ids_of(self, pieces: list[str]) -> list[list[int]]:
        """The ids of pre-tokens. The model takes their bytes as signs; none holds the separator."""
        if not pieces:
            return []
        spelled = "\0".join(pieces).encode().decode("latin-1").translate(self.signs).split(chr(self.signs[0]))
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(piece)] for piece in spelled]

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        if self.known.nbytes > self.remember:
            self.known = _Known()
        known = self.known
        try:
            split = self.split(texts)
            slots = known.find(split.hashes, split.points, split.counts)
        except HashClash:
            return self._encode_whole(texts)
        new = slots < 0
        if new.any():
            lists = self._ids_of(split.strings(new))
            points = split.points[np.repeat(new, split.counts)]
            slots[new] = known.add(split.hashes[new], points, split.counts[new], lists)
        at = slots[split.which]
        counts = known.id_counts.values[at]
        ids = known.ids.values[_runs(known.id_starts.values[at], counts)]
        bounds = np.concatenate(([0], np.cumsum(counts)))[np.cumsum(split.per_text)]
        return np.split(ids, bounds[:-1])

    def _encode_whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; none of null."""
        for plain, group in chunks(self, texts):
            if not plain:
                yield from self._encode_whole(group)
            elif len(group) == 1:
                yield np.concatenate([ids for part in cut(group[0]) for ids in self._encode_plain([part])])
            else:
                yield from self._encode_plain(group)


def chunks(encoder: Encoder, texts: Iterable[str | None]) -> Iterator[tuple[bool, list[str]]]:
    """Neighbours that are all plain, or all not, together up to ``CHUNK`` characters and ``TEXTS`` texts; a longer text by itself."""
    group: list[str] = []
    size, kind = 0, True
    for text in texts:
        text = text or ""
        plain = encoder.is_plain(text)
        if group and (plain != kind or size + len(text) > CHUNK or len(group) == TEXTS):
            yield kind, group
            group, size = [], 0
        kind = plain
        group.append(text)
        size += len(text)
    if group:
        yield kind, group


_GAP = re.compile(r"[^\t-\r ] (?=[^\t-\r ])")


def cut(text: str, size: int = CHUNK) -> Iterator[str]:
    """A plain text in parts, cut before single blanks between two words, where every pre-token ends."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start() + 1]
        start = gap.start() + 1
    yield text[start:]


def encoder_for(path: str, remember: int | None = None) -> Encoder:
    """The encoder of a file that this Python worker already has, with what it remembers; workers outlive tasks. ``remember``:
    bytes of it, ``REMEMBER`` unless given."""
    kept = sys.modules.setdefault("tidemark_worker_encoders", types.ModuleType("tidemark_worker_encoders"))
    if path not in kept.__dict__:
        kept.__dict__.clear()
        kept.__dict__[path] = Encoder(path)
    kept.__dict__[path].remember = REMEMBER if remember is None else remember
    return kept.__dict__[path]
