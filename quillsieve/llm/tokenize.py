"""Word-cached BPE with the ids of a ``tokenizers`` file.

The tokenizer file splits at white space before it applies its merges, so a
text's ids are those of its white-space-separated words in order.  Each Python
worker keeps a bounded table word -> ids; the words a batch brings anew are
merged as numpy matrices, a block of words of about one length each.  Words with
special-token strings, very long words and files of any other make go through
the ``tokenizers`` library itself.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cached_property
from itertools import chain, compress, repeat

import numpy as np
import regex

PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed: the file's own split pattern
LONGEST = 48
CACHED_WORDS = 400_000
BLOCK = 4096  # pieces that are merged together
_NONE = np.int32(2**31 - 1)
_PAST = 2**16 - 1  # stands before a piece's first and after its last id; no vocabulary has it


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBPE:
    """Encodes texts (UTF-8 bytes) to ids, exactly as the tokenizer file does."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        self.path, self.cached_words = path, cached_words
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"].encode() for t in spec["added_tokens"]]
        model, split = spec["model"], spec["pre_tokenizer"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        self.fast = (
            model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and kinds == ["NFC", "Replace", "Lowercase"]
            and split["pretokenizers"][0].get("pattern", {}).get("Regex") == PIECES and not model.get("dropout")
            and len(model["vocab"]) <= _PAST
        )
        if not self.fast:
            raise ValueError("this file does not split at white space or has too many ids; its texts cannot be encoded word by word")
        vocab, letters = model["vocab"], _byte_letters()
        self.middle = np.array([vocab[c] for c in letters], np.uint32)
        self.last = np.array([vocab[c + "</w>"] for c in letters], np.uint32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.uint32) for k in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        self.key = (left << 16) | right
        self.slots, self.second = self._tables(self.key)
        self.pattern = regex.compile(PIECES)
        self._clear()

    @cached_property
    def whole(self):
        """The library's own encoder, for words that need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.start = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.int32)
        self.used = 0

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key * np.uint32(0x9E3779B1)) >> np.uint32(12)

    def _tables(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash table key -> rank; the keys whose slot was taken, sorted, with their ranks."""
        slots = np.full(1 << 20, -1, np.int32)
        slot = self._slot(key)
        slots[slot[::-1]] = np.arange(len(key), dtype=np.int32)[::-1]
        lost = np.flatnonzero(slots[slot] != np.arange(len(key)))
        lost = lost[np.argsort(key[lost])]
        return slots, lost

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 16) | b
        rank = self.slots[self._slot(key)]
        hit = (self.key[rank] == key) & (rank >= 0)
        out = np.where(hit, rank, _NONE)
        if len(self.second):
            lost_keys = self.key[self.second]
            miss = np.flatnonzero(~hit.ravel() & (rank.ravel() >= 0))
            if len(miss):
                k = key.ravel()[miss]
                p = np.minimum(np.searchsorted(lost_keys, k), len(lost_keys) - 1)
                found = lost_keys[p] == k
                out.ravel()[miss[found]] = self.second[p[found]]
        return out

    def _merge(self, grid: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges columns of ``sizes`` letters each; the numbers of ids left, and the ids column by column.

        Ids stay in their rows and know the rows before and after them; the
        grid's last row is past every column's end. ``order`` holds rank and row
        of each pair by its left id, so a column's least is its next merge.
        """
        past, n = len(grid) - 1, grid.shape[1]
        row = np.arange(past + 1)[:, None]
        after = np.where(row + 1 < sizes, row + 1, past).ravel()
        before = np.repeat(np.where(row, row - 1, past), n)
        order = np.full(grid.shape, _NONE)
        ranks = self._ranks(grid[:-1], grid[1:])
        np.copyto(order[:-1], ranks << 6 | row[:-1].astype(np.int32), where=ranks < _NONE)
        gone = np.arange(past + 1)[:, None] >= sizes
        flat, dead, least = grid.ravel(), gone.ravel(), order.ravel()  # views
        while past > 1:
            best = order.min(0)
            column = np.flatnonzero(best < _NONE)
            if not len(column):
                break
            best = best[column]
            here = (best & 63) * n + column
            right = after[here] * n + column
            merged = self.made[best >> 6]
            flat[here], least[right], dead[right] = merged, _NONE, True
            beyond, left = after[right], before[here]
            after[here] = beyond
            beyond, ahead = beyond * n + column, left * n + column
            before[beyond] = best & 63
            ranks = self._ranks(np.concatenate([merged, flat[ahead]]), np.concatenate([flat[beyond], merged]))
            rows = np.concatenate([best & 63, left.astype(np.int32)])
            least[np.concatenate([here, ahead])] = np.where(ranks < _NONE, ranks << 6 | rows, _NONE)
        kept = ~gone.T
        return kept.sum(1), grid.T[kept]

    def pieces_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces that need no further splitting (lower-case UTF-8): where each one's begin, how many they are, all ids."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum(sizes) - sizes
        by_size = np.argsort(sizes, kind="stable")
        short = int(np.searchsorted(sizes[by_size], LONGEST, "right"))
        begin, count, found, total = np.empty_like(sizes), np.empty_like(sizes), [], 0

        def put(which: np.ndarray, own: np.ndarray, ids: np.ndarray) -> None:
            nonlocal total
            begin[which], count[which] = total + np.cumsum(own) - own, own
            found.append(ids)
            total += len(ids)

        for at in range(0, short, BLOCK):
            which = by_size[at : min(at + BLOCK, short)]
            size = sizes[which]
            row = np.arange(int(size[-1]) + 1)[:, None]
            grid = self.middle[data[np.minimum(starts[which] + row, len(data) - 1)]]
            grid[row >= size] = _PAST
            grid[size - 1, np.arange(len(which))] = self.last[data[starts[which] + size - 1]]
            put(which, *self._merge(grid, size))
        letters = _byte_letters()
        for i in by_size[short:].tolist():
            ids = np.array([t.id for t in self.whole.model.tokenize("".join(letters[b] for b in pieces[i]))], np.uint32)
            put(np.array([i]), np.array([len(ids)]), ids)
        return begin, count, np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)

    def _learn(self, words: list[bytes]) -> None:
        """Adds words that the table lacks."""
        joined = b" ".join(words)
        special: list[bytes] = []
        if any(x in joined for x in self.specials):
            special = [w for w in words if any(x in w for x in self.specials)]
            words = [w for w in words if not any(x in w for x in self.specials)]
            joined = b" ".join(words)
        if words:
            text = joined.decode()
            if not text.isascii() and not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            pieces = text.replace("Σ", "σ").lower().split(" ")
            plain = list(map(str.isalpha, pieces))
            odd = [not x for x in plain]
            found = list(map(self.pattern.findall, compress(pieces, odd)))
            words = [*compress(words, plain), *compress(words, odd)]
            parts = np.ones(len(words), np.int64)
            parts[len(words) - len(found) :] = np.fromiter(map(len, found), np.int64, len(found))
            pieces = [*compress(pieces, plain), *chain.from_iterable(found)]
            known = dict.fromkeys(pieces)
            begin, size, ids = self.pieces_ids(list(map(str.encode, known)))
            known = dict(zip(known, range(len(known))))
            place = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
            begin, size = begin[place], size[place]
            upto = np.concatenate([[0], np.cumsum(size)])
            bounds = upto[np.concatenate([[0], np.cumsum(parts)])]
            self._append(words, np.diff(bounds), ids[np.repeat(begin - upto[:-1], size) + np.arange(int(upto[-1]))])
        if special:
            got = [np.array(self.whole.encode(w.decode(), add_special_tokens=False).ids, np.int32) for w in special]
            self._append(special, np.fromiter(map(len, got), np.int64, len(got)), np.concatenate(got))

    def _append(self, words: list[bytes], size: np.ndarray, flat: np.ndarray) -> None:
        n, k = len(self.at), len(words)
        while n + k > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[n : n + k] = self.used + np.cumsum(size) - size
        self.size[n : n + k] = size
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.at.update(zip(words, range(n, n + k)))

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids (int32) of each text; null and empty texts have none."""
        split = [t.split() if t else [] for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        words = list(chain.from_iterable(split))
        del split
        total = len(words)
        if not total:
            return [np.zeros(0, np.int32)] * len(texts)
        if len(self.at) > self.cached_words or self.used > 8 * self.cached_words:
            self._clear()
        index = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, total)
        lack = np.flatnonzero(index < 0)
        if len(lack):
            new = [words[i] for i in lack.tolist()]
            self._learn(list(dict.fromkeys(new)))
            index[lack] = list(map(self.at.__getitem__, new))
        size = self.size[index]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[index] - (ends - size), size) + np.arange(int(ends[-1]))]
        cuts = np.concatenate([[0], ends])[np.cumsum(counts)]
        return np.split(ids, cuts[:-1])


_OPEN: dict[str, WordBPE] = {}


def opened(path: str) -> WordBPE:
    """The worker's encoder for ``path``; its table lasts from task to task."""
    if path not in _OPEN:
        _OPEN.clear()
        _OPEN[path] = WordBPE(path)
    return _OPEN[path]


def close() -> None:
    """Forgets the worker's table, so an idle worker holds no memory for it."""
    for encoder in _OPEN.values():
        encoder._clear()
        encoder.__dict__.pop("whole", None)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
