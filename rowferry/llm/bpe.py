"""Byte-pair encoding of whole texts, many words at a time.

Texts are cut where no token can reach across, each distinct piece is encoded once and
numbered, so that a text costs one look-up a piece and its ids are gathered from one array.
Pieces not met before are cut into words together, and their ids gathered from those of the
words. Words not met before are merged together: one array holds the symbols of thousands of
words, and each step does the merge of least rank in every one of them, leftmost first, as
the merge rules say.

Anything whose character classes are not beyond doubt goes to the tokenizers library as a
whole (see ``_odd``), so the ids are always those of the library.
"""

from __future__ import annotations

import itertools
import json
import re
from collections import defaultdict
from collections.abc import Iterable
from operator import not_

import numpy as np
import regex
from tokenizers import Tokenizer

from rowferry.llm.common import of_worker

NONE = np.int32(2**31 - 1)
LONG = 48  # longer words are merged one by one
MOST = 600_000  # pieces kept by a worker, and as many words


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merger:
    """Applies ranked merges to many words at once."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str = ""):
        symbol = byte_symbols()
        self.first = np.array([vocab[symbol[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[symbol[b] + end] for b in range(256)], np.int64)
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        keys = np.array([(vocab[a] << 17) | vocab[b] for a, b in pairs], np.uint64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        # hash tables without chains: what collides goes to the next one
        self.tables, rank, bits = [], np.arange(len(keys), dtype=np.int32), 19
        while len(keys):
            mult = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.tables) * 0x1F123BB5)
            slot = (keys * mult) >> np.uint64(64 - bits)
            at = np.unique(slot, return_index=True)[1]
            key, order, new = (np.full(1 << bits, fill, kind) for fill, kind in ((2**63, np.uint64), (NONE, np.int32), (0, np.int32)))
            key[slot[at]], order[slot[at]], new[slot[at]] = keys[at], rank[at], made[at]
            self.tables.append((mult, np.uint64(64 - bits), key, order, new))
            left = np.ones(len(keys), bool)
            left[at] = False
            keys, rank, made, bits = keys[left], rank[left], made[left], 14

    def rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of joining each ``a`` with its ``b``."""
        keys = (a.astype(np.uint64) << np.uint64(17)) | b.astype(np.uint64)
        rank, made = np.full(len(keys), NONE, np.int32), np.zeros(len(keys), np.int32)
        for mult, shift, key, order, new in self.tables:
            slot = (keys * mult) >> shift
            hit = key[slot] == keys
            rank[hit], made[hit] = order[slot[hit]], new[slot[hit]]
        return rank, made

    def _together(self, words: list[bytes], width: int) -> list[bytes]:
        n, w1 = len(words), width + 1
        size = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in words), np.uint8).reshape(n, width)
        sym = np.zeros((n, w1), np.int64)
        sym[:, :width] = self.first[data]
        rows = np.arange(n)
        sym[rows, size - 1] = self.last[data[rows, size - 1]]
        inside = np.arange(w1)[None, :] < size[:, None]
        nxt = np.tile(np.arange(1, w1 + 1), (n, 1))
        prv = np.tile(np.arange(-1, w1 - 1), (n, 1))
        rank, made = np.full((n, w1), NONE, np.int32), np.zeros((n, w1), np.int32)
        pair = np.arange(w1)[None, :] < size[:, None] - 1
        r, c = np.nonzero(pair)
        rank[r, c], made[r, c] = self.rank(sym[r, c], sym[r, c + 1])
        live = rows
        while len(live):
            at = rank[live].argmin(axis=1)
            go = rank[live, at] < NONE
            live, at = live[go], at[go]
            if not len(live):
                break
            right = nxt[live, at]
            after = nxt[live, right]
            before = prv[live, at]
            sym[live, at] = made[live, at]
            inside[live, right] = False
            rank[live, right] = NONE
            nxt[live, at] = after
            rank[live, at] = NONE
            more = after < size[live]
            lm, am, fm = live[more], at[more], after[more]
            prv[lm, fm] = am
            rank[lm, am], made[lm, am] = self.rank(sym[lm, am], sym[lm, fm])
            less = before >= 0
            ll, al, bl = live[less], at[less], before[less]
            rank[ll, bl], made[ll, bl] = self.rank(sym[ll, bl], sym[ll, al])
        flat = sym[inside].astype(np.uint32).tobytes()
        ends = 4 * np.cumsum(inside.sum(axis=1))
        out, a = [], 0
        for b in ends.tolist():
            out.append(flat[a:b])
            a = b
        return out

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (not empty), as unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            n = len(w)
            groups.setdefault(n if n > LONG else n + (-n % 4), []).append(i)
        for width, at in groups.items():
            step = max(1, 65536 // width)
            for a in range(0, len(at), step):
                part = at[a : a + step]
                for i, ids in zip(part, self._together([words[i] for i in part], width), strict=True):
                    out[i] = ids
        return out


def _with(room: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` behind the first ``used`` values, in twice the room when there is too little."""
    if used + len(more) > len(room):
        room = np.concatenate([room[:used], np.zeros(used + 2 * len(more), room.dtype)])
    room[used : used + len(more)] = more
    return room


class Table:
    """Keys numbered as they are met; the ids of all of them lie in one array, in that order.

    A list of keys becomes numbers by one look-up each, and its ids are gathered as a whole.
    ``first``, if given, is number 0, has no ids and is never forgotten.
    """

    def __init__(self, first=None):
        self.number: defaultdict = defaultdict(itertools.count().__next__)
        self.n, self.first = 0, first is not None
        self.end, self.uses, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        if self.first:
            self.number[first]
            self.add(np.zeros(1, np.int64), self.ids)

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, keys), np.int32, len(keys))

    def fresh(self) -> list:
        """Keys that have a number and no ids yet."""
        return list(itertools.islice(reversed(self.number), len(self.number) - self.n))[::-1]

    def add(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        """The ids of the next keys, end to end."""
        last, n = self.end[self.n], self.n
        self.end = _with(self.end, n + 1, last + np.cumsum(sizes))
        self.uses = _with(self.uses, n, np.zeros(len(sizes), np.int64))
        self.ids = _with(self.ids, last, ids)
        self.n += len(sizes)

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered keys end to end, and where those of each key end."""
        np.add.at(self.uses, at, 1)
        ends, parts, done = np.zeros(len(at), np.int64), [self.ids[:0]], 0
        for a in range(0, len(at), 1 << 18):
            k = at[a : a + (1 << 18)]
            first = self.end[k]
            size = self.end[k + 1] - first
            end = np.cumsum(size)
            place = np.repeat(first - (end - size), size)
            place += np.arange(len(place))
            parts.append(self.ids[place])
            ends[a : a + len(k)] = done + end
            done += len(place)
        return np.concatenate(parts), ends

    def forget(self, most: int) -> None:
        """Beyond ``most`` keys, keep those met more than once, of these the most met, half of ``most`` at most."""
        if self.n <= most:
            return
        uses = self.uses[: self.n]
        if self.first:
            uses[0] = np.iinfo(np.int64).max
        some = np.flatnonzero(uses > 1)
        if len(some) > most // 2:
            some = np.sort(some[np.argpartition(-uses[some], most // 2)[: most // 2]])
        uses, sizes, ids = uses[some] // 2, np.diff(self.end)[some], self.gather(some)[0]
        keys = list(itertools.compress(self.number, np.isin(np.arange(self.n), some).tolist()))
        self.number = defaultdict(itertools.count(len(keys)).__next__, zip(keys, range(len(keys)), strict=True))
        self.n, self.end, self.uses, self.ids = 0, self.end[:1].copy(), self.uses[:0], self.ids[:0]
        self.add(sizes, ids)
        self.uses[: self.n] = uses


class Coder:
    """What both kinds of vocabulary share: pieces, words, their ids, and the library for the rest."""

    close = ""  # stands behind the words of each piece and is no word itself

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t["content"] for t in data["added_tokens"]]
        self.vocab = data["model"]["vocab"]
        self.merger = Merger(self.vocab, data["model"]["merges"], data["model"].get("end_of_word_suffix") or "")
        self.known, self.words = Table(), Table(self.close)
        self.lexicon = None

    def by_library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Words of the lexicon by look-up, all others by their merges."""
        if self.lexicon is None:
            return self.merger.merge(words)
        out = self.lexicon.ids_of(words)
        left = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(left, self.merger.merge([words[i] for i in left]), strict=True):
            out[i] = ids
        return out

    def learn(self) -> None:
        """Give pieces not met before their ids."""
        fresh = self.known.fresh()
        self.words.forget(MOST)
        tokens, whole = self.cut(fresh)
        at = self.words.numbers(tokens)
        merged = self.merge_words([w.encode() for w in self.words.fresh()])
        self.words.add(_sizes(merged), np.frombuffer(b"".join(merged), np.uint32))
        ids, ends = self.words.gather(at)
        ends = ends[at == 0]
        sizes = np.diff(ends, prepend=0)
        if whole:
            got = [self.by_library(fresh[i] if isinstance(fresh[i], str) else fresh[i].decode()) for i in whole]
            sizes[whole] = _sizes(got)
            ids = np.insert(ids, np.repeat(ends[whole], sizes[whole]), np.frombuffer(b"".join(got), np.uint32))
        self.known.add(sizes, ids)

    def encode(self, texts: list[str | None], step: int = 512) -> Iterable[bytes]:
        """The ids of each text, as unsigned 32-bit little-endian integers."""
        for a in range(0, len(texts), step):
            self.known.forget(MOST)
            at, whole = [], []
            for t in texts[a : a + step]:
                cut = self.pieces(t) if t else b""
                whole.append(cut if isinstance(cut, bytes) else None)
                at.append(self.known.numbers([] if isinstance(cut, bytes) else cut))
            self.learn()
            ids, ends = self.known.gather(np.concatenate(at))
            data, begin = ids.tobytes(), 0
            ends = np.concatenate([[0], 4 * ends])[np.cumsum([len(x) for x in at])].tolist()
            for ids, end in zip(whole, ends, strict=True):
                yield data[begin:end] if ids is None else ids
                begin = end


def _sizes(ids: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, ids), np.int64, len(ids)) // 4


# Code points whose class differs between Unicode versions or engines: controls that some
# take for white space, private use, everything beyond the basic plane.
_ODD = re.compile("[\x1c-\x1f\x85\ud800-\uffff\U00010000-\U0010ffff]")


class WordCoder(Coder):
    """A lower-casing vocabulary with word ends; white space separates words and is dropped."""

    close = "\n"
    _plain = re.compile("[\n!-~\xa1-\xff]*")
    # of the plain code points in lower case, these are \p{L}, and these \p{N}
    _l, _n = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
    _lines = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_l}]+|[{_n}]|[^\n{_l}{_n}]+|\n")

    def pieces(self, text: str) -> list[bytes]:
        return text.encode().split()

    def cut(self, pieces: list[bytes]) -> tuple[list[str], list[int]]:
        """The words of all pieces, each piece closed, and the numbers of those left to the library."""
        lines, whole = b"\n".join([*pieces, b""]).decode(), []
        if "<|" in lines or not self._plain.fullmatch(lines):
            each = lines.split("\n")
            whole = [i for i, p in enumerate(each) if "<|" in p or not self._plain.fullmatch(p)]
            for i in whole:
                each[i] = ""
            lines = "\n".join(each)
        return self._lines.findall(lines.lower()), whole


class ByteCoder(Coder):
    """A byte-level vocabulary; a space belongs to the word behind it."""

    # with single spaces and line ends alone, a piece is a space and what follows it
    _other_space = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ud800-\uffff\U00010000-\U0010ffff]")
    _fast = re.compile(r" ?[^ \n]+|\n")
    _words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def __init__(self, path: str):
        super().__init__(path)
        back = {s: b for b, s in byte_symbols().items()}
        known = self.vocab | {s: self.library.token_to_id(s) for s in self.specials}
        self.texts = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.texts[i] = token.encode() if token in self.specials else bytes(back[c] for c in token)
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.texts), np.uint8)

    def pieces(self, text: str) -> list[str] | bytes:
        if "<|" in text and any(s in text for s in self.specials):
            return self.by_library(text)
        if self._other_space.search(text):
            return self.by_library(text) if _ODD.search(text) else self._words.findall(text)
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n":
            return self._words.findall(text)
        return self._fast.findall(text)

    @staticmethod
    def _alone(piece: str) -> bool:
        body = piece[1:] if piece[0] == " " else piece
        # the last: cut by the pattern before
        return body.isalpha() or piece.isspace() or not body or body.split(maxsplit=1)[0] != body

    def cut(self, pieces: list[str]) -> tuple[list[str], list[int]]:
        """The words of all pieces, each piece closed; all pieces that need it go through the pattern at once."""
        alone, out = list(map(self._alone, pieces)), []
        words = iter(self._words.findall("\n".join([*itertools.compress(pieces, map(not_, alone)), ""])))
        for p, one in zip(pieces, alone, strict=True):
            if one:
                out.append(p)
            else:
                out += itertools.takewhile("\n".__ne__, words)
            out.append(self.close)
        return out, []

    def decode(self, ids: bytes) -> str:
        return self.decode_many([ids])[0]

    def decode_many(self, lists: list[bytes]) -> list[str]:
        """The texts of lists of ids; their bytes are gathered together, a few megabytes at a time."""
        out: list[str] = []
        a = 0
        while a < len(lists):
            b, size = a, 0
            while b < len(lists) and (b == a or size + len(lists[b]) <= 4 << 20):
                size, b = size + len(lists[b]), b + 1
            ids = np.frombuffer(b"".join(lists[a:b]), np.uint32)
            lengths = self.sizes[ids]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            data = self.flat[np.repeat(self.starts[ids] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
            at = ends[np.cumsum([0, *(len(x) // 4 for x in lists[a:b])])].tolist()
            out += [data[x:y].decode("utf-8", "replace") for x, y in zip(at, at[1:])]
            a = b
        return out


def coder(kind: type[Coder], path: str) -> Coder:
    """The coder of this Python worker."""
    return of_worker((kind.__name__, path), lambda: kind(path))
