"""Byte-pair encoding as a lazily determinised finite-state transducer, and its streaming decoder.

Merges are compiled to two facts. (1) A token may follow another exactly if no merge would have crossed their
boundary before both were complete; a sequence is the encoding of its bytes exactly if all its neighbours
may follow each other, so of all tokens that end a prefix, one at most continues the encoding of what is
before it. (2) A token that reaches beyond the bytes read so far starts at one of the few positions from which
these bytes still run along a path of the vocabulary's trie.

A state of the transducer is the set of those positions: for each, its place in the trie and the tokens from
the last one common to all up to there. Tokens common to all of them can never change again and are emitted
by the transition that made them common. States and transitions are made when first needed, and forgotten
together once ``max_states`` is reached. Reading is one table look-up per byte, whatever the text is.
"""

from __future__ import annotations

import json

import regex

# Fixed value: the published pattern that splits text before merges are applied.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable ones stand for themselves, others follow 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Transducer:
    """Encodes bytes with the vocabulary and merges of a byte-level BPE file (JSON)."""

    def __init__(self, vocabulary: bytes, max_states: int = 60_000, max_words: int = 150_000):
        model = json.loads(vocabulary)["model"]
        letters = _byte_letters()
        ids = model["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in ids.items() if all(c in letters for c in t)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merge = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank = dict.fromkeys(self.bytes_of, -1)
        for r, (a, b) in enumerate(pairs):
            made = ids[a + b]
            self.merge.setdefault((ids[a], ids[b]), r)
            if made not in self.parts:
                self.parts[made], self.rank[made] = (ids[a], ids[b]), r
        # the trie: for each node the children by byte; the token of a node, if any
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int | None] = [None]
        for i, word in self.bytes_of.items():
            if len(word) > 1 and i not in self.parts:
                continue  # special tokens are no part of ordinary text
            node = 0
            for b in word:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = nxt
            self.token[node] = i
        self.max_states, self.max_words = max_states, max_words
        self._follows: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self.split = regex.compile(SPLIT).findall
        self.words: dict[str, tuple[int, ...]] = {}
        self._reset()

    def _reset(self) -> None:
        self._ids: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._moves: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self._rest: list[tuple[int, ...]] = []
        self._state(((0, (None,)),))

    def _spine(self, t: int, right: bool) -> list[tuple[int, float]]:
        """The pieces at one edge of a token, outermost first, each with the time at which it is used up."""
        out, until = [], float("inf")
        while True:
            out.append((t, until))
            if t not in self.parts:
                return out
            until, t = self.rank[t], self.parts[t][right]

    def _crossed(self, a: int, b: int, skip_top: bool = False) -> bool:
        """Whether a merge crosses the boundary of ``a`` and ``b`` while both sides' pieces are there.

        Of equal merges the leftmost goes first: before one inside ``b``, after one inside ``a``."""
        for x, x_until in self._spine(a, True):
            for y, y_until in self._spine(b, False):
                r = self.merge.get((x, y))
                if r is not None and r < x_until and r <= y_until and not (skip_top and (x, y) == (a, b)):
                    return True
        return False

    def whole(self, t: int) -> bool:
        """Whether the bytes of a token are encoded as this token."""
        known = self._whole.get(t)
        if known is None:
            if t not in self.parts:
                known = True
            else:
                a, b = self.parts[t]
                known = self.whole(a) and self.whole(b) and not self._crossed(a, b, skip_top=True)
            self._whole[t] = known
        return known

    def follows(self, a: int | None, b: int) -> bool:
        """Whether token ``b`` may come right after ``a`` (None: at the start)."""
        if a is None:
            return self.whole(b)
        known = self._follows.get((a, b))
        if known is None:
            if len(self._follows) > 500_000:
                self._follows.clear()
            known = self._follows[a, b] = self.whole(b) and not self._crossed(a, b)
        return known

    def _state(self, live: tuple) -> int:
        n = self._ids.get(live)
        if n is None:
            n = self._ids[live] = len(self._states)
            self._states.append(live)
            self._moves.append({})
            self._rest.append(next(chain for node, chain in live if node == 0)[1:])
        return n

    def _move(self, s: int, byte: int) -> tuple[int, tuple[int, ...]]:
        kept, ended = [], None
        for node, chain in self._states[s]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            t = self.token[child]
            if t is not None and ended is None and self.follows(chain[-1], t):
                ended = (*chain, t)
            if self.children[child]:
                kept.append((child, chain))
        if ended is None:
            raise ValueError("the vocabulary lacks a byte")
        live = [*kept, (0, ended)]
        n, short = 1, min(len(c) for _, c in live)
        while n < short and all(c[n] == ended[n] for _, c in live):
            n += 1
        move = (self._state(tuple((node, c[n - 1 :]) for node, c in live)), ended[1:n])
        self._moves[s][byte] = move
        return move

    def encode_bytes(self, data: bytes) -> tuple[int, ...]:
        """The tokens of one piece that no split divides."""
        if len(self._states) > self.max_states:
            self._reset()
        out: list[int] = []
        moves, s = self._moves, 0
        for byte in data:
            move = moves[s].get(byte) or self._move(s, byte)
            s = move[0]
            if move[1]:
                out += move[1]
        out += self._rest[s]
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """The token ids of a text without special tokens; an empty list for an empty or null text."""
        out: list[int] = []
        if not text:
            return out
        words = self.words
        for w in self.split(text):
            ids = words.get(w)
            if ids is None:
                ids = self.encode_bytes(w.encode("utf-8", "surrogatepass"))
                if len(w) <= 64:
                    if len(words) >= self.max_words:
                        words.clear()
                    words[w] = ids
            out += ids
        return out


class StreamDecoder:
    """Tokens to text as they come, through an incremental UTF-8 state machine.

    ``feed`` returns the characters completed by a token, so characters split between tokens appear with their
    last one. Bytes that are no UTF-8 become U+FFFD, one for each maximal part of a character."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.need, self.code, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, token: int) -> str:
        out: list[str] = []
        for b in self.bytes_of.get(token, b""):
            if self.need:
                if self.low <= b <= self.high:
                    self.code = self.code << 6 | b & 0x3F
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.code))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.need, self.code = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.need, self.code = 2, b & 0x0F
                self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.need, self.code = 3, b & 0x07
                self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        """What is left at the end of the stream: U+FFFD for an unfinished character."""
        left, self.need = ("�" if self.need else ""), 0
        self.low, self.high = 0x80, 0xBF
        return left

    def decode(self, ids) -> str:
        return "".join([*map(self.feed, ids), self.end()])
