"""Byte-pair encoding with word ends: splitting, merging and the streaming transducer.

The vocabulary file names the normaliser (NFC, lower case), the pattern that splits text
into pre-tokens, the merge list and the special tokens. Nothing here is trained.

Two facts make streaming exact:

* A pre-token holds no white space, so text may be cut at any white space.
* Inside a pre-token, a symbol can only be disturbed from the right by a merge of lower rank
  whose left operand is that symbol or one on its right spine. ``lookahead`` follows these
  chains through the merge list; a symbol is stable once that many symbols follow it, and
  what follows a token boundary encodes the same alone.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import regex

WORD_END = "</w>"
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
)
LETTERS = regex.compile(r"\p{L}*")
OTHERS = regex.compile(r"[^\p{White_Space}\p{L}\p{N}]*")
SPACE = regex.compile(r"\p{White_Space}")
LAST_SPACE = regex.compile(r"(?r)\p{White_Space}")

#: Pre-tokens up to this length are merged whole; longer ones pass through ``WordStream``.
WHOLE = 64
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte value in the vocabulary file."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (chr(256 + n) for n in range(256))
    return [chr(b) if b in kept else next(rest) for b in range(256)]


def lower(text: str) -> str:
    """Lower case letter by letter; a final sigma is no exception."""
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


@lru_cache(1)
def _composing() -> frozenset[str]:
    """Characters that NFC may join to the one before."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    second = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(second | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))})


class WordBPE:
    """The merge list of one vocabulary file."""

    def __init__(self, path: str):
        config = json.load(open(path, encoding="utf-8"))
        model = config["model"]
        kinds = [n["type"] for n in config["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("a BPE with word ends over NFC, lower-case text is needed")
        self.vocab: dict[str, int] = model["vocab"]
        self.tokens = {n: t for t, n in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.tokens |= {n: t for t, n in self.special.items()}
        self.special_pattern = re.compile("|".join(map(re.escape, self.special)))
        self.longest_special = max(map(len, self.special), default=0)
        letters = byte_letters()
        self.first = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + WORD_END] for c in letters]
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.ranks = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.joined = [joined for _, joined in self.merges.values()]

    # -- text to pre-tokens

    def parts(self, text: str) -> list[tuple[str, bool]]:
        """Runs of ordinary text and special strings (marked True)."""
        if not any(s in text for s in self.special):
            return [(text, False)]
        out, at = [], 0
        for found in self.special_pattern.finditer(text):
            out += [(text[at : found.start()], False), (found[0], True)]
            at = found.end()
        return [*out, (text[at:], False)]

    @staticmethod
    def split(text: str) -> list[str]:
        """The pre-tokens of ordinary text."""
        if text.isascii():
            return ASCII_PIECES.findall(text.lower())
        return PIECES.findall(lower(unicodedata.normalize("NFC", text)))

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text; special strings stand for themselves, upper case or not.

        No ordinary pre-token equals a special string: symbols and letters never share one.
        """
        out: list[str] = []
        for part, special in self.parts(text):
            out += [part] if special else self.split(part)
        return out

    # -- pre-tokens to ids

    def encode_word(self, word: str) -> list[int]:
        """The ids of one pre-token."""
        if word in self.special:
            return [self.special[word]]
        if len(word) <= WHOLE:
            data = word.encode()
            return self.merge([*map(self.first.__getitem__, data[:-1]), self.last[data[-1]]])
        stream = WordStream(self)
        return [*stream.feed(word), *stream.finish()]

    def merge(self, ids: list[int]) -> list[int]:
        """Join adjacent symbols, lowest rank first and leftmost first among equals."""
        if len(ids) > 40:
            return self._merge_long(ids)
        rank_of, joined = self.ranks.get, self.joined
        ids = list(ids)
        ranks = [rank_of(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            ids[at : at + 2] = [joined[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, merges = len(ids), self.merges
        after, before, here = list(range(1, n + 1)), list(range(-1, n - 1)), list(ids)
        queue = [(*found, at, at + 1) for at, pair in enumerate(zip(ids, ids[1:])) if (found := merges.get(pair))]
        heapq.heapify(queue)
        while queue:
            rank, joined, a, b = heapq.heappop(queue)
            if here[a] < 0 or after[a] != b or merges.get((here[a], here[b] if b < n else -1)) != (rank, joined):
                continue
            here[a], here[b] = joined, -1
            after[a] = c = after[b]
            if c < n:
                before[c] = a
                if found := merges.get((joined, here[c])):
                    heapq.heappush(queue, (*found, a, c))
            if before[a] >= 0 and (found := merges.get((here[before[a]], joined))):
                heapq.heappush(queue, (*found, before[a], a))
        return [x for x in here if x >= 0]

    @cached_property
    def lookahead(self) -> int:
        """So many bytes after a symbol decide whether it is a token.

        ``beyond(s)`` bounds the bytes after symbol s that can break it, or join it to
        what follows. A merge (u, v) can do so if u is on the right spine of s, ranks below the
        merge that takes u up into s, and v itself stands, which takes the bytes it needs in turn.
        """
        size = {n: len(t.removesuffix(WORD_END)) for n, t in self.tokens.items()}
        parents: dict[int, tuple[int, int]] = {}  # symbol: its merge's rank and right operand
        ranks: dict[int, list[int]] = {}  # u: ranks of the merges that begin with u
        reach: dict[int, list[int]] = {}  # the largest reach of these up to each rank

        def beyond(symbol: int, limit: int) -> int:
            most = 0
            while True:
                at = bisect_left(ranks.get(symbol, ()), limit)
                most = max(most, reach[symbol][at - 1]) if at else most
                if symbol not in parents:
                    return most
                limit, symbol = parents[symbol]

        for (a, b), (rank, joined) in self.merges.items():
            parents.setdefault(joined, (rank, b))
            longest = reach.setdefault(a, [])
            longest.append(max(size[b] + beyond(b, rank), longest[-1] if longest else 0))
            ranks.setdefault(a, []).append(rank)
        return max((beyond(token, len(self.merges)) for token in self.tokens), default=0)


class WordStream:
    """One pre-token of any length, encoded in constant memory."""

    def __init__(self, bpe: WordBPE):
        self.bpe, self.data = bpe, bytearray()
        self.ahead = bpe.lookahead  # computed once for each merge list
        self.room = 4 * self.ahead + 256

    def _encode(self, closed: bool) -> list[int]:
        bpe, data = self.bpe, self.data
        if closed:
            return bpe.merge([*map(bpe.first.__getitem__, data[:-1]), bpe.last[data[-1]]])
        return bpe.merge([*map(bpe.first.__getitem__, data)])

    def feed(self, text: str) -> Iterator[int]:
        """Ids that no later text can change."""
        more = text.encode()
        for start in range(0, len(more), self.room):
            self.data += more[start : start + self.room]
            # The last byte may turn out to end the word, so it is no lookahead yet.
            stable, at = len(self.data) - 1 - self.ahead, 0
            if stable <= self.room:
                continue
            for token in self._encode(closed=False):
                end = at + len(self.bpe.tokens[token])
                if end > stable:
                    break
                yield token
                at = end
            del self.data[:at]

    def finish(self) -> list[int]:
        return self._encode(closed=True) if self.data else []


class Encoder:
    """Text in pieces of any size to ids, in constant memory.

    ``words`` gives, for each stretch of text that later text cannot change, its pre-tokens;
    a pre-token too long to keep comes as a list of ids instead.
    """

    def __init__(self, bpe: WordBPE, keep: int = 4096):
        self.bpe, self.keep = bpe, keep
        self.held = ""
        self.open: WordStream | None = None
        self.goes_on = LETTERS

    @property
    def waits(self) -> bool:
        """Whether something is held back until more text comes."""
        return bool(self.held or self.open)

    def words(self, text: str, last: bool = False) -> Iterator[list[str] | list[int]]:
        self.held += text
        if last:
            yield from self._take(self.held, True)
            self.held = ""
            return
        found = LAST_SPACE.search(self.held)
        if found:
            cut = found.end()
            yield from self._take(self.held[:cut], True)
            self.held = self.held[cut:]
        if len(self.held) > self.keep:
            cut = self._safe_cut()
            if cut:
                taken, self.held = self.held[:cut], self.held[cut:]
                rest = yield from self._take(taken, False)
                self.held = rest + self.held

    def _safe_cut(self) -> int:
        """Where NFC joins nothing across and no special string is torn."""
        text = self.held
        cut = len(text) - 1
        while cut > 0 and (unicodedata.combining(text[cut]) or text[cut] in _composing()):
            cut -= 1
        for start in range(max(0, cut - self.bpe.longest_special + 1), cut):
            if any(s.startswith(text[start:cut]) for s in self.bpe.special):
                return start
        return cut

    def _take(self, text: str, closed: bool):
        """Encode ``text``; unless it ends here, return the end that must wait."""
        parts = self.bpe.parts(text)
        for n, (part, special) in enumerate(parts):
            ends = closed or n + 1 < len(parts)
            if special:
                yield from self._close()
                yield [part]
                continue
            if self.open:
                part = lower(unicodedata.normalize("NFC", part))
                run = self.goes_on.match(part)[0]
                yield [*self.open.feed(run)]
                part = part[len(run) :]
                if part or (ends and n + 1 < len(parts)) or closed:
                    yield from self._close()
            words = self.bpe.split(part)
            if not ends and words:
                # Nothing but the last pre-token can change, and it ends the text: there is no space in it.
                word = words.pop()
                yield words
                if len(word) <= WHOLE:
                    return word
                self.goes_on = OTHERS if OTHERS.fullmatch(word) else LETTERS
                self.open = WordStream(self.bpe)
                yield [*self.open.feed(word)]
                return ""
            yield words
        return ""

    def _close(self):
        if self.open:
            yield self.open.finish()
            self.open = None

    def feed(self, text: str, last: bool = False) -> Iterator[int]:
        """The ids that ``text`` makes certain."""
        for words in self.words(text, last):
            for word in words:
                if isinstance(word, int):
                    yield word
                else:
                    yield from self.bpe.encode_word(word)


class Decoder:
    """Ids to text in constant memory.

    ``joined`` gives token strings with a blank between, as a file without a decoder asks for.
    ``text`` gives readable text: bytes pass through an incremental UTF-8 state machine, so a
    character whose bytes lie in several tokens comes out whole, and word ends become blanks.
    """

    def __init__(self, bpe: WordBPE, joined: bool = True):
        self.bpe, self.joined, self.begun = bpe, joined, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        ids = list(ids)
        try:
            tokens = [*map(self.bpe.tokens.__getitem__, ids)]
        except KeyError:  # numbers that are no token are passed over
            tokens = [self.bpe.tokens[n] for n in ids if n in self.bpe.tokens]
        if self.joined:
            out = " ".join(tokens)
            out, self.begun = (" " + out if self.begun and tokens else out), self.begun or bool(tokens)
            return out
        out = []
        for token in tokens:
            if token in self.bpe.special:
                out.append(self.utf8.decode(b"", True) + token)
                self.utf8.reset()
                continue
            ends = token.endswith(WORD_END)
            data = bytes(self.bpe.byte_of[c] for c in token.removesuffix(WORD_END))
            out.append(self.utf8.decode(data, ends) + " " * ends)
        return "".join(out) + (self.utf8.decode(b"", True) if last else "")
