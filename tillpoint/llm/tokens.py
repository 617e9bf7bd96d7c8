"""Token ids of texts by a public lower-casing word tokenizer, inside tasks.

A text of plain Latin letters is cut into pre-tokens by one pattern and each
distinct pre-token is encoded once per worker (a bounded cache); any other text,
and one that holds an added token's string, goes through the tokenizer whole.
Both give the tokenizer's own ids.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np

from .common import kept_by_worker, release

CACHE = 400_000  # pre-tokens in a worker's cache
PIECE = 1 << 20

# fixed values: the tokenizer's pre-token pattern for texts of these characters
_OTHER = re.compile(r"[^\t-\r\x20-\x7e\xa1-ſ]")
_LETTER, _NUMBER = "a-zªµºß-öø-ſ", "0-9²³¹¼½¾"
# words come first, as most pre-tokens are: no other alternative begins with a letter
_PRE = re.compile(rf"[{_LETTER}]+|[{_NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[^\s{_LETTER}{_NUMBER}]+")


def _pieces(text: str) -> Iterator[str]:
    """Bounded pieces of a text, cut at spaces or line ends, where no token
    crosses."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in " \n\t":
            end += 1
        yield text[at:end]
        at = end


class WordBpe:
    """``known`` holds pre-tokens in the order learnt: when it is full, all but the
    latest ``CACHE // 2`` go."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the tokenizer finds their strings within texts, some before lower-casing, some after
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _cut(self, text: str) -> bytes | list[str]:
        """The ids, or the pre-tokens to look up."""
        low = text.lower()
        if _OTHER.search(text) or any(t in low for t in self.added):
            return self._ids(text).tobytes()
        return _PRE.findall(low)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null as empty."""
        held: list[list] = []  # of each text, pieces: words to look up, or the ids
        size = 0
        for text in texts:
            held.append([self._cut(p) for p in _pieces(text or "")])
            size += len(text or "")
            if size > PIECE:
                yield from self._looked_up(held)
                held, size = [], 0
        yield from self._looked_up(held)
        release()

    def _looked_up(self, held: list[list]) -> Iterator[bytes]:
        self._learn(set().union(*(p for pieces in held for p in pieces if isinstance(p, list))))
        get = self.known.__getitem__
        for pieces in held:
            yield b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in pieces)

    def _learn(self, words: set[str]) -> None:
        missing = list(words.difference(self.known))
        if not missing:
            return
        if len(self.known) + len(missing) > CACHE:
            self.known = dict(itertools.islice(self.known.items(), max(0, len(self.known) - CACHE // 2), None))
            missing = list(words.difference(self.known))
        # all at once: the last id of each pre-token says so
        ids = self._ids(" ".join(missing))
        ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
        if len(ends) != len(missing) or ends[-1] != len(ids):
            raise ValueError("pre-tokens were cut otherwise than by the tokenizer")
        raw = ids.tobytes()
        self.known.update(zip(missing, (raw[4 * i:4 * j] for i, j in zip([0, *ends], ends))))


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One tokenizer and cache for each worker process."""
    return WordBpe(path)


kept_by_worker("tokens", word_bpe.cache_clear)
