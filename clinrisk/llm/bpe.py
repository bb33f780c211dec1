"""Token ids of whole texts by the ``tokenizers`` library, a stretch at a time.

The vocabulary's splitting pattern never joins a run of non-blanks with a
blank behind it, nor letters with a mark behind them (an apostrophe aside).  A
text may be cut there, and a run with the one space before it is encoded on
its own: each distinct run once, by ``tokenizers``; the bytes of its ids are
remembered (a bounded cache), and a text's ids are its runs' ids in a row.  A
text of any length is handled in windows, and long runs of blanks need no
recursion.  Special tokens in a text are cut out first, as the library does.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import public_tokenizers

from clinrisk.llm.common import kept

#: White space of the splitting pattern (Python's \\s has \x1c-\x1f besides), and letters that need no table.
_B = "\t-\r \x85\xa0  -     　"
_L = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Letters; else a run of non-blanks that begins with no such letter or holds an apostrophe; else blanks.
_RUN = re.compile(f" ?[{_L}]+(?=[{_B}.,;:!?]|$)| ?[^{_B}]+|[{_B}]+(?![^{_B}])|[{_B}]")
_LETTERS = re.compile(f" ?[{_L}]+")
_CUT = re.compile(f"(?<=[^{_B}])[{_B}]")

WINDOW = 1 << 18            # characters whose runs are held at once
CACHED = 800_000            # runs that are remembered, some 200 MB
LONGEST = 64                # characters of such a run


def _byte_names() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian bytes, ``width`` bytes an id."""

    def __init__(self, path: str, cached: int | None = None):
        from tokenizers import Tokenizer
        self.cached = CACHED if cached is None else cached
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.names = _byte_names()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.known: dict[str, bytes] = {}
        self.missed = 0

    def _packed(self, ids: list[int]) -> bytes:
        packed = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        found = {}
        model = self.tokenizer.model
        other = []
        for run in new:
            if len(run) > LONGEST:
                other.append(run)
            elif run.isascii() and run[run[0] == " ":].isalpha():      # one word of the splitting pattern, only its space is renamed
                found[run] = self._packed([t.id for t in model.tokenize(run.replace(" ", self.names[32]))])
            elif _LETTERS.fullmatch(run):                               # such a word
                found[run] = self._packed([t.id for t in model.tokenize(run.encode().decode("latin-1").translate(self.names))])
            else:
                other.append(run)
        for run, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            found[run] = self._packed(e.ids)
        if len(self.known) < self.cached:
            self.known.update((run, ids) for run, ids in found.items() if len(run) <= LONGEST)
        else:
            self.missed += len(found)
            if self.missed > 4 * self.cached:            # other texts than those it was filled from
                self.known, self.missed = {}, 0
        return found

    def _ids(self, runs: list[str]) -> list[bytes]:
        ids = list(map(self.known.get, runs))
        if None in ids:
            found = self._learn({run for run, v in zip(runs, ids) if v is None})
            ids = [found[run] if v is None else v for run, v in zip(runs, ids)]
        return ids

    def _windows(self, text: str) -> Iterator[list[str]]:
        """The runs of a text, some WINDOW characters at a time; a special token is a run."""
        parts = self.at_special.split(text) if any(s in text for s in self.special) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield [part]
                continue
            at = 0
            while at < len(part):
                cut = _CUT.search(part, at + WINDOW) if len(part) - at > WINDOW else None
                end = cut.start() if cut else len(part)
                yield _RUN.findall(part[at:end] if at or cut else part)
                at = end

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        held: list[str] = []            # runs of the texts not given out yet
        ends: list[int] = []
        size = 0

        def flush() -> Iterator[bytes]:
            ids, at = self._ids(held), 0
            for end in ends:
                yield b"".join(ids[at:end])
                at = end
        for text in texts:
            if len(text) > WINDOW:          # alone, window by window
                yield from flush()
                held, ends, size = [], [], 0
                yield b"".join(b"".join(self._ids(runs)) for runs in self._windows(text))
                continue
            for runs in self._windows(text):
                held += runs
            ends.append(len(held))
            size += len(text)
            if size >= WINDOW:
                yield from flush()
                held, ends, size = [], [], 0
        yield from flush()


def encoder(vocabulary: str, cached: int | None = None) -> Encoder:
    """The encoder of ``<vocabulary>.json``, one a worker while tasks with ``keep`` follow each other."""
    return kept(("encoder", vocabulary, cached), lambda: Encoder(public_tokenizers.path(f"{vocabulary}.json"), cached))
