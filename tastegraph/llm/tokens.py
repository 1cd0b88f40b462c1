"""Byte-level BPE encoding with the tokenizers library, memoised by word.

The vocabulary's pre-tokeniser never makes a token that spans the place
between a non-space character and a following single space or line feed, so
a text may be cut there and the pieces encoded one by one with the same ids.
Words repeat, so each worker process keeps a bounded memo of encoded pieces; a piece of
letters goes straight to the library's BPE model, marks behind it are a piece
of their own, and any other piece goes through its whole pipeline.  Texts with other
white space (doubled, leading, trailing, tabs) are cut by a regular
expression only at the places where the cut is safe.  A text that holds the
string of one of the vocabulary's added tokens, which the library cuts out of
the text before all else, is encoded whole.
"""

from __future__ import annotations

import os
import re
import weakref
from array import array
from itertools import islice

_SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_MARKS = ".,;:!?\"'()[]{}-|*#$%&<>=+_/\\@~^`"


def _byte_letters() -> dict[int, str]:
    """The byte alphabet of byte-level BPE: printable Latin-1 bytes stand for
    themselves, the others for the characters from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class _Memo(dict):
    """word -> its ids, or None if the word is not safe to encode alone.  Two
    generations bound it: words used since the last ``age()`` stay.  It holds
    no reference to its encoder, so both are freed with the encoder's last one
    and do not wait for the collector of cycles."""

    def __init__(self, encoder: "Encoder", lead: str):
        super().__init__()
        self._encoder, self._lead, self._old = weakref.proxy(encoder), lead, {}

    def age(self) -> None:
        self._old = dict(self)
        self.clear()

    def __missing__(self, w: str) -> bytes | None:
        e = self._encoder
        if w in self._old:
            ids = self._old[w]
        elif w.isalpha():
            ids = e.word(self._lead + w)
        elif (letters := w.rstrip(_MARKS)).isalpha():
            ids = self[letters] + e.marks(w[len(letters):])
        elif w and not w[0].isspace() and not w[-1].isspace():
            ids = e.whole(self._lead + w)
        else:
            ids = None
        self[w] = ids
        return ids


class Encoder:
    """``encode(text)`` gives the little-endian unsigned 32-bit ids of a text
    (null as empty) followed by ``end_id``, as ``bytes``."""

    MEMO_ENTRIES = 300_000
    MARK_RUNS = 10_000

    def __init__(self, vocabulary: str, end_id: int, memo_entries: int = MEMO_ENTRIES):
        self.memo_entries = memo_entries
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(vocabulary)
        self._added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._model = self._tok.model
        self._letters = _byte_letters()
        self.vocab_size = self._tok.get_vocab_size()
        self._end = _packed([end_id])
        self._newline = self.whole("\n")
        self._marks: dict[str, bytes] = {}
        self._first = _Memo(self, "")  # words that start a line
        self._rest = _Memo(self, " ")  # words after a space

    def whole(self, part: str) -> bytes:
        return _packed(self._tok.encode(part, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        """Ids of one run of letters, with its leading space if any."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self._letters)
        elif word[0] == " ":
            word = self._letters[32] + word[1:]
        return _packed([t.id for t in self._model.tokenize(word)])

    def marks(self, run: str) -> bytes:
        """Ids of a run of marks, of which the pre-tokeniser makes one piece
        wherever it ends a word."""
        if run not in self._marks:
            if len(self._marks) >= self.MARK_RUNS:
                self._marks.clear()
            self._marks[run] = self.whole(run)
        return self._marks[run]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return self._end
        if any(t in text for t in self._added):
            return self.whole(text) + self._end
        first, rest = self._first, self._rest
        if len(first) + len(rest) > self.memo_entries // 2:
            first.age()
            rest.age()
        try:
            lines = [first[w[0]] + b"".join(map(rest.__getitem__, islice(w, 1, None)))
                     for w in (x.split(" ") for x in text.split("\n"))]
            return self._newline.join(lines) + self._end
        except TypeError:  # a piece that is not safe alone
            return b"".join(map(self.whole, _SAFE_CUT.split(text))) + self._end


_LOADED: dict[tuple[str, int], Encoder] = {}
SHARED_ENTRIES = 1_000_000


def loaded(vocabulary: str, end_id: int) -> Encoder:
    """The encoder of this worker process: tasks that follow one another in it
    share the loaded vocabulary and the memo, of more entries."""
    if (vocabulary, end_id) not in _LOADED:
        _LOADED.clear()
        _LOADED[vocabulary, end_id] = Encoder(vocabulary, end_id, SHARED_ENTRIES)
    return _LOADED[vocabulary, end_id]
