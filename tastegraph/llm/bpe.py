"""Operator 12: BPE encoding and decoding, long unsplit text by tree concatenation.

The vocabulary is one whose pre-tokeniser drops white space, as those with
marked word ends do, so a text may be cut at blanks and its words encoded one
by one.  Words repeat: a worker process keeps a bounded memo of them.

A *run* is a piece that the pre-tokeniser leaves whole.  Runs of more than
``PIECE`` byte letters are cut into halves of halves down to that size; the
leaves are encoded in parallel and joined pairwise, level by level, in Spark.
A leaf ends with a word end that the run does not have there, and merges may
cross a cut, so a join encodes a window around it anew and lets it grow until
the window and either side have one token in common: same id, same place.
Byte pairs are merged by rank alone, so a sequence of tokens is the encoding
of a string if and only if every two neighbours are the encoding of their own
concatenation.  Left of the shared token the pairs are those of the left side,
between them those of the window, and right of it those of the right side;
hence the join equals the encoding of the whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import materialize, slices

#: Byte letters of a leaf of the tree.
PIECE = 4096
#: Byte letters that the first window takes on either side of a cut.
WINDOW = 32

_BLANK = re.compile(r"[ \n]+")
_PLAIN = re.compile(r"[!-~À-ÿ]+")
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the
    others as the characters from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo(dict):
    """A bounded memo in two generations: what was used since the last
    ``age()`` stays."""

    def __init__(self, make):
        super().__init__()
        self._make, self._old = make, {}

    def age(self) -> None:
        self._old = dict(self)
        self.clear()

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        self[key] = value
        return value


class Bpe:
    """One vocabulary, loaded once per worker process (:func:`loaded`)."""

    MEMO_ENTRIES = 150_000

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(vocabulary)
        self._tok.no_truncation()
        self._tok.no_padding()
        self._model, self._letters = self._tok.model, _byte_letters()
        self._added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._plain_decode = self._tok.decoder is None
        self._end = self._model.end_of_word_suffix or ""
        self.names = {i: t for t, i in self._tok.get_vocab(with_added_tokens=True).items()}
        self._words, self._pieces = _Memo(self._word), _Memo(self._piece)
        self._words[""] = b""

    # -- words

    def _whole(self, text: str) -> bytes:
        return array("I", self._tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self._letters)
        return self.run(piece).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word between blanks.  Printable ASCII and Latin-1 letters
        need no normal form, have one lower case each and are split here; any
        other word, and one with an added token, goes through the library."""
        if _PLAIN.fullmatch(word) and not any(t in word for t in self._added):
            return b"".join([self._pieces[p] for p in _SPLIT.findall(word.lower())])
        return self._whole(word)

    def encode(self, text: str | None) -> bytes | None:
        """Little-endian unsigned 32-bit ids of the text (null: empty), or
        None if it has a run of more than ``PIECE`` letters."""
        if not text:
            return b""
        words, memo = text.replace("\n", " ").split(" "), self._words
        if len(memo) > self.MEMO_ENTRIES:
            memo.age()
            self._pieces.age()
        if len(text) > PIECE // 4 and max(map(len, words)) > PIECE // 4:  # a character has up to four byte letters
            if any(len(r) > PIECE for w in words if len(w) > PIECE // 4 for r in self.runs(w) if isinstance(r, str)):
                return None
            return b"".join([self._whole(w) if len(w) > PIECE // 4 else memo[w] for w in words])
        return b"".join(map(memo.__getitem__, words))

    def decode(self, ids: bytes) -> str:
        ids = np.frombuffer(ids, np.uint32).tolist()
        if self._plain_decode:
            try:
                return " ".join(map(self.names.__getitem__, ids))
            except KeyError:  # ids that no token has are left out
                return " ".join(self.names[i] for i in ids if i in self.names)
        return self._tok.decode(ids, skip_special_tokens=False)

    # -- long runs

    def runs(self, word: str) -> Iterator[str | bytes]:
        """The pieces of a word as the pre-tokeniser leaves them, in byte
        letters; an added token comes as its id."""
        cut = re.split("(" + "|".join(map(re.escape, self._added)) + ")", word) if self._added else [word]
        for i, part in enumerate(cut):
            if i % 2:
                yield array("I", [self._tok.token_to_id(part)]).tobytes()
            else:
                for run, _ in self._tok.pre_tokenizer.pre_tokenize_str(self._tok.normalizer.normalize_str(part)):
                    yield run

    def parts(self, text: str) -> list[tuple[bytes | None, str | None]]:
        """The text as ids of what is short and runs that are long, in order."""
        out, held = [], []
        for word in _BLANK.split(text):
            if len(word) <= PIECE // 4:
                held.append(self._words[word])
                continue
            for run in self.runs(word):
                if isinstance(run, bytes):
                    held.append(run)
                elif len(run) <= PIECE:
                    held.append(self.run(run).tobytes())
                else:
                    out += [(b"".join(held), None), (None, run)]
                    held = []
        return [*out, (b"".join(held), None)]

    def run(self, run: str) -> np.ndarray:
        return np.array([t.id for t in self._model.tokenize(run)], np.uint32)

    def _ends(self, ids: np.ndarray) -> np.ndarray:
        """Where tokens end in a run; the word end itself has no letter."""
        n = [len(x) - len(self._end) * (x.endswith(self._end) if self._end else 0) for x in map(self.names.__getitem__, ids.tolist())]
        return np.cumsum(n, dtype=np.int64)

    def join(self, a: str, a_ids: np.ndarray, b: str, b_ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """The encoding of ``a + b`` from those of both (see the module)."""
        a_end, b_end = self._ends(a_ids), self._ends(b_ids)
        a_at = {(int(e - n), int(i)): k for k, (e, n, i) in enumerate(zip(a_end, np.diff(a_end, prepend=0), a_ids))}
        a_at = {k: v for k, v in a_at.items() if v < len(a_ids) - 1}  # its last token has a word end too many
        b_at = {(int(e - n) + len(a), int(i)): k for k, (e, n, i) in enumerate(zip(b_end, np.diff(b_end, prepend=0), b_ids))}
        while True:
            lo, hi = max(0, len(a) - window), min(len(b), window)
            if lo:  # from the start of a token
                k = int(np.searchsorted(a_end, lo, "right")) - 1
                lo = int(a_end[k]) if k >= 0 else 0
            ids = self.run(a[lo:] + b[:hi])
            start = np.concatenate([[0], self._ends(ids)[:-1]]) + lo
            keys = list(zip(start.tolist(), ids.tolist()))
            left = (-1, -1) if lo == 0 else next(((j, a_at[x]) for j, x in enumerate(keys) if x in a_at), None)
            inner = keys if hi == len(b) else keys[:-1]  # a window's last token has a word end too many
            right = next(((j, b_at[x]) for j, x in enumerate(inner) if x in b_at), (len(ids), len(b_ids)) if hi == len(b) else None)
            if left and right:
                return np.concatenate([a_ids[:left[1] + 1], ids[left[0] + 1:right[0]], b_ids[right[1]:]])
            window *= 2


_LOADED: dict[str, Bpe] = {}


def loaded(vocabulary: str) -> Bpe:
    """The vocabulary of this worker process, with its memo."""
    if vocabulary not in _LOADED:
        _LOADED.clear()
        _LOADED[vocabulary] = Bpe(vocabulary)
    return _LOADED[vocabulary]


def _type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def _short(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids of every text without a long run; other ids are null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for b in slices(batches):
            yield pa.record_batch([b.column(0), pa.array(map(bpe.encode, b.column(1).to_pylist()), pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {_type(docs, 'doc_id')}, ids binary")


def encode_runs(runs: DataFrame, vocabulary: str) -> DataFrame:
    """``(key, ids)`` of the distinct long runs ``(key, run)``."""
    leaves = F.transform(F.sequence(F.lit(0), F.ceil(F.length("run") / PIECE).cast("int") - 1),
                         lambda i: F.substring(F.col("run"), i * PIECE + 1, F.lit(PIECE)))

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for b in slices(batches):
            ids = pa.array([bpe.run(x).tobytes() for x in b.column("run").to_pylist()], pa.binary())
            yield pa.record_batch([*b.columns, ids], names=["key", "at", "run", "ids"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for b in slices(batches, 16):
            texts, ids = [], []
            for a, ia, c, ic in zip(*(b.column(n).to_pylist() for n in ("run", "ids", "run2", "ids2"))):
                if c is not None:
                    ia = bpe.join(a, np.frombuffer(ia, np.uint32), c, np.frombuffer(ic, np.uint32)).tobytes()
                texts.append(a + (c or ""))
                ids.append(ia)
            yield pa.record_batch([b.column("key"), b.column("at"), pa.array(texts, pa.string()), pa.array(ids, pa.binary())],
                                  names=["key", "at", "run", "ids"])

    schema = "key binary, at int, run string, ids binary"
    nodes = runs.select("key", F.posexplode(leaves).alias("at", "run")).repartition("key", "at").mapInArrow(leaf, schema)
    nodes = materialize(nodes, "bpe-leaves")
    while (nodes.agg(F.max("at")).first()[0] or 0) > 0:  # log2 of the leaves of the longest run
        halves = nodes.select("key", F.shiftright("at", 1).alias("up"), F.col("at").bitwiseAND(1).alias("side"), "run", "ids")
        left = halves.filter("side = 0").select("key", F.col("up").alias("at"), "run", "ids")
        right = halves.filter("side = 1").select("key", F.col("up").alias("at"), F.col("run").alias("run2"), F.col("ids").alias("ids2"))
        nodes = materialize(left.join(right, ["key", "at"], "left").mapInArrow(join, schema), "bpe-level")
    return nodes.select("key", "ids")


def _long(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids of those texts that have a long run.  Equal texts and equal
    runs are encoded once."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for b in slices(batches, 16):
            rows = [(d, i, ids, run) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for i, (ids, run) in enumerate(bpe.parts(t))]
            kinds = [pa.binary(), pa.int32(), pa.binary(), pa.string()]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["digest", "seq", "ids", "run"])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 16):
            whole = [b"".join(x["ids"] for x in sorted(p, key=lambda x: x["seq"])) for p in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(whole, pa.binary())], names=["digest", "ids"])

    digest = F.unhex(F.sha2("text", 256))
    texts = docs.select(digest.alias("digest"), "text").groupBy("digest").agg(F.first("text").alias("text"))
    parts = materialize(texts.mapInArrow(cut, "digest binary, seq int, ids binary, run string"), "bpe-parts")
    key = F.unhex(F.sha2("run", 256))
    runs = parts.filter("run is not null").groupBy(key.alias("key")).agg(F.first("run").alias("run"))
    done = parts.filter("run is null").select("digest", "seq", "ids", F.lit(False).alias("long")).unionByName(
        parts.filter("run is not null").select("digest", "seq", key.alias("key")).join(encode_runs(runs, vocabulary), "key")
        .select("digest", "seq", "ids", F.lit(True).alias("long")))
    whole = (done.groupBy("digest").agg(F.collect_list(F.struct("seq", "ids")).alias("parts"), F.max("long").alias("long"))
             .filter("long").select("digest", "parts"))
    return (docs.select("doc_id", digest.alias("digest")).join(whole.mapInArrow(stitch, "digest binary, ids binary"), "digest")
            .select("doc_id", "ids"))


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, ids)`` for every row: the ids (little-endian unsigned 32-bit)
    that the tokenizers library gives for the whole text without special
    tokens of its own.  A null text counts as empty, a null doc_id and
    repeated rows are kept, other columns are ignored, and an empty table
    gives no rows."""
    docs = docs.select("doc_id", "text")
    # runs of more than PIECE byte letters need a word of more than a quarter as many characters
    long_word = F.coalesce((F.length("text") > PIECE // 4) & F.col("text").rlike(f"(?<![^ \n])[^ \n]{{{PIECE // 4 + 1}}}"), F.lit(False))
    suspects = docs.filter(long_word)
    if suspects.limit(1).count() == 0:
        return _short(docs, vocabulary)
    return _short(docs, vocabulary).filter("ids is not null").unionByName(_long(suspects, vocabulary))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, ids, text)``: what the library's ``decode`` with special
    tokens kept gives for ``(doc_id, ids)``; null ids count as none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for b in slices(batches):
            texts = [bpe.decode(x or b"") for x in b.column(1).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {_type(encoded, 'doc_id')}, ids binary, text string")
