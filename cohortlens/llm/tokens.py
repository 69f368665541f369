"""Token ids of a public tokenizer, whole texts, inside Arrow tasks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_OF_TEXT = 0  # the id after each document
ID_BYTES = 4
CACHED = 500_000  # distinct words whose ids a worker remembers
CACHED_BYTES = 64  # of longer ones none
BLOCK_DOCS = 128  # documents whose unknown words are encoded together
BLOCK_BYTES = 2 << 20  # longer blocks and texts are encoded in parts
WORD_END = "</w>"
SPACE = re.compile(rb"[\x20\x09-\x0D]")
# ASCII marks: those after a word are one more word to the tokenizer. Apostrophes, which can be part of either, are not here.
MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")


class Encoder:
    """Texts -> little-endian unsigned 32-bit ids.

    This tokenizer lower-cases, drops white space and never joins what it separates. Texts are cut at ASCII white
    space, the ids of words that come again are remembered, and new words of letters are encoded many at a time, apart
    from the marks that follow them; the last id of each is one that ends a word. Strings of special tokens are ordinary text, or with ``special`` what the
    tokenizer makes of them by default: texts that hold one are left to it.
    """

    def __init__(self, path: str = TOKENIZER, special: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder().values() if special else ()
        self.special = [token.content.encode() for token in added if token.special]
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known: dict[bytes, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def with_special(self, text: str) -> bytes:
        self.tokenizer.encode_special_tokens = False
        try:
            return self.ids(text).tobytes()
        finally:
            self.tokenizer.encode_special_tokens = True

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of words that are too long to be remembered; those of all others are, from now on."""
        letters, marked, odd = {}, [], {}
        for word in words:
            stem = word.rstrip(MARKS)
            if len(word) > CACHED_BYTES or not (stem.isalpha() or stem.decode().lower().isalpha()):
                odd[word] = self.ids(word.decode()).tobytes()
                continue
            if stem not in self.known:
                letters[stem] = None
            if len(stem) < len(word):
                marked.append((word, stem))
        if letters:
            ids = self.ids(b" ".join(letters).decode())
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * ID_BYTES
            if len(ends) == len(letters):  # each has at least one, so exactly one
                data, ends = ids.tobytes(), ends.tolist()
                self.known.update(zip(letters, [data[at:end] for at, end in zip([0, *ends], ends)]))
            else:  # the tokenizer's own normalisation can be more than letters
                self.known.update((stem, self.ids(stem.decode()).tobytes()) for stem in letters)
        for word, stem in marked:
            mark = word[len(stem) :]
            if mark not in self.known:
                self.known[mark] = self.ids(mark.decode()).tobytes()
            self.known[word] = self.known[stem] + self.known[mark]
        self.known.update((word, ids) for word, ids in odd.items() if len(word) <= CACHED_BYTES)
        return {word: ids for word, ids in odd.items() if len(word) > CACHED_BYTES}

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of texts that are short enough to be taken together."""
        if len(self.known) > CACHED:
            self.known.clear()
        whole = {i for i, text in enumerate(texts) if any(token in text for token in self.special)}
        block = [[] if i in whole else text.lower().split() for i, text in enumerate(texts)]
        new = set().union(*block).difference(self.known)
        long = self.learn(new) if new else {}
        self.known.update(long)
        try:
            for i, words in enumerate(block):
                yield self.with_special(texts[i].decode()) if i in whole else b"".join(map(self.known.__getitem__, words))
        finally:
            for word in long:
                del self.known[word]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = TOKENIZER) -> Encoder:
    """One for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, special=True)
    return _ENCODERS[path]


def encoded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[tuple[object, bytes]]:
    """(doc_id, ids) of each row of batches of doc_id and the text as binary, null as empty; an end of text after each."""
    encode, end = encoder(path).encode, END_OF_TEXT.to_bytes(ID_BYTES, "little")
    for batch in batches:
        for at in range(0, len(batch), BLOCK_DOCS):
            part = batch.slice(at, BLOCK_DOCS)
            texts = [text or b"" for text in part.column(1).to_pylist()]
            if sum(map(len, texts)) <= BLOCK_BYTES:
                ids = encode(texts)
            else:
                ids = (b"".join(ids for piece in pieces(text) for ids in encode([piece])) for text in texts)
            for doc_id, own in zip(part.column(0).to_pylist(), ids, strict=True):
                yield doc_id, own + end


def pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end at white space, where there is some."""
    at = 0
    while at < len(text):
        border = SPACE.search(text, at + BLOCK_BYTES)
        end = border.start() if border else len(text)
        yield text[at:end]
        at = end


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(piece, start, ids) of a document; only documents beyond the capacity are cut."""
    step = capacity * ID_BYTES
    for piece, at in enumerate(range(0, len(ids), step)):
        yield piece, piece * capacity, ids[at : at + step]
