"""Token ids by the ``tokenizers`` library, with a bounded per-worker memory of words already encoded."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END_ID = 1
#: Words a worker remembers (some 150 bytes each); beyond it those not used lately go.
MEMORY = 700_000

# A chunk is a run without ASCII white space. The tokenizer drops white space, and no normaliser or pattern of
# it looks across, so a text's ids are its chunks' ids. Letters of ASCII and Latin-1 with only marks after
# them (no apostrophe, which starts contractions) split further: the letters are one word of the model. Added
# tokens are found in the raw text, in the case they have; all begin with ADDED and have letters after it.
WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([^\w\s'\x80-\U0010ffff]|_)*", re.ASCII)
ADDED = b"<|"


def byte_level_table() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level BPE (a rule: printable bytes stand
    for themselves, the others follow from 256 on)."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Encodes batches of UTF-8 texts; equal to ``encode(text, add_special_tokens=False).ids`` of each."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer, self.memory = Tokenizer.from_file(path), memory
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(not t.content.encode().startswith(ADDED) or WORD.fullmatch(t.content) or t.content.split() != [t.content] or t.normalized or t.single_word for t in added):
            raise ValueError("added tokens of another form than <|...|>")
        self.model, self.table = self.tokenizer.model, byte_level_table()
        self.reset()

    def reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.bare: dict[str, bytes] = {}
        self.ids, self.first = array("I"), array("q", [0])
        self.used = np.zeros(self.memory + 1, bool)

    def word(self, word: str) -> bytes:
        got = self.bare.get(word)
        if got is None:
            if len(self.bare) >= self.memory // 2:
                self.bare.clear()
            got = self.bare[word] = array("I", [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.table))]).tobytes()
        return got

    def encode_chunk(self, chunk: str) -> bytes:
        m = WORD.fullmatch(chunk)
        if not m:
            return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        body = m.end(1)
        out = self.word(chunk[:body].lower())
        return out + self.word(chunk[body:]) if body < len(chunk) else out

    def forget(self) -> None:
        """Keep the chunks used since the last time, or none if those are most."""
        keep = np.flatnonzero(self.used[: len(self.known)])
        if len(keep) > 0.7 * self.memory:
            return self.reset()
        flat, first = np.array(self.ids, np.uint32), np.array(self.first, np.int64)
        sizes = first[keep + 1] - first[keep]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        place = dict(zip(keep.tolist(), range(len(keep)), strict=True))
        self.known = {c: place[i] for c, i in self.known.items() if i in place}
        self.ids = array("I", flat[np.repeat(first[keep] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes())
        self.first = array("q", ends.tobytes())
        self.used[:] = False

    def batch(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets): offsets has one more entry than texts. Texts are never cut."""
        parts, sizes = [], []
        lo, size = 0, 0
        for hi, t in enumerate(texts):
            size += len(t)
            if size > 1 << 21 or hi + 1 == len(texts):
                ids, off = self.some(texts[lo : hi + 1])
                parts.append(ids)
                sizes.append(np.diff(off))
                lo, size = hi + 1, 0
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def some(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        known, before, words, bounds = self.known, len(self.known), [], [0]
        for text in texts:
            # ASCII capitals may go first where no combining mark could compose with them and no added token arise
            words += (text if b"\xcc" in text or b"\xcd" in text or ADDED in text else text.lower()).split()
            bounds.append(len(words))
        at = list(map(known.get, words))
        for k in [k for k, i in enumerate(at) if i is None]:
            c = words[k]
            i = known.get(c)
            if i is None:
                i = known[c] = len(self.first) - 1
                self.ids.frombytes(self.encode_chunk(c.decode()))
                self.first.append(len(self.ids))
            at[k] = i
        del words
        places = np.array(at, np.int64)
        flat, first = np.array(self.ids, np.uint32), np.array(self.first, np.int64)
        sizes = first[places + 1] - first[places]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = flat[np.repeat(first[places] - ends[:-1], sizes) + np.arange(ends[-1])]
        if len(known) > len(self.used):
            self.used = np.concatenate([self.used, np.zeros(len(known), bool)])
        self.used[places[places < before]] = True  # seen again after the block that brought it
        if len(known) > self.memory:
            self.forget()
        return out, ends[np.array(bounds)]


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, memory: int = MEMORY) -> WordEncoder:
    """One encoder per Python worker, file and memory."""
    if (path, memory) not in _ENCODERS:
        _ENCODERS[path, memory] = WordEncoder(path, memory)
    return _ENCODERS[path, memory]


def release() -> None:
    """Drop the worker's encoders: a worker that goes on with other work need not keep their words."""
    _ENCODERS.clear()


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each text's ids."""
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))


def texts_of(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
