"""Token ids of whole texts, by the tokenizers library.

The vocabulary drops white space and never joins across it, so a text's ids
are those of its white-space-separated chunks one after another. Chunks
repeat: each worker keeps a bounded memory of chunk -> packed ids and asks
the library only for new ones. A chunk of letters and closing punctuation is
looked up as these two, which the vocabulary's own splitting separates.
Encoder.flat() takes many texts at once: it cuts chunks into such pieces
beforehand and looks up each distinct piece once.
"""

from __future__ import annotations

import re
import zlib

import numpy as np

from vireo.llm.common import only_memory

VOCABULARY = "word_bpe_49k.json"
END = 1
#: Chunks, and words, that a generation of a worker's memory holds unless told otherwise; there are two
#: generations of each. An entry takes some 150 bytes, so this bounds a worker's memory at 300 MB. The
#: pieces of flat() stand for both, twice as many a generation; words then come from odd chunks only.
REMEMBERED = 500_000
#: Chunks over this many characters are encoded without being remembered.
LONG = 64
#: Python splits at these controls too; the vocabulary takes them for characters.
CONTROLS = "\x1c\x1d\x1e\x1f"


class Chunks(dict):
    """chunk -> packed ids; what is missing is looked up in the last generation or encoded."""

    def __init__(self, encode, old: dict[str, bytes]):
        self.encode, self.old = encode, old

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) <= LONG:
            self[chunk] = ids
        return ids


class Encoder:
    """ids(text) -> little-endian unsigned 16-bit (or 32-bit) ids as bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.remembered = remembered
        self.library = Tokenizer.from_file(path)
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = f"<u{self.width}"
        self.plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)").fullmatch
        self.chunks = Chunks(self._chunk, {})
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        # The shortcut holds only if the vocabulary lowers case and splits words from punctuation.
        self.splits = all(self._ask([a]) == self._ask(b) for a, b in (("Ab.", ["ab", "."]), ("É,))", ["é", ",))"]), ("x'", ["x", "'"]), ("a\u3000b\x85c\xa0d", ["a", "b", "c", "d"])))
        # A lower-case word needs neither normalising nor splitting; its bytes, written as
        # the byte-level alphabet writes them, go to the vocabulary's model.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.model = self.library.model
        self.packed = [i.to_bytes(self.width, "little") for i in range(1 + max(self.library.get_vocab(with_added_tokens=True).values()))]
        self.direct = self.splits and all(self._word(w) == self._ask([w]) for w in ("token", "étéßñ", "zàüö", "y"))
        # Pieces take the place of chunks and words, so a generation holds as many as both.
        self.lower = re.compile("[a-zß-öø-ÿ]+").fullmatch
        self.pieces = Chunks(self._piece, {})
        self.apart = self.direct and all(self._ask([a]) == self._ask(b) for a, b in (("Ab,Éd", ["ab", ",", "éd"]), ("a12.b", ["a", "12.", "b"]), ("-x_1", ["-", "x", "_1"])))

    def _ask(self, texts: list[str]) -> bytes:
        return b"".join(self._pack(texts))

    def _pack(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype=self.dtype).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.alphabet)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(word)])

    def _chunk(self, chunk: str) -> bytes:
        m = self.plain(chunk) if self.direct else None
        if m is None:
            return self._ask([chunk])
        word, tail = m[1].lower(), m[2]
        words = self.words
        ids = words.get(word)
        if ids is None:
            ids = self.old_words.get(word) or self._word(word)
            words[word] = ids
        if tail:
            marks = words.get(tail)
            if marks is None:
                marks = words[tail] = self._ask([tail])
            ids += marks
        return ids

    def _rotate(self) -> None:
        """What a full generation has and the next one does not ask for is forgotten."""
        if len(self.chunks) > self.remembered:
            self.chunks.old = {}
            self.chunks = Chunks(self._chunk, self.chunks)
        if len(self.pieces) > 2 * self.remembered:
            self.pieces.old = {}
            self.pieces = Chunks(self._piece, self.pieces)
        if len(self.words) > self.remembered:
            self.words, self.old_words = {}, self.words

    def _piece(self, piece: str) -> bytes:
        return self._word(piece) if self.lower(piece) else self._chunk(piece)

    def _split(self, text: str) -> list[str]:
        if not self.splits or any(c in text for c in CONTROLS):
            return re.split("[ \t\n\r]+", text)
        return text.split()

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; a null text has none."""
        out = []
        for at in range(0, len(texts), 256):
            self._rotate()
            get = self.chunks.__getitem__
            out += [b"".join(map(get, self._split(t))) if t else b"" for t in texts[at : at + 256]]
        return out

    def flat(self, texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of texts, each followed by the end id, in one array, and where each text's ids end.

        Arrow numbers the distinct pieces of all texts, so that a piece is looked up
        once a call however often it occurs; its ids are then taken by number.
        """
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        if not self.apart:
            packs = self.batch(texts.to_pylist())
            ids, ends = np.frombuffer(b"".join(packs), dtype=self.dtype), np.cumsum([len(x) // self.width for x in packs])
        else:
            self._rotate()
            pieces, until = split_pieces(texts)
            coded = pieces.dictionary_encode()
            packs = list(map(self.pieces.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))
            lengths = np.fromiter(map(len, packs), np.int64, len(packs)) // self.width
            known, begins = np.frombuffer(b"".join(packs), dtype=self.dtype), np.cumsum(lengths) - lengths
            piece = coded.indices.to_numpy()
            n = lengths[piece]
            stops = np.cumsum(n)
            ids = known[np.repeat(begins[piece] - (stops - n), n) + np.arange(stops[-1] if len(stops) else 0)]
            ends = np.concatenate([[0], stops])[until]
        return np.insert(ids, ends, end), ends + np.arange(1, len(ends) + 1)


SPACE, LETTER, MARK, OTHER = range(4)


def byte_kinds() -> np.ndarray:
    """What each byte is. Apostrophes and < may join what stands around them, so they are OTHER, as are bytes beyond ASCII."""
    kinds = np.full(256, OTHER, np.uint8)
    kinds[33:127] = MARK
    kinds[[ord("'"), ord("<")]] = OTHER
    kinds[[32, *range(9, 14)]] = SPACE
    kinds[[*range(65, 91), *range(97, 123)]] = LETTER
    return kinds


def split_pieces(texts) -> tuple:
    """The pieces of an Arrow array of texts (no nulls) that the vocabulary encodes apart, and how many there are up to each text's end.

    Pieces are the runs of letters (ASCII and À to ÿ, in lower case) and of other
    ASCII characters; a chunk between white space that holds anything else is one piece as it is.
    """
    import pyarrow as pa

    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, int)
    data = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(texts), int)
    kind, low = byte_kinds()[data], data.copy()
    low[(data >= 65) & (data <= 90)] |= 32
    lead = np.flatnonzero(data[:-1] == 0xC3)
    two = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[two] = kind[two + 1] = LETTER
    low[two[data[two + 1] < 0x9F] + 1] |= 32
    kept = kind != SPACE
    first = at[:-1][np.diff(at) > 0]
    begins = kept.copy()
    begins[1:] &= ~kept[:-1]
    begins[first] = kept[first]
    change = begins.copy()
    change[1:] |= (kind[1:] != kind[:-1]) & kept[1:]
    odd = np.flatnonzero(kind == OTHER)
    if len(odd):
        chunks = np.flatnonzero(begins)
        holds = np.zeros(len(chunks) + 1, bool)
        holds[np.searchsorted(chunks, odd, "right")] = True
        inside = np.repeat(holds, np.diff(chunks, prepend=0, append=len(data)))
        change &= begins | ~inside
        np.copyto(low, data, where=inside)
    starts, chars = np.flatnonzero(change[kept]), low[kept]
    ends = np.append(starts, len(chars)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(chars)]), np.searchsorted(np.flatnonzero(change), at[1:])


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """This worker's encoder, kept from task to task."""
    return only_memory(f"encoder {path} {remembered}", lambda: Encoder(path, remembered))


def with_end(packed: bytes, width: int, end: int = END) -> np.ndarray:
    """The ids and the end id as little-endian unsigned 32-bit integers."""
    ids = np.empty(len(packed) // width + 1, dtype="<u4")
    ids[:-1] = np.frombuffer(packed, dtype=f"<u{width}")
    ids[-1] = end
    return ids


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def vocabulary(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)
