"""Whole texts to token ids with the tokenizers library, each distinct word encoded once per worker.

Encoding in pieces is exact where no token can cross a piece's edge:

- ``"words"``: the tokenizer drops white space, so every run of other characters stands alone;
- ``"spaced"``: the tokenizer keeps a single space with what follows it. A text is cut before each
  single space and, if the tokenizer parts them too, between letters and marks and around a single
  line end; texts with white space at an end, or beside a space, are encoded whole;
- ``None``: every text is encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import keep

MEMO_WORDS = 1_000_000
# Fixed value: how byte-level vocabularies write a space.
SPACE_MARK = "\u0120"
# Letters that no normal form changes, and marks that end words.
LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", ".,;:!?"
PLAIN, MARKED = re.compile(f"[{LETTERS}]+"), f"([{LETTERS}])([{MARKS}])([\\x20\\x09-\\x0D]|$)"
# White space of any script at an end of a text, or beside a space.
WHITE = "[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
UNEVEN = f"^{WHITE}|{WHITE}$|\\x20{WHITE}|{WHITE}\\x20"
# Marks that part words; an apostrophe is not one, as some endings keep it.
PARTING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
SPACE_BYTE, LINE_END, LATIN = 0x20, 0x0A, 0xC3


def _among(chars: str) -> np.ndarray:
    """A table of bytes, true for those of these characters."""
    table = np.zeros(256, dtype=bool)
    table[list(chars.encode())] = True
    return table


ASCII_LETTERS = _among("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
PARTS, VISIBLE = _among(PARTING), _among("".join(map(chr, range(0x21, 0x7F))))


def _begins(data: np.ndarray, fine: bool) -> np.ndarray:
    """Whether a piece begins at each byte of some UTF-8 texts, but for the texts' own begins."""
    begins = data == SPACE_BYTE
    if not fine or len(data) < 2:
        return begins
    # The letters beyond ASCII that count here are two bytes, of which the first is LATIN.
    lead = data == LATIN
    lead[:-1] &= (data[1:] != 0x97) & (data[1:] != 0xB7)
    first, last = ASCII_LETTERS[data] | lead, ASCII_LETTERS[data]
    last[1:] |= lead[:-1]
    marks, seen = PARTS[data], VISIBLE[data]
    begins[1:] |= (last[:-1] & marks[1:]) | (marks[:-1] & first[1:])
    line = np.flatnonzero((data[1:-1] == LINE_END) & (seen | last)[:-2] & (seen | first)[2:]) + 1
    begins[line] = begins[line + 1] = True
    return begins


def _gathered(known: list[bytes], place: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Ids of texts that consist of ``counts`` pieces each, which lie at ``place`` among the known ones."""
    flat, sizes = np.frombuffer(b"".join(known), dtype="<u4"), np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
    begins, sizes = (np.cumsum(sizes) - sizes)[place], sizes[place]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    ids = flat[np.arange(edges[-1]) + np.repeat(begins - edges[:-1], sizes)].tobytes()
    ends = (4 * edges[np.cumsum(counts)]).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Encodes texts; ``end_id`` closes each of them. Results are ids as little-endian uint32 bytes."""

    def __init__(self, path: str, cut: str | None, end_id: int | None = None, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text in a document.
        self.tokenizer.encode_special_tokens = True
        self.cut, self.memo_words = cut, memo_words
        self.end = b"" if end_id is None else np.uint32(end_id).astype("<u4").tobytes()
        self.memo: dict[bytes | str, bytes] = {}
        self.older: dict[bytes | str, bytes] = {}
        self.begins: np.ndarray | None = None
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes: np.ndarray | None = None
        self.folds: bool | None = None
        self.parts: bool | None = None
        self.fine: bool | None = None

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _each(self, pieces: list[str]) -> list[bytes]:
        if not pieces:
            return []
        coded = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        flat = np.array(coded.ids, dtype="<u4").tobytes()
        counts = np.bincount(np.array(coded.word_ids, dtype=np.int64), minlength=len(pieces))
        ends = (4 * np.cumsum(counts)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _after_space(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word with a space before it, from one encoding of all of them: a token that
        begins with a space begins a word. The words have no white space at their ends."""
        if self.begins is None:
            size = self.tokenizer.get_vocab_size()
            marks = (self.tokenizer.id_to_token(n) or "" for n in range(size))
            self.begins = np.fromiter((mark.startswith(SPACE_MARK) for mark in marks), dtype=bool, count=size)
        text = (b" " + b" ".join(words)).decode()
        coded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        ids = np.array(coded.ids, dtype="<u4")
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(words):
            return self._each([" " + word.decode() for word in words])
        flat, edges = ids.tobytes(), (4 * starts).tolist()
        return [flat[a:b] for a, b in zip(edges, [*edges[1:], len(flat)])]

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of each word, from one encoding of all of them: a word of letters closes with one token. If
        the tokenizer parts them otherwise, each word is encoded alone."""
        if self.closes is None:
            size = self.tokenizer.get_vocab_size()
            names = (self.tokenizer.id_to_token(n) or "" for n in range(size))
            self.closes = np.fromiter((name.endswith(self.suffix) for name in names), dtype=bool, count=size)
        coded = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(coded.ids, dtype="<u4")
        closing = np.flatnonzero(self.closes[ids])
        if len(closing) != len(words):
            return self._each(words)
        flat, ends = ids.tobytes(), (4 * (closing + 1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _alone(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words that white space parts from all else, with their ids."""
        plain = [word for word in words if PLAIN.fullmatch(word)] if self.suffix else []
        if plain:
            yield from zip(plain, self._plain(plain))
        other = list(set(words).difference(plain))
        yield from zip(other, self._each(other))

    def _of_texts(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Pieces of even texts, with their ids."""
        spaced = [piece for piece in pieces if piece[0] == SPACE_BYTE]
        if spaced:
            yield from zip(spaced, self._after_space([piece[1:] for piece in spaced]))
        other = [piece for piece in pieces if piece[0] != SPACE_BYTE]
        yield from zip(other, self._each([piece.decode() for piece in other]))

    def _learn(self, words: set[bytes] | set[str], coded: Callable[[list], Iterator[tuple]]) -> None:
        """Encodes the words that are new. A full half of the memo becomes the older one, from which
        words in use come back; the older one before it is forgotten."""
        if 2 * len(self.memo) > self.memo_words:
            self.memo, self.older = {}, self.memo
        missing = words.difference(self.memo)
        if self.older:
            back = missing.intersection(self.older)
            self.memo.update(zip(back, map(self.older.__getitem__, back)))
            missing -= back
        new = list(missing)
        for at in range(0, len(new), 4096):
            self.memo.update(coded(new[at : at + 4096]))

    def _same(self, pairs: list[tuple[str, str]]) -> bool:
        return all(self._whole(one) == self._whole(other) for one, other in pairs)

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, gathered from those of its words; each distinct word is looked up once. If the
        tokenizer folds letters, or parts a mark from a letter before it, that is done first, so that
        fewer words are distinct."""
        if self.folds is None:
            letters = [chr(n) for n in range(256) if PLAIN.fullmatch(chr(n))]
            self.folds = self._same([(c, c.lower()) for c in letters if c.isascii()])
            self.parts = self._same([(c + mark, f"{c} {mark}") for c in letters for mark in MARKS])
        rows = pa.array(texts, pa.string())
        rows = pc.ascii_lower(rows) if self.folds else rows
        rows = pc.replace_substring_regex(rows, MARKED, r"\1 \2\3") if self.parts else rows
        split = pc.ascii_split_whitespace(rows)
        words = split.flatten().dictionary_encode()
        names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(set(names), self._alone)
        known = list(map(self.memo.__getitem__, names))
        return _gathered(known, words.indices.to_numpy(), split.value_lengths().to_numpy())

    def _parts_finely(self) -> bool:
        """Whether the tokenizer itself parts what a fine cut parts."""
        split, letters = self.tokenizer.pre_tokenizer, [chr(n) for n in range(256) if PLAIN.fullmatch(chr(n))]
        if split is None or self.tokenizer.normalizer is not None:
            return False

        def spans(text: str) -> list[tuple[int, int]]:
            return [span for _, span in split.pre_tokenize_str(text)]

        cases = [(a, b) for a in letters for b in PARTING]
        return all(spans(f"{a}{a}{b}{a}\n{b}\n{a}") == [(0, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 8)] for a, b in cases)

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, gathered from those of its pieces; each distinct piece is looked up once."""
        if self.fine is None:
            self.fine = self._parts_finely()
        rows = pa.array(texts, pa.string())
        uneven = pc.match_substring_regex(rows, UNEVEN).to_numpy(zero_copy_only=False)
        even = rows.filter(pa.array(~uneven))
        out = [b"" if odd else None for odd in uneven]
        for at in np.flatnonzero(uneven).tolist():
            out[at] = self._whole(texts[at])
        ends = np.frombuffer(even.buffers()[1], dtype=np.int32)[even.offset : even.offset + len(even) + 1]
        if not len(even) or ends[-1] == ends[0]:
            return [ids or b"" for ids in out]
        data = np.frombuffer(even.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
        ends = ends[1:] - ends[0]
        begins = _begins(data, self.fine)
        begins[0] = True
        begins[ends[ends < len(data)]] = True
        edges = np.append(np.flatnonzero(begins), len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(set(names), self._of_texts)
        counts = np.diff(np.searchsorted(edges, ends), prepend=0)
        found = iter(_gathered(list(map(self.memo.__getitem__, names)), pieces.indices.to_numpy(), counts))
        return [next(found) if ids is None else ids for ids in out]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, null as empty, with the end id. Takes a slice of a batch at a time."""
        texts = [text or "" for text in texts]
        if self.cut == "words":
            return [ids + self.end for ids in self._by_words(texts)] if texts else []
        if self.cut is None:
            return [self._whole(text) + self.end for text in texts]
        return [ids + self.end for ids in self._by_pieces(texts)] if texts else []


def encoder(path: str, cut: str | None, end_id: int | None, memo_words: int = MEMO_WORDS) -> Encoder:
    """The worker's encoder; a worker keeps it, and what it has learned, for later tasks of its kind."""
    key = path, cut, end_id, memo_words
    return keep(("encoder", *key), lambda: Encoder(*key))


def public_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
