"""Texts to token ids, with the work of the tokenizer done once for each distinct piece of a text."""

from __future__ import annotations

import base64
import os
import re
from array import array
from codecs import charmap_decode
from functools import cache

import numpy as np
import pyarrow as pa

from tidemark.llm import words as w

KEPT = 400_000  # pieces whose ids a Python worker remembers

# Bytes that the tokenizer always cuts off a neighbouring letter or digit. An apostrophe and the signs of
# special tokens (<|name|>) are not among them.
MARKS = b".,;:!?$%&#*"

UINT32 = "I" if array("I").itemsize == 4 else "L"

KIND = np.zeros(256, dtype=np.uint8)
KIND[w.SPACE] = 1
KIND[list(MARKS)] = 2
KIND[48:58] = KIND[65:91] = KIND[97:123] = 3
# Of the kind of a byte plus four times that of the byte before it: whether a piece begins.
BEGINS = np.zeros(16, dtype=bool)
BEGINS[[4, 6, 7, 2 * 4 + 3, 3 * 4 + 2]] = True

# Letters that normalisation leaves as they are, next to each other as well, and that nothing cuts.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
IS_WORD = re.compile(rb"(?:[a-z]|\xC3[\x9F-\xB6\xB8-\xBF])+").fullmatch
MARK = "~"  # stands alone between pieces that are encoded as one text
TOGETHER = 256  # pieces in such a text


class WordTokenizer:
    """A tokenizer of the tokenizers library that drops white space, takes punctuation apart from words and has a BPE of bytes.

    For such a tokenizer the ids of a text are those of its pieces: a text is cut at white space, and between a letter
    or digit and one of MARKS. A-Z is lower-cased first where the tokenizer does so and nothing can combine with the
    letter; without that only more pieces would be distinct.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        # the character that stands for each byte of LETTERS in the vocabulary, as the tokenizer itself says
        [(shown, _)] = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(LETTERS))
        of_byte = dict(zip(LETTERS.encode(), shown, strict=True))
        self.shown = "".join(of_byte.get(b, "\ufffe") for b in range(256))
        [self.mark] = self.tokenizer.encode(MARK, add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and how many each text has."""
        data, offsets = w.text_bytes(texts)
        kind = KIND[data]
        keep = kind != 1
        kind[1:] += kind[:-1] << 2
        begins = BEGINS[kind]
        first = offsets[:-1][offsets[:-1] < len(data)]
        begins[first] = keep[first]
        if b"<|" not in data.tobytes():
            before_others = np.flatnonzero(data[1:] >= 128)
            data, given = w.LOWER[data], data
            data[before_others] = given[before_others]
        found, counts = w.pieces(data, offsets, begins, keep)
        numbers, distinct = w.coded(found)
        ids = pa.array(self._distinct(w.listed(distinct)), pa.large_binary()).take(pa.array(numbers))
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) // 4 if len(ids) else np.zeros(1, np.int64)
        flat = np.frombuffer(ids.buffers()[2] or b"", np.uint32, ends[-1]) if len(ids) else np.zeros(0, np.uint32)
        return flat, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def _distinct(self, pieces: list[bytes]) -> list[bytes]:
        known, tokenize, rest = self.known, self.tokenizer.model.tokenize, []
        if len(known) > KEPT:
            known.clear()
        ids = list(map(known.get, pieces))
        for i in [i for i, x in enumerate(ids) if x is None]:
            p = pieces[i]
            if p.isalpha() and p.islower():  # of ASCII letters
                known[p] = ids[i] = array(UINT32, [t.id for t in tokenize(p.decode())]).tobytes()
            elif IS_WORD(p):
                shown = charmap_decode(p, "strict", self.shown)[0]
                known[p] = ids[i] = array(UINT32, [t.id for t in tokenize(shown)]).tobytes()
            else:
                rest.append(i)
        for i, found in zip(rest, self._rest([pieces[i] for i in rest]), strict=True):
            known[pieces[i]] = ids[i] = found
        return ids

    def _rest(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of any pieces, many in one text, with MARK after each; its id tells them apart."""
        after = f" {MARK} ".encode()
        texts = [after.join([*pieces[at : at + TOGETHER], b""]).decode() for at in range(0, len(pieces), TOGETHER)]
        out = []
        for at, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            own, ids = pieces[at * TOGETHER : (at + 1) * TOGETHER], array(UINT32, e.ids)
            ends = np.flatnonzero(np.frombuffer(ids, np.uint32) == self.mark).tolist()
            if len(ends) == len(own):
                data = ids.tobytes()
                out += [data[4 * a : 4 * b] for a, b in zip([0, *[b + 1 for b in ends]], ends)]
            else:  # a piece has the same id in itself
                alone = self.tokenizer.encode_batch_fast([p.decode() for p in own], add_special_tokens=False)
                out += [array(UINT32, x.ids).tobytes() for x in alone]
        return out


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


@cache
def byte_tokenizer(path: str):
    """A byte-level encoding of the tiktoken library from a file of ranks."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
