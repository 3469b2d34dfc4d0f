"""BPE encoding and decoding by forced boundaries.

A pair of neighbouring bytes that no vocabulary token holds can't lie inside a token, so every encoding has a cut there.
Where that cut is also the end of a word for the tokenizer (seen by encoding the two bytes together and apart), the text
on both sides can be encoded on its own. ASCII white space, which no token holds, gives the first cuts; a fragment that
is not known yet is cut again at the other certain pairs, and only what is new among those is encoded: by the merges as
ranks, or by the tokenizers library where a text needs its normalization. Ids of a text are its fragments' ids in order, whatever its length.

Edge cases: a null text is encoded as an empty one (no ids); texts of any length, repeated rows and an empty table need
nothing special; strings of special tokens in a text become those tokens, as the library has it; pairs inside them count
as held by a token.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Fragments that a worker remembers, and texts that are looked at together.
CACHE, TEXTS = 400_000, 32
END = "</w>"
#: Texts that need no normalization but lower case, and the words of such a text as the tokenizer takes them.
_PLAIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u024f]+")
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _bytes_of_chars() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encodes and decodes whole texts; one for each worker and tokenizer file."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokens = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        alphabet = _bytes_of_chars()
        self.raw = {i: t.encode() if t in self.special else bytes(alphabet[c] for c in t.removesuffix(END)) for i, t in self.tokens.items()}
        self.cuts = self._certain_cuts()
        self.table = np.zeros(65536, bool)
        self.table[[p[0] << 8 | p[1] for p in self.cuts]] = True
        self.merger = self._merger()
        self.names = {i: (str(i).encode(), t.encode()) for i, t in self.tokens.items()}
        #: A fragment's ids in decimal, and its decoded text; void: fragments without ids.
        self.ids_of: dict[bytes, bytes] = {}
        self.text_of: dict[bytes, bytes] = {}
        self.void: set[bytes] = set()

    def _certain_cuts(self) -> set[bytes]:
        held = {t[i : i + 2] for t in self.raw.values() for i in range(len(t) - 1)}
        plain = [p for a in range(33, 127) for b in range(33, 127) if (p := bytes((a, b))).lower() not in held and p not in held]
        ids = lambda x: [e.ids for e in self.tokenizer.encode_batch(x, add_special_tokens=False)]
        # Context on both sides, so that a cut inside a word or a contraction shows.
        wide = [(f"{x}{p[:1].decode()}", f"{p[1:].decode()}{y}") for p in plain for x, y in (("", ""), ("a", "a"), ("1", "1"), (".", "."))]
        whole, left, right = ids([a + b for a, b in wide]), ids([a for a, _ in wide]), ids([b for _, b in wide])
        same = [w == x + y for w, x, y in zip(whole, left, right, strict=True)]
        return {p for i, p in enumerate(plain) if all(same[4 * i : 4 * i + 4])}

    def _merger(self):
        """The merges as ranks of byte strings; a word's end is the byte 255, which UTF-8 never has. None if ids aren't in the order of the merges."""
        n = len(self.raw) - len(self.special)
        ranks = {(r + b"\xff" if self.tokens[i].endswith(END) else r): i for i, r in self.raw.items() if self.tokens[i] not in self.special}
        ends = [self.tokens[i].endswith(END) and len(self.raw[i]) == 1 for i in range(256, 512)]
        if len(ranks) != n or sorted(ranks.values()) != list(range(n)) or not all(ends):
            # The base alphabet has b"\xff" twice over where a vocabulary names that byte: as itself, and as an end.
            return None
        return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def _encode(self, fragment: bytes) -> list[int]:
        text = fragment.decode("utf-8", "surrogatepass")
        if self.merger is None or not _PLAIN.fullmatch(text) or "<|" in text:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if not text.isascii():
            text = "".join([c.lower() for c in text])
        else:
            text = text.lower()
        if text.isascii() and text.isalpha():
            return self.merger.encode_single_piece(text.encode() + b"\xff")
        ids: list[int] = []
        for word in _PIECE.findall(text):
            ids += self.merger.encode_single_piece(word.encode() + b"\xff")
        return ids

    def _put(self, key: bytes, ids: list[int]) -> None:
        if ids:
            names = [self.names[i] for i in ids]
            self.ids_of[key] = b" ".join([n[0] for n in names])
            self.text_of[key] = b" ".join([n[1] for n in names])
        else:
            self.ids_of[key] = self.text_of[key] = b""
            self.void.add(key)

    def _join(self, known: dict[bytes, bytes], parts: list[bytes]) -> bytes:
        if self.void and not self.void.isdisjoint(parts):
            parts = [p for p in parts if p not in self.void]
        return b" ".join(map(known.__getitem__, parts))

    def learn(self, words: list[bytes]) -> None:
        """Cut all words at their certain pairs in one pass; encode what isn't known among the fragments."""
        line = b" ".join(words)
        a = np.frombuffer(line, np.uint8).astype(np.uint16)
        cuts = (np.flatnonzero(self.table[(a[:-1] << 8) | a[1:]]) + 1).tolist()
        known, at, i = self.ids_of, 0, 0
        for word in words:
            end = at + len(word)
            if i < len(cuts) and cuts[i] < end:
                parts = []
                while i < len(cuts) and cuts[i] < end:
                    parts.append(line[at : cuts[i]])
                    at = cuts[i]
                    i += 1
                parts.append(line[at:end])
                for p in parts:
                    if p not in known:
                        self._put(p, self._encode(p))
                ids, text = self._join(self.ids_of, parts), self._join(self.text_of, parts)
                self.ids_of[word], self.text_of[word] = ids, text
                if not ids:
                    self.void.add(word)
            elif word not in known:
                self._put(word, self._encode(word))
            at = end + 1

    def decode(self, ids: list[int]) -> str:
        """As the library's decode(ids, skip_special_tokens=False) where the file has no decoder: tokens joined by one space."""
        return " ".join([self.tokens[i] for i in ids])

    def encode_digests(self, texts: list[str | None]) -> list[tuple[int, bytes, bytes]]:
        """(number of ids, the ids in decimal joined by a space, the decoded text in UTF-8) of each text."""
        split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        if len(self.ids_of) > CACHE:
            self.ids_of, self.text_of, self.void = {}, {}, set()
        if new := set().union(*split).difference(self.ids_of):
            self.learn(list(new))
        out = []
        for words in split:
            ids = self._join(self.ids_of, words)
            out.append((ids.count(b" ") + 1 if ids else 0, ids, self._join(self.text_of, words)))
        return out

    def encode_digest(self, text: str | None) -> tuple[int, bytes, bytes]:
        return self.encode_digests([text])[0]

    def encode(self, text: str | None) -> list[int]:
        return [int(x) for x in self.encode_digest(text)[1].split()]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _map(df: DataFrame, text_col: str, id_col: str, many, schema: str) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            rows = [r for i in range(0, len(texts), TEXTS) for r in many(texts.slice(i, TEXTS).to_pylist())]
            cols = zip(*rows, strict=True) if rows else [[] for _ in names]
            types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), types.get(n, pa.string())) for n, c in zip(names, cols, strict=True))], ["doc_id", *names])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id long, {schema}")


def encode(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids, decoded)."""

    def many(texts: list[str | None]) -> list[tuple]:
        return [([int(x) for x in ids.split()], text.decode()) for _, ids, text in codec(path).encode_digests(texts)]

    return _map(df, text_col, id_col, many, "ids array<int>, decoded string")


def digests(df: DataFrame, path: str | None = None) -> DataFrame:
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def many(texts: list[str | None]) -> list[tuple]:
        return [(n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()) for n, ids, text in codec(path).encode_digests(texts)]

    return _map(df, "text", "doc_id", many, "n_tokens long, ids_sha256 string, decoded_sha256 string")
