"""Token ids of whole texts from a public tokenizer's file.

``ChunkEncoder``, for tokenizers that drop white space, has the library encode every
distinct chunk once per process, many in one call's text; a text's ids are those of its
chunks in a row.  Texts are cut only where the tokenizer's own splitting always cuts.
``ByteEncoder``, for byte-level
ones, has a faster library merge by the same file's ranks.  The ids equal those that the
file's own library gives whole texts, which the tests check.
"""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata
from itertools import chain, compress, repeat
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfmark.llm.common import ragged

REMEMBERED = 1_000_000  # chunks, after which a process starts anew
TOGETHER = 100  # chunks encoded as one text
BETWEEN = "!"  # stands between them
MARKS = string.punctuation  # what no letter composes with
PROBE = "naïve страница 漢字"

# How byte-level tokenizers split texts before merging; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[tuple[str, str], ChunkEncoder | ByteEncoder] = {}


def word_chunks(texts: list[str]) -> pa.Array:
    """For tokenizers that drop white space: cut at spaces and line ends."""
    return pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")


def plain_word(chunk: str) -> str:
    """The word as composing and lowering leave it, or nothing unless it then is of letters
    alone: some letters fall into a letter and a mark, which belongs to marks behind it."""
    if not chunk.isalpha():
        return ""
    if chunk.isascii():
        return chunk.lower()
    word = unicodedata.normalize("NFC", chunk).lower()
    return word if word.isalpha() and "Σ" not in chunk else ""  # whose lower form has two shapes


def without_marks(chunks: pa.Array) -> tuple[pa.Array, np.ndarray, list[str]]:
    """The chunks without the marks behind words of letters, which are always cut from
    these, and those marks with their chunks' places.  For tokenizers that ignore case:
    plain letters may be lowered beforehand."""
    stems = pc.utf8_rtrim(chunks, characters=MARKS)
    plain = pc.ascii_is_alpha(stems).to_numpy(zero_copy_only=False)
    sizes = pc.binary_length(stems).to_numpy()
    marked = pc.binary_length(chunks).to_numpy() > sizes
    unsure = np.flatnonzero(marked & ~plain)
    marked[unsure] = np.fromiter(map(bool, map(plain_word, _strings(stems.take(unsure)))), bool, len(unsure))
    stems = pc.if_else(plain | marked, stems, chunks)
    stems = pc.if_else(plain, pc.ascii_lower(stems), stems)
    marked = np.flatnonzero(marked)
    whole = pc.cast(chunks.take(marked), pa.large_binary()).to_numpy(zero_copy_only=False)
    return stems, marked, [chunk[size:].decode() for chunk, size in zip(whole.tolist(), sizes[marked].tolist())]


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


class ChunkEncoder:
    """Ids of texts by way of their chunks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        # Plain words are one piece each, which the file's model encodes without more rules.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        same = self.merges.encode(PROBE).ids == self.tokenizer.encode(PROBE, add_special_tokens=False).ids
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tokenizer.get_vocab().items() if suffix and same else ():
            self.ends_word[i] = token.endswith(suffix)
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = self.known = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)

    @staticmethod
    def _batch(library: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of all texts in a row, and how many each has."""
        found = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _add_words(self, chunks: list[str], words: list[str]) -> None:
        """Encode chunks by their plain words, many at a time; each word's last id ends words."""
        texts = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        ids, _ = self._batch(self.merges, texts)
        ends = np.flatnonzero(self.ends_word[ids])
        if len(ends) == len(words):
            self._add(chunks, ids, np.diff(ends, prepend=-1))
        else:  # a model without such ids
            self._add(chunks, *self._batch(self.tokenizer, chunks))

    def _add_others(self, chunks: list[str]) -> None:
        """Encode chunks, many at a time, with a mark behind each that none of them holds."""
        held = [c for c in chunks if BETWEEN in c]
        self._add(held, *self._batch(self.tokenizer, held))
        chunks = [c for c in chunks if BETWEEN not in c]
        texts = [f" {BETWEEN} ".join([*chunks[i : i + TOGETHER], ""]) for i in range(0, len(chunks), TOGETHER)]
        ids, _ = self._batch(self.tokenizer, texts)
        ends = np.flatnonzero(ids == self.between[0]) if len(self.between) == 1 else []
        if len(ends) == len(chunks):
            self._add(chunks, np.delete(ids, ends), np.diff(ends, prepend=-1) - 1)
        else:  # a tokenizer that uses the mark's id otherwise
            self._add(chunks, *self._batch(self.tokenizer, chunks))

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks."""
        words = list(map(plain_word, chunks))
        self._add_words(list(compress(chunks, words)), list(filter(None, words)))
        self._add_others(list(compress(chunks, map(not_, words))))

    def _places(self, chunks: list[str]) -> np.ndarray:
        """The places of the chunks' ids; new chunks are encoded first."""
        places = np.fromiter(map(self.index.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(places < 0)
        if len(new):
            missing = [chunks[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(missing)))
            places[new] = np.fromiter(map(self.index.__getitem__, missing), np.int64, len(missing))
        return places

    def _ids(self, at: np.ndarray) -> np.ndarray:
        """The ids of the chunks at these places, in a row."""
        return self.flat[ragged(self.starts[at], self.lengths[at])]

    def _add(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n = self.known
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(chunks) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[n : n + len(chunks)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n : n + len(chunks)] = lengths
        self.used += len(ids)
        self.known += len(chunks)
        self.index.update(zip(chunks, range(n, n + len(chunks))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        parts = word_chunks(texts)
        distinct = parts.flatten().dictionary_encode()
        stems, marked, marks = without_marks(distinct.dictionary)
        stems = stems.dictionary_encode()
        wanted = [*_strings(stems.dictionary), "", *marks]
        if len(self.index) + len(wanted) > REMEMBERED:
            self._forget()
        places = self._places(wanted)
        # The distinct chunks' ids, each its stem's and its marks', then those of all chunks.
        known = len(stems.dictionary)
        at = np.full((len(distinct.dictionary), 2), places[known])
        at[:, 0] = places[stems.indices.to_numpy()]
        at[marked, 1] = places[known + 1 :]
        flat, lengths = self._ids(at.ravel()), self.lengths[at].sum(axis=1)
        chunks = distinct.indices.to_numpy()
        ids = flat[ragged((np.cumsum(lengths) - lengths)[chunks], lengths[chunks])]
        ends = np.concatenate([[0], np.cumsum(lengths[chunks])])[parts.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    stand for themselves, the others for letters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteEncoder:
    """Ids of texts by a byte-level vocabulary, in which a token's id is its rank."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        added = {t["content"]: t["id"] for t in content["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in content["model"]["vocab"].items()
            if token not in added
        }
        self.added = added
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.plain = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _ids(self, text: str) -> list[int]:
        if self.cut is None or self.cut.search(text) is None:
            return self.plain(text)
        # A special token's text is that token, wherever it stands.
        parts = self.cut.split(text)
        return [i for p in parts for i in ([self.added[p]] if p in self.added else self.plain(p))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        return [np.array(self._ids(t), np.uint32) for t in texts]


ENCODERS = {"words": ChunkEncoder, "bytes": ByteEncoder}


def encoder(path: str, kind: str) -> ChunkEncoder | ByteEncoder:
    """This process's encoder for a tokenizer file."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = ENCODERS[kind](path)
    return _encoders[path, kind]
