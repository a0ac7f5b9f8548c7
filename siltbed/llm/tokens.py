"""Token ids of whole texts, each distinct word handed to the tokenizer once per worker.

A byte-level BPE tokenizer cuts a text into words before it merges bytes. A single space or line feed
between two other characters always is such a cut, so the text is cut there first and the ids of each
chunk are kept in a bounded table. Anything else (runs of white space, other tokenizers) goes to the
tokenizer whole, so ids are always those of ``Tokenizer.encode`` on the whole text.

Documents are encoded a column at a time: Arrow cuts the texts and tells the different words apart, these
are looked up once each, and numpy lays their ids out. A text with other white space is encoded alone.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

TOKENIZER = "byte_bpe_50k.json"
#: Entries kept per worker; beyond these a chunk is encoded anew each time it comes.
CHUNKS, PIECES = 700_000, 300_000
#: The same for the table of a column's words, and the bytes of text that are encoded in one step.
WORDS, STEP = 1_500_000, 16 << 20
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Latin and Cyrillic words; letters that only some versions of Unicode know are not among them.
_LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481]+$"
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Texts that a column leaves to ``Encoder.encode``, without a look at their words.
_OTHER_SPACE = r"[ \n\r\t][ \n\r\t]|^[ \n\r\t]|[ \n\r\t]$|\x00"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE files use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    spare = iter(range(256, 512))
    return {b: table.get(b) or chr(next(spare)) for b in range(256)}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        model = spec.get("model") or {}
        self.by_chunks = (
            not spec.get("normalizer")
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and model.get("type") == "BPE"
            and not model.get("ignore_merges")
        )
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65_536 else "<u4")
        self.bpe, self.letters = self.tokenizer.model, _byte_letters()
        self.space = self.letters[32]
        unit = "H" if self.dtype.itemsize == 2 else "I"
        self.packers = [struct.Struct(f"<{n}{unit}").pack for n in range(33)]
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        # Words met in columns, where their ids begin in ``word_ids``, and how many they are (-1: not a safe chunk).
        self.words = pa.array([], pa.large_string())
        self.word_ids = np.zeros(0, self.dtype)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, text: str) -> bytes:
        # Without the offsets of the tokens, which nothing here needs.
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype=self.dtype).tobytes()

    def _merged(self, piece: str) -> bytes:
        """One word of the tokenizer's own cutting: letters with at most one space before, or marks."""
        # Of the ASCII characters in such a word only the space has another letter.
        spelled = piece.replace(" ", self.space) if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.bpe.tokenize(spelled)]
        return self.packers[len(ids)](*ids) if len(ids) < 33 else np.array(ids, dtype=self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        """The same for a part of a chunk, which may be a chunk met before."""
        got = self.chunks.get(piece) or self.pieces.get(piece)
        if got is None:
            got = self._merged(piece)
            if len(self.pieces) < PIECES:
                self.pieces[piece] = got
        return got

    def _chunk(self, chunk: str) -> bytes | None:
        """None where the chunk's ends are white space, so that the cut beside it is not safe."""
        if chunk == "\n":
            got = self._whole(chunk)
        else:
            body = chunk[1:] if chunk[:1] == " " else chunk
            if body.isalpha():
                got = self.pieces.get(chunk) or self._merged(chunk)
            elif not body or body[0].isspace() or body[-1].isspace():
                return None
            else:
                word = chunk.rstrip(_PUNCTUATION)
                if (word[1:] if word[:1] == " " else word).isalpha():
                    got = self._piece(word) + self._piece(chunk[len(word) :])
                else:
                    got = self._whole(chunk)
        return got

    def _new_chunk(self, chunk: str) -> bytes | None:
        got = self._chunk(chunk)
        if got is not None and len(self.chunks) < CHUNKS and len(chunk) < 80:
            self.chunks[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_chunks:
            return self._whole(text)
        if "\0" not in text:
            parts = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
            if not parts[0]:
                parts = parts[1:]
            if parts and not parts[-1]:
                parts = parts[:-1]
            known = self.chunks
            try:
                return b"".join(map(known.__getitem__, parts))
            except KeyError:
                new = {p: self._new_chunk(p) for p in set(parts).difference(known)}
            if None not in new.values() and not _edge(text):
                if new.keys() <= known.keys():
                    return b"".join(map(known.__getitem__, parts))
                return b"".join([known[p] if p in known else new[p] for p in parts])
        first, *rest = _SAFE_SPACE.split(text)
        return b"".join([self._whole(first), *(self.chunks.get(" " + r) or self._whole(" " + r) for r in rest)])

    def _find(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids kept, and where those of each of ``pieces`` begin and how many they are. ``pieces`` differ."""
        at = np.array(pc.fill_null(pc.index_in(pieces, value_set=self.words), -1))
        new = np.flatnonzero(at < 0)
        texts = pieces.take(new)
        found = [self._chunk(p) if p else b"" for p in texts.to_pylist()]
        counts = np.array([-1 if f is None else len(f) // self.dtype.itemsize for f in found], dtype=np.int64)
        sizes = np.maximum(counts, 0)
        new_ids = np.frombuffer(b"".join(filter(None, found)), dtype=self.dtype)
        begin = np.cumsum(sizes) - sizes
        at[new] = len(self.words) + np.arange(len(new))
        ids = np.concatenate([self.word_ids, new_ids])
        found_starts = np.concatenate([self.starts, len(self.word_ids) + begin])[at]
        found_counts = np.concatenate([self.counts, counts])[at]
        kept = np.flatnonzero(np.asarray(pc.binary_length(texts)) < 80)[: WORDS - len(self.words)]
        if len(kept):
            self.words = pa.concat_arrays([self.words, texts.take(kept)])
            self.starts = np.concatenate([self.starts, len(self.word_ids) + np.cumsum(sizes[kept]) - sizes[kept]])
            self.counts = np.concatenate([self.counts, counts[kept]])
            self.word_ids = np.concatenate([self.word_ids, _runs(new_ids, begin[kept], sizes[kept])])
        return ids, found_starts, found_counts

    def encode_column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (without nulls), ``end_id`` after each, and how many each has with it."""
        texts, alone = texts.cast(pa.large_string()), {}
        if not self.by_chunks:
            alone = {t: self.encode(x) for t, x in enumerate(texts.to_pylist())}
            ids, sizes = np.zeros(0, self.dtype), np.zeros(len(texts), np.int64)
        else:
            # A NUL marks a word without a space before it: at a text's start, or after a line feed.
            mark, nothing = pa.scalar("\0", texts.type), pa.scalar("", texts.type)
            other = pc.match_substring_regex(texts, _OTHER_SPACE)
            plain = pc.replace_substring(pc.if_else(other, nothing, texts), "\n", " \n \0")
            parts = pc.split_pattern(pc.binary_join_element_wise(mark, plain, nothing), " ")
            first = np.asarray(parts.offsets).astype(np.int64)
            coded = parts.flatten().dictionary_encode()
            codes = np.asarray(coded.indices)
            ids, starts, counts, odd = self._words(coded.dictionary)
            counts = counts[codes]
            if odd.any():
                of = np.unique(np.searchsorted(first, np.flatnonzero(odd[codes]), side="right") - 1).tolist()
                alone = {t: self.encode(texts[t].as_py()) for t in of}
                for t in of:
                    counts[first[t] : first[t + 1]] = 0
            ids = _runs(ids, starts[codes], counts)
            sizes = np.diff(np.concatenate([[0], np.cumsum(counts)])[first])
        added = np.ones(len(texts), dtype=np.int64)
        for t, blob in alone.items():
            added[t] += len(blob) // self.dtype.itemsize
        values, ends_at = np.full(int(added.sum()), end_id, dtype=self.dtype), np.cumsum(added)
        for t, blob in alone.items():
            values[ends_at[t] - added[t] : ends_at[t] - 1] = np.frombuffer(blob, dtype=self.dtype)
        return np.insert(ids, np.repeat(np.cumsum(sizes), added), values), sizes + added

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words, those without a space before marked by NUL: all ids, where each word's begin,
        how many it has, and whether its texts must be encoded alone."""
        nothing = pa.scalar("", words.type)
        bare = pc.or_(pc.starts_with(words, "\0"), pc.equal(words, "\n"))
        word = pc.ascii_ltrim(words, "\0")
        # Letters and the marks after them are looked up apart: fewer are new.
        stem = pc.ascii_rtrim(word, _PUNCTUATION)
        stem = pc.if_else(pc.match_substring_regex(stem, _LETTERS), stem, word)
        whole = np.asarray(pc.binary_length(word))
        size = whole - np.asarray(pc.binary_length(stem))
        _, ends, letters = word.buffers()
        marks = _runs(np.frombuffer(letters or b"", np.uint8), np.frombuffer(ends, np.int64)[1 : len(word) + 1] - size, size)
        tail = pa.Array.from_buffers(word.type, len(word), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)])), pa.py_buffer(marks)])
        head = pc.binary_join_element_wise(pc.if_else(bare, nothing, pa.scalar(" ", words.type)), stem, nothing)
        coded = pa.concat_arrays([head, tail]).dictionary_encode()
        ids, starts, counts = self._find(coded.dictionary)
        at = np.asarray(coded.indices).reshape(2, -1).T
        odd = (counts[at] < 0).any(axis=1) | (whole == 0)
        counts = np.maximum(counts[at], 0)
        sizes = counts.sum(axis=1)
        return _runs(ids, starts[at].ravel(), counts.ravel()), np.cumsum(sizes) - sizes, sizes, odd


def _runs(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` ids from each of ``starts``, one run after the other."""
    out = []
    for a in range(0, len(starts), 1 << 18):
        n = counts[a : a + (1 << 18)]
        ends = np.cumsum(n)
        out.append(ids[np.arange(int(n.sum())) + np.repeat(starts[a : a + (1 << 18)] - (ends - n), n)])
    return np.concatenate([ids[:0], *out])


def _edge(text: str) -> bool:
    """White space at either end stands alone; the chunk rules are for white space between words."""
    return text[0].isspace() or text[-1].isspace()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``STEP`` bytes of text, a row being never cut."""
    held, size = [], 0
    for b in batches:
        ends, at = np.cumsum(np.asarray(pc.binary_length(b.column(1))), dtype=np.int64), 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = min(int(np.searchsorted(ends, before + STEP - size)) + 1, b.num_rows)
            held.append(b.slice(at, to - at))
            size, at = size + int(ends[to - 1]) - before, to
            if size >= STEP:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def encode_documents(docs: DataFrame, path: str | None = None, end_id: int = 0) -> DataFrame:
    """(doc_id, n_tokens, ids): ids little-endian, 16 bits each where the vocabulary allows, ``end_id``
    last. ``docs`` has doc_id and text without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path or tokenizer_path())
        for b in _steps(batches):
            ids, n = enc.encode_column(b.column(1), end_id)
            ends = np.concatenate([[0], np.cumsum(n)]) * enc.dtype.itemsize
            blobs = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), blobs.cast(pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def id_dtype(path: str | None = None) -> str:
    """The numpy type of the stored ids, for readers."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path or tokenizer_path()).get_vocab_size() <= 65_536 else "<u4"
