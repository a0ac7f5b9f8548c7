"""Token files and packing against the tokenizer's own ids."""

import random
import zlib

import numpy as np
import pytest
from siltbed.llm import packing, tokenfiles
from siltbed.llm.queries import QUERIES
from siltbed.llm.tokens import Encoder, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def test_chunks_give_the_tokenizers_ids(tokenizer, small, odd_rows):
    enc = Encoder(tokenizer_path())
    r = random.Random(1)
    alphabet = ["a", "Word", " ", "\n", "  ", ".", ",", "'s", "'", "\t", "9", "é", "ñ", " ", "\x1c", "_", "²", "中", "!!", "\0", "<|endoftext|>"]
    made = ["".join(r.choice(alphabet) for _ in range(r.randrange(12))) for _ in range(4000)]
    for text in [t for _, t, *_ in odd_rows] + list(small.text) + made * 2:
        text = text or ""
        assert enc.encode(text) == ids_of(tokenizer, text)[:-1].astype("<u2").tobytes(), repr(text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_read_whole_texts(name, small):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    enc = Encoder(tokenizer_path(name))
    t.encode_special_tokens = True
    for text in small.text[:20]:
        assert enc.encode(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


def test_numbers_come_back():
    r = np.random.default_rng(4)
    for n in (0, 1, 3, 4, 5, 1000):
        x = (r.integers(0, 1 << 32, n) >> r.integers(0, 32, n)).astype(np.uint32)
        control, data = (np.frombuffer(b, np.uint8) for b in tokenfiles.pack_numbers(x))
        assert len(control) == -(-n // 4)
        assert (tokenfiles.unpack_numbers(control, data, n) == x).all()


def by_order(rows):
    return sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start))


def test_files_hold_the_whole_table(spark, odd, odd_rows, tokenizer, home):
    tokenfiles.write_tokens(odd, f"{home}/t")
    rows = by_order(tokenfiles.read_tokens(spark, f"{home}/t").collect())
    assert sorted(([r.doc_id, list(r.ids)] for r in rows), key=str) == sorted(([i, ids_of(tokenizer, t).tolist()] for i, t, *_ in odd_rows), key=str)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens


def test_files_of_nothing(spark, empty, home):
    tokenfiles.write_tokens(empty, f"{home}/t")
    assert tokenfiles.read_tokens(spark, f"{home}/t").count() == 0


def test_op4(spark, sf, small, tokenizer):
    at = 0
    for r in by_order(QUERIES["op4_token_files"](spark, sf).collect()):
        ids = ids_of(tokenizer, small.set_index("doc_id").text[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def check_packed(rows, texts, tokenizer):
    """Every id in one piece, windows without gaps, and padding in no more than a few windows."""
    ids = [ids_of(tokenizer, t) for t in texts]
    windows = {}
    for r in rows:
        assert 0 < r.length <= 1024
        windows.setdefault(r.sequence_id, []).append(r)
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0
    assert sum(r.length for r in rows) == sum(map(len, ids))
    return ids


def test_packing_odd_rows(spark, odd, odd_rows, tokenizer):
    rows = packing.pack(odd).collect()
    ids = check_packed(rows, [t for _, t, *_ in odd_rows], tokenizer)
    got = sorted((r.doc_id or 0, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    for (i, start, length, crc, n) in got:
        assert any((d or 0) == i and len(x) == n and zlib.crc32(x[start : start + length].tobytes()) == crc for (d, *_), x in zip(odd_rows, ids))


def test_packing_of_nothing(empty):
    assert packing.pack(empty).count() == 0


def test_op2(spark, sf, small, tokenizer):
    rows = QUERIES["op2_packing"](spark, sf).collect()
    check_packed(rows, small.text, tokenizer)
    texts = small.set_index("doc_id").text
    pieces = {}
    for r in rows:
        ids = ids_of(tokenizer, texts[r.doc_id])
        assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for d, p in pieces.items():
        at = 0
        for start, length in sorted(p):
            assert start == at
            at += length
        assert at == len(ids_of(tokenizer, texts[d]))


def test_neighbours_share_a_window():
    """Of two kinds of documents, a window is filled with the seed's own kind first."""
    r = np.random.default_rng(2)
    docs = [r.integers(0, 50, 200) + (0 if d % 2 else 1000) for d in range(40)]
    idf = np.full(2000, 1.0, np.float32)
    shard = packing.Shard(docs, idf, 200.0)
    shard.left[0] = False
    assert all(n % 2 == 0 for n in shard.neighbours(0))


def test_a_new_word_is_kept_once():
    """Words alone and before marks, seen in either order; ids are those of the whole text."""
    from siltbed.llm import tokens

    enc = tokens.Encoder(tokens.tokenizer_path())
    for text in ("the zorblat qwix the", "zorblat, qwix; zorblat!", "caf\u00e9 na\u00efve, caf\u00e9. plonk? plonk", "x" * 300 + " " + "\u00e9" * 90 + "!", "it's 'quoted' z9 ,, ,"):
        assert enc.encode(text) == enc._whole(text)
    assert " qwix" in enc.chunks and " qwix" not in enc.pieces


def test_a_block_is_packed_and_read_at_once():
    """The bytes of many documents in one step are those of each alone."""
    r = np.random.default_rng(6)
    for most in (200, 60_000, 1 << 32):
        runs = [r.integers(0, most, n).astype(np.uint32) for n in (0, 1, 4, 5, 300, 0, 7)]
        counts = [len(x) for x in runs]
        alone = [tokenfiles.pack_numbers(x) for x in runs]
        control, data = tokenfiles.pack_numbers(np.concatenate(runs), counts)
        assert control == b"".join(c for c, _ in alone) and data == b"".join(d for _, d in alone)
        numbers = tokenfiles.unpack_numbers(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), counts)
        assert (numbers == np.concatenate(runs)).all()


def test_ids_of_a_document_are_told_apart():
    r = np.random.default_rng(7)
    for n in (0, 1, 2, 900):
        ids = r.integers(0, 50, n).astype("<u2")
        for got, wanted in zip(packing.distinct(ids), np.unique(ids, return_counts=True)):
            assert (got == wanted).all() and len(got) == len(wanted)


def test_a_column_gives_the_ids_of_its_texts(tokenizer, small, odd_rows, monkeypatch):
    """In one step or several, with a full table of words or an empty one, whatever white space a text has."""
    import pyarrow as pa

    from siltbed.llm import tokens

    r = random.Random(3)
    alphabet = ["a", "Word", " ", "\n", "  ", ".", ",", "'s", "'", "\t", "9", "\u00e9", "\u0416", "\u00a0", "\x1c", "_", "\u00b2", "\u4e2d", "!!", "\0", "\ua7da", "\r\n", "x" * 90]
    made = ["".join(r.choice(alphabet) for _ in range(r.randrange(12))) for _ in range(3000)]
    texts = [t or "" for _, t, *_ in odd_rows] + list(small.text.fillna("")) + made + ["", "\n", " ", "\0", "a\nb", "\ua7da, x"]
    wanted = [ids_of(tokenizer, t).astype("<u2") for t in texts]
    for kept, step in ((tokens.WORDS, tokens.STEP), (50, 3000), (0, 1)):
        monkeypatch.setattr(tokens, "WORDS", kept)
        monkeypatch.setattr(tokens, "STEP", step)
        enc, ids, sizes = Encoder(tokenizer_path()), [], []
        column = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
        halves = [pa.RecordBatch.from_arrays([b.column(0), b.column(0)], names=["doc_id", "text"]) for b in (column.slice(0, 700), column.slice(700))]
        for b in tokens._steps(iter(halves)):
            got, n = enc.encode_column(b.column(1), 0)
            ids.append(got)
            sizes += n.tolist()
        assert sizes == [len(w) for w in wanted]
        assert (np.concatenate(ids) == np.concatenate(wanted)).all()
        assert len(enc.words) <= kept


def test_a_word_is_handed_over_once_for_all_its_marks(monkeypatch):
    import pyarrow as pa

    enc, met = Encoder(tokenizer_path()), []
    chunk = Encoder._chunk
    monkeypatch.setattr(Encoder, "_chunk", lambda self, c: met.append(c) or chunk(self, c))
    for _ in range(2):
        enc.encode_column(pa.array(["the plonk plonk, plonk. plonk!", "so plonk\nplonk, caf\u00e9, caf\u00e9."]), 0)
    assert sorted(met) == sorted(["the", " plonk", "so", "\n", "plonk", " caf\u00e9", ",", ".", "!"])
