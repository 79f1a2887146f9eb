import random

import numpy as np
from brute import words
from hypothesis import given, settings
from hypothesis import strategies as st

from creditspark.llm import simple8b
from creditspark.llm.text import BASES, Words, as_bytes, bit_counts, byte_chunks, chunks, simhash, span_hash

TEXTS = st.lists(st.text(alphabet="ab \t\n\x0b\x1c\x85é中 ", max_size=30), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words(texts):
    w = Words(as_bytes(texts))
    got = [bytes(w.buf[a:b]).decode() for a, b in zip(w.start, w.end)]
    assert [got[a:b] for a, b in zip(w.first[:-1], w.first[1:])] == [words(t) for t in texts]
    h = w.hashes()
    assert len({*zip(got, h.tolist())}) == len(set(got)) == len(set(h.tolist()))


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 20))
def test_chunks_cover_all(texts, limit):
    raw = as_bytes(texts)
    assert [i for a, b in chunks(raw, limit) for i in range(a, b)] == list(range(len(texts)))
    assert [x for a, b, part in byte_chunks(texts, limit) for x in zip(range(a, b), part, strict=True)] == list(enumerate(raw))


def test_span_hash_depends_on_content_only():
    h = np.random.default_rng(1).integers(0, 2**63, 200, dtype=np.uint64)
    h[150:160] = h[20:30]
    got = span_hash(h, np.array([20, 150, 21]), np.array([30, 160, 30]), BASES[0])
    assert got[0] == got[1] != got[2]


def test_bit_counts_and_simhash():
    rng = np.random.default_rng(2)
    n = np.array([0, 1, 3, 700, 0, 255, 256, 2])
    h = rng.integers(0, 2**64 - 1, n.sum(), dtype=np.uint64)
    got, fp, at = bit_counts(h, n), simhash(h, n), 0
    for k, size in enumerate(n.tolist()):
        mine = h[at : at + size].tolist()
        at += size
        want = [sum(x >> b & 1 for x in mine) for b in range(64)]
        assert got[k].tolist() == want
        assert int(fp[k]) == sum(1 << b for b in range(64) if 2 * want[b] > size)


def test_bit_counts_where_empty_groups_equal_surplus_cuts():
    rng = np.random.default_rng(3)
    for n in ([0, 5, 7, 300], [300, 0, 1], [0, 0, 600, 2], [700, 3, 0, 0]):
        h = rng.integers(0, 2**64 - 1, sum(n), dtype=np.uint64)
        ends = np.cumsum(n)
        want = [[int((part >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)] for part in np.split(h, ends[:-1])]
        assert bit_counts(h, np.array(n)).tolist() == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 64).flatmap(lambda b: st.integers(0, max(0, 2**b - 1))), max_size=700))
def test_simple8b_round_trip(ids):
    ids = np.array(ids, np.uint64)
    buffer = simple8b.encode(ids)
    assert simple8b.decode(buffer).tolist() == ids.tolist()
    for k in range(-(-len(ids) // simple8b.BLOCK)):
        assert simple8b.decode_block(buffer, k).tolist() == ids[k * 256 : k * 256 + 256].tolist()


def test_simple8b_packs():
    assert len(simple8b.encode(np.ones(60_000, np.uint64))) < 60_000 / 30 * 8  # 51 of 60 bits at least
    ids = np.random.default_rng(3).integers(0, 49408, 50_000, dtype=np.uint64)
    assert len(simple8b.encode(ids)) < 2.8 * len(ids)


def test_word_coder_equals_the_library(spark):
    from creditspark.llm.tokens import coder, vocabulary_path

    rng, code = random.Random(4), coder(vocabulary_path(None))
    alphabet = "aAbB.,'sS tT\n\t !?#é É İ ß ẞ σς Σ 1２½ ̇́ ゙か 中文 <| |>  \x1c\x85 'll don't it's. a., ##. ..y"
    odd = ["<|endoftext|>", "<|ENDOFTEXT|>", "'re", "ﬁ", "Ǆ", "ŉ", "and,", "the###", "THE!!"]
    texts = ["".join(rng.choice(alphabet) if rng.random() < 0.95 else rng.choice(odd) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    raw = as_bytes(texts)
    got = [x for i, j in chunks(raw, 5000) for x in code.encode_all(raw[i:j])]
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == code.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_word_coder_asks_for_many_pieces_at_once(monkeypatch):
    from creditspark.llm.tokens import WordCoder, vocabulary_path

    code, asked = WordCoder(vocabulary_path(None)), []
    monkeypatch.setattr(code, "_ask", lambda text: asked.append(text))
    texts = ["CafÉ, été. ß&&& ñ×ñ ¡é! <é>÷ ÀÖØÞßöøÿ.ª µº", "don't 555-8990 l'été's 3é.é4 été́. 中文é. ·à« Ã\xadà\xa0é", ""]
    got = code.encode_all(as_bytes(texts))
    assert not asked  # numbers and accented letters beside marks are not asked for one by one
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == code.tokenizer.encode(text, add_special_tokens=False).ids, text
    assert b"\xc3\xa9t\xc3\xa9" in code.known and b"\xc3\xa9t\xc3\xa9." not in code.known
