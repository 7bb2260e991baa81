import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from pricelens.llm import bpe


@pytest.fixture(scope="module")
def ours():
    return bpe.Transducer(bpe.default_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def ids(t, text):
    return np.frombuffer(b"".join(t.encode(text)), "<u4").tolist()


def test_bytes_have_letters():
    assert len(set(bpe.byte_letters())) == 256 and bpe.byte_letters()[32] == "Ġ"


PARTS = [" the", "The", "'s", "'re", "'x", "12", " 3", "é", "世界", "😀", "\n", "  ", "\t", "\x85", "　", "<|endoftext|>",
         "<|endof", "--", " ==", "́", "aaaa", "ing", "\x00", "ſ"]


@pytest.mark.parametrize("seed", range(6))
def test_ids_and_text_of_the_library(ours, library, seed):
    r = random.Random(seed)
    for n in (0, 1, 2, 5, 20, 200):
        text = "".join(r.choice(PARTS) for _ in range(n))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(ours, text) == want
        packed = np.array(want, "<u4").tobytes()
        cut = 4 * r.randrange(len(want) + 1)
        assert "".join(ours.decode([packed[:cut], packed[cut:]])) == library.decode(want, skip_special_tokens=False)


def test_decoding_of_broken_characters(ours, library):
    r = random.Random(9)
    for _ in range(50):
        some = [r.choice([*range(188, 256), 94, 220, 50256, 12520]) for _ in range(r.randrange(12))]
        assert "".join(ours.decode([np.array(some, "<u4").tobytes()])) == library.decode(some, skip_special_tokens=False)


@pytest.mark.parametrize("seed", range(4))
def test_windows_emit_final_tokens_only(library, seed):
    t = bpe.Transducer(bpe.default_path())
    t.window = t.lookahead + 140  # a token of the longest kind fits
    r = random.Random(seed)
    words = [k for k, _ in sorted(library.get_vocab().items(), key=lambda x: x[1])[300:30000] if k.isalpha() and k.isascii()]
    word = "".join(r.choice(words) if seed % 2 else r.choice("etaoinshrd") for _ in range(1500))
    assert [i for block in t.piece(word.encode()) for i in block] == library.encode(word, add_special_tokens=False).ids
    same = "a" * 3000
    assert [i for block in t.piece(same.encode()) for i in block] == library.encode(same, add_special_tokens=False).ids


def test_lookahead_of_a_small_merge_list():
    # a=0 b=1 c=2 d=3; cd, b+cd, a+bcd: a "d" decides the token three bytes before it
    merges = [(2, 3), (1, 4), (0, 5)]
    made = {(2, 3): 4, (1, 4): 5, (0, 5): 6}
    assert bpe.lookahead(merges, made, [1, 1, 1, 1, 2, 3, 4]) == 3
    assert bpe.lookahead([], {}, [1]) == 0


def test_cache_starts_anew(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE", 10)
    t = bpe.Transducer(bpe.default_path())
    text = " ".join(f"word{chr(97 + k % 26) * (k % 7)}" for k in range(200))
    want = library.encode(text, add_special_tokens=False).ids
    for _ in range(3):   # the second and third time from the older generation
        assert ids(t, text) == want and len(t.cache) <= 10 + 200


def test_rows(spark, library):
    long = "wörd " * 60_000 + "x" * 50_000
    rows = [(1, "one two", 5), (2, None, 6), (3, "", 7), (1, "one two", 5), (None, "<|endoftext|>!", 8), (4, long, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in bpe.round_trip(df, bpe.default_path(), keep_ids=True).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        some = np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
        want.append((doc_id, len(some) // 4, hashlib.sha256(some).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), bytearray(some)))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(df.limit(0), bpe.default_path()).collect() == []


def test_ids_of_a_long_word_leave_before_its_end(ours, library):
    """A pre-token of any length passes its ids on piece by piece."""
    word = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(60_000))
    blocks = list(ours.encode("a " + word + " b"))
    assert len(blocks) > 50 and max(map(len, blocks)) < 4 * bpe.LONG
    ids = np.frombuffer(b"".join(blocks), "<u4").tolist()
    assert ids == library.encode("a " + word + " b", add_special_tokens=False).ids
