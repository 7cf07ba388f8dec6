import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bandwatch.llm import shingles


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from(list("aAbÉé \t\n\r\x0b\x0c\x1c\xa0\x85.1")), max_size=60), st.sampled_from([3, 17, 1 << 20]))
def test_word_hashes_follow_words(text, part):
    old, shingles.PART = shingles.PART, part
    try:
        found = shingles.word_hashes(text)
    finally:
        shingles.PART = old
    want = [shingles.byte_word_hashes(w)[0] for w in shingles.words(text)]
    assert found.tolist() == want
    assert len({int(x) for x in found}) == len(set(shingles.words(text)))


def test_long_words_differ_by_place():
    a, b = b"x" * 63 + b"y" + b"z" * 64, b"z" * 64 + b"x" * 63 + b"y"
    assert shingles.byte_word_hashes(a) != shingles.byte_word_hashes(b)


def test_shingle_sets():
    assert len(shingles.shingle_set("a b a b a b", 2)) == 2 and len(shingles.shingle_set("", 2)) == 0
    assert shingles.shingle_set("A  b", 4).tolist() == shingles.shingle_set("a b", 4).tolist() != shingles.shingle_set("b a", 4).tolist()
    s = shingles.shingle_set(" ".join(map(str, range(500))), 4)
    assert len(s) == 497 and (np.diff(s) > 0).all()
