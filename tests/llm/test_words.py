import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from txlake.llm import words

TEXT = st.text(alphabet="aAbBzZéÉ \t\n\v\f\r\x1c\u00a0\u20030|", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8), st.integers(1, 40))
def test_words_and_shingles_as_by_regular_expression(texts, slice_bytes):
    k = words.kernel(5, slice_bytes)
    names, found = {}, []
    for offsets, data in k.slices(pa.array(texts, pa.string())):
        numbers, counts = k.words(offsets, data)
        s, made = k.shingles(numbers, counts)
        i = j = 0
        for c, m in zip(counts, made, strict=True):
            found.append((list(numbers[i : i + c]), list(s[j : j + m])))
            i, j = i + c, j + m
    assert len(found) == len(texts)
    for text, (numbers, s) in zip(texts, found, strict=True):
        want = brute.words(text)
        assert len(numbers) == len(want)
        for n, w in zip(numbers, want, strict=True):
            assert names.setdefault(("w", int(n)), w) == w
            assert names.setdefault(("n", w), int(n)) == int(n)
        want = brute.shingles(text)
        assert len(s) == len(want)
        for n, w in zip(s, want, strict=True):
            assert names.setdefault(("s", int(n)), w) == w
            assert names.setdefault(("m", w), int(n)) == int(n)


def test_slices_of_an_array_that_starts_late():
    k = words.kernel(5, 4)
    texts = pa.array(["x", "a b c", None, "", "d"]).slice(1)
    assert [c for o, d in k.slices(texts) for c in k.words(o, d)[1]] == [3, 0, 0, 1]
