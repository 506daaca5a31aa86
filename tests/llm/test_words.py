import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerlake.llm import words
from tickerlake.llm.common import give_back
from tickerlake.llm.words import slices, window_hashes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abé日 \t\n\x0b\x85\xa0", max_size=30)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 20))
def test_words_are_the_pattern_and_hashes_are_of_content(values, size):
    seen = {}
    for low, high, words in slices(pa.array(values, pa.string()), size):
        for i in range(low, high):
            raw = [bytes(words.data[a:b]) for a, b in zip(words.starts, words.ends)][words.offsets[i - low] : words.offsets[i - low + 1]]
            assert raw == [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", values[i] or "")]
            for w, h in zip(raw, words.hashes()[words.offsets[i - low] : words.offsets[i - low + 1]].tolist()):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_tables_of_powers_go_back_at_the_end_of_a_task():
    text = pa.array(["a word " * 100_000])
    first = [w.hashes().tolist() for _, _, w in slices(text)]
    assert words._TABLES
    give_back()
    assert not words._TABLES
    assert [w.hashes().tolist() for _, _, w in slices(text)] == first


def test_windows_stay_in_one_text():
    (_, _, words), = slices(pa.array(["a b c", "a b", "", "b c a b c"]))
    first = words.windows(3)
    assert first.tolist() == [0, 5, 6, 7]
    h = window_hashes(words.hashes(), first, 3)
    assert h[0] == h[3] and len(np.unique(h)) == 3
