"""Words of many texts at a time against those of one text after another."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tallywell.llm import lm

TEXTS = [None, "", " ", "\x0b\x0c AÄ \x00b\x1cc Zq zq9\r\n", "zq zq9 ZQ9 zq9 zq9", "new1 new1 new2 zq", " x y \x85z\t", "zq"]


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def test_words_of_a_batch():
    for texts in (TEXTS, TEXTS[:3], []):
        here = lm.Words.of(pa.array(texts, pa.string()))
        assert here.texts == len(texts)
        assert list(zip(here.rows.tolist(), here.words.to_pylist())) == [(i, w) for i, t in enumerate(texts) for w in words(t)]


def test_pairs_and_rare_words_of_a_batch():
    vocabulary = lm.Vocabulary([b"zq", b"x", b"y"], np.array([9, 5, 4]), 2)
    here = lm.Words.of(pa.array(TEXTS, pa.string()))
    places = vocabulary.places(here)
    number = {b"zq": 0, b"x": 1, b"y": 2}
    assert places.tolist() == [number.get(w, 3) for t in TEXTS for w in words(t)]

    symbols = {0: 0, 1: 1, 2: vocabulary.other, 3: vocabulary.rare}
    sequences = [[vocabulary.end, *(symbols[number.get(w, 3)] for w in words(t)), vocabulary.end] for t in TEXTS]
    assert vocabulary.pairs(here, places).tolist() == [a * vocabulary.width + b for s in sequences for a, b in zip(s, s[1:])]

    want = Counter()
    for i, t in enumerate(TEXTS):
        for before, w in zip([None, *words(t)], words(t)):
            if w not in number:
                want[i, 3 if before is None else number.get(before, lm.hashed(before)), w] += 1
    rows, before, rare, n = vocabulary.rare_words(here, places)
    assert dict(zip(zip(rows.tolist(), before.tolist(), rare.to_pylist()), n.tolist())) == want and len(n) == len(want)
