import random
import re

import numpy as np
import pyarrow as pa

from replylane.llm.words import chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, " ", "one", "a b\tc\nd  e f", "é ü\x0bñ\x0cz", " lead and trail ", "x" * 50, "a b c d e a b c d e"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    alphabet = ["a", "bb", "ccc", "é", "ñandú", " ", "  ", "\n", "\t"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    texts = TEXTS + random_texts(300)
    got = {}
    for first, last, part in chunks(pa.array(texts), limit=200):
        raw = part.data.tobytes()
        for i in range(part.count):
            a, b = part.bounds[i], part.bounds[i + 1]
            got[first + i] = [raw[s:e].decode() for s, e in zip(part.starts[a:b], part.ends[a:b])]
    assert [got[i] for i in range(len(texts))] == [WORD.findall(t or "") for t in texts]


def test_hashes_follow_the_words_only():
    seen = {}
    for limit in (10, 1000):
        for _, _, part in chunks(pa.array([t for t in random_texts(200, 2)]), limit):
            raw = part.data.tobytes()
            for s, e, h in zip(part.starts, part.ends, part.word_hashes()):
                assert seen.setdefault(raw[s:e], h) == h
    assert len(set(seen.values())) == len(seen)


def test_shingle_sets_have_the_sizes_of_plain_sets():
    texts = TEXTS + random_texts(200, 3)
    for first, _, part in chunks(pa.array(texts), 300):
        for i, found in enumerate(part.shingle_sets()):
            words = WORD.findall(texts[first + i] or "")
            plain = {tuple(words)} if 0 < len(words) < 5 else {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
            assert len(found) == len(plain) and (np.diff(found.astype(object)) > 0).all()
