import numpy as np

from wardflow.llm import words


def test_hashes_follow_words(monkeypatch):
    monkeypatch.setattr(words, "PIECE", 64)
    texts = [b"a bb  A\x0bbb", None, b"", b" x ", b"long " * 200 + b"y" * 500 + b" end", "é \xa0z".encode()]
    known, counts = {}, {}
    for lower in (False, True):
        for first, n, hashes in words.hashed(texts, lower):
            at = 0
            for i, count in enumerate(n):
                own = (texts[first + i] or b"").split()
                own = [w.lower() for w in own] if lower else own
                assert len(own) == count
                for w, h in zip(own, hashes[at:at + count]):
                    assert known.setdefault(w, h) == h
                at += count
                counts[first + i] = count
    assert len(counts) == len(texts) and len(set(known.values())) == len(known)


def test_windows_are_equal_when_their_words_are():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 3, 500).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seen = {}
    for i, w in enumerate(words.windows(h, 4)):
        assert seen.setdefault(tuple(h[i:i + 4]), w) == w
    assert len(set(seen.values())) == len(seen) > 60
    assert len(words.windows(h[:3], 4)) == 0
