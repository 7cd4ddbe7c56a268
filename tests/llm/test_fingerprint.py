"""SimHash fingerprints against a loop over bits."""

import re

import numpy as np
import xxhash

from tapeworks.llm import neardup


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_against_a_loop():
    rng = np.random.default_rng(12)
    words = ["Red", "GREEN", "Été", "été", "a b", "x.", "7"]
    seps = [" ", "\t", "\n\n", "\x0b", "\x0c", "\r", "  "]
    texts = ["".join(w + s for w, s in zip(rng.choice(words, n), rng.choice(seps, n), strict=True)) for n in rng.integers(0, 200, 60)]
    texts += [None, "", " \t\n", "one", "one two", "same same same same same", "A B c " * 9_000]
    for t in texts:
        assert neardup.fingerprint(t) == brute(t)
