"""The n-gram join against a brute-force version."""

import random
import re

import pytest

from tidemark.llm import ngram_join
from tidemark.llm.ngram_join import most_shared, near_duplicates, signatures, slack

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=str)


def case(seed):
    r = random.Random(seed)
    vocabulary = ["A", "b", "É", "c.", *(f"w{i}" for i in range(40))]
    words = lambda k: [r.choice(vocabulary) for _ in range(k)]
    rows = []
    for size in (4, 12, 30, 70, 150, 260):
        base = words(size)
        passage = words(20)
        for _ in range(12):
            own = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 4, 8])):
                at = r.randrange(len(own))
                own[at : at + r.choice([0, 1, 1])] = words(r.choice([0, 1, 1]))
                own = own or words(1)
            rows.append(r.choice([" ", "\n"]).join(own + r.choice([[], [], passage])))
    rows += [" ".join(words(r.randint(1, 90))) for _ in range(20)] + ["", None, "x", "X", " y "]
    ids = r.sample(range(5000), len(rows))
    out = list(zip(ids, rows))
    return out + [out[3], (ids[0], rows[40]), (None, rows[1]), (None, "only null")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "options, few", [({}, 100_000), ({"frequent": 2, "subclasses": 4, "short": 20, "home_bytes": 3000}, 0)]
)
def test_against_brute_force(spark, seed, options, few, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_PAIRS", few)
    rows = case(seed)
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, node int").repartition(3)
    got = near_duplicates(docs, **options).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_sets_share_a_signature():
    import numpy as np

    r = np.random.Generator(np.random.PCG64(3))
    for _ in range(300):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 1 << 64, n, dtype=np.uint64))
        lost = int(r.integers(0, slack(len(a)) + 1))
        b = np.sort(r.permutation(a)[: len(a) - lost])
        told = {int(t): int(v) for t, v in zip(a, r.choice(3, len(a), p=[0, 0.3, 0.7]))}
        found = []
        for tokens in (a, b):
            verdict = np.array([told[int(t)] for t in tokens], np.uint8)
            found.append(signatures(tokens, verdict, 75, 8, 64))
        if all(enough for _, enough in found):
            assert len(np.intersect1d(found[0][0], found[1][0]))


def test_bound_of_shared_tokens_holds():
    import numpy as np

    r = np.random.Generator(np.random.PCG64(4))
    for _ in range(200):
        universe = r.integers(0, 1 << 64, 60, dtype=np.uint64)
        a, b = (np.unique(r.choice(universe, int(r.integers(1, 60)))) for _ in range(2))
        # Few bits, so that different tokens look alike.
        short = [(t[t < np.uint64(1 << 63)] >> np.uint64(60)).astype(np.uint16) for t in (a, b)]
        assert most_shared(short[0], len(a), short[1], len(b)) >= len(np.intersect1d(a, b))


def family(r, n, own):
    """Copies of one text with 3 to 8 words replaced each, by words of their own or by common ones too."""
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(n):
        words = list(base)
        for place in r.sample(range(150), r.randrange(3, 9)):
            words[place] = f"own{i}x{place}" if own else r.choice([f"own{i}x{place}", "common", "often"])
        docs.append((i, " ".join(words)))
    return docs


@pytest.mark.parametrize("own", [True, False])
def test_family_around_the_limit(spark, own):
    """Similarities from far below to above the limit, no copy without damage: no link is lost to the bounds."""
    docs = family(random.Random(own), 160, own)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted((tuple(row) for row in near_duplicates(df).collect()), key=str) == brute(docs)
