"""The stages against brute-force versions, each on what the one before has kept."""

import hashlib
import random
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.test_ngram_join import brute as brute_components
from tests.llm.test_repeats import covered
from tests.llm.test_winnowing import brute as brute_hits
from tidemark.llm import mixing, registry
from tidemark.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"
FIELDS = "doc_id long, text string, lang string, source string, n_chars long"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_run_against_brute_force(spark):
    """From the classifier's verdicts on, every stage must be what plain code makes of its input."""
    docs = registry.table(spark, SF_DIR, "documents")
    benchmark = [tuple(r) for r in registry.table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    accepted = corpus_pipeline.quality(spark, docs, SF_DIR).collect()
    assert 0 < len(accepted) <= docs.count()

    components = {d: c for d, _, c in brute_components([(r.doc_id, r.text) for r in accepted])}
    rows = sorted((r for r in accepted if components[r.doc_id] == r.doc_id), key=lambda r: r.doc_id)

    data = [(r.doc_id, r.text.encode()) for r in rows]
    texts = {}
    for (doc_id, raw), hit in zip(data, covered(data, 50)):
        left = bytes(b for b, h in zip(raw, hit) if not h).decode(errors="ignore")
        if left.strip(" ") or not any(hit):
            texts[doc_id] = left

    clean = {d for d, _, hit, _ in brute_hits(list(texts.items()), benchmark) if not hit}
    source = {r.doc_id: r.source for r in rows}
    size = {d: len(texts[d].encode().split()) for d in clean}
    sizes = {}
    for d in clean:
        sizes[source[d]] = sizes.get(source[d], 0) + size[d]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    targets = mixing.capped_targets(sizes, weights, sum(sizes.values()))

    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r["size"] for r in got} == size
    taken = {}
    for r in got:
        assert (r.source_size, r.target) == (sizes[source[r.doc_id]], targets[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert taken == {s: round(t) for s, t in targets.items()}


def _rows(n):
    r = random.Random(4)
    words = lambda k: " ".join(r.choice(["an", "be", "cé", "do.", "eel", *(f"w{i}" for i in range(60))]) for _ in range(k))
    rows = [(i, words(r.choice([0, 1, 30, 80])), "en", r.choice(["a", "b", None]), 5) for i in range(n)]
    rows[3] = (3, rows[2][1] + "x", "en", "a", 1)
    return rows + [(900, None, None, None, None), (None, "lost " * 30, None, "b", 0), (None, "lost " * 30, None, "b", 0), rows[5]]


@pytest.mark.parametrize("rows", [[], _rows(30)], ids=["empty", "mixed"])
def test_stages_take_any_table(spark, rows):
    """Nulls, empty tables, repeated rows and further columns pass through every stage."""
    docs = spark.createDataFrame([(*r, b"x") for r in rows], FIELDS + ", _text binary").repartition(2)
    before = len(rows)
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "mixture":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        assert docs.count() <= before
        before = docs.count()


def test_reruns_agree(spark):
    def digest():
        rows = sorted(tuple(map(str, r)) for r in mixing.mix_documents(registry.table(spark, SF_DIR, "documents").repartition(3)).collect())
        return hashlib.sha256(repr(rows).encode()).hexdigest()

    assert digest() == digest()


def test_near_duplicates_keep_one_row_per_component(spark):
    """Rows that share an id, or have none, are kept and dropped by their own texts."""
    r = random.Random(7)
    texts = [" ".join(f"w{r.randrange(10_000)}" for _ in range(60)) for _ in range(8)]
    near = [text + " more" for text in texts]
    rows = [
        (1, texts[0]),
        # A null text and two clean ones under one id: all stay.
        (2, None),
        (2, texts[1]),
        (2, texts[2]),
        # One row of the id is a near copy, the other is clean.
        (3, near[0]),
        (3, texts[3]),
        # Near copies under one id, and without one: the least text stays.
        (4, texts[4]),
        (4, near[4]),
        (None, near[5]),
        (None, texts[5]),
        (None, texts[5]),
        # Copies without an id go before those with one.
        (None, texts[1]),
        (None, near[0]),
        (None, texts[6]),
        # Without words.
        (None, " "),
        (None, None),
        (5, ""),
        (5, ""),
        (6, ""),
    ]
    docs = spark.createDataFrame([(*row, "en", "a", 1) for row in rows], FIELDS).repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).select("doc_id", "text").collect()
    kept = [(1, texts[0]), (2, None), (2, texts[1]), (2, texts[2]), (3, texts[3]), (4, texts[4])]
    kept += [(None, texts[5]), (None, texts[6]), (None, " "), (None, None), (5, ""), (6, "")]
    assert sorted(map(tuple, got), key=str) == sorted(kept, key=str)
