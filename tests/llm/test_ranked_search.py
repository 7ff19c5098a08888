"""Ranked search against a brute-force version."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm.ranked_search import bitmap_of, item_terms, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def brute(docs, items, top=10):
    counted = [(doc_id, terms_of(text)) for doc_id, text in docs]
    counted = [(doc_id, terms, terms.total()) for doc_id, terms in counted if terms]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(term for _, terms, _ in counted for term in terms)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, terms, n in counted:
            m, score = 100 - 75 + (75 * n * n_docs) // n_terms, 0
            for term, times in terms_of(text).items():
                if tf := terms[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:top], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def case(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "Wé", "naïve", "x1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: "".join(w.upper() * (r.random() < 0.1) or w + r.choice([" ", ", ", "\n", "_"]) for w in r.choices(words, weights, k=n))
    docs = [(i * 7 % 211, text(r.choice([1, 3, 20, 60]))) for i in range(211)]
    items = [(i, text(r.choice([1, 4, 12]))) for i in range(9)]
    docs += [(300 + i, items[i % 9][1] + text(3)) for i in range(30)]
    docs += [(400, None), (401, ""), (402, " .,"), docs[3], docs[3], (docs[4][0], text(9)), (None, items[0][1]), (None, text(30))]
    docs += [(403, "w1 w50 " * 3000)]
    items += [(9, None), (10, "??"), (11, "unknown"), items[0], (None, items[1][1]), (12, " ".join(words) * 3)]
    r.shuffle(docs)
    return docs, items


SETTINGS = [
    {},
    {"block_docs": 7, "bundle_items": 3, "top": 3},
    {"block_postings": 40, "cuts": (4000, 3000, 2000, 1500, 1000, 500), "bitmap_bytes": 1},
    {"cuts": (), "top": 1, "bundle_items": 1},
]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("options", SETTINGS)
def test_against_brute_force(spark, seed, options):
    docs, items = case(seed)
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    assert got(rank_documents(left, right, **options)) == brute(docs, items, options.get("top", 10))


def test_many_ties(spark):
    """A third of all documents are equal: the smallest ids come first."""
    docs = [(1000 - i, "same text") for i in range(200)] + [(i, f"other{i} words") for i in range(400)]
    items = [(1, "same"), (2, "words text")]
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    right = spark.createDataFrame(items, "item_id long, text string")
    found = got(rank_documents(left, right, block_docs=16))
    assert found == brute(docs, items)
    assert [row[2] for row in sorted(found)[:10]] == list(range(801, 811))


def test_empty_tables(spark):
    docs, items = case(3)
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    assert rank_documents(left.limit(0), right).collect() == []
    assert rank_documents(left, right.limit(0)).collect() == []
    assert rank_documents(left.withColumn("text", F.lit(None).cast("string")), right).collect() == []


def test_clashing_names(spark):
    docs, items = case(4)
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    for name in ("block", "slot", "score", "rank", "term", "_id", "item_id"):
        left = left.withColumn(name, F.lit("x"))
    for name in ("bundle", "doc_id", "weight", "_item"):
        right = right.withColumn(name, F.lit("x"))
    assert got(rank_documents(left, right)) == brute(docs, items)


def test_bitmap_has_every_term(spark):
    import zlib

    items = spark.createDataFrame([(i, f"term{i} and {i * 31}") for i in range(300)], "item_id long, text string")
    terms = item_terms(items, "item_id", "text", 50)
    known = bitmap_of(terms, 64)
    assert len(known) == 64
    for row in terms.collect():
        place = zlib.crc32(bytes(row.term)) % 512
        assert known[place >> 3] >> (place & 7) & 1
