"""Near-duplicate documents: a Jaccard join on word n-grams by token-combination prefixes.

A document's tokens are its distinct n-grams.  Two sets of similarity ``t`` differ
in few tokens: a set of ``n`` tokens loses at most ``n - ceil(t n)``, its *slack*.
All tokens stand in one order, rare ones first, and a document's *prefix* is as
much of its tokens as no such loss can clear of shared signatures:

* lone and rare tokens are signatures one by one, each adds 1 to what the prefix
  can lose;
* frequent tokens, which would gather large groups, are signatures in pairs.  They
  are dealt to ``SUBCLASSES`` by hash, and pairs are formed inside a subclass, so
  each token but the first of its subclass adds 1 and the prefix extends until
  the sum exceeds the slack.

Similar sets then share a signature.  Lone tokens are in no other document and
need not be sent: a document with more of them than its slack is similar to none,
and is done.  How frequent a token is comes from a census (``census``).  Sets of
fewer than ``SHORT`` tokens may have too few to pair: pairs of sets of which one is
short are found by prefixes of single tokens only.

Equal sets are one node.  Inside a signature's group every set is compared with the
group's center, the set with the fewest lone tokens, and components are made of the
links.  After that only sets of different components are compared, and of those only
pairs that can be similar by what they differ from their center in.  Let ``D`` be
the tokens that a set and the center ``c`` do not share.  For any ``c``

    |x ^ y| = |Dx| + |Dy| - 2 |Dx & Dy|

and two sets are similar if ``(100 + t) |x ^ y| <= (100 - t) (|x| + |y|)``.  With the *excess*
``e = (100 + t) |D| - (100 - t) n`` that is ``2 (100 + t) |Dx & Dy| >= ex + ey``.  Lone tokens are
in no other set's difference, so ``|Dx & Dy|`` is at most the rest of either difference, and
with the *reach* ``a = 2 (100 + t) (|D| - lone) - e``, the excess that a set can make up for, similar
sets have ``ex <= ay`` and ``ey <= ax``.  A set whose excess is over the largest reach in the other
components around its center is similar to none of them; that is seen from one number per
center.  Pairs with the center itself are known already.  What is left is
joined, and pairs that share too few of the lower half of their tokens to make up for it in
the other are dropped before whole sets are compared.  No link between components is missed,
and no group's pairs are listed while its sets are linked.

Texts without words are linked with nothing and are their own component.  Null
texts have no words.  Rows are nodes by their sets, so rows that repeat an id are
compared like others.  A component's id is the smallest id in it; null ids count
for none, and a component of null ids only has a null id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import census, hashing
from tidemark.llm.components import components
from tidemark.session import materialise

N_WORDS = 5
PERCENT = 75
FREQUENT = 1000
SUBCLASSES = 64
SHORT = 96
#: As many pairs, of less than 100 bytes each, are broadcast at most.
BROADCAST_PAIRS = 100_000
#: Of text, at the least; every word begins a token.
BYTES_PER_TOKEN = 8
_HALF = np.uint64(1 << 63)
_SALTS = {"single": np.uint64(0x1D8E4E27C47D124F), "short": np.uint64(0xEB44ACCAB455D165)}


def token_sets(texts: list[bytes], n_words: int = N_WORDS) -> list[np.ndarray]:
    """Sorted hashes of the distinct n-grams of each text; of the whole text if it has fewer words."""
    found: list[np.ndarray] = []
    for a in range(0, len(texts), 64):
        part = texts[a : a + 64]
        data = hashing.LOWER[np.frombuffer(b"\n".join(part), np.uint8)]
        starts, ends = hashing.words(data)
        values = hashing.stretches(hashing.byte_values(data), starts, ends)
        bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(text) + 1 for text in part])]))
        grams = hashing.grams(values, n_words)
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if j - i >= n_words:
                found.append(np.unique(grams[i : j - n_words + 1]))
            elif j > i:
                found.append(hashing.grams(values[i:j], j - i) ^ np.uint64(j - i))
            else:
                found.append(np.zeros(0, np.uint64))
    return found


def slack(n: int, percent: int = PERCENT) -> int:
    """How many of its tokens a set can lose to a similar one."""
    return n - -(-percent * n // 100)


def signatures(tokens: np.ndarray, verdict: np.ndarray, percent: int, subclasses: int, short: int) -> tuple[np.ndarray, bool]:
    """Signatures of a sorted set, given the verdicts on its tokens; whether the prefix is long enough."""
    n, need = len(tokens), slack(len(tokens), percent) + 1
    lone = int((verdict == census.LONE).sum())
    if lone >= need:
        return np.zeros(0, np.uint64), True
    rare, frequent = tokens[verdict == census.SHARED], tokens[verdict == census.HOT]
    found, enough = [], True
    if 100 * n < 100 * 100 * short // percent + 100:
        single = np.concatenate([rare, frequent])[: need - lone]
        found.append(hashing.mixed(single ^ _SALTS["short"]))
    if n >= short:
        left = need - lone
        single = rare[:left]
        left -= len(single)
        if left and len(frequent):
            subclass = (hashing.mixed(frequent) % np.uint64(subclasses)).astype(np.int64)
            order = np.argsort(subclass, kind="stable")
            begin = np.flatnonzero(np.diff(subclass[order], prepend=-1))
            later = np.ones(len(frequent), bool)
            later[order[begin]] = False
            reach = np.cumsum(later)
            end = int(np.searchsorted(reach, left)) + 1 if reach[-1] >= left else len(frequent)
            left -= int(reach[end - 1])
            used, group = frequent[:end], subclass[:end]
            for g in np.unique(group).tolist():
                own = used[group == g]
                i, j = np.triu_indices(len(own), 1)
                found.append(hashing.mixed(hashing.mixed(own[i]) + own[j]))
        enough = left <= 0
        found.append(hashing.mixed(single ^ _SALTS["single"]))
    return np.unique(np.concatenate(found)), enough


def _mark(tokens: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    ends = np.array([len(tokens)])
    return b"".join(hashing.stretches(tokens, np.zeros(1, np.int64), ends, lane).tobytes() for lane in (0, 1))


_SETS = (
    "doc_id long, n_shingles long, node binary, number long, lone int, sigs array<bigint>, tokens binary, "
    "enough boolean, _copies long"
)
_NAMES = [part.split(" ")[0] for part in _SETS.split(", ")]


def _sets(docs: DataFrame, id_col: str, text_col: str, n_words: int, percent: int, frequent: int, subclasses: int, short: int, home_bytes: int, keep_cols: tuple[str, ...]) -> DataFrame:
    """One row per document and its copies, with its node; signatures and tokens once per home and node, where there are any.

    ``number`` names a node more shortly, by its home and first place in it.
    """
    n_homes = census.parts_for(docs, text_col, home_bytes)
    homes = census.at_home(docs, id_col, text_col, keep_cols, n_homes)
    n_buckets = census.buckets_for(n_homes, home_bytes, BYTES_PER_TOKEN)
    schema = T.StructType([*T.StructType.fromDDL(_SETS).fields, *(docs.schema[name] for name in keep_cols)])

    def count(home: int, table: pa.Table) -> pa.Table:
        sets = token_sets(table.column("_text").to_pylist(), n_words)
        keys, counts = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
        return census.tags(home, keys, counts, n_buckets)

    def sign(home: int, table: pa.Table, told: pa.Table) -> pa.Table:
        sets = token_sets(table.column("_text").to_pylist(), n_words)
        keys = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64))
        verdict = census.verdicts(keys, n_buckets, told)
        nodes, numbers, lone, sigs, sent, enough = [], [], [], [], [], []
        seen: dict[bytes, int] = {}
        for tokens in sets:
            node = _mark(tokens) if len(tokens) else None
            own, whole = None, True
            of_tokens = verdict[np.searchsorted(keys, tokens)]
            lone.append(int((of_tokens == census.LONE).sum()))
            if node is not None and node not in seen:
                seen[node] = home << 32 | len(seen)
                own, whole = signatures(tokens, of_tokens, percent, subclasses, short)
            some = own is not None and len(own) > 0
            nodes.append(node)
            numbers.append(seen.get(node))
            sigs.append(own.view(np.int64) if some else None)
            sent.append(tokens.tobytes() if some else None)
            enough.append(whole)
        columns = [
            table.column("_id"),
            pa.array([len(tokens) for tokens in sets], pa.int64()),
            pa.array(nodes, pa.binary()),
            pa.array(numbers, pa.int64()),
            pa.array(lone, pa.int32()),
            pa.array(sigs, pa.list_(pa.int64())),
            pa.array(sent, pa.binary()),
            pa.array(enough, pa.bool_()),
            table.column("_copies"),
            *(table.column(name) for name in keep_cols),
        ]
        return pa.Table.from_arrays(columns, [*_NAMES, *keep_cols])

    return census.with_answers(homes, census.take_census(homes, count, frequent), sign, schema)


def _beside(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Written ``pairs`` (x, y) with ``n`` and ``of`` of both sides, from ``sets`` (number, n, of)."""
    x, y = (sets.select(F.col("number").alias(c), F.col("n").alias(f"n_{c}"), F.col("of").alias(f"of_{c}")) for c in "xy")
    if pairs.count() > BROADCAST_PAIRS:
        both = pairs.select("x", "y").join(x, "x").join(y, "y")
    else:
        # Few pairs go to the sets, so that only the sets of pairs move.
        few = F.broadcast(pairs.select("x", "y"))
        both = x.join(few, "x").join(y.join(few, "y"), ["x", "y"])
    return both.select("x", "y", "n_x", "n_y", "of_x", "of_y")


def _halves(sets: DataFrame) -> DataFrame:
    """Sets with the lower half of their tokens, shortened to 16 bits, in order."""

    def run(batches):
        for batch in batches:
            tokens = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
            lower = [t[: np.searchsorted(t, _HALF)] >> np.uint64(47) for t in tokens]
            packed = pa.array([low.astype(np.uint16).tobytes() for low in lower], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["number", "n", "of"])

    return sets.select("number", "n", "of").mapInArrow(run, "number long, n long, of binary")


def most_shared(a: np.ndarray, n: int, b: np.ndarray, m: int) -> int:
    """The most tokens that sets of sizes ``n`` and ``m`` with these shortened halves can share."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    return int(np.minimum(ca[i], cb[j]).sum()) + min(n - len(a), m - len(b))


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that share enough of their lower halves to be similar."""

    def run(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                a, b = np.frombuffer(x.as_buffer(), np.uint16), np.frombuffer(y.as_buffer(), np.uint16)
                most = most_shared(a, n, b, m)
                keep.append(100 * most >= percent * (n + m - most))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["x", "y"])

    return _beside(pairs, _halves(sets)).mapInArrow(run, "x long, y long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with how many tokens only one of them has (``differ``) and ``linked``: whether they are similar."""

    def run(batches):
        for batch in batches:
            linked, differ = [], []
            for x, y in zip(batch.column(4), batch.column(5)):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                whole = len(a) + len(b) - both
                linked.append(100 * both >= percent * whole)
                differ.append(whole - both)
            columns = [batch.column(0), batch.column(1), pa.array(differ, pa.int64()), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["x", "y", "differ", "linked"])

    return _beside(pairs, sets).mapInArrow(run, "x long, y long, differ long, linked boolean")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_words: int = N_WORDS,
    percent: int = PERCENT,
    frequent: int = FREQUENT,
    subclasses: int = SUBCLASSES,
    short: int = SHORT,
    home_bytes: int = census.HOME_BYTES,
    keep_cols: tuple[str, ...] = (),
    component_col: str | None = None,
) -> DataFrame:
    """Per document: id, ``n_shingles`` and ``component_id``, the smallest id that links lead to.

    ``keep_cols`` are handed through.  ``component_col`` adds a number that the rows of a component
    share and no others, whatever their ids; it is null for texts without words.
    """
    while True:
        options = (id_col, text_col, n_words, percent, frequent, subclasses, short, home_bytes, keep_cols)
        every = materialise(_sets(docs, *options), "token-sets")
        # A prefix can fall short where hashes deal a set's tokens badly: then sets of that size count as short.
        wanting = every.agg(F.max(F.when(~F.col("enough"), F.col("n_shingles"))).alias("n")).first()["n"]
        if wanting is None:
            break
        short = math.ceil(100 * (wanting + 1) / percent)
    signed = every.where("sigs IS NOT NULL")
    # Equal sets of several homes are one node, that of the least number.
    first = signed.groupBy("node").agg(F.min("number").alias("first"), F.count("*").alias("homes")).where("homes > 1")
    again = signed.select("node", "number").join(first, "node").where("number <> first").select("number")
    again = materialise(again, "equal-sets")
    again = F.broadcast(again) if again.count() <= BROADCAST_PAIRS else again
    signed = signed.join(again, "number", "left_anti")
    sets = signed.select("number", F.col("n_shingles").alias("n"), F.col("tokens").alias("of"))
    members = signed.select(
        "number", F.col("n_shingles").cast("int").alias("n"), F.col("lone").alias("l"), F.explode("sigs").alias("sig")
    )
    # Only signatures of several nodes make pairs; the node of the fewest lone tokens is the center.
    centers = (
        members.groupBy("sig")
        .agg(F.min(F.struct("l", "number", "n")).alias("c"), F.min("number").alias("a"), F.max("number").alias("b"))
        .where("a < b")
        .select("sig", F.col("c.number").alias("center"), F.col("c.n").alias("m"), F.col("c.l").alias("k"))
    )
    grouped = materialise(members.join(centers, "sig"), "groups")
    tried = (
        grouped.where("number <> center")
        .select(F.greatest("number", "center").alias("x"), F.least("number", "center").alias("y"))
        .distinct()
    )
    tried = materialise(tried, "center-pairs")
    seen = materialise(_verified(tried, sets, percent), "center-verified")
    labels = components(seen.where("linked"))

    # What is left: centers whose nodes are in several components.
    few = labels.count() <= BROADCAST_PAIRS and seen.count() <= BROADCAST_PAIRS
    of_node = labels.withColumnRenamed("node", "number")
    known = seen.select(F.col("x").alias("number"), F.col("y").alias("center"), "differ")
    known = known.union(seen.select("y", "x", "differ"))
    # A node once per center, with the signatures that it shares with it, so that a pair is found once.
    around = grouped.groupBy("center", "number", "n", "l").agg(F.collect_list("sig").alias("sigs"))
    differ = F.when(F.col("number") == F.col("center"), 0).otherwise(F.col("differ"))
    excess = (100 + percent) * F.col("differ") - (100 - percent) * F.col("n")
    named = (
        around.join(F.broadcast(of_node) if few else of_node, "number", "left")
        .join(F.broadcast(known) if few else known, ["number", "center"], "left")
        .withColumn("differ", differ)
        .select(
            "center",
            "number",
            "sigs",
            F.coalesce("label", "number").alias("label"),
            excess.alias("excess"),
            (2 * (100 + percent) * (F.col("differ") - F.col("l")) - excess).alias("reach"),
        )
    )
    several = named.groupBy("center").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    split = materialise(named.join(several.drop("most"), "center"), "split-groups")
    # The largest reach of a component and of all others but that one.
    of_label = split.groupBy("center", "label").agg(F.max("reach").alias("reach"))
    first = of_label.groupBy("center").agg(F.max(F.struct("reach", "label")).alias("first"))
    other = of_label.join(first, "center").where(F.col("label") != F.col("first.label"))
    second = other.groupBy("center", "first").agg(F.max("reach").alias("second"))
    most = F.when(F.col("label") == F.col("first.label"), F.col("second")).otherwise(F.col("first.reach"))
    near = split.join(second, "center").where(F.col("excess") <= most)
    near = materialise(near.select("center", "number", "sigs", "label", "least", "excess", "reach"), "within-reach")
    # Of two components one is not the least: its nodes are compared with all others.
    outside = near.where("label <> least").select(
        "center",
        F.col("number").alias("x"),
        F.col("sigs").alias("own_sigs"),
        F.col("label").alias("own"),
        F.col("excess").alias("e"),
        F.col("reach").alias("a"),
    )
    inside = near.select("center", F.col("number").alias("y"), "sigs", "label", "least", "excess", "reach")
    rest = (
        outside.join(inside, "center")
        # Of two nodes outside the least component, one order is enough.
        .where("own <> label AND (label = least OR x > y) AND e <= reach AND excess <= a")
        .where(F.arrays_overlap("own_sigs", "sigs"))
        .select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        .distinct()
        .join(tried, ["x", "y"], "left_anti")
    )
    possible = materialise(_possible(materialise(rest, "rest-pairs"), sets, percent), "rest-possible")
    found = materialise(_verified(possible, sets, percent), "rest-verified").where("linked")
    if not found.isEmpty():
        labels = components(found, labels)

    by_node = every.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("number").alias("number"))
    placed = by_node.join(labels.withColumnRenamed("node", "number"), "number", "left")
    least = placed.where("label IS NOT NULL").groupBy("label").agg(F.min("least").alias("component_id"))
    of_node = placed.join(least, "label", "left").select(
        "node",
        F.when(F.col("label").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("label", "number").alias("_component"),
    )
    final = every.select("doc_id", "n_shingles", "node", "_copies", *keep_cols).join(of_node, "node", "left")
    return census.repeated(final).select(
        F.col("doc_id").alias(id_col),
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        *keep_cols,
        *([F.col("_component").alias(component_col)] if component_col else []),
    )
