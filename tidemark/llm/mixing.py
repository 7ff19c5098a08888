"""Mixing sources to target weights by a min-cost flow.

Documents that belong to the same set of sources are one *pattern*.  Tokens flow
from patterns to the quotas of their sources; the first use of a pattern's tokens
costs nothing, the second use 1, the third 2, so that the flow meets the quotas
with as few repetitions as it can and spreads them evenly.  The flow runs over
patterns and sources only, never over documents, and apart for patterns that no
chain of shared sources connects: in tasks of many such components, nothing on the driver.
So there may be any number of sources; sources that do overlap, directly or by
others, are one task's work.

Each pattern's documents then stand in a seeded order on a line, as often as its
tokens may be used; the flow's share for each source is a stretch of that line,
and a document gives a source the words of its that lie in the stretch.  Sums
along the line are running totals over ranges of it, so that a pattern with most of
the documents, or an id that most of them have, is spread over many tasks.

A null source is a source of its own, last in order; null sources instead of an
array are none, and nothing is taken of such rows.  Null or negative sizes count
as 0.  Rows that repeat an id count each by itself; a null id has a place in the
order like any other.  Rows that tie in it are put in order by their other columns.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.operators.ordered import running_total
from tidemark.session import materialise

MAX_REPEATS = 3
WEIGHTS = (5, 2, 1)
#: Components are dealt to tasks of about this many arcs.
ARCS_PER_TASK = 10_000


def capped_targets(sizes: dict, weights: dict, total: float, max_repeats: int = MAX_REPEATS) -> dict:
    """Shares of ``total`` by weight, none above ``max_repeats`` sizes, the excess shared again by weight."""
    level = {source: max_repeats * sizes[source] / weights[source] for source in sizes}
    left, weight = float(total), float(sum(weights[source] for source in sizes))
    targets = {}
    for source in sorted(sizes, key=lambda s: level[s]):
        # Sources in the order in which a rising level reaches their limits.
        if weight and left / weight > level[source]:
            targets[source] = float(max_repeats * sizes[source])
            left -= targets[source]
            weight -= weights[source]
        else:
            break
    return {source: targets.get(source, weights[source] * left / weight if weight else 0.0) for source in sizes}


def min_cost_flow(
    patterns: dict[str, tuple[int, list]], quotas: dict, max_repeats: int = MAX_REPEATS
) -> dict[tuple[str, object], int]:
    """Tokens from each pattern to each of its sources.

    ``patterns`` maps a pattern to its size and sources.  Shortest augmenting
    paths with potentials; arc ``k`` into a pattern has the pattern's size as
    capacity and ``k - 1`` as cost.
    """
    flow: dict[tuple[str, object], int] = defaultdict(int)
    used: dict[str, int] = defaultdict(int)
    filled: dict[object, int] = defaultdict(int)
    users: dict[object, list[str]] = defaultdict(list)
    for pattern, (_, sources) in patterns.items():
        for source in sources:
            users[source].append(pattern)

    def cost(pattern: str) -> int:
        """Cost of the next token of a pattern."""
        return used[pattern] // patterns[pattern][0]

    for quota_source in sorted(quotas, key=lambda s: (s is None, s)):
        while filled[quota_source] < quotas[quota_source]:
            # From the quota back to a pattern with free tokens, through patterns that
            # serve this source and could be replaced at the sources that they serve.
            best: dict[object, int] = {quota_source: 0}
            via: dict[object, tuple[str, object]] = {}
            queue = [(0, 0, quota_source)]
            order = 1
            ends: tuple[int, str, object] | None = None
            seen: set[str] = set()
            while queue:
                distance, _, source = heapq.heappop(queue)
                if distance > best[source]:
                    continue
                for pattern in users[source]:
                    size = patterns[pattern][0]
                    if size and used[pattern] < max_repeats * size:
                        reached = distance + cost(pattern)
                        if ends is None or reached < ends[0]:
                            ends = (reached, pattern, source)
                    if pattern in seen:
                        continue
                    seen.add(pattern)
                    for other in patterns[pattern][1]:
                        if flow[pattern, other] > 0 and distance < best.get(other, math.inf):
                            best[other] = distance
                            via[other] = (pattern, source)
                            heapq.heappush(queue, (distance, order, other))
                            order += 1
            if ends is None:
                break
            _, pattern, source = ends
            size = patterns[pattern][0]
            amount = min((used[pattern] // size + 1) * size - used[pattern], quotas[quota_source] - filled[quota_source])
            path, at = [], source
            while at in via:
                path.append((via[at][0], at, via[at][1]))
                at = via[at][1]
            amount = min([amount, *(flow[middle, giver] for middle, giver, _ in path)])
            used[pattern] += amount
            flow[pattern, source] += amount
            for middle, giver, taker in path:
                flow[middle, giver] -= amount
                flow[middle, taker] += amount
            filled[quota_source] += amount
    return {arc: amount for arc, amount in flow.items() if amount}


def seeded_order(id_col: str, seed: int) -> Column:
    """A text that puts the rows into a random order that every engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _connected(arcs: DataFrame) -> DataFrame:
    """``arcs`` with ``_component``, which patterns and sources share that a chain of arcs connects."""
    source = F.concat(F.lit("s"), F.coalesce(F.concat(F.lit(":"), F.col("source").cast("string")), F.lit("")))
    arcs = arcs.withColumn("_node", source)
    # Only patterns of several sources connect what would be apart.
    links = arcs.where("n_sources > 1").select(F.concat(F.lit("p:"), "pattern").alias("x"), F.col("_node").alias("y"))
    if links.isEmpty():
        return arcs.withColumnRenamed("_node", "_component")
    labels = components(links).withColumnRenamed("node", "_node")
    return arcs.join(labels, "_node", "left").withColumn("_component", F.coalesce("label", "_node"))


def route(arcs: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The min-cost flow of ``arcs``: ``pattern``, ``pattern_size`` and ``flow``, its tokens to all its sources.

    An arc is a ``pattern`` (text) with ``pattern_size`` and ``n_sources``, one ``source`` of these and its ``quota``.
    """

    def run(given: pd.DataFrame) -> pd.DataFrame:
        patterns: dict[str, tuple[int, list]] = {}
        quotas = {}
        for row in given.sort_values("pattern").itertuples():
            source = None if pd.isna(row.source) else row.source
            patterns.setdefault(row.pattern, (row.pattern_size, []))[1].append(source)
            quotas[source] = row.quota
        for _, sources in patterns.values():
            sources.sort(key=lambda s: (s is None, s))
        flow: dict[str, int] = defaultdict(int)
        for (pattern, _), amount in min_cost_flow(patterns, quotas, max_repeats).items():
            flow[pattern] += amount
        rows = [(pattern, pattern_size, flow[pattern]) for pattern, (pattern_size, _) in patterns.items()]
        return pd.DataFrame(rows, columns=["pattern", "pattern_size", "flow"])

    # Components do not touch each other, so that one flow can run over several.
    tasks = math.ceil(arcs.count() / ARCS_PER_TASK) or 1
    task = F.pmod(F.xxhash64("_component"), F.lit(tasks)).alias("_task")
    dealt = _connected(arcs).select(task, "pattern", "pattern_size", "source", "quota")
    return dealt.groupBy("_task").applyInPandas(run, "pattern string, pattern_size long, flow long")


def mix(
    docs: DataFrame,
    quotas: dict | DataFrame,
    id_col: str = "doc_id",
    size_col: str = "size",
    sources_col: str = "sources",
    max_repeats: int = MAX_REPEATS,
    seed: int = 0,
) -> DataFrame:
    """``docs`` with ``pattern`` and ``taken``: the words the mix takes of each document, repeats counted.

    ``quotas`` maps a source to its number of tokens, as a dict or a table of ``source`` and ``quota``;
    ``sources_col`` is an array of sources.  ``docs`` is written in between: it should be narrow.
    """
    kind = docs.schema[sources_col].dataType
    if isinstance(quotas, dict):
        fields = f"source {kind.elementType.simpleString()}, quota long"
        quotas = docs.sparkSession.createDataFrame(list(quotas.items()), fields)
    size = F.greatest(F.coalesce(F.col(size_col), F.lit(0)), F.lit(0)).cast("long")
    of = F.array_sort(F.array_distinct(F.coalesce(F.col(sources_col), F.array().cast(kind))))
    rows = materialise(
        docs.select(
            "*",
            F.to_json(of).alias("pattern"),
            size.alias("_size"),
            seeded_order(id_col, seed).alias("_order"),
            F.xxhash64(*docs.columns).alias("_rest"),
        ),
        "mix-rows",
    )
    sums = rows.groupBy("pattern").agg(F.any_value(of).alias("of"), F.sum("_size").alias("pattern_size"))
    arcs = sums.select("pattern", "pattern_size", F.size("of").alias("n_sources"), F.explode("of").alias("_source"))
    arcs = arcs.join(quotas, F.col("_source").eqNullSafe(F.col("source")), "left").select(
        "pattern", "pattern_size", "n_sources", F.col("_source").alias("source"), F.coalesce("quota", F.lit(0)).alias("quota")
    )
    line = materialise(route(materialise(arcs, "mix-arcs"), max_repeats), "mix-flow")

    placed = running_total(rows, ["pattern"], ["_order", "_size", "_rest"], "_size", "_end")
    placed = placed.withColumn("_start", F.col("_end") - F.col("_size")).join(line, "pattern", "left")
    flow, whole = F.coalesce("flow", F.lit(0)), F.coalesce("pattern_size", F.lit(0))
    taken = sum(
        (
            F.least(F.col("_size"), F.greatest(F.lit(0), flow - F.lit(lap) * whole - F.col("_start")))
            for lap in range(max_repeats)
        ),
        F.lit(0),
    )
    return placed.select(*docs.columns, "pattern", taken.cast("long").alias("taken"))


WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of every source, as ``capped_targets`` shares out all sizes.

    ``sizes`` has the first two.  Weights repeat in the order of the sources.  Each round
    caps the sources whose limit lies below the level that the others would reach, which lifts the
    level; it ends when none is.  Only the level reaches the driver.
    """
    placed = sizes.select("source", "source_size", F.lit(0).alias("_all"), F.col("source").isNull().alias("_none"), F.lit(1).alias("_one"))
    placed = running_total(placed, ["_all"], ["_none", "source"], "_one", "_rank")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("_rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    limit = F.lit(max_repeats) * F.col("source_size")
    levels = materialise(
        placed.select("source", "source_size", weight.alias("w")).withColumn("lv", limit / F.col("w")), "mix-sources"
    )
    total = levels.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, free, left = 0.0, 0, 0.0
    while True:
        capped = F.col("lv") < F.lit(level)
        sums = levels.agg(F.sum(F.when(capped, limit)).alias("used"), F.sum(F.when(~capped, F.col("w"))).alias("free")).first()
        left, found = float(total - (sums["used"] or 0)), sums["free"] or 0
        if not found or found == free:
            break
        free, level = found, left / found
    share = F.col("w") * F.lit(left) / F.lit(float(free or 1))
    return levels.select(
        "source", "source_size", F.when(F.col("lv") < F.lit(level), limit.cast("double")).otherwise(share).alias("target")
    )


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0
) -> DataFrame:
    """Documents with one source each, mixed to the weights 5, 2, 1, repeating in the order of the sources."""
    sized = docs.select(
        F.col(id_col),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.array(source_col).alias("sources"),
    )
    sized = materialise(sized, "mix-sizes")
    sizes = sized.groupBy(F.col("sources")[0].alias("source")).agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sizes), "mix-targets")
    mixed = mix(sized, targets.select("source", F.bround("target").cast("long").alias("quota")), id_col, seed=seed)
    joined = mixed.join(targets, F.col("sources")[0].eqNullSafe(F.col("source")))
    return joined.select(id_col, "size", "source_size", "target", "taken")


#: SQL for the rows of ``mix_documents`` with seed 0.
ORACLE_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM {documents}
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
    FROM sized GROUP BY source
), levels AS (
    SELECT *, 3 * source_size / CAST(w AS DOUBLE) AS lv,
           CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(3.0 * source_size) OVER (ORDER BY 3 * source_size / CAST(w AS DOUBLE), source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
           sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 3 * source_size / CAST(w AS DOUBLE), source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ws
    FROM sources
), level AS (
    SELECT arg_min(CAST(room AS DOUBLE), lv) AS room, arg_min(CAST(ws AS DOUBLE), lv) AS ws
    FROM levels WHERE room / ws <= lv
), targets AS (
    SELECT s.source, s.source_size,
           CASE WHEN level.ws IS NULL OR 3 * s.source_size / CAST(s.w AS DOUBLE) < level.room / level.ws
                THEN 3.0 * s.source_size ELSE s.w * level.room / level.ws END AS target
    FROM sources s CROSS JOIN level
), placed AS (
    SELECT d.doc_id, d.size, CAST(t.source_size AS BIGINT) AS source_size, CAST(t.target AS DOUBLE) AS target,
           CAST(round_even(t.target, 0) AS BIGINT) AS flow,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(size, greatest(0, flow - s)) + least(size, greatest(0, flow - source_size - s))
            + least(size, greatest(0, flow - 2 * source_size - s)) AS BIGINT) AS taken
FROM placed
"""
