"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import WORD, free_name, picked, stored

#: A document is used at most so often; each further use costs more, so that repeats come last.
USES = 3
#: Weights of the sources in order, over and over.
WEIGHTS = (5, 2, 1)
#: Documents of a pattern that are looked at one by one (those at the edge of its share).
BUCKET_DOCS = 1_000
#: Patterns and sources are planned on the driver; more than this is an error, never a silent cut.
PLAN_LIMIT = 200_000


def targets(sizes: dict, weights: tuple[int, ...] = WEIGHTS, uses: int = USES) -> dict:
    """Words due from each source: all words by weight, none above ``uses`` times its size.

    Sources go by code point, null last. What exceeds a source's limit is shared again by weight
    among those below theirs.
    """
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, found = float(sum(sizes.values())), order, {}
    while free:
        share = left / sum(weight[s] for s in free)
        full = [s for s in free if share * weight[s] > uses * sizes[s]]
        if not full:
            found |= {s: share * weight[s] for s in free}
            break
        for s in full:
            found[s] = float(uses * sizes[s])
            left -= found[s]
        free = [s for s in free if s not in found]
    return found


def min_cost_flow(n: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc ``(from, to, capacity, cost)``: the largest flow, at the least cost of those.

    Primal-dual: distances give reduced costs, then everything that fits on arcs of reduced cost
    zero is sent at once, so the rounds are as many as there are different path costs.
    """
    head, room, price, out = [], [], [], [[] for _ in range(n)]
    for a, b, capacity, cost in arcs:
        for x, y, c, w in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out[x].append(len(head))
            head.append(y)
            room.append(c)
            price.append(w)
    infinite = float("inf")
    while True:
        distance, waiting, queued = [infinite] * n, deque([source]), [False] * n
        distance[source] = 0
        while waiting:
            x = waiting.popleft()
            queued[x] = False
            for e in out[x]:
                y = head[e]
                if room[e] and distance[x] + price[e] < distance[y]:
                    distance[y] = distance[x] + price[e]
                    if not queued[y]:
                        queued[y] = True
                        waiting.append(y)
        if distance[sink] == infinite:
            return [room[2 * i + 1] for i in range(len(arcs))]
        while True:  # levels among the cheapest arcs, then all augmenting paths along them
            level, waiting = [-1] * n, deque([source])
            level[source] = 0
            while waiting:
                x = waiting.popleft()
                for e in out[x]:
                    y = head[e]
                    if room[e] and level[y] < 0 and distance[x] + price[e] == distance[y]:
                        level[y] = level[x] + 1
                        waiting.append(y)
            if level[sink] < 0:
                break
            tried, path, x = [0] * n, [], source
            while True:
                if x == sink:
                    sent = min(room[e] for e in path)
                    for e in path:
                        room[e] -= sent
                        room[e ^ 1] += sent
                    path, x = [], source
                    continue
                while tried[x] < len(out[x]):
                    e = out[x][tried[x]]
                    y = head[e]
                    if room[e] and level[y] == level[x] + 1 and distance[x] + price[e] == distance[y]:
                        path.append(e)
                        x = y
                        break
                    tried[x] += 1
                else:
                    if x == source:
                        break
                    e = path.pop()
                    x = head[e ^ 1]
                    tried[x] += 1


def plan(patterns: dict[tuple, int], due: dict, uses: int = USES) -> dict[tuple, int]:
    """Words that each membership pattern gives, so that the sources get what is due to them."""
    names, kinds = list(due), list(patterns)
    place = {s: 2 + len(kinds) + i for i, s in enumerate(names)}
    arcs = []
    for i, kind in enumerate(kinds):
        arcs += [(0, 2 + i, patterns[kind], use * use) for use in range(uses)]
        arcs += [(2 + i, place[s], uses * patterns[kind], 0) for s in kind]
    arcs += [(place[s], 1, round(due[s]), 0) for s in names]
    flow = min_cost_flow(2 + len(kinds) + len(names), arcs, 0, 1)
    given, at = {}, 0
    for kind in kinds:
        given[kind] = sum(flow[at : at + uses])
        at += uses + len(kind)
    return given


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _pick(group: pd.DataFrame) -> pd.DataFrame:
    """Documents of an edge bucket in seeded order, each taken if it still fits, the last one to the nearest."""
    left = int(group["room"].iloc[0])
    group = group.sort_values(["h", "key", "size"])
    chosen = []
    for size in group["weight"].tolist():
        chosen.append(0 < size <= left)
        left -= size if chosen[-1] else 0
    rest = group.loc[[not c for c in chosen], "weight"]
    rest = rest[(rest > 0) & (rest < 2 * left)]
    group = group.assign(extra=[int(c) for c in chosen])
    if len(rest):  # rounding up by one more is nearer than stopping short
        group.loc[rest.idxmin(), "extra"] = 1
    return group[["pattern", "key", "size", "extra"]]


def mix(
    docs: DataFrame, *, key: Column, members: Column, size: Column, seed: int = 7, weights: tuple[int, ...] = WEIGHTS,
    uses: int = USES, bucket_docs: int = BUCKET_DOCS,
) -> tuple[DataFrame, dict, dict]:
    """Decisions as a stored table ``(pattern, key, size, taken)``, the sources' sizes and their targets.

    ``members`` is an array of sources that a document counts for (one or several, null among them).
    Documents are added up by pattern, and only those sums reach the driver, where the flow is
    solved: arcs into a pattern for its first, second and third use cost 0, 1 and 4, arcs from a
    pattern lead to its sources, and sources drain what is due to them. A pattern's share is then
    whole rounds of all its documents plus some documents once more. These are chosen by a seeded
    hash: buckets of hashes below the edge go in whole, the edge bucket (about ``bucket_docs``
    documents) is decided one by one, to within half a small document of the share. A hot pattern is
    thus never brought together. Rows with equal key, pattern and size are decided alike.
    """
    narrow = docs.select(
        F.array_sort(F.array_distinct(F.transform(members, lambda m: F.struct(m.isNull().alias("n"), m.alias("s"))))).alias("pattern"),
        key.alias("key"), size.cast("bigint").alias("size"),
    )
    items = narrow.groupBy("pattern", "key", "size").agg(F.count("*").alias("copies"))
    items = items.withColumn("weight", F.col("size") * F.col("copies")).withColumn("h", F.xxhash64("key", "size", F.lit(seed)))
    items = stored(items, "mix-items")
    sums = items.groupBy("pattern").agg(F.sum("weight").alias("weight"), F.count("*").alias("items"))
    found = sums.limit(PLAN_LIMIT + 1).collect()
    if len(found) > PLAN_LIMIT:
        raise ValueError(f"more than {PLAN_LIMIT} membership patterns")
    found = [(tuple(m.s for m in row.pattern), row) for row in found]
    sizes: dict = {}
    for kind, row in found:
        for s in kind:
            sizes[s] = sizes.get(s, 0) + row.weight
    total = sum(row.weight for _, row in found)
    due = targets(sizes, weights, uses)
    if sum(sizes.values()) > total:  # overlapping documents count once
        due = {s: d * total / sum(sizes.values()) for s, d in due.items()}
    given = plan({kind: row.weight for kind, row in found}, due, uses)
    spark, rows = docs.sparkSession, []
    for kind, row in found:
        rounds, rest = divmod(given[kind], row.weight) if row.weight else (0, 0)
        rows.append((row.pattern, rounds, rest, max(1, -(-row["items"] // bucket_docs))))
    schema = "pattern array<struct<n:boolean,s:string>>, rounds bigint, rest bigint, buckets bigint"
    shares = stored(spark.createDataFrame(rows, schema), "mix-shares")
    placed = items.join(shares, "pattern").withColumn("bucket", F.expr("shiftrightunsigned(h, 33) * buckets div 2147483648"))
    filled = stored(placed.groupBy("pattern", "buckets", "rest", "bucket").agg(F.sum("weight").alias("weight")), "mix-buckets")
    edges = stored(_edges(filled), "mix-edges")
    placed = placed.join(edges, "pattern")
    edge = placed.where(F.col("bucket") == F.col("edge")).select("pattern", "key", "size", "weight", "h", "room")
    kinds = "pattern array<struct<n:boolean,s:string>>, key {}, size bigint, extra int".format(narrow.schema["key"].dataType.simpleString())
    chosen = stored(edge.groupBy("pattern").applyInPandas(_pick, kinds), "mix-chosen")
    decided = placed.alias("p").join(
        chosen.alias("c"),
        (F.col("p.pattern") == F.col("c.pattern")) & F.col("p.key").eqNullSafe(F.col("c.key")) & (F.col("p.size") == F.col("c.size")),
        "left",
    )
    extra = F.when(F.col("bucket") < F.col("edge"), 1).when(F.col("bucket") == F.col("edge"), F.coalesce("extra", F.lit(0))).otherwise(0)
    taken = F.when(F.col("p.size") > 0, F.least(F.lit(uses), F.col("rounds") + extra) * F.col("p.size")).otherwise(0)
    decided = decided.select("p.pattern", "p.key", "p.size", taken.cast("bigint").alias("taken"))
    return stored(decided, "mix-taken"), sizes, due


def _edges(filled: DataFrame, step: int = 256) -> DataFrame:
    """Per pattern the bucket in which its remaining words run out, and the words left for that bucket.

    Sums of ever larger ranges of buckets are walked down from the top, so that no pattern's buckets
    have to stand in one task. A pattern with no words left, such as one without any, needs no walk.
    """
    none_left = filled.where("rest = 0").select("pattern", F.lit(0).cast("bigint").alias("edge"), F.lit(0).cast("bigint").alias("room")).distinct()
    filled = filled.where("rest > 0")
    levels = []
    level = filled.select("pattern", "buckets", "rest", F.col("bucket").alias("at"), "weight")
    top = filled.agg(F.max("buckets")).first()[0] or 1
    while True:
        levels.append(level)
        if top <= 1:
            break
        top = -(-top // step)
        level = level.groupBy("pattern", "buckets", "rest", F.expr(f"`at` div {step}").alias("at")).agg(F.sum("weight").alias("weight"))
    found = levels.pop().select("pattern", "rest", F.lit(0).cast("bigint").alias("edge"), F.col("rest").alias("room")).distinct()
    while levels:
        below = levels.pop().select("pattern", "at", "weight")
        inside = below.join(found, "pattern").where(F.expr(f"`at` div {step} = edge"))
        listed = inside.groupBy("pattern", "room").agg(F.sort_array(F.collect_list(F.struct("at", "weight"))).alias("list"))
        start = F.struct(F.lit(-1).cast("bigint").alias("edge"), F.col("room"), F.lit(False).alias("done"))

        def walk(state, item):
            fits = ~state["done"] & (item["weight"] <= state["room"])
            moved = F.struct(item["at"].alias("edge"), (state["room"] - item["weight"]).alias("room"), F.lit(False).alias("done"))
            held = F.struct(item["at"].alias("edge"), state["room"].alias("room"), F.lit(True).alias("done"))
            return F.when(fits, moved).when(~state["done"], held).otherwise(state)

        ended = F.aggregate("list", start, walk)
        last = listed.select("pattern", ended.alias("e"))
        # If every bucket fits, the edge lies beyond the last one.
        found = last.select("pattern", F.when(F.col("e.done"), F.col("e.edge")).otherwise(F.col("e.edge") + 1).alias("edge"), F.col("e.room").alias("room"))
    return found.select("pattern", "edge", "room").unionAll(none_left)


def mix_sources(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **settings) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of documents with one source each.

    Size is the number of words of the whole text (null: 0). Null is a source of its own, the last.
    Empty texts take nothing. Rows that agree in id, source and size are decided alike, reruns agree,
    an empty table gives an empty result, other columns are not looked at.
    """
    docs = picked(docs, doc_id=id_column, text=text_column, source=source_column)
    docs = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    docs = stored(docs, "mix-documents")
    decided, sizes, due = mix(docs, key=F.col("doc_id"), members=F.array("source"), size=F.col("size"), **settings)
    facts = [(s, int(sizes[s]), float(due[s])) for s in sizes]
    facts = stored(docs.sparkSession.createDataFrame(facts, "source string, source_size bigint, target double"), "mix-sources")
    decided = decided.select(F.col("key").alias("k"), F.col("pattern")[0]["s"].alias("s"), F.col("size").alias("z"), "taken")
    on = F.col("doc_id").eqNullSafe(F.col("k")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    joined = docs.join(decided, on).drop("s")
    facts = facts.withColumnRenamed("source", "s")
    return joined.join(facts, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **settings) -> DataFrame:
    """The documents of the mix, all columns as they were: each row as often as it is used.

    Rows that the mix leaves out go, and so do those without words (null and empty texts), which can
    add nothing. Repeated rows are used alike, an empty table gives an empty one, and no name of a
    column of ``docs`` can clash.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    size = word_count(F.col(f"`{text_column}`"))
    key, source = F.col(f"`{id_column}`"), F.col(f"`{source_column}`").cast("string")
    decided, _, _ = mix(docs, key=key, members=F.array(source), size=size, **settings)
    uses, counted, of, from_, sized = (free_name(docs, f"{n}_of_mix") for n in ("uses", "size", "key", "source", "decided"))
    used = decided.where("taken > 0").select(
        F.col("key").alias(of), F.col("pattern")[0]["s"].alias(from_), F.col("size").alias(sized), F.expr("taken div size").cast("int").alias(uses)
    )
    joined = docs.withColumn(counted, size).join(used, key.eqNullSafe(F.col(of)) & source.eqNullSafe(F.col(from_)) & (F.col(counted) == F.col(sized)))
    return joined.withColumn(uses, F.explode(F.array_repeat(F.lit(0), F.col(uses)))).select(*columns)
