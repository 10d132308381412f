"""SimHash near-duplicates by a self-join of a binary trie of fingerprints.

Two nodes of the trie at the same depth are visited together; the bits in
which their prefixes differ are added up, and a pair of nodes over the error
budget is dropped with everything below it. Two fingerprints within ``k`` bits
differ in at most ``k // 2`` bits in one of their halves, so the trie is built
twice, each half first, with that smaller budget down to bit 32: this keeps
the number of node pairs near the number of nodes.

The upper levels are DataFrames (one row per pair of nodes, joined to their
children); a pair of nodes that is small enough becomes one task's work, the
others go four bits deeper, until single fingerprints remain. So a crowded
prefix is split by its own bits, and nothing is capped or gathered.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import components, free_names, shared_table, worker_state

STEP = 4


def text_fingerprint(text: bytes, words: int, seed: int) -> int:
    """64-bit SimHash of the shingles of ``words`` words (ASCII white space, A-Z lowered)."""
    from xxhash import xxh64_intdigest as h

    w = text.lower().split()
    if not w:
        return 0
    if len(w) <= words:
        return h(b" ".join(w), seed)
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[words - 1:].tolist()
    hashes = np.array([h(joined[a:b], seed) for a, b in zip(starts, ends)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[i:i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed long."""
    def run(frames):
        worker_state("simhash")
        for pdf in frames:
            fp = np.array([text_fingerprint(t.encode(), words, seed) for t in pdf["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "fp": fp.view(np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
                       ).mapInPandas(run, "doc_id long, fp long")


def _fold(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the groups of i and j; a group's label is its smallest member."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _ones_before(keys: np.ndarray, bit: int) -> np.ndarray:
    one = ((keys >> np.uint64(63 - bit)) & np.uint64(1)).astype(np.int64)
    return np.concatenate(([0], np.cumsum(one)))


def trie_links(a: np.ndarray, b: np.ndarray | None, depth: int, diff: int, half_budget: int, budget: int,
               block: int = 400_000) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among the keys of one node pair.

    ``a`` and ``b`` are sorted distinct uint64 keys below two nodes at
    ``depth`` whose prefixes differ in ``diff`` bits; ``b`` is None for a node
    paired with itself. Returns indices into concat(a, b): each linked key and
    the smallest key it is linked with, directly or through others.
    Node pairs are kept as index ranges and worked off in blocks, deepest
    first, so memory stays bounded.
    """
    same = b is None
    b = a if same else b
    keys = a if same else np.concatenate((a, b))
    shift = 0 if same else len(a)
    label = np.arange(len(keys))
    ones: dict = {}
    at = np.array
    stack = [(depth, at([0]), at([len(a)]), at([0]), at([len(b)]), at([diff]))]
    while stack:
        d, la, ha, lb, hb, e = stack.pop()
        if len(la) > block:
            m = len(la) // 2
            stack += [(d, la[:m], ha[:m], lb[:m], hb[:m], e[:m]), (d, la[m:], ha[m:], lb[m:], hb[m:], e[m:])]
            continue
        small = (ha - la) * (hb - lb) <= 8 if d < 64 else np.ones(len(la), bool)
        if small.any():
            n = (hb - lb)[small]
            total = (ha - la)[small] * n
            start = np.repeat(np.cumsum(total) - total, total)
            k = np.arange(total.sum()) - start
            n = np.repeat(n, total)
            i, j = np.repeat(la[small], total) + k // n, np.repeat(lb[small], total) + k % n
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            i, j = i[near], j[near] + shift
            label = _fold(label, i, j)
            big = ~small
            la, ha, lb, hb, e = la[big], ha[big], lb[big], hb[big], e[big]
        if not len(la):
            continue
        if d not in ones:
            oa = _ones_before(a, d)
            ones[d] = (oa, oa if same else _ones_before(b, d))
        oa, ob = ones[d]
        ma, mb = ha - (oa[ha] - oa[la]), hb - (ob[hb] - ob[lb])
        limit = half_budget if d < 32 else budget
        parts = []
        for x, y in ((0, 0), (1, 1), (0, 1), (1, 0)):
            pa, qa = (ma, ha) if x else (la, ma)
            pb, qb = (mb, hb) if y else (lb, mb)
            keep = (pa < qa) & (pb < qb) & (e + (x != y) <= limit)
            if same and (x, y) == (1, 0):
                keep &= la != lb
            if keep.any():
                parts.append((pa[keep], qa[keep], pb[keep], qb[keep], e[keep] + (x != y)))
        if parts:
            stack.append((d + 1, *(np.concatenate(c) for c in zip(*parts))))
    linked = np.flatnonzero(label != np.arange(len(keys)))
    return linked, label[linked]


def hamming_links(fps: DataFrame, max_bits: int = 4, task_keys: int = 20_000) -> DataFrame:
    """Links (a, b) that connect whatever fingerprints differ in at most ``max_bits`` bits.

    ``fps`` has distinct longs ``fp``. Any two linked fingerprints are joined
    by a path of the result, every edge of which is itself within a chain of
    true links; groups of mutual links are returned as stars, not as all pairs.
    """
    links = None
    count = fps.count()
    for first in (0, 1):
        half = max_bits // 2
        key = F.col("fp") if first == 0 else F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
        keys = fps.select(key.alias("key"))
        found = _half_links(keys, count, half, max_bits, task_keys)
        back = (lambda c: F.col(c)) if first == 0 else \
            (lambda c: F.shiftleft(c, 32).bitwiseOR(F.shiftrightunsigned(c, 32)))
        found = found.select(back("a").alias("a"), back("b").alias("b"))
        links = found if links is None else links.unionByName(found)
    return links


def _half_links(keys: DataFrame, count: int, half: int, budget: int, task_keys: int) -> DataFrame:
    spark = keys.sparkSession

    def nodes(d):
        return keys.groupBy(F.shiftrightunsigned("key", 64 - d).alias("p")).agg(F.count("*").alias("n"))

    schema = "a long, b long, diff int, na long, nb long"
    heavy = spark.createDataFrame([(0, 0, 0, count, count)], schema)
    cells = heavy.where(f"na <= {task_keys}").withColumn("d", F.lit(0))
    depths = [0] if count <= task_keys else []
    d = 0
    while count > task_keys and d < 64:
        d += STEP
        child = shared_table(nodes(d), "nodes").withColumn("up", F.shiftrightunsigned("p", STEP))
        limit = half if d <= 32 else budget
        step = (heavy.select(F.col("a").alias("ua"), F.col("b").alias("ub"), "diff")
                .join(child.select(F.col("p").alias("a"), F.col("n").alias("na"), F.col("up").alias("ua")), "ua")
                .join(child.select(F.col("p").alias("b"), F.col("n").alias("nb"), F.col("up").alias("ub")), "ub")
                .where("ua <> ub or a <= b")
                .withColumn("diff", (F.col("diff") + F.bit_count(F.expr("(a ^ b) & 15"))).cast("int"))
                .where(F.col("diff") <= limit).select("a", "b", "diff", "na", "nb"))
        pairs = shared_table(step, "node-pairs")
        ready = F.lit(d == 64) | (F.col("na") + F.col("nb") <= 2 * task_keys)
        cells = cells.unionByName(pairs.where(ready).withColumn("d", F.lit(d)))
        depths.append(d)
        heavy = pairs.where(~ready)
        if heavy.isEmpty():
            break
    cells = cells.select("d", "a", "b", "diff")
    parts = []
    for d in depths:
        prefix = F.shiftrightunsigned("key", 64 - d) if d else F.lit(0).cast("long")
        mine = keys.select("key", prefix.alias("p"))
        own = cells.where(F.col("d") == d)
        parts.append(mine.join(own.withColumn("p", F.col("a")), "p").withColumn("side", F.lit(0)))
        parts.append(mine.join(own.where("a <> b").withColumn("p", F.col("b")), "p").withColumn("side", F.lit(1)))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)

    def visit(pdf):
        k = pdf["key"].to_numpy(np.int64).view(np.uint64)
        side = pdf["side"].to_numpy()
        a, b = np.sort(k[side == 0]), np.sort(k[side == 1])
        alone = pdf["a"].iloc[0] == pdf["b"].iloc[0]
        i, j = trie_links(a, None if alone else b, int(pdf["d"].iloc[0]), int(pdf["diff"].iloc[0]), half, budget)
        all_keys = (a if alone else np.concatenate((a, b))).view(np.int64)
        return pd.DataFrame({"a": all_keys[i], "b": all_keys[j]})

    return (rows.select("d", "a", "b", "diff", "side", "key").groupBy("d", "a", "b")
            .applyInPandas(visit, "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, seed: int = 42,
                    task_keys: int = 20_000) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits. Null text counts as empty: fingerprint zero,
    linked like any other. Repeated rows give repeated results; a null doc_id
    is kept and never the smallest (a component of null ids only has null);
    an empty table gives an empty result; other columns are ignored.
    """
    fps = shared_table(fingerprints(docs, words, seed), "fingerprints")
    groups = shared_table(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "groups")
    comp = components(hamming_links(groups.select("fp"), max_bits, task_keys))
    joined = comp.join(groups, comp["node"] == groups["fp"]).select("fp", "root", "first")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    merged = joined.join(least, "root").select(F.col("fp").alias("node"), "least")
    label = groups.join(merged, groups["fp"] == merged["node"], "left").select(
        "fp", F.coalesce("least", "first").alias("component_id"))
    return (fps.join(label, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each component: the
    one with the smallest doc_id. Of rows repeated with that id one stays; rows
    without an id stay unless a component of theirs has an id, one for each text."""
    keep, text = free_names(docs, "_keep", "_t")
    d = near_duplicates(docs, words, max_bits)
    stay = d.select(F.col("component_id").alias(keep)).distinct()
    rows = docs.withColumn(text, F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long")))
    return (rows.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col(keep)), "left_semi")
            .dropDuplicates(["doc_id", text]).select(*docs.columns))
