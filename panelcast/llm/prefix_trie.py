"""Prefix trie of conversations, rolled up band by band.

A node is a distinct sequence of first turns. Its key is the XOR, in two
64-bit lanes, of hashes of (place, turn), so the keys along a conversation are
running XORs and a parent's key is the child's without its own turn. Two
different sequences share a key with a chance of about 2^-128.

Subtree sums come in depth bands of ``band`` levels: a node sends its own
values only to its ancestors down to the top of its band, so it explodes to at
most ``band`` rows however deep the trie is. Nodes at the band borders (band
roots) form a small trie of their own. Their totals are completed over it by
pointer doubling, in about log2(depth / band) rounds, and each completed total
goes to the ancestors in the band above, again at most ``band`` rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import crc_list, shared_table, sql_crc32

NOTHING = hashlib.sha256(b"").hexdigest()
ID = ["a", "b"]


def rebuilt_paths(conversations: DataFrame, group: int = 5, heads: int = 9, band: int = 32) -> DataFrame:
    """One row per rebuilt conversation and prefix of it (the empty one too).

    A conversation c starts with the first crc32(c) % heads turns of
    conversation c - c % group and goes on with its own turns after as many.
    Columns: conv_id, depth, the node's key (a, b), its parent's key (pa, pb;
    null for the root), bytes of the last text, ``chain`` (keys of the
    ancestors inside the node's band, top first) and ``last``.
    Texts are never shuffled, only a 16-byte digest and a length per turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    keyed = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "key")
    head = F.crc32(F.col("conv_id").cast("string")) % heads
    own = keyed.select("conv_id", F.row_number().over(order).alias("at"), "key", "bytes")
    starts = own.where("at = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("source"),
                                        head.alias("head"))
    lent = own.where(F.col("at") < heads).select(F.col("conv_id").alias("source"), "at", "key", "bytes")
    rows = (starts.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("at"), F.lit(b"").alias("key"),
                          F.lit(0).cast("long").alias("bytes"))
            .unionByName(starts.join(lent, "source").where("at <= head")
                         .select("conv_id", F.lit(1).alias("part"), "at", "key", "bytes"))
            .unionByName(own.where(F.col("at") > head).select("conv_id", F.lit(2).alias("part"), "at", "key", "bytes")))
    order = Window.partitionBy("conv_id").orderBy("part", "at")
    rows = rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("depth"), "key", "bytes", "part", "at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    for lane in ID:
        rows = rows.withColumn(f"m{lane}", F.when(F.col("depth") > 0, F.xxhash64(F.lit(lane), "depth", "key")).otherwise(F.lit(0)))
    rows = rows.withColumns({lane: F.bit_xor(f"m{lane}").over(so_far) for lane in ID})
    rows = rows.withColumn("before", F.collect_list(F.struct(*ID)).over(order.rowsBetween(-band, -1)))
    inside = F.when(F.col("depth") > 0, (F.col("depth") - 1) % band + 1).otherwise(F.lit(0)).cast("int")
    return rows.select(
        "conv_id", "depth", *ID, *[F.when(F.col("depth") > 0, F.col(x).bitwiseXOR(F.col(f"m{x}"))).alias(f"p{x}") for x in ID],
        "bytes", F.slice("before", F.size("before") - inside + 1, inside).alias("chain"),
        F.lead("depth").over(order).isNull().alias("last"))


def ends_digests(ends: DataFrame, chunk: int = 4096) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of every key (a, b).

    A digest is read in one go, but its ids are joined elsewhere: ranges of
    (key, conv_id) turn into texts of at most ``chunk`` ids, wherever the
    range borders fall, and only these texts meet, streamed in order through
    the hash. So a node at which a third of all conversations end holds no
    list in memory and one row per ``chunk`` ids in a task.
    """
    def join(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            ids, first = pdf["conv_id"].astype(str).tolist(), pdf["conv_id"]
            new = (pdf["a"] != pdf["a"].shift()) | (pdf["b"] != pdf["b"].shift())
            run = pdf.groupby(new.cumsum()).cumcount() % chunk
            at = (new | (run == 0)).to_numpy().nonzero()[0].tolist()
            yield pd.DataFrame({"a": pdf["a"].to_numpy()[at], "b": pdf["b"].to_numpy()[at], "first": first.to_numpy()[at],
                                "ids": [",".join(ids[i:j]) for i, j in zip(at, [*at[1:], len(ids)])]})

    def digest(frames):
        key, h = None, None
        for pdf in frames:
            done = []
            for a, b, ids in zip(pdf["a"].tolist(), pdf["b"].tolist(), pdf["ids"].tolist()):
                if key == (a, b):
                    h.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, h.hexdigest()))
                key, h = (a, b), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["a", "b", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, h.hexdigest())], columns=["a", "b", "ends_sha256"])

    texts = (ends.select(*ID, "conv_id").repartitionByRange(*ID, "conv_id").sortWithinPartitions(*ID, "conv_id")
             .mapInPandas(join, "a long, b long, first long, ids string"))
    return (texts.repartition(*ID).sortWithinPartitions(*ID, "first")
            .mapInPandas(digest, "a long, b long, ends_sha256 string"))


def _sums(df: DataFrame) -> DataFrame:
    return df.groupBy(*ID).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def _below_band_roots(nodes: DataFrame, inside: DataFrame, deepest: int, band: int) -> DataFrame:
    """For every band root: sums over all its strict descendants, in any band.

    ``inside`` has the sums of each node over its own band. Round k adds what
    lies 2^k bands further down and doubles the reach of every pointer.
    """
    s = shared_table(nodes.where(F.col("depth") % band == 0)
                     .select("depth", *ID, *[F.get("chain", F.lit(0)).getField(x).alias(f"u{x}") for x in ID])
                     .join(inside, ID, "left")
                     .select("depth", *ID, "ua", "ub", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("saved", "leaves")]),
                     "trie-bands")
    for _ in range((deepest // band).bit_length()):
        more = s.where("ua is not null").select(F.col("ua").alias("a"), F.col("ub").alias("b"), "saved", "leaves")
        more = _sums(more).withColumnsRenamed({"saved": "saved2", "leaves": "leaves2"})
        up = s.select(F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("ua").alias("va"), F.col("ub").alias("vb"))
        s = shared_table(s.join(more, ID, "left").join(up, ["ua", "ub"], "left").select(
            "depth", *ID, F.col("va").alias("ua"), F.col("vb").alias("ub"),
            *[(F.col(c) + F.coalesce(f"{c}2", F.lit(0))).alias(c) for c in ("saved", "leaves")]), "trie-bands")
    return s


def prefix_trie(conversations: DataFrame, group: int = 5, heads: int = 9, band: int = 32) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with subtree totals.

    ``conversations`` has conv_id, turn, role, text. Returns conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 per node.
    Defined cases: null role or text is empty; null turns come first; turns
    of one number (repeated rows too) go by the MD5 of role and text, and all
    count; rows without a conv_id belong to no conversation; an empty table
    has no nodes, not even the root; texts of any length enter as a digest and
    a length; other columns are ignored. Turns of one conversation are
    numbered by a window, which streams (and spills) but is one task for one
    conversation; members of a node are combined before they meet.
    """
    paths = shared_table(rebuilt_paths(conversations, group, heads, band), "trie-paths")
    nodes = shared_table(paths.groupBy(*ID).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("depth").alias("depth"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.max("bytes").alias("bytes"),
        F.any_value("chain").alias("chain")), "trie-nodes")
    children = nodes.where("pa is not null").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")) \
                    .agg(F.count("*").alias("n_children"))
    nodes = shared_table(nodes.join(children, ID, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
        "saved": (F.col("n_convs") - 1) * F.col("bytes"),
        "leaves": F.col("n_children").isNull().cast("long")}), "trie-values")

    def raised(df):
        return df.select(F.explode("chain").alias("up"), "saved", "leaves").select("up.a", "up.b", "saved", "leaves")

    parts = raised(nodes)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    if deepest > band:
        below = _below_band_roots(nodes, _sums(parts), deepest, band)
        parts = parts.unionByName(raised(nodes.select(*ID, "chain").join(below.where("depth > 0"), ID)))
    totals = _sums(parts).withColumnsRenamed({"saved": "saved2", "leaves": "leaves2"})
    digests = ends_digests(paths.where("last"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    zero = F.lit(0).cast("long")
    return (nodes.join(totals, ID, "left").join(digests, ID, "left").join(parents, ["pa", "pb"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                    (F.col("leaves") + F.coalesce("leaves2", zero)).alias("n_leaves"),
                    (F.col("saved") + F.coalesce("saved2", zero)).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))


def trie_sql(group: int = 5, heads: int = 9) -> str:
    """The same nodes in DuckDB, by whole prefixes as list keys."""
    digits = "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, md5(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS k, strlen(text) AS bytes,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CAST(strlen(role) AS VARCHAR) || ':' || role || text)) AS place
  FROM turns),
convs AS (
  SELECT conv_id, conv_id - conv_id % {group} AS source, {sql_crc32(digits)} % {heads} AS head
  FROM (SELECT DISTINCT conv_id, {crc_list()} AS tab FROM own)),
rebuilt AS (
  SELECT c.conv_id, 1 AS part, o.place, o.k, o.bytes FROM convs c JOIN own o ON o.conv_id = c.source AND o.place <= c.head
  UNION ALL SELECT c.conv_id, 2, o.place, o.k, o.bytes FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.head),
seqs AS (
  SELECT c.conv_id, list(r.k ORDER BY part, place) FILTER (r.k IS NOT NULL) AS ks,
    list(r.bytes ORDER BY part, place) FILTER (r.k IS NOT NULL) AS bs
  FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
members AS (
  SELECT conv_id, d, coalesce(ks[1:d], []) AS node, coalesce(bs[d], 0) AS bytes, d = coalesce(len(ks), 0) AS ends
  FROM (SELECT *, unnest(range(0, coalesce(len(ks), 0) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, d),
kids AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
valued AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, (n - 1) * bytes AS saved, CAST(k.n_children IS NULL AS BIGINT) AS leaf
  FROM nodes n LEFT JOIN kids k ON k.node = n.node),
totals AS (
  SELECT node[1:e] AS node, CAST(sum(saved) AS BIGINT) AS saved, CAST(sum(leaf) AS BIGINT) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM valued) GROUP BY 1)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, t.leaves AS n_leaves,
  t.saved AS saved_tokens, v.ends_sha256
FROM valued v JOIN totals t ON t.node = v.node LEFT JOIN nodes p ON v.d > 0 AND p.node = v.node[1:v.d - 1]"""
