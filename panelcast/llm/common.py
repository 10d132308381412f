"""Helpers shared by the operators: intermediate tables and graph components."""

from __future__ import annotations

import sys
import types
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import release, shared_table  # noqa: F401


def worker_state(owner: str) -> dict:
    """What this Python worker keeps between tasks for one operator.

    Spark uses its workers again for later stages; the caches of the operator
    before are dropped when another one asks, so they never add up. The
    package's functions are shipped by value, so the dictionary hangs on a
    module of its own.
    """
    module = sys.modules.setdefault("panelcast_worker_state", types.ModuleType("panelcast_worker_state"))
    if getattr(module, "owner", None) != owner:
        module.owner, module.kept = owner, {}
    return module.kept


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The given names, with underscores in front until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def ascii_lower(col):
    """Lower-case A-Z only, as the contracts ask (``lower`` would touch all letters)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_list() -> str:
    """DuckDB list of the 256 remainders of CRC-32 (one byte through the polynomial)."""
    return f"CAST({[zlib.crc32(bytes([x])) ^ zlib.crc32(bytes(1)) for x in range(256)]} AS BIGINT[])"


def sql_crc32(octets: str, table: str = "tab") -> str:
    """DuckDB expression: CRC-32 of a list of bytes (bigint); ``table`` is a column holding ``crc_list()``."""
    return (f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {octets}, lambda s, x: "
            f"xor(s >> 8, {table}[(xor(s, x) & 255) + 1])), CAST(4294967295 AS BIGINT))")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph.

    ``edges`` has long columns ``a``, ``b``. Returns one row (``node``,
    ``root``) per node that has an edge; root is the smallest node reachable.
    Alternating large-star and small-star rounds: every round is two grouped
    minima and a join, and the edge set never grows, so a hub with very many
    neighbours costs one row per edge and no group is gathered in a task.
    """
    spark = edges.sparkSession
    e = shared_table(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if e.isEmpty():
        return spark.createDataFrame([], "node long, root long")
    seen = None
    for _ in range(max_rounds):
        # large star: neighbours above a node move to the smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: neighbours below a node, and the node, move to the smallest of them
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = shared_table(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
