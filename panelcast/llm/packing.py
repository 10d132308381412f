"""Sequence packing by shortest-pack-first over the length histogram.

A document's ids are cut into full sequences and one remainder. The histogram
of the remainders' lengths (at most ``max_len`` numbers, whatever the corpus)
goes to the driver, where lengths are placed longest first: each goes to the
packing pattern with the most room that still fits, a pattern being a list of
lengths with the number of sequences that hold exactly those. The patterns are
then joined back to the pieces by each piece's rank within its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.llm.common import shared_table
from panelcast.llm.token_cache import in_blocks, word_ids

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of every document: its ids and ``end_id``, cut every ``max_len`` ids.

    The checksum is taken here, while the ids are at hand, so texts are
    encoded once and never shuffled.
    """
    end = int(end_id).to_bytes(4, "little")

    def cut(frames):
        for pdf in frames:
            texts, keys, rows = pdf["text"].tolist(), pdf["doc_id"].tolist(), []
            for s in in_blocks(texts):
                for key, ids in zip(keys[s], word_ids(texts[s], tokenizer_path)):
                    ids += end
                    n = len(ids) // 4
                    rows += [(key, a, min(max_len, n - a), zlib.crc32(ids[4 * a:4 * (a + max_len)]), n)
                             for a in range(0, n, max_len)]
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
                       ).mapInPandas(cut, PIECES)


def pack_patterns(histogram: dict[int, int], max_len: int) -> list[tuple[int, list[int]]]:
    """Shortest-pack-first: (number of sequences, lengths in order) for each pattern.

    Every length splits at most one pattern's count, so there are at most two
    patterns per length: the result is bounded by ``max_len``, not by the data.
    """
    open_by_room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    done: list[tuple[int, list[int]]] = []

    def put(count, lengths, room):
        (open_by_room[room] if room else done).append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in open_by_room.items() if packs and r >= length), default=None)
            if room is None:
                # as many of this length as fit go into each new sequence
                each = max_len // length
                whole, rest = divmod(left, each)
                if whole:
                    put(whole, [length] * each, max_len - each * length)
                if rest:
                    put(1, [length] * rest, max_len - rest * length)
                break
            count, lengths = open_by_room[room].pop()
            used = min(count, left)
            if count > used:
                open_by_room[room].append((count - used, lengths))
            put(used, lengths + [length], room - length)
            left -= used
    return done + [p for room in sorted(open_by_room) for p in open_by_room[room]]


def pattern_slots(patterns: list[tuple[int, list[int]]], first_sequence: int = 0) -> list[tuple]:
    """One row per pattern and distinct length in it: which ranks of that length
    it takes, and where. (length, rank_from, rank_to, count, first sequence, offset)."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], first_sequence
    for count, lengths in patterns:
        offset = 0
        for length in dict.fromkeys(lengths):
            times = lengths.count(length)
            rows.append((length, taken[length], taken[length] + times * count, count, sequence, offset))
            taken[length] += times * count
            offset += times * length
        sequence += count
    return rows


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1,
         rank_group: int = 50_000) -> DataFrame:
    """Pack all documents (columns doc_id, text) into sequences of ``max_len``.

    Returns the pieces with sequence_id and offset. Null text is empty (one
    piece, the end id); repeated rows are packed each; an empty table gives an
    empty result; other columns are ignored.

    Ranks within a length need no single task: a length's pieces are dealt by
    hash into groups of about ``rank_group``, ranked inside the group, and a
    running sum over the small table of group sizes gives each group's start.
    """
    spark = docs.sparkSession
    p = shared_table(pieces(docs, tokenizer_path, max_len, end_id), "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = pattern_slots(pack_patterns(histogram, max_len))
    groups = max(1, -(-sum(histogram.values()) // rank_group))
    p = p.withColumn("g", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    starts = (p.groupBy("length", "g").agg(F.count("*").alias("n"))
              .select("length", "g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    inside = Window.partitionBy("length", "g").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (p.withColumn("r", F.row_number().over(inside) - 1).join(starts, ["length", "g"])
              .withColumn("rank", F.col("before") + F.col("r")))
    table = spark.createDataFrame(slots, "length long, lo long, hi long, times long, seq long, base long")
    # broadcast is safe: at most 2 patterns a length, and a pattern's distinct lengths sum to max_len at most
    on = (ranked["length"] == table["length"]) & (ranked["rank"] >= table["lo"]) & (ranked["rank"] < table["hi"])
    at = F.col("rank") - F.col("lo")
    return (ranked.join(F.broadcast(table), on)
            .select("doc_id", "start", ranked["length"], "ids_crc32", "doc_tokens",
                    (F.col("seq") + at % F.col("times")).alias("sequence_id"),
                    (F.col("base") + F.floor(at / F.col("times")) * ranked["length"]).alias("offset")))
