"""Benchmark decontamination by q-gram counting and banded alignment.

Benchmark texts are cut into overlapping windows of ``window`` characters. If
a stretch of a document is within ``e`` edits of a window of ``m`` characters,
the two share at least ``m + 1 - q * (e + 1)`` q-grams (the q-gram lemma), and
all of them lie on diagonals at most ``e`` apart. So the q-grams that a
document shares with a window are counted in overlapping diagonal bands;
only bands that reach the bound are aligned, within the band.

Texts are compared as UTF-8 bytes, lower-cased, with every run of ASCII white
space, control characters and punctuation as one space; an edit is an edit of such a byte.

The benchmark goes to the executors in blocks of about ``block_chars``
characters; every text is scanned with each block's windows in turn, so a
larger benchmark takes more passes over a batch, not more memory for an index.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import worker_state

SIGNS = string.punctuation.encode() + bytes(range(33))
BLANK = bytes.maketrans(SIGNS, b" " * len(SIGNS))
BITS = 22


def normal(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(BLANK).split())


def qgrams(data: bytes, q: int) -> np.ndarray:
    """Every q-gram (q <= 8) as a number, in order."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(data) - q + 1]
    return np.ascontiguousarray(eight).view("<u8").ravel() & np.uint64((1 << (8 * q)) - 1)


def slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)


class Windows:
    """Windows of a block of benchmark texts, and the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], window: int, share: float, q: int):
        self.q, self.item, self.text = q, [], []
        for item, text in items:
            data = normal(text)
            ends = range(window, len(data), window // 2) if len(data) > window else []
            for end in [*ends, len(data)]:
                part = data[max(0, end - window):end]
                if len(part) >= q:
                    self.item.append(item)
                    self.text.append(part)
        self.edits = [int(share * len(t)) for t in self.text]
        # a window too short for the lemma still needs one shared q-gram, or none of its edits
        self.edits = [e if len(t) + 1 - q * (e + 1) > 0 else max(0, (len(t) + 1) // q - 1)
                      for t, e in zip(self.text, self.edits)]
        self.need = np.array([len(t) + 1 - q * (e + 1) for t, e in zip(self.text, self.edits)], np.int64)
        grams = [qgrams(t, q) for t in self.text]
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        own = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.grams, self.own, self.place = flat[order], own[order], place[order]
        self.known = np.zeros(1 << BITS, bool)
        self.known[slot(flat)] = True

    def hits(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, place in the document, place in the window) of every shared q-gram."""
        grams = qgrams(data, self.q)
        at = np.flatnonzero(self.known[slot(grams)])
        lo = np.searchsorted(self.grams, grams[at], "left")
        n = np.searchsorted(self.grams, grams[at], "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        k = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return self.own[k], np.repeat(at, n), self.place[k]


def band_distance(pattern: bytes, text: bytes, limit: int) -> tuple[int, int] | None:
    """Least edits (<= limit) between the whole pattern and some stretch of the
    text, with the end of that stretch; None if it takes more.

    Only cells within the band of diagonals that the text's length leaves are
    computed, column by column over arrays.
    """
    m, n = len(pattern), len(text)
    width = n - m + 2 * limit + 1  # diagonals -limit .. n - m + limit
    if width <= 0:
        return None
    t = np.frombuffer(text, np.uint8)
    big = limit + 1
    # row i: cell k is text place j = i - limit + k
    k = np.arange(width)
    row = np.where((k - limit >= 0) & (k - limit <= n), 0, big)
    for i in range(1, m + 1):
        j = i - limit + k
        inside = (j >= 1) & (j <= n)
        same = np.zeros(width, bool)
        same[inside] = t[j[inside] - 1] == pattern[i - 1]
        new = np.minimum(row + ~same, np.append(row[1:], big) + 1)
        new[(j < 0) | (j > n)] = big
        new[j == 0] = min(i, big)
        # insertions along the row: running minimum of value - place
        new = np.minimum(new, np.minimum.accumulate(new - k) + k)
        new[(j < 0) | (j > n)] = big
        row = np.minimum(new, big)
        if row.min() > limit:
            return None
    best = int(row.min())
    return best, int(np.flatnonzero(row == best)[0]) + m - limit


def regions(texts: list[bytes], windows: Windows) -> list[list[tuple[int, int, int, int]]]:
    """For each text (item, start, end, edits) of its stretches within the edit budget.

    The texts are scanned as one, a zero byte between them; an alignment never
    reaches from one into the next.
    """
    found: list[list] = [[] for _ in texts]
    if not windows.text or not texts:
        return found
    data = b"\0".join(texts)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    own, at, place = windows.hits(data)
    edits = np.array(windows.edits)
    reach = max(map(len, windows.text)) + 1
    # bands of 2 (e + 1) diagonals, each half over the next
    key = own * (1 << 40) + (at - place + reach) // (edits[own] + 1)
    band, counts = np.unique(key, return_counts=True)
    follow = np.where(band[1:] == band[:-1] + 1, counts[1:], 0)
    full = counts + np.append(follow, 0)
    lone = np.concatenate(([True], band[1:] != band[:-1] + 1))  # hits of the first half alone: the band before
    need = windows.need[band >> 40]
    order = np.argsort(key, kind="stable")
    sorted_key, sorted_place = key[order], place[order]
    for k in np.flatnonzero((full >= need) | (lone & (counts >= need))).tolist():
        w, e = int(band[k] >> 40), int(edits[band[k] >> 40])
        pattern, m = windows.text[w], len(windows.text[w])
        # the lemma counts q-grams of the window: a place hit twice counts once
        i, j = np.searchsorted(sorted_key, [band[k], band[k] + 2])
        if len(set(sorted_place[i:j].tolist())) < need[k]:
            continue
        low = (int(band[k]) & ((1 << 40) - 1)) * (e + 1) - reach
        start, end = max(0, low - e), min(len(data), low + 2 * (e + 1) + m + e)
        d = max(0, int(np.searchsorted(starts, start, "right")) - 1)
        while d < len(texts) and starts[d] < end:
            a, z = max(start, int(starts[d])), min(end, int(starts[d]) + len(texts[d]))
            if z - a >= m - e:
                got = band_distance(pattern, data[a:z], e)
                if got is not None:
                    stop = a + got[1] - int(starts[d])
                    region = (windows.item[w], max(0, stop - m), stop, got[0])
                    if region not in found[d]:
                        found[d].append(region)
            d += 1
    return found


def blocks(texts: list[bytes], size: int = 1_000_000):
    """Slices of about ``size`` bytes."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 120, share: float = 0.1, q: int = 8,
                  block_chars: int = 2_000_000) -> DataFrame:
    """Which documents hold a benchmark passage.

    Returns per document doc_id, contaminated, n_regions, items (sorted
    distinct item ids), and starts, ends, edits of the regions (in bytes of
    the normalised text). ``window`` is in characters, ``share`` the edits
    allowed per character; a benchmark text shorter than the window is one
    window.
    Null text counts as empty; empty benchmark texts and ones shorter than a
    q-gram match nothing; repeated rows get equal rows; an empty table on
    either side gives no regions; other columns are ignored. The texts stay
    where they are read: nothing is shuffled, whatever the number of blocks.
    """
    schema = ("doc_id long, contaminated boolean, n_regions long, items array<long>, starts array<long>, "
              "ends array<long>, edits array<long>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(finder(benchmark, window, share, q, block_chars), schema)


def benchmark_blocks(items, block_chars: int):
    """Lists of the (item, text) pairs ``items``, each of at most ``block_chars`` characters or of one item."""
    block, size = [], 0
    for item, text in items:
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    if block:
        yield block


def finder(benchmark: DataFrame, window: int, share: float, q: int, block_chars: int):
    """The function over batches of documents that knows the benchmark, in blocks."""
    spark = benchmark.sparkSession
    texts = (benchmark.where(F.col("text").isNotNull() & (F.col("text") != ""))
             .select(F.coalesce("item_id", F.lit(-1)).alias("item_id"), "text").distinct().orderBy("item_id", "text"))
    items = [spark.sparkContext.broadcast(block)
             for block in benchmark_blocks(((r["item_id"], r["text"]) for r in texts.toLocalIterator()), block_chars)]

    def run(frames):
        worker_state("decontamination")
        index, at = None, None  # of one block at a time; the texts of all stay
        for pdf in frames:
            texts = [normal(t) for t in pdf["text"]]
            slices = list(blocks(texts))
            found: list[list] = [[] for _ in texts]
            for n, block in enumerate(items):
                if at != n:
                    index = None
                    index, at = Windows(block.value, window, share, q), n
                for s in slices:
                    for mine, more in zip(found[s], regions(texts[s], index)):
                        mine += [r for r in more if r not in mine]
            out = [(key, bool(r), len(r), sorted({x[0] for x in r}), [x[1] for x in r], [x[2] for x in r],
                    [x[3] for x in r]) for key, r in zip(pdf["doc_id"], found)]
            yield pd.DataFrame(out, columns=["doc_id", "contaminated", "n_regions", "items", "starts", "ends", "edits"]
                               ).astype({"doc_id": "Int64"})

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 120, share: float = 0.1, q: int = 8,
                    block_chars: int = 2_000_000) -> DataFrame:
    """The documents (all their columns) without a benchmark passage; same rules as ``contamination``."""
    run = finder(benchmark, window, share, q, block_chars)

    @F.pandas_udf("boolean")
    def contaminated(texts: pd.Series) -> pd.Series:
        frame = pd.DataFrame({"doc_id": pd.Series(0, index=texts.index), "text": texts.fillna("")})
        return pd.Series(next(iter(run([frame])))["contaminated"].to_numpy(bool))

    return docs.where(~contaminated(F.col("text")))
