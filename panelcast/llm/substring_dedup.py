"""Removal of word sequences that occur more than once.

Every window of ``window`` consecutive words gets a Rabin-Karp hash: word
hashes are sums over the bytes, window hashes sums over the words, both taken
from running sums, so a window costs the same whatever its length. Spark deals
the hashes into buckets and counts them there; a window whose hash occurs
again anywhere is repeated, and overlapping repeated windows merge into the
spans to remove.

Documents are dealt by hash into chunks of about ``chunk_bytes``. A chunk
sends each of its distinct hashes once to the hash's bucket and gets back one
bit for each, so the hash of a passage in a third of all documents costs one
entry a chunk. 56 bits travel, and the bucket comes from a second hash: at
2^30 windows a false repeat anywhere has a chance of about one in 2^6 per
corpus; it falls as buckets grow in number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Odd multipliers of the three sums (fixed values; any odd numbers will do).
BYTE_BASE, WORD_BASE, BUCKET_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
MASK = (1 << 64) - 1
LOW56 = np.uint64((1 << 56) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n + 1, base, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xE7037ED1A0B428DB)
    return x ^ (x >> np.uint64(32))


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Sum of values[s:e] * base^(position - s), for all pairs at once (mod 2^64)."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values))[:-1])))
    inverse = _powers(pow(base, -1, 1 << 64), len(values))
    return (sums[ends] - sums[starts]) * inverse[starts]


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word (runs of bytes other than ASCII white space)."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Chunk:
    """The windows of a group of texts.

    ``doc`` is the text of each word, ``at`` the first word of each window
    inside one text, ``unique``/``bucket`` the distinct hashes in order of
    bucket and hash, ``which`` the place of each window's hash there.
    """

    def __init__(self, texts: list[bytes], window: int, buckets: int):
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends_of_text = np.cumsum([len(t) + 1 for t in texts])
        starts, ends = word_places(data)
        self.doc = np.searchsorted(ends_of_text, starts, "right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        n = len(starts) - window + 1
        at = np.arange(max(n, 0))
        self.at = at[self.doc[at] == self.doc[at + window - 1]] if n > 0 else at
        if not len(self.at):
            self.unique, self.bucket = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.which, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        letters = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))
        words = _mix(_rolling(letters[data], starts, ends, BYTE_BASE) + (ends - starts).astype(np.uint64))
        h = _mix(_rolling(words, self.at, self.at + window, WORD_BASE)) & LOW56
        b = (_mix(_rolling(words, self.at, self.at + window, BUCKET_BASE)) >> np.uint64(20)) % np.uint64(buckets)
        b = b.astype(np.int32)
        order = np.argsort(h)
        order = order[np.argsort(b[order], kind="stable")]
        h, b = h[order], b[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (b[1:] != b[:-1])))
        group = np.cumsum(new) - 1
        self.which = np.empty(len(order), np.int64)
        self.which[order] = group
        self.unique, self.bucket = h[new], b[new]
        self.times = np.bincount(group)

    def covered(self, repeated: np.ndarray, window: int) -> np.ndarray:
        """Words that lie in a window whose (distinct) hash is marked."""
        hit = self.at[repeated[self.which]]
        change = np.zeros(len(self.doc) + 1, np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + window, -1)
        return np.cumsum(change)[:-1] > 0


def remove_repeats(docs: DataFrame, window: int = 35, chunk_bytes: int = 2_000_000,
                   bucket_windows: int = 2_000_000) -> DataFrame:
    """Documents without the words of repeated windows.

    ``docs`` has doc_id and text; returns doc_id, n_words, n_removed,
    kept_text (kept words joined by one space) and the removed spans as two
    lists of word numbers (first word, word after the last).
    A null text counts as empty and has no words; a text shorter than a window
    is kept whole; repeated rows are repeats of each other (both lose their
    windows); an empty table gives an empty result; other columns are ignored.

    Texts are shuffled once, by chunk: both uses of the chunks share that
    exchange. Chunks and buckets are many enough that each fits a task.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    buckets = max(1, -(-size // (6 * bucket_windows)))
    text = F.coalesce("text", F.lit(""))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                        F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(chunks)).cast("int").alias("chunk"))

    def send(key, pdf):
        c = Chunk([t.encode() for t in pdf["text"]], window, buckets)
        cut = np.flatnonzero(np.concatenate(([True], c.bucket[1:] != c.bucket[:-1]))) if len(c.bucket) else []
        raw = c.unique.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
        ends = [*cut[1:], len(c.bucket)]
        return pd.DataFrame({"bucket": [int(c.bucket[i]) for i in cut], "chunk": int(key[0]),
                             "hashes": [raw[i:j].tobytes() for i, j in zip(cut, ends)]})

    def count(key, pdf):
        blobs, chunk = pdf["hashes"].tolist(), pdf["chunk"].tolist()
        lengths = [len(x) // 7 for x in blobs]
        h = np.zeros((sum(lengths), 8), np.uint8)
        h[:, :7] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 7)
        h = h.view("<u8").ravel()
        order = np.argsort(h)
        s = h[order]
        equal = s[1:] == s[:-1]
        again = np.zeros(len(h), bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        rows, start = [], 0
        for c, n in zip(chunk, lengths):
            part = again[start:start + n]
            start += n
            if part.any():
                rows.append((c, int(key[0]), np.packbits(part).tobytes()))
        return pd.DataFrame(rows, columns=["chunk", "bucket", "bits"])

    def finish(pdf, marks):
        texts = [t.encode() for t in pdf["text"]]
        c = Chunk(texts, window, buckets)
        repeated = c.times > 1
        for b, bits in zip(marks["bucket"], marks["bits"]):
            i, j = np.searchsorted(c.bucket, [b, b + 1])
            repeated[i:j] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
        gone = c.covered(repeated, window) if len(c.at) else np.zeros(len(c.doc), bool)
        rows = []
        for k, (key, t) in enumerate(zip(pdf["doc_id"], texts)):
            own = gone[c.first[k]:c.first[k + 1]]
            words = t.split()
            starts, ends = [], []
            if own.any():
                edge = np.diff(np.concatenate(([0], own.view(np.int8), [0])))
                starts, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
                words = [w for w, x in zip(words, own.tolist()) if not x]
            rows.append((key, len(own), int(own.sum()), b" ".join(words).decode(), starts, ends))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_text", "span_starts", "span_ends"])
        return out.astype({"doc_id": "Int64"})

    marks = (dealt.groupBy("chunk").applyInPandas(send, "bucket int, chunk int, hashes binary")
             .groupBy("bucket").applyInPandas(count, "chunk int, bucket int, bits binary"))
    return dealt.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInPandas(
        finish, "doc_id long, n_words long, n_removed long, kept_text string, "
                "span_starts array<long>, span_ends array<long>")
