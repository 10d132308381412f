"""Spelling variants of the corpus vocabulary, found with k-d trees.

Words are counted where the texts are read and summed by Spark. Every word is
a point: its letter counts. One replaced letter takes one count away and adds
one, one more letter adds one, so near words lie at an L1 distance of two or
one, with at most one count up and one down. For each pair of lengths (equal,
and one apart) a k-d tree over the longer words is searched with the shorter
ones: a box is pruned as soon as it needs a second count up or down. What is
left is verified letter by letter.

The top of each tree is built from a sample of the words and deals all words
to cells: as a point to the cell it lies in, as a query to every cell its
search reaches. A Spark task completes the tree of its cell and searches it.
The sample shapes the cells only; every word is indexed and searched.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import crc_list, shared_table, sql_crc32
from panelcast.llm.token_cache import in_blocks

#: Latin-1 codes of the letters: a-z and U+00C0 to U+00FF.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
#: A-Z become a-z, letters stay, all else parts words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in LETTERS else 32 for c in range(256))
_DIM = np.zeros(256, np.int64)
_DIM[LETTERS] = np.arange(len(LETTERS))


class _Vocabulary(dict):
    """Numbers of the words met so far, with their CRC and length in UTF-8."""

    def __init__(self):
        super().__init__()
        self.words, self.crc, self.size = [], np.zeros(1024, np.uint32), np.zeros(1024, np.int64)
        self.n = np.zeros(0, np.int64)

    def __missing__(self, word):
        k = self[word] = len(self.words)
        if k == len(self.crc):
            self.crc, self.size = np.resize(self.crc, 2 * k), np.resize(self.size, 2 * k)
        utf8 = word.decode("latin-1").encode()
        self.words.append(word)
        self.crc[k], self.size[k] = zlib.crc32(utf8), len(utf8)
        return k

    def count(self, keys: list[bytes], texts: list[str], modulus: int, min_chars: int) -> dict[bytes, int]:
        """Add the words of some documents; returns the words that lose a
        letter. ``crc(key + word)`` is the word's CRC, XORed with a value that
        depends on the key and the word's length alone. Words under
        ``min_chars`` letters count for nothing, with or without one more lost."""
        rows = [[w for w in t.encode("latin-1", "replace").translate(_TABLE).split() if len(w) >= min_chars] for t in texts]
        ids = np.array([k for r in rows for k in map(self.__getitem__, r)], np.int64)
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        if not len(ids):
            return {}
        size = self.size[ids]
        width = int(size.max()) + 1
        pair, which = np.unique(doc * width + size, return_inverse=True)
        zeros = bytes(width)
        plain = {int(s): zlib.crc32(zeros[:s]) for s in np.unique(size)}
        start = [zlib.crc32(k) for k in keys]
        shift = np.array([zlib.crc32(zeros[:p % width], start[p // width]) ^ plain[p % width] for p in pair.tolist()], np.uint32)
        h = self.crc[ids] ^ shift[which]
        hit = np.flatnonzero(h % np.uint32(modulus) == 0)
        total = np.bincount(ids, minlength=len(self.words))
        np.subtract.at(total, ids[hit], 1)
        total[:len(self.n)] += self.n
        self.n = total
        shorter: dict[bytes, int] = {}
        for k, x in zip(ids[hit].tolist(), h[hit].tolist()):
            word = self.words[k]
            word = word[:x % len(word)] + word[x % len(word) + 1:]
            shorter[word] = shorter.get(word, 0) + 1
        return shorter


def word_counts(docs: DataFrame, modulus: int = 97, min_chars: int = 5, min_count: int = 3,
                flush: int = 300_000) -> DataFrame:
    """Words of at least ``min_chars`` letters and ``min_count`` occurrences: word, n, size."""
    def count(frames):
        seen, shorter = _Vocabulary(), {}

        def out():
            both = {}
            for w, n in [*zip(seen.words, seen.n.tolist()), *shorter.items()]:
                if n and len(w) >= min_chars:
                    both[w] = both.get(w, 0) + n
            return [pd.DataFrame({"word": [w.decode("latin-1") for w in both], "n": list(both.values())})] if both else []

        for pdf in frames:
            keys, texts = [f"{i}:".encode() for i in pdf["id"]], pdf["text"].tolist()
            for s in in_blocks(texts):
                for w, n in seen.count(keys[s], texts[s], modulus, min_chars).items():
                    shorter[w] = shorter.get(w, 0) + n
                if len(seen.words) > flush:
                    yield from out()
                    seen, shorter = _Vocabulary(), {}
        yield from out()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return (rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count).withColumn("size", F.length("word")))


def letter_rows(words: list[str], size: int) -> np.ndarray:
    """Words of one length as a matrix of Latin-1 codes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(-1, size)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    n, size = rows.shape
    out = np.zeros((n, len(LETTERS)), np.int16 if size < 2 ** 15 else np.int32)
    at = np.arange(n)
    for c in range(size):
        out[at, _DIM[rows[:, c]]] += 1
    return out


class KdTree:
    """A k-d tree over letter counts; each node halves its points by one letter's count.

    ``dim`` is -1 in leaves. ``low``/``high`` bound the node's box in the letter
    that it is split by; points with at most ``cut`` of it go left.
    """

    WIDE = 2 ** 30

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.dim, self.cut, self.low, self.high = [], [], [], []
        self.left, self.right, self.start, self.end = [], [], [], []
        used = np.flatnonzero(points.any(axis=0))
        points = points[:, used].astype(np.float32)
        todo = [(0, len(points), {}, -1, False)]
        while todo:
            a, b, box, parent, right = todo.pop()
            node = len(self.dim)
            if parent >= 0:
                (self.right if right else self.left)[parent] = node
            mine = points[self.order[a:b]]
            d = cut = -1
            if b - a > leaf:
                widest = int(((mine * mine).mean(axis=0) - mine.mean(axis=0) ** 2).argmax())
                x = mine[:, widest]
                cut = min(int(np.median(x)), int(x.max()) - 1)
                d = int(used[widest]) if cut >= x.min() else -1
            low, high = box.get(d, (0, self.WIDE))
            for k, v in (("dim", d), ("cut", cut), ("low", low), ("high", high), ("left", -1), ("right", -1),
                         ("start", a), ("end", b)):
                getattr(self, k).append(v)
            if d >= 0:
                below = x <= cut
                part = self.order[a:b]
                self.order[a:b] = np.concatenate((part[below], part[~below]))
                m = a + int(below.sum())
                todo.append((m, b, box | {d: (cut + 1, high)}, node, True))
                todo.append((a, m, box | {d: (low, cut)}, node, False))
        for k in ("dim", "cut", "low", "high", "left", "right", "start", "end"):
            setattr(self, k, np.array(getattr(self, k), np.int64))
        self.leaf = np.cumsum(self.dim < 0) - 1
        self.leaves = int((self.dim < 0).sum())

    def search(self, queries: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, leaf node) whose box may hold a point with at most
        ``up`` counts more and ``down`` counts fewer than the query."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        more, less = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        found_q, found_n = [], []
        while len(q):
            d = self.dim[node]
            end = d < 0
            found_q.append(q[end])
            found_n.append(node[end])
            q, node, more, less, d = q[~end], node[~end], more[~end], less[~end], d[~end]
            x = queries[q, d].astype(np.int64)
            cut = self.cut[node]
            to_left = less + np.maximum(0, x - cut) - np.maximum(0, x - self.high[node])
            to_right = more + np.maximum(0, cut + 1 - x) - np.maximum(0, self.low[node] - x)
            le, ri = to_left <= down, to_right <= up
            q, node, more, less = (np.concatenate((q[le], q[ri])), np.concatenate((self.left[node[le]], self.right[node[ri]])),
                                   np.concatenate((more[le], to_right[ri])), np.concatenate((to_left[le], less[ri])))
        return (np.concatenate(found_q), np.concatenate(found_n)) if found_q else (q, node)


def _half_keys(rows: np.ndarray, cut: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``cut`` letters and of those after the next ``skip``."""
    out = []
    for part in (rows[:, :cut], rows[:, cut + skip:]):
        h = np.zeros(len(rows), np.uint64)
        for c in range(part.shape[1]):
            h = (h ^ part[:, c]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out.append(h)
    return out[0], out[1]


def near_pairs(tree: KdTree, points: np.ndarray, queries: np.ndarray, counts: np.ndarray, block: int = 2000):
    """Pairs (query, point) one edit apart, for queries as long as the points or one letter shorter.

    ``points``/``queries`` are letter matrices, ``counts`` the queries' letter counts. One edit
    leaves the first or the second half of a word as it was: that is asked before letters are compared.
    """
    size, longer = queries.shape[1], points.shape[1] > queries.shape[1]
    qa, qb = _half_keys(queries, size // 2)
    pa, pb = _half_keys(points, size // 2)
    if longer:
        pb = _half_keys(points, size // 2, 1)[1]
    width = (tree.end - tree.start)
    block = max(1, min(block, 40_000_000 // max(1, size * 64)))
    for s in range(0, len(queries), block):
        q, node = tree.search(counts[s:s + block], 1, 0 if longer else 1)
        for t in range(0, len(q), 200_000):
            qq, nn = q[t:t + 200_000] + s, node[t:t + 200_000]
            w = width[nn]
            i = np.repeat(qq, w)
            first = np.cumsum(w) - w
            j = tree.order[np.arange(len(i)) - np.repeat(first - tree.start[nn], w)]
            ok = (qa[i] == pa[j]) | (qb[i] == pb[j])
            i, j = i[ok], j[ok]
            step = max(1, 20_000_000 // max(1, size))
            for u in range(0, len(i), step):
                a, b = queries[i[u:u + step]], points[j[u:u + step]]
                if longer:
                    differ = a != b[:, :-1]
                    at = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
                    good = ~((a != b[:, 1:]) & (np.arange(size) >= at[:, None])).any(axis=1)
                else:
                    good = (a != b).sum(axis=1) == 1
                yield i[u:u + step][good], j[u:u + step][good]


def _room(size: int, cell_words: int) -> int:
    """Words of one length that a cell should hold: fewer where they are very long."""
    return max(1, min(cell_words, 2_000_000 // size))


def plan_cells(words: DataFrame, cell_words: int, sample_words: int) -> dict[int, tuple]:
    """Per length: (top tree or None, number of its first cell, chunks per leaf).

    Reads one row per length and about ``sample_words`` words. A leaf that the
    tree cannot split (words of the same letters) is dealt to chunks.
    """
    counts = {r["size"]: r["n"] for r in words.groupBy("size").agg(F.count("*").alias("n")).collect()}
    share = max(1, sum(counts.values()) // sample_words)
    crowded = [s for s, n in counts.items() if n > _room(s, cell_words)]
    sample: dict[int, list[str]] = {}
    if crowded:
        for r in words.where(F.col("size").isin(crowded) & (F.pmod(F.xxhash64("word"), F.lit(share)) == 0)) \
                      .select("size", "word").collect():
            sample.setdefault(r["size"], []).append(r["word"])
    plan, cell = {}, 0
    for size, n in sorted(counts.items()):
        tree, chunks = None, np.ones(1, np.int64)
        if size in sample:
            got = sample[size]
            scale = n / len(got)
            tree = KdTree(letter_counts(letter_rows(sorted(got), size)), max(1, int(_room(size, cell_words) / scale)))
            held = (tree.end - tree.start)[tree.dim < 0] * scale
            chunks = np.maximum(1, np.ceil(held / (2 * _room(size, cell_words)))).astype(np.int64)
            tree.order = None
        plan[size] = (tree, cell, chunks)
        cell += len(chunks)
    return plan


def near_words(words: DataFrame, cell_words: int = 20_000, sample_words: int = 200_000) -> DataFrame:
    """Per word with near words: word, n_near, best (the near word of largest n, smallest if tied), best_n."""
    plan = plan_cells(words, cell_words, sample_words)

    def deal(frames):
        for pdf in frames:
            for size, part in pdf.groupby("size"):
                part = part.reset_index(drop=True)
                counts = letter_counts(letter_rows(part["word"].tolist(), size))
                own = np.array([zlib.crc32(w.encode()) for w in part["word"]], np.int64)
                for role, target, down in ((1, size, 1), (2, size + 1, 0)):
                    if target not in plan:
                        continue
                    tree, first, chunks = plan[target]
                    if tree is None:
                        q, leaf = np.arange(len(part)), np.zeros(len(part), np.int64)
                        home = leaf
                    else:
                        q, node = tree.search(counts, 1, down)
                        leaf = tree.leaf[node]
                        if role == 1:
                            home = np.zeros(len(part), np.int64)
                            hq, hn = tree.search(counts, 0, 0)
                            home[hq] = tree.leaf[hn]
                    times = chunks[leaf]
                    q, leaf = np.repeat(q, times), np.repeat(leaf, times)
                    chunk = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
                    kind = np.full(len(q), role)
                    if role == 1:
                        kind[(leaf == home[q]) & (chunk == own[q] % chunks[home[q]])] = 0
                    yield pd.DataFrame({"cell": first + leaf, "chunk": chunk, "role": kind,
                                        "word": part["word"].to_numpy()[q], "n": part["n"].to_numpy()[q]})

    def search(pdf):
        words, n = pdf["word"].to_numpy(), pdf["n"].to_numpy()
        rank = np.empty(len(pdf), np.int64)
        by = np.lexsort((words.astype(str), -n))
        rank[by] = np.arange(len(pdf))
        role = pdf["role"].to_numpy()
        near, best = np.zeros(len(pdf), np.int64), np.full(len(pdf), len(pdf))
        at = np.flatnonzero(role == 0)
        if len(at):
            points = letter_rows(words[at].tolist(), len(words[at[0]]))
            point_counts = letter_counts(points)
            tree = KdTree(point_counts, 24)
            for kind in (0, 1, 2):
                mine = at if kind == 0 else np.flatnonzero(role == kind)
                if not len(mine):
                    continue
                rows = points if kind == 0 else letter_rows(words[mine].tolist(), len(words[mine[0]]))
                counts = point_counts if kind == 0 else letter_counts(rows)
                for i, j in near_pairs(tree, points, rows, counts):
                    i, j = mine[i], at[j]
                    near += np.bincount(i, minlength=len(near))
                    np.minimum.at(best, i, rank[j])
                    if kind == 2:       # the longer word meets the shorter one here only
                        near += np.bincount(j, minlength=len(near))
                        np.minimum.at(best, j, rank[i])
        got = np.flatnonzero(near)
        return pd.DataFrame({"word": words[got], "n_near": near[got], "best": words[by[best[got]]], "best_n": n[by[best[got]]]})

    dealt = words.mapInPandas(deal, "cell long, chunk long, role int, word string, n long")
    found = dealt.groupBy("cell", "chunk").applyInPandas(search, "word string, n_near long, best string, best_n long")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b"))
            .select("word", "n_near", F.col("b.w").alias("best"), (-F.col("b.m")).alias("best_n")))


def spelling_variants(docs: DataFrame, modulus: int = 97, min_chars: int = 5, min_count: int = 3, ratio: int = 2,
                      cell_words: int = 20_000, sample_words: int = 200_000) -> DataFrame:
    """Words of the corpus with their likely spelling: word, form, root, n, n_near, form_n.

    ``form`` is the near word (one edit) of largest n, if that is at least
    ``ratio`` times the word's own; ``root`` is the end of the chain of forms.
    Defined cases: null texts have no words; a null doc_id is the empty text
    in the hash; repeated rows count again; near words of equal n tie to the
    smallest in code-point order; words of any length are kept whole; an
    empty table gives an empty result; other columns are ignored.
    """
    words = shared_table(word_counts(docs, modulus, min_chars, min_count), "spelling-words")
    near = near_words(words, cell_words, sample_words)
    ruled = F.col("best_n") >= ratio * F.col("n")
    words = shared_table(words.join(near, "word", "left").select(
        "word", F.when(ruled, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(ruled, F.col("best_n")).alias("form_n")), "spelling-forms")
    # n at least doubles from word to form, so a chain has at most log2(largest n) steps; reach doubles each round
    most = words.agg(F.max("n")).first()[0] or 1
    roots = words.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range((most.bit_length() - 1).bit_length()):
        roots = shared_table(roots, "spelling-roots")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return (words.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_sql(modulus: int = 97, min_chars: int = 5, min_count: int = 3, ratio: int = 2) -> str:
    """The same words in DuckDB: near words by equality of what one edit leaves."""
    octets = ("list_transform(range(0, strlen(s)), lambda i: CAST(strpos('0123456789ABCDEF', hex(encode(s))[2 * i + 1]) - 1 AS BIGINT) * 16"
              " + strpos('0123456789ABCDEF', hex(encode(s))[2 * i + 2]) - 1)")
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS r FROM documents WHERE text IS NOT NULL)
  GROUP BY ALL),
hashed AS (
  SELECT run, n, {sql_crc32('octets')} AS h
  FROM (SELECT run, n, {octets} AS octets, tab FROM (
    SELECT run, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, {crc_list()} AS tab FROM runs))),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {modulus} = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= {min_chars} GROUP BY word HAVING sum(n) >= {min_count}),
cuts AS (
  SELECT word, n, i, substring(word, 1, i) AS head, substring(word, i + 2) AS tail
  FROM (SELECT *, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON w.word = c.head || c.tail
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON w.word = c.head || c.tail),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= {ratio} * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= {ratio} * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word"""
