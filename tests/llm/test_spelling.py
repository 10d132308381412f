"""Spelling variants against brute force, and their defined cases."""

import collections
import random
import re
import zlib

import numpy as np

SCHEMA = "doc_id long, text string, n long, word string"


def brute(rows, modulus=97):
    n = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % modulus == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out, form = [], {}
    found = {w: [x for x in n if x != w and near(w, x)] for w in n}
    for w, xs in found.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(found[w]), n[form[w]] if form[w] else None))
    return collections.Counter(out)


def made(seed, words=250):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdé×") for _ in range(r.randint(4, 8))) for _ in range(words)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(60):
            w = base[int(r.random() ** 3 * words)]
            if r.random() < .3:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1:], w[:k] + r.choice("abcx") + w[k + 1:], w[:k] + r.choice("ab") + w[k:]])
            text.append(w.upper() if r.random() < .05 else w)
        rows.append((i, " ".join(text) + r.choice([".", " 1a", "中"])))
    return rows


def odd():
    long_word = "ab" * 4000
    return [(None, "lostword lostword lostword lostwords " * 2), (7, None), (8, ""), (9, " 12 _ 中 "),
            (10, f"{long_word} {long_word}c " * 3), (10, "twice twice"), (10, "twice twice")]


def run(spark, rows, **kw):
    from panelcast.llm.spelling import spelling_variants
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(3)
    return collections.Counter(tuple(r) for r in spelling_variants(df, **kw).collect())


def test_against_brute_force(spark):
    rows = made(1) + odd()
    assert run(spark, rows) == brute(rows)


def test_many_small_cells(spark):
    rows = made(2)
    assert run(spark, rows, cell_words=12, sample_words=100, modulus=11) == brute(rows, 11)


def test_anagrams_are_dealt_to_chunks(spark):
    from itertools import permutations
    rows = [(i, " ".join("".join(p) for p in permutations("abcde"))) for i in range(4)] + \
        [(9, " ".join("".join(p)[:-1] + "z" for p in permutations("abcde")) + " abcdex " * 20)]
    assert run(spark, rows, cell_words=10) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == run(spark, [(1, None)]) == collections.Counter()


def test_tree_search_prunes_only_what_is_far():
    from panelcast.llm.spelling import KdTree, letter_counts, letter_rows
    r = random.Random(5)
    words = sorted({"".join(r.choice("abcdef") for _ in range(7)) for _ in range(400)})
    counts = letter_counts(letter_rows(words, 7)).astype(int)
    tree = KdTree(counts, 5)
    q, node = tree.search(counts, 1, 1)
    seen = set()
    for a, k in zip(q.tolist(), node.tolist()):
        seen.update((a, b) for b in tree.order[tree.start[k]:tree.end[k]].tolist())
    want = {(a, b) for a in range(len(words)) for b in np.flatnonzero(
        (np.maximum(counts - counts[a], 0).sum(1) <= 1) & (np.maximum(counts[a] - counts, 0).sum(1) <= 1)).tolist()}
    assert want <= seen and len(seen) < .5 * len(words) ** 2


def test_against_sql(spark):
    import duckdb
    from panelcast.llm.queries import op12_spelling
    from panelcast.llm.spelling import spelling_sql
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.sql(spelling_sql())
    got = op12_spelling(spark, sf)
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    assert collections.Counter(tuple(r) for r in got.select(*cols).collect()) == \
        collections.Counter(tuple(r) for r in want.select(", ".join(cols)).fetchall())
