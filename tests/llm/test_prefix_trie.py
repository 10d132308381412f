"""The prefix trie against a brute-force trie, and its defined cases."""

import collections
import hashlib
import random
import zlib

import pytest

SCHEMA = "conv_id long, turn long, role string, text string, depth long, a string"


def brute(rows, group=5, heads=9):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = tuple(own.get(c - c % group, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    out = []
    for n, who in members.items():
        inside = [m for m in members if m[:len(n)] == n]
        ends = ",".join(map(str, sorted(c for c in who if len(rebuilt[c]) == len(n))))
        out.append((min(who), len(n), min(members[n[:-1]]) if n else None, len(who), children[n],
                    sum(1 for m in inside if not children[m]),
                    sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in inside if m),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return collections.Counter(out)


def made(seed, convs, longest):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(convs * 2), convs):
        n = r.choice([1, 2, 3, r.randint(1, longest)])
        for t in range(n):
            text = r.choice(["", None, "x", "ää", f"t{t}"]) if r.random() < .9 else f"own {c}"
            rows.append((c, None if r.random() < .05 else t, r.choice(["user", "user", "user", None]), text))
    return rows + rows[:3] + [(None, 1, "user", "lost")]


def run(spark, rows, **kw):
    from panelcast.llm.prefix_trie import prefix_trie
    df = spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA).repartition(3)
    return collections.Counter(tuple(r) for r in prefix_trie(df, **kw).collect())


@pytest.mark.parametrize("seed,band", [(1, 32), (2, 3)])
def test_trie_against_brute_force(spark, seed, band):
    rows = made(seed, 60, 9 if band == 32 else 20)
    assert run(spark, rows, band=band) == brute(rows)


def test_deep_trie_crosses_many_bands(spark):
    rows = [(c, t, "user", "same" if t < 20 else f"{c} {t}") for c in (5, 6, 7, 8) for t in range(37)]
    assert run(spark, rows, band=2) == brute(rows)


def test_copies_share_their_nodes(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 400, 5) for t in range(2)]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) == 3


def test_empty_and_turnless(spark):
    assert run(spark, []) == collections.Counter()
    assert run(spark, [(None, 1, "user", "x")]) == collections.Counter()
    short = [(1, 0, "user", "only")]          # its source is absent and its own turns end before its head
    assert run(spark, short) == brute(short)


def test_digest_of_many_ends_comes_in_chunks(spark):
    from panelcast.llm.prefix_trie import ends_digests
    df = spark.range(5000).selectExpr("id % 2 as a", "0L as b", "id as conv_id").repartition(7)
    got = {r.a: r.ends_sha256 for r in ends_digests(df, chunk=100).collect()}
    want = {a: hashlib.sha256(",".join(str(i) for i in range(a, 5000, 2)).encode()).hexdigest() for a in (0, 1)}
    assert got == want


def test_trie_against_sql(spark):
    import duckdb
    from panelcast.llm.queries import op11_prefix_trie
    from panelcast.llm.prefix_trie import trie_sql
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{sf}/conversations.parquet'")
    want = con.sql(trie_sql())
    got = op11_prefix_trie(spark, sf)
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    assert collections.Counter(tuple(r) for r in got.select(*cols).collect()) == \
        collections.Counter(tuple(r) for r in want.select(", ".join(cols)).fetchall())
