"""The training-data operators against brute force, and their defined edge cases."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "x") for i, t in rows], SCHEMA)


def words(n, seed):
    r = random.Random(seed)
    return [r.choice(["the", "of", "and"]) if r.random() < .3 else "".join(r.choice("abcdefgh") for _ in range(6))
            for _ in range(n)]


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    long_text = " ".join(words(9000, 1))
    base = " ".join(words(120, 2))
    return [(1, base), (1, base), (2, None), (3, ""), (4, "  \n\t "), (5, long_text), (None, "lost id " + base),
            (7, base + " end"), (8, "ÄÖ ñ 日本語 \u00a0 <|endoftext|> x"), (9, "A\x1cb c'd 1234")]


def test_packing(spark, odd_rows):
    from panelcast.llm.packing import pack
    from panelcast.llm.queries import tokenizer_file
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    r = pack(frame(spark, odd_rows), path, 256).toPandas()
    for key, text in odd_rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        mine = r[r.doc_id.isna() if key is None else r.doc_id == key].sort_values("start")
        assert set(mine.doc_tokens) == {len(ids)}
        for p in mine.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
        assert mine.length.sum() == len(ids) * sum(k == key for k, _ in odd_rows)
    r = r.sort_values(["sequence_id", "offset"])
    by = r.groupby("sequence_id").length
    assert (by.cumsum() - r.length == r.offset).all() and by.sum().max() <= 256
    assert pack(frame(spark, []), path).count() == 0


def test_pack_patterns_place_everything():
    from panelcast.llm.packing import pack_patterns, pattern_slots
    r = random.Random(3)
    for _ in range(50):
        h = {r.randint(1, 64): r.randint(1, 40) for _ in range(r.randint(1, 30))}
        patterns = pack_patterns(h, 64)
        got = collections.Counter()
        for count, lengths in patterns:
            assert sum(lengths) <= 64
            for x in lengths:
                got[x] += count
        assert got == h and len(patterns) <= 2 * 64
        assert sum(hi - lo for _, lo, hi, *_ in pattern_slots(patterns)) == sum(h.values())


def test_token_counts_and_cache(spark, odd_rows):
    from panelcast.llm.queries import tokenizer_file
    from panelcast.llm.token_counts import fresh_cache, read_cache, token_counts
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    tok, cache, docs = Tokenizer.from_file(path), fresh_cache(spark), frame(spark, odd_rows)
    first = token_counts(docs, path, cache).toPandas()
    assert len(first) == len(odd_rows)
    want = sorted((len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for _, t in odd_rows)
    assert sorted(zip(first.n_bytes, first.n_tokens)) == want
    stored = read_cache(spark, cache).count()
    assert stored == len({t or "" for _, t in odd_rows})
    more = frame(spark, odd_rows + [(20, "one more text")])
    assert token_counts(more, path, cache).count() == len(odd_rows) + 1
    assert read_cache(spark, cache).count() == stored + 1  # only the miss was encoded
    assert token_counts(frame(spark, []), path, fresh_cache(spark)).count() == 0


def brute_components(fps, bits):
    group = {f: f for f in fps}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("task_keys", [30, 100_000])
def test_hamming_links_against_all_pairs(spark, task_keys):
    from panelcast.llm.common import components
    from panelcast.llm.simhash import hamming_links
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for _ in range(4):
            g = f
            for b in r.sample(range(64), r.randint(1, 6)):
                g ^= 1 << b
            fps.add(g)
    crowd = r.getrandbits(64)  # many keys below one prefix
    fps |= {crowd ^ (1 << a) ^ (1 << b) for a in range(14) for b in range(a)}
    fps = sorted(fps)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {r["node"]: r["root"] for r in components(hamming_links(df, 4, task_keys)).collect()}
    want = brute_components(fps, 4)
    mine = collections.defaultdict(set)
    theirs = collections.defaultdict(set)
    for f in fps:
        mine[got.get(signed(f), signed(f))].add(f)
        theirs[want[f]].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_simhash_documents(spark, odd_rows):
    from panelcast.llm.simhash import keep_one, near_duplicates, text_fingerprint
    r = near_duplicates(frame(spark, odd_rows)).toPandas()
    assert len(r) == len(odd_rows)
    want = {k: format(text_fingerprint((t or "").encode(), 4, 42), "016x") for k, t in odd_rows}
    assert all(want[None if pd.isna(k) else k] == f for k, f in zip(r.doc_id, r.fingerprint))
    empty = r[r.fingerprint == "0" * 16]
    assert set(empty.doc_id) >= {2, 3, 4} and set(empty.component_id) == {2}
    kept = keep_one(frame(spark, odd_rows), 4, 4).toPandas()
    assert sorted(kept.doc_id.dropna()) == sorted(r.component_id.dropna().unique())
    assert list(kept.columns)[-1] == "label"
    assert near_duplicates(frame(spark, [])).count() == 0


def brute_repeats(rows, k):
    texts = [(key, (t or "").encode().split()) for key, t in rows]
    count = collections.Counter(tuple(w[i:i + k]) for _, w in texts for i in range(len(w) - k + 1))
    out = []
    for key, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if count[tuple(w[i:i + k])] > 1:
                gone[i:i + k] = [True] * k
        out.append((key, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_substring_dedup(spark, odd_rows):
    from panelcast.llm.substring_dedup import remove_repeats
    passage = " ".join(words(50, 8))
    rows = odd_rows + [(30, "a b " + passage + " tail of it"), (31, passage * 1 + " x " + passage), (32, "so " * 100)]
    for chunk, bucket in ((2_000_000, 2_000_000), (500, 40)):
        r = remove_repeats(frame(spark, rows), 35, chunk, bucket).toPandas()
        key = lambda x: (str(x[0]), x[1:])
        got = [(None if pd.isna(x.doc_id) else int(x.doc_id), x.n_words, x.n_removed, x.kept_text) for x in r.itertuples()]
        assert sorted(got, key=key) == sorted(brute_repeats(rows, 35), key=key)
        for x in r.itertuples():
            assert sum(b - a for a, b in zip(x.span_starts, x.span_ends)) == x.n_removed
    assert remove_repeats(frame(spark, [])).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distances():
    from panelcast.llm.decontaminate import band_distance
    from panelcast.llm.line_dedup import edit_distance
    r = random.Random(11)
    for _ in range(1500):
        a = "".join(r.choice("abc") for _ in range(r.randint(0, 14)))
        b = "".join(r.choice("abc") for _ in range(r.randint(0, 14)))
        for k in (1, 2, 3):
            assert edit_distance(a, b, k) == min(edits(a, b), k + 1)
        if a:
            best = min(edits(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
            got = band_distance(a.encode(), b.encode(), 2)
            assert (got is None) if best > 2 or len(b) < len(a) - 2 else got[0] == best


def mutate(line, n, r):
    for _ in range(n):
        i = r.randrange(len(line))
        line = [line[:i] + line[i + 1:], line[:i] + r.choice("xyz") + line[i:],
                line[:i] + r.choice("xyz") + line[i + 1:]][r.randrange(3)]
    return line


def test_line_dedup(spark, odd_rows):
    from panelcast.llm.line_dedup import line_classes, remove_lines
    r = random.Random(13)
    lines = [" ".join(words(r.randint(4, 12), 100 + i)) for i in range(25)]
    rows = list(odd_rows)
    for d in range(100, 130):
        rows.append((d, "\n".join(mutate(r.choice(lines), r.randint(0, 3), r) for _ in range(6)) + "\n\nshort"))
    first, find = {}, {}
    for key, t in sorted({(k, t) for k, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0)):
        for i, line in enumerate((t or "").split("\n")):
            line = re.sub(r"[ \t\n\x0b\f\r]+", " ", line).strip(" ")
            if len(line) >= 20:
                first.setdefault(line, (-1 if key is None else key, i))

    def root(x):
        while find.setdefault(x, x) != x:
            x = find[x]
        return x
    degree = collections.Counter()
    distinct = list(first)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2:
                degree[a] += 1
                degree[b] += 1
                x, y = sorted((root(a), root(b)), key=first.get)
                find[y] = x
    got = line_classes(frame(spark, rows)).toPandas()
    seen = collections.defaultdict(set)
    for x in got.itertuples():
        place = (-1 if pd.isna(x.doc_id) else int(x.doc_id), x.line_no)
        seen[place].add(((-1 if pd.isna(x.class_doc_id) else int(x.class_doc_id), x.class_line_no), x.n_links, x.removed))
    for key, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            line = re.sub(r"[ \t\n\x0b\f\r]+", " ", line).strip(" ")
            if len(line) >= 20:
                place = (-1 if key is None else key, i)
                want = first[root(line)]
                assert seen[place] == {(want, degree[line], place != want)}
    assert sum(degree.values()) > 20
    out = remove_lines(frame(spark, rows), 2, 20).toPandas()
    assert len(out) == len(rows) and "label" in out.columns
    assert line_classes(frame(spark, [])).count() == 0


@pytest.mark.parametrize("edits_, share", [(2, 0.1), (1, 0.25), (3, 0.03)])
def test_line_budget_grows_with_length(spark, edits_, share):
    from panelcast.llm.line_dedup import line_classes
    r = random.Random(19)
    lines = [" ".join(words(r.randint(4, 40), 900 + i)) for i in range(8)] + ["ab" * 30, "a" * 70]
    found = {mutate(x, r.randint(0, max(3, int(1.2 * share * len(x)))), r) for x in lines for _ in range(8)}
    # a changed first half of an otherwise equal line, and lengths across a class border
    found = sorted(x for x in found | {x + " tail of" for x in lines} if len(x) >= 20)
    rows = [(i, x) for i, x in enumerate(found)]
    want = collections.Counter()
    for i, a in enumerate(found):
        for j, b in enumerate(found[:i]):
            k = max(edits_, int(share * min(len(a), len(b))))
            if abs(len(a) - len(b)) <= k and edits(a, b) <= k:
                want[i] += 1
                want[j] += 1
    got = {x.doc_id: x.n_links for x in line_classes(frame(spark, rows), edits_, 20, share).collect()}
    assert got == {i: want[i] for i in range(len(found))}
    assert sum(want.values()) > 100


def test_short_lines_repeat_exactly(spark):
    from panelcast.llm.line_dedup import line_classes, remove_lines
    rows = [(1, "And ornd.\n\nx"), (2, "  And \t ornd.\nAnd orne."), (3, "x\n\nand ornd.")]
    got = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.n_links, r.removed)
           for r in line_classes(frame(spark, rows)).collect()}
    assert got == {(1, 0): (1, 0, 0, False), (1, 2): (1, 2, 0, False), (2, 0): (1, 0, 0, True), (2, 1): (2, 1, 0, False),
                   (3, 0): (1, 2, 0, True), (3, 2): (3, 2, 0, False)}
    out = {r.doc_id: r.text for r in remove_lines(frame(spark, rows)).collect()}
    assert out == {1: "And ornd.\n\nx", 2: "And orne.", 3: "\nand ornd."}


def test_decontamination(spark, odd_rows):
    from panelcast.llm.decontaminate import clean_documents, contamination
    r = random.Random(17)
    items = [(i, " ".join(words(40, 500 + i)).capitalize() + ".") for i in range(6)]
    bench = spark.createDataFrame(items + [(50, None), (51, ""), (52, "tiny")], "item_id long, text string")
    filler = lambda s: " ".join(words(60, s))
    leaked = [(100 + i, filler(i) + " " + t.upper() + "\n" + filler(90 + i)) for i, (_, t) in enumerate(items)]
    edited = [(200 + i, filler(30 + i) + " " + mutate(t, 8, r) + " " + filler(60 + i)) for i, (_, t) in enumerate(items)]
    clean = [(300 + i, filler(700 + i) + " ".join(items[i][1].split()[:6])) for i in range(6)]
    half = [(400, items[0][1][:len(items[0][1]) // 3] + filler(5)), (401, filler(6) + items[0][1][len(items[0][1]) // 3:][:40])]
    rows = odd_rows + leaked + edited + clean + half
    got = contamination(frame(spark, rows), bench).toPandas()
    hit = set(got[got.contaminated].doc_id)
    assert hit == {k for k, _ in leaked + edited}
    for x in got[got.contaminated].itertuples():
        assert list(x.items) == [int(x.doc_id) % 100]
    kept = clean_documents(frame(spark, rows), bench)
    assert kept.count() == len(rows) - len(hit) and kept.columns == frame(spark, []).columns
    assert contamination(frame(spark, []), bench).count() == 0
    assert contamination(frame(spark, rows), bench.limit(0)).where("contaminated").count() == 0


def test_benchmark_of_several_blocks(spark):
    from panelcast.llm.decontaminate import benchmark_blocks, clean_documents, contamination
    texts = [(i, " ".join(words(30, 800 + i))) for i in range(7)]
    assert [len(b) for b in benchmark_blocks([(i, "x" * n) for i, n in enumerate([4, 4, 3, 30, 1])], 10)] == [2, 1, 1, 1]
    bench = spark.createDataFrame(texts + [(3, texts[5][1]), (None, texts[6][1])], "item_id long, text string")
    rows = [(i, " ".join(words(50, 850 + i)) + " " + texts[i][1] + "\n" + texts[-1 - i][1]) for i in range(7)]
    rows += [(None, None), (90, " ".join(words(90, 890)))]

    def result(block_chars):
        return sorted(((r.doc_id is not None, r.doc_id, r.contaminated, r.n_regions, r["items"], sorted(zip(r.starts, r.ends, r.edits)))
                       for r in contamination(frame(spark, rows), bench, block_chars=block_chars).collect()), key=str)
    whole = result(2_000_000)
    assert sum(r[2] for r in whole) == 7
    for block_chars in (1, 500):  # smaller than the benchmark, which was refused
        assert result(block_chars) == whole
        assert clean_documents(frame(spark, rows), bench, block_chars=block_chars).count() == 2


def test_url_rules(spark):
    import duckdb

    from panelcast.llm.url_filter import url_verdicts, verdict_sql
    urls = [None, "", "nonsense", "http://a.com", "HTTP://A.COM/x", "http://b.example.com/en/1?x#y", "http://www.example.com/en/",
            "https://m.www.example.com/en/z", "https://x.net/es/1", "https://x.net/ES/1", "https://x.net/estes/", "http://notexample.com.org/en/",
            "https://x.org/login", "https://x.org/ads/1", "https://x.org/bads/1", "ftp://u@h.org:80/cart?x=1", "http://x.org?q=/ads/",
            "https://x.net/fr/1", "https://x.net/fr/1", "http://casino.example.org/", "http://a.b://c.com/"]
    pdf = pd.DataFrame({"page_id": range(len(urls)), "url": urls, "html": "x", "rule": "clash", "token": "t"})
    pages = spark.createDataFrame(pdf, "page_id long, url string, html string, rule string, token string")
    got = url_verdicts(pages).toPandas().sort_values("page_id").reset_index(drop=True)
    con = duckdb.connect()
    con.register("pages", pdf)
    want = con.execute(verdict_sql()).df().sort_values("page_id").reset_index(drop=True)
    for c in got.columns:
        assert got[c].fillna("~").tolist() == want[c].fillna("~").tolist(), c
    assert got.rule[5] == "example.com/en/" and got.verdict[6] == "allow" and got.rule[8] == "net/es/"
    assert got.verdict[12] == "block" and got.verdict[14] == "allow" and got.path[3] == ""
    assert url_verdicts(pages.limit(0)).count() == 0


def test_license_scan(spark, odd_rows):
    from panelcast.llm.license_scan import NOTICE_TEMPLATES, scan
    rows = odd_rows + [(40, "x\nReleased under the MIT License.\ny"), (41, "The MIT\n license; APACHE-License"),
                       (42, "Licensed under CC BY-NC 4.0."), (43, "mit der license general public license"),
                       (44, "a\n" + NOTICE_TEMPLATES[0][1].replace(", ", ",\n# ") + "\nb"), (45, "emit license")]
    got = {None if pd.isna(x.doc_id) else int(x.doc_id): x for x in scan(frame(spark, rows)).toPandas().itertuples()}
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    for key, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(i, lab) for i in range(len(w)) for p, lab in phrases.items() if tuple(w[i:i + len(p)]) == p]
        x = got[key]
        assert (x.n_words, x.n_base) == (len(w), len(at)), key
        assert x.base_labels == ",".join(sorted({lab for _, lab in at}))
        assert (x.first_word, x.last_word) == (min(at)[0], max(at)[0]) if at else pd.isna(x.first_word)
    assert got[40].labels == "mit" and got[42].labels == "cc-by-nc" and got[42].score == 1.0
    assert got[44].labels == "mit" and got[44].score >= 0.9 and got[45].labels == "" and got[45].score == 0
    assert scan(frame(spark, [])).count() == 0


def test_spotsigs(spark, odd_rows):
    from panelcast.llm.spotsigs import edited_fingerprints
    rows = [r for r in odd_rows if r[0] not in (None, 1)] + [(60 + i, " ".join(words(80, 40 + i))) for i in range(40)]
    got = {int(x.doc_id): x for x in edited_fingerprints(frame(spark, rows)).toPandas().itertuples()}
    rows = sorted(rows)
    for i, (key, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(t) // 4
        assert got[key].edited_sha256 == hashlib.sha256((t[:len(t) - q] + after[:q]).encode()).hexdigest()
        assert got[key].n_chars == len(t)
    assert got[2].fingerprint == got[3].fingerprint == "" and got[2].near_next == 1.0
    running = [got[k] for k in range(60, 99)]
    assert min(x.near_edited for x in running) > 0.3 > max(x.near_next for x in running)
    same = edited_fingerprints(frame(spark, [(1, "the cat of the house"), (2, "the cat of the house")])).toPandas()
    assert same.fingerprint.nunique() == 1 and (same.near_next == 1).all()
    assert edited_fingerprints(frame(spark, [(1, "the one and only text")])).first()["near_next"] == 1.0
    assert edited_fingerprints(frame(spark, odd_rows)).count() == len(odd_rows)
    assert edited_fingerprints(frame(spark, [])).count() == 0


def test_spotsigs_links_against_all_pairs(spark):
    from panelcast.llm.spotsigs import edited_fingerprints, similar_classes, similar_sets
    r = random.Random(23)
    sets = [frozenset()]
    for n in (1, 2, 4, 5, 6, 9, 10, 25, 80):
        for _ in range(6):
            base = [r.randrange(1 << 32) for _ in range(n)] if r.random() < .7 else r.sample(range(120), n)
            sets.append(frozenset(base))
            for _ in range(6):
                keep = r.sample(base, r.randint(max(1, 7 * n // 10), n))
                sets.append(frozenset(keep + [r.randrange(200) for _ in range(r.randint(0, n // 4 + 1))]))
    sets = sorted(set(sets), key=sorted)
    want = {(i, j) for j, y in enumerate(sets) for i, x in enumerate(sets[:j])
            if x and y and 10 * len(x & y) >= 8 * len(x | y)}
    rows = [(i, sorted(x)) for i, x in enumerate(sets)]
    got = similar_sets(spark.createDataFrame(rows + rows[::3], "id long, sigs array<long>")).collect()
    assert len(got) == len(want) > 50 and {(x.a, x.b) for x in got} == want
    base = words(300, 77)
    docs = [(1, " ".join(base)), (2, " ".join(words(300, 78))), (3, " ".join(base[:285] + words(15, 79))),
            (4, " ".join(base)), (5, " ".join(words(300, 80))), (6, None)]
    got = {x.doc_id: x.class_doc_id for x in edited_fingerprints(frame(spark, docs)).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1, 5: 5, 6: 6}
    # classes: components of all pairs, with a chain whose ends are far apart
    chain = [frozenset(range(500 + 4 * k, 540 + 4 * k)) for k in range(12)]
    sets = sorted(set(sets) | set(chain), key=sorted)
    root = list(range(len(sets)))
    for j, y in enumerate(sets):
        for i, x in enumerate(sets[:j]):
            if x and y and 10 * len(x & y) >= 8 * len(x | y):
                a, b = sorted((root[i], root[j]))
                root = [a if v == b else v for v in root]
    linked = {i for i, v in enumerate(root) if root.count(v) > 1}
    rows = [(i, sorted(x)) for i, x in enumerate(sets) if x]
    found = similar_classes(spark.createDataFrame(rows + rows[::3], "id long, sigs array<long>")).collect()
    assert {(x.node, x.root) for x in found} == {(i, root[i]) for i in linked} and len(found) == len(linked)


def test_gru_gradients():
    """The hand-written backward pass against numeric differences."""
    from panelcast.llm import toxicity as T
    r = np.random.default_rng(1)
    m = T.Model({"a": 0, "b": 1, "c": 2}, np.array([1.0, 0, -1]), np.zeros(T.STEM_BUCKETS))
    x = r.standard_normal((4, T.WORD_DIM + 2 * T.CHAR_DIM)).astype(np.float32)
    ids = np.array([[0, 1, 3], [2, 3, 0], [1, 0, 0]])
    mask = np.array([[1, 1, 1], [1, 1, 0], [1, 0, 0]], bool)
    y = np.array([1, 0, 1], np.float32)
    g, dx, _ = m.gradients(x, ids, mask, y)
    for name in ("Wf", "Uf", "bf", "Wb", "Ub", "bb", "Wa", "ba", "va", "wo", "bo"):
        p = m.p[name]
        at = tuple(int(r.integers(0, s)) for s in p.shape)
        old, h = p[at], np.float32(1e-2)
        p[at] = old + h
        up = m.gradients(x, ids, mask, y)[2]
        p[at] = old - h
        down = m.gradients(x, ids, mask, y)[2]
        p[at] = old
        assert abs((up - down) / (2 * h) - g[name][at]) < 2e-3, name
    assert dx.shape == x.shape and np.abs(dx).sum() > 0


def test_toxicity_held_out(spark, odd_rows):
    from panelcast.llm.toxicity import fit_on_tables, keep_clean, score_documents, window_starts
    bad = ["vilex", "grubbo", "nastor"]
    r = random.Random(23)
    rows, labels = list(odd_rows), []
    for i in range(100, 500):
        w = words(r.randint(20, 160), i)
        toxic = int(i % 3 == 0)
        for _ in range(4 * toxic):
            w[r.randrange(len(w))] = r.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    docs = frame(spark, rows)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    model = fit_on_tables(docs, marks, 300)
    got = score_documents(docs, model).toPandas().set_index("doc_id")
    held = [(k, t) for k, _, t in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(got.predicted[k] == t for k, t in held) / len(held) > 0.95
    assert got.score.between(0, 1).all() and len(got) == len(rows)
    kept = keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == int((got.predicted == 0).sum())
    assert fit_on_tables(docs, marks.where("toxic = 0"), 50) is None
    assert set(score_documents(docs, None).toPandas().predicted) == {0}
    assert score_documents(frame(spark, []), model).count() == 0
    for n in (0, 1, 48, 49, 200):
        covered = {k for s in window_starts(n) for k in range(s, min(n, s + 48))}
        assert covered == set(range(n))


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"]
    frames = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, frames[-1], sf).write.parquet(str(tmp_path / str(k)))
        frames.append(spark.read.parquet(str(tmp_path / str(k))))
    for f in frames[:-1]:
        assert f.columns == docs.columns
    counts = [f.count() for f in frames]
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] > 0
    packed = frames[-1].toPandas()
    assert set(packed.doc_id) == {r["doc_id"] for r in frames[-2].select("doc_id").collect()}
    empty = spark.read.schema(docs.schema).parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        out = stage(spark, empty, sf)
        assert out.count() == 0


def test_worker_state_holds_one_operator():
    from panelcast.llm.common import worker_state
    worker_state("a")["x"] = 1
    assert worker_state("a") == {"x": 1}
    assert worker_state("b") == {}
    assert worker_state("a") == {}


def test_word_ids_do_not_depend_on_the_cache_limit():
    from panelcast.llm.queries import tokenizer_file
    from panelcast.llm.token_cache import word_ids
    path = tokenizer_file("word_bpe_49k.json")
    texts = [f"Word{i} common, text {i * 7919} word{i % 3}" for i in range(200)] + ["", " "]
    whole = word_ids(texts, path)
    assert [word_ids([t], path, limit=5)[0] for t in texts] == whole


def test_lines_meet_inside_blocks(spark, monkeypatch):
    """No row per place of a line is shuffled; blocks of a few lines find the links that all pairs give."""
    import panelcast.llm.line_dedup as L
    monkeypatch.setattr(L, "BLOCK_CHARS", 400)
    r = random.Random(11)
    lines = [" ".join(words(r.randint(5, 30), 700 + i)) for i in range(6)]
    lines = sorted({mutate(x, r.randint(0, len(x) // 8), r) for x in lines for _ in range(8)} | {"ab" * 40, "ab" * 39 + "a"})
    occ = L.occurrences(frame(spark, list(enumerate(lines))))
    histogram: dict[int, int] = {}
    for x in lines:
        histogram[len(x)] = histogram.get(len(x), 0) + 1
    got = L.similar_lines(occ, histogram, 2, 0.1, 20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" in plan
    ids = {row["line"]: row["id"] for row in occ.collect()}
    want = {tuple(sorted((ids[a], ids[b]))) for i, a in enumerate(lines) for b in lines[:i]
            if min(len(a), len(b)) >= 20 and L.edit_distance(a, b, max(len(a), len(b))) <= L.budget(min(len(a), len(b)), 2, 0.1)}
    assert {(row["a"], row["b"]) for row in got.collect()} == want and len(want) > 20


def test_lines_within_their_budgets():
    from panelcast.llm.line_dedup import alignment_edits, edit_distance, within
    r = random.Random(12)
    pairs = [(x, mutate(x, r.randint(0, 12), r), r.randint(0, 10)) for x in
             ("".join(r.choice("abé ") for _ in range(r.randint(13, 90))) for _ in range(200))]
    exact = [edit_distance(a, b, 100) for a, b, _ in pairs]
    assert within(pairs, cells=500).tolist() == [d <= k for d, (_, _, k) in zip(exact, pairs)]
    assert all(alignment_edits(a, b, 100) >= d for d, (a, b, _) in zip(exact, pairs))


def test_written_tables_leave_no_shuffle_files(spark):
    """A shared table's shuffle files go when it stands, and spotsigs' tables when they are read no more."""
    import os

    from pyspark.sql import functions as F

    from panelcast.llm.spotsigs import similar_classes
    from panelcast.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir, shared_table
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {x for x in blocks.getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}

    before, said = shuffles(), spark.conf.get(SHUFFLE_CLEANUP)
    table = shared_table(spark.range(1000).repartition(3, "id"), "cleaned")
    made = set()
    for _ in range(50):
        made = {x.split("_")[1] for x in shuffles() - before}
        if not made:
            break
        time.sleep(0.1)
    assert not made and table.count() == 1000 and spark.conf.get(SHUFFLE_CLEANUP) == said
    r = random.Random(5)
    base = [sorted(r.sample(range(10_000), 30)) for _ in range(6)]
    rows = [(i, sorted({*b[:30 - i % 3], 20_000 + i})) for i, b in enumerate(base * 4)]
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    sets = spark.createDataFrame(rows, "id long, sigs array<long>").withColumn("id", F.xxhash64("sigs"))
    held = set(os.listdir(folder))
    assert similar_classes(sets).select("root").distinct().count() == 6
    assert not [x for x in set(os.listdir(folder)) - held if x.startswith("spot-")]


def test_pairs_are_compared_together():
    """The table of many pairs gives their edit distances, whatever its width; common ends are left out."""
    import panelcast.llm.line_dedup as L
    r = random.Random(23)
    a = ["".join(r.choice("abé \U0001F600") for _ in range(r.randint(1, 160))) for _ in range(120)]
    b = [mutate(x, r.randint(0, min(40, len(x) - 1)), r) or "a" for x in a]
    k = np.array([r.randint(0, 45) for _ in a])
    one, two = (L.Lines(np.arange(len(x)), np.array([len(y) for y in x]), L.code_points("".join(x))) for x in (a, b))
    want = np.array([L.edit_distance(x, y, n) <= n for x, y, n in zip(a, b, k.tolist())])
    assert 20 < want.sum() < 110
    for words_ in (2, 3, 5):
        got = L.in_band(one.points, one.start, one.n, two.points, two.start, two.n, k, words_)
        assert (got & (np.abs(one.n - two.n) <= k) == want).all()
    which = np.arange(len(a))
    assert (L.close(one, which, two, which, k) == want).all()


def test_classes_need_no_pairs_of_connected_lines(spark):
    """A group of near copies is connected by one link a line, and the lines removed stay the same."""
    import panelcast.llm.line_dedup as L
    r = random.Random(29)
    base = " ".join(words(30, 77))
    lines = sorted({mutate(base, 2, r) for _ in range(60)}, key=len)
    held = L.Lines(np.arange(len(lines)), np.array([len(x) for x in lines]), L.code_points("".join(lines)))
    every, some = (np.concatenate(list(L.Filed(held, 2, 0.1, pairs).links(held)), axis=1) for pairs in (True, False))
    assert every.shape[1] == len(lines) * (len(lines) - 1) // 2 and some.shape[1] == len(lines) - 1
    docs = frame(spark, [(i, "\n".join(r.sample(lines, 3) + ["another line of its own " + str(i) * 9])) for i in range(12)])
    rows = [{tuple(x) for x in L.line_classes(docs, 2, 20, 0.1, pairs).drop("n_links").collect()} for pairs in (True, False)]
    assert rows[0] == rows[1] and any(x[-1] for x in rows[0])


def test_many_pairs_of_few_sets_are_compared_in_rounds(spark, monkeypatch):
    """No round sends many more pairs than there are sets, and the rounds together find what all pairs give."""
    import panelcast.llm.spotsigs as S
    from pyspark.sql import functions as F
    r = random.Random(31)
    base = list(range(40))
    rows = [(i, sorted({*r.sample(base, r.randint(30, 40)), 100 + i % 3})) for i in range(14)]
    want = {(a, b) for a, x in rows for b, y in rows if a < b and 10 * len({*x} & {*y}) >= 8 * len({*x, *y})}
    pairs = S.shared_table(spark.createDataFrame([(a, b) for a, _ in rows for b, _ in rows if a < b], "a long, b long"), "pairs")
    sent = []
    keep = S.shared_table
    monkeypatch.setattr(S, "shared_table", lambda df, label: sent.append(label) or keep(df, label))
    got = S.compared(pairs, spark.createDataFrame(rows, "id long, sigs array<long>"), 8, 10)
    assert {tuple(x) for x in got.select("a", "b").collect()} == want and len(want) > 14
    assert sent.count("spot-links") == -(-91 // 14) + 1 and got.where(F.col("a") >= F.col("b")).isEmpty()
