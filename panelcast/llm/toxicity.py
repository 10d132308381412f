"""Toxicity scores from a bidirectional GRU with attention pooling, in numpy.

Inputs of a word: the embedding of the word, if the training sample knows it,
the mean embedding of its character trigrams, and that of its beginnings of
three to six characters (which stand for its stem). A text is cut into
overlapping windows that cover all its words; each window is read by a GRU in
both directions, attention pools the states, and the text's score is that of
its highest window.

The classifier is fitted on a bounded sample of labelled rows (``train_docs``
of each class, chosen by hash of the id); scoring reads every window of every
text. Labels, language, source and id are never inputs.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import worker_state

WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 8, 12, 12
CHAR_BUCKETS, STEM_BUCKETS = 4096, 32_768
WINDOW, STRIDE = 48, 36
EDGE = " \t\n\r.,;:!?\"'()[]{}<>|*#_-–—…«»“”‘’¡¿/\\=+~`"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def window_starts(n: int, window: int = WINDOW, stride: int = STRIDE) -> list[int]:
    """Starts of overlapping windows that cover words 0..n-1; the last ends at n."""
    if n <= window:
        return [0]
    return [*range(0, n - window, stride), n - window]


def trigrams(word: str) -> list[int]:
    w = f"^{word}$"
    return [zlib.crc32(w[i:i + 3].encode()) % CHAR_BUCKETS for i in range(max(1, len(w) - 2))]


def stems(word: str) -> list[int]:
    return [zlib.crc32(word[:k].encode()) % STEM_BUCKETS for k in range(3, min(6, len(word)) + 1)] or [0]


def _mean_rows(table: np.ndarray, lists: list[list[int]]) -> np.ndarray:
    n = np.array([len(x) for x in lists])
    return np.add.reduceat(table[np.concatenate(lists)], np.cumsum(n) - n, axis=0) / n[:, None]


def _add_rows(shape, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of ``values`` by row number."""
    out = np.zeros(shape, np.float32)
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(rows[order]) != 0)))
    out[rows[order][first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def _sigmoid(x):
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Model:
    """Parameters and the forward pass. ``vocabulary`` maps a word to its row."""

    def __init__(self, vocabulary: dict[str, int], word_start: np.ndarray, stem_start: np.ndarray, seed: int = 7):
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        x, h, a = WORD_DIM + 2 * CHAR_DIM, HIDDEN, ATTENTION
        self.vocabulary = vocabulary
        words = (0.1 * r.standard_normal((len(vocabulary) + 1, WORD_DIM))).astype(np.float32)
        words[:-1, 0], words[-1] = word_start, 0  # the last row stands for unknown words
        stem = (0.1 * r.standard_normal((STEM_BUCKETS, CHAR_DIM))).astype(np.float32)
        stem[:, 0] = stem_start
        self.p = {"words": words, "stems": stem,
                  "chars": (0.1 * r.standard_normal((CHAR_BUCKETS, CHAR_DIM))).astype(np.float32),
                  "Wf": draw(x, 3 * h), "Uf": draw(h, 3 * h), "bf": np.zeros(3 * h, np.float32),
                  "Wb": draw(x, 3 * h), "Ub": draw(h, 3 * h), "bb": np.zeros(3 * h, np.float32),
                  "Wa": draw(2 * h, a), "ba": np.zeros(a, np.float32), "va": draw(a),
                  "wo": draw(2 * h), "bo": np.zeros(1, np.float32)}
        self.shift = np.float32(0)

    def digest(self) -> str:
        return hashlib.sha256(b"".join(v.tobytes() for v in self.p.values())).hexdigest()

    def inputs(self, words: list[str]):
        """Word row, trigram rows, stem rows and joint input vector of every word."""
        unknown = len(self.vocabulary)
        row = np.array([self.vocabulary.get(w, unknown) for w in words])
        grams, begin = [trigrams(w) for w in words], [stems(w) for w in words]
        x = np.concatenate((self.p["words"][row], _mean_rows(self.p["chars"], grams),
                            _mean_rows(self.p["stems"], begin)), axis=1)
        return row, grams, begin, x.astype(np.float32)

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Input side of the gates of both directions, once per distinct word."""
        return x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]

    def read(self, gates: np.ndarray, ids: np.ndarray, mask, u: np.ndarray, order, keep: list | None = None):
        """States (T, B, H) of one direction over ids (T, B) of projected words."""
        h = np.zeros((ids.shape[1], HIDDEN), np.float32)
        states = np.empty((*ids.shape, HIDDEN), np.float32)
        for t in order:
            g, r = gates[ids[t]], h @ u
            zr = _sigmoid(g[:, :2 * HIDDEN] + r[:, :2 * HIDDEN])
            z, rr = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(g[:, 2 * HIDDEN:] + rr * r[:, 2 * HIDDEN:])
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((t, h, z, rr, n, r))
            states[t] = h = new
        return states

    def logits(self, gf, gb, ids: np.ndarray, mask=None, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ids (T, B) into the projections, mask (T, B) of real words."""
        p, steps = self.p, range(ids.shape[0])
        kf, kb = ([], []) if keep is not None else (None, None)
        s = np.concatenate((self.read(gf, ids, mask, p["Uf"], steps, kf),
                            self.read(gb, ids, mask, p["Ub"], reversed(steps), kb)), axis=2)
        u = np.tanh(s @ p["Wa"] + p["ba"])
        e = u @ p["va"]
        if mask is not None:
            e = np.where(mask, e, np.float32(-30))
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        c = np.einsum("tb,tbh->bh", alpha, s)
        if keep is not None:
            keep |= {"f": kf, "b": kb, "s": s, "u": u, "alpha": alpha, "c": c}
        return c @ p["wo"] + p["bo"][0]

    def gradients(self, x, ids, mask, y) -> tuple[dict, np.ndarray, float]:
        """Gradients of the mean cross-entropy by parameter, and by input vector x."""
        p, keep = self.p, {}
        gf, gb = self.project(x)
        out = self.logits(gf, gb, ids, mask, keep)
        prob = _sigmoid(out)
        d = ((prob - y) / len(y)).astype(np.float32)
        loss = float(-np.mean(np.where(y > 0.5, np.log(prob + 1e-7), np.log(1 - prob + 1e-7))))
        s, u, alpha, c = keep["s"], keep["u"], keep["alpha"], keep["c"]
        g = {"wo": c.T @ d, "bo": d.sum(keepdims=True)}
        dc = d[:, None] * p["wo"]
        ds = alpha[:, :, None] * dc
        da = np.einsum("tbh,bh->tb", s, dc)
        de = alpha * (da - (alpha * da).sum(axis=0))
        g["va"] = np.einsum("tba,tb->a", u, de)
        du = de[:, :, None] * p["va"] * (1 - u * u)
        g["Wa"] = np.einsum("tbh,tba->ha", s, du)
        g["ba"] = du.sum(axis=(0, 1))
        ds = ds + du @ p["Wa"].T
        dx = np.zeros_like(x)
        for side, states, name, gates in (("f", ds[:, :, :HIDDEN], "f", gf), ("b", ds[:, :, HIDDEN:], "b", gb)):
            dU, parts = np.zeros_like(p["U" + name]), []
            dh = np.zeros((ids.shape[1], HIDDEN), np.float32)
            for t, h, z, rr, n, r in reversed(keep[side]):
                dh = dh + states[t]
                real = dh if mask is None else np.where(mask[t][:, None], dh, np.float32(0))
                dn = real * (1 - z) * (1 - n * n)
                dz = real * (h - n) * z * (1 - z)
                dr = dn * r[:, 2 * HIDDEN:] * rr * (1 - rr)
                dpre = np.concatenate((dz, dr, dn * rr), axis=1)
                dU += h.T @ dpre
                back = dpre @ p["U" + name].T + real * z
                dh = back if mask is None else np.where(mask[t][:, None], back, dh)
                parts.append((ids[t], np.concatenate((dz, dr, dn), axis=1)))
            dg = _add_rows(gates.shape, np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]))
            g["U" + name], g["W" + name], g["b" + name] = dU, x.T @ dg, dg.sum(axis=0)
            dx += dg @ p["W" + name].T
        return g, dx, loss


def _batches(windows: list[list[str]]):
    """Distinct words, ids (T, B) and mask of a list of windows."""
    distinct = {w: i for i, w in enumerate(dict.fromkeys(w for ws in windows for w in ws))}
    t = max(1, max(map(len, windows)))
    ids, mask = np.zeros((t, len(windows)), np.int64), np.zeros((t, len(windows)), bool)
    for b, ws in enumerate(windows):
        ids[:len(ws), b] = [distinct[w] for w in ws]
        mask[:len(ws), b] = True
    return list(distinct) or [""], ids, mask


def _text_windows(words: list[str]) -> list[list[str]]:
    return [words[i:i + WINDOW] for i in window_starts(len(words))]


def _clean(words: list[str]) -> list[str]:
    return [w.strip(EDGE) for w in words]


def fit(texts: list[str], toxic: list[int], epochs: int = 5, rate: float = 0.01, seed: int = 7,
        max_words: int = 20_000) -> Model | None:
    """Fit on labelled texts; None if a class is missing.

    The first word dimension starts at the smoothed log-odds of the word. Of
    each text the windows with the strongest words are trained first; then all
    windows are scored and the clean ones that score highest are added. A
    toxic text without any telling word or stem teaches nothing (its label may
    be wrong), but counts where the decision point is set.
    """
    if not any(toxic) or all(toxic):
        return None
    rng = np.random.default_rng(seed)
    docs = [_clean(words_of(t)) for t in texts]
    y = np.array(toxic, np.float32)
    n1, n0 = float(y.sum()), float(len(y) - y.sum())

    def odds(c):
        """Log-odds of a class for a word in c[1] toxic and c[0] clean texts, less their deviation."""
        value = np.log((c[1] + 1) / (n1 + 2)) - np.log((c[0] + 1) / (n0 + 2))
        return float(np.sign(value) * max(0.0, abs(value) - np.sqrt(1 / (c[1] + 1) + 1 / (c[0] + 1))))

    seen: dict[str, list[int]] = {}
    begun = np.zeros((STEM_BUCKETS, 2))
    for ws, label in zip(docs, toxic):
        own = set(ws)
        for w in own:
            seen.setdefault(w, [0, 0])[label] += 1
        begun[list({k for w in own for k in stems(w)}), label] += 1
    kept = sorted((w for w, c in seen.items() if sum(c) >= 2 and w), key=lambda w: (-sum(seen[w]), w))[:max_words]
    word_odds = {w: odds(seen[w]) for w in kept}
    stem_odds = np.array([odds(c) if c.any() else 0.0 for c in begun])
    model = Model({w: i for i, w in enumerate(kept)}, np.clip(np.array([word_odds[w] for w in kept]) / 3, -2, 2),
                  np.clip(stem_odds / 3, -2, 2), seed)
    power_of = {w: max(word_odds.get(w, 0.0), stem_odds[stems(w)].max()) for w in seen}
    cut = [_text_windows(ws) for ws in docs]
    strength = [[max((power_of[w] for w in win), default=0.0) for win in wins] for wins in cut]
    sample, labels = [], []
    for wins, power, label in zip(cut, strength, toxic):
        if label and max(power) <= 0.3:
            continue  # no word of it speaks for the label: it teaches no window
        order = np.argsort(-np.array(power), kind="stable")
        chosen = set(order[:1].tolist()) | (set() if label else {int(rng.integers(0, len(wins)))})
        sample += [wins[i] for i in sorted(chosen)]
        labels += [label] * len(chosen)
    if not any(labels):
        return None
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    step = 0

    def train(sample, labels, epochs):
        nonlocal step
        labels = np.array(labels, np.float32)
        weight = len(labels) / max(1.0, 2 * labels.sum())
        ones = np.flatnonzero(labels > 0.5)
        for _ in range(epochs):
            # toxic windows are repeated so that both classes weigh the same
            order = np.concatenate((np.arange(len(labels)), rng.choice(ones, int(max(0, weight * 2 - 2) * len(ones)))))
            rng.shuffle(order)
            for i in range(0, len(order), 128):
                part = order[i:i + 128]
                words, ids, mask = _batches([sample[k] for k in part])
                row, grams, begin, x = model.inputs(words)
                g, dx, _ = model.gradients(x, ids, mask, labels[part])
                big = {"words": _add_rows(model.p["words"].shape, row, dx[:, :WORD_DIM])}
                big["words"][-1] = 0
                for name, lists, at in (("chars", grams, WORD_DIM), ("stems", begin, WORD_DIM + CHAR_DIM)):
                    n = np.array([len(q) for q in lists])
                    big[name] = _add_rows(model.p[name].shape, np.concatenate(lists),
                                          np.repeat(dx[:, at:at + CHAR_DIM] / n[:, None], n, axis=0))
                step += 1
                for k, grad in (g | big).items():
                    m, v = moments[k]
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    model.p[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    train(sample, labels, epochs)
    by_window = score_texts(model, texts, windows=True)
    hard = sorted(((s, d, i) for d, (label, scores) in enumerate(zip(toxic, by_window)) if not label
                   for i, s in enumerate(scores)), reverse=True)[:max(64, len(sample) // 3)]
    train(sample + [cut[d][i] for _, d, i in hard], labels + [0] * len(hard), max(1, epochs // 2))
    top = np.array(score_texts(model, texts))
    # the decision point: between the classes, in the middle of the widest best gap
    order = np.sort(top)
    points = np.concatenate(([order[0] - 1], (order[1:] + order[:-1]) / 2, [order[-1] + 1]))
    gaps = np.concatenate(([0], np.diff(order), [0]))
    clean, bad = np.sort(top[y < 0.5]), np.sort(top[y > 0.5])
    wrong = ((len(clean) - np.searchsorted(clean, points)) / n0 + np.searchsorted(bad, points) / n1)
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    model.shift = np.float32(points[best[np.argmax(gaps[best])]])
    return model


def score_texts(model: Model, texts: list[str], windows: bool = False, batch: int = 1024, limit: int = 120_000) -> list:
    """Highest window logit of each text (or the logits of all its windows).

    The projections of distinct words are kept in the worker process, for this
    model only, and dropped when more than ``limit`` words have been met.
    """
    held = worker_state("toxicity")
    key = model.digest()
    if held.get("toxicity model") != key:
        held |= {"toxicity model": key, "toxicity rows": {}, "toxicity words": {},
                 "toxicity gates": (np.zeros((0, 3 * HIDDEN), np.float32),) * 2}
    chunks = [words_of(t) for t in texts]
    row_of, word_row = held["toxicity rows"], held["toxicity words"]
    distinct = set().union(*chunks) if chunks else set()
    if len(word_row) + len(distinct) > limit or len(row_of) + len(distinct) > 3 * limit:
        row_of, word_row = {}, {}
        held |= {"toxicity rows": row_of, "toxicity words": word_row,
                 "toxicity gates": (np.zeros((0, 3 * HIDDEN), np.float32),) * 2}
    gf, gb = held["toxicity gates"]
    new = []
    for chunk in [*distinct, ""]:
        if chunk not in row_of:
            w = chunk.strip(EDGE)
            if w not in word_row:
                word_row[w] = len(word_row)
                new.append(w)
            row_of[chunk] = word_row[w]
    if new:
        f, b = model.project(model.inputs(new)[-1])
        gf, gb = np.concatenate((gf, f)), np.concatenate((gb, b))
        held["toxicity gates"] = (gf, gb)
    flat = np.array([row_of[w] for ws in chunks for w in ws], np.int64)
    lengths = np.array([len(ws) for ws in chunks], np.int64)
    base = np.cumsum(lengths) - lengths
    starts = [window_starts(n) for n in lengths.tolist()]
    doc = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    at = base[doc] + np.concatenate([np.array(s, np.int64) for s in starts]) if texts else np.zeros(0, np.int64)
    size = np.minimum(lengths[doc], WINDOW)
    out = np.empty(len(doc), np.float32)
    order = np.argsort(size, kind="stable")
    flat = np.concatenate((flat, np.full(WINDOW, row_of[""], np.int64)))
    for i in range(0, len(order), batch):
        part = order[i:i + batch]
        t = max(1, int(size[part].max()))
        steps = np.arange(t)[:, None]
        mask = steps < np.maximum(size[part], 1)
        ids = np.where(steps < size[part], flat[at[part] + np.minimum(steps, np.maximum(size[part] - 1, 0))], row_of[""])
        out[part] = model.logits(gf, gb, ids, None if mask.all() else mask)
    bounds = np.cumsum([len(s) for s in starts])
    if windows:
        return [x.tolist() for x in np.split(out, bounds[:-1])]
    return np.maximum.reduceat(out, bounds - [len(s) for s in starts]).tolist() if texts else []


def training_rows(docs: DataFrame, labels: DataFrame, train_docs: int) -> DataFrame:
    """At most ``train_docs`` rows (doc_id, text, toxic) of each class.

    Only ids whose crc32 leaves a remainder by 5 are used. The ids are chosen
    from the labels alone; the chosen ids are bounded, so they are broadcast
    and no text is shuffled.
    """
    rows = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                         & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("o", F.xxhash64("doc_id")))
    chosen = None
    for label in (0, 1):
        part = rows.where(F.col("toxic") == label).orderBy("o", "doc_id").limit(train_docs).select("doc_id", "toxic")
        chosen = part if chosen is None else chosen.unionByName(part)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit_on_tables(docs: DataFrame, labels: DataFrame, train_docs: int = 1000) -> Model | None:
    """Fit on a bounded sample of the labelled documents (see ``training_rows``)."""
    rows = training_rows(docs, labels, train_docs).toPandas().sort_values(["doc_id", "text"], na_position="first")
    return fit(rows["text"].fillna("").tolist(), rows["toxic"].astype(int).tolist())


def scorer(model: Model | None, block_chars: int = 1_000_000):
    """pandas UDF from texts to scores: the logistic of the highest window
    logit over the decision point. Null text counts as empty (one empty
    window); without a model (no labels of one class) every score is 0."""
    def score(text: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.zeros(len(text)))
        texts, out, start = text.fillna("").tolist(), [], 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= block_chars):
                size += len(texts[end])
                end += 1
            out += score_texts(model, texts[start:end])
            start = end
        z = np.array(out, np.float64) - float(model.shift)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return F.pandas_udf(score, "double")


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score and predicted (1 from a score of 0.5) of every row; repeated
    rows get equal scores, an empty table an empty result."""
    return (docs.select("doc_id", scorer(model)(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_clean(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is below 0.5."""
    return docs.where(scorer(model)(F.col("text")) < 0.5)
