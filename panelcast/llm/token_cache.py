"""Token ids through a per-process cache of text chunks.

A public tokenizer splits a text at white space before its merges run, so a
text's ids are the ids of its white-space chunks in a row. Chunks repeat
(natural text follows Zipf's law); each worker process keeps the ids of the
chunks it met and asks the ``tokenizers`` library for new ones only. The cache
is emptied when it holds ``limit`` chunks, so its memory is bounded.
"""

from __future__ import annotations

import os
import re

import numpy as np

from panelcast.llm.common import worker_state

_CHUNKS = re.compile(r"\s*\S+|\s+")
# Control characters that Python calls white space and the tokenizers do not:
# texts with them go to the library whole.
_ODD = re.compile("[\x1c-\x1f]")
# Letters whose lower case and normal form are the same everywhere.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[{_LETTERS}0-9!-&(-/:;=?@\[-`{{}}~]+")
_PIECES = re.compile(rf"[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


def load_tokenizer(path: str):
    """The tokenizer of a file, loaded once per process; no threads of its own."""
    held = worker_state("tokens")
    if f"tokenizer {path}" not in held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        held[f"tokenizer {path}"] = Tokenizer.from_file(path)
    return held[f"tokenizer {path}"]


def _cache(kind: str, path: str, limit: int, coming: int) -> dict:
    c = worker_state("tokens").setdefault(f"{kind} {path}", {})
    if len(c) + coming > limit:
        c.clear()
    return c


def _ids_of_separate(tok, chunks: list[str]) -> list[bytes]:
    """Ids (little-endian uint32) of chunks free of white space. They are
    encoded many at a time, joined by a space that this tokenizer drops."""
    out = []
    for i in range(0, len(chunks), 256):
        part = chunks[i:i + 256]
        e = tok.encode(" ".join(part), add_special_tokens=False)
        ids = np.array(e.ids, dtype="<u4").tobytes()
        ends = np.searchsorted(np.array([o[0] for o in e.offsets]), np.cumsum([len(p) + 1 for p in part])).tolist()
        start = 0
        for end in ends:
            out.append(ids[4 * start:4 * end])
            start = end
    return out


def _known(kind: str, path: str, wanted, limit: int, make) -> dict:
    """A cache that holds ids of all ``wanted``; ``make`` gives those of a list of new entries.

    Two generations of at most ``limit`` bytes (or what one call wants): when
    the younger one is full it becomes the older one, and what is asked for
    again moves over, so frequent entries stay.
    """
    state = worker_state("tokens").setdefault(f"{kind} {path}", {"young": {}, "old": {}, "bytes": 0})
    if state["bytes"] > limit:
        state.update(young={}, old=state["young"], bytes=0)
    young, old = state["young"], state["old"]
    missing = [w for w in wanted if w not in young]
    new = [w for w in missing if w not in old]
    young.update({w: old[w] for w in missing if w in old})
    young.update(zip(new, make(new)))
    state["bytes"] += 200 * len(missing) + sum(map(len, missing))
    return young


def _byte_letters(path: str) -> dict[int, str]:
    """The signs by which the byte-level step of a tokenizer writes the letters beyond ASCII."""
    held = worker_state("tokens")
    if f"letters {path}" not in held:
        from tokenizers.pre_tokenizers import ByteLevel
        step = ByteLevel(add_prefix_space=False, use_regex=False)
        held[f"letters {path}"] = {c: step.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
    return held[f"letters {path}"]


def _ids_of_pieces(tok, pieces: list[str], letters: dict[int, str]) -> list[bytes]:
    """Ids of plain pieces. They are in normal form and lower case and hold no
    further cut, so only the merges are left to the library's model."""
    model = tok.model
    found = [[t.id for t in model.tokenize(p if p.isascii() else p.translate(letters))] for p in pieces]
    ids = np.array([i for f in found for i in f], dtype="<u4").tobytes()
    ends = np.cumsum([4 * len(f) for f in found]).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


def word_ids(texts: list[str], path: str, limit: int = 48_000_000) -> list[bytes]:
    """Ids of each text under a tokenizer that drops white space and lower-cases.

    A chunk of plain letters, digits and signs is cut further into the pieces
    at which the tokenizer cuts, lower-cased, so ``Word``, ``word,`` and
    ``word`` share one cached piece.
    """
    tok = load_tokenizer(path)
    rows = [None if _ODD.search(t) else t.split() for t in texts]

    def chunks(new):
        cut = [_PIECES.findall(w.lower()) if _PLAIN.fullmatch(w) else None for w in new]
        pieces = _known("piece", path, {p for ps in cut if ps for p in ps}, limit,
                        lambda some: _ids_of_pieces(tok, some, _byte_letters(path)))
        other = iter(_ids_of_separate(tok, [w for w, ps in zip(new, cut) if ps is None]))
        return [next(other) if ps is None else pieces[ps[0]] if len(ps) == 1 else b"".join([pieces[p] for p in ps])
                for ps in cut]

    cache = _known("word", path, set().union(*[r for r in rows if r]), limit, chunks)
    return [b"".join([cache[w] for w in r]) if r is not None else
            np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
            for r, t in zip(rows, texts)]


def byte_counts(texts: list[str], path: str, limit: int = 1_000_000) -> list[int]:
    """Number of ids of each text under a byte-level tokenizer whose splitting
    pattern keeps at most one leading white-space character with a word."""
    tok = load_tokenizer(path)
    rows = [None if _ODD.search(t) else _CHUNKS.findall(t) for t in texts]
    wanted = set()
    for r in rows:
        if r is not None:
            wanted.update(r)
    cache = _cache("count", path, limit, len(wanted))
    new = [w for w in wanted if w not in cache]
    for i in range(0, len(new), 4096):
        part = new[i:i + 4096]
        cache.update(zip(part, [len(e.ids) for e in tok.encode_batch(part, add_special_tokens=False)]))
    return [sum([cache[w] for w in r]) if r is not None else len(tok.encode(t, add_special_tokens=False).ids)
            for r, t in zip(rows, texts)]


def in_blocks(texts: list[str], max_chars: int = 2_000_000):
    """Slices of a batch of at most ``max_chars`` characters (or one text)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > max_chars:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))
