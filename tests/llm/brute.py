"""Plain versions of the operators' rules, for small tables only."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from xxhash import xxh64_intdigest

SPACE = "[\x20\x09-\x0d]"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact(docs: pd.DataFrame) -> pd.DataFrame:
    groups = defaultdict(list)
    for d, t in zip(docs.doc_id, docs.text):
        groups[re.sub(SPACE, "", t or "")].append((-len(t or ""), d))
    rows = []
    for norm, own in groups.items():
        keep = min(own)[1]
        rows += [(d, keep, len(own), d == keep, sha(norm)) for _, d in own]
    return pd.DataFrame(rows, columns=["doc_id", "keep_id", "group_size", "kept", "text_sha256"])


def simhash(text: str | None, k: int = 4) -> int:
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(values: np.ndarray, radius: int) -> np.ndarray:
    """The smallest place of each value's component, by comparing all."""
    distinct, inverse = np.unique(values, return_inverse=True)
    root = np.arange(len(distinct))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(distinct)):
        near = np.flatnonzero(np.bitwise_count(distinct[i + 1:] ^ distinct[i]) <= radius) + i + 1
        for j in near.tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    comp = np.array([find(i) for i in range(len(distinct))])[inverse]
    first = {}
    for at, c in enumerate(comp.tolist()):
        first.setdefault(c, at)
    return np.array([first[c] for c in comp.tolist()])


def near(docs: pd.DataFrame, k: int = 4, radius: int = 4) -> pd.DataFrame:
    docs = docs.sort_values("doc_id").reset_index(drop=True)
    fps = np.array([simhash(t, k) for t in docs.text], np.uint64)
    ids = docs.doc_id.to_numpy()[linked(fps, radius)]
    return pd.DataFrame({"doc_id": docs.doc_id, "fingerprint": [f"{f:016x}" for f in fps.tolist()], "component_id": ids})


def chat(rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    for conv, own in rows.groupby("conv_id"):
        own = own.sort_values("turn")
        said = "".join(t or "" for r, t in zip(own.role, own.text) if r == "assistant")
        lines = "".join(f"{r}\n{t or ''}\n" for r, t in zip(own.role, own.text))
        out.append((conv, len(own), sha(lines), len(said), sha(said)))
    return pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"])


def substring(docs: pd.DataFrame, k: int = 20) -> pd.DataFrame:
    seen, out = set(), []
    for d, t in docs.sort_values("doc_id", kind="stable")[["doc_id", "text"]].itertuples(index=False):
        w = words(t)
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            if key in seen:
                gone[i:i + k] = True
            seen.add(key)
        out.append((d, len(w), int(gone.sum()), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])


def leaks(docs: pd.DataFrame, items: pd.DataFrame, k: int = 5, similarity: float = 0.8) -> set[tuple[int, int]]:
    """(doc_id, item_id) with an item-sized window of at least this similarity."""
    def cut(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def bag(w):
        return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()
    found = set()
    bench = [(i, cut(t)) for i, t in zip(items.item_id, items.text)]
    for d, t in zip(docs.doc_id, docs.text):
        w = cut(t)
        own = bag(w)
        for i, b in bench:
            want = bag(b)
            if not own.keys() & want.keys():
                continue
            for s in range(max(1, len(w) - len(b) + 1)):
                have = bag(w[s:s + len(b)])
                both = sum((have & want).values())
                if both and both / (have.total() + want.total() - both) >= similarity:
                    found.add((d, i))
                    break
    return found


def url(u: str | None) -> tuple[str, str]:
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def judged(u: str | None, rules, default="allow") -> tuple[str | None, str]:
    host, path = url(u)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.host + r.path), default=None)
    return (None, default) if best is None else (best.host + best.path, best.action)


def token_rows(docs: pd.DataFrame, path: str, end_id: int = 2) -> dict[int, np.ndarray]:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return {d: np.array([*tok.encode(t or "", add_special_tokens=False).ids, end_id], "<u4") for d, t in zip(docs.doc_id, docs.text)}


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
