"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters the network twice: as itself (a vector of its own, if the training rows
have it often enough) and as characters (the mean vector of its hashed character
triples, so that unseen spellings have one too).  Windows of ``window`` words overlap by
half; two gated recurrent units read a window forwards and backwards, attention pools
their states into one logit, and a text scores as its highest window does, through a
calibrated logistic curve.  All of a text is scored, however long it is.

Training is numpy on the driver.  Its input is bounded: at most ``toxic_docs`` documents
of label 1 and ``clean_docs`` of label 0, chosen by a hash of their ids among the training folds, and of those the
ones with at most ``train_bytes`` bytes.  A label belongs to a document and not to a
window, so only the highest window of a toxic document is taught as toxic, by the
leaning of its words in the first round and by the network itself from then on.

Scale: scoring is a map over the texts with no shuffle; a task holds the model (a few
MB) and a bounded store of words it has met, unpacks about a megabyte of text at a time
and first lets go of what its worker keeps for other operators.  Only the sampled ids are
broadcast, at most ``toxic_docs + clean_docs`` of them.

Edge cases: null and empty texts are one empty window and get its score; without training
rows of both labels every score is 0; a document labelled twice counts as toxic if one
label says so; repeated rows get equal scores.  Language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesforge.llm.common import SHORT, KeyTable, lean, packed, settled, text_of, utf8

FOLDS = 5
HIDDEN, WORD_DIM, CHAR_DIM = 8, 12, 12
CHAR_BUCKETS = 4096  # vectors that the character triples share
UNKNOWN = 0  # the own vector of words without one
#: Words are runs of letters and digits (any byte over 127 counts as a letter), A-Z lower-cased.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


class Words:
    """The words of texts (UTF-8), one text after the other: their places in the bytes,
    the number of each text, and two longs per word that are its key."""

    def __init__(self, texts: list[bytes]):
        from xxhash import xxh64_intdigest

        self.line = b" " + b" ".join([t.translate(_PLAIN) for t in texts]) + bytes([32] * 16)
        self.data = np.frombuffer(self.line, np.uint8)
        edge = np.flatnonzero(np.diff((self.data != 32).view(np.int8), prepend=0, append=0))
        self.start, self.stop = edge[::2], edge[1::2]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        self.counts = np.diff(np.searchsorted(self.start, ends), prepend=0)
        lens = self.stop - self.start
        self.a, self.b = packed(self.data, self.start, np.minimum(lens, SHORT))
        for i in np.flatnonzero(lens > SHORT).tolist():  # hashes are enough to score by
            self.a[i], self.b[i] = xxh64_intdigest(self.word(i)), xxh64_intdigest(self.word(i), 1)

    def mixed(self) -> np.ndarray:
        """One long per word, equal for equal words."""
        return (self.a ^ (self.b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)

    def word(self, i: int) -> bytes:
        return self.line[self.start[i]:self.stop[i]]

    def triples(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of each character of the chosen words, taken with the one before
        and the one after it, and the number of each word's characters."""
        n = (self.stop - self.start)[chosen]
        at = np.repeat(self.start[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        three = (self.data[at - 1].astype(np.uint64) << np.uint64(16) | self.data[at].astype(np.uint64) << np.uint64(8)
                 | self.data[at + 1])
        return ((three * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % CHAR_BUCKETS, n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _recur(x: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (N, T, H) of one unit over inputs (N, T, 3H); ``keep`` collects what the
    gradient needs.  Gate order: keep, reset, candidate."""
    n, steps, _ = x.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((n, steps, HIDDEN), np.float32)
    gates, own = u[:, :2 * HIDDEN], u[:, 2 * HIDDEN:]
    for t in range(steps):
        zr = _sigmoid(x[:, t, :2 * HIDDEN] + h @ gates)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        q = h @ own
        c = np.tanh(x[:, t, 2 * HIDDEN:] + r * q)
        if keep is not None:
            keep.append((h, z, r, q, c))
        h = c + z * (h - c)
        out[:, t] = h
    return out


def _recur_back(d_out: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    n, steps, _ = d_out.shape
    dx, du = np.empty((n, steps, 3 * HIDDEN), np.float32), np.zeros_like(u)
    dh = np.zeros((n, HIDDEN), np.float32)
    gates, own = u[:, :2 * HIDDEN], u[:, 2 * HIDDEN:]
    for t in reversed(range(steps)):
        h, z, r, q, c = kept[t]
        dh = dh + d_out[:, t]
        dc = dh * (1 - z) * (1 - c * c)
        dzr = np.concatenate([dh * (h - c) * z * (1 - z), dc * q * r * (1 - r)], axis=1)
        dq = dc * r
        dx[:, t, :2 * HIDDEN], dx[:, t, 2 * HIDDEN:] = dzr, dc
        du[:, :2 * HIDDEN] += h.T @ dzr
        du[:, 2 * HIDDEN:] += h.T @ dq
        dh = dh * z + dzr @ gates.T + dq @ own.T
    return dx, du


class Network:
    """Parameters and the two passes.  ``vocabulary`` has the words with a vector of
    their own and its row, from 1."""

    def __init__(self, vocabulary: dict[bytes, int], seed: int = 1):
        rng = np.random.default_rng(seed)

        def init(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {
            "words": init(len(vocabulary) + 1, WORD_DIM, scale=0.1), "chars": init(CHAR_BUCKETS, CHAR_DIM, scale=0.3),
            "in": init(WORD_DIM + CHAR_DIM, 6 * HIDDEN, scale=0.3), "bias": np.zeros(6 * HIDDEN, np.float32),
            "fwd": init(HIDDEN, 3 * HIDDEN, scale=0.3), "bwd": init(HIDDEN, 3 * HIDDEN, scale=0.3),
            "att": init(2 * HIDDEN, HIDDEN, scale=0.3), "att_v": init(HIDDEN, scale=0.3),
            "out": init(2 * HIDDEN, scale=0.3), "out_b": np.zeros(1, np.float32)}
        self.curve = (0.0, 1.0)  # score = sigmoid(a + b * highest logit)

    def inputs(self, ids: np.ndarray, chars: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, projections) of words: rows of their own vectors, buckets of their
        characters one word after the other, and the number of each word's characters."""
        mean = np.add.reduceat(self.p["chars"][chars], np.cumsum(n) - n, axis=0) / n[:, None].astype(np.float32)
        x = np.concatenate([self.p["words"][ids], mean], axis=1)
        return x, x @ self.p["in"] + self.p["bias"]

    def pad_row(self) -> np.ndarray:
        """Keeps the state as it is: the keep gates are open."""
        row = np.zeros(6 * HIDDEN, np.float32)
        row[:HIDDEN] = row[3 * HIDDEN:4 * HIDDEN] = 30
        return row

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """One logit per window from projections (N, T, 6H) and the mask of its words."""
        kept = ([], []) if keep is not None else (None, None)
        a = _recur(x[:, :, :3 * HIDDEN], self.p["fwd"], kept[0])
        b = _recur(x[:, ::-1, 3 * HIDDEN:], self.p["bwd"], kept[1])[:, ::-1]
        states = np.concatenate([a, b], axis=2)
        seen = np.tanh(states @ self.p["att"])
        e = np.where(mask, seen @ self.p["att_v"], np.float32(-1e9))
        e = np.exp(e - e.max(axis=1, keepdims=True))
        alpha = e / e.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", alpha, states)
        if keep is not None:
            keep.update(kept=kept, states=states, seen=seen, alpha=alpha, pooled=pooled)
        return pooled @ self.p["out"] + self.p["out_b"]

    def gradients(self, d: np.ndarray, k: dict) -> tuple[dict, np.ndarray]:
        """For the logits' gradient d: those of the parameters above the words, and of
        the projections."""
        p, states, seen, alpha = self.p, k["states"], k["seen"], k["alpha"]
        g = {"out": k["pooled"].T @ d, "out_b": d.sum(keepdims=True)}
        dpool = d[:, None] * p["out"]
        da = np.einsum("nth,nh->nt", states, dpool)
        de = alpha * (da - (alpha * da).sum(axis=1, keepdims=True))
        g["att_v"] = np.einsum("nt,nth->h", de, seen)
        dseen = de[:, :, None] * p["att_v"] * (1 - seen * seen)
        g["att"] = np.einsum("nti,nth->ih", states, dseen)
        ds = alpha[:, :, None] * dpool[:, None] + dseen @ p["att"].T
        dfx, g["fwd"] = _recur_back(np.ascontiguousarray(ds[:, :, :HIDDEN]), p["fwd"], k["kept"][0])
        dbx, g["bwd"] = _recur_back(np.ascontiguousarray(ds[:, ::-1, HIDDEN:]), p["bwd"], k["kept"][1])
        return g, np.concatenate([dfx, dbx[:, ::-1]], axis=2)


def windows(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(word places (N, window), -1 where a text has ended; the text of each window) for
    texts that stand one after the other."""
    step = window // 2
    counts = np.maximum(-(-(sizes - window) // step), 0) + 1
    doc = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.cumsum(sizes) - sizes
    inside = nth[:, None] * step + np.arange(window)
    return np.where(inside < sizes[doc][:, None], base[doc][:, None] + inside, -1).astype(np.int32), doc


def _leanings(word: np.ndarray, doc: np.ndarray, y: np.ndarray, min_docs: int) -> np.ndarray:
    """How far each word leans to label 1: the log odds ratio of document counts with a
    prior of five documents, in standard errors; 0 below ``min_docs`` documents."""
    size = int(word.max()) + 1 if len(word) else 0
    pairs = np.unique(doc.astype(np.int64) * max(size, 1) + word)
    label, word = y[pairs // max(size, 1)], pairs % max(size, 1)
    toxic, clean = (np.bincount(word[label == v], minlength=size) for v in (1, 0))
    n = np.array([(y == 0).sum(), (y == 1).sum()], np.float64)
    share = 5 * n / n.sum()
    a, b = toxic + share[1], clean + share[0]
    lean = (np.log(a / (n[1] + 2 * share[1] - a)) - np.log(b / (n[0] + 2 * share[0] - b))) / np.sqrt(1 / a + 1 / b)
    return np.where(toxic + clean >= min_docs, lean, 0)


def train(texts: list[bytes], labels: list[int], *, window: int = 32, min_docs: int = 4, least_lean: float = 4.0,
          max_words: int = 20_000, steps: int = 400, batch: int = 128, rate: float = 0.01, doubt: float = 0.7,
          decay: float = 0.03, seed: int = 1, stands_for: tuple[float, float] = (1.0, 1.0)) -> Network | None:
    """A network fitted to whole documents in about ``steps`` steps; None without both
    labels.  ``stands_for``: how many labelled documents one of label 0 and one of label 1
    in ``texts`` stands for, by which the score is calibrated."""
    seen: dict[bytes, int] = {}
    for text, label in zip(texts, labels):  # copies count once
        seen[text] = max(seen.get(text, 0), label)
    texts, y = list(seen), np.array(list(seen.values()), np.float32)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    words = Words(texts)
    _, first, flat = np.unique(words.mixed(), return_index=True, return_inverse=True)
    flat = flat.astype(np.int32)
    lean = _leanings(flat, np.repeat(np.arange(len(texts)), words.counts), y, min_docs)
    names = {w: words.word(first[w]) for w in np.flatnonzero(lean >= least_lean).tolist()}
    chosen = sorted(names, key=lambda w: (-lean[w], names[w]))[:max_words]
    net = Network({names[w]: i + 1 for i, w in enumerate(chosen)}, seed)
    net.p["words"][1:, 0] = np.clip(lean[chosen] / 3, -2, 2)
    ids = np.zeros(len(first), np.int32)
    ids[chosen] = np.arange(1, len(chosen) + 1)
    chars, n_chars = words.triples(first)
    chars = chars.astype(np.int32)
    begin = np.cumsum(n_chars) - n_chars
    places, doc = windows(words.counts, window)
    word = np.where(places >= 0, flat[places] if len(flat) else 0, -1).astype(np.int32)
    del words, flat, places
    fit = rng.random(len(y)) < 0.8  # the others set the curve
    fit[[int(np.flatnonzero(y == v)[0]) for v in (0, 1)]] = True
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, start = 0, {k: net.p[k].copy() for k in ("words", "chars")}

    def scores() -> np.ndarray:
        _, proj = net.inputs(ids, chars, n_chars)
        table = np.concatenate([proj, net.pad_row()[None]])
        return np.concatenate([net.logits(table[word[a:a + 2048]], _mask(word[a:a + 2048])) for a in range(0, len(word), 2048)])

    def learn(rows: np.ndarray, weight: np.ndarray) -> None:
        nonlocal step
        w = word[rows]
        used, local = np.unique(w, return_inverse=True)
        local = local.reshape(w.shape)
        real = used >= 0
        used = np.where(real, used, 0)  # the missing words of a short text; any will do
        n = n_chars[used]
        own_chars = chars[np.repeat(begin[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        own_ids = np.where(rng.random(len(used)) < 0.2, UNKNOWN, ids[used])  # the characters must do at times
        x, proj = net.inputs(own_ids, own_chars, n)
        proj[~real] = net.pad_row()
        keep: dict = {}
        z = net.logits(proj[local], _mask(w), keep)
        p, own_y = _sigmoid(z), y[doc[rows]]
        # A document marked toxic may have no toxic window: what the network firmly takes
        # for clean teaches less (generalised cross entropy).
        d = (p - own_y) * weight * np.where(own_y > 0, p ** np.float32(doubt), 1)
        g, dproj = net.gradients((d / weight.sum()).astype(np.float32), keep)
        dp = np.zeros_like(proj)
        np.add.at(dp, local.reshape(-1), dproj.reshape(-1, 6 * HIDDEN))
        dp[~real] = 0
        dx = dp @ net.p["in"].T
        g["in"], g["bias"] = x.T @ dp, dp.sum(axis=0)
        g["words"], g["chars"] = np.zeros_like(net.p["words"]), np.zeros_like(net.p["chars"])
        np.add.at(g["words"], own_ids, dx[:, :WORD_DIM])
        np.add.at(g["chars"], own_chars, np.repeat(dx[:, WORD_DIM:] / n[:, None], n, axis=0))
        step += 1
        for k, v in g.items():
            m, s = moments[k]
            if k in start:
                v += decay * (net.p[k] - start[k])
            m += 0.1 * (v - m)
            s += 0.001 * (v * v - s)
            net.p[k] -= rate * max(1 - step / steps, 0.02) * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)

    places_of = np.searchsorted(doc, np.arange(len(y) + 1))
    known = np.append(net.p["words"][ids, 0], np.float32(-2))  # the place -1
    turn = 0
    while step < steps:
        rows = []
        # The highest window of a toxic document is the one to teach; of a clean one all are clean.
        z = scores() if turn else known[word].max(axis=1)
        for i in np.flatnonzero(fit).tolist():
            own = np.arange(places_of[i], places_of[i + 1])
            top = own[np.argsort(-z[own], kind="stable")]
            rows.append(top[:1] if y[i] else np.concatenate([top[:1], rng.permutation(top[1:])[:1]]))
        rows = rng.permutation(np.concatenate(rows))
        share = y[doc[rows]].mean()
        weight = np.where(y[doc[rows]] > 0, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).astype(np.float32)
        for a in range(0, len(rows), batch):
            learn(rows[a:a + batch], weight[a:a + batch])
        turn += 1
    z = np.maximum.reduceat(scores(), places_of[:-1]).astype(np.float64)
    rest = ~fit if len(set(y[~fit].tolist())) == 2 else np.ones(len(y), bool)
    net.curve = _curve(z[rest], y[rest].astype(np.float64), np.where(y[rest] > 0, stands_for[1], stands_for[0]))
    return net


def _mask(word: np.ndarray) -> np.ndarray:
    """The words that exist; an empty text keeps its first place, so that the pooling has one."""
    mask = word >= 0
    mask[:, 0] = True
    return mask


def _curve(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of y on z by damped Newton steps, with a weak pull to
    (0, 1)."""
    weight = weight * (len(z) / weight.sum())

    def loss(t: np.ndarray) -> float:
        m = t[0] + t[1] * z
        return float((weight * (np.logaddexp(0, m) - y * m)).sum() + 0.25 * (t[0] ** 2 + (t[1] - 1) ** 2))
    t = np.array([0.0, 1.0])
    for _ in range(50):
        p = _sigmoid(t[0] + t[1] * z)
        w, e = weight * p * (1 - p), weight * (p - y)
        g = np.array([e.sum() + 0.5 * t[0], (e * z).sum() + 0.5 * (t[1] - 1)])
        h = np.array([[w.sum() + 0.5, (w * z).sum()], [(w * z).sum(), (w * z * z).sum() + 0.5]])
        step, now = np.linalg.solve(h, g), loss(t)
        while loss(t - step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        t = t - step
    return float(t[0]), max(float(t[1]), 1e-3)


class Scorer:
    """Scores texts; keeps the projections of words already met, up to ``max_words``."""

    def __init__(self, net: Network, window: int = 32, max_words: int = 250_000):
        self.net, self.window, self.max_words = net, window, max_words
        known = Words(list(net.vocabulary))
        self.own = KeyTable(len(known.a))
        self.own.put(known.a, known.b, np.fromiter(net.vocabulary.values(), np.int64, len(known.a)))
        self._empty()

    def _empty(self) -> None:
        self.rows = KeyTable(self.max_words)
        # Zeroed pages take memory as they are written; a table that is made anew and copied takes it twice.
        self.table = np.zeros((self.max_words + (1 << 16), 6 * HIDDEN), np.float32)
        self.table[0] = self.net.pad_row()
        self.size = 1

    def _rows_of(self, words: Words) -> np.ndarray:
        rows = self.rows.find(words.a, words.b)
        miss = np.flatnonzero(rows == 0)
        if len(miss):
            _, first = np.unique(words.mixed()[miss], return_index=True)
            new = miss[first]
            while len(self.table) < self.size + len(new):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            for at in range(0, len(new), 1 << 13):
                part = new[at:at + (1 << 13)]
                ids = self.own.find(words.a[part], words.b[part])
                self.table[self.size + at:self.size + at + len(part)] = self.net.inputs(ids, *words.triples(part))[1]
            self.rows.put(words.a[new], words.b[new], np.arange(self.size, self.size + len(new)))
            self.size += len(new)
            rows[miss] = self.rows.find(words.a[miss], words.b[miss])
        return rows

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.size > self.max_words:
            self._empty()
        words = Words(texts)
        rows = np.append(self._rows_of(words), 0)  # the place -1 is padding
        best = np.full(len(texts), -np.inf)
        a, b = self.net.curve
        places, doc = windows(words.counts, self.window)
        for at in range(0, len(places), 2048):
            own = places[at:at + 2048]
            z = self.net.logits(self.table[rows[own]], _mask(own))
            np.maximum.at(best, doc[at:at + 2048], z)
        return _sigmoid(a + b * best)


def sample(docs: DataFrame, labels: DataFrame, *, toxic_docs: int, clean_docs: int, train_bytes: int, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "toxic") -> tuple[list[bytes], list[int], tuple[float, float]]:
    """Training texts and labels, in an order that does not depend on the cluster, and
    how many labelled documents of either label one of them stands for.  Documents of up
    to ``train_bytes`` come first; where a label has too few of them, longer ones fill the
    sample with excerpts, so that a table of long documents is learned from as well."""
    own = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    own = own.where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    fits = settled(rows.select("id", (F.octet_length("text") > train_bytes).alias("long")).join(own, "id")
                   .groupBy("id").agg(F.min("long").alias("long"), F.max("y").alias("y")))
    order = F.xxhash64(F.col("id"), F.lit(5))
    picked = [fits.where(F.col("y") == v).orderBy("long", order, "id").limit(n) for v, n in ((0, clean_docs), (1, toxic_docs))]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most toxic_docs + clean_docs rows
    rows = rows.join(ids, "id").where((F.octet_length("text") > train_bytes) == F.col("long"))
    rows = rows.groupBy("id").agg(F.min(F.when(F.col("long"), excerpts(F.col("text"), train_bytes)).otherwise(F.col("text"))).alias("text"), F.max("y").alias("y"))
    found = sorted(rows.collect(), key=lambda r: r["id"])
    counts = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}  # two rows
    drawn = [r["y"] for r in found]
    stands_for = tuple(counts.get(v, 0) / max(drawn.count(v), 1) for v in (0, 1))
    return [r["text"].encode() for r in found], drawn, stands_for


def excerpts(text: Column, upto: int, n: int = 4) -> Column:
    """``n`` evenly spread parts of a long text, together about ``upto`` characters."""
    size, total = upto // n, F.char_length(text)
    return F.concat_ws(" ", *[F.substr(text, F.floor((total - size) * (i / (n - 1))).cast("int") + 1, F.lit(size)) for i in range(n)])


def scorer(docs: DataFrame, labels: DataFrame, *, toxic_docs: int = 1500, clean_docs: int = 3000, train_bytes: int = 8_192, window: int = 32,
           id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """Train on the labelled rows of ``docs``; a function from a text column to its score."""
    texts, marks, stands_for = sample(docs, labels, toxic_docs=toxic_docs, clean_docs=clean_docs, train_bytes=train_bytes, id_col=id_col,
                                      text_col=text_col, label_col=label_col)
    net = train(texts, marks, window=window, stands_for=stands_for)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lean(forget=True)  # other operators' stores, which this one has no use for
        own = Scorer(shared.value, window) if shared.value else None
        for batch in batches:
            out, at = np.zeros(len(batch)), 0
            sizes = pc.binary_length(batch).to_numpy(zero_copy_only=False)
            while own and at < len(batch):  # about a megabyte of text is unpacked at a time
                stop, room = at, 1 << 20
                while stop < len(batch) and (stop == at or room >= sizes[stop]):
                    room -= sizes[stop]
                    stop += 1
                out[at:stop] = own.scores(utf8(batch.slice(at, stop - at)))
                at = stop
            yield pa.array(out)
        own = None
        lean()

    return scored


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, score), one row per row of ``docs``."""
    scored = scorer(docs, labels, id_col=id_col, text_col=text_col, **options)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), scored(text_of(text_col)).alias("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    scored = scorer(docs, labels, text_col=text_col, **options)
    return docs.where(scored(text_of(text_col)) < threshold)
