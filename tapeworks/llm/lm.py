"""Language-model scores: a causal self-attention model, trained in numpy on subword ids.

Words are cut into byte-level BPE ids of a public tokenizer, each word with its leading space, so ids give
the words back. Every id is a symbol of the model: the most frequent ones each their own, the others in
``TAIL`` ranges of similar bytes that hold equal shares of the corpus; within a range an id goes by its
count. The output has two steps (class, then member) and for ranges a third. The model reads windows of
``CONTEXT`` symbols that advance by ``STRIDE``: each token is scored once, by the last positions of one
window, with masked attention of ``HEADS`` heads over batches of windows. Positions enter as a learned
bias per head and distance. A text's score is the sum over its ids, its end included.

Corpus statistics (word counts N, V, c; subword counts) and weights come from all training documents. A bounded
number of windows gives the weights that training starts from; every window of the corpus then trains them, once,
in groups whose weights are averaged by windows, in up to ``ROUNDS`` rounds. Windows are dealt to groups and ordered by a hash of
document and position, so neither weights nor scores depend on how files or partitions are cut.
"""

from __future__ import annotations

import base64
import math
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import discard, stage
from tapeworks.llm.tokenstore import vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
CLASSES, MEMBERS, TAIL = 32, 32, 128
SLOTS = CLASSES * MEMBERS
#: Symbols: the slots, of which RARE stands for all ranges in the output, START, and the ranges.
RARE, END, START, RANGE = 0, 1, SLOTS, SLOTS + 1
SYMBOLS = RANGE + TAIL
DIM, HEADS, HIDDEN, CONTEXT, STRIDE = 24, 2, 48, 48, 32
WIDTH = DIM // HEADS
#: Where training starts from: windows at most, steps, windows a step, learning rate.
SAMPLE_WINDOWS, STEPS, BATCH, RATE, SEED = 24_000, 1_500, 64, 1e-2, 3
#: The pass over all windows of the training documents: learning rate, windows in a group, rounds between which the groups' weights are averaged.
PASS_RATE, GROUP_WINDOWS, ROUNDS = 2e-3, 16_384, 4
#: Frequent words whose counts travel to every worker (bounded); the other words' counts are joined, with the same result.
HEAD_WORDS = 250_000
COUNTER_WORDS, CACHE_WORDS = 400_000, 500_000
LOG10 = math.log(10.0)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2: never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


class SpacedEncoder(dict):
    """word -> bytes of the ids (unsigned 16 bits) of a space and the word."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[word] = self.cut(word)
        return out

    def cut(self, word: bytes) -> bytes:
        ids = self.encoding.encode_ordinary(" " + word.decode("utf-8", "replace"))
        return struct.pack(f"<{len(ids)}H", *ids)

    def bytes_of(self, i: int) -> bytes:
        return self.bytes.get(i, b"")


_encoders: dict[str, SpacedEncoder] = {}


def spaced(path: str) -> SpacedEncoder:
    if path not in _encoders:
        _encoders[path] = SpacedEncoder(path)
    return _encoders[path]


# ---- the model


def init(rng: np.random.Generator, class_prior: np.ndarray, member_prior: np.ndarray, range_prior: np.ndarray) -> dict[str, np.ndarray]:
    d, n = DIM, lambda *s: rng.standard_normal(s).astype(np.float32)
    return {
        "E": n(SYMBOLS, d) * 0.3, "R": np.zeros((HEADS, CONTEXT), np.float32), "Wq": n(d, d) / math.sqrt(d), "Wk": n(d, d) / math.sqrt(d), "Wv": n(d, d) / math.sqrt(d), "Wo": n(d, d) * 0.1,
        "W1": n(d, HIDDEN) / math.sqrt(d), "b1": np.zeros(HIDDEN, np.float32), "W2": n(HIDDEN, d) * 0.1,
        "Wc": n(d, CLASSES) * 0.1, "bc": class_prior.astype(np.float32), "Wm": n(CLASSES, d, MEMBERS) * 0.1, "bm": member_prior.astype(np.float32),
        "Wt": n(d, TAIL) * 0.1, "bt": range_prior.astype(np.float32),
    }


#: How far behind a scored position a position of the window lies; below 0: ahead of it.
BEHIND = np.arange(CONTEXT - STRIDE, CONTEXT)[:, None] - np.arange(CONTEXT)[None, :]
MASK = np.where(BEHIND < 0, -1e9, 0.0).astype(np.float32)


def bias(w: dict[str, np.ndarray]) -> np.ndarray:
    """What is added to attention logits, (HEADS, STRIDE, CONTEXT): a value for each distance, the mask ahead."""
    return w["R"][:, np.maximum(BEHIND, 0)] + MASK


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    x -= np.log(np.exp(x).sum(-1, keepdims=True))
    return x


def outputs(w: dict[str, np.ndarray]) -> np.ndarray:
    """For each class the weights of both output steps side by side, biases as the last row: (CLASSES, DIM + 1, CLASSES + MEMBERS)."""
    out = np.empty((CLASSES, DIM + 1, CLASSES + MEMBERS), w["Wm"].dtype)
    out[:, :DIM, :CLASSES], out[:, DIM, :CLASSES] = w["Wc"], w["bc"]
    out[:, :DIM, CLASSES:], out[:, DIM, CLASSES:] = w["Wm"], w["bm"]
    return out


def _exp_totals(logits: np.ndarray) -> np.ndarray | None:
    """Turns logits (n, CLASSES + MEMBERS) into their exp, in place; the sums over each step, (n, 2), or None where they left the safe range."""
    with np.errstate(over="ignore"):
        np.exp(logits, out=logits)
        totals = logits.reshape(-1, MEMBERS) @ np.ones(MEMBERS, logits.dtype)  # there are as many members as classes
    return totals.reshape(-1, 2) if 1e-30 < totals.min(initial=1) and totals.max(initial=1) < 1e30 else None


def _less_maximum(logits: np.ndarray) -> np.ndarray:
    """Takes the maximum of each step off, in place."""
    two = logits.reshape(len(logits), 2, MEMBERS)
    two -= two.max(-1, keepdims=True)
    return logits


def folded(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Tables for scoring: what a symbol gives to states and queries, and to keys and values; whether logits stay small."""
    heads = lambda x: x.reshape(len(x), HEADS, -1)
    q, k, v = heads(w["E"] @ w["Wq"]) * np.float32(1 / math.sqrt(WIDTH)), heads(w["E"] @ w["Wk"]), heads(w["E"] @ w["Wv"])
    ones = np.ones((SYMBOLS, HEADS, 1), np.float32)  # attention weights and their sum come from one product
    each = lambda x: np.ascontiguousarray(x.transpose(1, 0, 2))
    out = {"x": w["E"], "q": each(q), "k": each(k), "v": each(np.concatenate([v, ones], 2)), "bias": bias(w), "outer": outputs(w)}
    out |= {k: w[k] for k in ("Wo", "W1", "b1", "W2", "Wt", "bt")}
    reach = max(float(np.abs(q[:, h]).max(0) @ np.abs(k[:, h]).max(0)) for h in range(HEADS)) + float(np.abs(w["R"]).max())
    return out | {"tame": np.array(reach < 80)}


def states(t: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Hidden states of the last STRIDE positions, (batch * STRIDE, DIM), from ``folded`` tables."""
    own = ids[:, -STRIDE:]
    z, width = np.empty((len(ids), STRIDE, DIM), np.float32), WIDTH
    for i in range(HEADS):
        a = t["q"][i].take(own, 0) @ t["k"][i].take(ids, 0).transpose(0, 2, 1)
        a += t["bias"][i]
        if not t["tame"]:
            a -= a.max(-1, keepdims=True)
        np.exp(a, out=a)
        y = a @ t["v"][i].take(ids, 0)
        np.divide(y[:, :, :width], y[:, :, width:], out=z[:, :, i * width : (i + 1) * width])
    h = z.reshape(-1, DIM) @ t["Wo"]
    h += t["x"].take(own.ravel(), 0)
    u = h @ t["W1"]
    u += t["b1"]
    np.maximum(u, 0, out=u)
    h += u @ t["W2"]
    return h


#: Windows whose states, and windows whose outputs are worked out at once, and rows of logits at once: their arrays stay in a core's cache.
AT_ONCE, SORTED, ROWS = 64, 512, 512


def log_probs(t: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probabilities of the symbols ``targets`` (batch, STRIDE), from ``folded`` tables."""
    ids, out = ids.astype(np.intp, copy=False), np.empty(targets.shape, np.float32)
    logits = np.empty((ROWS, CLASSES + MEMBERS), np.float32)
    at_member = np.arange(ROWS) * (CLASSES + MEMBERS) + CLASSES
    for begin in range(0, len(ids), SORTED):
        block, want = ids[begin : begin + SORTED], targets[begin : begin + SORTED].ravel()
        slot = np.where(want > START, RARE, want).astype(np.int16)
        order = slot.argsort(kind="stable")  # a class is one product
        slot = slot.take(order)
        f = np.ones((len(want), DIM + 1), np.float32)
        for lo in range(0, len(block), AT_ONCE):
            f[lo * STRIDE : (lo + AT_ONCE) * STRIDE, :DIM] = states(t, block[lo : lo + AT_ONCE])
        by_class = f.take(order, 0)
        said, totals = np.zeros(len(want), np.float32), np.ones((len(want), 2), np.float32)
        cuts = np.searchsorted(slot, np.arange(CLASSES + 1) * MEMBERS).tolist()
        for c in range(CLASSES):
            for lo in range(cuts[c], cuts[c + 1], ROWS):
                hi = min(lo + ROWS, cuts[c + 1])
                x, total, member = logits[: hi - lo], None, at_member[: hi - lo] + (slot[lo:hi] - c * MEMBERS)
                for safe in (False, True):
                    if total is None:
                        np.matmul(by_class[lo:hi], t["outer"][c], out=x)
                        if safe:
                            _less_maximum(x)
                        np.add(x[:, c], x.ravel().take(member), out=said[lo:hi])
                        total = _exp_totals(x)
                totals[lo:hi] = total
        got = np.empty_like(said)
        got[order] = said - np.log(totals).sum(1)
        at = np.flatnonzero(want > START)
        got[at] += _log_softmax(f[at, :DIM] @ t["Wt"] + t["bt"])[np.arange(len(at)), want[at] - RANGE]
        out[begin : begin + SORTED] = got.reshape(-1, STRIDE)
    return out


def _cross_entropy(x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of column ``own`` of each row of logits, and its gradient with the sign turned; ``x`` is overwritten."""
    at = np.arange(len(x))
    x -= x.max(-1, keepdims=True)
    said = x[at, own]
    np.exp(x, out=x)
    total = x.sum(-1)
    x /= total[:, None]
    x[at, own] -= 1
    return said - np.log(total), x


def gradients(w: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss (nats a token) and its gradient over windows ``ids`` (batch, CONTEXT); targets below 0 do not count.

    Attention weights stay undivided, their sums beside the values; tokens stand sorted by class, so that each
    class is one product for both steps of the output, biases included.
    """
    batch, real = len(ids), w["E"].dtype
    one, scale = (lambda n: np.ones(n, real)), real.type(1 / math.sqrt(WIDTH))
    heads = lambda x, n: x.reshape(batch, -1, HEADS, n).transpose(0, 2, 1, 3)
    # a key, a value and a place for 1 of each head, side by side
    inner = np.zeros((DIM, HEADS, 2 * WIDTH + 1), real)
    inner[:, :, :WIDTH], inner[:, :, WIDTH:-1] = w["Wk"].reshape(DIM, HEADS, WIDTH), w["Wv"].reshape(DIM, HEADS, WIDTH)
    inner = inner.reshape(DIM, -1)
    flat_ids = ids.ravel()
    x = w["E"].take(flat_ids, 0)
    xq = x.reshape(batch, CONTEXT, DIM)[:, -STRIDE:].reshape(-1, DIM)
    q, kv = heads(xq @ w["Wq"] * scale, WIDTH), heads(x @ inner, 2 * WIDTH + 1)
    kv[..., -1] = 1
    k, v = kv[..., :WIDTH], kv[..., WIDTH:]
    a = q @ k.transpose(0, 1, 3, 2)
    a += bias(w)
    np.exp(np.minimum(a, 30.0, out=a), out=a)
    y = a @ v
    y, sums = y[..., :WIDTH] / y[..., WIDTH:], y[..., WIDTH:]
    z = y.transpose(0, 2, 1, 3).reshape(-1, DIM)
    h = z @ w["Wo"]
    h += xq
    r = h @ w["W1"]
    r += w["b1"]
    np.maximum(r, 0, out=r)

    t = targets.ravel()
    slot = np.where(t > START, RARE, np.maximum(t, 0)).astype(np.int16)
    order = slot.argsort(kind="stable")
    slot, t = slot.take(order), t.take(order)
    cls, used = slot >> (MEMBERS.bit_length() - 1), (t >= 0).astype(real)
    n = real.type(max(used.sum(), 1))
    f = np.ones((len(t), DIM + 1), real)
    np.add(h, r @ w["W2"], out=f[:, :DIM])
    f = f.take(order, 0)
    outer = outputs(w)
    back, g_outer = np.ascontiguousarray(outer[:, :DIM].transpose(0, 2, 1)), np.zeros_like(outer)
    logits, df = np.empty((len(t), CLASSES + MEMBERS), real), np.empty((len(t), DIM), real)
    cuts = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
    spans = [(c, slice(lo, hi)) for c, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)) if lo < hi]
    own_class = np.arange(len(t)) * (CLASSES + MEMBERS) + cls
    own_member = own_class + (CLASSES - cls + slot - cls * MEMBERS)
    flat, total = logits.ravel(), None
    for safe in (False, True):
        if total is None:
            for c, at in spans:
                np.matmul(f[at], outer[c], out=logits[at])
            if safe:
                _less_maximum(logits)
            said = flat.take(own_class) + flat.take(own_member)
            total = _exp_totals(logits)
    loss = -float(((said - np.log(total).sum(1)) * used).sum())
    used /= n
    each = logits.reshape(-1, MEMBERS)
    each *= (used[:, None] / total).reshape(-1, 1)
    flat[own_class] -= used
    flat[own_member] -= used
    for c, at in spans:
        np.matmul(logits[at], back[c], out=df[at])
        np.matmul(f[at].T, logits[at], out=g_outer[c])
    of_class, of_member = g_outer[:, :, :CLASSES].sum(0), g_outer[:, :, CLASSES:]
    g = {"Wc": of_class[:DIM], "bc": of_class[DIM], "Wm": of_member[:, :DIM], "bm": of_member[:, DIM]}
    at = np.flatnonzero(t > START)
    rare = f[at, :DIM]
    said, dt = _cross_entropy(rare @ w["Wt"] + w["bt"], t[at] - RANGE)
    loss -= float(said.sum())
    dt /= n
    g["Wt"], g["bt"] = rare.T @ dt, dt.sum(0)
    df[at] += dt @ w["Wt"].T
    unsorted = np.empty_like(df)
    unsorted[order] = df
    df = unsorted

    du = df @ w["W2"].T
    du *= r > 0
    dh = df + du @ w["W1"].T
    g["W2"], g["W1"], g["b1"], g["Wo"] = r.T @ df, h.T @ du, one(len(du)) @ du, z.T @ dh
    dz = np.empty((batch, HEADS, STRIDE, WIDTH + 1), real)
    np.divide(heads(dh @ w["Wo"].T, WIDTH), sums, out=dz[..., :WIDTH])
    dz[..., WIDTH] = -np.einsum("bhsw,bhsw->bhs", dz[..., :WIDTH], y)
    ds = dz @ v.transpose(0, 1, 3, 2)
    ds *= a
    g["R"] = np.stack([np.bincount(BEHIND[BEHIND >= 0], s[BEHIND >= 0], CONTEXT) for s in ds.sum(0)]).astype(real)
    dq, dkv = np.empty((batch, STRIDE, HEADS, WIDTH), real), np.zeros((batch, CONTEXT, HEADS, 2 * WIDTH + 1), real)
    dk, dv = (dkv[..., own].transpose(0, 2, 1, 3) for own in (slice(WIDTH), slice(WIDTH, -1)))
    np.matmul(ds, k, out=dq.transpose(0, 2, 1, 3))
    np.matmul(ds.transpose(0, 1, 3, 2), q, out=dk)
    np.matmul(a.transpose(0, 1, 3, 2), dz[..., :WIDTH], out=dv)
    dq, dkv = dq.reshape(-1, DIM), dkv.reshape(len(x), -1)
    dq *= scale
    g_inner = (x.T @ dkv).reshape(DIM, HEADS, 2 * WIDTH + 1)
    g["Wq"], g["Wk"], g["Wv"] = xq.T @ dq, g_inner[:, :, :WIDTH].reshape(DIM, DIM), g_inner[:, :, WIDTH:-1].reshape(DIM, DIM)
    dx = dkv @ inner.T
    dh += dq @ w["Wq"].T
    dx.reshape(batch, CONTEXT, DIM)[:, -STRIDE:] += dh.reshape(batch, STRIDE, DIM)
    # rows of equal symbols are neighbours, so one sum by runs adds them up
    order = flat_ids.astype(np.int16).argsort(kind="stable")
    sorted_ids = flat_ids.take(order)
    first = np.flatnonzero(np.r_[True, sorted_ids[1:] != sorted_ids[:-1]])
    g["E"] = np.zeros_like(w["E"])
    g["E"][sorted_ids[first]] = np.add.reduceat(dx.take(order, 0), first, axis=0)
    return loss / float(n), g


class Adam:
    """``w`` starts as a copy of the weights given and changes with each step; ``flat`` is all of it, by sorted names."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.names, self.at = sorted(weights), 0
        self.flat = np.concatenate([weights[k].ravel() for k in self.names])
        self.w = unflat(self.flat, weights)
        self.m, self.v, self.a, self.b = (np.zeros_like(self.flat) for _ in range(4))

    def step(self, rows: np.ndarray, lr: float) -> float:
        loss, g = gradients(self.w, rows[:, :CONTEXT].astype(np.int64), rows[:, CONTEXT:].astype(np.int64))
        m, v, a, b = self.m, self.v, self.a, self.b
        self.at += 1
        np.concatenate([g[k].ravel() for k in self.names], out=a)
        np.multiply(a, 0.1, out=b)
        m *= 0.9
        m += b
        a *= a
        a *= 0.01
        v *= 0.99
        v += a
        np.divide(v, 1 - 0.99**self.at, out=a)
        np.sqrt(a, out=a)
        a += 1e-8
        np.divide(m, a, out=b)
        b *= lr / (1 - 0.9**self.at)
        self.flat -= b
        return loss


def unflat(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Views of ``flat`` in the shapes of ``like``, by sorted names."""
    cuts = np.cumsum([like[k].size for k in sorted(like)])[:-1]
    return {k: x.reshape(like[k].shape) for k, x in zip(sorted(like), np.split(flat, cuts), strict=True)}


def keep_memory() -> None:
    """After one large block is freed, malloc keeps freed arrays of a few hundred KB instead of mapping each anew."""
    np.empty(31 << 20, np.uint8)


def train(windows: np.ndarray, weights: dict[str, np.ndarray], *, steps: int = STEPS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on ``windows`` (n, CONTEXT + STRIDE): inputs, then targets (-1: none), from ``weights``."""
    rng, adam = np.random.default_rng(seed), Adam(weights)
    if not len(windows):
        return adam.w
    keep_memory()
    for step in range(1, steps + 1):
        adam.step(windows[rng.integers(0, len(windows), BATCH)], RATE * min(1.0, step / 20) * (1 - 0.95 * step / steps))
    return adam.w


# ---- windows


def windows_of(slots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, CONTEXT), targets (n, STRIDE; -1 behind a text's end) and the texts' first windows.

    ``slots`` holds each text's slots with END. Before its first token a text sees START only.
    """
    counts = np.array([-(-len(s) // STRIDE) for s in slots])
    first = np.concatenate([[0], np.cumsum(counts)])
    stream, begins = [], []
    at = 0
    for s, n in zip(slots, counts, strict=True):
        padded = np.full(CONTEXT + n * STRIDE, START, np.int64)
        padded[CONTEXT : CONTEXT + len(s)] = s
        stream.append(padded)
        begins.append(at + STRIDE - 1 + STRIDE * np.arange(n))
        at += len(padded)
    flat = np.concatenate([*stream, np.full(CONTEXT, START)])
    begins = np.concatenate(begins)
    inputs = flat[begins[:, None] + np.arange(CONTEXT)]
    targets = flat[begins[:, None] + (CONTEXT - STRIDE + 1) + np.arange(STRIDE)]
    return inputs, np.where(targets == START, -1, targets), first


@dataclass
class LanguageModel:
    path: str
    tables: dict[str, np.ndarray]
    symbol_of: np.ndarray  # id -> symbol
    within_log: np.ndarray  # id -> log probability within its symbol
    train_tokens: int
    distinct: int
    head: dict[bytes, float]  # frequent word -> log10(count + 1)
    end_log: float  # log10(count + 1) of the end token

    @property
    def floor(self) -> float:
        """log10(N + V + 1), with N all and V the distinct tokens."""
        return math.log10(self.train_tokens + self.distinct + 1)


class Words(dict):
    """word -> its ids as bytes, and log10(count + 1) where it is a frequent one, else nan."""

    def __init__(self, model: LanguageModel):
        self.encode, self.head = spaced(model.path), model.head

    def __missing__(self, word: bytes) -> tuple[bytes, float]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[word] = self.encode.cut(word), self.head.get(word, math.nan)
        return out


#: Windows of a text that are in memory at once.
TEXT_WINDOWS = 4_096


def score_ids(model: LanguageModel, texts: list[np.ndarray]) -> list[float]:
    """Natural log probability of each text's ids and its end."""
    out = [0.0] * len(texts)
    for group in _groups([len(x) for x in texts], TEXT_WINDOWS * STRIDE):
        symbols = [np.append(model.symbol_of[texts[i]], END) for i in group]
        inputs, targets, first = windows_of(symbols)
        for lo in range(0, len(inputs), TEXT_WINDOWS):
            t = targets[lo : lo + TEXT_WINDOWS]
            got = log_probs(model.tables, inputs[lo : lo + TEXT_WINDOWS], np.maximum(t, 0)).astype(np.float64)
            per_window = np.where(t >= 0, got, 0.0).sum(1)
            owner = np.searchsorted(first, np.arange(lo, lo + len(t)), side="right") - 1
            for j, x in enumerate(np.bincount(owner, per_window, len(group)).tolist()):
                out[group[j]] += x
        for i in group:
            out[i] += float(model.within_log[texts[i]].sum())
    return out


def _groups(sizes: list[int], most: int) -> Iterator[list[int]]:
    """Neighbours of ``most`` in all, or single ones of more."""
    group, total = [], 0
    for i, n in enumerate(sizes):
        if group and total + n > most:
            yield group
            group, total = [], 0
        group.append(i)
        total += n
    if group:
        yield group


def score_texts(model: LanguageModel, texts: list[list[bytes]], table: Words) -> Iterator[tuple[float, float, int, list[bytes]]]:
    """Per text (a list of words): the model's log10 probability, the frequent words' sum of log10(c + 1), how many those are, and the other words."""
    ids, logs = [], []
    for ws in texts:
        pieces, own = zip(*map(table.__getitem__, ws), strict=True) if ws else ((), ())
        ids.append(np.frombuffer(b"".join(pieces), "<u2"))
        logs.append(np.array(own, np.float64))
    ends = math.isnan(model.end_log) or model.end_log == 0  # unseen
    for ws, own, lp in zip(texts, logs, score_ids(model, ids), strict=True):
        rest = np.isnan(own)
        yield lp / LOG10, float(own[~rest].sum()) + (0.0 if ends else model.end_log), int(len(ws) - rest.sum()) + (not ends), [ws[i] for i in np.flatnonzero(rest)]


# ---- Spark


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush():
        words, counts = list(seen.keys()), list(seen.values())
        seen.clear()
        for lo in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(words[lo : lo + 50_000], pa.binary()), pa.array(counts[lo : lo + 50_000], pa.int64())], names=["word", "n"])

    for b in batches:
        for t in b.column("text"):
            seen.update(words_of(t.as_py()))
        if len(seen) > COUNTER_WORDS:
            yield from flush()
    yield from flush()


def word_counts(train_docs: DataFrame) -> DataFrame:
    """word (binary), n: over all words of the documents; counted in each task before the shuffle."""
    return train_docs.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = HEAD_WORDS) -> dict[bytes, float]:
    """word -> log10(count + 1) of the ``most`` most frequent words at most: all above a count that a histogram gives, so nothing is sorted."""
    band = F.floor(F.log2("n") * 16).cast("int")
    low, total = None, 0
    for r in sorted(counts.groupBy(band.alias("band")).agg(F.count("*").alias("k")).collect(), reverse=True):
        total += r.k
        if total > most:
            break
        low = r.band
    if low is None:
        return {}
    top = counts.where(band >= low).toArrow()
    logs = np.log10(top.column("n").to_numpy() + 1.0).tolist()
    return dict(zip(top.column("word").to_pylist(), logs, strict=True))


def _count_ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, total = spaced(path), np.zeros(1 << 16, np.int64)
        for b in batches:
            for w, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
                for i in np.frombuffer(encode[w], "<u2").tolist():
                    total[i] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["id", "n"])

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits that look drawn by chance, from 64 bits (splitmix)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Windows that are given out together.
DRAWN = 8_192


def _draw_windows(path: str, symbol_of: np.ndarray, share: float, seed: int):
    """h, w: a share of the windows of each text (key, text), drawn by a hash of key and position, and that hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, most = spaced(path), np.uint64(min(share, 1.0) * (2.0**64 - 4096))
        before, behind = np.full(CONTEXT, START, np.int16), np.array([END] + [START] * STRIDE, np.int16)
        of_id, own = symbol_of.astype(np.int16), np.r_[: CONTEXT, CONTEXT - STRIDE + 1 : CONTEXT + 1]
        streams, begins, hashes, held, end = [], [], [], 0, 0

        def flush():
            # as in windows_of, for the drawn windows only
            rows = np.concatenate(streams)[np.concatenate(begins)[:, None] + own]
            targets = rows[:, CONTEXT:]
            targets[targets == START] = -1
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * 2)
            windows = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.astype("<i2", copy=False))])
            out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), windows], names=["h", "w"])
            for x in (streams, begins, hashes):
                x.clear()
            return out

        for b in batches:
            for key, t in zip(b.column("key").to_pylist(), b.column("text"), strict=True):
                ids = np.frombuffer(b"".join(map(encode.__getitem__, words_of(t.as_py()))), "<u2")
                n = len(ids) // STRIDE + 1
                h = mixed(mixed(np.array([key], np.int64).view(np.uint64) + np.uint64(seed)) + np.arange(n, dtype=np.uint64))
                at = np.flatnonzero(h <= most)
                if not len(at):
                    continue
                streams += [before, of_id.take(ids), behind]
                begins.append(at * STRIDE + (STRIDE - 1 + end))
                hashes.append(h[at])
                end, held = end + CONTEXT + len(ids) + len(behind), held + len(at)
                if held >= DRAWN:
                    yield flush()
                    held = end = 0
        if held:
            yield flush()

    return run


def _matrix(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), "<i2").reshape(-1, CONTEXT + STRIDE)


def _rows(windows: pa.BinaryArray) -> np.ndarray:
    """The windows of a column, which are equally long, as one array."""
    size = (CONTEXT + STRIDE) * 2
    begin = np.frombuffer(windows.buffers()[1], np.int32)[windows.offset]
    return np.frombuffer(windows.buffers()[2], "<i2", len(windows) * size // 2, begin).reshape(-1, CONTEXT + STRIDE)


def _in_order(h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The order by hash, then by the window's bytes."""
    order = h.argsort(kind="stable")
    if len(h) > 1 and (h[order][1:] == h[order][:-1]).any():
        order = np.array(sorted(range(len(h)), key=lambda i: (h[i], rows[i].tobytes())))
    return order


def _train_groups(weights: dict[str, np.ndarray]):
    """Rows (g, h, w) come sorted by g; trains on each group, ordered by h and w, from ``weights``; yields n and the sum of the groups' weights, each times its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        total, n, least, group, hs, ws = 0.0, 0, 1 << 62, None, [], []

        def close():
            nonlocal total, n
            h, rows, adam = np.concatenate(hs), np.concatenate(ws), Adam(weights)
            rows = rows[_in_order(h, rows)]
            for lo in range(0, len(rows), BATCH):
                adam.step(rows[lo : lo + BATCH], PASS_RATE * min(1.0, (adam.at + 1) / 20))
            total, n = total + adam.flat.astype(np.float64) * len(rows), n + len(rows)
            hs.clear()
            ws.clear()

        for b in batches:
            if not b.num_rows:
                continue
            g, h, rows = b.column("g").to_numpy(), b.column("h").to_numpy(), _rows(b.column("w"))
            cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if g[lo] != group and group is not None:
                    close()
                group = int(g[lo])
                least = min(least, group)
                hs.append(h[lo:hi].copy())
                ws.append(rows[lo:hi].copy())
        if group is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array([least], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["g", "n", "w"])

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least, n, total = 1 << 62, 0, None
    for b in batches:
        for g, k, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
            x = np.frombuffer(x)
            least, n, total = min(least, g), n + k, x if total is None else total + x
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([least], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["g", "n", "w"])


#: Sums of weights that the driver gets at most (some 0.5 MB each).
SUMS = 32


def refine(windows: DataFrame, weights: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], int]:
    """The mean of the weights that groups of ``windows`` (h, w) reach from ``weights``, each counted by its windows, and the number of windows."""
    spark, schema = windows.sparkSession, "g long, n long, w binary"
    groups = max(1, -(-windows.count() // GROUP_WINDOWS))
    dealt = windows.withColumn("g", F.pmod(F.col("h"), F.lit(groups)))
    parts = min(groups, max(SUMS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))  # groups fall on parts by chance: small parts even out
    each = dealt.repartition(parts, "g").sortWithinPartitions("g").select("g", "h", "w").mapInArrow(_train_groups(weights), schema)
    if parts > SUMS:
        each = stage(each, "lm_weights").repartition(SUMS, F.col("g") % SUMS).sortWithinPartitions("g").mapInArrow(_add_up, schema)
    sums = sorted(each.collect(), key=lambda r: r.g)
    n = sum(r.n for r in sums)
    if not n:
        return weights, 0
    return {k: x.astype(np.float32) for k, x in unflat(sum(np.frombuffer(r.w) for r in sums) / n, weights).items()}, n


def symbols(path: str, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each id's symbol and log share of it, and the corpus count of each symbol; ``freq`` counts ids."""
    encode = spaced(path)
    ranked = np.argsort(-freq, kind="stable")[: SLOTS - 2]
    symbol_of, within = np.full(len(freq), RARE, np.int64), np.zeros(len(freq))
    symbol_of[ranked] = np.arange(2, SLOTS)
    others = np.flatnonzero(symbol_of == RARE)
    others = np.array(sorted(others.tolist(), key=lambda i: (encode.bytes_of(i), i)), np.int64)
    mass = np.cumsum(freq[others] + 1.0)
    ranges = np.minimum((mass / mass[-1] * TAIL).astype(np.int64), TAIL - 1)
    symbol_of[others] = RANGE + ranges
    per_range = np.bincount(ranges, freq[others] + 1.0, TAIL)
    within[others] = np.log((freq[others] + 1.0) / per_range[ranges])
    counts = np.zeros(SYMBOLS)
    counts[2:SLOTS], counts[RARE], counts[RANGE:] = freq[ranked], freq[others].sum(), per_range
    return symbol_of, within, counts


def fit(train_docs: DataFrame, *, vocabulary: str | None = None, seed: int = SEED) -> tuple[LanguageModel, DataFrame]:
    """The model and the staged word counts of ``train_docs`` (doc_id, text). Rows that repeat in both train once, and count as often as they come."""
    path = vocabulary or vocabulary_path(VOCABULARY)
    counts = stage(word_counts(train_docs), "lm_counts")
    n_docs = train_docs.count()
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    by_id = {r.id: r.n for r in counts.mapInArrow(_count_ids(path), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    freq = np.zeros(1 << 16, np.int64)
    freq[list(by_id)] = list(by_id.values())
    symbol_of, within, of_symbol = symbols(path, freq)
    of_symbol[END] = n_docs
    p = (of_symbol[:SLOTS] + 1).reshape(CLASSES, MEMBERS)
    ranges = of_symbol[RANGE:] + 1
    weights = init(np.random.default_rng(seed), np.log(p.sum(1) / p.sum()), np.log(p / p.sum(1, keepdims=True)), np.log(ranges / ranges.sum()))

    rows = train_docs.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    if rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        rows = rows.dropDuplicates(["key"])
    windows = stage(rows.mapInArrow(_draw_windows(path, symbol_of, 1.0, seed), "h long, w binary"), "lm_windows")
    total = windows.count()
    first = SAMPLE_WINDOWS / max(total, 1)
    sample = windows if first >= 1 else windows.where(F.expr(f"conv(hex(h), 16, 10) <= cast({int(first * 2.0**64)} as decimal(20, 0))"))
    got = sorted((r.h % (1 << 64), bytes(r.w)) for r in sample.collect())
    weights = train(_matrix([w for _, w in got]), weights, seed=seed)
    rounds = max(1, min(ROUNDS, total // GROUP_WINDOWS))
    for i in range(rounds):
        weights, _ = refine(windows.where(F.pmod(F.shiftrightunsigned("h", 32), F.lit(rounds)) == i), weights)
    discard(windows)
    known = int(n_docs > 0)
    return LanguageModel(path, folded(weights), symbol_of, within, int(words) + n_docs, int(distinct) + known, frequent(counts), math.log10(n_docs + 1)), counts


_tables: dict[str, Words] = {}
#: Characters of texts that are scored together.
CHARS_AT_ONCE = 400_000


def _score(shared, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        model = shared.value
        if name not in _tables:
            _tables.clear()
            _tables[name] = Words(model)
        key = TaskContext.get().partitionId() << 36
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                texts = b.column("text").slice(lo, 64).to_pylist()
                words, done = [0] * len(texts), []
                for group in _groups([len(t or "") for t in texts], CHARS_AT_ONCE):
                    split = [words_of(texts[i]) for i in group]
                    for i, ws in zip(group, split, strict=True):
                        words[i] = len(ws)
                    done += score_texts(model, split, _tables[name])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, 64), pa.array(range(key, key + len(texts)), pa.int64()), pa.array([n + 1 for n in words], pa.int64()),
                     pa.array([d[0] for d in done]), pa.array([d[1] for d in done]), pa.array([int(d[2]) for d in done], pa.int64()),
                     pa.array([d[3] for d in done], pa.list_(pa.binary()))],
                    names=["doc_id", "row_key", "n_tokens", "score", "head_sum", "head_known", "tail"],
                )
                key += len(texts)

    return run


def score(docs: DataFrame, *, vocabulary: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out. Tokens are words and one end; null texts count as empty and
    have the end alone. Without training rows N and V are 0 and nothing is known. Repeated rows are
    documents of their own. A text is scored in blocks of windows, however long it is. Extra columns are
    ignored; an empty table gives no rows.
    """
    import uuid

    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model, counts = fit(d.where(~held_out(F.col("doc_id"))), vocabulary=vocabulary)
    shared = spark.sparkContext.broadcast(model)
    schema = "doc_id long, row_key long, n_tokens long, score double, head_sum double, head_known long, tail array<binary>"
    scored = stage(d.mapInArrow(_score(shared, uuid.uuid4().hex), schema), "lm_scores")
    tails = scored.select("row_key", F.explode("tail").alias("word"))
    met = tails.join(counts, "word").groupBy("row_key").agg(F.sum(F.log10(F.col("n") + 1.0)).alias("tail_sum"), F.count("*").alias("tail_known"))
    out = scored.drop("tail").join(met, "row_key", "left")
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(model.floor)).alias("base_score"), "score",
    )
