"""Personal data: exact base patterns, and spans that a character BiLSTM with CRF transitions adds.

The network is trained in numpy on labelled windows of the corpus: stretches of its own texts, labelled by the base
patterns and by named secrets, with further forms set in between that no pattern has (hidden addresses, bare phone
numbers, numbers that run into one another, keys). Every span of its kinds holds a digit or an @, so windows are laid
over the runs around those characters only, and none can be missed elsewhere; overlapping windows are decoded one by
one and reconciled over the whole text: each character keeps the tag of the window in which it is farthest from an edge.
"""

from __future__ import annotations

import hashlib
import random
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8_buffer

KINDS = ("email", "ip", "card", "phone")
#: The network's kinds: a secret is the value of a named key or token.
ALL_KINDS = (*KINDS, "secret")
WINDOW, STRIDE, MARGIN = 96, 48, 24
#: Bounds of training: documents that give windows, windows in all, steps, and the sizes of the network.
DOCUMENTS, SENTENCES, STEPS, BATCH, EMBED, HIDDEN = 20_000, 3000, 360, 48, 12, 20

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = re.compile("[0-9@]")
_SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|key)[\"']?\s?[=:]\s?[\"']?([a-z0-9+/_-]{16,64})(?![a-z0-9+/_-])")
_VALUE = re.compile("[A-Za-z0-9+/_-]+")
_BYTES = np.zeros(256, bool)
_BYTES[[*range(48, 58), 64]] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind: str, s: str) -> bool:
    digits = "".join(c for c in s if "0" <= c <= "9")
    match kind:
        case "ip":
            return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in s.split("."))
        case "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        case "phone":
            return 9 <= len(digits) <= 15
    return True


def _emails(text: str):
    """Leftmost non-overlapping matches, found from each @ outward: linear in the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        s = at
        while s > free and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            yield s, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", s, e) for s, e in _emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m[0])]
    return out


# --- the network -----------------------------------------------------------------------------------------------

_TAGS = 1 + 2 * len(ALL_KINDS)  # O, then B and I of each kind


def char_ids(text: str) -> np.ndarray:
    """0 pads; ASCII has its own ids; other characters share one."""
    x = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    return np.where(x < 128, x + 1, 129)


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghijklmnoprstuvwéèüñ") for _ in range(rng.randint(1, 9)))


def _card(rng: random.Random) -> str:
    d = rng.choice("3456") + _digits(rng, rng.choice((12, 13, 14, 14, 14)))
    d += next(c for c in "0123456789" if luhn(d + c))
    return rng.choice(("", "", " ", "-", ".")).join(d[i : i + 4] for i in range(0, len(d), 4))


def _phone(rng: random.Random) -> str:
    a, b, c, land = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4), rng.randint(1, 99)
    return rng.choice((f"+{land} ({a}) {b}-{c}", f"+{land} ({a}) {b}-{c}", f"+{land} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{land}{a}{b}{c}"))


def _email(rng: random.Random) -> str:
    who = f"{_word(rng)}{rng.choice(('', '.', '_'))}{rng.choice((_word(rng), _digits(rng, 2)))}"
    return f"{who}{rng.choice(('@', '@', '@', ' @ ', '(at)@'))}{_word(rng)}{_digits(rng, 1)}.{rng.choice(('com', 'org', 'example.com', 'de'))}"


def _ip(rng: random.Random) -> str:
    return ".".join(str(rng.randint(0, 255)) for _ in range(4))


def _secret(rng: random.Random) -> tuple[str, str]:
    """What names a secret, and the secret."""
    name = rng.choice(("token", "token", "Token", "TOKEN", "api_key", "API_KEY", "secret", "password", "access-key", "key"))
    letters = rng.choice(("0123456789abcdef", "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    return f"{name}{rng.choice((' = ', ' = ', '=', ': ', ':'))}{rng.choice(chr(34) + chr(34) + chr(39) + '|')}".rstrip("|"), "".join(rng.choice(letters) for _ in range(rng.choice((20, 32, 40, 40, 40))))


def _no_span(rng: random.Random) -> str:
    """Numbers and signs that are no personal data: also a digest without a name, and a card number that fails its check."""
    x, y = rng.randint(0, 9), "".join(rng.choice("0123456789abcdef") for _ in range(40))
    wrong = next(d for d in iter(lambda: _digits(rng, 16), "") if not luhn(d))
    return rng.choice((_digits(rng, rng.randint(1, 8)), f"{_digits(rng, 2)}.{_digits(rng, 2)}", f"{_digits(rng, 4)}-{_digits(rng, 2)}-{_digits(rng, 2)}", f"v{x}.{rng.randint(0, 9)}.{rng.randint(0, 30)}", y, f"commit {y}", f"@{_word(rng)}", _digits(rng, rng.randint(20, 30)), wrong))


def _piece(rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """One stretch with its labels: a span, or two numbers that run into one another."""
    x = rng.random()
    if x < 0.3:
        name, value = _secret(rng)
        return name + value + (name[-1] if name[-1] in "\"'" else ""), [("secret", len(name), len(name) + len(value))]
    if x < 0.4:
        a, b = _phone(rng), _ip(rng)
        return f"{a} {b}", [("phone", 0, len(a)), ("ip", len(a) + 1, len(a) + 1 + len(b))]
    kind, made = rng.choice((("email", _email), ("ip", _ip), ("card", _card), ("phone", _phone), ("phone", _phone)))
    t = made(rng)
    return t, [(kind, 0, len(t))]


def _sentence(rng: random.Random, corpus: list[tuple[str, list[tuple[str, int, int]]]] = ()) -> tuple[str, list[tuple[str, int, int]]]:
    """WINDOW characters with labelled spans: the corpus' own stretches and words, further forms, and numbers that are none."""
    text, spans = "", []

    def add(t, found=()):
        nonlocal text
        spans.extend((k, s + len(text), e + len(text)) for k, s, e in found)
        text += t

    while len(text) < WINDOW:
        add(rng.choice(("", " ", " ", ". ", ", ", "\n", '"', "(", "*** ")) if text else "")
        x = rng.random()
        if x < 0.16:
            add(*_piece(rng))
            add(rng.choice((" ", " ", ".", "\n", "!!", "$$$ ")))
        elif x < 0.28:
            add(_no_span(rng) + " ")
        elif corpus and x < 0.6:
            add(*rng.choice(corpus))
            add(" ")
        else:
            add(_word(rng) + " ")
    shift = rng.randint(0, len(text) - WINDOW)
    kept = [(k, max(s - shift, 0), min(e - shift, WINDOW)) for k, s, e in spans if s - shift < WINDOW and e - shift > 0]
    return text[shift : shift + WINDOW], kept


def _labelled(n: int, seed: int, corpus: list = ()) -> tuple[np.ndarray, np.ndarray]:
    rng = random.Random(seed)
    x, y = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    for i in range(n):
        text, spans = _sentence(rng, corpus)
        x[i] = char_ids(text)
        for kind, s, e in spans:
            k = 1 + 2 * ALL_KINDS.index(kind)
            y[i, s:e] = k + 1
            y[i, s] = k
        pad = rng.choice((0, 0, 0, rng.randint(1, 60)))
        if pad:
            x[i, WINDOW - pad :], y[i, WINDOW - pad :] = 0, 0
    return x, y


def teacher(text: str) -> list[tuple[str, int, int]]:
    """The labels of a corpus text: its base spans, and secrets that are named."""
    named = [("secret", m.start(1), m.end(1)) for m in _SECRET.finditer(text) if _mixed(m[1])]
    base = base_spans(text)
    return [x for x in base if all(x[2] <= s or x[1] >= e for _, s, e in named)] + named


def _mixed(t: str) -> bool:
    return any(c.isdigit() for c in t) and any(c.isalpha() for c in t)


def stretches(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A text's windows with the teacher's labels; windows that cut a span are left out."""
    known, out = teacher(text), []
    for s, e in windows(text):
        inside = [(k, a - s, b - s) for k, a, b in known if a < e and b > s]
        if all(a >= 0 and b <= e - s for _, a, b in inside):
            out.append((text[s:e], inside))
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-z))


class BiLstmCrf:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        u = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"e": u(130, EMBED) * 3, "o": u(2 * HIDDEN, _TAGS), "ob": np.zeros(_TAGS, np.float32), "t": u(_TAGS, _TAGS), "s": np.zeros(_TAGS, np.float32)}
        gates = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)].astype(np.float32)
        self.p |= {"w": np.stack([u(EMBED + HIDDEN, 4 * HIDDEN) for _ in "fb"]), "b": np.stack([gates, gates])[:, None]}

    def _run(self, ids: np.ndarray):
        """Hidden states (time, batch, 2 * HIDDEN) of both directions, run side by side, and what the way back needs."""
        e = self.p["e"][ids.T]
        x = np.stack([e, e[::-1]], 1)  # (time, direction, batch, EMBED)
        w, b = self.p["w"], self.p["b"]
        n, _, m, _ = x.shape
        h, c, keep = np.zeros((2, m, HIDDEN), np.float32), np.zeros((2, m, HIDDEN), np.float32), []
        out, given, again = np.empty((n, 2, m, HIDDEN), np.float32), x @ w[:, :EMBED] + b, np.ascontiguousarray(w[:, EMBED:])
        for t in range(n):
            z = given[t] + h @ again
            g = _sigmoid(z[..., : 3 * HIDDEN])
            i, f, o, a = g[..., :HIDDEN], g[..., HIDDEN : 2 * HIDDEN], g[..., 2 * HIDDEN :], np.tanh(z[..., 3 * HIDDEN :])
            before, last = c, h
            c = f * c + i * a
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            keep.append((i, f, o, a, before, tc, last))
        return np.concatenate([out[:, 0], out[::-1, 1]], 2), x, keep

    def _back(self, ids, x, keep, dout, grad):
        w = self.p["w"]
        dout = np.stack([dout[:, :, :HIDDEN], dout[::-1, :, HIDDEN:]], 1)
        again = np.ascontiguousarray(w[:, EMBED:].transpose(0, 2, 1))
        dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
        dz_all = np.empty((*dout.shape[:3], 4 * HIDDEN), np.float32)
        for t in range(len(x) - 1, -1, -1):
            i, f, o, a, before, tc, _ = keep[t]
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = dz_all[t]
            dz[..., :HIDDEN] = dc * a * i * (1 - i)
            dz[..., HIDDEN : 2 * HIDDEN] = dc * before * f * (1 - f)
            dz[..., 2 * HIDDEN : 3 * HIDDEN] = dh * tc * o * (1 - o)
            dz[..., 3 * HIDDEN :] = dc * i * (1 - a * a)
            dh, dc = dz @ again, dc * f
        given = np.concatenate([x, np.stack([k[6] for k in keep])], 3)
        grad["w"] = np.stack([given[:, d].reshape(-1, EMBED + HIDDEN).T @ dz_all[:, d].reshape(-1, 4 * HIDDEN) for d in (0, 1)])
        grad["b"] = dz_all.sum((0, 2))[:, None]
        dx = dz_all @ w[:, :EMBED].transpose(0, 2, 1)
        one = np.zeros((ids.size, len(self.p["e"])), np.float32)
        one[np.arange(ids.size), ids.T.ravel()] = 1
        grad["e"] = one.T @ (dx[:, 0] + dx[::-1, 1]).reshape(-1, EMBED)

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """(batch, time) ids to (time, batch, tags)."""
        return self._run(ids)[0] @ self.p["o"] + self.p["ob"]

    def step(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tag sequences under the CRF, and its gradient."""
        p, grad = self.p, {}
        h, x, keep = self._run(ids)
        e = (h @ p["o"] + p["ob"]).astype(np.float64)
        n, m, _ = e.shape
        y, tr = tags.T, p["t"].astype(np.float64)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + p["s"]
        for t in range(1, n):
            top = alpha[t - 1].max(1, keepdims=True)
            alpha[t] = np.log(np.exp(alpha[t - 1] - top) @ np.exp(tr) + 1e-300) + top + e[t]
        for t in range(n - 2, -1, -1):
            z = beta[t + 1] + e[t + 1]
            top = z.max(1, keepdims=True)
            beta[t] = np.log(np.exp(z - top) @ np.exp(tr).T + 1e-300) + top
        top = alpha[-1].max(1)
        total = np.log(np.exp(alpha[-1] - top[:, None]).sum(1)) + top
        k = np.arange(m)
        gold = p["s"][y[0]] + sum(e[t, k, y[t]] for t in range(n)) + sum(tr[y[t - 1], y[t]] for t in range(1, n))
        de = np.exp(alpha + beta - total[None, :, None])
        grad["s"] = (de[0].sum(0) - np.bincount(y[0], minlength=_TAGS)) / m
        left = np.exp(alpha[:-1] - total[None, :, None] / 2)
        right = np.exp(beta[1:] + e[1:] - total[None, :, None] / 2)
        pair = np.einsum("nmi,nmj->ij", left, right) * np.exp(tr)
        true = np.zeros_like(pair)
        np.add.at(true, (y[:-1].ravel(), y[1:].ravel()), 1)
        grad["t"] = (pair - true) / m
        np.subtract.at(de, (np.arange(n)[:, None], k[None, :], y), 1)
        de = (de / m).astype(np.float32)
        grad["o"], grad["ob"] = h.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, _TAGS), de.sum((0, 1))
        self._back(ids, x, keep, de @ p["o"].T, grad)
        return float((total - gold).mean()), grad

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best tag sequence of each row, by Viterbi."""
        e, tr = self.emissions(ids), self.p["t"]
        n, m, _ = e.shape
        score, back = e[0] + self.p["s"], np.empty((n, m, _TAGS), np.int8)
        for t in range(1, n):
            z = score[:, :, None] + tr[None]
            back[t] = z.argmax(1)
            score = z.max(1) + e[t]
        out = np.empty((n, m), np.int64)
        out[-1] = score.argmax(1)
        for t in range(n - 1, 0, -1):
            out[t - 1] = back[t, np.arange(m), out[t]]
        return out.T


def corpus_windows(docs: DataFrame, documents: int = DOCUMENTS, most: int = SENTENCES) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled windows of about `documents` documents, chosen by a hash of their ids and texts; at most `most` of them.

    Windows are cut where the texts are; the `most` of the least hashes come to the driver, WINDOW characters each.
    """
    share = min(1.0, documents / max(docs.count(), 1))

    def run(batches):
        for b in batches:
            flat, offsets = utf8_buffer(b.column(0))
            hits = np.diff(np.searchsorted(np.flatnonzero(_BYTES[flat]), offsets))
            cut = {(t, tuple(spans)) for i in np.flatnonzero(hits).tolist() for t, spans in stretches(b.column(0)[i].as_py())}
            t = [x for x, _ in cut]
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array([",".join(f"{k}:{s}:{e}" for k, s, e in spans) for _, spans in cut], pa.string())], ["t", "spans"])

    picked = docs.where(F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) < int(share * 2**53)).select("text")
    rows = picked.mapInArrow(run, "t string, spans string").distinct().orderBy(F.xxhash64("t"), "t", "spans").limit(most).collect()  # bounds what trains the network
    return [(r.t, [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]) for r in rows]


@cache
def trained(corpus: tuple = (), sentences: int = SENTENCES, steps: int = STEPS, seed: int = 7) -> BiLstmCrf:
    """Adam over labelled windows; the same corpus windows and numbers give the same network."""
    net, rng = BiLstmCrf(seed), np.random.default_rng(seed)
    x, y = _labelled(sentences, seed, [(t, list(spans)) for t, spans in corpus])
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    for t in range(1, steps + 1):
        pick = rng.integers(0, sentences, BATCH)
        _, grad = net.step(x[pick], y[pick])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
        rate = 0.02 * min(1.0, t / 20) * (1 - 0.9 * t / steps)
        for k, g in grad.items():
            g = g * min(1.0, 5 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            net.p[k] = (net.p[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return net


def train_pii(docs: DataFrame) -> BiLstmCrf:
    """The network for a corpus, from its own labelled windows; an empty corpus leaves the generated ones."""
    return trained(tuple((t, tuple(spans)) for t, spans in corpus_windows(docs)))


def windows(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over all stretches within MARGIN characters of a run of non-blanks with a digit or an @."""
    out, lo, hi, n = [], None, 0, len(text)
    for m in _TRIGGER.finditer(text):
        p = m.start()
        if lo is not None and p < hi - MARGIN:
            continue
        s = e = p
        while s > max(hi - MARGIN, 0) and not text[s - 1].isspace():
            s -= 1
        while e < n and not text[e].isspace():
            e += 1
        if lo is not None and s - MARGIN <= hi:
            hi = e + MARGIN
            continue
        if lo is not None:
            out.append((lo, hi))
        lo, hi = max(s - MARGIN, 0), e + MARGIN
    if lo is not None:
        out.append((lo, hi))
    cut = []
    for s, e in out:
        e = min(e, n)
        for a in range(s, max(e - WINDOW, s) + STRIDE, STRIDE):
            cut.append((a, min(a + WINDOW, e)))
            if a + WINDOW >= e:
                break
    return cut


def reconcile(found: list[tuple[int, int, np.ndarray]]) -> list[tuple[str, int, int]]:
    """Spans of a text from its windows' tags (start, end, tags), windows in order."""
    spans, at, i = [], 0, 0
    while i < len(found):
        j, end = i + 1, found[i][1]
        while j < len(found) and found[j][0] < end:
            end = max(end, found[j][1])
            j += 1
        lo = found[i][0]
        tags, depth = np.zeros(end - lo, np.int64), np.full(end - lo, -1)
        for s, e, t in found[i:j]:
            n = np.arange(e - s)
            mine = np.minimum(n + (0 if s > lo else WINDOW), (e - s - 1 - n) + (0 if e < end else WINDOW))
            better = mine > depth[s - lo : e - lo]
            depth[s - lo : e - lo][better] = mine[better]
            tags[s - lo : e - lo][better] = t[: e - s][better]
        kind = (tags + 1) // 2
        edge = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | ((tags[1:] % 2 == 1) & (tags[1:] > 0))])
        for a, b in zip(edge, np.r_[edge[1:], len(tags)]):
            if kind[a]:
                spans.append((ALL_KINDS[kind[a] - 1], int(lo + a), int(lo + b)))
        i = j
    return spans


def added_spans(text: str, base: list[tuple[str, int, int]], model: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The model's spans, trimmed, that hold what their kind needs and touch no span already there."""
    taken, out = [(s, e) for _, s, e in base], []
    for kind, s, e in model:
        while s < e and not (text[s].isalnum() or text[s] in "+("):
            s += 1
        while e > s and not text[e - 1].isalnum():
            e -= 1
        t = text[s:e]
        if kind == "email":
            fine = t.count("@") == 1 and "." in t.split("@")[1] and t[0] != "@"
        elif kind == "ip":
            fine = bool(_IP.fullmatch(t)) and valid(kind, t)
        elif kind == "secret":
            fine = 16 <= len(t) <= 64 and _mixed(t) and bool(_VALUE.fullmatch(t))
        else:
            fine = valid(kind, t) and all(c in "0123456789+().- " for c in t)
        left, right = text[s - 1 : s], text[e : e + 1]
        if fine and not (left.isalnum() and left.isascii()) and not (right.isalnum() and right.isascii()) and all(e <= a or s >= b for a, b in taken):
            out.append((kind, s, e))
            taken.append((s, e))
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (ALL_KINDS.index(x[0]), x[1])))


def find_pii(texts: list[str], net: BiLstmCrf) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; the windows of all texts are decoded together."""
    cuts = [windows(t) for t in texts]
    where = [(i, s, e) for i, c in enumerate(cuts) for s, e in c]
    tags: list[list] = [[] for _ in texts]
    for lo in range(0, len(where), 512):
        part = where[lo : lo + 512]
        x = np.zeros((len(part), WINDOW), np.int64)
        for r, (i, s, e) in enumerate(part):
            x[r, : e - s] = char_ids(texts[i][s:e])
        for (i, s, e), t in zip(part, net.decode(x)):
            tags[i].append((s, e, t))
    out = []
    for text, found in zip(texts, tags):
        base = base_spans(text)
        out.append((base, base + added_spans(text, base, reconcile(found))))
    return out


def detect_pii(docs: DataFrame, net: BiLstmCrf | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added, n_spans for every row of docs.

    Null and empty texts have none; repeated rows agree; other columns are ignored; whole texts of any length; an empty
    table gives an empty result. Without a network, one is trained on docs.
    """
    net = net or train_pii(docs)

    def run(batches):
        for b in batches:
            flat, offsets = utf8_buffer(b.column(1))
            hits = np.diff(np.searchsorted(np.flatnonzero(_BYTES[flat]), offsets))
            busy = np.flatnonzero(hits)
            got: dict[int, tuple[list, list]] = {}
            for lo in range(0, len(busy), 256):
                part = busy[lo : lo + 256].tolist()
                got |= zip(part, find_pii([b.column(1)[i].as_py() for i in part], net))
            out = []
            for i in range(b.num_rows):
                base, every = got.get(i, ((), ()))
                kinds = [k for k, _, _ in base]
                out.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(_joined(list(base)).encode()).hexdigest(), _joined(list(every)), len(every) - len(base), len(every)))
            c = list(zip(*out)) if out else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, k) for x, k in zip(c, kinds))], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "n_spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long")
