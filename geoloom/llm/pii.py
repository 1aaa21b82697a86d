"""Personal data: base patterns, and a character BiLSTM with CRF transitions.

The base finds e-mail addresses, IPv4 addresses, payment cards and phone numbers
by fixed patterns.  The method tags every character of every text: the text is
cut into overlapping windows, and a bidirectional LSTM gives the emissions of
each window.  The windows are reconciled over the whole text: in an overlap the
emissions are averaged, each window's by its distance to the window's edge, and
one Viterbi path is decoded over the whole text.  Runs of a tag become spans; a
span is trimmed, must have the form of its kind, and is added unless it touches a
base span.

Decoding is exact and needs no pass over plain text: kinds never follow each
other at once, so a path's score is the sum of what its spans gain over "none",
and only places inside some span of positive gain can be tagged.  These places
are found by running sums; the path is decoded between them.  Scores are rounded
to ``1 / UNIT`` and summed as integers, each lane is computed apart (its own
ends, no padding is read), so the spans of a text do not depend on the texts
beside it.

The network is trained in numpy, on the driver, from labelled spans that a
seeded generator writes (``labelled``): ``STEPS`` batches, a fixed cost that
does not depend on the data.  Its weights (about 10 kB) go to the tasks inside
the function.

Edge cases: null text counts as empty and has no span; texts of any length are
windowed whole; repeated rows give repeated result rows; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
HIDDEN, EMBED, CLASSES, TAGS = 8, 8, 72, 5
WINDOW, STRIDE, LANES = 384, 320, 1024
SEED, STEPS, BATCH, LENGTH = 11, 700, 192, 72

# ---------------------------------------------------------------- base

_MAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping: from each @ back over the local part, then on over the host."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _MAIL_LOCAL:
            start -= 1
        if start < at and (m := _MAIL_HOST.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind, as KINDS lists them."""
    out: list[list[tuple[int, int]]] = [emails(text), [], [], []]
    if _DIGIT.search(text):
        out[1] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out[2].append(m.span())
        if "+" in text:
            out[3] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# ---------------------------------------------------------------- labelled spans


def char_classes() -> np.ndarray:
    """Class of each code point below 256: letters by themselves in lower case, digits alike but for 0 to 2 leading roles, marks by themselves."""
    out = np.full(257, 1, np.uint8)
    nxt = 2
    for c in "abcdefghijklmnopqrstuvwxyz":
        out[ord(c)] = nxt
        out[ord(c.upper())] = nxt
        nxt += 1
    out[48:58] = nxt
    nxt += 1
    for c in "@.+-() ,:;_%/=\"'#$&*!|<>[]\n\t{}?\\~^`":
        out[ord(c)] = nxt
        nxt += 1
    if nxt > CLASSES:
        raise AssertionError("too many classes")
    return out


CLASS = char_classes()


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CLASS[np.minimum(points, 256)]


def labelled(rng: np.random.Generator, n: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts of ``length`` characters as classes, and the tag of each character (0: none, else kind + 1).

    Running text of syllables in several layouts holds spans of the four kinds,
    in the base's forms and in looser ones (spelled-out e-mail signs, phones
    without a plus), and decoys: hexadecimal tokens, long numbers, versions,
    dates, prices, and numbers that miss their checksum only at the form check.
    """
    syllables = "an ing er the on tion in es re or at ed nd th ou ea he ti ai eau ment que la ent cion os ado sch ein ung heit keit ach ber pa vi el ma to su".split()
    tails = ["", "", "", "", ",", ".", "***", "###", "!!", "$$$", "%%%", "&&&", " |"]

    def pick(xs):
        return xs[int(rng.integers(len(xs)))]

    def num(k):
        return "".join(map(str, rng.integers(0, 10, k)))

    def word():
        if rng.random() < 0.6:
            w = "".join(pick(syllables) for _ in range(int(rng.integers(1, 4))))
        else:  # words of any letters
            w = "".join(pick("bcdfghjklmnpqrstvwxyz") * int(rng.random() < 0.8) + pick("aeiouy") + pick("bcdfghjklmnpqrstvwxyz") * int(rng.random() < 0.5) for _ in range(int(rng.integers(1, 4))))
        r = rng.random()
        return w.upper() if r < 0.1 else w.title() if r < 0.25 else w

    def card():
        size = pick([13, 14, 15, 16, 16, 16, 16, 19])
        d = pick("3456") + num(size - 2)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = pick(["", "", " ", "-", ".", "/"])
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))

    def email():
        local = pick(["{}.{}", "{}{}", "{}_{}", "{}-{}", "{}.{}9", "{}"]).format(word(), num(int(rng.integers(1, 4))) if rng.random() < 0.6 else word())
        host = ".".join([word().lower() + (num(1) if rng.random() < 0.3 else ""), *(["example"] if rng.random() < 0.5 else []), pick(["com", "org", "net", "fr", "de", "io"])])
        if rng.random() < 0.72:
            return local + "@" + host
        at, dot = pick([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" @ ", " . "), ("(at)", "(dot)"), ("@", " dot "), (" AT ", " DOT "), (" at ", ".")])
        return local.lower() + at + host.replace(".", dot)

    def phone():
        a, b, c = num(3), num(3), num(4)
        return pick(["+1 ({}) {}-{}", "+1 ({}) {}-{}", "+1-{}-{}-{}", "+44 {} {} {}", "({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "00 33 {} {} {}", "+49{}{}{}", "1-{}-{}-{}", "({}){}-{}", "{} {} {}"]).format(a, b, c)

    def ip():
        parts = [str(int(x)) for x in rng.integers(1, 256, 4)]
        return pick([".", ".", ".", ".", " . ", "[.]", "(.)"]).join(parts) if rng.random() < 0.9 else ".".join(p.zfill(3) for p in parts)

    def decoy():
        return pick([
            lambda: 'token = "' + "".join(pick("0123456789abcdef") for _ in range(int(rng.integers(16, 41)))) + '"',
            lambda: num(int(rng.integers(1, 9))), lambda: "v" + ".".join(num(1) for _ in range(3)), lambda: ".".join(num(2) for _ in range(2)),
            lambda: f"{1990 + int(rng.integers(40))}-{num(2)}-{num(2)}", lambda: f"${num(3)}.{num(2)}", lambda: f"{num(2)}:{num(2)}:{num(2)}",
            lambda: f"https://{word().lower()}.{pick(['com', 'org'])}/{word().lower()}?page={num(2)}", lambda: "Version " + num(1) + "." + num(1) + ".", lambda: "@" + word().lower(), lambda: f"{num(1)},{num(3)},{num(3)}", lambda: num(24), lambda: word() + " at " + word(), lambda: word() + " dot " + word(),
        ])()

    makers = (email, ip, card, phone)
    xs, ys = np.ones((n, length), np.uint8), np.zeros((n, length), np.uint8)
    for r in range(n):
        text, tags, style = "", [], pick(tails)
        lead = int(rng.integers(0, 4))
        while len(text) < length + 24:
            kind = 0
            if lead > 0 or rng.random() < 0.72:
                part = word()
                lead -= 1
            elif rng.random() < 0.3:
                part = decoy()
            else:
                kind = int(rng.integers(4)) + 1
                part = makers[kind - 1]()
            text += part
            tags += [kind] * len(part)
            end = (style if rng.random() < 0.85 else pick(tails)) + ("\n" if rng.random() < 0.04 else " ")
            text += end
            tags += [0] * len(end)
        off = int(rng.integers(0, 24)) if rng.random() < 0.7 else 0
        xs[r] = classes(text)[off : off + length]
        ys[r] = tags[off : off + length]
    return xs, ys


# ---------------------------------------------------------------- network


def _lstm_forward(p: dict, d: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    """x (T, E, B) → states (T, H, B) and what the backward pass needs. Gates: input, forget, output, candidate."""
    T, _, B = x.shape
    H, h, c, hs, kept = HIDDEN, np.zeros((HIDDEN, B), np.float32), np.zeros((HIDDEN, B), np.float32), np.empty((T, HIDDEN, B), np.float32), []
    W, U, b = p[d + "W"], p[d + "U"], p[d + "b"][:, None]
    for t in range(T):
        z = W @ x[t] + U @ h + b
        s = 0.5 * np.tanh(0.5 * z[: 3 * H]) + 0.5
        g = np.tanh(z[3 * H :])
        before = c
        c = s[H : 2 * H] * c + s[:H] * g
        tc = np.tanh(c)
        kept.append((h, before, s, g, tc))
        h = s[2 * H :] * tc
        hs[t] = h
    return hs, kept


def _lstm_backward(p: dict, d: str, x: np.ndarray, kept: list, dh_all: np.ndarray, grads: dict) -> np.ndarray:
    T, _, B = x.shape
    H, dx = HIDDEN, np.empty_like(x)
    dh, dc = np.zeros((H, B), np.float32), np.zeros((H, B), np.float32)
    W, U = p[d + "W"], p[d + "U"]
    for t in range(T - 1, -1, -1):
        h, before, s, g, tc = kept[t]
        dh = dh + dh_all[t]
        dc = dc + dh * s[2 * H :] * (1 - tc * tc)
        dz = np.concatenate([dc * g, dc * before, dh * tc, dc * s[:H]])
        dz[: 3 * H] *= s * (1 - s)
        dz[3 * H :] *= 1 - g * g
        grads[d + "W"] += dz @ x[t].T
        grads[d + "U"] += dz @ h.T
        grads[d + "b"] += dz.sum(1)
        dx[t] = W.T @ dz
        dh, dc = U.T @ dz, dc * s[H : 2 * H]
    return dx


def _crf(e: np.ndarray, y: np.ndarray, A: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood of tags y (T, B) under emissions e (T, K, B) and transitions A, with gradients."""
    T, K, B = e.shape
    grow = np.exp(A)
    al, m = np.empty((T, K, B)), np.empty((T, B))
    al[0] = e[0]
    for t in range(1, T):
        m[t] = al[t - 1].max(0)
        al[t] = e[t] + m[t] + np.log(grow.T @ np.exp(al[t - 1] - m[t]) + 1e-300)
    be = np.zeros((T, K, B))
    for t in range(T - 2, -1, -1):
        v = e[t + 1] + be[t + 1]
        top = v.max(0)
        be[t] = top + np.log(grow @ np.exp(v - top) + 1e-300)
    top = al[-1].max(0)
    z = top + np.log(np.exp(al[-1] - top).sum(0))
    post = np.exp(al + be - z)
    rows, lanes = np.arange(T)[:, None], np.arange(B)[None, :]
    gold = e[rows, y, lanes].sum(0) + A[y[:-1], y[1:]].sum(0)
    de = post.copy()
    de[rows, y, lanes] -= 1
    before, after = np.exp(al[:-1] - z), np.exp(e[1:] + be[1:])
    dA = np.einsum("tjb,tkb->jk", before, after, optimize=True) * grow
    dA -= np.bincount((y[:-1] * K + y[1:]).ravel(), minlength=K * K).reshape(K, K)
    return float((z - gold).sum()), de.astype(np.float32), dA


_FORBID = -30.0


def train(seed: int = SEED, steps: int = STEPS, batch: int = BATCH, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Weights, by Adam on CRF likelihood over generated batches. One kind never follows another kind at once."""
    rng = np.random.default_rng(seed)
    H, E = HIDDEN, EMBED
    p = {"emb": rng.normal(0, 0.5, (CLASSES, E)), "O": rng.normal(0, 0.3, (TAGS, 2 * H)), "ob": np.zeros(TAGS)}
    p["ob"][0] = 1.0
    for d in "fb":
        p[d + "W"], p[d + "U"], p[d + "b"] = rng.normal(0, 0.5, (4 * H, E)), rng.normal(0, 0.35, (4 * H, H)), np.zeros(4 * H)
        p[d + "b"][H : 2 * H] = 1.0
    p = {k: v.astype(np.float32) for k, v in p.items()}
    A = np.where((np.arange(5)[:, None] == np.arange(5)) | (np.arange(5)[:, None] == 0) | (np.arange(5) == 0), 0.0, _FORBID)
    free = A == 0
    p["A"] = A.astype(np.float32)
    m1, m2 = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    pool_x, pool_y = labelled(rng, 24 * batch, length)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(pool_x), batch)
        xs, ys = pool_x[pick].T, pool_y[pick].T.astype(np.int64)
        x = p["emb"][xs].transpose(0, 2, 1).copy()
        hf, kf = _lstm_forward(p, "f", x)
        hb, kb = _lstm_forward(p, "b", x[::-1])
        h = np.concatenate([hf, hb[::-1]], axis=1)
        e = np.einsum("kh,thb->tkb", p["O"], h) + p["ob"][None, :, None]
        _, de, dA = _crf(e.astype(np.float64), ys, p["A"].astype(np.float64))
        de /= batch
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["A"] = (dA / batch * free).astype(np.float32)
        g["O"], g["ob"] = np.einsum("tkb,thb->kh", de, h), de.sum((0, 2))
        dh = np.einsum("kh,tkb->thb", p["O"], de)
        dx = _lstm_backward(p, "f", x, kf, dh[:, :H], g)
        dx += _lstm_backward(p, "b", x[::-1], kb, np.ascontiguousarray(dh[::-1, H:]), g)[::-1]
        flat = dx.transpose(0, 2, 1).reshape(-1, E)
        g["emb"] += np.stack([np.bincount(xs.ravel(), flat[:, j], CLASSES) for j in range(E)], axis=1)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k in p:
            v = g[k] * min(1.0, 20 / (norm + 1e-9))
            m1[k] = 0.9 * m1[k] + 0.1 * v
            m2[k] = 0.99 * m2[k] + 0.01 * v * v
            p[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)
    return p


_TRAINED: dict[tuple, dict] = {}


def model(seed: int = SEED, steps: int = STEPS) -> dict[str, np.ndarray]:
    """The trained weights; trained once in a process."""
    if (seed, steps) not in _TRAINED:
        _TRAINED[seed, steps] = train(seed, steps)
    return _TRAINED[seed, steps]


#: Scores are multiples of 1 / UNIT.
UNIT = 1024


class Tagger:
    """Tags texts of classes, many windows at a time."""

    def __init__(self, p: dict[str, np.ndarray]):
        H, A = HIDDEN, p["A"]
        self.emb = np.ascontiguousarray(p["emb"].T)
        half = np.ones((4 * H, 1), np.float32)
        half[: 3 * H] = 0.5  # a logistic gate is a tanh of half its input
        self.M = {d: np.ascontiguousarray(np.concatenate([p[d + "W"], p[d + "U"], p[d + "b"][:, None]], axis=1) * half) for d in "fb"}
        # what each kind leads "none" by, from the states of either direction
        lead = p["O"][1:] - p["O"][0]
        self.O = {"f": np.ascontiguousarray(lead[:, :H]), "b": np.ascontiguousarray(lead[:, H:])}
        self.bias = p["ob"][1:] - p["ob"][0]
        # what a span gains by beginning, going on and ending, over no span there
        unit = lambda v: [int(round(float(x) * UNIT)) for x in v]
        self.start, self.stay, self.end = unit(A[0, 1:] - A[0, 0]), unit(np.diag(A)[1:] - A[0, 0]), unit(A[1:, 0] - A[0, 0])

    def _half(self, d: str, xs: np.ndarray) -> np.ndarray:
        """xs (T, B), read from the top → what the states of one direction add to the leads, (B, kinds, T)."""
        T, B = xs.shape
        H, E, M, O = HIDDEN, EMBED, self.M[d], self.O[d]
        u = np.zeros((E + H + 1, B), np.float32)
        u[-1] = 1
        c, tmp, z = np.zeros((H, B), np.float32), np.empty((H, B), np.float32), np.empty((4 * H, B), np.float32)
        out = np.empty((T, len(O), B), np.float32)
        for t in range(T):
            np.take(self.emb, xs[t], axis=1, out=u[:E], mode="clip")
            np.matmul(M, u, out=z)
            np.tanh(z, out=z)
            s = z[: 3 * H]
            s *= 0.5
            s += 0.5
            np.multiply(c, z[H : 2 * H], out=c)
            np.multiply(z[:H], z[3 * H :], out=tmp)
            c += tmp
            np.tanh(c, out=tmp)
            np.multiply(z[2 * H : 3 * H], tmp, out=u[E : E + H])
            np.matmul(O, u[E : E + H], out=out[t])
        return np.ascontiguousarray(out.transpose(2, 1, 0))

    def window_leads(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """What each kind leads "none" by, (kinds, n), for windows of classes. Each lane begins with its own window in both directions."""
        T, B = max(map(len, parts)), -(-len(parts) // 64) * 64
        ahead, back = np.zeros((T, B), np.uint8), np.zeros((T, B), np.uint8)
        for r, x in enumerate(parts):
            ahead[: len(x), r], back[: len(x), r] = x, x[::-1]
        f, b = self._half("f", ahead), self._half("b", back)
        f += self.bias[:, None]
        return [f[r, :, : len(x)] + b[r, :, len(x) - 1 :: -1] if len(x) < T else f[r] + b[r, :, ::-1] for r, x in enumerate(parts)]

    def leads(self, coded: list[np.ndarray]) -> list[np.ndarray]:
        """What each kind leads "none" by at every character of every text, the windows' overlaps averaged."""
        out: list[np.ndarray] = [np.zeros((len(KINDS), len(c)), np.float32) for c in coded]
        weight: dict[int, np.ndarray] = {}
        jobs = sorted((e - s, k, s, e) for k, c in enumerate(coded) for s, e in windows(len(c)))
        for at in range(0, len(jobs), LANES):
            lot = jobs[at : at + LANES]
            for (n, k, s, e), got in zip(lot, self.window_leads([coded[k][s:e] for _, k, s, e in lot])):
                size = len(coded[k])
                if n == size:
                    out[k] = got
                    continue
                i = np.arange(n, dtype=np.float32)
                w = np.minimum(i + 1 if s else np.float32(WINDOW), n - i if e < size else np.float32(WINDOW))
                total = weight.setdefault(k, np.zeros(size, np.float32))
                # summed as multiples of a power of two, so the order of the windows plays no part
                out[k][:, s:e] += np.rint(got * 64) * w
                total[s:e] += w
        for k, total in weight.items():
            out[k] /= 64 * total
        return out

    def runs(self, lead: np.ndarray) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the spans of the best path over a whole text, by their places."""
        n = lead.shape[1]
        if not n:
            return []
        # whole numbers, which doubles add exactly
        q = np.rint(lead * np.float64(UNIT))
        stay, begin, leave = (np.array(x, np.float64)[:, None] for x in (self.stay, self.start, self.end))
        closed = np.cumsum(q + stay, axis=1)
        # a span [a, b] gains closed[b] - opened[a] - stay
        opened = closed - q - (stay + begin)
        opened[:, :1] += begin
        closed[:, :-1] += leave
        best_end = np.maximum.accumulate(closed[:, ::-1], axis=1)[:, ::-1]
        inside = (best_end - np.minimum.accumulate(opened, axis=1) > stay).any(axis=0)
        if not inside.any():
            return []
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        return [r for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) for r in self._path(q[:, a:b].T.tolist(), a, a == 0, b == n)]

    def _path(self, q: list[list[int]], at: int, first: bool, last: bool) -> list[tuple[int, int, int]]:
        """The spans of the best path over some places with none before and after (unless the text begins or ends there); ties go to "none"."""
        kinds, start, stay, end = range(len(KINDS)), self.start, self.stay, self.end
        none, own, opened = 0, [None] * len(KINDS), [0] * len(KINDS)
        closed_by: list[tuple[int, int] | None] = []  # at each place: (kind, start) of a span that ends before it, where "none" is best reached so
        starts: list[list[int]] = []
        for t, row in enumerate(q):
            came, least = None, none
            for k in kinds:
                if own[k] is not None and own[k] + end[k] > least:
                    came, least = (k, opened[k]), own[k] + end[k]
            for k in kinds:
                fresh = none + (0 if first and t == 0 else start[k])
                if own[k] is not None and own[k] + stay[k] > fresh:
                    own[k] += stay[k] + row[k]
                else:
                    own[k], opened[k] = fresh + row[k], t
            none = least
            closed_by.append(came)
            starts.append(opened.copy())
        t, out = len(q) - 1, []
        tail, final = None, none
        for k in kinds:
            v = own[k] + (0 if last else end[k])
            if v > final:
                tail, final = (k, opened[k]), v
        while True:
            if tail is not None:
                k, a = tail
                out.append((k, at + a, at + t + 1))
                t = a - 1
            # the place before is "none": go back to where it was last reached from a span
            while t >= 0 and closed_by[t] is None:
                t -= 1
            if t < 0:
                return out[::-1]
            tail, t = closed_by[t], t - 1


def windows(n: int, window: int = WINDOW, stride: int = STRIDE) -> list[tuple[int, int]]:
    """(start, end) of overlapping windows that cover n characters."""
    if n <= window:
        return [(0, n)] if n else []
    starts = list(range(0, n - window, stride)) + [n - window]
    return [(s, s + window) for s in starts]


_LOOSE_MAIL = re.compile(r"[A-Za-z0-9._%+-]+\s*(?:@|[\[(]\s*at\s*[\])]|\sat\s)\s*[A-Za-z0-9-]+(?:\s*(?:\.|[\[(]\s*(?:dot|\.)\s*[\])]|\sdot\s)\s*[A-Za-z0-9-]+)+", re.I)
_LOOSE_IP = re.compile(r"[0-9]{1,3}(?:\s*[\[(]?\s*\.\s*[\])]?\s*[0-9]{1,3}){3}")
_LOOSE_PHONE = re.compile(r"\+?\(?[0-9]{1,4}(?:[\s().-]+[0-9]{2,})+")
_LOOSE_CARD = re.compile(r"[0-9](?:[\x20./-]?[0-9]){12,18}")
_WORDISH = re.compile(r"[A-Za-z0-9_]")


def form(text: str, kind: int, s: int, e: int) -> tuple[int, int] | None:
    """The part of a tagged run that has the form of its kind; None if none has."""
    s, e = max(0, s - 2), min(len(text), e + 2)
    part = text[s:e]
    m = (_LOOSE_MAIL, _LOOSE_IP, _LOOSE_CARD, _LOOSE_PHONE)[kind].search(part)
    if not m:
        return None
    a, b, got = s + m.start(), s + m.end(), m[0]
    lone = (a == 0 or not _WORDISH.match(text[a - 1])) and (b == len(text) or not _WORDISH.match(text[b]))
    if not lone:
        return None
    d = _digits(got)
    if kind == 0 and not ("@" in got or re.search(r"dot|[\[(]", got, re.I)):
        return None
    if kind == 1 and any(int(x) > 255 for x in re.findall("[0-9]+", got)):
        return None
    if kind == 2 and not (13 <= len(d) <= 19 and luhn(d)):
        return None
    if kind == 3 and not (9 <= len(d) <= 15 and (len(d) >= 10 or got.lstrip()[0] in "+(")):
        return None
    return a, b


def all_spans(text: str, runs: list[tuple[int, int, int]], base: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """Base spans, and tagged runs of the right form that touch none of them nor each other."""
    out = [list(x) for x in base]
    taken = sorted(x for k in base for x in k)
    for kind, s, e in runs:
        got = form(text, kind, s, e)
        if got and not any(a < got[1] and got[0] < b for a, b in taken):
            out[kind].append(got)
            taken.append(got)
    return [sorted(x) for x in out]


def spelled(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, own in zip(KINDS, spans) for s, e in own)


def found(docs: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans of every row."""
    p = weights or model()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(p)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 1024):
                b = whole.slice(at, 1024)
                texts = [t or "" for t in b.column(1).to_pylist()]
                tagged = [tagger.runs(x) for x in tagger.leads([classes(t) for t in texts])]
                base = [base_spans(t) for t in texts]
                digest = [hashlib.sha256(spelled(x).encode()).hexdigest() for x in base]
                more = [spelled(all_spans(t, g, x)) for t, g, x in zip(texts, tagged, base)]
                counts = [pa.array([len(x[k]) for x in base], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array(digest, pa.string()), pa.array(more, pa.string())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    got = docs.select("doc_id", "text")
    kind = got.schema["doc_id"].dataType.simpleString()
    return got.mapInArrow(rows, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
