"""URL filter: rules by host and path, else a logistic regression on hashed character n-grams.

Host and path are cut out with column functions.  Rules name a domain and a path
beginning; a rule holds for the domain and all its subdomains, and the longest
rule that holds wins.  Where no rule holds, the model decides: it is trained in
numpy from ``LABELLED``, a small table of labelled addresses (a bounded, fixed
sample), on character n-grams of the host (with its ends marked) and of the
path, hashed to ``BUCKETS`` weights.

Edge cases: a null url or one without ``://`` has an empty host and path and is
judged by the model as such (no n-gram: the bias decides, which allows);
repeated rows give repeated result rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, SIZES = 1 << 14, (3, 4, 5)

#: (verdict, domain, path beginning); the rule's own spelling is domain + path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))

# What unwanted sites trade in, and how they praise it; ordinary sites' words and companions.
_TRADE = "casino poker slots bets betting pills meds viagra loans crypto porn adult xxx dating spam linkfarm ads tracker popups prizes lottery replica rolex diet".split()
_PRAISE = "free cheap win best fast hot bonus online buy farm track click deals now top".split()
_WORDS = (
    "library museum weather city university research garden cookbook history railway news bakery hospital orchestra therapy theory theatre anthology mathematics "
    "kitchen station teaching interest onward ending rental heritage reading thorn ontario shelter ingredient orion hearth atlas standard blend relation other together"
).split()
_COMPANIONS = "the house society north lab press room works notes road club".split()


def _names(words: list[str], others: list[str]) -> list[str]:
    """Each word with four companions, before or behind it, and alone."""
    out = []
    for i, w in enumerate(words):
        out.append(w)
        for j in range(4):
            o = others[(4 * i + j) % len(others)]
            out.append(f"{w}-{o}" if (i + j) % 2 else f"{o}-{w}")
    return out


def labelled(seed: int = 1, without: frozenset[str] = frozenset()) -> list[tuple[str, str, int]]:
    """(host, path, label) with label 1 for addresses to block; no name holds a word of ``without``.

    Names of both kinds and made-up plain names stand in the same hosts and
    paths, drawn by a seeded generator, so that these tell nothing.  Addresses
    without host and path are not to be blocked.
    """
    bad, good = (_names([w for w in words if w not in without], others) for words, others in ((_TRADE, _PRAISE), (_WORDS, _COMPANIONS)))
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    tops, fronts, paths = ("com", "org", "net", "example.com", "example.org", "example.net"), ("", "www.", "m.", "blog."), ("/en/{}", "/fr/{}/", "/de/{}.html", "/es/{}", "/", "/index.html")
    address = lambda name, label: (f"{pick(fronts)}{name}.{pick(tops)}", pick(paths).format(int(rng.integers(1000))), label)
    parts = [c + v + e for c in ("", "b", "c", "d", "g", "l", "m", "n", "r", "s", "t", "th", "wh") for v in "aeiou" for e in ("", "n", "r", "s", "nt")]
    plain = ["".join(pick(parts) for _ in range(2 + k % 2)) for k in range(400)]
    rows = [address(name, label) for label, names in ((1, bad * 4), (0, good * 3 + plain)) for name in names]
    for i, name in enumerate(good):  # addresses whose path alone is bad
        rows.append((f"{name}.org", f"/{bad[i % len(bad)]}/offer", 1))
        rows.append((f"{name}.org", f"/{good[-i - 1]}/page", 0))
    return rows + [("", "", 0)] * 60


def grams(texts: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(text's number, bucket) of the character n-grams of all texts at once."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    inside = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
    whose, where = [], []
    for n in SIZES:
        m = max(0, len(points) - n + 1)
        h = np.full(m, seed * 16 + n, np.uint32)
        for k in range(n):
            h = (h ^ points[k : k + m]) * np.uint32(16777619)
            h ^= h >> np.uint32(13)
        fits = inside[:m] + n <= size[owner[:m]]
        whose.append(owner[:m][fits])
        where.append((h[fits] * np.uint32(2654435769) >> np.uint32(18)).astype(np.int64))
    return np.concatenate(whose), np.concatenate(where)


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value): counts of the n-grams of each host (ends marked) and path, which are hashed apart, at length one."""
    h = grams([f"^{x}$" if x else "" for x in hosts], 1)
    p = grams([x if len(x) > 1 else "" for x in paths], 2)
    key, count = np.unique(np.concatenate([h[0], p[0]]) * BUCKETS + np.concatenate([h[1], p[1]]), return_counts=True)
    row = key // BUCKETS
    norm = np.sqrt(np.bincount(row, count.astype(float) ** 2, len(hosts)))
    return row, key % BUCKETS, count / norm[row]


def train(rows: list[tuple[str, str, int]] | None = None, steps: int = 1500, rate: float = 1.0, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weights, bias) of the regression, by full-batch gradient steps."""
    rows = rows or labelled()
    at, where, value = features([r[0] for r in rows], [r[1] for r in rows])
    y = np.array([r[2] for r in rows], float)
    w, b = np.zeros(BUCKETS), 0.0
    speed, speed_b = np.zeros(BUCKETS), 0.0
    for _ in range(steps):
        z = np.bincount(at, w[where] * value, len(rows)) + b
        d = (1 / (1 + np.exp(-z)) - y) / len(rows) * 20
        speed = 0.9 * speed - rate * (np.bincount(where, d[at] * value, BUCKETS) + l2 * w)
        speed_b = 0.9 * speed_b - rate * 0.05 * d.sum()
        w, b = w + speed, b + speed_b
    return w, b


_TRAINED: list[tuple[np.ndarray, float]] = []


def model() -> tuple[np.ndarray, float]:
    if not _TRAINED:
        _TRAINED.append(train())
    return _TRAINED[0]


def spam_scores(hosts: list[str], paths: list[str], w: np.ndarray, b: float) -> np.ndarray:
    """The model's probability that each address is to be blocked; an address without n-grams has that of the bias."""
    row, bucket, value = features(hosts, paths)
    return 1 / (1 + np.exp(-(np.bincount(row, w[bucket] * value, len(hosts)) + b)))


def lowered(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ruled(rules: tuple = RULES) -> tuple[Column, Column]:
    """The winning rule's spelling and verdict, by host and path columns; null where none holds."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, domain, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        holds = ((F.col("host") == domain) | F.col("host").endswith("." + domain)) & F.col("path").startswith(begin)
        rule, verdict = F.when(holds, domain + begin).otherwise(rule), F.when(holds, what).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, rules: tuple = RULES, threshold: float = 0.55) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's probability that the address is to be blocked) of every row."""
    w, b = model()
    url = pages.select("page_id", F.col("url"))
    rest = url.withColumn("rest", F.coalesce(F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END"), F.lit("")))
    host = rest.withColumn("host", F.regexp_extract("rest", r"^([^/?#]*)", 1))
    cut = host.withColumn("path", F.regexp_extract(F.expr("substring(rest, length(host) + 1)"), r"^([^?#]*)", 1)).select("page_id", lowered(F.col("host")).alias("host"), "path")
    kind = cut.schema["page_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            got = spam_scores(x.column("host").to_pylist(), x.column("path").to_pylist(), w, b)
            yield pa.RecordBatch.from_arrays([*x.columns, pa.array(got, pa.float64())], [*x.schema.names, "score"])

    scored = cut.mapInArrow(rows, f"page_id {kind}, host string, path string, score double")
    rule, verdict = ruled(rules)
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
