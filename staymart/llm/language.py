"""Language identification by error-correcting output codes.

Every language has a codeword. A binary classifier per bit, naive Bayes over hashed letter
n-grams, tells which half of the languages a text belongs to. Decoding takes the language
whose codeword loses least, each bit's loss weighted by how well its classifier does on the
sample; a small lead over the second best is flagged as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from staymart.llm.common import held_out, scan
from staymart.llm.trees import sigmoid

BUCKETS, ORDERS = 1 << 13, (1, 2, 3)
#: Documents per language for fitting, about, at most.
MOST_PER_LANGUAGE = 3_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams of lower-cased letters; None if there is no letter.

    All else is a blank; n-grams reach over one blank, so ends of words count.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    if not is_letter.any():
        return None
    codes = np.where(is_letter, codes, 32).astype(np.uint64)
    codes = codes[np.append(True, is_letter[1:] | is_letter[:-1])]
    codes = np.concatenate([[np.uint64(32)], codes, [np.uint64(32)]])
    total = np.zeros(BUCKETS, np.int64)
    for n in ORDERS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        total += np.bincount((h >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS)
    return total


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 per language. All ways to halve up to seven languages; beyond that,
    of some random codes the one whose rows lie farthest apart."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        ways = np.arange(1, 2 ** (n - 1))
        return np.array([[-1 if (w >> k) & 1 else 1 for w in ways] for k in range(n)], float)
    rng, best, apart = np.random.default_rng(11), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        least = ((code.shape[1] - code @ code.T) / 2 + np.eye(n) * n * 99).min()
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class Languages:
    names: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    scale: np.ndarray  # per bit: log odds = scale * evidence + shift
    shift: np.ndarray
    trust: np.ndarray  # per bit

    def evidence(self, counts: np.ndarray) -> np.ndarray:
        """Mean log ratio per n-gram, so that long texts are not more certain than seen."""
        return counts @ self.weights / max(1, counts.sum())

    def decode(self, evidence: np.ndarray) -> tuple[str, float, bool]:
        margin = self.code * (self.scale * evidence + self.shift)
        loss = np.logaddexp(0, -margin) @ self.trust / self.trust.sum()
        order = np.argsort(loss, kind="stable")
        share = np.exp(-len(self.trust) / 2 * (loss - loss[order[0]]))
        lead = loss[order[1]] - loss[order[0]] if len(order) > 1 else 1.0
        return self.names[order[0]], float(1 / share.sum()), bool(lead < 0.1)


def fit_languages(docs: DataFrame, most: int = MOST_PER_LANGUAGE) -> Languages | None:
    """Fit on about ``most`` documents per language outside the held-out quarter.

    The sample is a fixed range of a hash of the id. What comes to the driver is a count per
    language, sums of n-gram counts and a few numbers per sampled document. None if no
    document has a language.
    """
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        "doc_id", "lang", "text"
    )
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    names = sorted(sizes)
    bound = F.create_map(*[F.lit(x) for k in names for x in (k, int(1e6 * min(1.0, most / sizes[k])))])
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < bound[F.col("lang")]
    sample = train.where(chosen).repartition(8)

    def sums(batches):
        import pyarrow as pa

        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                counts = grams(text.as_py())
                if counts is not None:
                    total[lang] = total.get(lang, 0) + counts
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([x.tolist() for x in total.values()], pa.list_(pa.int64()))],
            ["lang", "counts"],
        )

    counts = np.zeros((len(names), BUCKETS))
    for lang, own in sample.mapInArrow(sums, "lang string, counts array<long>").collect():
        counts[names.index(lang)] += own
    code = codewords(len(names))
    weights = np.zeros((BUCKETS, code.shape[1]))
    shares = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))  # languages weigh alike
    for b in range(code.shape[1]):
        sides = [shares[code[:, b] == s].sum(axis=0) + 1e-7 for s in (1, -1)]
        weights[:, b] = np.log(sides[0] / sides[0].sum()) - np.log(sides[1] / sides[1].sum())
    bits = code.shape[1]
    model = Languages(names, code, weights, np.ones(bits), np.zeros(bits), np.ones(bits))

    def evidence(part):
        found = [(lang, grams(text)) for lang, text in zip(part["lang"], part["text"])]
        found = [(lang, model.evidence(g).tolist()) for lang, g in found if g is not None]
        return {"lang": [x[0] for x in found], "evidence": [x[1] for x in found]}

    seen = scan(sample, ["lang", "text"], evidence, "lang string, evidence array<double>").collect()
    if seen and len(names) > 1:
        x = np.array([r[1] for r in seen])
        y = code[[names.index(r[0]) for r in seen]]
        for b in range(bits):
            model.scale[b], model.shift[b] = platt(x[:, b], y[:, b])
            wrong = ((model.scale[b] * x[:, b] + model.shift[b]) * y[:, b] <= 0).mean()
            model.trust[b] = max(0.05, 1 - 2 * wrong)
    return model


def platt(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton's method with a small ridge."""
    spread = x.std() or 1.0
    a = np.column_stack([x / spread, np.ones(len(x))])
    w, t = np.zeros(2), (y > 0).astype(float)
    for _ in range(steps):
        p = sigmoid(a @ w)
        h = (a * (p * (1 - p))[:, None]).T @ a + np.eye(2) * 0.5
        w = w - np.linalg.solve(h, a.T @ (p - t) + 0.5 * w)
    return float(w[0] / spread), float(w[1])


def languages_of(docs: DataFrame, model: Languages | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` per row of ``docs``.

    Only the text is read. Null texts and texts without a letter, and all if there is no
    model, are ``und`` with score 0. Repeated rows come back each; an empty table gives none.
    """

    def of_slice(part):
        rows = []
        for text in part["text"]:
            counts = grams(text) if model else None
            rows.append((UNKNOWN, 0.0, True) if counts is None else model.decode(model.evidence(counts)))
        return {"doc_id": part["doc_id"]} | {
            k: [r[i] for r in rows] for i, k in enumerate(["lang_pred", "score", "ambiguous"])
        }

    out = scan(docs, ["doc_id", "text"], of_slice, "doc_id long, lang_pred string, score double, ambiguous boolean")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
