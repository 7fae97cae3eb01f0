"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the 2-, 3- and 4-byte windows of the lower-cased text in which everything but letters and bytes
from 0x80 up is a blank; each is hashed to one of ``BUCKETS`` embeddings.  A text's vector is their average over
the whole text.  The model is trained by stochastic gradient descent in numpy on a bounded sample: about
``rows`` labelled rows in all, the same number of each of up to ``MOST_LANGS`` languages, chosen by a hash of the id; a row sends
its counted buckets (at most ``BUCKETS``), not its text.  A fifth of the sample calibrates: it sets the softmax
temperature and the limits below which a text is rejected.  They are two, each half of what all but a small share of the
right held-out rows reach (a text half of which is foreign still stays): the log odds of its language against the
others, and its mean log ratio of subword frequencies in the sample to equal ones, which also tells an unlearned language
where one or two are learned and the softmax cannot.  A text that reaches twice the second limit is not held to the first.  As the layer is linear, prediction adds up
embedding-times-weight rows, computed once.

Defined cases: null text, and text without a letter, is ``und`` with score 0 and rejected; so is every text
if there are no labelled rows.  Rows with a null id are predicted but not learned from.  Equal scores go to the
first language in order.  Other columns, of any name, pass through ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, release_memory, slices, stored, text_buffers

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
DIM = 16
SAMPLE_ROWS = 4000
REJECT_SHARE = 0.001  # of right calibration rows that may fall below twice a limit
UNSEEN = 0.1  # share of equal frequencies in the subword frequencies
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (languages + 1, buckets): embedding times weight; last, the log ratio of frequencies
    bias: np.ndarray
    temperature: float
    least_odds: float
    least_ratio: float


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, row_ends): all subword buckets, row after row, and where each row's end."""
    low = _LETTERS[data].astype(np.uint32)
    n = len(low)
    parts, begins = [], []
    last = np.zeros(n, np.int64)
    last[:] = np.repeat(offsets[1:], np.diff(offsets))
    for size in SIZES:
        if n < size:
            continue
        value = low[:n - size + 1].copy()
        for k in range(1, size):
            value = (value << np.uint32(8)) | low[k:n - size + 1 + k]
        # inside one text, and not starting with two blanks
        inside = (np.arange(n - size + 1) + size <= last[:n - size + 1]) & ((low[:n - size + 1] != 32) | (low[1:n - size + 2] != 32))
        at = np.flatnonzero(inside)
        h = value[at] * np.uint32(0x9E3779B1) + np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        parts.append((h >> np.uint32(17)).astype(np.int64) & (BUCKETS - 1))
        begins.append(np.searchsorted(at, offsets))
    return parts, begins


def _row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.append(0.0, np.cumsum(values, dtype=np.float64))
    return total[at[1:]] - total[at[:-1]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = text_buffers(b.column(1))
        for i in range(b.num_rows):
            parts, _ = subwords(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
            counts = np.bincount(np.concatenate(parts), minlength=BUCKETS) if parts else np.zeros(BUCKETS, np.int64)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, 1), b.column(2).slice(i, 1), pa.array([at.astype("<u2").tobytes()], pa.binary()),
                 pa.array([(counts[at] / max(1, counts.sum())).astype("<f4").tobytes()], pa.binary())],
                names=["lang", "order", "at", "share"])


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS) -> list:
    """About ``rows`` labelled rows, evenly over the languages, as counted buckets."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~held_out(F.col(id_col)))
    known = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.lit(17), F.col(id_col)).alias("order"))
    sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-sizes")
    langs = sizes.count()
    if not langs:
        return []
    share = F.pmod("order", F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.join(sizes, "lang").where(share * F.col("n") < rows / langs)
    return (chosen.select("lang", "text", "order").mapInArrow(_count, "lang string, order long, at binary, share binary")
            .collect())  # about ``rows`` rows of at most 6 * BUCKETS bytes


def train(rows: list, dim: int = DIM, epochs: int = 12, batch: int = 16, rate: float = 20.0, seed: int = 7) -> Model | None:
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: (r.order, r.lang))
    langs = sorted({r.lang for r in rows})
    xs = [(np.frombuffer(r.at, "<u2").astype(np.int64), np.frombuffer(r.share, "<f4").astype(np.float64)) for r in rows]
    ys = np.array([langs.index(r.lang) for r in rows])
    rng = np.random.default_rng(seed)
    checked = np.arange(len(rows)) % 5 == 4 if len(rows) >= 50 else np.zeros(len(rows), bool)
    fit = np.flatnonzero(~checked)
    emb = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    out, bias = rng.uniform(-1, 1, (dim, len(langs))), np.zeros(len(langs))
    steps, done = epochs * max(1, -(-len(fit) // batch)), 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for k in range(0, len(fit), batch):
            some = fit[k:k + batch]
            lr = rate * (1 - done / steps)
            done += 1
            vec = np.stack([v @ emb[a] if len(a) else np.zeros(dim) for a, v in (xs[i] for i in some)])
            p = _softmax(vec @ out + bias)
            p[np.arange(len(some)), ys[some]] -= 1
            p /= len(some)
            back = p @ out.T
            out -= 0.05 * lr * vec.T @ p
            bias -= 0.01 * lr * p.sum(axis=0)
            for i, g in zip(some, back):
                a, v = xs[i]
                emb[a] -= lr * v[:, None] * g  # the buckets of one row are distinct
    table = emb @ out
    test = np.flatnonzero(checked) if checked.any() else np.arange(len(rows))
    logits = np.stack([v @ table[a] if len(a) else np.zeros(len(langs)) for a, v in (xs[i] for i in test)]) + bias
    temps = np.geomspace(0.05, 20, 61)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(test)), ys[test]] + 1e-12).mean() for t in temps]
    t = float(temps[int(np.argmin(loss))])
    p = _softmax(logits / t)
    right = p.argmax(axis=1) == ys[test]
    seen = np.zeros(BUCKETS)
    for a, v in (xs[i] for i in fit):
        seen[a] += v
    ratio = np.log((1 - UNSEEN) * seen / max(seen.sum(), 1e-300) * BUCKETS + UNSEEN)
    ratios = np.array([v @ ratio[a] for a, v in (xs[i] for i in test)])
    table = np.concatenate([table.T, ratio[None]]).astype(np.float32)
    return Model(langs, np.ascontiguousarray(table), bias, t, _limit(_odds(logits / t)[right]), _limit(ratios[right]))


def _limit(values: np.ndarray) -> float:
    """Half of the value that all but ``REJECT_SHARE`` reach."""
    if not len(values) or np.isinf(values).all():
        return -np.inf
    least = float(np.quantile(values, REJECT_SHARE))
    return least / 2 if least > 0 else least


def _odds(z: np.ndarray) -> np.ndarray:
    """Log odds of each row's greatest against all others, infinite if there are none."""
    rest = np.sort(z, axis=1)
    top, rest = rest[:, -1], rest[:, :-1]
    if not rest.shape[1]:
        return np.full(len(z), np.inf)
    return top - rest[:, -1] - np.log(np.exp(rest - rest[:, -1:]).sum(axis=1))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with three more columns, whose names are returned: lang_pred, score, rejected."""
    names = fresh(docs.columns, "lang_pred", "score", "rejected")
    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.withColumns(dict(zip(names, (F.lit("und"), F.lit(0.0), F.lit(True))))), names
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, sure boolean")
    def ask(text: pa.Array) -> pa.Array:
        m = shared.value
        data, offsets = text_buffers(text)
        best, score, sure = [], [], []
        for i, j in slices(offsets):
            parts, begins = subwords(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            count = sum((np.diff(at) for at in begins), np.zeros(j - i, np.int64))
            z = np.stack([sum((_row_sums(row[p], at) for p, at in zip(parts, begins)), np.zeros(j - i)) for row in m.table], axis=1)
            z /= np.maximum(count, 1)[:, None]
            z, ratio = (z[:, :-1] + m.bias) / m.temperature, z[:, -1]
            p = _softmax(z)
            best.append(p.argmax(axis=1))
            score.append(p.max(axis=1))
            usual = max(m.least_ratio, 2 * m.least_ratio)  # a text with the usual subwords stays, however near two languages are
            sure.append((ratio >= m.least_ratio) & ((_odds(z) >= m.least_odds) | (ratio >= usual)))
        best, score = (np.concatenate(x) if x else np.zeros(0) for x in (best, score))
        sure = np.concatenate(sure) if sure else np.zeros(0, bool)
        lang = pa.array([m.langs[int(k)] for k in best], pa.string())
        release_memory()
        return pa.StructArray.from_arrays([lang, pa.array(score, pa.float64()), pa.array(sure)],
                                          names=["lang", "score", "sure"])

    said, = fresh(docs.columns + names, "said")
    out = docs.withColumn(said, ask(F.col(text_col)))
    out = out.withColumns({names[0]: F.when(letter, F.col(said)["lang"]).otherwise("und"),
                           names[1]: F.when(letter, F.col(said)["score"]).otherwise(0.0),
                           names[2]: ~(letter & F.col(said)["sure"])})
    return out.drop(said), names


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> Model | None:
    return train(sample(docs, id_col, text_col, lang_col, rows))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language is known well enough, with the columns of ``docs``."""
    out, (_, _, rejected) = predict(docs, fit(docs, id_col, text_col, lang_col), text_col)
    return out.where(~F.col(rejected)).select(*[F.col(f"`{c}`") for c in docs.columns])
