"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens are words; two labels, clean and toxic, form the chain. A token's features are the
hashed word, its beginnings and its ending. Token labels for training come from labelled
documents: in a toxic document, a token is labelled toxic if one of its features stands far
more often in toxic than in clean documents; clean documents have clean tokens only.
Forward-backward gives each token's marginal; a small logistic layer, fitted on training
documents that the field has not seen, turns a document's marginals into its score.

A null or empty text has no token; it gets the score of a document without any sign, as
does every text when there was nothing to train on (then 0.5). Repeated rows are answered one by one; columns but
the key and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import Rolling, code_points, fold, raw_bytes, runs, slices, word_flags

#: Training takes about this many labelled rows of either class at most, by a hash of the key,
#: among those whose text has at most TRAIN_CHARS characters.
SAMPLE = 3000
TRAIN_CHARS = 16_000
BUCKET_BITS = 20
#: A feature marks a token as toxic in a toxic document if it is in so many toxic documents
#: and its share there is so many times its share in clean ones.
MARK_DOCS, MARK_RATIO = 4, 20.0
PREFIXES = (4, 5, 6, 7, 8)
CHUNK = 64
EPOCHS = 12
RATE = 0.3
L2 = 1e-4
SPAN_AT = 0.5


@dataclass
class ToxicField:
    """``weights``: log-potential of toxic against clean by feature bucket. ``moves``:
    log-potentials from clean and toxic to clean and toxic. ``layer``: of the document score."""

    weights: np.ndarray
    moves: np.ndarray
    layer: np.ndarray


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Feature buckets (tokens by features), token starts, ends and text bounds."""
    lower = fold(data)
    starts, ends, firsts = runs(word_flags(data), offsets)
    rolling, shift = Rolling(lower), np.uint64(64 - BUCKET_BITS)
    found = [rolling(starts, ends)]
    for k in PREFIXES:
        found.append(rolling(starts, np.minimum(starts + k, ends)) + np.uint64(k))
    found.append(rolling(np.maximum(ends - 4, starts), ends) + np.uint64(99))
    mult = np.uint64(0x9E3779B97F4A7C15)
    return np.stack([((x * mult) >> shift).astype(np.int32) for x in found], axis=1), starts, ends, firsts


class _Chunks:
    """Rows of CHUNK tokens; a text takes whole rows."""

    def __init__(self, firsts: np.ndarray) -> None:
        sizes = np.diff(firsts)
        self.rows = -(-sizes // CHUNK)
        self.first_row = np.concatenate([[0], np.cumsum(self.rows)])
        within = np.arange(firsts[-1]) - np.repeat(firsts[:-1], sizes)
        self.place = np.repeat(self.first_row[:-1], sizes) * CHUNK + within
        self.count = int(self.first_row[-1])
        self.valid = np.zeros(self.count * CHUNK, dtype=bool)
        self.valid[self.place] = True
        self.valid = self.valid.reshape(self.count, CHUNK)

    def lay(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.count * CHUNK)
        out[self.place] = values
        return out.reshape(self.count, CHUNK)

    def carried(self, backwards: bool) -> list[np.ndarray]:
        """Rows that take from their neighbour, nearest to the border first."""
        out = []
        for k in range(1, int(self.rows.max()) if len(self.rows) else 0):
            more = self.rows > k
            out.append(self.first_row[1:][more] - 1 - k if backwards else self.first_row[:-1][more] + k)
        return out


def _pass(e, valid, start, step, carried, towards):
    """Carry a ratio through every row: first as a product of 2x2 maps by row, then from row
    to row of a text, then token by token."""
    order = range(CHUNK) if towards > 0 else range(CHUNK - 1, -1, -1)
    incoming = np.full(len(e), start)
    if carried:
        m = [np.ones(len(e)), np.zeros(len(e)), np.zeros(len(e)), np.ones(len(e))]
        for t in order:
            p, q, r, s = step(e[:, t])
            new = [p * m[0] + q * m[2], p * m[1] + q * m[3], r * m[0] + s * m[2], r * m[1] + s * m[3]]
            size = new[0] + new[1] + new[2] + new[3]
            ok = valid[:, t]
            m = [np.where(ok, x / size, y) for x, y in zip(new, m, strict=True)]
        for rows in carried:
            x = incoming[rows - towards]
            a, b, c, d = (y[rows - towards] for y in m)
            incoming[rows] = (a * x + b) / (c * x + d)
    out = np.empty_like(e)
    x = incoming
    for t in order:
        p, q, r, s = step(e[:, t])
        after = np.where(valid[:, t], (p * x + q) / (r * x + s), x)
        # forwards the ratio after the token counts, backwards the one before it is reached
        out[:, t] = after if towards > 0 else x
        x = after
    return out


def forward_backward(scores: np.ndarray, chunks: _Chunks, moves: np.ndarray):
    """(emission ratios, forward ratios, backward ratios), toxic over clean, by row and token."""
    e = np.exp(np.clip(scores, -30, 30))
    (cc, ct), (tc, tt) = np.exp(moves)
    ahead = _pass(e, chunks.valid, 0.0, lambda x: (x * tt, x * ct, tc, cc), chunks.carried(False), 1)
    back = _pass(e, chunks.valid, 1.0, lambda x: (x * tt, tc, x * ct, cc), chunks.carried(True), -1)
    return e, ahead, back


def marginals(scores: np.ndarray, firsts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Each token's chance of being toxic, given the log-potentials of the tokens."""
    chunks = _Chunks(firsts)
    _, ahead, back = forward_backward(chunks.lay(scores), chunks, moves)
    odds = (ahead * back).reshape(-1)[chunks.place]
    return odds / (1 + odds)


def _summary(chance: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Per document: log-odds of the most toxic token, sum of marginals, and a constant."""
    sizes = np.diff(firsts)
    out = np.zeros((len(sizes), 3))
    out[:, 0], out[:, 2] = -12.0, 1.0
    full = np.flatnonzero(sizes)
    if len(full):
        top = np.clip(np.maximum.reduceat(chance, firsts[full]), 6e-6, 1 - 6e-6)
        out[full, 0] = np.log(top / (1 - top))
        out[full, 1] = np.log1p(np.add.reduceat(np.where(chance >= 0.1, chance, 0), firsts[full]))
    return out


def learn_toxicity(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label", sample: int = SAMPLE,
) -> ToxicField:
    """Train on rows with a text and a label of 0 or 1."""
    known = labelled.select(
        F.xxhash64(key).alias("place"), F.col(text).alias("text"), F.col(label).cast("int").alias("label")
    ).where(f"text is not null and label in (0, 1) and length(text) <= {TRAIN_CHARS}")
    sizes = {r["label"]: r["rows"] for r in known.groupBy("label").agg(F.count("*").alias("rows")).collect()}
    share = F.col("place").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    picks = [
        known.where(F.col("label") == k).where(share * n < sample).orderBy("place", F.xxhash64("text")).limit(2 * sample) for k, n in sorted(sizes.items())
    ]
    if len(picks) < 2:
        return ToxicField(np.zeros(1 << BUCKET_BITS, np.float32), np.zeros((2, 2)), np.zeros(3))
    rows = {(r["place"], r["text"]): r["label"] for r in picks[0].union(picks[1]).collect()}
    chosen = sorted(rows)
    labels = np.array([rows[x] for x in chosen])
    kept = np.bincount(labels, minlength=2)
    weight = np.array([sizes[0] / max(1, kept[0]), sizes[1] / max(1, kept[1])])
    return train([x for _, x in chosen], labels, weight / weight.max())


def _marked(features: np.ndarray, firsts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Token labels from document labels."""
    seen = np.zeros((2, 1 << BUCKET_BITS))
    for i, toxic in enumerate(labels):
        seen[toxic][np.unique(features[firsts[i] : firsts[i + 1]])] += 1
    share = (seen + np.array([[1.0], [0.0]])) / np.maximum(1, np.bincount(labels, minlength=2))[:, None]
    mark = (seen[1] >= MARK_DOCS) & (share[1] >= MARK_RATIO * share[0])
    return mark[features].any(axis=1) & np.repeat(labels == 1, np.diff(firsts))


def train(texts: list[str], labels: np.ndarray, weight: np.ndarray) -> ToxicField:
    """Fit the field on three quarters of the texts, the document layer on the rest."""
    # slice by slice, so that only the feature table is as large as the sample
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    parts = [(t[0], np.diff(t[3])) for t in (_tokens(*raw_bytes(x.column("text"))) for x in slices(batch, "text"))]
    features = np.concatenate([np.zeros((0, len(PREFIXES) + 2), np.int32), *(f for f, _ in parts)])
    firsts = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in parts]))]).astype(np.int64)
    fit = np.arange(len(texts)) % 4 != 0
    y = _marked(features[np.repeat(fit, np.diff(firsts))], np.concatenate([[0], np.cumsum(np.diff(firsts)[fit])]), labels[fit])
    own = features[np.repeat(fit, np.diff(firsts))]
    # windows of a chunk: all with a toxic token, and three times as many others
    windows = np.arange(0, len(y) - CHUNK + 1, CHUNK)
    toxic = np.add.reduceat(y, windows) > 0 if len(windows) else np.zeros(0, bool)
    rng = np.random.default_rng(11)
    clean = rng.permutation(windows[~toxic])[: max(2000, 3 * int(toxic.sum()))]
    windows = np.concatenate([windows[toxic], clean])
    weights, square = np.zeros(1 << BUCKET_BITS), np.full(1 << BUCKET_BITS, 1e-6)
    moves, moved = np.zeros((2, 2)), np.full((2, 2), 1e-6)
    span = np.arange(CHUNK)
    for _ in range(EPOCHS if toxic.any() else 0):
        rng.shuffle(windows)
        for at in range(0, len(windows), 512):
            part = windows[at : at + 512, None] + span
            f, truth = own[part], y[part]
            chunks = _Chunks(np.arange(len(part) + 1) * CHUNK)
            e, ahead, back = forward_backward(weights[f].sum(axis=2), chunks, moves)
            chance = ahead * back / (1 + ahead * back)
            slope = (chance - truth) / len(part)
            bucket, inverse = np.unique(f.reshape(-1), return_inverse=True)
            step = np.bincount(inverse, np.repeat(slope.reshape(-1), f.shape[2])) + L2 * weights[bucket]
            square[bucket] += step**2
            weights[bucket] -= RATE * step / np.sqrt(square[bucket])
            moves, moved = _move(moves, moved, e, ahead, back, truth)
    model = ToxicField(weights.astype(np.float32), moves, np.zeros(3))
    rest = ~fit
    chance = marginals(
        weights[features[np.repeat(rest, np.diff(firsts))]].sum(axis=1),
        np.concatenate([[0], np.cumsum(np.diff(firsts)[rest])]), moves,
    )
    seen = _summary(chance, np.concatenate([[0], np.cumsum(np.diff(firsts)[rest])]))
    model.layer = _logistic(seen, labels[rest], weight[labels[rest]])
    return model


def _move(moves, moved, e, ahead, back, truth):
    """One step for the potentials between neighbours, from expected and given pairs."""
    (cc, ct), (tc, tt) = np.exp(moves)
    r, u = ahead[:, :-1], e[:, 1:] * back[:, 1:]
    pairs = np.stack([np.full_like(r, cc), ct * u, tc * r, tt * r * u])
    expected = (pairs / pairs.sum(axis=0)).sum(axis=(1, 2)).reshape(2, 2)
    before, after = truth[:, :-1], truth[:, 1:]
    given = np.array([[(~before & ~after).sum(), (~before & after).sum()], [(before & ~after).sum(), (before & after).sum()]])
    step = (expected - given) / len(e) + L2 * moves
    moved = moved + step**2
    return moves - RATE * step / np.sqrt(moved), moved


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a little shrinkage."""
    layer = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ layer, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 0.1 * layer
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        layer = layer - np.linalg.solve(curve, slope)
    return layer


def score_toxicity(docs: DataFrame, model: ToxicField, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: the key, ``score``, ``toxic_tokens`` and ``offsets``, the code
    point ranges start:end of tokens whose marginal is SPAN_AT or more."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    # fixed size: 4 MB of weights
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        field = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                data, bounds = raw_bytes(part.column("text"))
                features, starts, ends, firsts = _tokens(data, bounds)
                weights = field.weights[features[:, 0]].astype(np.float64)
                for k in range(1, features.shape[1]):
                    weights += field.weights[features[:, k]]
                chance = marginals(weights, firsts, field.moves)
                score = 1 / (1 + np.exp(-np.clip(_summary(chance, firsts) @ field.layer, -40, 40)))
                marks = np.flatnonzero(chance >= SPAN_AT)
                owner = np.searchsorted(firsts, marks, side="right") - 1
                points = code_points(data)
                base = points[bounds[owner]]
                spans = [""] * part.num_rows
                for i, a, b in zip(owner.tolist(), (points[starts[marks]] - base).tolist(), (points[ends[marks]] - base).tolist(), strict=True):
                    spans[i] += f",{a}:{b}" if spans[i] else f"{a}:{b}"
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(score), pa.array(np.bincount(owner, minlength=part.num_rows).astype(np.int64)), pa.array(spans, pa.string())],
                    names=["key", "score", "toxic_tokens", "offsets"],
                )

    out = source.mapInArrow(run, f"key {kind}, score double, toxic_tokens long, offsets string")
    return out.withColumnRenamed("key", key)
