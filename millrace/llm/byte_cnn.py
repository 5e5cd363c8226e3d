"""Quality classifier: a byte-level convolutional network in numpy (operator 6).

Learned filters of ``WIDTH`` bytes slide over the UTF-8 bytes of a text with
step ``STEP``. A byte is one of 256 symbols, so a filter is a table of weights
by place and byte, and a convolution is a sum of table rows. The text is cut
into chunks of ``2 * HALF`` positions that overlap by half, together covering
the whole document. In each chunk every filter's response goes through a ReLU
and is max-pooled; a linear layer turns the pooled values into the chunk's
logit, and the mean logit over all chunks gives one probability.

Training uses at most ``FIT_ROWS`` labelled documents of each class of up to
``FIT_BYTES`` bytes, taken in the order of a hash of the id, never from the
held-out fold (documented bounds; the sample is read through a join with its
own ids only). It runs on the driver with Adam and a fixed seed. The sample's
share of a class is not the table's, so after training the constant is moved by
the difference of their log odds, the table's counted over all labels outside the
held-out fold: scores do not depend on where the bound cuts. Scoring is one narrow
pass over every whole text.

Defined results: a null or empty text is scored like a text of zero bytes; null
ids are held out; with no labels, or labels of one class only, every score is
that class's smoothed share (0.5 if none); repeated labels of one document
count once, by their largest value; repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import id_and_text, map_batches, pick
from ._pieces import in_groups

WIDTH, STEP, FILTERS, HALF = 8, 4, 16, 512
FIT_ROWS, FIT_BYTES = 1500, 65_536
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.01, 7
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
GROUP_BYTES = 1 << 18


@dataclass
class Network:
    table: np.ndarray        # WIDTH x 256 x FILTERS
    bias: np.ndarray         # FILTERS
    out: np.ndarray          # FILTERS
    const: float

    @classmethod
    def start(cls) -> Network:
        rng = np.random.default_rng(SEED)
        return cls(rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
                   np.zeros(FILTERS, np.float32),
                   rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0)


def _padded(data: bytes) -> np.ndarray:
    """Bytes with zeros up to a whole number of steps; at least one position."""
    positions = max(1, -(-max(0, len(data) - WIDTH) // STEP) + 1)
    x = np.zeros((positions - 1) * STEP + WIDTH, np.uint8)
    x[:len(data)] = np.frombuffer(data, np.uint8)
    return x


def _respond(net: Network, x: np.ndarray) -> np.ndarray:
    """Positions x FILTERS, before the ReLU."""
    positions = (len(x) - WIDTH) // STEP + 1
    total = net.table[0].take(x[0:positions * STEP:STEP], axis=0)
    for j in range(1, WIDTH):
        total += net.table[j].take(x[j:j + (positions - 1) * STEP + 1:STEP], axis=0)
    total += net.bias
    return total


def _pool_halves(net: Network, data: bytes) -> np.ndarray:
    """Halves x FILTERS: largest response in each half chunk, in bounded memory."""
    x = _padded(data)
    positions = (len(x) - WIDTH) // STEP + 1
    span, out = GROUP_BYTES // STEP // HALF * HALF, []
    for a in range(0, positions, span):
        r = _respond(net, x[a * STEP:(min(a + span, positions) - 1) * STEP + WIDTH])
        out.append(np.maximum.reduceat(r, np.arange(0, len(r), HALF), axis=0))
    return np.concatenate(out)


def _chunks(halves: np.ndarray) -> np.ndarray:
    """Overlapping chunks of two halves each (one, if the text has one half)."""
    h = np.maximum(halves, 0)
    return np.maximum(h[:-1], h[1:]) if len(h) > 1 else h


def score_text(net: Network, text: str) -> float:
    pooled = _chunks(_pool_halves(net, text.encode("utf-8")))
    z = float((pooled @ net.out).mean()) + net.const
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def score_texts(net: Network, texts: list[str]) -> list[float]:
    """Same as score_text for each; short texts share one convolution.

    Texts are laid end to end, each from a position that is a multiple of the
    step, and the responses that would straddle two texts are never pooled.
    """
    out: list[float] = []
    data = [t.encode("utf-8") for t in texts]
    for a, b in in_groups(len(data), lambda i: len(data[i]) + WIDTH + STEP, GROUP_BYTES):
        if b - a == 1:
            out.append(score_text(net, texts[a]))
            continue
        parts = [_padded(d) for d in data[a:b]]
        room = [-(-len(p) // STEP) * STEP for p in parts]
        at = np.concatenate([[0], np.cumsum(room)])
        x = np.zeros(at[-1] + WIDTH, np.uint8)
        for s, p in zip(at, parts):
            x[s:s + len(p)] = p
        r = _respond(net, x)
        cuts, first = [], []
        for s, p in zip(at, parts):
            n = (len(p) - WIDTH) // STEP + 1
            first.append(len(cuts) // 2)
            for h in range(0, n, HALF):
                cuts += [s // STEP + h, s // STEP + min(h + HALF, n)]
        halves = np.maximum.reduceat(r, cuts, axis=0)[::2]
        first.append(len(halves))
        for s, e in zip(first, first[1:]):
            z = float((_chunks(halves[s:e]) @ net.out).mean()) + net.const
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
    return out


def train(texts: list[str], labels: list[int], totals: tuple[int, int] | None = None) -> Network:
    """Adam on the log loss; only the positions that win a max-pool carry gradient.

    ``totals``: labels 0 and 1 of the whole table that the sample was drawn from
    (the sample's own if not given).
    """
    net = Network.start()
    zeros, ones = totals or (len(labels) - sum(labels), sum(labels))
    if len(set(labels)) < 2:
        net.out[:] = 0
        share = (ones + 1) / (zeros + ones + 2)
        net.const = float(np.log(share / (1 - share)))
        return net
    y = np.array(labels, np.float32)
    net.const = float(np.log(y.mean() / (1 - y.mean())))
    data = [_padded(t.encode("utf-8")) for t in texts]
    rng = np.random.default_rng(SEED)
    params = {"table": net.table, "bias": net.bias, "out": net.out, "const": np.array([net.const], np.float32)}
    m1 = {k: np.zeros_like(v) for k, v in params.items()}
    m2 = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    places = np.arange(WIDTH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for a in range(0, len(order), BATCH):
            grad = {k: np.zeros_like(v) for k, v in params.items()}
            group = order[a:a + BATCH]
            for i in group:
                x = data[i]
                r = _respond(net, x)
                edge = np.arange(0, len(r), HALF)
                where, halves = [], np.maximum.reduceat(r, edge, axis=0)
                for h, s in enumerate(edge):
                    where.append(s + np.argmax(r[s:s + HALF], axis=0))
                won = np.array(where)                                  # halves x FILTERS
                if len(halves) > 1:
                    later = halves[1:] > halves[:-1]
                    won = np.where(later, won[1:], won[:-1])
                    top = np.where(later, halves[1:], halves[:-1])
                else:
                    top = halves
                pooled = np.maximum(top, 0)
                z = float((pooled @ net.out).mean()) + float(params["const"][0])
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) / len(group)
                grad["const"] += err
                grad["out"] += err * pooled.mean(0)
                g = (err / len(pooled)) * net.out * (top > 0)          # chunks x FILTERS
                grad["bias"] += g.sum(0)
                bytes_at = x[won[:, :, None] * STEP + places]          # chunks x FILTERS x WIDTH
                f = np.broadcast_to(np.arange(FILTERS)[None, :, None], bytes_at.shape)
                np.add.at(grad["table"], (np.broadcast_to(places, bytes_at.shape), bytes_at, f),
                          np.broadcast_to(g[:, :, None], bytes_at.shape))
            step += 1
            for k, p in params.items():
                m1[k] += 0.1 * (grad[k] - m1[k])
                m2[k] += 0.001 * (grad[k] ** 2 - m2[k])
                p -= RATE * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    net.const = float(params["const"][0]) + float(np.log(ones / zeros) - np.log(y.mean() / (1 - y.mean())))
    return net


def held_out(id_col="doc_id"):
    fold = F.crc32(F.col(id_col).cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def fit_network(docs: DataFrame, labels: DataFrame) -> Network:
    """Draw the bounded sample (ids first, then only their texts) and train."""
    marked = (pick(labels, "doc_id", "quality").filter(~held_out() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.max("quality").alias("y")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # Not more than 2 * FIT_ROWS ids: a proven bound, so they may be broadcast.
    chosen = marked.filter("y = 1").orderBy(*order).limit(FIT_ROWS).unionByName(
        marked.filter("y = 0").orderBy(*order).limit(FIT_ROWS))
    count = marked.agg(*[F.count_if(F.col("y") == k).alias(f"n{k}") for k in (0, 1)]).first()
    rows = (id_and_text(docs).filter(F.octet_length("text") <= FIT_BYTES)
            .join(F.broadcast(chosen), "doc_id").collect())
    sample = sorted({(r.doc_id, r.text, int(r.y)) for r in rows})
    return train([t for _, t, _ in sample], [y for _, _, y in sample], (count.n0, count.n1))


def classify(docs: DataFrame, labels: DataFrame, net: Network | None = None) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    net = net or fit_network(docs, labels)

    def work(ids, texts):
        return [ids, score_texts(net, texts)]
    found = map_batches(id_and_text(docs), "doc_id long, score double", work)
    return found.select("doc_id", held_out().alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
