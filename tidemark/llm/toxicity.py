"""Toxicity: a bidirectional gated recurrent network with attention, trained in numpy.

Every position of a text is a word with two inputs: a vector of the word, for words of the training
vocabulary, and the mean of the vectors of its character trigrams, for any word. The network reads
windows of ``WINDOW`` words, the next one beginning ``STRIDE`` words later, forwards and backwards;
attention over both states gives a window's logit, and a text is as toxic as its worst window. Training
sees labels of whole texts only: a text's windows share its loss by a soft maximum. A logistic curve
over the worst logit, fitted on texts kept out of training, gives the score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, in_fold, slices
from tidemark.llm.url_filter import logistic

HELD_OUT = (5, 0)
WINDOW, STRIDE = 32, 16
WORD_DIMS, CHAR_DIMS, HIDDEN = 12, 12, 8
CHAR_CELLS = 4096
# Bounds of the training sample: documents of each label, and the characters of all of them.
DOCS_PER_LABEL = 1500
SAMPLE_CHARS = 24_000_000
MIN_DOCS = 2
# A long text learns through as many of its windows, those that the network finds worst at the time.
LEARNED_WINDOWS = 32
EPOCHS, MAX_EPOCHS, STEPS, BATCH_DOCS, RATE, PULL = 4, 12, 400, 32, 0.01, 5.0
MEMO_WORDS = 250_000
CHUNK = 1024


def plain(word: str) -> str:
    """A word as the network reads it: lower case, without what surrounds its letters and digits."""
    low = word.lower()
    if low.isalnum():
        return low
    begin, end = 0, len(low)
    while begin < end and not low[begin].isalnum():
        begin += 1
    while end > begin and not low[end - 1].isalnum():
        end -= 1
    return low[begin:end] or low


def _crc_table() -> np.ndarray:
    """What a byte does to a crc32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all words' trigrams as they are written, with case and punctuation, and how many each word
    has. A cell is the crc32 of three bytes; words are not empty."""
    marked = [f"<{word}>".encode() for word in words]
    lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    laid = np.frombuffer(b"".join(marked), dtype=np.uint8)
    ends = np.repeat(np.cumsum(lengths), lengths)
    first = np.flatnonzero(np.arange(len(laid)) + 2 < ends)
    crc = np.full(len(first), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(3):
        crc = CRC[(crc ^ laid[first + k]) & 0xFF] ^ (crc >> np.uint32(8))
    return ((~crc) % np.uint32(CHAR_CELLS)).astype(np.int64), lengths - 2


def windows(count: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of the overlapping windows over ``count`` words; the last ends with the text."""
    begin = 0
    while True:
        yield begin, min(begin + WINDOW, count)
        if begin + WINDOW >= count:
            return
        begin += STRIDE


def laid_out(rows: np.ndarray, padding: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all windows of a text, padded, and the lengths of the windows."""
    spans = list(windows(len(rows)))
    table = np.full((len(spans), WINDOW), padding, dtype=np.int64)
    for n, (begin, end) in enumerate(spans):
        table[n, : end - begin] = rows[begin:end]
    return table, np.array([end - begin for begin, end in spans])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights; ``p`` holds them by name. Gates lie side by side: update, reset, candidate."""

    p: dict[str, np.ndarray]
    vocabulary: dict[str, int]
    slope: float = 1.0
    offset: float = 0.0
    prior: float | None = None
    start: dict[str, np.ndarray] = field(default_factory=dict)
    state: dict = field(default_factory=dict)

    @staticmethod
    def fresh(vocabulary: dict[str, int], lean: np.ndarray, seed: int = 7) -> Network:
        """Random weights; the first dimension of a word's vector starts at ``lean``, what its
        log-odds are at least."""
        rng = np.random.default_rng(seed)
        dims, h = WORD_DIMS + CHAR_DIMS, HIDDEN
        p = {
            "word": rng.normal(0, 0.1, (len(vocabulary) + 1, WORD_DIMS)),
            "char": rng.normal(0, 0.1, (CHAR_CELLS, CHAR_DIMS)),
            "attend": np.zeros(2 * h),
            "out": rng.normal(0, 0.3, 2 * h),
            "bias": np.zeros(1),
        }
        p["word"][:-1, 0] = lean
        p["word"][-1] = 0
        for side in "fb":
            p[f"w{side}"] = rng.normal(0, 1 / np.sqrt(dims), (dims, 3 * h))
            p[f"u{side}"] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h))
            p[f"c{side}"] = np.concatenate([np.full(h, -1.0), np.zeros(2 * h)])
        p = {k: v.astype(np.float32) for k, v in p.items()}
        return Network(p, vocabulary, start={"word": p["word"]})

    def embed(self, words: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Vectors of words as they are written, and their trigrams."""
        unknown, find = len(self.vocabulary), self.vocabulary.get
        known = np.array([find(plain(w), unknown) for w in words], dtype=np.int64)
        cells, lengths = trigrams(words)
        sums = np.add.reduceat(self.p["char"][cells], np.cumsum(lengths) - lengths, axis=0)
        return np.concatenate([self.p["word"][known], sums / lengths[:, None]], axis=1), (cells, lengths)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """What the gates of both directions get from a word, with a padding row at the end."""
        both = [vectors @ self.p[f"w{side}"] + self.p[f"c{side}"] for side in "fb"]
        rows = np.concatenate(both, axis=1)
        return np.concatenate([rows, np.zeros((1, rows.shape[1]), dtype=rows.dtype)])

    def logits(self, gates: np.ndarray, table: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logit of every window; with ``keep`` also what the backward pass needs."""
        n, steps, h = len(table), int(lengths.max()), HIDDEN
        states = np.zeros((2, steps, n, h), dtype=np.float32)
        trail: dict = {"f": [], "b": []}
        alive = (np.arange(steps)[:, None] < lengths[None, :]).astype(np.float32)[:, :, None]
        uneven = bool((lengths < steps).any())
        for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            d = 0 if side == "f" else 1
            u_zr, u_n = self.p[f"u{side}"][:, : 2 * h], self.p[f"u{side}"][:, 2 * h :]
            state = np.zeros((n, h), dtype=np.float32)
            for t in order:
                x = gates[table[:, t], 3 * h * d : 3 * h * (d + 1)]
                zr = sigmoid(x[:, : 2 * h] + state @ u_zr)
                z, r = zr[:, :h], zr[:, h:]
                inner = state @ u_n
                c = np.tanh(x[:, 2 * h :] + r * inner)
                after = state + z * (c - state)
                if uneven:
                    after = state + alive[t] * (after - state)
                if keep:
                    trail[side].append((t, state, z, r, c, inner))
                state = after
                states[d, t] = state
        scores = states[0] @ self.p["attend"][:h] + states[1] @ self.p["attend"][h:]
        scores = np.where(alive[:, :, 0] > 0, scores, -1e9)
        share = np.exp(scores - scores.max(axis=0))
        share /= share.sum(axis=0)
        pooled = np.concatenate([np.einsum("tn,tnh->nh", share, states[d]) for d in (0, 1)], axis=1)
        logits = pooled @ self.p["out"] + self.p["bias"][0]
        return (logits, (states, trail, alive, share, pooled)) if keep else logits

    def gradients(self, gates, table, lengths, kept, d_logit):
        """Gradients of the weights and of ``gates`` for the given gradients of the logits."""
        states, trail, alive, share, pooled = kept
        steps, h = states.shape[1], HIDDEN
        g = {k: np.zeros_like(v) for k, v in self.p.items() if k not in ("word", "char")}
        g["out"], g["bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], dtype=np.float32)
        d_pooled = d_logit[:, None] * self.p["out"]
        both = np.concatenate([states[0], states[1]], axis=2)
        d_share = np.einsum("nh,tnh->tn", d_pooled, both)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_score, both)
        d_both = share[:, :, None] * d_pooled + d_score[:, :, None] * self.p["attend"]
        d_gates = np.zeros_like(gates)
        for d, side in enumerate("fb"):
            u = self.p[f"u{side}"]
            carry = np.zeros((len(table), h), dtype=np.float32)
            moves = np.zeros((steps, len(table), 3 * h), dtype=np.float32)
            for t, before, z, r, c, inner in reversed(trail[side]):
                total = carry + d_both[t, :, d * h : (d + 1) * h]
                moved = total * alive[t]
                d_c = moved * z * (1 - c * c)
                d_z = moved * (c - before) * z * (1 - z)
                d_r = d_c * inner * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                d_inner = d_c * r
                carry = total - moved * z + d_zr @ u[:, : 2 * h].T + d_inner @ u[:, 2 * h :].T
                g[f"u{side}"][:, : 2 * h] += before.T @ d_zr
                g[f"u{side}"][:, 2 * h :] += before.T @ d_inner
                moves[t, :, : 2 * h], moves[t, :, 2 * h :] = d_zr, d_c
            at = table[:, :steps].T.ravel()
            for k, column in enumerate(moves.reshape(-1, 3 * h).T):
                d_gates[:, 3 * h * d + k] = np.bincount(at, column, len(gates))
        d_gates[-1] = 0
        return g, d_gates

    def step(self, gradients: dict[str, np.ndarray], rate: float) -> None:
        """Adam; vectors are pulled back to where they began, so that rare words are not learned by heart."""
        self.state["t"] = self.state.get("t", 0) + 1
        for name, g in gradients.items():
            m, v = self.state.get(name, (np.zeros_like(g), np.zeros_like(g)))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.state[name] = m, v
            t = self.state["t"]
            self.p[name] = self.p[name] - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
            if name in self.start:
                self.p[name] += PULL * rate * (self.start[name] - self.p[name])


def doc_windows(texts: list[str]) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    """The distinct words of some texts, and every text's windows over them."""
    number: dict[str, int] = {}
    rows = [np.array([number.setdefault(w, len(number)) for w in t.split()], dtype=np.int64) for t in texts]
    return list(number), [laid_out(r, len(number)) for r in rows]


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """A network for labelled texts. A fifth of them only calibrates, if there are enough."""
    y = np.array(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        network = Network.fresh({}, np.zeros(0), seed)
        network.prior = float(y.mean()) if len(y) else 0.0
        return network
    fit = np.arange(len(y)) % 5 != 0 if len(y) >= 200 else np.ones(len(y), dtype=bool)
    often, toxic = Counter(), Counter()
    for text, label, used in zip(texts, labels, fit):
        if used:
            held = {plain(w) for w in set(text.split())}
            often.update(held)
            if label:
                toxic.update(held)
    chosen = sorted((w for w, n in often.items() if n >= MIN_DOCS), key=lambda w: (-often[w], w))
    bad, good = y[fit].sum(), (1 - y[fit]).sum()
    share = np.array([[toxic[w] + 0.5, often[w] - toxic[w] + 0.5] for w in chosen]).reshape(-1, 2)
    odds, spread = np.log(share[:, 0] / (bad + 1)) - np.log(share[:, 1] / (good + 1)), np.sqrt((1 / share).sum(axis=1))
    lean = np.clip(np.sign(odds) * np.maximum(0, np.abs(odds) - 2 * spread), -3, 3)
    network = Network.fresh({w: n for n, w in enumerate(chosen)}, lean, seed)
    rng, used = np.random.default_rng(seed), np.flatnonzero(fit)
    weight = np.where(y > 0, 0.5 / max(1, bad), 0.5 / max(1, good)) * len(used)
    # Small samples are gone through more often.
    epochs = min(MAX_EPOCHS, max(EPOCHS, STEPS * BATCH_DOCS // len(used)))
    for epoch in range(epochs):
        order = rng.permutation(used)
        for at in range(0, len(order), BATCH_DOCS):
            _train_batch(network, [texts[n] for n in order[at : at + BATCH_DOCS]], y[order[at : at + BATCH_DOCS]],
                         weight[order[at : at + BATCH_DOCS]], RATE * (0.5 if 2 * epoch >= epochs else 1))
    scorer = Scorer(network, memo_words=50_000)
    rest = np.flatnonzero(~fit) if not fit.all() else used
    parts = (rest[at : at + BATCH_DOCS] for at in range(0, len(rest), BATCH_DOCS))
    worst = np.array([logit for part in parts for logit in scorer.worst([texts[n] for n in part])])
    network.slope, network.offset = logistic(worst, y[rest], balanced=False)
    network.state, network.start = {}, {}
    return network


def _train_batch(network: Network, texts: list[str], y: np.ndarray, weight: np.ndarray, rate: float) -> None:
    words, laid = doc_windows(texts)
    if not words:
        return
    vectors, (cells, size) = network.embed(words)
    gates = network.project(vectors.astype(np.float32))
    laid = [_worst_windows(network, gates, *own) if len(own[0]) > LEARNED_WINDOWS else own for own in laid]
    table, lengths = np.concatenate([t for t, _ in laid]), np.concatenate([n for _, n in laid])
    doc = np.repeat(np.arange(len(texts)), [len(n) for _, n in laid])
    lengths = np.maximum(lengths, 1)
    logits, kept = network.logits(gates, table, lengths, keep=True)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, doc, logits)
    soft = np.exp(logits - top[doc])
    soft /= np.bincount(doc, soft, len(texts))[doc]
    whole = np.bincount(doc, soft * logits, len(texts))
    d_doc = weight * (1 / (1 + np.exp(-whole)) - y) / len(texts)
    d_logit = (d_doc[doc] * soft).astype(np.float32)
    g, d_gates = network.gradients(gates, table, lengths, kept, d_logit)
    h3 = 3 * HIDDEN
    d_vectors = np.zeros_like(vectors, dtype=np.float32)
    for d, side in enumerate("fb"):
        own = d_gates[:-1, h3 * d : h3 * (d + 1)]
        g[f"w{side}"], g[f"c{side}"] = vectors.T.astype(np.float32) @ own, own.sum(axis=0)
        d_vectors += own @ network.p[f"w{side}"].T
    known = np.array([network.vocabulary.get(plain(w), len(network.vocabulary)) for w in words])
    g["word"] = np.zeros_like(network.p["word"])
    np.add.at(g["word"], known, d_vectors[:, :WORD_DIMS])
    g["word"][-1] = 0
    g["char"] = np.zeros_like(network.p["char"])
    np.add.at(g["char"], cells, np.repeat(d_vectors[:, WORD_DIMS:] / size[:, None], size, axis=0))
    network.step(g, rate)


def _worst_windows(network: Network, gates: np.ndarray, table: np.ndarray, lengths: np.ndarray):
    """The windows of a text that the network finds worst now."""
    parts = [slice(at, at + CHUNK) for at in range(0, len(table), CHUNK)]
    logits = np.concatenate([network.logits(gates, table[part], np.maximum(lengths[part], 1)) for part in parts])
    worst = np.sort(np.argsort(-logits, kind="stable")[:LEARNED_WINDOWS])
    return table[worst], lengths[worst]


class Scorer:
    """Scores texts with a network; keeps what the gates get from each word it has seen."""

    def __init__(self, network: Network, memo_words: int = MEMO_WORDS):
        self.network, self.memo_words = network, memo_words
        self._reset()

    def _reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.gates = np.zeros((1, 6 * HIDDEN), dtype=np.float32)
        self.filled = 1  # Row 0 is padding.

    def _learn(self, words: set[str]) -> None:
        """Gates of the words that are new. A full memo keeps the words in use."""
        if len(self.memo) > self.memo_words:
            kept = [w for w in words if w in self.memo]
            rows = self.gates[[self.memo[w] for w in kept]]
            self._reset()
            self.gates = np.concatenate([self.gates, rows])
            self.memo, self.filled = dict(zip(kept, range(1, len(kept) + 1))), len(kept) + 1
        new = [w for w in words if w not in self.memo]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            rows = self.network.project(self.network.embed(part)[0].astype(np.float32))[:-1]
            if self.filled + len(part) > len(self.gates):
                room = np.zeros((len(self.gates) // 2 + len(part), self.gates.shape[1]), dtype=np.float32)
                self.gates = np.concatenate([self.gates[: self.filled], room])
            self.gates[self.filled : self.filled + len(part)] = rows
            self.memo.update(zip(part, range(self.filled, self.filled + len(part))))
            self.filled += len(part)

    def worst(self, texts: list[str | None]) -> list[float]:
        """The largest logit of every text's windows; a text without words is one window of padding."""
        split = [(text or "").split() for text in texts]
        self._learn(set().union(*split))
        find = self.memo.__getitem__
        laid = [laid_out(np.fromiter(map(find, words), dtype=np.int64, count=len(words)), 0) for words in split]
        table, lengths = np.concatenate([t for t, _ in laid]), np.concatenate([n for _, n in laid])
        doc = np.repeat(np.arange(len(texts)), [len(n) for _, n in laid])
        lengths = np.maximum(lengths, 1)
        logits = np.empty(len(table), dtype=np.float32)
        full = lengths == WINDOW
        for chosen in (np.flatnonzero(full), np.flatnonzero(~full)):
            for at in range(0, len(chosen), CHUNK):
                part = chosen[at : at + CHUNK]
                logits[part] = self.network.logits(self.gates, table[part], lengths[part])
        top = np.full(len(texts), -np.inf, dtype=np.float32)
        np.maximum.at(top, doc, logits)
        return top.tolist()

    def scores(self, texts: list[str | None]) -> list[float]:
        network = self.network
        if network.prior is not None:
            return [network.prior] * len(texts)
        worst = np.array(self.worst(texts), dtype=np.float64)
        return (1 / (1 + np.exp(-np.clip(network.slope * worst + network.offset, -60, 60)))).tolist()


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """Labelled texts outside the held-out fold, whole and of any length: per label at most
    ``DOCS_PER_LABEL``, chosen by a hash of their ids; if they have more than ``SAMPLE_CHARS`` characters in
    all, the longest go. A document labelled more than once counts as toxic if any label says so; null
    labels and null texts are left out. Of rows with one id the shortest text counts."""
    marks = labels.where(~in_fold("doc_id", *HELD_OUT) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("labelled")).agg(F.max("toxic").cast("int").alias("mark"))
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("id"), "text")
    sizes = texts.groupBy("id").agg(F.min(F.length("text")).alias("size"))
    usable = marks.join(sizes, F.col("labelled") == F.col("id"))
    parts = [
        usable.where(F.col("mark") == mark).orderBy(F.xxhash64("labelled"), "labelled").limit(DOCS_PER_LABEL)
        for mark in (0, 1)
    ]
    chosen = sorted(parts[0].unionByName(parts[1]).collect(), key=lambda row: (row["size"], row["labelled"]))
    room = SAMPLE_CHARS - np.cumsum([row["size"] for row in chosen])
    mark = {row["labelled"]: row["mark"] for row, left in zip(chosen, room) if left >= 0}
    known = docs.sparkSession.createDataFrame([(i,) for i in mark], "labelled bigint")
    # At most 2 * DOCS_PER_LABEL ids.
    own = texts.join(F.broadcast(known), F.col("id") == F.col("labelled"), "left_semi")
    shortest = F.min(F.struct(F.length("text").alias("size"), "text"))["text"]
    rows = own.groupBy("id").agg(shortest.alias("text")).collect()
    rows.sort(key=lambda row: zlib.crc32(str(row[0]).encode()))
    return [row[1] for row in rows], [mark[row[0]] for row in rows]


def score_texts(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text. Null and empty texts are scored as one
    empty window; repeated rows are scored alike; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                values = scorer.scores(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(values, pa.float64())], ["doc_id", "held_out", "score"]
                )

    rows = docs.select("doc_id", in_fold("doc_id", *HELD_OUT).alias("held_out"), "text")
    scored = rows.mapInArrow(score, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from the labels outside the held-out fold and scores all rows, see :func:`training_sample` and
    :func:`score_texts`; without labels of both kinds every score is the share of toxic ones, or 0."""
    return score_texts(docs, train(*training_sample(docs, labels)))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns; scored where they are read.

    Null and empty texts are scored as one empty window; repeated rows are kept or go alike; an empty table
    gives no rows. Other columns, whatever their names, are passed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(*training_sample(docs, labels)))
    names, place = docs.columns, docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch.rename_columns([str(n) for n in range(batch.num_columns)]), str(place)):
                good = pa.array([value < 0.5 for value in scorer.scores(part.column(place).to_pylist())])
                yield part.filter(good).rename_columns(names)

    return docs.mapInArrow(keep, docs.schema)
