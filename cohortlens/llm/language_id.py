"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte of a text is labelled from the states of a network that reads it forwards and one that reads it backwards;
a text's probabilities are the means of those of its bytes. The network is trained in numpy by backpropagation through
time on a bounded sample of labelled windows; it is a few thousand numbers, sent to the tasks that label whole texts.
Texts are read in windows, a thousand of them side by side. Gates use the piecewise linear sigmoid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import stage, whole_text

HIDDEN = 8
WINDOW = 96  # bytes read from a fresh state, in training and in use
SIDE_BY_SIDE = 4096  # windows labelled at once
UNKNOWN = "und"

# Bounds of the training sample: documents of each language, and windows of each document.
SAMPLE_DOCS = 400
BROADCAST_LANGUAGES = 10_000  # with more, documents are shuffled to meet their language's share
SAMPLE_WINDOWS = 8
STEPS, BATCH, RATE = 400, 192, 0.02


def held_out(doc_id: str = "doc_id") -> Column:
    """The documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, docs_each: int = SAMPLE_DOCS, windows: int = SAMPLE_WINDOWS) -> list[tuple[str, str]]:
    """(lang, window) of at most ``docs_each`` documents of each language, chosen by hash, and ``windows`` of each,
    spread over its whole text."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0) & ~held_out())
    share = F.least(F.lit(1.0), F.lit(2.0 * docs_each) / F.count(F.lit(1)))
    shares = stage(known.groupBy(F.col("lang").alias("of")).agg(share.alias("share")), "shares")
    if shares.count() <= BROADCAST_LANGUAGES:
        shares = F.broadcast(shares)
    place = F.xxhash64("doc_id", "text")
    length = F.length("text")
    several = F.least(F.lit(windows), F.ceil(length / WINDOW)).cast("int")
    step = F.greatest(length - WINDOW, F.lit(0)) / F.greatest(several - 1, F.lit(1))
    cut = F.transform(
        F.sequence(F.lit(0), several - 1), lambda i: F.substring("text", (i * step).cast("int") + 1, F.lit(WINDOW))
    )
    drawn = (
        known.join(shares, F.col("lang") == F.col("of"))
        .where(F.pmod(place, F.lit(1 << 20)) < F.col("share") * (1 << 20))
        .select("lang", place.alias("place"), cut.alias("cut"))
    )
    rows = (
        drawn.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("place")))
        .where(F.col("nth") <= docs_each)
        .select("lang", "place", F.posexplode("cut").alias("at", "window"))
    )
    return [(r["lang"], r["window"]) for r in rows.orderBy("lang", "place", "at").collect()]


# --- the network ------------------------------------------------------------------------------------


@dataclass
class Direction:
    """One way of reading: what each byte adds to the two gates and to the candidate, and what the state adds."""

    byte_gates: np.ndarray  # 256 x 2h
    byte_candidate: np.ndarray  # 256 x h
    state_gates: np.ndarray  # h x 2h
    state_candidate: np.ndarray  # h x h

    @classmethod
    def random(cls, hidden: int, rng: np.random.Generator) -> Direction:
        def draw(*shape: int) -> np.ndarray:
            return rng.normal(0, 0.3, shape).astype(np.float32)

        return cls(draw(256, 2 * hidden), draw(256, hidden), draw(hidden, 2 * hidden), draw(hidden, hidden))

    def parameters(self) -> list[np.ndarray]:
        return [self.byte_gates, self.byte_candidate, self.state_gates, self.state_candidate]

    def read(self, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
        """The states after each of the steps (time x windows of bytes); ``keep`` gets what backpropagation needs."""
        hidden = len(self.state_candidate)
        states = np.zeros((len(steps) + 1, steps.shape[1], hidden), np.float32)
        gates = np.empty((steps.shape[1], 2 * hidden), np.float32)
        from_state, candidate = np.empty_like(gates), np.empty_like(states[0])
        carried = np.empty_like(candidate)
        for t, column in enumerate(steps):
            state = states[t]
            np.take(self.byte_gates, column, axis=0, out=gates, mode="clip")
            np.dot(state, self.state_gates, out=from_state)
            gates += from_state
            gates *= 0.25
            gates += 0.5
            np.clip(gates, 0, 1, out=gates)
            reset, update = gates[:, :hidden], gates[:, hidden:]
            np.dot(state, self.state_candidate, out=carried)
            np.take(self.byte_candidate, column, axis=0, out=candidate, mode="clip")
            if keep is not None:
                keep.append((gates.copy(), carried.copy(), candidate))
            carried *= reset
            candidate += carried
            np.tanh(candidate, out=candidate)
            after = states[t + 1]
            np.subtract(state, candidate, out=after)
            after *= update
            after += candidate
            if keep is not None:
                candidate = np.empty_like(candidate)
        return states

    def gradients(self, steps: np.ndarray, states: np.ndarray, keep: list, outer: np.ndarray) -> list[np.ndarray]:
        """Backpropagation through time; ``outer`` is the loss's gradient by the states after each step."""
        sums = [np.zeros_like(p) for p in self.parameters()]
        hidden = len(self.state_candidate)
        back = np.zeros_like(states[0])
        for t in range(len(steps) - 1, -1, -1):
            gates, carried, candidate = keep[t]
            reset, update = gates[:, :hidden], gates[:, hidden:]
            state, column = states[t], steps[t]
            back = back + outer[t]
            by_candidate = back * (1 - update) * (1 - candidate * candidate)
            by_gates = np.concatenate((by_candidate * carried, back * (state - candidate)), axis=1)
            by_gates *= 0.25 * ((gates > 0) & (gates < 1))
            by_carried = by_candidate * reset
            np.add.at(sums[0], column, by_gates)
            np.add.at(sums[1], column, by_candidate)
            sums[2] += state.T @ by_gates
            sums[3] += state.T @ by_carried
            back = back * update + by_gates @ self.state_gates.T + by_carried @ self.state_candidate.T
        return sums


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    weights: np.ndarray  # 2h x languages
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.forward.parameters(), *self.backward.parameters(), self.weights, self.bias]

    def probabilities(self, steps: np.ndarray) -> np.ndarray:
        """Of each language for each byte: languages x time x windows."""
        forward, backward = self.forward.read(steps), self.backward.read(steps[::-1])
        return self._labelled(forward[1:], backward[:0:-1])

    def _labelled(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        hidden = forward.shape[2]
        logits = self.weights[:hidden].T @ forward.reshape(-1, hidden).T
        logits += self.weights[hidden:].T @ backward.reshape(-1, hidden).T
        logits += self.bias[:, None]
        return softmax(logits).reshape(len(self.bias), *forward.shape[:2])

    def loss_gradients(self, steps: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all bytes that are not padding, and its gradients by the parameters."""
        keep: tuple[list, list] = ([], [])
        forward = self.forward.read(steps, keep[0])
        backward = self.backward.read(steps[::-1], keep[1])
        states = np.concatenate((forward[1:], backward[:0:-1]), axis=2)
        by_label = self._labelled(forward[1:], backward[:0:-1])
        counts = steps > 0
        total = counts.sum()
        at_label = by_label[labels, :, np.arange(len(labels))].T
        loss = float(-(np.log(np.maximum(at_label, 1e-9)) * counts).sum() / total)
        by_label[labels, :, np.arange(len(labels))] -= 1
        by_label *= counts / np.float32(total)
        by_logit = np.moveaxis(by_label, 0, 2)
        flat = np.ascontiguousarray(by_logit).reshape(-1, len(self.bias))
        by_weights = states.reshape(len(flat), -1).T @ flat
        by_states = by_logit @ self.weights.T
        hidden = len(self.forward.state_candidate)
        return loss, [
            *self.forward.gradients(steps, forward, keep[0], by_states[..., :hidden]),
            *self.backward.gradients(steps[::-1], backward, keep[1], by_states[::-1, :, hidden:]),
            by_weights,
            flat.sum(axis=0),
        ]


def softmax(logits: np.ndarray) -> np.ndarray:
    """Over the first axis, in place."""
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def train(rows: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 0) -> Network | None:
    """Adam over batches with as many windows of each language; some windows are shortened, as short texts are."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    windows = np.zeros((len(rows), WINDOW), np.intp)
    for i, (_, text) in enumerate(rows):
        cut = np.frombuffer(text.encode()[:WINDOW], np.uint8)
        windows[i, : len(cut)] = cut
    labels = np.array([languages.index(lang) for lang, _ in rows])
    by_label = [np.flatnonzero(labels == k) for k in range(len(languages))]
    weights = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
    network = Network(
        languages, Direction.random(hidden, rng), Direction.random(hidden, rng), weights,
        np.zeros(len(languages), np.float32),
    )
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    for step in range(1, steps + 1):
        chosen = rng.integers(len(languages), size=BATCH)
        chosen = np.array([rng.choice(by_label[k]) for k in chosen])
        batch = windows[chosen]
        short = rng.random(BATCH) < 0.15
        batch[short[:, None] & (np.arange(WINDOW) >= rng.integers(8, WINDOW, BATCH)[:, None])] = 0
        _, gradients = network.loss_gradients(np.ascontiguousarray(batch.T), labels[chosen])
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for p, g, (one, two) in zip(network.parameters(), gradients, moments, strict=True):
            np.clip(g, -1, 1, out=g)
            one += 0.1 * (g - one)
            two += 0.01 * (g * g - two)
            p -= rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)
    return network


# --- labelling --------------------------------------------------------------------------------------


def pooled(network: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all bytes of each text. Windows that would be short begin earlier; their first bytes,
    which the window before has labelled, do not count."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = np.cumsum(sizes) - sizes
    new = begins[owner] + nth * WINDOW  # the first byte that the window has to label
    starts = np.maximum(np.minimum(new, (begins + sizes)[owner] - WINDOW), begins[owner])
    ends = (begins + sizes)[owner]
    run = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
    sums = np.zeros((len(texts), len(network.languages)))
    for at in range(0, len(owner), SIDE_BY_SIDE):
        part = slice(at, at + SIDE_BY_SIDE)
        places = np.arange(WINDOW)[:, None] + starts[part]
        inside = places < ends[part]
        by_byte = network.probabilities(np.where(inside, run[places], 0).astype(np.intp))
        labelled = (inside & (places >= new[part])).astype(np.float32)
        by_window = (by_byte * labelled).sum(axis=1).T
        np.add.at(sums, owner[part], by_window)
    return sums / np.maximum(sizes, 1)[:, None]


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """A row for each row of docs: doc_id, lang_pred, score (the pooled probability of lang_pred).

    A null text, or one without a letter, is ``und`` with score 0, as is every text where nothing could be learned.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, texts in runs(batch):
                labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                lettered = [i for i, t in enumerate(texts) if sent.value and any(map(str.isalpha, t.decode()))]
                if lettered:
                    means = pooled(sent.value, [texts[i] for i in lettered])
                    best = means.argmax(axis=1)
                    scores[lettered] = np.clip(means.max(axis=1), 0, 1)
                    for i, k in zip(lettered, best, strict=True):
                        labels[i] = sent.value.languages[k]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(labels), pa.array(scores)], ["doc_id", "lang_pred", "score"]
                )

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[bytes]]]:
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            yield part.column("doc_id"), part.column("text").to_pylist()

    source = docs.select("doc_id", F.encode(whole_text(), "UTF-8").alias("text"))
    return source.mapInArrow(work, f"doc_id {kind}, lang_pred string, score double")


def learned(docs: DataFrame) -> Network | None:
    """Trained on documents that are not held out and have a lang; null texts and null ids teach nothing."""
    return train(sample(docs))
