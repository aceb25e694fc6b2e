"""Language of a text: a bidirectional gated recurrent network over bytes, trained by backpropagation through time.

Texts are cut into windows of ``WINDOW`` bytes.  Two gated recurrent layers
read each window, one forwards and one backwards; every position gets label
probabilities from both states.  A document's probabilities are the mean over
all its positions.  Gates use the piecewise-linear sigmoid and candidates the
piecewise-linear tanh, which numpy evaluates several times faster.

Training takes windows of a bounded sample of labelled rows: at most
``sample_docs`` rows of each language (the first in a seeded order) with at
most ``windows_per_doc`` windows each.  Everything else reads whole texts.

Scale: the trained weights (a few kB) go to the tasks; texts are labelled
where they are scanned, without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score
0; without any labelled row every text is ``und``; an empty table gives no rows;
every byte of a text of any length is read; repeated rows get a row each; for
predictions, columns other than doc_id, text and lang are not read.

``known_language`` drops texts without a letter and those whose best pooled
probability is below a threshold fitted to the labelled windows; without any
labelled row there is no threshold, and every text with a letter stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetwright.llm.common import each, lowest
from sheetwright.llm.textbytes import slices, text_bytes

WINDOW = 64
HIDDEN = 8
LETTER = r"\p{L}"
BATCH = 2048


def hard_sigmoid(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0.0, 1.0)


class ByteGRU:
    """Weights of both directions: input table (256, 3H), recurrent matrix (H, 3H), output matrix (2H, K)."""

    def __init__(self, labels: list[str], seed: int = 3, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        self.floor = 0.0  # least probability of a text in a known language
        self.weights = {"out": rng.normal(0, 0.3, (2 * hidden, len(labels))), "bias": np.zeros(len(labels))}
        for d in "fb":
            self.weights |= {f"in_{d}": rng.normal(0, 0.5, (256, 3 * hidden)), f"rec_{d}": rng.normal(0, 0.3, (hidden, 3 * hidden))}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def states(self, windows: np.ndarray, direction: str, keep: bool = False):
        """States (T, N, H) in reading order, and what the backward pass needs.

        Gates z and r come from input and state; the candidate sees the state through r.
        """
        h_size, n = self.hidden, windows.shape[1]
        table, rec = self.weights[f"in_{direction}"], self.weights[f"rec_{direction}"]
        h = np.zeros((n, h_size), np.float32)
        out = np.empty((len(windows), n, h_size), np.float32)
        trace = []
        for t, bytes_ in enumerate(windows if direction == "f" else windows[::-1]):
            x = table.take(bytes_, axis=0)
            back = h @ rec
            gates = x[:, : 2 * h_size] + back[:, : 2 * h_size]
            gates *= 0.25
            gates += 0.5
            np.clip(gates, 0.0, 1.0, out=gates)
            z, r = gates[:, :h_size], gates[:, h_size:]
            raw = r * back[:, 2 * h_size :]
            raw += x[:, 2 * h_size :]
            c = np.clip(raw, -1.0, 1.0)
            new = h - c
            new *= z
            new += c
            if keep:
                trace.append((bytes_, h, back, z, r, raw, c))
            h = out[t] = new
        return out, trace

    def position_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Label probabilities (T, N, K) of every byte position of ``windows`` (T, N)."""
        forward, _ = self.states(windows, "f")
        backward, _ = self.states(windows, "b")
        h = self.hidden
        logits = forward @ self.weights["out"][:h]
        logits += backward[::-1] @ self.weights["out"][h:]
        logits += self.weights["bias"]
        np.clip(logits, -30, 30, out=logits)
        np.exp(logits, out=logits)
        logits /= logits @ np.ones((logits.shape[2], 1), np.float32)
        return logits

    def gradients(self, windows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy over all positions, through time."""
        h_size = self.hidden
        grads = {k: np.zeros_like(v) for k, v in self.weights.items()}
        kept = {d: self.states(windows, d, keep=True) for d in "fb"}
        steps, n = windows.shape
        forward, backward = kept["f"][0], kept["b"][0][::-1]
        both = np.concatenate((forward, backward), axis=2)
        logits = both @ self.weights["out"] + self.weights["bias"]
        p = np.exp(logits - logits.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        p[:, np.arange(n), label] -= 1
        p *= (weight / (steps * weight.sum()))[None, :, None]
        grads["out"] = np.einsum("tnh,tnk->hk", both, p)
        grads["bias"] = p.sum((0, 1))
        d_both = p @ self.weights["out"].T
        for d, d_states in (("f", d_both[:, :, :h_size]), ("b", d_both[::-1, :, h_size:])):
            rec = self.weights[f"rec_{d}"]
            carry = np.zeros((n, h_size), np.float32)
            for t in range(steps - 1, -1, -1):
                bytes_, h, back, z, r, raw, c = kept[d][1][t]
                dh = carry + d_states[t]
                dz = dh * (h - c) * 0.25 * ((z > 0) & (z < 1))
                dc = dh * (1 - z) * (np.abs(raw) < 1)
                dr = dc * back[:, 2 * h_size :] * 0.25 * ((r > 0) & (r < 1))
                d_in = np.concatenate((dz, dr, dc), axis=1)
                d_back = np.concatenate((dz, dr, dc * r), axis=1)
                np.add.at(grads[f"in_{d}"], bytes_, d_in)
                grads[f"rec_{d}"] += h.T @ d_back
                carry = dh * z + d_back @ rec.T
        return grads

    def train(self, windows: np.ndarray, label: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.02, seed: int = 5) -> None:
        """Adam over shuffled batches; every language weighs the same."""
        rng = np.random.default_rng(seed)
        weight = (len(label) / np.maximum(1, np.bincount(label, minlength=len(self.labels))))[label].astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(label))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                grads = self.gradients(windows[:, rows], label[rows], weight[rows])
                norm = float(np.sqrt(sum((g * g).sum() for g in grads.values())))
                step += 1
                for k, g in grads.items():
                    g = g * min(1.0, 1.0 / max(norm, 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - rate * 0.7**epoch * change).astype(np.float32)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (T, N) over each text, the row of each window and its number of real positions.

    A text's last window is padded with line breaks.
    """
    sizes = np.diff(offsets)
    per_row = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), per_row)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    begin = number * WINDOW
    real = np.minimum(WINDOW, sizes[row] - begin)
    padded = np.concatenate((data, np.full(WINDOW, 10, np.uint8)))
    at = (offsets[row] + begin)[None, :] + np.arange(WINDOW)[:, None]
    windows = padded[np.minimum(at, len(padded) - 1)]
    windows[np.arange(WINDOW)[:, None] >= real[None, :]] = 10
    return windows, row, real


def document_probabilities(model: ByteGRU, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean label probabilities of each text over all its byte positions."""
    n, k = len(offsets) - 1, len(model.labels)
    total, count = np.zeros((n, k)), np.zeros(n)
    windows, row, real = cut_windows(data, offsets)
    for at in range(0, len(row), BATCH):
        part, own = windows[:, at : at + BATCH], slice(at, at + BATCH)
        p = model.position_probabilities(part)
        if (real[own] < WINDOW).any():
            p *= (np.arange(WINDOW)[:, None] < real[own][None, :])[:, :, None]
        pooled = p.sum(0)
        for j in range(k):
            total[:, j] += np.bincount(row[own], pooled[:, j], minlength=n)
        count += np.bincount(row[own], real[own], minlength=n)
    return total / np.maximum(count, 1)[:, None]


def fit(docs: DataFrame, sample_docs: int = 400, windows_per_doc: int = 6, seed: int = 3) -> ByteGRU:
    """The network, trained on at most ``sample_docs`` labelled rows of each language outside the held-out fold.

    Of each row it sees ``windows_per_doc`` windows of ``WINDOW`` bytes, spread
    evenly over the whole text; predictions read every byte.
    """
    labelled = docs.select("text", "lang", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text").alias("_order"),
                           fold("doc_id").alias("_fold")).where("lang is not null and text is not null")
    labelled = labelled.where("_fold is null or _fold <> 2").where(F.regexp_like("text", F.lit(LETTER)))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("_rows"))  # one row a language
    labelled = labelled.join(F.broadcast(counts), "lang").where(lowest(F.col("_order"), F.col("_rows"), sample_docs))
    ranked = labelled.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_order")))
    size = WINDOW * 2  # characters: enough for a window of bytes
    step = F.greatest(F.lit(1), F.floor(F.char_length("text") / windows_per_doc)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(windows_per_doc - 1)), lambda i: F.substring(F.col("text"), i * step + 1, F.lit(size)))
    rows = ranked.where(F.col("_rank") <= sample_docs).select("lang", F.array_distinct(parts).alias("parts"), "_order")
    rows = sorted(rows.collect(), key=lambda r: (r["lang"], r["_order"], r["parts"]))  # bounded: sample_docs a language
    labels = sorted({r["lang"] for r in rows})
    model = ByteGRU(labels or ["und"], seed)
    texts = [(labels.index(r["lang"]), p.encode()[:WINDOW]) for r in rows for p in r["parts"] if p.strip()]
    if texts:
        windows = np.stack([np.frombuffer(t.ljust(WINDOW, b"\n"), np.uint8) for _, t in texts], axis=1)
        model.train(windows, np.array([label for label, _ in texts]))
        model.floor = fitted_floor(model, [t for _, t in texts])
    return model


def fitted_floor(model: ByteGRU, texts: list[bytes]) -> float:
    """Half way from chance to the least best probability of any labelled window.

    A whole text is pooled over all its windows, so a clean one lies above its
    worst window; the half keeps texts that are shorter or odder than those.
    """
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    least = document_probabilities(model, np.frombuffer(b"".join(texts), np.uint8), offsets).max(1).min()
    chance = 1 / len(model.labels)
    return float(chance + max(0.0, least - chance) / 2) if len(model.labels) > 1 else 0.0


def fold(doc_id: str):
    """Fold 0 to 3 of a document: CRC-32 of its id as text, modulo 4; null for a null id."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4


def labelled(docs: DataFrame, model: ByteGRU) -> DataFrame:
    """Rows (row, lang_pred, score): each row of ``docs`` as a struct, its predicted language and that language's probability."""
    known = model.labels != ["und"]
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.regexp_like("text", F.lit(LETTER)), F.lit(False)).alias("letters"))
    schema = rows.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches) -> Iterator[pa.RecordBatch]:
        names = np.array(model.labels, dtype=object)
        for batch in each(batches):
            data, offsets = text_bytes(pc.struct_field(batch.column("row"), "text"))
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool) & known
            for a, b in slices(offsets, 1 << 20):
                p = document_probabilities(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                lang = np.where(letters[a:b], names[p.argmax(1)], "und")
                score = np.clip(np.where(letters[a:b], p.max(1), 0.0), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array(lang, pa.string()), pa.array(score)], names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def predicted(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score): one per row of ``docs``."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    found = labelled(narrow, fit(narrow, **options))
    return found.select("row.doc_id", F.coalesce(fold("row.doc_id") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language.  Columns unchanged.

    Rows without a letter go, and rows whose best probability is below the
    model's floor; without any labelled row only those without a letter go.
    """
    model = fit(docs, **options)
    if model.labels == ["und"]:
        return docs.where(F.coalesce(F.regexp_like("text", F.lit(LETTER)), F.lit(False)))
    return labelled(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= model.floor)).select("row.*")
