"""Language of whole texts: a bidirectional gated recurrent network over bytes, trained in numpy."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.llm.sampling import STEPS as STEPS_OF_HASH
from postsift.llm.text import blocks, flat

# Labelled windows that are learnt from, of each language at most, and their length in bytes.
SAMPLE = 600
STEPS = 96
HIDDEN = 8
EPOCHS = 12
BATCH = 64
RATE = 0.02
# Windows of texts that are read side by side.
SIDE_BY_SIDE = 2048
PAD = 256
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def _squash(a, hidden):
    """In place: the gate between 0 and 1 above, the candidate between -1 and 1 below."""
    np.tanh(a, out=a)
    gate = a[:hidden]
    gate *= 0.5
    gate += 0.5
    return gate, a[hidden:]


class Network:
    """Two gated layers, one from each end, and a label at every byte.

    A layer keeps h = h + z * (c - h), where gate z and candidate c come from the byte and h. A
    byte enters through a table, so a step is one table look-up, one matrix product and one
    tanh. Bytes after a text's end (PAD) are masked out of losses and sums; they stand at the end
    of a window, so going backwards they come first and the state is held at zero there.
    """

    def __init__(self, labels: list, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        k = len(labels)
        self.params = {}
        for way in ("f", "b"):
            self.params[f"table_{way}"] = rng.normal(0, 0.3, (PAD + 1, 2 * HIDDEN)).astype("f4")
            self.params[f"loop_{way}"] = rng.normal(0, 0.3, (2 * HIDDEN, HIDDEN)).astype("f4")
            self.params[f"out_{way}"] = rng.normal(0, 0.3, (k, HIDDEN)).astype("f4")
        self.params["bias"] = np.zeros((k, 1), "f4")

    def _run(self, way, ids, keep=False):
        """Hidden states (steps, hidden, windows) in the order of the bytes; with ``keep`` also gates and candidates."""
        table, loop = self.params[f"table_{way}"], self.params[f"loop_{way}"]
        steps, n = ids.shape
        states = np.zeros((steps, HIDDEN, n), "f4")
        h = np.zeros((HIDDEN, n), "f4")
        kept = []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            a = loop @ h
            a += table[ids[t]].T
            z, c = _squash(a, HIDDEN)
            if way == "b":
                z *= ids[t] != PAD
            if keep:
                kept.append((h, z, c))
            c = c - h
            c *= z
            h = h + c
            states[t] = h
        return states, kept

    def _label(self, f, b):
        logits = self.params["out_f"] @ f + self.params["out_b"] @ b + self.params["bias"]
        logits -= logits.max(-2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-2, keepdims=True)
        return logits

    def pooled(self, ids):
        """Sum over positions of the label probabilities: (labels, windows)."""
        f, _ = self._run("f", ids)
        b, _ = self._run("b", ids)
        total = np.zeros((len(self.labels), ids.shape[1]), "f4")
        for t in range(len(ids)):
            total += self._label(f[t], b[t]) * (ids[t] != PAD)
        return total

    def gradients(self, ids, target):
        """Cross entropy over all positions and its gradients, by backpropagation through time."""
        steps, n = ids.shape
        f, kept_f = self._run("f", ids, keep=True)
        b, kept_b = self._run("b", ids, keep=True)
        mask = (ids != PAD).astype("f4")
        p = self._label(f, b)
        at = np.arange(n)
        loss = -float((np.log(p[:, target, at] + 1e-9) * mask).sum() / mask.sum())
        d = p
        d[:, target, at] -= 1
        d *= mask[:, None, :] / mask.sum()
        grads = {"bias": d.sum((0, 2))[:, None]}
        for way, states, kept in (("f", f, kept_f), ("b", b, kept_b)):
            loop = self.params[f"loop_{way}"]
            grads[f"out_{way}"] = np.einsum("tkn,thn->kh", d, states)
            outer = self.params[f"out_{way}"].T
            table = np.zeros_like(self.params[f"table_{way}"])
            turn = np.zeros_like(loop)
            back = np.zeros((HIDDEN, n), "f4")
            order = range(steps) if way == "f" else range(steps - 1, -1, -1)
            for t, (h, z, c) in reversed(list(zip(order, kept))):
                back = back + outer @ d[t]
                # z is half the tanh of its input plus a half, so its slope is 2 z (1 - z).
                inner = np.concatenate([back * (c - h) * 2 * z * (1 - z), back * z * (1 - c * c)])
                turn += inner @ h.T
                np.add.at(table, ids[t], inner.T)
                back = back * (1 - z) + loop.T @ inner
            grads[f"table_{way}"], grads[f"loop_{way}"] = table, turn
        return loss, grads

    def fit(self, windows, target, seed: int = 11):
        """Adam over shuffled batches; languages count alike, however many windows they have."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        by_label = [np.flatnonzero(target == k) for k in range(len(self.labels))]
        most = max(len(x) for x in by_label)
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(np.concatenate([np.resize(rng.permutation(x), most) for x in by_label]))
            rate = RATE * (1 - epoch / EPOCHS)
            for i in range(0, len(order), BATCH):
                some = order[i: i + BATCH]
                # Half of the windows end early, as short texts do.
                end = np.where(rng.random(len(some)) < 0.5, rng.integers(8, STEPS, len(some)), STEPS)
                ids = np.where(np.arange(STEPS)[:, None] < end, windows[:, some], PAD)
                _, grads = self.gradients(ids, target[some])
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def predict(self, array):
        """For each text of a string column: label probabilities, summed over its bytes, and their number."""
        data, offsets = flat(array)
        sizes = np.diff(offsets)
        counts = -(-sizes // STEPS)
        owner = np.repeat(np.arange(len(sizes)), counts)
        first = offsets[:-1][owner] + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * STEPS
        sums = np.zeros((len(sizes), len(self.labels)))
        padded = np.concatenate([data, np.zeros(STEPS, np.uint8)])
        for i in range(0, len(first), SIDE_BY_SIDE):
            at = first[i: i + SIDE_BY_SIDE]
            place = at[None, :] + np.arange(STEPS)[:, None]
            ids = np.where(place < offsets[1:][owner[i: i + SIDE_BY_SIDE]], padded[place].astype(np.int64), PAD)
            pooled = self.pooled(ids).T.astype(np.float64)
            for k in range(len(self.labels)):
                sums[:, k] += np.bincount(owner[i: i + SIDE_BY_SIDE], pooled[:, k], minlength=len(sizes))
        return sums, sizes


def byte_windows(texts: list):
    """One column of byte ids per text, STEPS long, padded at the end."""
    out = np.full((STEPS, len(texts)), PAD, np.int64)
    for i, text in enumerate(texts):
        data = np.frombuffer(text.encode()[:STEPS], np.uint8)
        out[: len(data), i] = data
    return out


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id never does."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Train on at most ``sample`` windows of each language, from as many texts spread by hash; None without labels.

    A language's texts are thinned by hash before they meet in one task, to about four times the sample.

    A window starts at a place in the text that its hash gives, every third at its start. Learning is bounded by ``sample``,
    the number of languages and nothing else; it takes seconds whatever the input.
    """
    hashed = F.xxhash64("text", "doc_id")
    start = F.when(F.pmod(hashed, F.lit(3)) == 0, 1).otherwise(
        F.pmod(hashed, F.greatest(F.length("text") - STEPS, F.lit(1))) + 1)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out())
    place = F.pmod(hashed, F.lit(STEPS_OF_HASH))
    # The share of a language's hashes that holds about four times its sample: the rest stays in its task. One row per
    # language, which are as many as the network has outputs.
    share = known.groupBy(F.col("lang").alias("known")).agg(
        F.least(F.lit(STEPS_OF_HASH), F.floor(F.lit(4 * sample * STEPS_OF_HASH) / F.count("*")) + 1).alias("share"))
    rows = known.select("lang", F.expr("text").substr(start.cast("int"), F.lit(STEPS)).alias("window"), place.alias("hash"))
    rows = rows.join(F.broadcast(share), (F.col("lang") == F.col("known")) & (F.col("hash") < F.col("share"))).select("lang", "window", "hash")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash", "window")))
    chosen = ranked.where(F.col("rank") <= sample).orderBy("lang", "rank").select("lang", "window").collect()
    if not chosen:
        return None
    labels = sorted({r.lang for r in chosen})
    target = np.array([labels.index(r.lang) for r in chosen])
    return Network(labels).fit(byte_windows([r.window for r in chosen]), target)


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (the pooled probability of lang_pred).

    Every byte of the whole text is labelled and the labels' probabilities are averaged. A
    null or letterless text, or any text where nothing could be learnt, is ``und`` with score 0.
    Of equal probabilities the first language in order counts. Only the text enters a prediction.
    """
    network = learn(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        net = shared.value
        for whole in batches:
            for batch in blocks(whole, "text"):
                texts = batch.column("text")
                some = [t is not None and LETTER.search(t) is not None for t in texts.to_pylist()]
                if net is None:
                    names, scores = [UNKNOWN] * len(some), [0.0] * len(some)
                else:
                    sums, sizes = net.predict(texts)
                    mean = sums / np.maximum(sizes, 1)[:, None]
                    best = mean.argmax(1)
                    top = np.clip(mean[np.arange(len(best)), best], 0, 1)
                    names = [net.labels[k] if known else UNKNOWN for k, known in zip(best.tolist(), some)]
                    scores = [p if known else 0.0 for p, known in zip(top.tolist(), some)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text").mapInArrow(run, PREDICTED)
