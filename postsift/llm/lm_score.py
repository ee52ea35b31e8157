"""Scores of whole texts: smoothed token counts, and a log-bilinear model trained with noise contrast.

The model predicts the class of the next token from the last CONTEXT classes: the most frequent
words are classes of their own, all other words fall into TAILS classes by their last letters, and
the end of a text is a class. A word's probability is its class's, from a full softmax, times its
share of the class by smoothed counts over the whole corpus, so it is normalised over all words.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.llm.text import blocks
from postsift.session import staged

HEADS = 223
CLASS_BITS = 10
TAILS = 32
END = 0  # the class of the end; also stands before a text
CONTEXT = 3
WIDTH = 16
NOISE = 32
BATCH = 2048
# Positions whose classes' probabilities are worked out at a time.
AT_ONCE = 512
RATE = 0.08
# Training texts are dealt by hash into pieces of about so many tokens; each round trains a model on every
# one of its pieces, all from the average of the round before.
PIECE_TOKENS, ROUNDS = 1 << 21, 2
# At most so many words, the most frequent, whose counts every task holds; those of all others are joined.
KNOWN = 50_000
# Different words that a task counts before it passes them on.
COUNTED = 400_000
# Words whose class a Python worker keeps.
CACHED = 400_000


def held_out(doc_id: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id never does."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def split(text: str | None) -> list:
    """The words of a text with A-Z as a-z, as bytes."""
    return (text or "").encode().lower().split()


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAILS


class Vocabulary(dict):
    """Word to count and class in one number. Known words are given; others count 0 here, a bounded number is kept."""

    def __init__(self, known: list, heads: int, n_texts: int):
        super().__init__()
        self.n_heads = min(heads, len(known))
        self.size = 1 + self.n_heads + TAILS
        self.end = n_texts << CLASS_BITS | END
        for i, (word, count) in enumerate(known):
            cls = 1 + i if i < self.n_heads else 1 + self.n_heads + tail_class(word)
            self[word] = count << CLASS_BITS | cls

    def __missing__(self, word):
        cls = 1 + self.n_heads + tail_class(word)
        if len(self) < CACHED:
            self[word] = cls
        return cls

    def read(self, texts: list):
        """Over all texts on end, each with its end: words, classes, counts; and the lengths."""
        words, sizes = [], []
        for text in texts:
            own = split(text)
            words += own
            words.append(None)
            sizes.append(len(own) + 1)
        self[None] = self.end
        codes = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return words, (codes & ((1 << CLASS_BITS) - 1)).astype(np.int32), codes >> CLASS_BITS, np.array(sizes, np.int64)


def contexts(classes, sizes):
    """For each position the classes before it in its text, nearest first; END before the start."""
    place = np.arange(len(classes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((CONTEXT, len(classes)), np.int32)
    for k in range(CONTEXT):
        out[k, k + 1:] = classes[: -k - 1]
        out[k][place <= k] = END
    return out


def _sums(places, values, size):
    """The rows of ``values`` summed by place."""
    order = np.argsort(places.astype(np.uint16), kind="stable")
    ordered = places[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    out = np.zeros((size, values.shape[1]), "f4")
    out[ordered[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


class LogBilinear:
    """Score of class w after context c: (sum over places k of weight_k * vector of c_k) . target_w + bias_w."""

    def __init__(self, unigram: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = len(unigram)
        self.unigram = unigram / unigram.sum()
        self.vectors = rng.normal(0, 0.1, (size, WIDTH)).astype("f4")
        self.targets = rng.normal(0, 0.1, (size, WIDTH)).astype("f4")
        self.weights = np.full((CONTEXT, WIDTH), 1 / CONTEXT, "f4")
        self.bias = np.log(self.unigram).astype("f4")

    def parts(self):
        return [self.vectors, self.targets, self.weights, self.bias]

    def set(self, flat):
        at = 0
        for part in self.parts():
            part[...] = flat[at: at + part.size].reshape(part.shape)
            at += part.size
        return self

    def train(self, classes, sizes, rng, memory):
        """One pass of noise-contrastive estimation over the positions, by AdaGrad steps.

        Each batch shares NOISE noise words drawn from the unigram; a word is told from noise by
        the logistic of its score less log(NOISE * unigram).
        """
        before = contexts(classes, sizes)
        log_noise = np.log(NOISE * self.unigram).astype("f4")
        size = len(self.bias)
        for start in range(0, len(classes), BATCH):
            c, w = before[:, start: start + BATCH], classes[start: start + BATCH]
            noise = rng.choice(size, NOISE, p=self.unigram)
            looked = [self.vectors[c[k]] for k in range(CONTEXT)]
            q = sum(v * self.weights[k] for k, v in enumerate(looked))
            target = self.targets[w]
            true = 1 / (1 + np.exp(-np.clip((q * target).sum(1) + self.bias[w] - log_noise[w], -30, 30))) - 1
            far = self.targets[noise]
            fake = 1 / (1 + np.exp(-np.clip(q @ far.T + (self.bias - log_noise)[noise], -30, 30)))
            dq = true[:, None] * target + fake @ far
            grad_t = _sums(w, true[:, None] * q, size)
            np.add.at(grad_t, noise, fake.T @ q)
            grad_b = np.bincount(w, true, size) + np.bincount(noise, fake.sum(0), size)
            grad_v = sum(_sums(c[k], dq * self.weights[k], size) for k in range(CONTEXT))
            grad_w = np.stack([np.einsum("ij,ij->j", dq, v) for v in looked])
            for part, grad, seen in zip(self.parts(), (grad_v, grad_t, grad_w, grad_b), memory):
                grad = grad.astype("f4") / len(w)
                seen += grad * grad
                part -= RATE * grad / (np.sqrt(seen) + 1e-6)

    def log_probs(self, classes, sizes):
        """Natural log probability of each position's class, normalised over all classes."""
        before = contexts(classes, sizes)
        out = np.empty(len(classes))
        # The bias as one more place of the product; a shift for all rows keeps the powers in range.
        matrix = np.concatenate([self.targets, (self.bias - self.bias.max())[:, None]], 1).T.copy()
        ones = np.ones(len(self.bias), "f4")
        q = np.ones((AT_ONCE, WIDTH + 1), "f4")
        for start in range(0, len(classes), AT_ONCE):
            c, w = before[:, start: start + AT_ONCE], classes[start: start + AT_ONCE]
            q[: len(w), :WIDTH] = sum(self.vectors[c[k]] * self.weights[k] for k in range(CONTEXT))
            logits = q[: len(w)] @ matrix
            logits -= max(0.0, float(logits.max()) - 40)
            at = logits[np.arange(len(w)), w]
            np.exp(logits, out=logits)
            out[start: start + AT_ONCE] = at - np.log(logits @ ones)
        return out


# ---- counts ---------------------------------------------------------------------------------------------

COUNTS = "word binary, n long"


def _counted(batches):
    counts = Counter()

    def rows():
        made = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return made

    for whole in batches:
        for batch in blocks(whole, "text"):
            for text in batch.column("text").to_pylist():
                counts.update(split(text))
            if len(counts) > COUNTED:
                yield rows()
    yield rows()


def token_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, ends left out: counted in each task, then summed by word."""
    return texts.select("text").mapInArrow(_counted, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


class Corpus:
    """What every task knows: totals, the counts of frequent words, sums by tail class."""

    def __init__(self, counts: DataFrame, n_texts: int):
        # Words by their counts' eleven leading bits: at most 65,536 numbers of words, however many words.
        level = F.expr("struct(length(bin(n)) AS o, shiftright(n, greatest(length(bin(n)) - 11, 0)) AS v)")
        leveled, words, least, share = counts.withColumn("level", level), 0, None, 0.0
        for (o, v), many in sorted(((tuple(r.level), r["count"]) for r in leveled.groupBy("level").count().collect()), reverse=True):
            if words + many > KNOWN:  # of the words at the bound those with small hashes are known
                least, share = (o, v), (KNOWN - words) / many
                break
            words += many
        if least is not None:
            at = F.expr(f"struct({least[0]} AS o, {least[1]}L AS v)")
            small = F.pmod(F.xxhash64("word"), F.lit(1 << 31)) < int(share * (1 << 31))
            leveled = leveled.where((F.col("level") > at) | ((F.col("level") == at) & small))
        top = leveled.select("word", "n").collect()
        top.sort(key=lambda r: (-r.n, bytes(r.word)))
        self.vocabulary = Vocabulary([(bytes(r.word), r.n) for r in top], HEADS, n_texts)
        heads = [bytes(r.word) for r in top[:HEADS]]
        tail = counts.where(~F.col("word").isin(heads)) if heads else counts
        by_tail = tail.groupBy((F.crc32(F.expr("substring(word, greatest(length(word) - 2, 1), 3)")) % TAILS).alias("tail")).agg(
            F.sum("n"), F.count("*")).collect()
        self.tail_n, self.tail_words = np.zeros(TAILS), np.zeros(TAILS)
        for cls, n, words in by_tail:
            self.tail_n[cls], self.tail_words[cls] = n, words
        self.n_texts = n_texts
        self.tokens = int(n_texts + sum(r.n for r in top[:HEADS]) + self.tail_n.sum())
        self.words = int(len(heads) + self.tail_words.sum() + (n_texts > 0))
        unigram = np.concatenate([[n_texts], [r.n for r in top[:HEADS]], self.tail_n]) + 1.0
        self.model = LogBilinear(unigram)

    def base(self, count) -> float:
        """log10 of a token's smoothed share, from its count."""
        return np.log10((count + 1) / (self.tokens + self.words + 1))


def train(texts: DataFrame, corpus: Corpus, piece_tokens: int = PIECE_TOKENS, rounds: int = ROUNDS) -> LogBilinear:
    """Train on all ``texts`` (doc_id, text) in rounds of equal pieces.

    A piece is what the hash of its rows says, about ``piece_tokens`` tokens, and is read in the order of
    these hashes, so the model depends on the texts and not on how the table is split. The models
    of a round, a few thousand numbers for each piece, are summed by place and averaged by tokens;
    the next round, over other texts, starts from the average. All texts are read once.
    """
    shared = texts.sparkSession.sparkContext.broadcast(corpus)
    n_pieces = rounds * max(1, round(corpus.tokens / (piece_tokens * rounds)))
    key = F.xxhash64("doc_id", "text")
    keyed = texts.select("text", key.alias("key"), F.pmod(key, F.lit(n_pieces)).alias("piece"))
    for number in range(rounds):
        start = np.concatenate([p.ravel() for p in corpus.model.parts()])

        def fit(batches, start=start):
            known, open_ = shared.value, None

            def row(model, seen):
                flat = np.concatenate([p.ravel() for p in model.parts()]).astype(np.float64) * seen
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), seen))],
                    names=["place", "value", "weight"])

            for whole in batches:
                for batch in blocks(whole, "text"):
                    pieces = batch.column("piece").to_numpy()
                    cuts = np.flatnonzero(np.concatenate([[True], pieces[1:] != pieces[:-1], [True]]))
                    for low, high in zip(cuts[:-1], cuts[1:]):
                        if open_ is None or open_[0] != pieces[low]:
                            if open_ is not None:
                                yield row(*open_[1:3])
                            model = LogBilinear(known.model.unigram).set(start)
                            memory = [np.full(p.shape, 1e-3, "f4") for p in model.parts()]
                            open_ = [pieces[low], model, 0, memory, np.random.default_rng([3, int(pieces[low])])]
                        texts_ = batch.column("text").slice(low, high - low).to_pylist()
                        _, classes, _, sizes = known.vocabulary.read(texts_)
                        open_[1].train(classes, sizes, open_[4], open_[3])
                        open_[2] += len(classes)
            if open_ is not None:
                yield row(*open_[1:3])

        some = keyed.where(F.col("piece") % rounds == number).repartition("piece").sortWithinPartitions("piece", "key")
        parts = some.mapInArrow(fit, "place long, value double, weight long")
        mean = parts.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value")).orderBy("place").collect()
        if mean:
            corpus.model.set(np.array([r.value for r in mean]))
    return corpus.model


PART_TYPES = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64())
PART = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())])


def scores(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out. A text's tokens are its words and one end; null
    counts as empty, so its one token is the end. base_score and score are log10; rare words are
    joined to their counts, frequent ones are looked up. Repeated rows count, and are scored, as
    often as they come. Other columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       held_out().alias("held_out"), "text")
    learnt = rows.where(~F.col("held_out"))
    counts = staged(token_counts(learnt), "token-counts")
    corpus = Corpus(counts, learnt.count())
    corpus.model = train(learnt, corpus)
    shared = docs.sparkSession.sparkContext.broadcast(corpus)
    n_heads, share = corpus.vocabulary.n_heads, np.log10(corpus.tail_n + corpus.tail_words + 1)

    def score(batches):
        known = shared.value
        for whole in batches:
            for batch in blocks(whole, "text"):
                words, classes, count, sizes = known.vocabulary.read(batch.column("text").to_pylist())
                first = np.cumsum(sizes) - sizes
                logs = known.model.log_probs(classes, sizes) / np.log(10)
                tails = classes > n_heads
                # Words outside the table stand here with count 0; the join adds what their counts add.
                logs[tails] += np.log10(count[tails] + 1.0) - share[classes[tails] - n_heads - 1]
                n = batch.num_rows
                none = pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())
                totals = [np.add.reduceat(x, first) for x in (count > 0, known.base(count), logs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(sizes),
                     pa.array(totals[0].astype(np.int64)), pa.array(totals[1]), pa.array(totals[2]), *none], names=PART.names)
                at = np.flatnonzero(count == 0)
                at = at[np.not_equal(classes[at], END)]
                if len(at):
                    owner = batch.column("row").take(pa.array(np.searchsorted(first, at, "right") - 1)).to_pylist()
                    rare = Counter(zip(owner, map(words.__getitem__, at.tolist())))
                    keys, unknown = zip(*rare)
                    gone = [pa.nulls(len(keys), PART_TYPES[i]) for i in range(1, 7)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), *gone, pa.array(unknown, pa.binary()),
                         pa.array(list(rare.values()), pa.int64())], names=PART.names)

    parts = rows.mapInArrow(score, PART)
    # Rows without a word are spread over the join by their row number, they match nothing.
    key = F.coalesce("word", F.col("row").cast("string").cast("binary"))
    joined = parts.withColumn("key", F.concat(F.when(F.col("word").isNull(), F.lit(b"\x00")).otherwise(F.lit(b"\x01")), key)).join(
        counts.select(F.concat(F.lit(b"\x01"), "word").alias("key"), "n"), "key", "left")
    gain = F.log10(F.col("n") + 1) * F.col("times")
    done = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("times"))), F.lit(0))).alias("n_known"),
        (F.sum("base_score") + F.coalesce(F.sum(gain), F.lit(0.0))).alias("base_score"),
        (F.sum("score") + F.coalesce(F.sum(gain), F.lit(0.0))).alias("score"))
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(corpus.tokens).cast("long").alias("train_tokens"),
                       "base_score", "score")
