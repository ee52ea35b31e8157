"""Secret scans: fixed patterns, and formats learnt as probabilistic automata from labelled credentials."""

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.sampling import by_hash
from postsift.llm.text import blocks
from postsift.session import staged

# The base patterns, the least length of what they must match, and the order of kinds.
KINDS = ("assign", "access", "hex", "grammar")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18

# At most so many labelled credentials of each kind, and ordinary words, are learnt from.
SAMPLE = 400
LONGEST_LEARNT = 128
ALPHA = 0.01
SMOOTHING = 0.05
ALPHABET = 67  # the candidate characters
# A candidate is a secret when a format explains each of its characters this many nats better
# than ordinary words do, and about as well as it explains the credentials it was learnt from.
MARGIN = 0.7
SLACK = 0.5


def base_spans(text: str) -> list:
    """(start, end, kind number) of the base matches, in code points; leftmost, not overlapping per kind."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


# ---- grammar inference ----------------------------------------------------------------------------------


class Automaton:
    """A probabilistic automaton learnt from strings by merging compatible states of their prefix tree.

    States are taken breadth first; one whose ending and outgoing frequencies agree, down its
    whole subtree, with those of a state already kept (Hoeffding bound at ``ALPHA``) is folded into
    it, otherwise it is kept (Carrasco and Oncina 1994).
    """

    def __init__(self, strings: list):
        self.count, self.end, self.next = [0], [0], [{}]
        for text in strings:
            state = 0
            self.count[0] += 1
            for symbol in text:
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.count)
                    self.count.append(0)
                    self.end.append(0)
                    self.next.append({})
                state = self.next[state][symbol]
                self.count[state] += 1
            self.end[state] += 1
        # How often each edge was taken; the same as the target's count until states merge.
        self.taken = [{s: self.count[t] for s, t in out.items()} for out in self.next]
        self._bound = math.sqrt(0.5 * math.log(2 / ALPHA))
        kept, front = [0], [(0, s) for s in self.next[0]]
        while front:
            fresh = []
            for state, symbol in front:
                target = self.next[state].get(symbol)
                if target is None or target in kept:
                    continue
                mate = next((k for k in kept if self._compatible(k, target)), None)
                if mate is None:
                    kept.append(target)
                    fresh += [(target, s) for s in self.next[target]]
                else:
                    self.next[state][symbol] = mate
                    self._fold(mate, target, fresh, kept)
            front = fresh
        rates = [self.per_symbol(s) for s in strings]
        self.floor = min(rates) - SLACK if rates else math.inf

    def _differ(self, f1, n1, f2, n2) -> bool:
        return abs(f1 / n1 - f2 / n2) > self._bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n1, n2 = self.count[a], self.count[b]
            if self._differ(self.end[a], n1, self.end[b], n2):
                return False
            for symbol in self.next[a].keys() | self.next[b].keys():
                if self._differ(self.taken[a].get(symbol, 0), n1, self.taken[b].get(symbol, 0), n2):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    pairs.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, a: int, b: int, fresh: list, kept: list) -> None:
        pairs, kept = [(a, b)], set(kept)
        while pairs:
            a, b = pairs.pop()
            self.count[a] += self.count[b]
            self.end[a] += self.end[b]
            for symbol, target in self.next[b].items():
                self.taken[a][symbol] = self.taken[a].get(symbol, 0) + self.taken[b][symbol]
                if symbol in self.next[a]:
                    pairs.append((self.next[a][symbol], target))
                else:
                    self.next[a][symbol] = target
                    if a in kept:
                        fresh.append((a, symbol))

    def per_symbol(self, text: str) -> float:
        """Mean log likelihood of the characters; an unseen one is unlikely and leaves the state as it is."""
        total, state = 0.0, 0
        for symbol in text:
            n = self.count[state] + SMOOTHING * ALPHABET
            total += math.log((self.taken[state].get(symbol, 0) + SMOOTHING) / n)
            state = self.next[state].get(symbol, state)
        return total / len(text)


class Formats:
    """The automata of all kinds and the model of ordinary words."""

    def __init__(self, labelled: dict, ordinary: list):
        self.automata = [Automaton(strings) for _, strings in sorted(labelled.items()) if strings]
        self.pairs: dict = {}
        self.singles: dict = {}
        for word in ordinary:
            for a, b in zip(" " + word, word):
                self.pairs[a, b] = self.pairs.get((a, b), 0) + 1
                self.singles[a] = self.singles.get(a, 0) + 1

    def ordinary(self, text: str) -> float:
        total = 0.0
        for a, b in zip(" " + text, text):
            total += math.log((self.pairs.get((a, b), 0) + 0.5) / (self.singles.get(a, 0) + 0.5 * ALPHABET))
        return total / len(text)

    def secret(self, text: str) -> bool:
        """Whether one and the same format passes both tests."""
        ordinary = self.ordinary(text)
        rates = ((a.per_symbol(text), a.floor) for a in self.automata)
        return any(rate >= floor and rate - ordinary >= MARGIN for rate, floor in rates)

    def spans(self, text: str) -> list:
        """The base matches and the learnt ones; those inside a base match are not given again."""
        base = sorted(base_spans(text), key=lambda s: (s[0], s[2]))
        found, at, reach = [], 0, 0  # reach: how far the base matches go that start at or before the candidate
        if self.automata:
            for m in CANDIDATE.finditer(text):
                while at < len(base) and base[at][0] <= m.start():
                    reach = max(reach, base[at][1])
                    at += 1
                if m.end() > reach and self.secret(m.group()):
                    found.append((m.start(), m.end(), 3))
        return sorted(base + found, key=lambda s: (s[0], s[2]))


LABELLED = "kind int, value string"


def _labels(batches):
    """Credentials that the base patterns label, and the first ordinary words of each text."""
    for whole in batches:
        for batch in blocks(whole, "text"):
            rows = set()
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                base = base_spans(text)
                for start, end, kind in base:
                    match = ASSIGN.match(text, start) if kind == 0 else None
                    rows.add((kind, match.group(2) if match else text[start:end]))
                if not base:
                    word = CANDIDATE.search(text)
                    if word:
                        rows.add((3, word.group()))
            kinds, values = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.string())], names=["kind", "value"])


def learn(docs: DataFrame, sample: int = SAMPLE) -> Formats:
    """Formats from at most ``sample`` labelled credentials of each kind, spread by hash over all texts.

    Credentials of over LONGEST_LEARNT characters are found like others but not learnt from.
    """
    found = staged(docs.select("text").mapInArrow(_labels, LABELLED).where(
        F.length("value") <= LONGEST_LEARNT).distinct(), "credentials")
    chosen: dict = {k: [] for k in range(4)}
    for kind in chosen:
        rows = by_hash(found.where(F.col("kind") == kind), sample, "value")
        chosen[kind] = [r.value for r in rows.collect()]
    ordinary = chosen.pop(3)
    return Formats(chosen, ordinary)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


REPORT = ("doc_id long, n_assign long, n_access long, n_hex long, n_grammar long, "
          "base_sha256 string, spans string")


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256, spans.

    Spans are kind:start:end in code points, by start and kind. Null texts count as empty and have
    none; without any labelled credential only the base patterns count. Repeated rows
    are reported each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, sample))

    def report(batches):
        formats = shared.value
        for whole in batches:
            for batch in blocks(whole, "text"):
                columns = [[] for _ in range(6)]
                for text in batch.column("text").to_pylist():
                    spans = formats.spans(text or "")
                    kinds = np.bincount([k for _, _, k in spans], minlength=4).tolist()
                    base = _joined([s for s in spans if s[2] < 3])
                    for column, value in zip(columns, kinds + [hashlib.sha256(base.encode()).hexdigest(), _joined(spans)]):
                        column.append(value)
                arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:]]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + arrays, names=[
                    "doc_id", "n_assign", "n_access", "n_hex", "n_grammar", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(report, REPORT)


MASK = "[SECRET]"


def masked(text: str, spans: list) -> str:
    """The text with each span, or run of overlapping spans, replaced by the mask."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with secrets in ``text`` masked (and n_chars, if there is one, set anew); null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, sample))
    at = docs.columns.index("text")

    def replace(batches):
        formats = shared.value
        for whole in batches:
            for batch in blocks(whole, "text"):
                texts = [t and masked(t, formats.spans(t)) for t in batch.column(at).to_pylist()]
                yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(replace, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
