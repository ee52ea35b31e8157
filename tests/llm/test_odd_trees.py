"""Repeated messages and circles in reply trees, short benchmark items, fingerprints at the edge of the radius."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from postsift.llm import chat, decontaminate, lang_id, near_dup

MESSAGES = "tree long, node long, parent long, score double, role string, text string"


def walked(rows, per_tree):
    """The same paths by a walk over each tree in Python."""
    lower = lambda v: (v is not None, v if v is not None else 0)  # noqa: E731  nulls first
    trees = {}
    for tree, node, parent, score in sorted(rows, key=lambda r: (lower(r[2]), r[3] or 0.0), reverse=True):
        trees.setdefault(tree, {})[node] = (parent, score or 0.0)
    out = set()
    for tree, nodes in trees.items():
        up = {n: p if p is not None and p in nodes else None for n, (p, _) in nodes.items()}
        for n in nodes:
            ring, at = [n], up[n]
            while at is not None and at not in ring:
                ring.append(at)
                at = up[at]
            if at is not None:
                circle = ring[ring.index(at):]
                up[min(circle)] = None
        leaves = []
        for leaf in set(nodes) - {p for p in up.values() if p is not None}:
            path = [leaf]
            while up[path[-1]] is not None:
                path.append(up[path[-1]])
            leaves.append((-sum(nodes[m][1] for m in path), lower(leaf), path[::-1]))
        for rank, (_, (_, leaf), path) in enumerate(sorted(leaves)[:per_tree], 1):
            out.update((tree, path[-1], rank, depth, m) for depth, m in enumerate(path))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_paths_with_repeats_and_circles_equal_a_walk(spark, seed):
    draw = random.Random(seed)
    rows = []
    for tree in (None, 1, 2, 3):
        for node in range(25):
            parent = draw.choice([None, draw.randrange(27), draw.randrange(node + 1)])
            rows += [(tree, node, parent, float(draw.randrange(5)))] * draw.choice([1, 1, 3])
        rows.append((tree, None, draw.randrange(25), None))
        rows.append((tree, 7, 3, 2.0))
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double")
    got = {tuple(r) for r in chat.paths(df, 3).select("tree", "leaf", "path_rank", "depth", "node").collect()}
    assert got == walked(rows, 3)


def test_circles_alone_and_long_ones(spark):
    ring = [(1, n, (n + 1) % 70, 1.0) for n in range(70)] + [(2, 5, 5, 1.0)]
    df = spark.createDataFrame(ring, "tree long, node long, parent long, score double")
    got = {(r.tree, r.node): r.depth for r in chat.paths(df).collect()}
    assert got == {(2, 5): 0} | {(1, n): (70 - n) % 70 for n in range(70)}


def test_a_message_given_three_times_is_said_once(spark):
    rows = [(1, 1, None, 0.0, "user", "q"), (1, 2, 1, 0.0, "assistant", "a"), (1, 3, 2, 0.0, "user", "r")]
    got = chat.parsed(chat.chat(spark.createDataFrame(rows * 3, MESSAGES))).collect()
    assert [[t.text for t in r.turns] for r in got] == [["q", "a", "r"]] and got[0].loss_text == "a"
    assert chat.chat(spark.createDataFrame(rows, MESSAGES).limit(0)).collect() == []


def test_short_items_are_found_inside_documents(spark):
    texts = ["the  Quick\nbrown fox", "a quick brown dog", "quick", "quickly brown", None, "", "brown quick brown",
             "x " * 50000 + "quick brown"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = {10: "quick brown", 11: "Quick", 12: "brown dog", 13: "the quick brown fox", 14: "no such run", 15: "brown"}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, spark.createDataFrame(list(items.items()), "item_id long, text string"), inside=True).collect()}
    def spaced(text):
        return f" {' '.join((text or '').lower().split())} "
    assert got == {(d, i) for d, t in enumerate(texts) for i, item in items.items() if spaced(item) in spaced(t)}
    index = decontaminate.ItemIndex([(1, "one two"), (2, "a b c d e f")], inside=True)
    assert [r[:2] for r in decontaminate._held(index, pa.array(["z one two", "a b c d e f"]), 0.8)] == [(0, 1), (1, 2)]


def test_every_pattern_of_three_bits_links(spark):
    """A fingerprint, many that differ from it in one to three bits, and some far away: the groups that all pairs give."""
    base = 0x0123456789ABCDEF
    flips = [sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(64), n)]
    draw = random.Random(5)
    chosen = draw.sample(flips, 400) + [1 << b for b in range(64)]
    near = {base} | {base ^ f for f in chosen}
    far = {base ^ 0xF0F0F0F0F0F0F0F0 ^ (0b1111 << 8 * i) for i in range(4)}
    signed = np.array(sorted(near | far), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    groups = []
    for edges in (near_dup.links(df).collect(),
                  [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3]):
        label = {p: p for p in signed}

        def top(p):
            while label[p] != p:
                p = label[p]
            return p

        for a, b in edges:
            label[max(top(a), top(b))] = min(top(a), top(b))
        groups.append({p: top(p) for p in signed})
    assert groups[0] == groups[1]


def test_learning_sample_is_thinned_before_it_meets(spark):
    rows = [(i, f"word{i} and others of number {i}", "en" if i % 3 else "de") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    network = lang_id.learn(df, 20)
    assert network.labels == ["de", "en"]
