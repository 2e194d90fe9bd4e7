"""The language model's scores against a mixer that keeps every context by name and goes bit by bit."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphvec.llm import lm_score

VOCAB = 30


class Plain:
    """Counts of contexts in a dict; weights by gate; refined once a chunk."""

    def __init__(self, starts, rate=0.06):
        self.seen, self.starts, self.rate = defaultdict(lambda: [0, 0]), np.array(starts, float), rate

    def count(self, bits):
        for contexts, node, bit, _, _ in bits:
            for k, c in enumerate(contexts):
                self.seen[k, c, node][bit] += 1

    def run(self, bits, weights):
        """log2 probability of bits (contexts, node, bit, first input or None, chunk); `weights` move."""
        total, at = 0.0, 0
        while at < len(bits):
            end = at
            while end < len(bits) and bits[end][4] == bits[at][4]:
                end += 1
            moves, met = defaultdict(lambda: 0.0), Counter()
            for contexts, node, bit, first, _ in bits[at:end]:
                x, gate = [] if first is None else [first], 0
                for k, c in enumerate(contexts):
                    n0, n1 = self.seen.get((k, c, node), (0, 0))
                    x.append(round(min(max(math.log((n1 + 0.4) / (n0 + 0.4)), -8), 8 - 1 / 512) * 512) / 512)
                    gate = (4 * gate + sum(n0 + n1 >= m for m in (1, 4, 32))) % 16
                dot = min(max(float(np.dot(weights[gate], x)), -11), 11)
                sign = 1 - 2 * bit
                odds = math.exp(dot * sign)
                total -= math.log2(1 + odds)
                moves[gate] = moves[gate] + np.array(x) * odds / (1 + odds) * sign
                met[gate] += 1
            for gate, move in moves.items():
                weights[gate] -= self.rate * move / math.sqrt(met[gate] + 16)
            at = end
        return total

    def learn(self, bits):
        weights = self.starts.copy()
        self.run(bits, weights)
        met = {g for g in range(16) if (weights[g] != self.starts[g]).any()}
        self.starts = np.array([np.round(w, 4) if g in met else self.starts[g] for g, w in enumerate(weights)])


def word_bits(code, ids):
    out = []
    for i, t in enumerate(ids):
        one, two = ids[i - 1] if i else 0, ids[i - 2] if i > 1 else 0
        a = code.starts[t]
        for j in range(a, a + code.sizes[t]):
            out.append((((one,), (one, two)), int(code.nodes[j]), int(code.bits[j]), float(code.tree_at[j]), i // lm_score.CHUNK))
    return out


def spelled_bits(words):
    out = []
    for word in words:
        raw = word + b" "
        for i, byte in enumerate(raw):
            contexts = tuple((b"\0" * 4 + raw)[i + 4 - k : i + 4] for k in range(1, 5))
            for k in range(8):
                out.append((contexts, (byte | 256) >> (8 - k), byte >> (7 - k) & 1, None, min(i, 63)))
    return sorted(out, key=lambda b: b[4])


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_equal_those_of_a_plain_mixer(spark, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(50)]
    texts, w = [], 0
    for _ in range(150):
        t = []
        for _ in range(r.randint(0, 90)):
            t.append(words[w] + r.choice(["", "", "", "", "x", "yz"]))
            w = (w * 3 + r.randint(0, 2)) % 50
        texts.append(" ".join(t))
    rows = [*enumerate(texts), (900, ""), (901, None), (902, "unseen " * 60)]
    rows += [(903 + i, "w1 w2 w3 " * 40) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    tokens = {d: (t or "").lower().encode().split() for d, t in rows}
    train = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = Counter(w for d in train for w in tokens[d])
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:VOCAB]
    code = lm_score.Code(top, sum(counts.values()) - sum(c for _, c in top), len(train))
    number = {w: i + 2 for i, (w, _) in enumerate(top)}
    ids = {d: [number.get(w, 0) for w in tokens[d]] + [1] for d, _ in rows}

    # who tells the start weights, and in which order
    h = {x["doc_id"]: x for x in docs.select("doc_id", F.xxhash64("text").alias("apart"), F.xxhash64(F.lit(1), "text", "doc_id").alias("at")).collect()}
    share = sorted((d for d in train if h[d]["apart"] % lm_score.LEARN_SHARE == 0), key=lambda d: h[d]["at"])
    listed = spark.createDataFrame([(w,) for w in counts], "word binary")
    g = {bytes(x["word"]): x for x in listed.select("word", F.xxhash64("word").alias("apart"), F.xxhash64(F.lit(1), "word").alias("at")).collect()}
    word_share = sorted((w for w in counts if g[w]["apart"] % lm_score.LEARN_SHARE == 0), key=lambda w: g[w]["at"])
    assert share and word_share

    model, speller = Plain(lm_score._word_starts()), Plain(lm_score._byte_starts())
    for d in train:
        if d not in share:
            model.count(word_bits(code, ids[d]))
    learned = [(b[0], b[1], b[2], b[3], (k, b[4])) for k, d in enumerate(share) for b in word_bits(code, ids[d])]
    model.learn(learned)
    speller.count(spelled_bits([w for w in counts if w not in word_share]))
    speller.learn(spelled_bits(word_share))
    for d in share:  # what told the weights is counted now
        model.count(word_bits(code, ids[d]))
    speller.count(spelled_bits(word_share))

    # so many slots that no two contexts of these texts share one
    got = {x["doc_id"]: x["score"] for x in lm_score.score(docs, vocab=VOCAB, word_slots=1 << 22, byte_slots=1 << 22).collect()}
    for d, _ in rows:
        want = model.run(word_bits(code, ids[d]), model.starts.copy())
        want += sum(speller.run(spelled_bits([w]), speller.starts.copy()) for w in tokens[d] if w not in number)
        assert got[d] == pytest.approx(want * math.log10(2), rel=2e-3, abs=2e-3), d


def test_counts_of_the_learning_share_are_added(spark):
    """Summing the two parts of the blocks gives the table of all rows."""
    r = np.random.default_rng(3)
    slot, bit = r.integers(0, 1 << 10, 5000), r.integers(0, 2, 5000)
    parts, whole = lm_score.Tally(2, 1 << 10), lm_score.Tally(1, 1 << 10)
    parts.add(0, slot[:4000], bit[:4000])
    parts.add(1, slot[4000:], bit[4000:])
    whole.add(0, slot, bit)
    rows = [tuple(row.values()) for b in parts.blocks() for row in b.to_pylist()]
    blocks = spark.createDataFrame(rows, lm_score.BLOCKS)
    n0, n1 = whole.counts[0].reshape(-1, 2).T.astype(float)
    assert (lm_score.gathered(lm_score.with_share(blocks, 1), 1, 1 << 10)[0] == lm_score.packed(n0, n1)).all()
