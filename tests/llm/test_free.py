"""The other operators against brute force, libraries and round trips."""

import base64
import hashlib
import io
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from graphvec.llm import bpe, licenses, lm_score, near_copies, simhash, suffix_dedup, token_counts, warc

CLIP = public_tokenizers.path("word_bpe_49k.json")


def docs(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("clash")).repartition(partitions)


# --- 1 token counts ------------------------------------------------------------------------

def test_token_counts(spark):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "a b c", "the quick brown fox " * 900, "é中<|endoftext|>", "a b c", "x" * 5000, " " * 3000, "a" + "\n" * 2000 + "b" + " \t" * 999 + "\u3000c " + "\x1f" * 1500]
    lengths = sorted(len(own.encode_ordinary(t or "")) for t in texts)
    made = token_counts.encoded_lengths(docs(spark, list(enumerate(texts))), path, public_tokenizers.PATTERN)
    hist = token_counts.histogram(made)
    table = token_counts.context_table(hist)
    for r in table.collect():
        n = r["n_tokens"]
        assert r["n_docs"] == lengths.count(n) and r["docs_at_least"] == sum(x >= n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n) and r["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert (r["total_docs"], r["total_tokens"]) == (len(lengths), sum(lengths))
    limits = token_counts.at_limits(table, [0, 3, 100, 10**6]).collect()
    assert [tuple(r) for r in limits] == [(k, sum(x > k for x in lengths), sum(min(x, k) for x in lengths), sum(max(x - k, 0) for x in lengths)) for k in (0, 3, 100, 10**6)]
    assert [r["n_tokens"] for r in token_counts.quantiles(table, [0.01, 0.5, 1.0]).collect()] == [lengths[0], lengths[4], lengths[-1]]
    empty = token_counts.histogram(made.limit(0))
    assert token_counts.context_table(empty).count() == 0 and token_counts.at_limits(token_counts.context_table(empty), [5]).first()["tokens_kept"] == 0


def test_very_long_runs():
    """Millions of equal characters: as many tokens as a shorter run's, in proportion."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        encoding = token_counts._encoding(f.read(), public_tokenizers.PATTERN)
    n = token_counts.count_tokens
    assert n(encoding, "a" + " " * 2_000_000 + "b") == len(encoding._encode_single_piece(" " * 1_999_999)) + 2
    assert n(encoding, " " * 2_000_000) > 0 and n(encoding, "x" * 2_000_000) > 0 and n(encoding, "-" * 2_000_000) > 0


# --- 2 suffix-array dedup ------------------------------------------------------------------

def brute_repeats(rows):
    first = {}
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i : i + 50], d)
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        keep = np.ones(len(b), bool)
        for i in range(len(b) - 49 if d is not None else 0):
            if first[b[i : i + 50]] < d:
                keep[i : i + 50] = False
        spans = int((np.diff(np.concatenate(([0], (~keep).astype(int)))) == 1).sum())
        out[d] = (len(b), int((~keep).sum()), spans, np.frombuffer(b, np.uint8)[keep].tobytes())
    return out


@pytest.mark.parametrize(("hot", "bits", "batch"), [(100_000, 64, 8 << 20), (3, 64, 2000), (100_000, 3, 8 << 20)])
def test_repeated_strings(spark, monkeypatch, hot, bits, batch):
    """Whole batches, hot anchors split down to strings, and a hash of three bits that collides."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    r = random.Random(3)
    base = ["".join(r.choice("abcdé \n") for _ in range(r.randint(0, 400))) for _ in range(12)]
    rows = []
    for i in range(150):
        t = ""
        for _ in range(r.randint(0, 4)):
            x = r.choice(base)
            a = r.randint(0, max(0, len(x) - 1))
            t += x[a : a + r.randint(30, 200)] + r.choice(["", "x", "a" * 80])
        rows.append((i, t))
    rows += [(None, rows[5][1]), (1000, None), (1001, "a" * 300), (1002, "a" * 120), (1003, "ab" * 200), (1004, "b" + "ab" * 100), (1005, ""), (1006, "c" * 49)]
    r.shuffle(rows)
    got = suffix_dedup.remove_repeats(docs(spark, rows), hot=hot, hash_bits=bits).collect()
    assert {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) for x in got} == brute_repeats(rows) and len(got) == len(rows)


def test_a_passage_in_every_document(spark):
    """A line of 40 bytes with a different surrounding in each of 300 documents, and a passage
    of 70 bytes in all of them: an anchor that is split by its neighbourhoods."""
    r = random.Random(4)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    line, passage = noise(40), noise(70)
    rows = [(i, noise(r.randint(20, 60)) + line + noise(r.randint(10, 60)) + passage + noise(r.randint(0, 30))) for i in range(300)]
    for hot in (100_000, 20):
        got = suffix_dedup.remove_repeats(docs(spark, rows, 1), hot=hot).collect()
        assert {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) for x in got} == brute_repeats(rows)


def test_a_doc_id_with_different_texts(spark):
    """Each row is judged on its own text, and rows of one doc_id never remove from one another."""
    p, q = "passage one of more than fifty bytes, all of which come again", "another passage that is also longer than fifty bytes in all"
    rows = [(1, p), (1, "short"), (1, ""), (1, p + q), (2, p), (2, None), (2, "x" + q), (3, p[:20]), (3, q + p)]
    got = sorted((x["doc_id"], bytes(x["kept"])) for x in suffix_dedup.remove_repeats(docs(spark, rows)).collect())
    want = [(1, p), (1, "short"), (1, ""), (1, p + q), (2, ""), (2, ""), (2, "x"), (3, p[:20]), (3, "")]
    assert got == sorted((d, t.encode()) for d, t in want)


def test_anchors_of_a_long_text_do_not_depend_on_segments(monkeypatch):
    b = np.random.default_rng(2).integers(97, 101, 20_000).astype(np.uint8)
    whole = suffix_dedup.anchors_of(b)
    for size in (64, 999, 5000):
        monkeypatch.setattr(suffix_dedup, "SEGMENT", size)
        assert all((x == y).all() for x, y in zip(whole, suffix_dedup.anchors_of(b)))


def test_collapsing_a_bucket_keeps_its_rows():
    """Rows given in many parts, with a collapse after each, mark what one sorting marks."""
    r = np.random.default_rng(5)
    h, c, doc, place = (r.integers(0, k, 400) for k in (5, 4, 30, 3))
    columns = *(suffix_dedup._short(x.astype(np.uint64)) for x in (h, c)), doc, place, np.zeros(400, np.uint8)
    seen = []
    for parts in (1, 40):
        bucket, out = suffix_dedup.Bucket(False), []
        for x in zip(*(np.array_split(k, parts) for k in columns)):
            out += list(bucket.add(suffix_dedup._pack(*x)))
            out += list(bucket.collapse()) if parts > 1 else []
        out += list(bucket.close())
        rows = [x for b in out for x in b.to_pylist()]
        edges = {(x["doc_id"], x["place"], x["anchor"]) for x in rows if x["anchor"] is not None}
        claims = {(x["doc_id"], x["place"]) for x in rows if x["pdoc"] is not None}
        seen.append((edges, claims))
    assert seen[0] == seen[1] and seen[0][0] and seen[0][1]


def test_repeated_rows_and_empty_tables(spark):
    got = suffix_dedup.remove_repeats(docs(spark, [(1, "q" * 60), (1, "q" * 60), (2, "q" * 60)])).collect()
    assert sorted((x["doc_id"], x["n_removed"]) for x in got) == [(1, 0), (1, 0), (2, 60)]
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_cover_ranks_order_suffixes():
    r = np.random.default_rng(1)
    text = r.integers(97, 99, (50, suffix_dedup.SLOT)).astype(np.uint8)
    text[7] = text[3]
    ranks = suffix_dedup.cover_ranks(text)
    wide = np.concatenate((text, np.zeros((50, 39), np.uint8)), axis=1)
    keys = {(c, i): wide[i, c : c + 39].tobytes() for c in ranks for i in range(50)}
    order = {k: n for n, k in enumerate(sorted(set(keys.values())))}
    assert all(ranks[c][i] == order[keys[c, i]] for c, i in keys)


# --- 5 licenses ----------------------------------------------------------------------------

def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"]
    worn = mit.replace("free of charge,", "").replace("sublicense", "relicense").replace("furnished", "kindly furnished")
    texts = ["foo Released under the MIT License. bar", f"İ{mit}\nmore", worn, "Released under the", None, "", "the following conditions of the software " * 50,
             "x Licensed under CC BY-NC 4.0. y Licensed under CC BY-NC 4.0."]
    got = Counter()
    for r in licenses.find_licenses(docs(spark, list(enumerate(texts)))).collect():
        got[r["doc_id"], r["license"]] += 1
        span = texts[r["doc_id"]][r["start"] : r["end"]]
        assert r["n_matched"] <= r["n_template"] and r["coverage"] >= 0.8 and span[0].isalnum() and span[-1].isalnum()
    assert got == {(0, "MIT-notice"): 1, (1, "MIT"): 1, (2, "MIT"): 1, (7, "CC-BY-NC-4.0-notice"): 2}


# --- 6 SimHash -----------------------------------------------------------------------------

def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = {d: d for d in fps}
    for a in fps:
        for b in fps:
            if bin(fps[a] ^ fps[b]).count("1") <= 4:
                low, high = sorted((root[a], root[b]))
                root = {d: low if x == high else x for d, x in root.items()}
    return root


def test_fingerprints():
    for t in (None, "", "One", "a b c d", "The quick  BROWN\tfox É jumps " * 3, "x " * 40_000):
        assert simhash.fingerprint(t) == slow_fingerprint(t)


@pytest.mark.parametrize("cell_rows", [4096, 2])
def test_links_equal_brute_force(spark, cell_rows):
    r = random.Random(6)
    fps = {0: 0, 1: (1 << 64) - 1}
    for d in range(2, 160):
        f = r.choice(list(fps.values())) if d % 3 else r.getrandbits(64)
        for _ in range(r.randint(0, 5) if d % 3 else 0):
            f ^= 1 << r.randrange(64)
        fps[d] = f
    distinct = {}
    for d, f in fps.items():
        distinct.setdefault(f, d)
    points = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, d) for f, d in distinct.items()], "fp bigint, rep bigint")
    from graphvec.operators.components import components

    got = {d: d for d in distinct.values()} | {x["node"]: x["component"] for x in components(simhash.links(points, cell_rows=cell_rows)).collect()}
    assert got == brute_components({d: f for f, d in distinct.items()})


def test_near_duplicates(spark):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(5, long), (3, long + " tail"), (9, long), (4, None), (2, ""), (7, "other text entirely here"), (None, long), (9, long)]
    got = {x["doc_id"]: x["component_id"] for x in simhash.near_duplicates(docs(spark, rows)).collect()}
    fps = {d: slow_fingerprint(t) for d, t in rows if d is not None}
    assert {d: c for d, c in got.items() if d is not None} == brute_components(fps) and got[None] is None
    kept = sorted(str(x["doc_id"]) for x in simhash.keep_one(docs(spark, rows)).collect())
    assert kept == sorted([*map(str, set(brute_components(fps).values())), "None"])
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_the_pipeline_drops_what_only_fingerprints_link(spark):
    """Pairs at 4 or fewer differing bits whose shingle sets are alike to less than four fifths."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = []
    for d in range(0, 4000, 2):
        base = [word() for _ in range(6)] * 8
        other = base + [word() for _ in range(4)]
        rows += [(d, " ".join(base)), (d + 1, " ".join(other))]
    close = [d for d in range(0, 4000, 2) if (slow_fingerprint(rows[d][1]) ^ slow_fingerprint(rows[d + 1][1])).bit_count() <= 4 and len(set(slow_links(rows[d : d + 2]).values())) == 2][:20]
    assert close
    some = [x for d in close for x in rows[d : d + 2]]
    kept = {x["doc_id"] for x in corpus_pipeline.near_duplicate_stage(spark, docs(spark, some), "").collect()}
    assert kept == set(brute_components({d: slow_fingerprint(t) for d, t in some}).values()) and not kept & {d + 1 for d in close}


def slow_links(rows):
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for d, t in rows}
    root = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {d: low if x == high else x for d, x in root.items()}
    return root


def test_parities_never_exceed_the_difference():
    r = np.random.default_rng(4)
    for n, more in ((3, 1), (500, 40), (510, 60), (5000, 900), (9000, 0)):
        a = np.unique(r.integers(0, 1 << 63, n, np.int64).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n - n // 9], r.integers(0, 1 << 63, more, np.int64).astype(np.uint64)]))
        assert near_copies.differing(near_copies.parities(a), near_copies.parities(b)) <= len(np.setxor1d(a, b))
        other = np.unique(r.integers(0, 1 << 63, n, np.int64).astype(np.uint64))
        assert n < 9 or 9 * near_copies.differing(near_copies.parities(a), near_copies.parities(other)) > 2 * n


@pytest.mark.parametrize("cell_rows", [4096, 2])
def test_keep_one_drops_copies_of_similarity_of_four_fifths(spark, cell_rows):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    line = " ".join(word() for _ in range(40))  # a passage that unlike texts share
    rows = [(d, " ".join(word() for _ in range(200)) + " " + line) for d in range(12)]
    for d in range(12):
        for k, changed in enumerate((1, 2, 3, 4, 5, 6)):  # similarity from 0.96 to 0.77
            w = rows[d][1].split()
            for at in range(changed):
                w[20 + 30 * at] = word()
            rows.append((100 + 10 * d + k, " ".join(w)))
    rows += [(500, None), (501, ""), (502, "a b"), (503, "A  b")]
    want = slow_links(rows)
    got = near_copies.near_copies(docs(spark, rows), cell_rows=cell_rows).collect()
    assert {x["doc_id"]: x["component_id"] for x in got} == want and len(got) == len(rows)
    if cell_rows > 2:
        assert {x["doc_id"] for x in simhash.keep_one(docs(spark, rows)).collect()} == set(want.values())


def test_a_crowd_of_half_alike_texts_loses_no_link(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = []
    for d in range(3 * near_copies.CROWD):  # pairs from alike to a similarity of about 0.6
        w = list(base)
        for at in r.sample(range(120), r.randint(0, 4)):
            w[at] = word()
        rows.append((d, " ".join(w)))
    rows += [(d, rows[d + 1][1]) for d in range(0, 60, 20)]  # ids that repeat with another text
    plain = [(k, t) for k, (_, t) in enumerate(rows)]
    for crowd in (near_copies.CROWD, 1):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(near_copies, "CROWD", crowd)
            got = near_copies.near_copies(docs(spark, plain), cell_rows=16).collect()
            assert {x["doc_id"]: x["component_id"] for x in got} == slow_links(plain)
    ids = {x["doc_id"] for x in near_copies.near_copies(docs(spark, rows)).collect()}
    assert ids == {d for d, _ in rows}


# --- 7 BPE ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def clip():
    return Tokenizer.from_file(CLIP), bpe.Encoder(open(CLIP, encoding="utf-8").read())


def by_library(clip, text):
    ids = clip[0].encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids), clip[0].decode(ids, skip_special_tokens=False)


def joined(parts):
    """What the rows of a document hold together, the spaced text without what joins the rows."""
    rows = [[c[0].as_py() for c in p] for p in parts]
    assert [r[0] for r in rows] == list(range(len(rows))) and [r[1] for r in rows] == [False] * (len(rows) - 1) + [True]
    return b"".join(r[2] for r in rows), "".join(r[3] for r in rows)


def agree(clip, text):
    _, _, packed, decoded, _ = clip[1].short([text])
    assert (packed[0].as_py(), decoded[0].as_py()) == by_library(clip, text), repr(text[:80])


def test_bpe_equals_the_library(clip):
    r = random.Random(1)
    parts = ["a", "B", "é", "é", " ", "\n", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "1", "²", "Σ", "ß", "İ", "中", "👍", "...", "|", " ", "\x1c", "\x85", "the", "ing", "Ᲊ", "\U00016ea0"]
    for _ in range(1500):
        agree(clip, "".join(r.choice(parts) for _ in range(r.randint(0, 30))))
    for text in ("a" * 3000, "theing" * 1500, "".join(r.choice("abcdeht") for _ in range(5000)), "!" * 4000, "é" * 2000, "word " * 300_000):
        agree(clip, text)
    for c in [*range(0x3000), *range(0x1E000, 0x1F000), *range(0x10D00, 0x10F00)]:
        agree(clip, f"a{chr(c)}b")


def test_stream_equals_merging_the_whole_word(clip):
    t = clip[1].of
    assert t.lookahead > 0
    r = random.Random(2)
    for n, parts in [*((n, ["th", "e", "ing", "s", "x", "er"]) for n in (1, 5, 700, 2500)), (900, "a"), (900, "ha"), (300, "👍!?"), (800, "abcdefghijklmnop"), *((30, "aeinrst") for _ in range(60))]:
        word = "".join(r.choice(parts) for _ in range(n))
        symbols = [t.alphabet[b] for b in word.encode()]
        whole = t.merge([*symbols[:-1], symbols[-1] + t.suffix])
        assert t.unstable(symbols) <= t.lookahead
        for step in (1, 64, 256) if n < 1000 else (256,):
            assert list(t.stream(symbols, step)) == whole
    with pytest.raises(ValueError):
        t._sufficient_lookahead([("ab", "c")])


def test_memory_of_a_long_word(clip):
    """A word of millions of characters leaves token by token: what is held is a few hundred."""
    t = clip[1].of
    taken = 0

    def symbols():
        nonlocal taken
        for k in range(400_000):
            taken = k
            yield "theingxers"[k * k % 10]

    ahead, given = 0, 0
    for token in t.stream(symbols()):
        given += len(token.removesuffix(t.suffix))
        ahead = max(ahead, taken - given)
    assert given == 400_000 and ahead < t.lookahead + 2 * bpe.STEP


def test_long_texts_equal_the_library(clip, monkeypatch):
    """Texts read a few bytes at a time, with and without white space, in one run or many."""
    monkeypatch.setattr(bpe, "PIECE", 64)
    monkeypatch.setattr(bpe, "RUN", 20)
    r = random.Random(7)
    parts = ["a", "the", "é", "e\u0301", "\u1112\u1161\u11ab", "'", "'s", "'LL", "ll", "<|endoftext|>", "<|endof", "<", "1", "!", "...", "中", "👍", "Σ"]
    for k in range(300):
        text = "".join(r.choice(parts if k % 3 else parts[: r.randint(1, 6)]) for _ in range(r.randint(1, 400)))
        if k % 2:
            text = " ".join(text[i : i + 90] for i in range(0, len(text), 90))
        ids, shown = by_library(clip, text)
        got, spaced = joined(list(clip[1].long(memoryview(text.encode()))))
        assert got == ids and spaced == shown, repr(text)


def test_incremental_text(clip):
    t, d = clip[1].of, clip[1].decoder
    plain = lambda ids, first=True, last=True: d.parts(np.array(ids, np.uint32), np.array([0, len(ids)]), first, last)[1][0].as_py()
    assert plain(t.encode_word("é👍")) == "é👍 "
    a, b = (t.vocab[t.alphabet[x]] for x in "é".encode())
    assert (plain([a], True, False), plain([b], False, True)) == ("", "é") and plain([a]) == "\ufffd"


def test_encode_on_spark(spark, clip, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 1000)
    long = "a word and anotherword " * 300 + "x" * 3000
    rows = [(0, "Hello, World!"), (1, None), (2, ""), (3, "Hello, World!"), (4, long), (5, "x")]
    made = bpe.encode(docs(spark, rows), CLIP)
    got = {x["doc_id"]: (bytes(x["token_bytes"]), x["decoded"], x["fp"]) for x in made.where("doc_id <> 4").collect()}
    assert got[0] == got[3] == (*by_library(clip, "Hello, World!"), "clash") and got[1] == got[2] == (b"", "", "clash")
    sums = {x["doc_id"]: (x["n_tokens"], x["ids_sha256"], x["decoded_sha256"], x["fp"]) for x in bpe.digests(made).collect()}
    for d, t in rows:
        ids, shown = by_library(clip, t or "")
        assert sums[d] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(shown.encode()).hexdigest(), "clash")
    assert bpe.digests(bpe.encode(docs(spark, rows[:0]), CLIP)).count() == 0
    clash = docs(spark, rows[:1]).withColumns({c: F.lit("clash") for c in ("part", "last", "plain", "_text", "a.b")})
    assert bpe.digests(bpe.encode(clash, CLIP)).columns == ["doc_id", "fp", "_text", "a.b", "n_tokens", "ids_sha256", "decoded_sha256", "plain_sha256"]


# --- 9 WARC --------------------------------------------------------------------------------

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("frame", F.lit(1)).repartition(2)


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "u3", "same"), (1, "u1", "same"), (2, None, None), (4, "u\r\n4", ""), (5, "é", "<p>é</p>\r\n\r\nWARC/1.1"), (None, "u", "same"), (1, "u1", "same"), (6, "big", "x" * 700_000)]
    to = f"file://{tmp_path}/w"
    index = warc.write_bundles(pages(spark, rows), to, frame_bytes=256, bundle_bytes=2000)
    got = warc.read_bundles(index).collect()
    want = []
    first = {}
    for p, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if p is not None:
            first.setdefault(h or "", p)
    for p, _, h in rows:
        raw = (h or "").encode()
        other = p is not None and first[h or ""] != p
        want.append((str(p), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if other or (p is None and False) else "response", first[h or ""] if other else None))
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == sorted(want, key=str) or Counter(
        (str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == Counter(want)
    picked = index.where("page_id in (1, 5)")
    assert Counter(r["page_id"] for r in warc.fetch(index, picked).collect()) == {1: 2, 5: 1}
    fs = pyarrow.fs.LocalFileSystem()
    for name in {r["bundle"] for r in index.collect()}:
        path = name.removeprefix("file://")
        with fs.open_input_file(path) as f:
            sizes = [x[2] for x in warc.seek_table(f)]
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(path, "rb").read()), read_across_frames=True).read()
        assert len(plain) == sum(sizes)  # any Zstandard tool reads the bundle
    limited = warc.write_bundles(pages(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long"), (4, "d", "long")]), min_bytes=3)
    assert {r["page_id"]: r["refers_to"] for r in warc.read_bundles(limited).collect()} == {1: None, 2: None, 3: None, 4: 3}
    assert warc.read_bundles(warc.write_bundles(pages(spark, []))).count() == 0


# --- 10 LM scoring -------------------------------------------------------------------------

def corpus(seed=7, n=300):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        t, w = [], r.choice(words)
        for _ in range(r.randint(0, 80)):
            t.append(w)
            w = words[(words.index(w) * 7 + r.randint(0, 2)) % 60]
        out.append((i, " ".join(t)))
    return out


def test_base_score_and_held_out_gain(spark):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "zzz unseen Words é"), (None, "w1 w2"), (1003, "w1 " * 5000)]
    train = [(d, t) for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    c = Counter()
    for _, t in train:
        c.update((t or "").lower().encode().split())
        c[b"end\n"] += 1
    n, v = sum(c.values()), len(c)
    got = lm_score.score(docs(spark, rows), vocab=40, word_slots=1 << 16, byte_slots=1 << 16).collect()
    assert len(got) == len(rows)
    by = {x["doc_id"]: x for x in got}
    for d, t in rows:
        tokens = [*(t or "").lower().encode().split(), b"end\n"]
        x = by[d]
        assert x["held_out"] == ((d, t) not in train) and x["n_tokens"] == len(tokens) and x["n_known"] == sum(w in c for w in tokens) and x["train_tokens"] == n
        assert x["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens))
        assert x["score"] < 0
    held = [x for x in got if x["held_out"] and x["n_tokens"] > 10]
    assert sum(x["score"] for x in held) > 0.8 * sum(x["base_score"] for x in held)
    assert lm_score.score(docs(spark, []), vocab=4, word_slots=1 << 16, byte_slots=1 << 16).count() == 0


def test_bit_probabilities_sum_to_one():
    code = lm_score.Code([(b"a", 50), (b"b", 20), (b"c", 3)], 5, 10)
    r = np.random.default_rng(1)
    tables = lm_score.packed(r.integers(0, 9, (2, 1 << 16)).astype(float), r.integers(0, 9, (2, 1 << 16)).astype(float))
    model = lm_score.WordModel(code, tables, lm_score._word_starts())
    texts = [np.array([2, 3, s, 1]) for s in range(5)]
    whole = model.score([t[:3] for t in texts])
    prefix = model.score([np.array([2, 3])])[0]
    assert np.exp2(whole - prefix).sum() == pytest.approx(1, abs=1e-3)
    speller = lm_score.Speller(lm_score.packed(r.integers(0, 9, (4, 1 << 16)).astype(float), r.integers(0, 9, (4, 1 << 16)).astype(float)), lm_score._byte_starts())
    some = [bytes([b]) for b in range(256) if b not in b" "] 
    assert np.exp2(speller.score(some)).sum() < 1


def test_long_texts_score_alike_in_parts(monkeypatch):
    code = lm_score.Code([(b"a", 50), (b"b", 20)], 5, 10)
    r = np.random.default_rng(2)
    tables = lm_score.packed(r.integers(0, 9, (2, 1 << 16)).astype(float), r.integers(0, 9, (2, 1 << 16)).astype(float))
    ids = r.integers(0, 4, 5000)
    whole = lm_score.WordModel(code, tables, lm_score._word_starts()).score([ids])[0]
    monkeypatch.setattr(lm_score, "PART", 1000)
    assert lm_score.WordModel(code, tables, lm_score._word_starts()).score([ids])[0] == pytest.approx(whole, rel=1e-4)
