"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

How far a token can still change is bounded by the merge list alone.  Cut a word after some
symbol and run the merges, in rank order, on the part and on the whole word side by side.
Their segmentations agree up to a boundary that moves left only when a merge (a, b) takes the
last agreed token a in one run and not in the other; it moves by |a|.  The next such merge
(a', b') has a later rank, and its b' begins with the token at the boundary, so a lies on the
left spine of b'.  The sufficient lookahead is thus the largest sum of |a| over such chains,
found in one pass over the merges.  For the characters at hand only chains whose tokens spell
them count, which leaves a few characters: tokens that end before the longest such chain are
final.  They are emitted and dropped, so memory does not grow with the word.  Every word goes
this way; one that ends before the first emission is stable at its end.

Merges must be proper (both parts of a merge arise from earlier merges), else ValueError.
Long texts are decoded from UTF-8, normalised and split into words PIECE bytes at a time, and a
document leaves as rows of at most about PIECE bytes of text.  Decoding feeds token bytes to an
incremental UTF-8 decoder, which holds at most three bytes from one row of a document to the next.

Edge cases: a null text encodes as an empty one, to no tokens; special tokens' strings in a
text become their ids; texts and words of any length are taken whole; repeated rows encode
alike; an empty table gives no rows; extra columns stay, save that the outputs (part, last,
token_bytes, decoded, plain) replace columns of their names.
"""

from __future__ import annotations

import array
import codecs
import functools
import hashlib
import heapq
import itertools
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE_WORDS = 250_000  # a worker forgets all words when it knows so many
CACHE_TOKENS = 2_000_000
PIECE = 1 << 18  # bytes of a text handled at a time
SLICE_BYTES = 1 << 20  # of short texts handled together
RUN = 1 << 12  # characters of a word before it is read on its own
STEP = 256  # symbols between emissions


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others take code points from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


# Unicode's white space.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

# Letters, numbers and lower-case pairs of Unicode versions newer than Python's.
NEW_LETTERS = ("1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b 1138e 11390-113b5 "
               "113b7 113d1 113d3 11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff 1e5d0-1e5ed 1e5f0")
NEW_NUMBERS = "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa"
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
             **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
_NEW_UPPER = re.compile("[" + "".join(map(chr, NEW_LOWER)) + "]")


def _written(ranges: str) -> str:
    ends = [(r.split("-")[0], r.split("-")[-1]) for r in ranges.split()]
    return "".join(f"\\U{a:0>8}-\\U{b:0>8}" for a, b in ends)


@functools.lru_cache(maxsize=1)
def letters_and_numbers() -> tuple[str, str]:
    """Ranges of the categories L* and N*, for a character class."""
    found = []
    for kind in "LN":
        ranges, start = [], None
        for c in range(sys.maxunicode + 2):
            own = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
            if own and start is None:
                start = c
            elif not own and start is not None:
                ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
                start = None
        found.append("".join(ranges))
    return found[0] + _written(NEW_LETTERS), found[1] + _written(NEW_NUMBERS)


def with_classes(pattern: str) -> str:
    """A split pattern with its property classes written out, for Python's re."""
    letters, numbers = letters_and_numbers()
    pattern = pattern.replace(r"[\p{L}]", rf"[{letters}]").replace(r"[\p{N}]", rf"[{numbers}]")
    return pattern.replace(r"\s", SPACES).replace(r"\p{L}", letters).replace(r"\p{N}", numbers)


class Transducer:
    """A byte-level BPE with an end-of-word suffix, from a tokenizers JSON text."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.alphabet = byte_alphabet()
        self.bytes_of = {c: b for b, c in self.alphabet.items()}
        self.decoder = (j.get("decoder") or {}).get("type")
        pre = j["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = re.compile(with_classes(pre))
        self.words = self.pattern.findall
        letters, numbers = letters_and_numbers()
        self.runs = re.compile(f"[{letters}]+"), re.compile(f"[^{SPACES}{letters}{numbers}]+")
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else (lambda t: [t])
        self.merges = merges
        self.lookahead = self._sufficient_lookahead(merges)

    def _size(self, token: str) -> int:
        return len(token) - (len(self.suffix) if self.suffix and token.endswith(self.suffix) else 0)

    def _sufficient_lookahead(self, merges: list[tuple[str, str]]) -> int:
        left: dict[str, str] = {}
        born: set[str] = set()
        longest: dict[str, int] = {}
        most = 0
        base = set(self.alphabet.values())
        base |= {c + self.suffix for c in base}
        for a, b in merges:
            if any(x not in base and x not in born for x in (a, b)) or a + b in born:
                raise ValueError(f"merge {a} {b} is not proper")
            chain, t = 0, b
            while t is not None:
                chain = max(chain, longest.get(t, 0))
                t = left.get(t)
            longest[a] = max(longest.get(a, 0), self._size(a) + chain)
            most = max(most, longest[a])
            born.add(a + b)
            left[a + b] = a
        return most

    @functools.cached_property
    def chains(self) -> tuple[dict[str, int], dict[tuple[str, str], list[int]], int]:
        """What the first long word asks for: the rank of the first merge that takes a token on
        its left; for (a', a) the ranks of merges (a', b') with a on the left spine of b'; and
        the longest token that is on the left of a merge."""
        first: dict[str, int] = {}
        links: dict[tuple[str, str], list[int]] = {}
        left: dict[str, str] = {}
        for rank, (a, b) in enumerate(self.merges):
            t = b
            while t is not None:
                links.setdefault((a, t), []).append(rank)
                t = left.get(t)
            first.setdefault(a, rank)
            left[a + b] = a
        return first, links, max(map(len, first), default=0)

    def unstable(self, held: list[str]) -> int:
        """How many symbols at the end of a proper prefix of a word may yet merge otherwise: the
        longest chain of merges whose tokens end at its end, one before the other."""
        first, links, widest = self.chains
        text = "".join(held)
        reach, seen, todo = 0, {}, [(len(text), None, -1)]
        while todo:
            end, after, rank = todo.pop()
            for size in range(1, min(widest, end) + 1):
                token = text[end - size : end]
                if after is None:
                    now = first.get(token)
                else:
                    ranks = links.get((token, after))
                    now = next((r for r in ranks if r > rank), None) if ranks else None
                if now is not None and seen.get((end, token), now + 1) > now:
                    seen[end, token] = now
                    reach = max(reach, len(text) - end + size)
                    todo.append((end - size, token, now))
        return reach

    def merge(self, parts: list[str]) -> list[str]:
        """All merges of a part, lowest rank first, then leftmost."""
        ranks = self.ranks
        if len(parts) <= 48:
            get, none = ranks.get, len(ranks)
            order = [get(p, none) for p in zip(parts, parts[1:])]
            while order and (best := min(order)) < none:
                i = order.index(best)
                parts[i] += parts.pop(i + 1)
                del order[i]
                if i:
                    order[i - 1] = get((parts[i - 1], parts[i]), none)
                if i < len(order):
                    order[i] = get((parts[i], parts[i + 1]), none)
            return parts
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, p = heapq.heappop(heap)
            k = after[i]
            if parts[i] != p[0] or k < 0 or parts[k] != p[1]:
                continue
            parts[i], parts[k] = p[0] + p[1], ""
            after[i] = after[k]
            if after[k] >= 0:
                before[after[k]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (q := (parts[x], parts[y])) in ranks:
                    heapq.heappush(heap, (ranks[q], x, q))
        return [p for p in parts if p]

    def stream(self, symbols: Iterable[str], step: int = STEP) -> Iterator[str]:
        """Tokens of one word from its symbols, each as soon as it is stable."""
        source = iter(symbols)
        held = list(itertools.islice(source, step))
        while True:
            more = list(itertools.islice(source, step))
            if not more:
                break
            # held is a proper prefix of the word: none of its symbols is the last
            stable = len(held) - self.unstable(held)
            done = 0
            for token in self.merge(list(held)):
                if done + len(token) > stable:
                    break
                yield token
                done += len(token)
            held = held[done:] + more
        if held:
            held[-1] += self.suffix
            yield from self.merge(held)

    def symbols(self, text: str) -> Iterator[str]:
        return map(self.alphabet.__getitem__, text.encode("utf-8", "surrogatepass"))

    def encode_word(self, word: str) -> list[int]:
        return [self.vocab[t] for t in self.stream(self.symbols(word))]

    # --- long texts

    def pieces(self, raw: memoryview) -> Iterator[tuple[bool, str, bool]]:
        """(special, text, open) of a text's UTF-8 bytes, PIECE at a time: a special token, or
        normalised text; `open` if the next piece goes on without white space between."""
        decode, held = codecs.getincrementaldecoder("utf-8")("replace").decode, ""
        for at in range(0, len(raw), PIECE):
            final = at + PIECE >= len(raw)
            held += decode(bytes(raw[at : at + PIECE]), final)
            cut, goes_on = (len(held), False) if final else self._cut(held)
            found = self.split_special(held[:cut]) if cut else []
            for k, part in enumerate(found):
                yield (True, part, False) if k % 2 else (False, self.normal(part), goes_on and k == len(found) - 1)
            held = held[cut:]

    def _cut(self, text: str) -> tuple[int, bool]:
        """Where to cut: before the last white space, or else where neither a special token nor
        normalisation reaches across."""
        space = None
        for space in _SPACE.finditer(text):
            pass
        if space and space.start():
            return space.start(), False
        longest = max(map(len, self.special), default=0)
        for p in range(len(text) - longest, 0, -1):
            crosses = any(text.startswith(t, p - k) for t in self.special for k in range(1, min(len(t), p + 1)))
            if unicodedata.combining(text[p]) == 0 and text[p] not in composing() and not crosses:
                return p, True
        return 0, True

    def open_words(self, raw: memoryview) -> Iterator[list[str] | Iterator[str]]:
        """Lists of words, and for a word of over RUN characters at the end of a piece its
        tokens, which must be taken before the next list is asked for."""
        source, tail = self.pieces(raw), ""
        for special, text, goes_on in source:
            while True:
                if special:
                    yield [" " + text]
                    break
                text, tail = tail + text, ""
                matches = list(self.pattern.finditer(text))
                if not goes_on:
                    yield [m.group() for m in matches]
                    break
                # up to three characters decide a split, so what ends later is held back
                yield [m.group() for m in matches if m.end() <= len(text) - 3]
                late = next((m for m in matches if m.end() > len(text) - 3), None)
                if late is None:
                    break
                if late.end() < len(text) or len(text) - late.start() <= RUN:
                    tail = text[late.start() :]
                    break
                rest: list = []
                yield self._endless(late.group(), source, rest)
                special, text, goes_on = rest

    def _endless(self, begin: str, source: Iterator[tuple[bool, str, bool]], rest: list) -> Iterator[str]:
        run = self.runs[0] if self.runs[0].match(begin) else self.runs[1]

        def symbols() -> Iterator[str]:
            yield from self.symbols(begin)
            for special, text, goes_on in source:
                own = None if special else run.match(text)
                size = own.end() if own else 0
                yield from self.symbols(text[:size])
                if special or size < len(text) or not goes_on:
                    rest[:] = special, text[size:], goes_on
                    return
            rest[:] = False, "", False

        return self.stream(symbols())

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma: letters are lowered one by one
        if _NEW_UPPER.search(text):
            text = text.translate(NEW_LOWER)
        return text.lower()


_SPACE = re.compile(f"[{SPACES}]")


_SEPARATORS = re.compile("[\x1c-\x1f]").search


def spaced_out(text: str) -> list[str]:
    """`text` split at white space, which str.split takes four characters more for."""
    return text.split() if not _SEPARATORS(text) else list(filter(None, re.split(f"[{SPACES}]+", text)))


@functools.lru_cache(maxsize=1)
def composing() -> frozenset[str]:
    """Characters that normalisation may join to the one before."""
    parts = (unicodedata.decomposition(chr(c)).split() for c in range(sys.maxunicode + 1))
    seconds = {chr(int(p[1], 16)) for p in parts if len(p) == 2 and p[0][0] != "<"}
    return frozenset(seconds | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))})


class Known(dict):
    """What stands between white space -> its number among what was met; the ids of its words
    stand one after another in `flat`.  A special token has white space before it here."""

    def __init__(self, of: Transducer):
        super().__init__()
        self.of = of
        self.flat, self.ends = array.array("I"), array.array("q")

    def __missing__(self, word: str) -> int:
        if word[:1] == " ":
            self.flat.append(self.of.special[word[1:]])
        else:
            for w in self.of.words(word):
                self.flat.extend(self.of.encode_word(w))
        self.ends.append(len(self.flat))
        self[word] = number = len(self)
        return number

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each word has."""
        if len(self) > CACHE_WORDS or len(self.flat) > CACHE_TOKENS:
            self.clear()
            self.flat, self.ends = array.array("I"), array.array("q")
        number = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        ends = np.concatenate((np.zeros(1, np.int64), np.frombuffer(self.ends, np.int64)))  # a copy, and so is what follows
        start = ends[number]
        sizes = ends[number + 1] - start
        before = np.cumsum(sizes) - sizes
        return np.frombuffer(self.flat, np.uint32)[np.repeat(start - before, sizes) + np.arange(int(sizes.sum()))], sizes


class Decoder:
    """Ids to text, one part of a document after another.  `spelled` is what the file's decoder
    gives, and with none token strings joined by spaces; `plain` goes through an incremental
    byte-to-text state machine, where a word's end is a space."""

    def __init__(self, of: Transducer):
        top = max(of.names, default=-1) + 1
        names = [of.names.get(i, "") for i in range(top)]

        def raw(name: str) -> bytes:
            if name in of.special:
                return name.encode()
            end = bool(of.suffix) and name.endswith(of.suffix)
            return bytes(of.bytes_of.get(c, 63) for c in (name.removesuffix(of.suffix) if end else name)) + b" " * end

        self.names, self.raw = pa.array(names, pa.string()), pa.array([raw(n) for n in names], pa.binary())
        self.spaced = of.decoder is None
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def parts(self, ids: np.ndarray, offsets: np.ndarray, first: bool, last: bool) -> tuple[pa.Array, pa.Array]:
        """(spelled, plain) for each run of ids; `first` and `last` tell whether the first run
        begins a document and the last one ends its document."""
        offsets = pa.array(offsets, pa.int32())
        join = lambda values, by: pc.binary_join(pa.ListArray.from_arrays(offsets, values.take(pa.array(ids))), by)
        raws, plain = join(self.raw, b"").to_pylist(), []
        for k, raw in enumerate(raws):
            if k or first:
                self.state.reset()
            plain.append(self.state.decode(raw, last or k < len(raws) - 1))
        plain = pa.array(plain, pa.string())
        if not self.spaced:
            return plain, plain
        spelled = join(self.names, " ")
        if not first and len(ids):  # a space stands between the parts, too
            spelled = pa.array([" " + spelled[0].as_py(), *spelled[1:].to_pylist()], pa.string())
        return spelled, plain


OUTPUT = [("part", T.IntegerType(), pa.int32()), ("last", T.BooleanType(), pa.bool_()), ("token_bytes", T.BinaryType(), pa.binary()),
          ("decoded", T.StringType(), pa.string()), ("plain", T.StringType(), pa.string())]


class Encoder:
    """What a worker holds: a transducer, the words met and a decoder."""

    def __init__(self, spec: str):
        self.of = Transducer(spec)
        self.known, self.decoder = Known(self.of), Decoder(self.of)

    def short(self, texts: list[str]) -> list[pa.Array]:
        """The output columns for texts of at most PIECE bytes, a row each."""
        words, counts = [], []
        for text in texts:
            before = len(words)
            for k, part in enumerate(self.of.split_special(text) if "<" in text else [text]):
                words += [" " + part] if k % 2 else spaced_out(self.of.normal(part))
            counts.append(len(words) - before)
        ids, sizes = self.known.ids(words)
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]
        return self._columns(ids, ends, 0, True, True)

    def _columns(self, ids: np.ndarray, ends: np.ndarray, part: int, first: bool, last: bool) -> list[pa.Array]:
        n = len(ends) - 1
        packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
        return [pa.array(np.full(n, part, np.int32)), pa.array([last] * n), packed, *self.decoder.parts(ids, ends, first, last)]

    def long(self, raw: memoryview) -> Iterator[list[pa.Array]]:
        """The output columns of one text, a row at a time."""
        held, size, part = [], 0, 0

        def chunks() -> Iterator[np.ndarray]:
            for words in self.of.open_words(raw):
                if isinstance(words, list):
                    yield self.known.ids(words)[0]
                    continue
                while some := list(itertools.islice(words, 1 << 15)):
                    yield np.array([self.of.vocab[t] for t in some], np.uint32)

        for ids in chunks():
            if size + len(ids) > PIECE // 4 and size:
                yield self._columns(np.concatenate(held), np.array([0, size]), part, part == 0, False)
                held, size, part = [], 0, part + 1
            held.append(ids)
            size += len(ids)
        yield self._columns(np.concatenate(held) if held else np.zeros(0, np.uint32), np.array([0, size]), part, part == 0, True)


@functools.lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    return Encoder(spec)


def _numbered(columns: list[str]) -> list[Column]:
    """The columns under names that mapInArrow can look up, whatever they are called."""
    return [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)]


def _fields(df: DataFrame, columns: list[str]) -> list[T.StructField]:
    return df.select(*[F.col(f"`{c}`") for c in columns]).schema.fields


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """`docs` without its text, with part, last, token_bytes (token ids as little-endian unsigned
    32-bit integers), decoded (as the file's decoder shows the ids) and plain (the ids' bytes as
    text).  A text of over PIECE bytes has several rows, in order within its partition: part
    counts them from 0, and last is true for the last one."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    made = [name for name, _, _ in OUTPUT]
    rest = [c for c in docs.columns if c != text_col and c.lower() not in made]
    d = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *_numbered(rest))
    schema = T.StructType([*_fields(docs, rest), *[T.StructField(name, kind) for name, kind, _ in OUTPUT]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(spec.value)
        for whole in batches:
            sizes = pc.binary_length(whole.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, start = np.cumsum(sizes), 0
            while start < whole.num_rows:
                done = ends[start] - sizes[start]
                end = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
                long = np.flatnonzero(sizes[start:end] > PIECE)
                end = start + max(1, int(long[0])) if len(long) else end
                b = whole.slice(start, end - start)
                if sizes[start] > PIECE:
                    for columns in tool.long(memoryview(b.column(0)[0].as_buffer())):
                        yield pa.RecordBatch.from_arrays([*b.columns[1:], *columns], names=schema.names)
                else:
                    yield pa.RecordBatch.from_arrays([*b.columns[1:], *tool.short(b.column(0).to_pylist())], names=schema.names)
                start = end

    return d.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """What `encode` gives -> one row for each document, with n_tokens, ids_sha256,
    decoded_sha256 and plain_sha256 for all of its parts, added up as they come."""
    made = [name for name, _, _ in OUTPUT]
    rest = [c for c in encoded.columns if c not in made]
    sums = ["ids_sha256", "decoded_sha256", "plain_sha256"]
    schema = T.StructType([*_fields(encoded, rest), T.StructField("n_tokens", T.LongType()), *[T.StructField(c, T.StringType()) for c in sums]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = 0, []
        for b in batches:
            ends = [k for k, last in enumerate(b.column(len(rest) + 1).to_pylist()) if last]
            rows: list[tuple] = []
            for part, last, *values in zip(b.column(len(rest)).to_pylist(), b.column(len(rest) + 1).to_pylist(), *(b.column(len(rest) + k) for k in (2, 3, 4))):
                if part == 0:
                    n, held = 0, [hashlib.sha256() for _ in sums]
                for h, v in zip(held, values):
                    h.update(v.as_buffer())
                n += values[0].as_buffer().size // 4
                if last:
                    rows.append((n, *[h.hexdigest() for h in held]))
            kept = b.select(list(range(len(rest)))).take(pa.array(ends, pa.int64()))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(cols[0], pa.int64()), *[pa.array(c, pa.string()) for c in cols[1:]]], names=schema.names)

    return encoded.select(*_numbered(rest), *made).mapInArrow(run, schema)
