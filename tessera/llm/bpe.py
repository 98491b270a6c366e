"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

One pass over the corpus counts its words; the frequent ones, with the ids that exact merging gives them, become a
minimal acyclic automaton. Words with equal endings share states, and the number of words that lie before a path gives
each word its place in the table of ids. The automaton is one flat file: each executor gets its bytes once, writes
them to its own folder and maps the file into memory, so that its workers share the pages. Words that it lacks are merged exactly.

The tokenizer file is a parameter and is read by the driver. It must be of the kind "BPE with word ends": NFC, blanks to
one space, lower case, a split pattern, byte letters. encode() gives what the tokenizers library gives for such a file
without added special tokens, and decode() what it gives with special tokens kept (there is no decoder in the file:
tokens joined by spaces).

Defined results: null and empty texts have no ids and decode to the empty text; the texts of special tokens become their
ids, as in the library; long texts are encoded whole; repeated rows give equal rows; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches

#: Words in the lexicon, and the longest of them in bytes.
LEXICON_WORDS, LONGEST = 1 << 16, 64
#: Distinct chunks that a worker counts, or bytes that it reads, before it hands its counts on.
COUNTED_WORDS, COUNTED_BYTES = 3 << 17, 1 << 26
#: Chunks, or bytes of chunks, of one of two generations whose ids a worker keeps at hand: between two steps the older is dropped.
KEPT_CHUNKS, KEPT_BYTES = 5 << 15, 1 << 23
#: Characters of the texts that are split at once: chunks take many times the memory of their text.
AT_ONCE = 1 << 19


#: What a split pattern must end with for words() to see its common cases at once, and stops that are one word each after letters.
_PLAIN, _STOPS = r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", frozenset(".,!?;:")


def _byte_letters() -> list[str]:
    """The printable letter of each byte, by the public byte-level rule: printable Latin-1 stays, the others count up from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, up = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else up))
        up += b not in plain
    return out


def pieces(text: str) -> Iterator[str]:
    """A text in pieces of about AT_ONCE characters, cut behind ASCII blanks, which neither words nor normal forms cross."""
    begin = 0
    while len(text) - begin > AT_ONCE:
        cut = text.rfind(" ", begin, begin + AT_ONCE) + 1 or text.find(" ", begin + AT_ONCE) + 1
        if not cut:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


#: The letters and numbers that Unicode 16 added, which the library's split engine knows and Python's character table may
#: not; capitals of Unicode 16 and 17, which its lower case knows: (first, last, distance to the small letter).
_ADDED = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139),
    (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
)
_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x0264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x019B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
_SMALL = {c: c + d for a, b, d in _CAPITALS for c in range(a, b + 1)}
#: What the UTF-8 of such a capital holds.
_CAPITAL_BYTES = tuple({chr(c).encode()[: 2 if c < 0x10000 else 3] for c in _SMALL})


def _pattern(source: str) -> regex.Pattern:
    """The split pattern with the classes that the library's engine has: white space is the Unicode property, and what neither
    Python's character table nor Unicode 16 assigns is neither letter nor number."""
    newer = regex.compile(r"[\p{L}\p{N}]")
    added = {c for a, b in _ADDED for c in range(a, b + 1)}
    later = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn" and c not in added and newer.match(chr(c))]
    spans: list[list[int]] = []
    for c in later:
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    minus = "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in spans)
    out = source.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]" if not minus else rf"(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]|[{minus}])")
    if minus:
        out = out.replace(r"[\p{L}]+", rf"[\p{{L}}--[{minus}]]+").replace(r"|[\p{N}]|", rf"|[\p{{N}}--[{minus}]]|")
    return regex.compile(out, regex.V1)


class Vocabulary:
    """What a tokenizer file says: ids, merge ranks, the split pattern and the special tokens."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError("the file must hold a BPE without decoder and post-processor")
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): k for k, (a, b) in enumerate(merges)}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = _pattern(split["pattern"]["Regex"])
        self.plain = split["pattern"]["Regex"].endswith(_PLAIN)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = _byte_letters()
        # merges over ids: a pair of ids to its rank, and the id that each rank makes; only where every symbol has one
        symbols = [self.ids.get(a + end) for end in ("", self.end) for a in self.letters]
        made = [(self.ids.get(a), self.ids.get(b), self.ids.get(a + b)) for a, b in merges]
        self.whole = None not in symbols and all(None not in m for m in made)
        if self.whole:
            self.inner, self.last = symbols[:256], symbols[256:]
            self.pairs = {a << 20 | b: k for k, (a, b, _) in enumerate(made)}
            self.made = [c for _, _, c in made]
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, k in [*self.ids.items(), *self.special.items()]:
            self.tokens[k] = token

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return Vocabulary(json.load(f))

    def clean(self, section: str) -> bytes:
        """Normal form and lower case, character by character (no final sigma)."""
        if section.isascii():
            return section.lower().encode()
        section = unicodedata.normalize("NFC", section)
        if "Σ" in section:
            section = section.replace("Σ", "σ")
        out = section.lower().encode("utf-8", "surrogatepass")
        if any(x in out for x in _CAPITAL_BYTES):
            out = section.lower().translate(_SMALL).encode("utf-8", "surrogatepass")
        return out

    def words(self, chunk: bytes) -> list[bytes]:
        """The words of a chunk without ASCII blanks. Letters alone, or before one ASCII stop, need no look at the pattern."""
        text = chunk.decode("utf-8", "surrogatepass")
        if self.plain:
            if text.isalpha():
                return [chunk]
            if text[-1:] in _STOPS and text[:-1].isalpha():
                return [chunk[:-1], chunk[-1:]]
        return [w.encode("utf-8", "surrogatepass") for w in self.split.findall(text)]

    def merge(self, word: bytes) -> list[int]:
        """Exact merges: always the pair of lowest rank, the leftmost first."""
        if len(word) > 32 or not self.whole:
            return self._merge_long(word) if word else []
        if not word:
            return []
        ids = [self.inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        get, made, never = self.pairs.get, self.made, len(self.made)
        ranks = [get(a << 20 | b, never) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == never:
                break
            k = ranks.index(low)
            ids[k : k + 2] = (made[low],)
            del ranks[k]
            if k < len(ranks):
                ranks[k] = get(ids[k] << 20 | ids[k + 1], never)
            if k:
                ranks[k - 1] = get(ids[k - 1] << 20 | ids[k], never)
        return ids

    def _merge_long(self, word: bytes) -> list[int]:
        """The same with a heap, which keeps a long word at n log n."""
        sym: list[str | None] = [self.letters[b] for b in word]
        sym[-1] += self.end
        n, ranks = len(sym), self.ranks
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = a + b, None
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x in (left[i], i):
                if x >= 0 and (y := right[x]) >= 0 and (r := ranks.get((sym[x], sym[y]))) is not None:
                    heapq.heappush(heap, (r, x, sym[x], sym[y]))
        return [self.ids[s] for s in sym if s is not None and s in self.ids]


def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """A minimal acyclic automaton of words, built from sorted input by merging equal states as soon as they are complete.

    Layout: six int32 (root, states, edges, words, ids, none), the key of each edge as int64 (its state, then its label byte; in order),
    then int32 arrays: the final flag of each state, the words below each edge's earlier siblings (and the state's own word),
    the target of each edge, the start of each word's ids, the ids."""
    entries = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def close(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]
    labels: list[int] = []
    before = b""
    for word, _ in entries:
        common = len(os.path.commonprefix([before, word]))
        while len(labels) > common:
            done = path.pop()
            path[-1][1].append((labels.pop(), close(done)))
        for b in word[common:]:
            path.append([False, []])
            labels.append(b)
        path[-1][0] = True
        before = word
    while labels:
        done = path.pop()
        path[-1][1].append((labels.pop(), close(done)))
    root = close(path[0])
    below = []
    for final, edges in states:  # targets come before their sources
        below.append(final + sum(below[t] for _, t in edges))
    keys, skip, target = [], [], []
    for state, (final, edges) in enumerate(states):
        n = int(final)
        for b, t in edges:
            keys.append(state << 8 | b)
            skip.append(n)
            target.append(t)
            n += below[t]
    starts = np.cumsum([0, *(len(ids) for _, ids in entries)])
    flat = [k for _, ids in entries for k in ids]
    head = np.array([root, len(states), len(target), len(entries), len(flat), 0], "<i4").tobytes()
    arrays = [np.array(a, "<i4") for a in ([f for f, _ in states], skip, target, starts, flat)]
    return head + np.array(keys, "<i8").tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon, mapped into memory: all of its arrays are views of the file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r").view(np.ndarray)
        self.root, n, edges, words, flat, _ = (int(x) for x in raw[:24].view("<i4"))
        at = 24 + 8 * edges
        self.keys = raw[24:at].view("<i8")
        parts = []
        for size in (n, edges, edges, words + 1, flat):
            parts.append(raw[at : at + 4 * size].view("<i4"))
            at += 4 * size
        self.final, self.skip, self.target, self.starts, self.ids = parts

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids (little-endian unsigned 32-bit) of each word, or None. All words walk the automaton together, a byte a step."""
        out: list[bytes | None] = [None] * len(words)
        if not len(self.keys):
            return out
        lengths = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(lengths) - lengths
        live = np.flatnonzero(lengths <= LONGEST)
        state = np.full(len(live), self.root, np.int64)
        place = np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            done = lengths[live] == step
            if done.any():
                for w, p, f in zip(live[done].tolist(), place[done].tolist(), self.final[state[done]].tolist(), strict=True):
                    if f:
                        out[w] = self.ids[self.starts[p] : self.starts[p + 1]].tobytes()
                live, state, place = live[~done], state[~done], place[~done]
            key = state << 8 | flat[begins[live] + step]
            edge = np.searchsorted(self.keys, key)
            edge[edge == len(self.keys)] = 0
            on = self.keys[edge] == key
            live, edge = live[on], edge[on]
            place = place[on] + self.skip[edge]
            state = self.target[edge].astype(np.int64)
            step += 1
        return out


class Codec:
    """Encodes and decodes in one worker."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None):
        self.v, self.lexicon, self.kept, self.size = vocabulary, lexicon, {}, 0
        self.older: dict[bytes, bytes] = {}
        self.pieces = np.array([t.encode() for t in vocabulary.tokens], object)

    def _learn(self, chunks: set[bytes]) -> None:
        """Find the ids of chunks: those of the older generation, those of their words from the lexicon, or else by merging."""
        kept, older = self.kept, self.older
        if older:
            again = chunks & older.keys()
            kept.update(zip(again, map(older.__getitem__, again), strict=True))
            self.size += sum(map(len, again))
            chunks = chunks - again
        parts = {c: self.v.words(c) for c in chunks}
        words = list({w for ws in parts.values() for w in ws})
        found = self.lexicon.find(words) if self.lexicon else [None] * len(words)
        ids = {w: f if f is not None else array("I", self.v.merge(w)).tobytes() for w, f in zip(words, found, strict=True)}
        for c, ws in parts.items():
            self.kept[c] = ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])
            self.size += len(c)

    def encode_batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, step by step."""
        step: list[str] = []
        size = 0
        for text in texts:
            if text and len(text) > AT_ONCE:
                yield from self._step(step)
                step, size = [], 0
                yield b"".join(self._step([part])[0] for part in pieces(text))
                continue
            step.append(text or "")
            size += len(step[-1])
            if size >= AT_ONCE:
                yield from self._step(step)
                step, size = [], 0
        yield from self._step(step)

    def _step(self, texts: list[str]) -> list[bytes]:
        if len(self.kept) >= KEPT_CHUNKS or self.size >= KEPT_BYTES:
            self.older, self.kept, self.size = self.kept, {}, 0
        v, kept = self.v, self.kept
        split: list[list] = []
        new: set[bytes] = set()
        for text in texts:
            sections = []
            for s in v.parts.split(text) if v.parts and "<|" in text else [text]:
                if s in v.special:
                    sections.append(v.special[s])
                else:
                    chunks = v.clean(s).split()
                    new.update(chunks)
                    sections.append(chunks)
            split.append(sections)
        self._learn(new.difference(kept))
        get = kept.__getitem__
        return [b"".join([np.array([s], "<u4").tobytes() if isinstance(s, int) else b"".join(map(get, s)) for s in sections]) for sections in split]

    def encode(self, text: str) -> bytes:
        return next(self.encode_batch([text]))

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the tokens' letters, joined by spaces."""
        return b" ".join(self.pieces[np.frombuffer(ids, "<u4")].tolist())


def count_words(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, n) of the words of up to LONGEST bytes, over whole texts. Each worker adds up its own rows first, so the shuffle carries
    distinct words."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        counts: Counter[bytes] = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            words: Counter[bytes] = Counter()
            for chunk, n in counts.items():
                for w in v.words(chunk):
                    if len(w) <= LONGEST:
                        words[w] += n
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for t in b.column("text").to_pylist():
                for part in pieces(t) if t else ():
                    for s in v.parts.split(part) if v.parts and "<|" in part else [part]:
                        if s not in v.special:
                            counts.update(v.clean(s).split())
                    size += len(part)
                    if len(counts) >= COUNTED_WORDS or size >= COUNTED_BYTES:
                        yield flush()
                        size = 0
        if counts:
            yield flush()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, size: int = LEXICON_WORDS) -> bytes:
    """The ``size`` most frequent words of the corpus (ties by word), compiled. The driver gets these words only."""
    top = count_words(docs, vocabulary).orderBy(F.desc("n"), "word").limit(size)
    return compile_lexicon([(bytes(w), vocabulary.merge(bytes(w))) for w in top.toArrow()["word"].to_pylist()])


def mapped(data: bytes) -> Lexicon:
    """The lexicon in this worker: the first worker of an executor writes the file, all of them map it. It lies in the executor's folder
    of the application, which Spark removes at its end, and is written anew by an executor that takes another's place. The folder is only
    reached by the name that Spark gives, in executors a relative one: its full path may lead over another mount, and no file is renamed
    from one mount to another."""
    path = os.path.join(SparkFiles.getRootDirectory(), f"lexicon-{hashlib.sha256(data).hexdigest()[:24]}.bin")
    if not os.path.exists(path):
        own = f"{path}.{uuid.uuid4().hex}"
        with open(own, "xb") as f:
            f.write(data)
        os.replace(own, path)
    return Lexicon(path)


#: The codec of this worker with its lexicon's digest: what it has learned serves the worker's next tasks, too.
_OWN: dict[str, Codec] = {}


def codec_maker(docs: DataFrame, tokenizer_path: str, size: int = LEXICON_WORDS):
    """A function that gives the codec for these documents in a worker. What is broadcast, the tokenizer and a lexicon of
    ``size`` words, does not grow with the data."""
    vocabulary = Vocabulary.load(tokenizer_path)
    context = docs.sparkSession.sparkContext
    lexicon = build_lexicon(docs, vocabulary, size)
    with open(tokenizer_path, "rb") as f:
        key = hashlib.sha256(f.read() + lexicon).hexdigest()
    shared, data = context.broadcast(vocabulary), context.broadcast(lexicon)

    def own() -> Codec:
        if key not in _OWN:
            _OWN.clear()
            _OWN[key] = Codec(shared.value, mapped(data.value))
        return _OWN[key]

    return own


def encode_documents(docs: DataFrame, tokenizer_path: str, size: int = LEXICON_WORDS, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of whole texts; the digests are of the ids and of their decoding."""
    bound_batches(docs.sparkSession)
    make = codec_maker(docs, tokenizer_path, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make()
        for b in batches:
            rows = []
            for ids in codec.encode_batch(b.column("text").to_pylist()):
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest(), ids))
            cols = [b.column("doc_id").cast(pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array([np.frombuffer(r[3], "<u4").astype(np.int32) for r in rows], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of ids, as the library decodes them with special tokens kept."""
    return " ".join(vocabulary.tokens[k] for k in ids)
