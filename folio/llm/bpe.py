"""BPE encoding and decoding by a contiguous rank array."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import SLICE_BYTES, fresh, slices, table, tidied

#: Longer words are merged with a heap instead of repeated scans.
SHORT = 160
NONE = np.int32(2**31 - 1)
#: Longest word, in bytes, that is merged together with others.
TOGETHER = 48
#: Entries of each of the two generations of a task's caches of words and of runs.
CACHE = 150_000
TOKENIZER_DIR = "/opt/tokenizers"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join(TOKENIZER_DIR, name)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if printable Latin-1, else the next free code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


#: The vocabulary file's own split pattern and the white space that its engine knows (fixed values).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t-\r \x85\p{Z}\p{L}\p{N}]+"


class WordBPE:
    """Encodes like the vocabulary file's own settings: NFC, lower case, split, byte letters, merges with a word end."""

    def __init__(self, path: str, cache: int = CACHE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.letter = byte_letters()
        self.words = regex.compile(SPLIT).findall
        self.odd = regex.compile("[\x1c-\x1f]").search  # white space to str.split alone
        self.runs = regex.compile(r"[^\t-\r \x85\p{Z}]+").findall
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else lambda t: [t]
        self.cache: dict[str, tuple[str, str, int]] = {}
        self.older: dict[str, tuple[str, str, int]] = {}
        self.run_cache: dict[str, tuple[str, str, int]] = {}
        self.run_older: dict[str, tuple[str, str, int]] = {}
        self.most = cache
        self.digits = {i: str(i) for i in self.token}
        pairs = np.array([a * len(self.token) + b for a, b in self.merges], np.int64)
        order = np.argsort(pairs)
        self.pair = pairs[order]
        self.pair_rank = np.array([r for r, _ in self.merges.values()], np.int32)[order]
        self.made = np.zeros(len(model["merges"]) + 1, np.int32)
        for r, i in self.merges.values():
            self.made[r] = i
        self.inner = np.array([self.vocab[c] for c in self.letter], np.int32)
        self.last = np.array([self.vocab[c + self.end] for c in self.letter], np.int32)

    def forget(self) -> None:
        """Empties the caches: a worker that goes on to another task keeps the vocabulary alone."""
        for c in (self.cache, self.older, self.run_cache, self.run_older):
            c.clear()

    def merge(self, word: str) -> list[int]:
        """Ids of one word. Parts lie in one array, the rank of each part with its right neighbour in another;
        the leftmost least rank is merged, its boundary deleted and the two neighbouring ranks refreshed."""
        letters = [self.letter[b] for b in word.encode("utf-8")]
        letters[-1] += self.end
        parts = [self.vocab[c] for c in letters]
        if len(parts) > SHORT:
            return self.merge_long(parts)
        get, none = self.merges.get, (1 << 60, -1)
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least is none:
                break
            i = ranks.index(least)
            parts[i] = least[1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in n log n: a heap of (rank, place) over linked parts."""
        get, n = self.merges.get, len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        alive = [True] * n
        heap = [(m[0], i, p, m[1]) for i, p in enumerate(zip(parts, parts[1:])) if (m := get(p))]
        heapq.heapify(heap)
        while heap:
            _, i, pair, new = heapq.heappop(heap)
            j = right[i] if alive[i] else -1
            if j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i], alive[j], right[i] = new, False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a in (left[i], i):
                if a >= 0 and (b := right[a]) >= 0 and (m := get((parts[a], parts[b]))):
                    heapq.heappush(heap, (m[0], a, (parts[a], parts[b]), m[1]))
        return [p for p, a in zip(parts, alive) if a]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * len(self.token) + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (a >= 0) & (b >= 0), self.pair_rank[at], NONE)

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """merge() of words of like length side by side: one row of parts and one of ranks for each word."""
        n, size = len(words), np.array([len(w) for w in words])
        width = int(size.max())
        col = np.arange(width)
        parts = np.full((n, width), -1, np.int32)
        inside = col < size[:, None]
        parts[inside] = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        rows = np.arange(n)
        parts[rows, size - 1] = self.last[np.array([w[-1] for w in words])]
        ranks = np.full((n, width), NONE, np.int32)  # the last column stays NONE
        ranks[:, :-1] = self._ranks(parts[:, :-1], parts[:, 1:])
        out: list[list[int]] = [[]] * n
        while n:
            i = ranks.argmin(1)
            least = ranks[np.arange(n), i]
            if (done := least == NONE).any():
                for r, p in zip(rows[done].tolist(), parts[done].tolist()):
                    out[r] = [x for x in p if x >= 0]
                go = ~done
                rows, parts, ranks, i, least = rows[go], parts[go], ranks[go], i[go], least[go]
                n = len(rows)
                if not n:
                    break
            every = np.arange(n)
            parts[every, i] = self.made[least]
            # delete the boundary: what lies behind it moves up by one
            step = (col > i[:, None]) & (col < width - 1)
            tail = parts[:, -1].copy()
            parts = np.take_along_axis(parts, col + step, 1)
            parts[:, -1] = np.where(i == width - 1, tail, -1)
            ranks = np.take_along_axis(ranks, col + ((col >= i[:, None]) & (col < width - 1)), 1)
            ranks[:, -1] = NONE
            right = np.where(i + 1 < width, parts[every, np.minimum(i + 1, width - 1)], -1)
            ranks[every, i] = self._ranks(parts[every, i], right)
            k = np.flatnonzero(i)
            ranks[k, i[k] - 1] = self._ranks(parts[k, i[k] - 1], parts[k, i[k]])
        return out

    def _entry(self, ids: list[int]) -> tuple[str, str, int]:
        return " ".join([self.digits[i] for i in ids]), " ".join([self.token[i] for i in ids]), len(ids)

    def learn(self, words: Iterable[str]) -> dict[str, tuple[str, str, int]]:
        """An entry (decimal ids, tokens, their number) for each distinct word, from the cache or merged now."""
        out, missing = {}, []
        now, older = self.cache, self.older
        for w in words:
            if (e := now.get(w)) is None:
                if (e := older.get(w)) is None:
                    missing.append(w)
                    continue
                now[w] = e
            out[w] = e
        pairs = sorted(((w.encode("utf-8"), w) for w in missing), key=lambda x: len(x[0]))
        for at in range(0, len(pairs), 4096):
            some = pairs[at : at + 4096]
            short = [b for b, _ in some if len(b) <= TOGETHER]
            merged = self.merge_many(short) if short else []
            merged += [self.merge(w) for b, w in some if len(b) > TOGETHER]
            for (b, w), ids in zip(some, merged):
                out[w] = e = self._entry(ids)
                if len(b) <= TOGETHER:
                    now[w] = e
        if len(now) >= self.most:
            self.older, self.cache = now, {}
        return out

    def _split(self, text: str) -> list[list[str] | str]:
        """Runs between white space, and special tokens (every second part)."""
        out: list[list[str] | str] = []
        for k, part in enumerate(self.cut(text) if "<|" in text else [text]):
            if k % 2:
                out.append(part)
                continue
            if not part.isascii():
                # lower-cased letter by letter: no final-sigma rule
                part = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3")
            out.append(self.runs(part) if self.odd(part) else part.split())
        return out

    def _known(self, runs: set[str]) -> dict[str, tuple[str, str, int]]:
        """An entry for each run between white space; words never reach over white space."""
        out, missing = {}, {}
        now, older = self.run_cache, self.run_older
        for r in runs:
            if (e := now.get(r)) is None:
                if (e := older.get(r)) is None:
                    missing[r] = self.words(r.lower())
                    continue
                now[r] = e
            out[r] = e
        words = self.learn({w for p in missing.values() for w in p})
        for r, pieces in missing.items():
            if len(pieces) == 1:
                e = words[pieces[0]]
            else:
                got = [words[p] for p in pieces]
                e = (" ".join([g[0] for g in got]), " ".join([g[1] for g in got]), sum([g[2] for g in got]))
            out[r] = e
            if len(r) <= TOGETHER:
                now[r] = e
        if len(now) >= self.most:
            self.run_older, self.run_cache = now, {}
        return out

    def many(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Per text (tokens, decimal ids joined by one space, decoded text). The file has no decoder: tokens are joined by a space."""
        texts = [self._split(t or "") for t in texts]
        known = self._known({r for parts in texts for p in parts[::2] for r in p})
        out = []
        for parts in texts:
            got = [known[r] for r in parts[0]] if len(parts) == 1 else [e for k, p in enumerate(parts) for e in ([(str(self.special[p]), p, 1)] if k % 2 else [known[r] for r in p])]
            ids, tokens, n = zip(*got) if got else ((), (), ())
            out.append((sum(n), " ".join(ids), " ".join(tokens)))
        return out

    def both(self, text: str | None) -> tuple[int, str, str]:
        return self.many([text])[0]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for i in self.both(text)[1].split()]

    def decode(self, ids: Iterable[int]) -> str:
        """Unknown ids are left out."""
        return " ".join(self.token[i] for i in ids if i in self.token)


_loaded: dict[str, WordBPE] = {}


def tokenizer(path: str) -> WordBPE:
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def encode(docs: DataFrame, text: str = "text", path: str | None = None, ids: bool = False, texts: bool | None = None, cache: int = CACHE, step: int = SLICE_BYTES) -> DataFrame:
    """docs plus n_tokens, ids_sha256, decoded_sha256 (token_ids with ids=True, decoded with texts=True; texts is as ids unless
    given); a map, without a shuffle. A task's memory grows with `cache`, entries of its caches, and `step`, bytes of text that
    are encoded at once (or one text); results don't depend on them.

    Null text counts as empty: 0 tokens, the hash of the empty string. Rows, repeats and other columns are kept as they
    are; if docs already has a column of one of those names, the new one gets underscores at its end. Whole texts are
    encoded; the vocabulary file's path is a parameter and has to exist on every executor."""
    path = path or vocabulary_path()
    texts = ids if texts is None else texts
    columns = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"} | ({"token_ids": "array<int>"} if ids else {}) | ({"decoded": "string"} if texts else {})
    names = fresh(docs, *columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"`{n}` {k}" for n, k in zip(names, columns.values()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        tok.most = cache
        try:
            for whole in batches:
                for b in slices(whole, text, step):
                    n, i, d, t, x = [], [], [], [], []
                    for count, id_text, decoded in tok.many(b.column(text).to_pylist()):
                        n.append(count)
                        i.append(hashlib.sha256(id_text.encode()).hexdigest())
                        d.append(hashlib.sha256(decoded.encode()).hexdigest())
                        if ids:
                            t.append(np.array(id_text.split(), np.int32))
                        if texts:
                            x.append(decoded)
                    new = [pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())]
                    if ids:
                        new.append(pa.array(t, pa.list_(pa.int32())))
                    if texts:
                        new.append(pa.array(x, pa.string()))
                    yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *names])
        finally:
            tok.forget()

    return docs.mapInArrow(tidied(run), schema)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
