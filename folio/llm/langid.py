"""Language identification by word-first backoff."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, fresh, sampled, slices, table, tidied, written

#: The model is fitted on about so many labelled documents; all words and n-grams of these are kept.
SAMPLE = 6_000
#: Longest character n-gram, and the log10 penalty of each step from words down to shorter n-grams.
LONGEST, STEP = 5, 0.4
#: Entries of a task's tables: of counts before they are passed on, of words already scored; n-grams looked up at once.
COUNTER, CACHE, BLOCK = 300_000, 100_000, 1 << 16
UNKNOWN = "und"
_letters = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
_ascii = regex.compile("[a-z]+").findall


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, with their combining marks."""
    if not text:
        return []
    return _ascii(text.lower()) if text.isascii() else _letters(text.lower())


def grams_of(word: str, n: int, start: int = 0, stop: int | None = None) -> list[str]:
    """The n-grams of a word between ^ and $ (from the start-th up to the stop-th)."""
    w = f"^{word}$"
    last = len(w) - n + 1
    return [w[i : i + n] for i in range(start, last if stop is None else min(stop, last))]


def _keys(items: Iterable[str], kind: str) -> np.ndarray:
    """64 bits of each item; words and n-grams are told apart."""
    seed = 1 if kind == "w" else 2
    h = xxhash.xxh64_intdigest
    return np.fromiter([h(x, seed) for x in items], np.uint64)


class Model:
    """Log10 frequencies in two flat tables, of words and of n-grams: ascending 64-bit keys and a float32 row for each, a
    column for each language. 8 + 4 * languages bytes an entry; the sample bounds their number."""

    def __init__(self, langs: list[str], tables: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs, self.tables = langs, tables

    def _rows(self, kind: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are known, and the rows of those."""
        known, rows = self.tables[kind]
        if not len(known):
            return np.zeros(len(keys), bool), rows
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
        return hit, rows[at[hit]]

    def word(self, w: str) -> tuple[np.ndarray, int]:
        """Scores of a word that isn't known: the mean over its longest character n-grams of which any is known, with a
        penalty for each step, and the n-grams' length; else nothing and 0. The whole word is looked at, in blocks."""
        for n in range(min(LONGEST, len(w) + 2), 0, -1):
            total, hits = np.zeros(len(self.langs)), 0
            for at in range(0, len(w) + 3 - n, BLOCK):
                hit, rows = self._rows("g", _keys(grams_of(w, n, at, at + BLOCK), "g"))
                total += rows.sum(0, dtype=np.float64)
                hits += int(hit.sum())
            if hits:
                return total / hits - STEP * (LONGEST + 1 - n), n
        return np.zeros(len(self.langs)), 0

    def scorer(self) -> "Scorer":
        return Scorer(self)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        return self.scorer().predict(texts)


class Scorer:
    """A task's predictions, with the words that it has scored already."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.langs) + 1))

    def _learn(self, words: set[str]) -> None:
        missing = [w for w in words if w not in self.index]
        if len(self.index) + len(missing) > CACHE and self.index:
            self._clear()
            missing = list(words)
        if not missing:
            return
        new = np.zeros((len(missing), len(self.model.langs) + 1))
        hit, rows = self.model._rows("w", _keys(missing, "w"))
        new[hit, :-1], new[hit, -1] = rows, 1
        for i in np.flatnonzero(~hit).tolist():
            new[i, :-1], n = self.model.word(missing[i])
            new[i, -1] = n >= 2
        at = len(self.index)
        self.index.update(zip(missing, range(at, at + len(missing))))
        self.rows = np.concatenate([self.rows, new])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, share, evidence): the language with the largest sum of scores and its softmax share, from 0 to 1; the
        first by name among equals; `und` and 0 without letters or without a language learned. Evidence is the share of the
        text's words that are known or have known n-grams of two characters or more."""
        langs, out = self.model.langs, []
        docs = [words_of(t) for t in texts]
        self._learn({w for d in docs for w in d})
        for d in docs:
            if not d or not langs:
                out.append((UNKNOWN, 0.0, 0.0))
                continue
            s = self.rows[np.fromiter(map(self.index.__getitem__, d), np.int64, len(d))].sum(0)
            evidence, s = s[-1] / len(d), s[:-1] * math.log(10)
            best = int(s.argmax())
            out.append((langs[best], float(1 / np.exp(np.minimum(s - s[best], 0)).sum()), float(evidence)))
        return out


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from (doc_id, text, lang): about `sample` whole documents, chosen by a hash of doc_id and text alike at every size.

    Rows with null lang, null text or an empty lang name are not learned from; rows without doc_id are as others, and
    repeated rows are in or out together. Counting is distributed; the driver gets the counts of the sample's words and
    n-grams, all of them. A language's estimate is its count plus a half over its total."""
    rows = sampled(labelled.where("lang is not null and lang <> '' and text is not null").select("doc_id", "text", "lang"), sample, "doc_id", "text").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per: dict[tuple[str, str], Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, kind), c in per.items():
                items = list(c)
                sizes = [0] * len(items) if kind == "w" else [len(x) for x in items]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(items), pa.string()), pa.array([kind] * len(items), pa.string()), pa.array(sizes, pa.int32()), pa.array(_keys(items, kind).view(np.int64)), pa.array(list(c.values()), pa.int64())], names=["lang", "kind", "size", "key", "n"])
            per.clear()

        for whole in batches:
            for b in slices(whole):
                for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                    c = Counter(words_of(text))
                    per.setdefault((lang, "w"), Counter()).update(c)
                    g = per.setdefault((lang, "g"), Counter())
                    for w, n in c.items():
                        for k in range(1, min(LONGEST, len(w) + 2) + 1):
                            for at in range(0, len(w) + 3 - k, BLOCK):
                                for x in grams_of(w, k, at, at + BLOCK):
                                    g[x] += n
                        if max(len(g), len(per.get((lang, "w"), ()))) > COUNTER:
                            yield from flush()
                            g = per.setdefault((lang, "g"), Counter())
        yield from flush()

    counts = written(rows.mapInArrow(tidied(count), "lang string, kind string, size int, key bigint, n bigint").groupBy("lang", "kind", "size", "key").agg(F.sum("n").alias("n")))
    got = counts.select("lang", "kind", "size", "key", "n").toArrow()
    langs = sorted(set(got["lang"].to_pylist()))
    lang = np.searchsorted(np.array(langs), np.array(got["lang"].to_pylist())) if langs else np.zeros(0, np.int64)
    kind, size, key, n = np.array(got["kind"].to_pylist()), got["size"].to_numpy(), got["key"].to_numpy().view(np.uint64), got["n"].to_numpy()
    tables = {}
    for k in ("w", "g"):
        of = kind == k if langs else np.zeros(0, bool)
        keys, one, where = np.unique(key[of], return_index=True, return_inverse=True)
        sizes = size[of][one]
        # totals of each language's items of one length (words: all alike)
        totals = np.zeros((LONGEST + 1, len(langs)))
        np.add.at(totals, (size[of], lang[of]), n[of])
        rows_ = np.full((len(keys), len(langs)), 0.5, np.float32)
        rows_[where, lang[of]] += n[of]
        rows_ = np.log10(rows_) - np.log10(totals[sizes] + 0.5 * max(len(keys), 1))
        tables[k] = (keys, rows_.astype(np.float32))
    return Model(langs, tables)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs' columns plus lang_pred, score and evidence (see Scorer.predict); a map over whole texts. Null text, or one without
    letters, is `und` with score 0. Repeated rows get the same result. New names that docs already has get underscores at
    their end."""
    names = fresh(docs, "lang_pred", "score", "evidence")
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{names[0]}` string, `{names[1]}` double, `{names[2]}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held.value.scorer()
        for whole in batches:
            for b in slices(whole):
                got = scorer.predict(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64())], names=[*b.schema.names, *names])

    return docs.mapInArrow(tidied(run), schema)


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    train = docs.select("doc_id", "text", "lang").where(crc_mod("doc_id", 4) != 2)
    got = identify(docs.select("doc_id", "text"), fit(train))
    return got.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "evidence")
