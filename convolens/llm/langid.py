"""Language identification by multilingual mixture inference.

A text is a mixture of languages: each word is drawn from one of them, with a likelihood from character n-grams.
Expectation-maximisation estimates the languages' shares in each text; the set of languages is the one of best
likelihood after a penalty for each language, and the largest share in it is the prediction.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: n-grams in the model, the most frequent over all languages: bounds what is broadcast.
MODEL_GRAMS = 20_000
SMOOTHING = 0.5
#: Words whose likelihoods a worker remembers, and characters of them, before it starts anew.
WORDS_KEPT = 300_000
CHARS_HELD = 16_000_000
#: Characters of text that are inferred together.
PORTION = 1_000_000
ROUNDS = 25
#: n-grams of one word overlap; their joint likelihood is tempered by this power.
TEMPER = 0.6
UNDETERMINED = "und"


def letters(word: str) -> str:
    bare = word.strip(".,;:!?\"()")
    return bare if bare.isalpha() else "".join([c for c in bare if c.isalpha()])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


@dataclass
class Model:
    languages: list[str]
    #: Sorted codes of the n-grams (see ``gram_codes``), and the log likelihood of each by language; the last row is that
    #: of an n-gram that the model lacks.
    codes: np.ndarray
    table: np.ndarray


def gram_codes(words: list[str]):
    """Codes of the 2-grams and 3-grams of words with their borders marked, and how many of each a word has.

    A code packs code points of 21 bits; borders are marked by characters that aren't letters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le"), "<u4").astype(np.int64)
    last = np.cumsum(lengths + 2) - 1
    inside = np.ones(len(points), bool)
    inside[last] = False
    at = np.flatnonzero(inside)
    two = points[at] << 21 | points[at + 1]
    inside[last - 1] = False
    at = np.flatnonzero(inside)
    three = points[at] << 42 | points[at + 1] << 21 | points[at + 2]
    return two, three, lengths + 1, lengths


def gram_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, code, n) over every row with a text and a language."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words: dict[str, Counter] = defaultdict(Counter)
        held = 0

        def flush():
            out = [(np.empty(0, np.int64), np.empty(0, np.int64), "")]
            for lang, counts in words.items():
                clean = [(c, n) for w, n in counts.items() if (c := letters(w))]
                if not clean:
                    continue
                two, three, n_two, n_three = gram_codes([c for c, _ in clean])
                weight = np.array([n for _, n in clean], np.int64)
                codes, place = np.unique(np.concatenate([two, three]), return_inverse=True)
                counted = np.bincount(place, np.concatenate([np.repeat(weight, n_two), np.repeat(weight, n_three)]))
                out.append((codes, counted.astype(np.int64), lang))
            words.clear()
            langs = pa.concat_arrays([pa.array([x] * len(c), pa.string()) for c, _, x in out])
            return pa.RecordBatch.from_arrays([langs, pa.array(np.concatenate([c for c, _, _ in out])), pa.array(np.concatenate([n for _, n, _ in out]))], names=["lang", "code", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lowered = text.as_py().lower()
                words[lang.as_py()].update(lowered.split())
                held += len(lowered)
                if held > CHARS_HELD:
                    held = 0
                    yield flush()
        yield flush()

    rows = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text")).where("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", model_grams: int = MODEL_GRAMS) -> Model:
    """Counts cover every row of ``docs``; the model keeps the ``model_grams`` most frequent n-grams."""
    from .shared import settle

    counts = settle(gram_counts(docs, text_col=text_col, lang_col=lang_col), "gram_counts")
    totals = {r["lang"]: (r["total"], r["kinds"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).collect()}
    top = counts.groupBy("code").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "code").limit(model_grams)
    languages = sorted(totals)
    place = {lang: k for k, lang in enumerate(languages)}
    kinds = max((k for _, k in totals.values()), default=0)
    bottom = [math.log(totals[x][0] + SMOOTHING * kinds) if totals[x][0] else 0.0 for x in languages]
    unknown = [math.log(SMOOTHING) - b for b in bottom]
    table: dict[int, list[float]] = {}
    for r in counts.join(top.select("code"), "code").collect():
        row = table.setdefault(r["code"], list(unknown))
        row[place[r["lang"]]] = math.log(r["n"] + SMOOTHING) - bottom[place[r["lang"]]]
    codes = sorted(table)
    return Model(languages, np.array(codes, np.int64), np.array([*(table[c] for c in codes), unknown], float).reshape(len(codes) + 1, len(languages)))


class Mixture:
    """Mixture inference with one model, over many texts at once; remembers likelihoods of words."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.log = np.zeros((1024, len(model.languages)))
        self.held = 0

    def _learn(self, words: list[str]) -> None:
        """Give each word a row of log likelihoods, or -1 when it has no letter."""
        clean = [letters(w) for w in words]
        some = [c for c in clean if c]
        first = self.used
        if some:
            two, three, n_two, n_three = gram_codes(some)
            need = first + len(some)
            if need > len(self.log):
                self.log = np.concatenate([self.log[:first], np.zeros((max(need, 2 * len(self.log)) - first, self.log.shape[1]))])
            self.log[first:need] = TEMPER * (self._sums(two, n_two) + self._sums(three, n_three))
        k = first
        for w, c in zip(words, clean, strict=True):
            self.rows[w] = k if c else -1
            k += bool(c)
        self.used = k
        self.held += sum(map(len, words))

    used = 0

    def _sums(self, codes, n):
        known = self.model.codes
        at = np.searchsorted(known, codes)
        at[at == len(known)] = 0
        if len(known):
            at[known[at] != codes] = len(known)
        return np.add.reduceat(self.model.table[at], np.cumsum(n) - n)

    def shares(self, texts: list[str]) -> list[dict[str, float]]:
        """For each text the share of each language of the chosen set; empty without letters or languages."""
        if not self.model.languages:
            return [{} for _ in texts]
        if len(self.rows) > WORDS_KEPT or self.held > CHARS_HELD:
            self.rows.clear()
            self.used = self.held = 0
        counts = [Counter(t.lower().split()) for t in texts]
        rows = self.rows
        new = [w for w in dict.fromkeys(chain.from_iterable(counts)) if w not in rows]
        if new:
            self._learn(new)
        sizes = np.fromiter(map(len, counts), np.int64, len(counts))
        total = int(sizes.sum())
        at = np.fromiter(map(rows.__getitem__, chain.from_iterable(counts)), np.int64, total)
        weight = np.fromiter(chain.from_iterable(c.values() for c in counts), float, total)
        doc = np.repeat(np.arange(len(texts)), sizes)
        lettered = at >= 0
        at, weight, doc = at[lettered], weight[lettered], doc[lettered]
        out: list[dict[str, float]] = [{} for _ in texts]
        if len(at):
            present, doc = np.unique(doc, return_inverse=True)
            names = self.model.languages
            for d, (chosen, part) in zip(present.tolist(), self.infer(self.log[at], weight, doc), strict=True):
                out[d] = {names[k]: s for k, s in zip(chosen, part, strict=True)}
        return out

    def infer(self, log, w, doc) -> list[tuple[list[int], list[float]]]:
        """The chosen set and its shares for each document; rows of ``log`` are words, sorted by document (0, 1, ...).

        Sets are those of the languages with the greatest shares in the full mixture, of every size."""
        n, languages = int(doc[-1]) + 1, log.shape[1]
        starts = np.searchsorted(doc, np.arange(n))
        top = log.max(axis=1)
        like = np.exp(log - top[:, None])
        total = np.add.reduceat(w, starts)
        base = np.add.reduceat(w * top, starts)
        alone = np.add.reduceat(log * w[:, None], starts)
        single = np.argmax(alone, axis=1)
        best = alone[np.arange(n), single]
        chosen: list[list[int]] = [[k] for k in single.tolist()]
        parts: list[list[float]] = [[1.0]] * n
        if languages > 1:
            full, full_value = self._fit(like, w, doc, starts, total, np.full((n, languages), 1 / languages))
            order = np.argsort(-full, axis=1, kind="stable")
            full = np.take_along_axis(full, order, axis=1)
            for k in range(2, languages + 1):
                some, shares, value = order[:, :k], full, full_value
                if k < languages:
                    # Started from the full mixture, whose shares are near; none starts at zero, where it would stay.
                    begin = np.maximum(full[:, :k], 1e-3)
                    shares, value = self._fit(np.take_along_axis(like, some[doc], axis=1), w, doc, starts, total, begin / begin.sum(axis=1, keepdims=True))
                value = value + base - (k - 1) * np.log(total + 1)
                for d in np.flatnonzero(value > best).tolist():
                    chosen[d], parts[d], best[d] = some[d].tolist(), shares[d].tolist(), value[d]
        return list(zip(chosen, parts, strict=True))

    @staticmethod
    def _fit(like, w, doc, starts, total, shares):
        """Shares, from those given, and log likelihood of each document's mixture; a document rests when its shares move no more."""
        active = np.arange(len(starts))
        x, xw, xdoc, xstarts = like, w, doc, starts
        for _ in range(ROUNDS):
            now = shares[active]
            mixed = np.maximum(np.einsum("ij,ij->i", x, now[xdoc]), 1e-300)
            new = now * np.add.reduceat(x * (xw / mixed)[:, None], xstarts) / total[active][:, None]
            moving = np.abs(new - now).max(axis=1) >= 1e-4
            shares[active] = new
            if not moving.any():
                break
            if not moving.all():
                keep = moving[xdoc]
                x, xw = x[keep], xw[keep]
                xdoc = (np.cumsum(moving) - 1)[xdoc[keep]]
                active = active[moving]
                xstarts = np.searchsorted(xdoc, np.arange(len(active)))
        value = np.add.reduceat(w * np.log(np.maximum(np.einsum("ij,ij->i", like, shares[doc]), 1e-300)), starts)
        return shares / shares.sum(axis=1, keepdims=True), value


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about ``PORTION`` characters together, one at least."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > PORTION:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) for every row of ``docs``.

    A null text and one without letters is ``und`` with score 0, as is everything under a model without languages.
    ``languages`` maps the chosen set to shares; score is the predicted one's.  Equal shares go to the first name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        mix = Mixture(shared.value)
        for batch in batches:
            preds, scores, maps = [], [], []
            for shares in chain.from_iterable(map(mix.shares, _portions([t.as_py() or "" for t in batch.column(2)]))):
                pred = min(shares, key=lambda x: (-shares[x], x), default=UNDETERMINED)
                preds.append(pred)
                scores.append(min(1.0, max(0.0, shares.get(pred, 0.0))))
                maps.append(list(shares.items()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(maps, pa.map_(pa.string(), pa.float64()))],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), held_out(docs[id_col]).alias("held_out"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, languages map<string,double>")


def training_rows(docs: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Rows with an id that isn't held out; a null id never trains."""
    return docs.where(F.crc32(docs[id_col].cast("string")) % 5 != 0)
