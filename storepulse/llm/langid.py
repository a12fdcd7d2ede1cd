"""Language identification by word-first backoff (operator 4).

Known words are scored by their log frequency in each language. A word the model has not
seen in the sample falls back to its character n-grams, from MAX_GRAM characters down to one, with '<' and
'>' for the word's ends: the longest order of which the model knows any gram decides, by the
mean of its known grams' log frequencies. A text's score is the sum over its words; the
prediction is the best language (ties: the first by name), its score the posterior
probability.

The model is fitted on a bounded sample of labelled rows: FIT_ROWS of each language, those
with the smallest hash of their id (ties: of their text). It knows every word and gram of these rows; everything
else covers all rows and whole texts.
"""

from __future__ import annotations

import math
import re
import sys
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from storepulse.llm.common import fresh, ranges, worker_tables

#: The documented bound of the sample: labelled rows of each language.
FIT_ROWS = 1000
MAX_GRAM = 4
#: Parts of a language that are ranked apart before the sample is taken from their best.
PARTS = 64
#: Weight of a word that is scored by its grams, and the smoothing of counts.
GRAM_WEIGHT = 0.5
SMOOTH = 0.5
_MEMO = 300_000
# Runs of letters (categories L*): word signs that are no digits, of which other numeric signs are taken out first.
_SIGNS = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal()]
_NUMERIC = re.compile("[" + re.escape("".join(c for c in _SIGNS if c < "\U00010000")) + "]")
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
_ASTRAL_NUMERIC = str.maketrans({c: " " for c in _SIGNS if c >= "\U00010000"})
_WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    if not text.isascii():
        text = _NUMERIC.sub(" ", text)
        if _ASTRAL.search(text):
            text = text.translate(_ASTRAL_NUMERIC)
    return _WORD.findall(text)


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    words: dict[str, int]  # row of word_values
    word_values: np.ndarray
    grams: dict[str, int]  # row of values
    values: np.ndarray

    def of_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return self.word_values[known]
        marked = f"<{word}>"
        for n in range(MAX_GRAM, 0, -1):
            found = [g for g in [self.grams.get(marked[i:i + n]) for i in range(len(marked) - n + 1)] if g is not None]
            if found:
                return self.values.take(found, 0).sum(0) * (GRAM_WEIGHT / len(found))
        return np.zeros(len(self.langs))


class Scores:
    """A worker's scores of words, kept over its tasks: those of the model's words, and of up to _MEMO others."""

    def __init__(self, model: Model):
        self.model = model
        self._renew(_MEMO)

    def _renew(self, room: int) -> None:
        m = self.model
        self.at = dict(m.words)
        self.values = np.empty((len(m.words) + room, len(m.langs)))
        self.values[:len(m.words)] = m.word_values

    def of(self, words: Iterable[str]) -> np.ndarray:
        """A row for each of ``words``, which are distinct."""
        new = [w for w in words if w not in self.at]
        if len(self.at) + len(new) > len(self.values):
            new = [w for w in words if w not in self.model.words]
            self._renew(max(_MEMO, len(new)))
        for w in new:
            self.values[len(self.at)] = self.model.of_word(w)
            self.at[w] = len(self.at)
        return self.values.take([self.at[w] for w in words], 0)


def fit(rows: Iterator[tuple[str | None, str]]) -> Model:
    """A model of (text, language) rows; empty rows give a model without languages."""
    words: dict[str, Counter] = defaultdict(Counter)
    docs: Counter = Counter()
    for text, lang in rows:
        docs[lang] += 1
        words[lang].update(words_of(text))
    langs = sorted(docs)
    total = Counter()
    for lang in langs:
        total.update(words[lang])
    ranked = sorted(total)
    orders: list[dict[str, Counter]] = [defaultdict(Counter) for _ in range(MAX_GRAM + 1)]
    for lang in langs:
        for w, n in words[lang].items():
            marked, weight = f"<{w}>", 1 + math.log(n)
            for k in range(1, MAX_GRAM + 1):
                for i in range(len(marked) - k + 1):
                    orders[k][lang][marked[i:i + k]] += weight
    grams: dict[str, int] = {}
    values = []
    for k in range(1, MAX_GRAM + 1):
        of = Counter()
        for lang in langs:
            of.update(orders[k][lang])
        found = sorted(of)
        grams.update(zip(found, range(len(grams), len(grams) + len(found))))
        values.append(_log_shares(langs, orders[k], found))
    prior = np.log(np.array([docs[x] for x in langs], float) / max(1, sum(docs.values()))) if langs else np.zeros(0)
    return Model(langs, prior, dict(zip(ranked, range(len(ranked)))), _log_shares(langs, words, ranked), grams, np.concatenate(values))


def _log_shares(langs: list[str], counts: dict[str, Counter], keys: list[str]) -> np.ndarray:
    """A row of values for each of ``keys``."""
    if not keys:
        return np.zeros((0, len(langs)))
    n = np.array([[counts[lang][k] for k in keys] for lang in langs], float) + SMOOTH
    shares = np.log(n / n.sum(1, keepdims=True))
    shares -= shares.mean(0)  # what all languages share says nothing
    return np.ascontiguousarray(shares.T)


def sample(docs: DataFrame, use: Column, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """FIT_ROWS rows (text, lang) of each language among those where ``use`` holds, by the smallest hash of their id.

    Parts of a language are ranked first, then the best of all its parts, so no task ranks a whole language. Rows
    that repeat id and text are one row.
    """
    rows = docs.where(use & docs[lang_col].isNotNull()).select(
        docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("h"), docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text"))
    best = [F.xxhash64("id"), "id", "h"]
    keys = rows.select("lang", "id", "h").distinct().withColumn("part", F.pmod(F.xxhash64("h", "id"), F.lit(PARTS)))
    for group in (["lang", "part"], ["lang"]):  # the limit applies before each shuffle
        keys = keys.withColumn("k", F.row_number().over(Window.partitionBy(*group).orderBy(*best))).where(F.col("k") <= FIT_ROWS).drop("k")
    keys = F.broadcast(keys.drop("part"))  # FIT_ROWS of each language; no text is shuffled to find them
    return rows.join(keys, ["lang", "id", "h"], "left_semi").dropDuplicates(["lang", "id", "h"]).select("text", "lang")


def held_out(id_col: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 4, is 2 (a null id is held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             keep: list[str] | None = None) -> DataFrame:
    """(``keep`` columns or ``id_col``, held_out, lang_pred, score): the language of every whole text.

    Learned only from text and language of rows that are not held out. Null texts and texts
    without a letter are ``und`` with score 0, as are all texts if no row has a language. A text
    whose letters tell nothing gets the most frequent language. Repeated or null ids pass through.
    """
    spark = docs.sparkSession
    rows = sample(docs, ~held_out(docs[id_col]), id_col, text_col, lang_col).toLocalIterator()  # bounded by FIT_ROWS
    model = spark.sparkContext.broadcast(fit((r[0], r[1]) for r in rows))  # the words and grams of these rows
    mark = uuid.uuid4().hex
    keep = [id_col] if keep is None else keep
    made = ("lang_pred", "score", "held_out")
    body = fresh("text_to_read", [*docs.columns, *made])
    if set(made).intersection(keep):
        raise ValueError(f"rename columns named as the results first: {sorted(set(made).intersection(keep))}")
    fields = [f for f in docs.schema.fields if f.name in keep]
    if text_col in keep:
        body, texts = text_col, []  # a text goes to Python once
    else:
        texts = [docs[text_col].alias(body)]
    kept = docs.select([F.col(f.name) for f in fields] + texts + [held_out(docs[id_col]).alias("held_out")])
    out_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["held_out boolean", "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        own = worker_tables(f"langid {mark}")
        if not own:
            own["scores"] = Scores(m)
        for batch in batches:
            texts = batch.column(body)
            for a, b in ranges(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                langs, scores = [], []
                for text in texts.slice(a, b - a).to_pylist():
                    words = words_of(text)
                    if not words or not m.langs:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    counts = Counter(words)
                    s = m.prior + np.array(list(counts.values()), float) @ own["scores"].of(counts)
                    p = np.exp(s - s.max())
                    best = int(s.argmax())
                    langs.append(m.langs[best])
                    scores.append(float(p[best] / p.sum()))
                part = batch.slice(a, b - a)
                cols = [part.column(f.name) for f in fields] + [part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields] + ["held_out", "lang_pred", "score"])

    return kept.mapInArrow(run, out_schema)
