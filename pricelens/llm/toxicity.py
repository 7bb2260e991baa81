"""Toxicity: significant passages by maximum-scoring segments of token log-odds.

Learning. A bounded sample of labelled documents (``DOCS`` of each label at most, about, by
hash of doc_id) is read where it lies. Numbers of documents with a word, and with a word's
first ``STEM`` letters, are summed by label into tables of fixed size (``WORDS`` and ``STEMS``
buckets). A word's score is its log-odds between the labels under a Dirichlet prior: the
prior of a word shares ``PRIOR`` documents between the labels as its stem does, that of a stem
as all documents do. So an unseen form of a toxic stem scores, a word seen once hardly does.

Search. A text's scores, less the text's own median (within bounds) and ``DRIFT``, are negative
on the whole; a word that returned within ``NEAR`` tokens
counts nothing. All its maximal scoring segments are found in one pass that looks at each run
of positive scores once (Ruzzo and Tompa's linear-time algorithm).

Calibration. On a part of the sample that nothing was counted from, the best segments of clean
texts give the two parameters of the extreme-value law: a segment of score S in n tokens is
expected K n exp(-lambda S) times by chance. Segments with an expectation of ``SIGNIFICANT``
or less are passages. The r best passages together have a p-value by the law of the sum of
their normalised scores; a text's evidence is the least over r, as -log p, and its score a
logistic function of its logarithm, fitted on the same part with the labels' own weights.

Defined results: a null or empty text, or one without letters, has no passage and the score of
no evidence. A null doc_id counts as the empty text in the fold and has no label; several label
rows of a doc_id count as toxic if one is. Without a toxic or without a clean labelled document
nothing is learned, and every score is 0. Positions are of characters (code points).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Sampled documents of a label (about), buckets of words and of stems, letters of a stem.
DOCS, WORDS, STEMS, STEM = 16_000, 1 << 18, 1 << 16, 4
PRIOR, DRIFT, SIGNIFICANT, NEAR = 8.0, 1.0, 0.05, 50
#: Most that a text's median score takes off each of its tokens, remembered forms, characters read at once.
MEDIAN, CACHE_FORMS, PIECE = 1.0, 150_000, 1 << 20
_LETTERS, _GAP, _TOKEN = re.compile(r"[^\W\d_]+"), re.compile(r"\s"), re.compile(r"\S+")


def fold(doc_id: Column) -> Column:
    """0: held out, nothing is learned from it; 4: for calibration; 1 to 3: for counting."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def word_bucket(word: str) -> int:
    return crc32(word.encode()) & (WORDS - 1)


def stem_bucket(word: str) -> int:
    return crc32(word[:STEM].encode(), 1) & (STEMS - 1)


def tokens(text: str) -> Iterator[list[str]]:
    """Runs of characters other than white space, some at a time."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE and (gap := _GAP.search(text, at + PIECE)):
            end = gap.start()
        yield text[at:end].split()
        at = end


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end, score), in order, in linear time."""
    plus = scores > 0
    edge = np.diff(plus.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    if not len(starts):
        return []
    upto = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    stack: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum at end, link
    for first, end, low, high in zip(starts.tolist(), ends.tolist(), upto[starts].tolist(), upto[ends].tolist(), strict=True):
        while True:
            # the nearest candidate to the left whose sum before is lower; links skip the others
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append((first, end, low, high, j))
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(first, end, high - low) for first, end, low, high, _ in stack]


class Model:
    """Counts of documents by label, and what calibration adds."""

    def __init__(self, words: np.ndarray, stems: np.ndarray, docs: tuple[int, int]):
        self.words, self.stems = words, stems  # a row a bucket: clean, toxic documents
        total = sum(docs)
        self.known, self.share = min(docs) > 0, docs[1] / total if total else 0.0
        self.rate, self.k = 1.0, 0.1
        self.a, self.b = -8.0, 1.0
        self.cache: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def word(self, word: str) -> float:
        """Log-odds of a word in lower case."""
        clean, toxic = self.stems[stem_bucket(word)].tolist()
        share = (toxic + PRIOR * self.share) / (toxic + clean + PRIOR)
        clean, toxic = self.words[word_bucket(word)].tolist()
        odds = (toxic + PRIOR * share) / (clean + PRIOR * (1 - share))
        return math.log(odds * (1 - self.share) / self.share)

    def form(self, form: str) -> float:
        """Score of a token: its words' log-odds added up, 0 without a letter."""
        return sum(self.word(w) for w in _LETTERS.findall(form.lower()))

    def scores(self, text: str) -> np.ndarray:
        cache, out, at, high = self.cache, [], 0, []
        for some in tokens(text):
            try:
                s = [cache[t] for t in some]
            except KeyError:
                if len(cache) > CACHE_FORMS:
                    cache.clear()
                new = {t: self.form(t) for t in set(some) if t not in cache}
                s = [new[t] if t in new else cache[t] for t in some]
                cache.update(new)
            s = np.array(s, np.float32)
            high += [(at + k, some[k].lower()) for k in np.flatnonzero(s > DRIFT).tolist()]
            out.append(s)
            at += len(s)
        if not at:
            return np.empty(0, np.float32)
        s = np.concatenate(out)
        s -= min(max(float(np.median(s)), 0.0), MEDIAN) + DRIFT
        last: dict[str, int] = {}
        for k, form in high:
            # documents were counted, not occurrences: a word that soon returns is no news
            if s[k] > 0 and k - last.get(form, -NEAR - 1) <= NEAR:
                s[k] = 0.0
            last[form] = k
        return s

    def expected(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-self.rate * score)

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        """-log of the least p-value of the r best segments together: the sum T of their
        normalised scores exceeds t with probability about exp(-t) t^(r-1) / (r! (r-1)!)."""
        best, total = 0.0, 0.0
        for r, s in enumerate(sorted((x[2] for x in found), reverse=True), 1):
            one = self.rate * s - math.log(self.k * n)
            if one < -math.log(SIGNIFICANT):
                break
            total += one
            log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
            best = max(best, -log_p)
        return best

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float, float]]]:
        """Score of a text, and its passages: tokens from, to, score and expected number."""
        if not self.known:
            return 0.0, []
        s = self.scores(text or "")
        found = segments(s)
        x = self.a + self.b * math.log1p(self.evidence(found, len(s)))
        passages = [(f, e, score, self.expected(score, len(s))) for f, e, score in found
                    if self.expected(score, len(s)) <= SIGNIFICANT]
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x)))), passages


def extreme_value(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Maximum likelihood (lambda, K) of best scores of ``n`` tokens each by chance:
    P(best < s) = exp(-K n exp(-lambda s)). Newton's method would do; bisection can't fail."""
    def slope(rate: float) -> float:
        w = n * np.exp(-rate * (best - best.min()))
        return 1 / rate - best.mean() + (w * best).sum() / w.sum()

    low, high = 1e-3, 1e3
    for _ in range(100):
        middle = math.sqrt(low * high)
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    rate = min(max(low, 0.05), 50.0)
    return rate, float(len(best) / (n * np.exp(-rate * best)).sum())


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not negative) of a weighted logistic fit with a small ridge."""
    scale = max(1.0, float(np.abs(x).max(initial=0)))
    z = np.stack((np.ones(len(x)), x / scale), 1)
    at, ridge = np.zeros(2), np.array([1e-3, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ at, -500, 500)))
        slope = z.T @ (weight * (y - p)) - ridge * at
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge), slope)
        at += step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), max(0.0, float(at[1] / scale))


def sample(docs: DataFrame, labels: DataFrame, size: int = DOCS) -> tuple[DataFrame, dict[int, int]]:
    """(fold, toxic, text) of the sampled documents, and the labelled documents by label."""
    marks = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0"))
    marks = stored(marks, "toxic_marks")
    rows = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chance = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 40))
    part = F.when(F.col("toxic") == 1, F.lit(min(1.0, size / max(1, rows.get(1, 0))))).otherwise(
        F.lit(min(1.0, size / max(1, rows.get(0, 0)))))
    few = marks.where(chance < part * float(1 << 40))  # about 2 * size rows of three numbers
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "text IS NOT NULL").join(F.broadcast(few), "doc_id").select("fold", "toxic", "text"), rows


def _counts(found: DataFrame) -> DataFrame:
    """(kind, bucket, toxic, n): documents by word bucket (kind 0) and stem bucket (1), and all (2)."""
    def run(batches):
        import pyarrow as pa

        words, stems, docs = np.zeros((WORDS, 2), np.int64), np.zeros((STEMS, 2), np.int64), np.zeros((1, 2), np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                forms: set[str] = set()
                for some in tokens(text.as_py()):
                    forms.update(some)
                found = {w for f in forms for w in _LETTERS.findall(f.lower())}
                words[list({word_bucket(w) for w in found}), toxic] += 1
                stems[list({stem_bucket(w) for w in found}), toxic] += 1
                docs[0, toxic] += 1
        for kind, table in enumerate((words, stems, docs)):
            bucket, toxic = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(bucket), kind, np.int32)), pa.array(bucket.astype(np.int32)),
                 pa.array(toxic.astype(np.int32)), pa.array(table[bucket, toxic])], names=["kind", "bucket", "toxic", "n"])

    rows = found.select("toxic", "text").mapInArrow(run, "kind int, bucket int, toxic int, n long")
    return rows.groupBy("kind", "bucket", "toxic").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, size: int = DOCS) -> Model:
    """Counts from folds 1 to 3 of the sample, calibration on fold 4 (on all if it lacks a label)."""
    found, rows = sample(docs, labels, size)
    found = stored(found, "toxic_sample")
    tables = [np.zeros((n, 2)) for n in (WORDS, STEMS, 1)]
    counted = _counts(found.where("fold <> 4")).toPandas()  # 2 * (WORDS + STEMS + 1) rows at most
    for kind, table in enumerate(tables):
        some = counted[counted["kind"] == kind]
        table[some["bucket"], some["toxic"]] = some["n"]
    # the label that was sampled more thinly counts for more
    taken = np.array([max(1, rows.get(k, 0)) / max(1.0, n) for k, n in enumerate(tables[2][0])])
    taken /= taken.min()
    model = Model(tables[0] * taken, tables[1] * taken, tuple((tables[2][0] * taken).tolist()))
    if not model.known:
        return model
    given = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        for batch in batches:
            out = []
            for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
                s = given.value.scores(text)
                if len(s):
                    best = sorted((x[2] for x in segments(s)), reverse=True)[:64]
                    out.append((toxic, len(s), best))
            yield pd.DataFrame(out, columns=["toxic", "n", "best"])

    some = found.where("fold = 4")
    if len({r["toxic"] for r in some.select("toxic").distinct().collect()}) < 2:
        some = found
    seen = some.select("toxic", "text").mapInPandas(measure, "toxic int, n long, best array<double>").toPandas()
    if len(set(seen["toxic"])) < 2:
        model.known = False
        return model
    clean = seen[seen["toxic"] == 0]
    best = np.array([b[0] if len(b) else 0.0 for b in clean["best"]])
    model.rate, model.k = extreme_value(best, clean["n"].to_numpy(np.float64))
    x = np.log1p([model.evidence([(0, 0, s) for s in b], n) for b, n in zip(seen["best"], seen["n"], strict=True)])
    y = seen["toxic"].to_numpy(np.float64)
    model.a, model.b = logistic(x, y, np.where(y == 1, taken[1], taken[0]))
    return model


def positions(text: str, passages: list[tuple[int, int, float, float]]) -> list[tuple[int, int, float, float]]:
    """Passages by tokens as passages by characters."""
    out, found, at = [], _TOKEN.finditer(text), 0
    for first, end, score, expected in passages:
        begin = next(islice(found, first - at, None))
        last = begin if end - first == 1 else next(islice(found, end - first - 2, None))
        out.append((begin.start(), last.end(), score, expected))
        at = end
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and passages (start, end, score, expected); only ``text`` is looked at."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, passages array<struct<start:int,end:int,score:double,expected:double>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            scores, passages = [], []
            for text in texts:
                value, found = given.value.judge(text)
                scores.append(value)
                passages.append([dict(zip(("start", "end", "score", "expected"), p, strict=True))
                                 for p in (positions(text, found) if found else [])])
            yield pd.DataFrame({"score": scores, "passages": passages})
        given.value.cache.clear()

    out = docs.withColumn("__toxicity", judge(F.col("text").cast("string")))
    return out.select(*docs.columns, "__toxicity.score", "__toxicity.passages")
