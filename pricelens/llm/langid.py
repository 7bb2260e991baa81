"""Language of code-switched text: a linear-chain conditional random field over words.

Every word with a letter gets a label. Its features are byte affixes, byte n-grams with
word ends, and membership in each language's learned lexicon; transitions between labels
are learned too. Marginals come from forward-backward over the whole text; a document's
language is the one with the largest sum of marginals, its score the share of that sum.

Training: a bounded sample on the driver (``DOCS`` documents a language by hash of doc_id,
``PIECES`` pieces of ``PIECE_CHARS`` characters from each), spliced into sequences that
switch language between pieces. The model is some 2**15 by languages of weights and at
most ``LEXICON`` words a language, so it may be broadcast; more than ``MAX_LANGUAGES``
languages are refused.

Texts of any length: words are cut into segments, each segment's transfer matrix is
computed at once for all segments of a batch, and boundary vectors are carried along the
segments of a text, which gives exactly the marginals of the whole chain.

Defined results: ``und`` with score 0 for a null text or one without letters, and for
every text if nothing could be learned (no labelled row). Ties go to the language that
comes first by code point. A null doc_id counts as the empty text in the fold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import give_back

UNKNOWN = "und"
DOCS, PIECES, PIECE_CHARS, LEXICON, MAX_LANGUAGES = 400, 3, 600, 1000, 256
HASHES, STEPS, RATE, DECAY = 1 << 15, 60, 0.1, 1e-4
SEGMENT, BATCH_WORDS = 32, 400_000
#: Most numbers in an array of training (chains x words x languages) and of labelling
#: (segments x languages x languages), beyond a single chain or segment.
TRAIN_CELLS, MOVE_CELLS = 1 << 22, 1 << 22
#: Remembered words: as they stand in texts, and bare with their weights.
CACHE_FORMS, CACHE_WORDS = 150_000, 250_000
MIN_SCORE = 0.4


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def bare(word: str) -> str:
    """A word in lower case without what isn't a letter at its ends; empty if none is one."""
    low = word.lower()
    if low.isalpha():
        return low
    at = [i for i, c in enumerate(low) if c.isalpha()]
    return low[at[0] : at[-1] + 1] if at else ""


def features(word: str, lexicon: dict[str, tuple[int, ...]]) -> list[int]:
    """Feature numbers of a bare word."""
    w = b"^" + word.encode() + b"$"
    n, mask = len(w), HASHES - 1
    out = [crc32(w[i : i + 2]) & mask for i in range(n - 1)]
    out += [crc32(w[i : i + 3]) & mask for i in range(n - 2)]
    out += [crc32(w[1 : 1 + k], 1) & mask for k in (1, 2, 3, 4)]
    out += [crc32(w[-1 - k : -1], 2) & mask for k in (1, 2, 3, 4)]
    return out + [HASHES + k for k in lexicon.get(word, ())]


class Field:
    """A trained model: labels, feature weights, transitions, lexicon."""

    def __init__(self, labels: list[str], lexicon: dict[str, tuple[int, ...]]):
        n = len(labels)
        self.labels, self.lexicon = labels, lexicon
        self.weights, self.steps = np.zeros((HASHES + n, n)), np.zeros((n, n))
        self.numbers: dict[str, int] = {}

    def __getstate__(self):
        return self.__dict__ | {"numbers": {}}

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log weights of bare words, a row each."""
        lists = [features(w, self.lexicon) for w in words]
        flat = np.fromiter((f for x in lists for f in x), np.int64, sum(map(len, lists)))
        starts = np.cumsum([0, *map(len, lists[:-1])])
        out = np.empty((len(words), len(self.labels)))
        for k in range(len(self.labels)):
            out[:, k] = np.add.reduceat(self.weights[:, k][flat], starts)
        return out

    def number(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
        """Rows of ``table`` for the labelled words of each text, and the table: exp of the
        emissions, scaled to 1 at most. Words are remembered until a cache is full."""
        if not self.numbers or len(self.known) > CACHE_WORDS:
            self.numbers, self.known, self.table = {"": -1}, {"": -1}, np.empty((1024, len(self.labels)), np.float32)
            self.filled = 0
        elif len(self.numbers) > CACHE_FORMS:
            self.numbers = {"": -1}
        numbers, known, new, out = self.numbers, self.known, [], []
        for text in texts:
            found = (text or "").split()
            try:
                ids = [numbers[w] for w in found]
            except KeyError:
                for w in found:
                    if w not in numbers:
                        b = bare(w)
                        if (i := known.get(b)) is None:
                            i = known[b] = self.filled + len(new)
                            new.append(b)
                        numbers[w] = i
                ids = [numbers[w] for w in found]
            ids = np.array(ids, dtype=np.int64)
            out.append(ids[ids >= 0])
        if new:
            e = self.emissions(new)
            need = self.filled + len(new)
            if need > len(self.table):
                self.table = np.concatenate((self.table, np.empty((max(need, len(self.table)), len(self.labels)), np.float32)))
            self.table[self.filled : need] = np.exp(e - e.max(1, keepdims=True))
            self.filled = need
        return out, self.table

    def forget(self) -> None:
        """Let go of the remembered words."""
        self.numbers, self.known, self.table = {}, {}, np.empty((0, len(self.labels)), np.float32)

    def batch_words(self) -> int:
        """Words that are labelled at once, in whole segments."""
        return max(1, min(BATCH_WORDS // SEGMENT, MOVE_CELLS // len(self.labels) ** 2)) * SEGMENT

    def marginal_sums(self, ids: list[np.ndarray], table: np.ndarray) -> np.ndarray:
        """Sum of the words' marginals for each text of one word or more, so many segments
        at once; a longer text in pieces that hand on their boundary vectors."""
        most, out, at = self.batch_words(), [], 0
        while at < len(ids):
            if len(ids[at]) > most:
                pieces = [ids[at][k : k + most] for k in range(0, len(ids[at]), most)]
                enter = [None]
                for piece in pieces[:-1]:
                    enter.append(self._marginal_sums([piece], table, enter[-1])[1])
                leave, sums = None, 0.0
                for piece, a in zip(reversed(pieces), reversed(enter), strict=True):
                    one, _, leave = self._marginal_sums([piece], table, a, leave)
                    sums = sums + one
                out.append(sums)
                at += 1
                continue
            end, segs = at, 0
            while end < len(ids) and (end == at or segs - len(ids[end]) // -SEGMENT <= most // SEGMENT):
                segs -= len(ids[end]) // -SEGMENT
                end += 1
            out.append(self._marginal_sums(ids[at:end], table)[0])
            at = end
        return np.concatenate(out)

    def _marginal_sums(self, ids: list[np.ndarray], table: np.ndarray, enter: np.ndarray | None = None,
                       leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sums, and the vectors after the last and before the first word of ``ids``.
        ``enter`` and ``leave``: what they are at the ends of a piece within a text."""
        n_labels, count = len(self.labels), np.array([len(x) for x in ids])
        segs = -(-count // SEGMENT)
        first = np.cumsum(segs) - segs
        total = int(segs.sum())
        rows = np.full((total, SEGMENT), -1, np.int64)
        flat = np.concatenate(ids)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
        rows[np.repeat(first, count) + place // SEGMENT, place % SEGMENT] = flat
        opens = np.zeros(total, bool)
        opens[first] = enter is None
        step = np.exp(self.steps - self.steps.max()).astype(np.float32)
        there = rows >= 0
        given = np.where(there[..., None], table[np.where(there, rows, 0)], np.float32(1))

        def scaled(x, axes):
            return x / x.sum(axis=axes, keepdims=True)

        moves = np.broadcast_to(np.eye(n_labels, dtype=np.float32), (total, n_labels, n_labels)).copy()
        for s in range(SEGMENT):
            on = there[:, s]
            to = (moves.reshape(-1, n_labels) @ step).reshape(moves.shape)
            if s == 0:
                to = np.where(opens[:, None, None], moves, to)
            to = scaled(to * given[:, s, None, :], (1, 2))
            moves = np.where(on[:, None, None], to, moves)
        ahead = np.ones((total, n_labels), np.float32)  # before a segment, from the left
        behind = np.ones((total, n_labels), np.float32)  # after a segment, from the right
        if enter is not None:
            ahead[0] = enter
        if leave is not None:
            behind[-1] = leave
        order = np.argsort(-segs, kind="stable")
        more = np.searchsorted(-segs[order], -np.arange(1, int(segs.max()) + 1), side="right")
        for k in range(1, int(segs.max())):
            at = first[order[: more[k]]] + k
            ahead[at] = scaled(np.einsum("bi,bij->bj", ahead[at - 1], moves[at - 1]), 1)
            back = first[order[: more[k]]] + segs[order[: more[k]]] - 1 - k
            behind[back] = scaled(np.einsum("bij,bj->bi", moves[back + 1], behind[back + 1]), 1)
        left = np.empty((SEGMENT, total, n_labels), np.float32)
        a = ahead
        for s in range(SEGMENT):
            to = a @ step
            if s == 0:
                to = np.where(opens[:, None], a, to)
            a = np.where(there[:, s, None], scaled(to * given[:, s], 1), a)
            left[s] = a
        sums, b = np.zeros((total, n_labels)), behind
        for s in range(SEGMENT - 1, -1, -1):
            on = there[:, s, None]
            sums += np.where(on, scaled(left[s] * b, 1), 0)
            b = np.where(on, scaled((given[:, s] * b) @ step.T, 1), b)
        return np.add.reduceat(sums, first, axis=0), a[-1], b[0]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.labels:
            return langs, scores
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars < 6 * self.batch_words()):
                chars += len(texts[end] or "")
                end += 1
            ids, table = self.number(texts[at:end])
            some = [k for k, x in enumerate(ids) if len(x)]
            if some:
                sums = self.marginal_sums([ids[k] for k in some], table)
                share = sums / sums.sum(1, keepdims=True)
                for k, best, score in zip(some, share.argmax(1), share.max(1), strict=True):
                    langs[at + k], scores[at + k] = self.labels[best], min(1.0, float(score))
            at = end
        return langs, scores


def train(pieces: list[tuple[str, str]], seed: int = 11, steps: int = STEPS) -> Field:
    """Fits a field to (language, text) pieces by gradient ascent on the log likelihood."""
    labels = sorted({lang for lang, _ in pieces})
    split = [(labels.index(lang), [b for w in text.split() if (b := bare(w))]) for lang, text in pieces]
    split = [(k, ws) for k, ws in split if ws]
    counts = [Counter() for _ in labels]
    for k, ws in split:
        counts[k].update(ws)
    lexicon: dict[str, list[int]] = {}
    for k, c in enumerate(counts):
        for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            if n > 1:
                lexicon.setdefault(w, []).append(k)
    field = Field(labels, {w: tuple(ks) for w, ks in lexicon.items()})
    if len(labels) < 2:
        return field
    n_labels = len(labels)
    order = np.random.default_rng(seed).permutation(len(split))
    # three pieces to a sequence, so two changes of language at most
    chains = [[split[i] for i in order[k : k + 3]] for k in range(0, len(order), 3)]
    words = {w: i for i, w in enumerate(sorted({w for _, ws in split for w in ws}))}
    lists = [features(w, field.lexicon) for w in words]
    flat = np.fromiter((f for x in lists for f in x), np.int32, sum(map(len, lists)))
    ends = np.cumsum([len(x) for x in lists])
    del lists
    longest = max(sum(len(ws) for _, ws in c) for c in chains)
    ids, gold = np.full((len(chains), longest), -1, np.int32), np.zeros((len(chains), longest), np.int16)
    for r, chain in enumerate(chains):
        ids[r, : sum(len(ws) for _, ws in chain)] = [words[w] for _, ws in chain for w in ws]
        gold[r, : sum(len(ws) for _, ws in chain)] = [k for k, ws in chain for _ in ws]
    there = ids >= 0
    total = there.sum()
    onehot = np.eye(n_labels)
    size = max(1, TRAIN_CELLS // (longest * n_labels))
    linked = there[:, 1:] & there[:, :-1]
    seen = np.zeros((n_labels, n_labels))
    np.add.at(seen, (gold[:, :-1][linked], gold[:, 1:][linked]), 1)
    moment = {"w": [0.0, 0.0], "t": [0.0, 0.0]}

    def ascend(what: str, value: np.ndarray, slope: np.ndarray, t: int) -> np.ndarray:
        m, v = moment[what]
        moment[what] = m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        return value + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)

    def slopes(ids: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What some chains add to the slope of the weights and to the expected transitions."""
        there = ids >= 0
        some = np.unique(ids[there])
        ids = np.searchsorted(some, ids)
        counts = ends[some] - np.where(some > 0, ends[some - 1], 0)
        starts = np.cumsum(counts) - counts
        feats = flat[np.repeat(ends[some] - counts - starts, counts) + np.arange(counts.sum())]
        owner = np.repeat(np.arange(len(some)), counts)
        e = np.stack([np.add.reduceat(field.weights[:, k][feats], starts) for k in range(n_labels)], 1)
        p = np.exp(e - e.max(1, keepdims=True))
        move = np.exp(field.steps - field.steps.max())
        given = np.where(there[..., None], p[np.where(there, ids, 0)], 1.0)
        left = np.empty((longest, len(ids), n_labels))
        a = given[:, 0] / given[:, 0].sum(1, keepdims=True)
        left[0] = a
        for s in range(1, longest):
            to = (a @ move) * given[:, s]
            a = np.where(there[:, s, None], to / to.sum(1, keepdims=True), a)
            left[s] = a
        by_word, by_step = np.zeros((len(some), n_labels)), np.zeros((n_labels, n_labels))
        b = np.ones((len(ids), n_labels))
        for s in range(longest - 1, -1, -1):
            on = there[:, s]
            g = left[s] * b
            g /= g.sum(1, keepdims=True)
            np.add.at(by_word, ids[on, s], onehot[gold[on, s]] - g[on])
            if s:
                right = given[:, s] * b
                back = right @ move.T
                before = left[s - 1] / (left[s - 1] * back).sum(1, keepdims=True)
                by_step += move * (before[on].T @ right[on])
                b = np.where(on[:, None], back / back.sum(1, keepdims=True), b)
        return np.stack([np.bincount(feats, by_word[owner, k], len(field.weights)) for k in range(n_labels)], 1), by_step

    for t in range(1, steps + 1):
        # the whole sample's slope, some chains at a time
        slope, by_step = np.zeros(field.weights.shape), seen.copy()
        for k in range(0, len(chains), size):
            of_weights, expected = slopes(ids[k : k + size], gold[k : k + size])
            slope += of_weights
            by_step -= expected
        field.weights = ascend("w", field.weights, slope / total - DECAY * field.weights, t)
        field.steps = ascend("t", field.steps, by_step / total - DECAY * field.steps, t)
    return field


def sample(docs: DataFrame, docs_per_language: int = DOCS) -> list[tuple[str, str]]:
    """The bounded training sample: pieces spread over each chosen document."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    chance = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.length("text"))
    rows = usable.select(F.col("lang").cast("string").alias("lang"), F.length("text").alias("n"),
                         chance.alias("chance"),
                         *[F.expr(f"substring(text, CAST(1 + greatest(length(text) - {PIECE_CHARS}, 0) * {k} "
                                  f"div {max(1, PIECES - 1)} AS INT), {PIECE_CHARS})").alias(f"piece{k}")
                           for k in range(PIECES)])
    # a short text's pieces would be one piece several times
    rows = rows.withColumns({f"piece{k}": F.when(F.col("n") > k * PIECE_CHARS, F.col(f"piece{k}"))
                             for k in range(1, PIECES)})
    one = W.partitionBy("lang").orderBy("chance", "piece0")
    few = rows.withColumn("nth", F.row_number().over(one)).where(F.col("nth") <= docs_per_language).collect()
    if len({r["lang"] for r in few}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    few.sort(key=lambda r: (r["lang"], r["nth"]))
    return [(r["lang"], r[f"piece{k}"]) for r in few for k in range(PIECES) if r[f"piece{k}"]]


def fit(docs: DataFrame, docs_per_language: int = DOCS) -> Field:
    return train(sample(docs, docs_per_language))


def identify(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with lang_pred and score; only ``text`` is looked at."""
    model = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            for texts in batches:
                langs, scores = model.value.predict(texts.tolist())
                yield pd.DataFrame({"lang_pred": langs, "score": scores})
        finally:
            model.value.forget()
            give_back()

    out = docs.withColumn("__language", label(F.col("text").cast("string")))
    return out.select(*docs.columns, "__language.lang_pred", "__language.score")


def accept(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is known with ``min_score`` or more, columns as before.
    Texts go to Python alone, and the other columns stay where they are."""
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])  # no name clashes with what is added
    labelled = identify(plain.withColumn("text", F.col(f"c{names.index('text')}")), fit(docs))
    kept = labelled.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*[F.col(f"c{k}").alias(name) for k, name in enumerate(names)])
