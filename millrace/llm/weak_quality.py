"""Quality scores from weak labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer.

Each labeller votes good, bad or nothing on a document from counts over its whole text; several look at the same kind
of fault, so their votes overlap. The votes of all documents are counted by pattern (at most 3 to the power of the
labellers), and expectation-maximisation over those counts finds each labeller's accuracy on good and on bad
documents and the share of good ones. A pattern's posterior then labels the documents of a bounded sample
(``most_fitted``, the smallest id hashes), and a linear scorer over hashed words and word shapes is fitted to those
soft labels. It scores every whole text in a pass of its own. Nothing is learned from given labels.

Defined cases: null and empty texts get the votes of an empty text and score 0 (there is nothing to train on); ties and
repeated rows are scored one by one; other columns are carried only on request; an empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textvec as tv
from millrace.llm.shared import cut, map_text, quoted, ship_package

#: Fixed values, together: name of the statistic, good up to, bad from (or, where bad is lower, good from, bad up to).
LABELLERS = (
    ("odd_marks", 0.004, 0.02),  # signs such as % * # & per byte
    ("marked_words", 0.02, 0.15),  # words that end in two or more marks
    ("capitals", 0.12, 0.40),  # capitals among ASCII letters
    ("shouts", 0.004, 0.05),  # exclamation marks per word
    ("bars", 0.002, 0.05),  # words that are a lone separator
    ("stutter", 0.03, 0.20),  # words equal to the word before
    ("repeated_trios", 0.25, 0.55),  # runs of three words that occurred before
    ("listed", 0.05, 0.25),  # words that stand next to a lone separator: menus and tables
)
GOOD, BAD, NOTHING = 0, 1, 2
FEATURE_BITS = 15


def _table(chars: str) -> np.ndarray:
    return tv.byte_class(lambda b: chr(b) in chars)


_ODD, _CAPITAL = _table("%*#&$@^~<>{}\\"), tv.byte_class(lambda b: 65 <= b <= 90)
_ASCII_LETTER = tv.byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122)
_MARK = tv.byte_class(lambda b: 33 <= b <= 126 and not chr(b).isalnum())
#: Bytes as their kind: letters of either case, digits, and every mark as itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = ord("A"), ord("a"), ord("0"), ord("a")


class Block:
    """Words of a run of texts with what labellers and features need of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.starts, self.ends, self.first = tv.word_spans(data, offsets, tv.NONSPACE_BYTES)
        low = tv.LOWER[data]
        self.words = tv.span_hashes(tv.prefix_sums(low), self.starts, self.ends)
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.n_words)), self.n_words)

    def per_text(self, byte_flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(byte_flags)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def per_words(self, word_flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc[word_flags], minlength=len(self.n_words))

    def same_text(self, gap: int) -> np.ndarray:
        """Places whose word ``gap`` further on is in the same text."""
        return np.flatnonzero(self.doc[gap:] == self.doc[: len(self.doc) - gap]) if len(self.doc) > gap else np.zeros(0, np.int64)

    def statistics(self) -> np.ndarray:
        """One column for each labeller."""
        size = np.maximum(1, np.diff(self.offsets))
        n = np.maximum(1, self.n_words)
        last = self.data[self.ends - 1] if len(self.ends) else np.zeros(0, np.uint8)
        length = self.ends - self.starts
        before_last = self.data[np.maximum(self.ends - 2, 0)] if len(self.ends) else last
        alone = (length == 1) & _MARK[last]
        stutter = np.zeros(len(self.words), bool)
        near = self.same_text(1)
        stutter[near + 1] = self.words[near + 1] == self.words[near]
        listed = np.zeros(len(self.words), bool)
        listed[near] |= alone[near + 1]
        listed[near + 1] |= alone[near]
        trio = self.same_text(2)
        run = tv.mix(self.words[trio] + tv.mix(self.words[trio + 1] + tv.mix(self.words[trio + 2] + self.doc[trio].astype(np.uint64))))
        _, new = np.unique(run, return_index=True)
        again = np.ones(len(trio), bool)
        again[new] = False
        trios = np.bincount(self.doc[trio], minlength=len(n))
        return np.stack(
            [
                self.per_text(_ODD[self.data]) / size,
                self.per_words((length > 2) & _MARK[last] & _MARK[before_last]) / n,
                self.per_text(_CAPITAL[self.data]) / np.maximum(1, self.per_text(_ASCII_LETTER[self.data])),
                self.per_text(self.data == 33) / n,
                self.per_words(alone) / n,
                self.per_words(stutter) / n,
                np.bincount(self.doc[trio[again]], minlength=len(n)) / np.maximum(1, trios),
                self.per_words(listed) / n,
            ],
            axis=1,
        )

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, hashed feature) of every word, its shape, and whether it repeats the word before it."""
        kinds = _SHAPE[self.data]
        keep = np.ones(len(kinds), bool)
        keep[1:] = kinds[1:] != kinds[:-1]
        keep[self.starts] = True
        place = np.concatenate([[0], np.cumsum(keep)])
        sums = tv.prefix_sums(kinds[keep])
        shape = tv.span_hashes(sums, place[self.starts], place[self.ends])
        repeat = np.zeros(len(self.words), bool)
        near = self.same_text(1)
        repeat[near + 1] = self.words[near + 1] == self.words[near]
        mask = np.uint64((1 << FEATURE_BITS) - 1)
        ids = [(self.words & mask), (tv.mix(shape + np.uint64(1)) & mask), np.where(repeat, np.uint64(1), np.uint64(2))]
        return np.tile(self.doc, 3), np.concatenate(ids).astype(np.int64)


def votes_of(statistics: np.ndarray) -> np.ndarray:
    out = np.full(statistics.shape, NOTHING, np.int64)
    for k, (_, good, bad) in enumerate(LABELLERS):
        out[statistics[:, k] <= good, k] = GOOD
        out[statistics[:, k] >= bad, k] = BAD
    return out


def pattern_of(votes: np.ndarray) -> np.ndarray:
    return votes @ 3 ** np.arange(len(LABELLERS))


def pattern_votes(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class LabelModel:
    """Share of good documents and, for each labeller, the chances of its votes on good and on bad ones."""

    good_share: float
    chances: np.ndarray  # (labeller, class, vote)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is good."""
        logs = np.log(np.array([self.good_share, 1 - self.good_share]))[None] + sum(np.log(self.chances[k][:, votes[:, k]].T) for k in range(votes.shape[1]))
        return 1 / (1 + np.exp(np.clip(logs[:, 1] - logs[:, 0], -700, 700)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, pseudo: float = 1.0) -> LabelModel:
    """EM with a prior: as many imagined good documents as real ones hold the rate of false alarms down.

    Faults come in kinds that hardly overlap. Without that prior, EM takes the kind with the most votes for the only
    one and the other kinds' votes for errors on good documents.
    """
    votes, n = pattern_votes(patterns), counts.astype(float)
    k = len(LABELLERS)
    start = np.array([[0.80, 0.004, 0.196], [0.45, 0.35, 0.20]])
    model = LabelModel(0.8, np.repeat(start[None], k, axis=0))
    for _ in range(rounds):
        p = model.posterior(votes)
        weights = np.stack([n * p, n * (1 - p)])
        share = (weights[0].sum() + pseudo) / (n.sum() + 2 * pseudo)
        chances = np.empty_like(model.chances)
        for j in range(k):
            for c in (GOOD, BAD):
                seen = np.bincount(votes[:, j], weights=weights[c], minlength=3) + pseudo * start[c]
                chances[j, c] = seen / seen.sum()
            alarm = (chances[j, GOOD, BAD] * weights[0].sum() + start[GOOD, BAD] * n.sum()) / (weights[0].sum() + max(pseudo, n.sum()))
            rest = chances[j, GOOD, [GOOD, NOTHING]]
            chances[j, GOOD, [GOOD, NOTHING]] = rest / rest.sum() * (1 - alarm)
            chances[j, GOOD, BAD] = alarm
        moved = abs(share - model.good_share) + np.abs(chances - model.chances).max()
        model = LabelModel(min(max(share, 1e-6), 1 - 1e-6), chances)
        if moved < 1e-9:
            break
    return model


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float
    accuracies: dict[str, tuple[float, float]] = field(default_factory=dict)

    def scores(self, block: Block) -> np.ndarray:
        doc, feature = block.features()
        total = np.bincount(doc, weights=self.weights[feature], minlength=len(block.n_words))
        z = self.bias + total / np.maximum(1, block.n_words)
        return np.where(block.n_words > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, int]], target: np.ndarray, rounds: int = 300, rate: float = 0.5, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on mean feature values against soft labels, by full-batch Adagrad."""
    doc = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    feature = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int64)
    value = np.concatenate([r[1] / max(1, r[2]) for r in rows]) if rows else np.zeros(0)
    w, bias = np.zeros(1 << FEATURE_BITS), 0.0
    square, square_bias = np.full(1 << FEATURE_BITS, 1e-8), 1e-8
    mass = np.array([target.sum(), (1 - target).sum()])
    weight = (target / max(mass[0], 1e-9) + (1 - target) / max(mass[1], 1e-9)) / 2
    for _ in range(rounds if len(rows) else 0):
        z = bias + np.bincount(doc, weights=w[feature] * value, minlength=len(rows))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        g = np.bincount(feature, weights=error[doc] * value, minlength=len(w)) + ridge * w
        square += g * g
        w -= rate * g / np.sqrt(square)
        gb = error.sum()
        square_bias += gb * gb
        bias -= rate * gb / np.sqrt(square_bias)
    return w, bias


def weak_votes(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and the pattern of votes (a base-3 number, one digit for each labeller)."""
    ship_package(docs.sparkSession)

    def worker():
        def handle(text, _):
            out = np.zeros(len(text), np.int64)
            for row, data, offsets in tv.blocks(text):
                block = Block(data, offsets)
                out[row : row + len(block.n_words)] = pattern_of(votes_of(block.statistics()))
            return {"votes": pa.array(out)}

        return handle

    return map_text(docs, worker, T.StructType([T.StructField("votes", T.LongType())]), text_col, carry)


def fit_quality(docs: DataFrame, most_fitted: int = 4000, text_col: str = "text", id_col: str = "doc_id") -> QualityModel:
    """Votes of all documents give the label model; at most ``most_fitted`` documents' features reach the driver."""
    votes = cut(weak_votes(docs, text_col, (id_col,)))
    patterns = votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    model = fit_label_model(np.array([r["votes"] for r in patterns], np.int64).reshape(-1), np.array([r["n"] for r in patterns], np.int64))
    sample = cut(votes.where(quoted(id_col).isNotNull()).groupBy(quoted(id_col).alias("id")).agg(F.max("votes").alias("v")).orderBy(F.xxhash64("id"), "id").limit(most_fitted))
    picked = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("t")).join(F.broadcast(sample), "id")

    def worker():
        def handle(text, _):
            ids, values, words = [], [], []
            for _, data, offsets in tv.blocks(text):
                block = Block(data, offsets)
                doc, feature = block.features()
                pair, count = np.unique(doc * (1 << FEATURE_BITS) + feature, return_counts=True)
                at = np.searchsorted(pair, np.arange(len(block.n_words) + 1) * (1 << FEATURE_BITS))
                for i in range(len(block.n_words)):
                    ids.append(pair[at[i] : at[i + 1]] % (1 << FEATURE_BITS))
                    values.append(count[at[i] : at[i + 1]])
                words += block.n_words.tolist()
            return {"f": pa.array(ids, pa.list_(pa.int32())), "c": pa.array(values, pa.list_(pa.int32())), "w": pa.array(words, pa.int64())}

        return handle

    fields = T.StructType([T.StructField("f", T.ArrayType(T.IntegerType())), T.StructField("c", T.ArrayType(T.IntegerType())), T.StructField("w", T.LongType())])
    rows, labels = [], []
    for r in map_text(picked, worker, fields, "t", ("v",)).where("w > 0").toLocalIterator():
        rows.append((np.array(r["f"], np.int64), np.array(r["c"], float), r["w"]))
        labels.append(r["v"])
    target = model.posterior(pattern_votes(np.array(labels, np.int64).reshape(-1)))
    weights, bias = fit_scorer(rows, target)
    found = {name: (float(model.chances[k, GOOD, GOOD]), float(model.chances[k, BAD, BAD])) for k, (name, _, _) in enumerate(LABELLERS)}
    return QualityModel(model, weights, bias, found)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """The carried columns with ``score`` (linear), ``weak_label`` (posterior of the votes) and ``keep``."""
    ship_package(docs.sparkSession)

    def worker():
        def handle(text, _):
            score, weak = np.zeros(len(text)), np.zeros(len(text))
            for row, data, offsets in tv.blocks(text):
                block = Block(data, offsets)
                score[row : row + len(block.n_words)] = model.scores(block)
                weak[row : row + len(block.n_words)] = model.labels.posterior(votes_of(block.statistics()))
            return {"score": pa.array(score), "weak_label": pa.array(weak), "keep": pa.array(score >= threshold)}

        return handle

    return map_text(docs, worker, T.StructType([T.StructField("score", T.DoubleType()), T.StructField("weak_label", T.DoubleType()), T.StructField("keep", T.BooleanType())]), text_col, carry)
