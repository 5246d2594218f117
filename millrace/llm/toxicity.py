"""Toxicity scores: misspelled lexicon terms by Levenshtein automata over a trie, weighed by their context window.

Fitting takes at most ``most_per_class`` labelled rows of each class (those of the smallest id hash) that do not belong
to the held-out fold. Words and stems that tell toxic from clean documents become the lexicon; terms that stay precise
when misspelled may be matched with an edit: one at any byte, a swap of neighbours included, or else one behind the first
byte. A term's window of bytes to either side tells quotation (an opening mark
before, a closing one after) from abuse, and a small logistic model over the counts of exact, misspelled and quoted
terms gives the score. All documents are then scored in one pass without a shuffle; labels, lang, source and ids are
never features.

Defined cases: null and empty texts score as texts without terms; labels with a null id or class are ignored, a row
labelled both ways counts as toxic; without labels of both classes the score is the share of toxic labels (0 without
labels); repeated rows are scored one by one; other columns are carried only on request.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textvec as tv
from millrace.llm.levenshtein import LexiconAutomaton, Term
from millrace.llm.shared import cut, map_text, quoted, release_memory, ship_package

FOLDS = 5
#: Opening and closing quotation marks as UTF-8.
OPENING = ('"', "“", "«", "„", "‘")
CLOSING = ('"', "”", "»", "“", "’")
FITTING_ROUNDS = 6  # in which terms may give up edits
STEMS = range(4, 9)  # lengths of stems in bytes
#: Where fitting starts from, and where it stays without evidence: bias, exact, misspelled, quoted.
PRIOR = np.array([-3.0, 5.0, 3.0, 0.5])


@dataclass
class ToxicityModel:
    terms: list[Term] = field(default_factory=list)
    weights: np.ndarray | None = None
    base_rate: float = 0.0
    window: int = 64

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.base_rate)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ self.weights[1:], -30, 30)))


def held_out(id_col: str = "doc_id"):
    return F.crc32(quoted(id_col).cast("string").cast("binary")) % FOLDS == 0


def lowered_words(text, limit: int = 1 << 20):
    """(first row, lower-case bytes, offsets, starts, ends, first word) of each run of texts."""
    for row, data, offsets in tv.blocks(pc.utf8_lower(text), limit):
        starts, ends, first = tv.word_spans(data, offsets, tv.WORD_BYTES)
        yield row, data, offsets, starts, ends, first


def is_quoted(raw: bytes, start: int, end: int, lo: int, hi: int, window: int) -> bool:
    """An opening mark in the window before the term that nothing closes, and a closing one in the window after it."""
    before, after = raw[max(lo, start - window) : start], raw[end : min(hi, end + window)]
    for a, b in zip(OPENING, CLOSING):
        a, b = a.encode(), b.encode()
        opened = before.count(a) % 2 == 1 if a == b else before.rfind(a) > before.rfind(b)
        if opened and b in after:
            return True
    return False


def term_counts(text, automaton: LexiconAutomaton, window: int) -> np.ndarray:
    """For each text, term and kind (exact, misspelled, quoted): rows of (text, term, kind, count)."""
    out = []
    for row, data, offsets, starts, ends, first in lowered_words(text):
        word, term, edits = automaton.match(data, starts, ends)
        if not len(word):
            continue
        doc = np.searchsorted(first, word, side="right") - 1
        raw = data.tobytes()
        kind = (edits > 0).astype(np.int64)
        for k in range(len(word)):
            if is_quoted(raw, int(starts[word[k]]), int(ends[word[k]]), int(offsets[doc[k]]), int(offsets[doc[k] + 1]), window):
                kind[k] = 2
        rows, count = np.unique(np.stack([doc + row, term, kind]), axis=1, return_counts=True)
        out.append(np.concatenate([rows, count[None]]))
    return np.concatenate(out, axis=1).T if out else np.zeros((0, 4), np.int64)


def features_of(counts: np.ndarray, n: int, loose: np.ndarray) -> np.ndarray:
    """log(1 + terms) by kind; misspellings of terms that aren't loose don't count."""
    x = np.zeros((n, 3))
    if len(counts):
        keep = (counts[:, 2] != 1) | loose[counts[:, 1]]
        np.add.at(x, (counts[keep, 0], counts[keep, 2]), counts[keep, 3])
    return np.log1p(x)


def _sample(labels: DataFrame, most_per_class: int, id_col: str, label_col: str) -> DataFrame:
    known = labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("id"))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most_per_class) for y in (0, 1)]
    return cut(parts[0].unionByName(parts[1]))


def _candidate_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean, places): documents of each class that hold a word ("=word") or stem ("^stem").

    ``places`` has a bit for each of 64 hashes of the word that stands before it in a toxic document. Copies and near
    copies of one document repeat the same places, so they can't lend a word the look of a habit.
    """

    def run(batches):
        seen: dict[bytes, list[int]] = {}

        def flush():
            keys, values = list(seen), list(seen.values())
            seen.clear()
            for lo in range(0, len(keys), 100_000):
                part = values[lo : lo + 100_000]
                masks = np.array([v[2] for v in part], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys[lo : lo + 100_000], pa.binary()), pa.array([v[1] for v in part], pa.int64()), pa.array([v[0] for v in part], pa.int64()), pa.array(masks)], ["f", "toxic", "clean", "places"])

        for batch in batches:
            y = batch.column(0).to_pylist()
            text = batch.column(1).cast(pa.large_string()).fill_null("")
            for row, data, _, starts, ends, first in lowered_words(text):
                raw = data.tobytes()
                all_words = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
                for i in range(len(first) - 1):
                    words = all_words[first[i] : first[i + 1]]
                    label, found = y[row + i], {}
                    for before, w in zip([b"", *words], words):
                        if w not in found:
                            found[w] = 1 << (zlib.crc32(before) & 63) if label else 0
                    features: dict[bytes, int] = {}
                    for w, bit in found.items():
                        features[b"=" + w] = bit
                        for k in STEMS:
                            if len(w) < k:
                                break
                            f = b"^" + w[:k]
                            features[f] = features.get(f, 0) | bit
                    for f, bits in features.items():
                        entry = seen.get(f)
                        if entry is None:
                            entry = seen[f] = [0, 0, 0]
                        entry[label] += 1
                        entry[2] |= bits
                if len(seen) > 150_000:
                    yield from flush()
        yield from flush()
        release_memory()

    made = rows.select("y", "t").mapInArrow(run, "f binary, toxic long, clean long, places long")
    return made.groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_count(F.bit_or("places")).alias("places"))


def least_support(features_by_df: dict[int, int], toxic: int, clean: int, chance: float = 0.01) -> int:
    """So many documents that no feature is expected to be in toxic ones alone by chance."""
    share = toxic / (toxic + clean)
    for t in range(3, max(features_by_df, default=3) + 1):
        if share**t * sum(n for df, n in features_by_df.items() if df >= t) < chance:
            return t
    return max(features_by_df, default=3)


def choose_terms(candidates: dict[bytes, tuple[int, int, int]], toxic: int, clean: int, least: int = 3, purity: float = 0.95) -> list[Term]:
    """The shortest pure stems, each lengthened while it keeps nine tenths of its words' documents; else pure words.

    A stem with a single word is that word.
    """

    def pure(f: bytes) -> bool:
        t, c, places = candidates.get(f, (0, 0, 0))
        return min(t, places) >= min(least, 32) and t / toxic >= purity * (t / toxic + (c + 0.5) / clean)

    words = sorted(f[1:] for f in candidates if f[:1] == b"=")

    def below(stem: bytes) -> list[bytes]:
        lo = bisect.bisect_left(words, stem)
        return words[lo : bisect.bisect_left(words, stem + b"\xff")]

    kept: dict[tuple[bytes, bool], int] = {}
    covered: set[bytes] = set()
    for f in sorted((f for f in candidates if f[:1] == b"^"), key=lambda f: (len(f), f)):
        stem = f[1:]
        if not pure(f) or any(stem[:k] in covered for k in STEMS):
            continue
        covered.add(stem)
        own = below(stem)
        mass = sum(candidates[b"=" + w][0] for w in own)
        for k in STEMS:
            longer = {w[:k] for w in own if len(w) >= k}
            best = max(longer, key=lambda x: sum(candidates[b"=" + w][0] for w in below(x)), default=stem)
            if k > len(stem) and sum(candidates[b"=" + w][0] for w in below(best)) >= 0.9 * mass:
                stem = best
        own = below(stem)
        top = max(own, key=lambda w: candidates[b"=" + w][0], default=stem)
        single = bool(own) and candidates[b"=" + top][0] >= 0.9 * mass
        kept[(top, False) if single else (stem, True)] = candidates[f][0]
    for w in words:
        if len(w) > 2 and pure(b"=" + w) and not any(w[:k] in covered for k in STEMS):
            kept[w, False] = candidates[b"=" + w][0]
    chosen = sorted(kept, key=lambda k: (-kept[k], k))
    return [Term(text, stem, 1, True) for text, stem in chosen]


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards PRIOR; the classes weigh the same."""
    z = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    weight = np.where(y == 1, len(y) / (2 * max(1, (y == 1).sum())), len(y) / (2 * max(1, (y == 0).sum())))
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (weight * (y - p)) - ridge * (w - PRIOR))
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, most_per_class: int = 10_000, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic", window: int = 64) -> ToxicityModel:
    """At most 2 * ``most_per_class`` labelled rows are read; what reaches the driver is bounded by that as well.

    Nothing else is cut: the driver gets every word and stem of the sample that is at least four times as frequent in toxic
    texts, and all terms chosen from them are used.
    """
    ship_package(docs.sparkSession)
    sample = _sample(labels, most_per_class, id_col, label_col)
    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    model = ToxicityModel(base_rate=toxic / max(1, toxic + clean), window=window)
    if not toxic or not clean:
        return model
    picked = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("t")).join(F.broadcast(sample), "id")
    rows = cut(picked.select("y", "t"))
    features = cut(_candidate_counts(rows))
    by_df = {r["df"]: r["n"] for r in features.groupBy(F.least(F.col("toxic") + F.col("clean"), F.lit(60)).alias("df")).agg(F.count(F.lit(1)).alias("n")).collect()}
    found = features.where((F.col("toxic") >= max(2, toxic // 4000)) & (F.col("toxic") * clean > 4 * F.col("clean") * toxic))
    # as many as the sample has, which most_per_class bounds
    model.terms = choose_terms({bytes(r["f"]): (r["toxic"], r["clean"], r["places"]) for r in found.collect()}, toxic, clean, least_support(by_df, toxic, clean))
    if not model.terms:
        return model
    fields = T.StructType([T.StructField("hits", T.ArrayType(T.LongType()))])
    for last in [False] * (FITTING_ROUNDS - 1) + [True]:
        terms = model.terms

        def worker(terms=terms):
            automaton = LexiconAutomaton(terms)

            def handle(text, _):
                by_row: list[list[int]] = [[] for _ in range(len(text))]
                for r in term_counts(text, automaton, window).tolist():
                    by_row[r[0]] += r[1:]
                return {"hits": pa.array(by_row, pa.list_(pa.int64()))}

            return handle

        seen = map_text(rows, worker, fields, "t", ("y",)).collect()
        y = np.array([r["y"] for r in seen])
        counts = np.array([(i, *r["hits"][k : k + 3]) for i, r in enumerate(seen) for k in range(0, len(r["hits"]), 3)], np.int64).reshape(-1, 4)
        near = counts[counts[:, 2] == 1]
        bad = np.bincount(near[:, 1], weights=1 - y[near[:, 0]], minlength=len(terms)) / clean
        good = np.bincount(near[:, 1], weights=y[near[:, 0]], minlength=len(terms)) / toxic
        loose = (bad <= 0.05 * good + 0.0002) & np.array([t.edits > 0 for t in terms])
        # a word belongs to one term, so what a term gives up may fall to another, which is then tried again
        model.terms = [t if loose[i] else Term(t.text, t.stem, int(t.free and not last)) for i, t in enumerate(terms)]
        if model.terms == terms:
            break
    model.weights = fit_weights(features_of(counts, len(y), loose), y)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns with score (0 to 1) and predicted (1 from 0.5 on)."""
    ship_package(docs.sparkSession)

    def worker():
        automaton = LexiconAutomaton(model.terms)
        loose = np.array([t.edits > 0 for t in model.terms], bool)

        def handle(text, _):
            score = model.scores(features_of(term_counts(text, automaton, model.window), len(text), loose))
            return {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}

        return handle

    return map_text(docs, worker, T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]), text_col, carry)
