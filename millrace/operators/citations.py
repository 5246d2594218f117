"""Audit of citations: whether what a sentence says stands where it says it does.

1. Sentences and documents are cut into shingles of ``SHINGLE`` words (a shorter sentence is one shingle of all its words). The places
   of a sentence's shingles in a document are counted in overlapping windows of about twice the sentence; the windows that hold a
   share of ``CANDIDATE`` of them are candidates. The best window of each document, and all of the cited one, are aligned with the
   sentence word by word (local alignment).
2. A window that holds so many shingles holds one of all but the commonest of the sentence, so only these rarer ones are looked for.
3. Each sentence meets the documents that it cites, and the first ones that hold its rarest shingles. Where all of it aligns there, only
   a place as early in another document can be better, so only the beginnings of the others are looked at.
4. A sentence is *supported* if enough of it aligns within the span that it cites; *misplaced* if it aligns elsewhere, in the
   cited document or in another; else *invented*. Where it aligns best is told with its place.

What is skipped can't align better than what was found, so the result is that of all pairs. Equal sentences
and equal texts are looked at once; what an answer cites is judged after that. A shingle that very many documents hold is dealt by
Spark's skewed join, the sentences of a document ``LISTED`` at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.sources.session import kept, ship_package

SHINGLE = 3
CANDIDATE = 0.3  # share of a sentence's shingles that a window has to hold
ALIGNED = 0.7  # share of a sentence's words that has to align
TOGETHER = 512  # pairs that are aligned at once
FIRST = 3  # of the rarest shingles of a sentence, whose first documents are looked at before others
LISTED = 1024  # sentences that meet a document at once
TOLD = "said long, document_id string, nth int, share double, first int, last int"


def _size():
    """Of how many words the shingles of a sentence are."""
    return F.greatest(F.lit(1), F.least(F.size("asked"), F.lit(SHINGLE)))


def _shingles(words, size):
    """(shingle, place) of an array of words."""
    count = F.size(words) - size + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(F.xxhash64(F.array_join(F.slice(words, i + 1, size), " ")).alias("shingle"), i.alias("place")))).otherwise(F.array().cast("array<struct<shingle:bigint,place:int>>"))


def aligned(asked: list[str], given: list[str]) -> tuple[int, int, int]:
    """(words of ``asked`` that align, first and last place of them in ``given``) in the best local alignment.

    A word that agrees counts 2, one that differs or is left out -1; of equal scores the earliest end counts.
    """
    hits, first, last = aligned_many([asked], [given])
    return int(hits[0]), int(first[0]), int(last[0])


def _coded(lists: list[list[str]], codes: dict[str, int], pad: int) -> np.ndarray:
    """Words as numbers, a row for each list, filled up with ``pad``."""
    out = np.full((len(lists), max(map(len, lists), default=0)), pad, np.int32)
    for row, words in zip(out, lists):
        row[: len(words)] = [codes.setdefault(w, len(codes)) for w in words]
    return out


def aligned_many(asked: list[list[str]], given: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``aligned`` of many pairs, TOGETHER of about one size at a time; what fills a list up agrees with nothing and so adds nothing."""
    out = np.zeros((3, len(asked)), np.int32)
    order = sorted(range(len(asked)), key=lambda i: (len(given[i]), len(asked[i])))
    for at in range(0, len(order), TOGETHER):
        part, codes = order[at : at + TOGETHER], {}
        words, texts = _coded([asked[i] for i in part], codes, -1), _coded([given[i] for i in part], codes, -2)
        shape = (len(part), texts.shape[1] + 1)
        column = np.arange(shape[1], dtype=np.int32)
        score, hits, begin = np.zeros(shape, np.int32), np.zeros(shape, np.int32), np.broadcast_to(column, shape)
        best = np.zeros((4, len(part)), np.int32)  # score, hits, first, last
        best[3] = -1
        for k in range(words.shape[1]):
            same = texts == words[:, k : k + 1]
            over = score[:, :-1] + np.where(same, 2, -1)
            take = over >= score[:, 1:] - 1
            row, row_hits, row_begin = np.zeros(shape, np.int32), np.zeros(shape, np.int32), np.zeros(shape, np.int32)
            row[:, 1:] = np.where(take, over, score[:, 1:] - 1)
            row_hits[:, 1:] = np.where(take, hits[:, :-1] + same, hits[:, 1:])
            row_begin[:, 1:] = np.where(take, begin[:, :-1], begin[:, 1:])
            # words of the document that the sentence leaves out: the latest place to the left that is best for them
            lifted = row + column
            reach = np.maximum.accumulate(lifted, axis=1)
            source = np.maximum.accumulate(np.where(lifted == reach, column, 0), axis=1)
            low = reach <= column
            score = np.where(low, 0, reach - column)
            hits = np.where(low, 0, np.take_along_axis(row_hits, source, 1))
            begin = np.where(low, column, np.take_along_axis(row_begin, source, 1))
            top = score.argmax(axis=1)[:, None]
            found = [np.take_along_axis(x, top, 1)[:, 0] for x in (score, hits, begin)] + [top[:, 0] - 1]
            best = np.where(found[0] > best[0], found, best)
        out[:, part] = best[1:]
    return out[0], out[1], out[2]


def _places(words: list[str], size: int) -> dict[tuple, list[int]]:
    """Where each shingle of a document stands."""
    out: dict[tuple, list[int]] = {}
    for at, shingle in enumerate(zip(*(words[k:] for k in range(size)))):
        out.setdefault(shingle, []).append(at)
    return out


def _half(n):
    """Of how many places half a window is for a sentence of ``n`` words."""
    return max(n, 4)


def best_windows(asked: list[str], places: dict[tuple, list[int]]) -> list[int]:
    """Windows that hold enough of a sentence's shingles, each place in two of them; the fullest first, of equal ones the earliest."""
    size, half, held = min(len(asked), SHINGLE), _half(len(asked)), Counter()
    shingles = set(zip(*(asked[k:] for k in range(size))))
    for s in shingles:
        held.update({w for at in places.get(s, ()) for w in (at // half - 1, at // half)})
    return sorted((w for w, n in held.items() if n >= len(shingles) * CANDIDATE), key=lambda w: (-held[w], w))


def align_pairs(pairs: DataFrame, said: DataFrame, texts: DataFrame) -> DataFrame:
    """TOLD of pairs (said, document_id, cited, before): the best window of each, of a cited document all.

    With ``before``, only where all words of the sentence may align from that place on or earlier.
    """
    part = F.floor((F.row_number().over(W.partitionBy("document_id").orderBy("said")) - 1) / LISTED)
    listed = pairs.join(said.select("said", "words"), "said").withColumn("part", part).groupBy("document_id", "part").agg(F.collect_list(F.struct("said", "words", "cited", "before")).alias("listed"))

    def told(todo: list[tuple]) -> pa.RecordBatch:
        no, doc, nth, start, asked, given = zip(*todo) if todo else ((),) * 6
        n, first, last = aligned_many(asked, given)
        share, start = n / np.maximum(1, np.fromiter(map(len, asked), np.int64, len(asked))), np.array(start, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(no, pa.int64()), pa.array(doc, pa.string()), pa.array(nth, pa.int32()), pa.array(share, pa.float64()), pa.array(first + start, pa.int32()), pa.array(last + start, pa.int32())], ["said", "document_id", "nth", "share", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            todo = []
            for doc, text, asks in zip(*(b.column(k) for k in range(3))):
                doc, words, places = doc.as_py(), text.as_py().split(" "), {}
                for s in asks.as_py():
                    asked = s["words"].split(" ")
                    size, half = min(len(asked), SHINGLE), _half(len(asked))
                    if size not in places:
                        places[size] = _places(words, size)
                    found = best_windows(asked, places[size])
                    for nth, w in enumerate(found if s["cited"] else found[:1], 1):
                        start = max(0, w) * half
                        given = words[start : start + 4 * half]
                        if s["before"] is None or (start <= s["before"] and set(asked) <= set(given)):
                            todo.append((s["said"], doc, nth, start, asked, given))
                if len(todo) >= 16 * TOGETHER:
                    yield told(todo)
                    todo = []
            yield told(todo)

    return listed.join(texts, "document_id").select("document_id", "text", "listed").mapInArrow(run, TOLD).where(F.col("share") >= ALIGNED)


def audit_citations(answers: DataFrame, documents: DataFrame) -> DataFrame:
    """(answer_id, sentence_no, verdict, share, document_id, first, last): where a sentence aligns best, in words of the document.

    ``answers``: (answer_id, sentence_no, sentence, document_id, start, end), the span cited in code points; ``documents``:
    (document_id, text). A sentence without words is invented; sentences that cite nothing can't be supported.
    """
    ship_package(answers.sparkSession)
    asked = answers.select(F.col("answer_id").cast("string").alias("answer_id"), F.col("sentence_no").cast("int").alias("sentence_no"), tokens("sentence").alias("asked"), F.col("document_id").cast("string").alias("cited_id"), "start", "end")
    asked = kept(asked.withColumn("words", F.array_join("asked", " ")), "asked")  # words hold no space
    said = kept(asked.where("words <> ''").select("words", "asked").distinct().withColumn("said", F.monotonically_increasing_id()), "sentences")
    sizes = [r[0] for r in said.select(_size().alias("size")).distinct().collect()]  # SHINGLE at most
    each = said.select("said", F.size("asked").alias("n"), F.array_distinct(F.transform(_shingles(F.col("asked"), _size()), lambda s: s["shingle"])).alias("every"))
    each = each.select("said", "n", F.size("every").alias("total"), F.explode("every").alias("shingle"))

    # equal texts stand for each other: the largest id of each is searched
    docs = documents.select(F.col("document_id").cast("string").alias("document_id"), F.col("text"))
    alike = docs.where("document_id IS NOT NULL AND text IS NOT NULL").select("document_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    ids = kept(alike.join(alike.groupBy("digest").agg(F.max("document_id").alias("one")), "digest").select("document_id", "one").distinct(), "ids")
    texts = docs.join(ids.select(F.col("one").alias("document_id")).distinct(), "document_id", "left_semi")
    texts = kept(texts.select("document_id", F.array_join(tokens("text"), " ").alias("text")), "texts")
    every = F.concat(*[_shingles(F.col("words"), F.lit(s)) for s in sizes] or [F.array().cast("array<struct<shingle:bigint,place:int>>")])
    grams = texts.select("document_id", F.split("text", " ").alias("words")).select("document_id", F.explode(every).alias("g")).select("document_id", "g.shingle", "g.place")
    grams = kept(grams.join(each.select("shingle").distinct(), "shingle", "left_semi"), "places")
    # what holds enough of a sentence's shingles holds one of these
    known = grams.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"), F.min(F.struct("place", "document_id"))["document_id"].alias("document_id"))
    rank = F.row_number().over(W.partitionBy("said").orderBy(F.coalesce("held", F.lit(0)), "shingle"))
    rarer = each.join(known, "shingle", "left").withColumn("rank", rank).where(F.col("rank") <= F.col("total") - F.ceil(F.col("total") * CANDIDATE) + 1)
    present = F.row_number().over(W.partitionBy("said").orderBy("rank"))
    rarer = kept(rarer.where("held IS NOT NULL").withColumn("present", present).select("said", "n", "shingle", "document_id", "present"), "rarer")

    links = asked.where("cited_id IS NOT NULL").join(said.select("words", "said"), "words").select("answer_id", "sentence_no", "said", "cited_id", "start", "end")
    links = links.join(ids.select(F.col("document_id").alias("cited_id"), F.col("one").alias("document_id")), "cited_id")
    cited = links.select("said", "document_id", F.lit(True).alias("cited"))
    first = rarer.where(F.col("present") <= FIRST).select("said", "document_id", F.lit(False).alias("cited"))
    first = kept(cited.unionByName(first).groupBy("said", "document_id").agg(F.max("cited").alias("cited")).withColumn("before", F.lit(None).cast("int")), "first")
    met = kept(align_pairs(first, said, texts), "met")

    # where all of a sentence aligns, only windows that begin as early can hold a better place
    whole = met.where("nth = 1 AND share = 1").groupBy("said").agg(F.min("first").alias("before"))
    half = F.greatest(F.col("n"), F.lit(4))
    early = F.col("before").isNull() | (F.col("place") < (F.floor(F.col("before") / half) + 2) * half)
    others = grams.join(rarer.drop("document_id").join(whole, "said", "left"), "shingle").where(early).groupBy("said", "document_id").agg(F.max("before").alias("before"))
    others = others.join(first, ["said", "document_id"], "left_anti").select("said", "document_id", F.lit(False).alias("cited"), "before")
    told = kept(met.unionByName(align_pairs(others, said, texts)), "alignments")

    # the cited span in words of its document: words that begin before it, and before its end
    def words_before(text, end):
        return F.size(tokens(F.substring(text, F.lit(1), end)))

    spans = links.where("start < end").select("answer_id", "sentence_no", "cited_id", "start", "end").join(docs.select(F.col("document_id").alias("cited_id"), "text"), "cited_id")
    spans = spans.select("answer_id", "sentence_no", "cited_id", words_before(F.col("text"), F.col("start")).alias("low"), words_before(F.col("text"), F.col("end")).alias("high"))
    own = links.join(told, ["said", "document_id"]).join(spans, ["answer_id", "sentence_no", "cited_id"], "left")
    # a word that the span's edges cut counts as within
    inside = F.coalesce((F.col("first") + 1 >= F.col("low")) & (F.col("last") < F.col("high")), F.lit(False))

    def place(inside, own, document_id):
        return F.struct(inside.alias("inside"), F.col("share"), own.alias("own"), (-F.col("first")).alias("less"), F.col(document_id).alias("document_id"), F.col("last"))

    # where a sentence aligns best anywhere doesn't depend on what it cites
    anywhere = told.where("nth = 1").groupBy("said").agg(F.max(place(F.lit(False), F.lit(False), "document_id")).alias("p"))
    met = asked.join(said.select("words", "said"), "words").join(anywhere, "said").select("answer_id", "sentence_no", "p")
    found = met.unionByName(own.select("answer_id", "sentence_no", place(inside, F.col("low").isNotNull(), "cited_id").alias("p"))).groupBy("answer_id", "sentence_no").agg(F.max("p").alias("p"))
    verdict = F.when(F.col("p").isNull(), "invented").when(F.col("p.inside"), "supported").otherwise("misplaced")
    return asked.join(found, ["answer_id", "sentence_no"], "left").select("answer_id", "sentence_no", verdict.alias("verdict"), F.coalesce("p.share", F.lit(0.0)).alias("share"), F.col("p.document_id").alias("document_id"), (-F.col("p.less")).alias("first"), F.col("p.last").alias("last"))
