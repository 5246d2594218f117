"""Secret scans with a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams. Texts are indexed block by block, only for the
trigrams that some rule asks for; posting lists are intersected and united, and the expression itself runs on the
candidates alone. Rules that no trigram follows from (such as runs of hexadecimal digits) scan every text. Blocks make
the index as distributed as the scan: nothing is shuffled, and memory is bounded by one block.

Spans count code points, end exclusive. Matches are leftmost and non-overlapping for each kind; those that a rule's
least length rejects are dropped. Defined cases: null and empty texts have no spans; repeated rows are scanned
one by one; other columns pass untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textvec as tv
from millrace.llm.shared import map_text, ship_package
from millrace.llm.trigrams import TrigramIndex, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    either_case: bool = False
    group: int = 0  # whose length counts
    least: int = 0
    base: bool = False


#: The base kinds, then those that this operator adds, in the order used for ties.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", False, 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", False, 0, 24, True),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.compiled = [re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.either_case else 0)) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.index = TrigramIndex(set().union(*map(trigrams_of, self.queries)))

    def scan(self, text: pa.LargeStringArray) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule, end), in that order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(text))]
        for row, data, offsets in tv.blocks(text):
            low = tv.LOWER[data]
            texts = len(offsets) - 1
            postings = self.index.postings(low, offsets)
            whole: dict[int, str] = {}
            for k, rule in enumerate(self.rules):
                for i in np.flatnonzero(self.index.candidates(self.queries[k], postings, texts)).tolist():
                    if i not in whole:
                        whole[i] = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
                    out[row + i] += [(m.start(), k, m.end()) for m in self.compiled[k].finditer(whole[i]) if len(m[rule.group]) >= rule.least]
        for spans in out:
            spans.sort()
        return out


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), redact: str | None = None) -> DataFrame:
    """The carried columns and ``secrets``: all spans by start, then by the order of the rules.

    With ``redact``, the text column comes too, each stretch that spans cover replaced by that string.
    """
    ship_package(docs.sparkSession)

    def worker():
        scanner = Scanner(rules)

        def handle(text, null):
            found = scanner.scan(text)
            kinds = [r.kind for r in rules]
            made = {"secrets": pa.array([[{"kind": kinds[k], "start": s, "end": e} for s, k, e in x] for x in found], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))}
            if redact is not None:
                made[text_col] = pa.array([redacted(t, x, redact) if x else t for t, x in zip(text.to_pylist(), found)], pa.string(), mask=null.to_numpy(zero_copy_only=False))
            return made

        return handle

    fields = [T.StructField("secrets", SPANS)] + [T.StructField(text_col, T.StringType())] * (redact is not None)
    return map_text(docs, worker, T.StructType(fields), text_col, carry)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with every covered stretch replaced; overlapping spans are one stretch."""
    parts, at, until = [], 0, -1
    for start, _, end in spans:
        if start >= until:
            if until >= 0:
                at = until
            parts += [text[at:start], mark]
            until = end
        else:
            until = max(until, end)
    parts.append(text[max(until, 0) :])
    return "".join(parts)


def with_digest(found: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and all spans as one string."""
    base = [r.kind for r in rules if r.base]

    def text(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of_kind(kind):
        return F.filter("secrets", lambda x: x["kind"] == kind)

    return found.select(
        id_col,
        *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(text(F.filter("secrets", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        text(F.col("secrets")).alias("spans"),
    )
