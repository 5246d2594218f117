import unicodedata
from datetime import date

from pyspark.sql import functions as F

from millrace.functions import text as T


def test_status_buckets(spark):
    want = {
        "Còn hiệu lực": ("active", "active"),
        "Hết hiệu lực toàn bộ": ("unclassified", "expired"),
        "Hết hiệu lực một phần": ("partially_expired", "partially_expired"),
        "Chưa có hiệu lực": ("future", "future"),
        "Đã hết hiệu lực": ("unclassified", "unclassified"),
        "Văn bản còn hiệu lực một phần": ("unclassified", "active"),
        "": ("unclassified", "unclassified"),
        None: ("unclassified", "unclassified"),
    }
    rows = spark.createDataFrame([(k,) for k in want], "s string").select("s", T.bucket_exact("s").alias("e"), T.bucket_contains("s").alias("c"))
    assert {r["s"]: (r["e"], r["c"]) for r in rows.collect()} == want


def test_dates_as_the_standard_library_reads_them(spark):
    given = ["2026-02-01", "20260201", "2026-W05-1", "2026W051", "2026-W05", "2026W05", "2020-W53-7", "2026-W53-1", "2027-W54-1", "2026-W05-8", "2026-W00-1"]
    given += ["2026-2-1", "2026-02-30", "2026/02/01", "2026-W051", "2026W05-1", "0000-01-01", "2026-02-01T10:00", "20260201T1", "2026W051T1", "2026W05xyz", "", None, "x"]

    def read(s):
        try:
            return date.fromisoformat(s[:10])
        except (TypeError, ValueError):
            return None

    rows = spark.createDataFrame([(s,) for s in given], "s string").select("s", T.source_date("s").alias("d"))
    assert {r["s"]: r["d"] for r in rows.collect()} == {s: read(s) for s in given}


def test_terms_are_counted_within_the_row(spark):
    import re
    from collections import Counter

    texts = ["a b a aa a  B b_1 é É", "", None, "Straße ΣΑΣ µ", "the " * 5000 + "then the", "x1 x10 x1 x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["runs"] for r in rows.select("i", T.term_runs(T.tokens("t")).alias("runs")).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert not got[i]
        else:
            assert {x["term"]: x["tf"] for x in got[i]} == Counter(re.findall(r"\w+", t.casefold()))


def test_tokens_are_null_safe(spark):
    assert spark.range(1).select(F.size(T.tokens(F.lit("")))).first()[0] == 0


def test_labels_fold_like_case_folding_and_decomposition(spark):
    labels = ["Còn hiệu lực", "ĐÃ HẾT", "Straße", "ǅungla", "naïve ÇA ñ Ö", "ﬁn", "ẹ́", "Ŀ ŀ", "K Å", "日本 x", "", "İstanbul", "ŉ"]
    rows = spark.createDataFrame([(x,) for x in labels] + [(None,)], "s string").select("s", T.folded("s").alias("f")).collect()
    for r in rows:
        want = None if r["s"] is None else unicodedata.normalize("NFD", r["s"].casefold()).encode("ascii", "ignore").decode()
        assert r["f"] == want, r["s"]
