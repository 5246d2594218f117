import hashlib
import random

from pyspark.sql import functions as F

from millrace.llm import line_runs
from millrace.llm.line_runs import LineRuns, drop_common_lines

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, shortest=40, copies=5):
    low = line_runs.NO_ID
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= shortest:
                holders.setdefault(key(line), set()).add(low if i is None else i)
    gone = {k: max(h) for k, h in holders.items() if len(h) >= copies}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if (low if i is None else i) >= gone.get(key(x), low)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def planted(seed=1):
    rng = random.Random(seed)
    shared = [f"Line {k} that is shared by {'é' * (k % 3)} many documents of this small corpus" for k in range(30)]
    rows = []
    for i in range(300):
        lines = [rng.choice(["", "short", f"only here {i} " + "x" * 40, "  \t"]) for _ in range(rng.randrange(4))]
        lines += [f"{rng.choice(['', ' ', chr(9)])}{x.upper() if rng.random() < 0.3 else x}{rng.choice(['', chr(13), '  '])}" for x in rng.sample(shared, rng.randrange(4))]
        if i % 3 == 0:
            lines.append("a footer that a third of all documents hold, some twice")
            lines.append("A footer that a third of all documents hold, some TWICE")
        rng.shuffle(lines)
        rows.append((i * 7, "\n".join(lines)))
    edge = "x" * 40
    rows += [(5000 + k, f"{edge}\n{'y' * 39}\n{'z' * 40}" if k < 4 else f"{edge}\n{'y' * 39}") for k in range(6)]
    rows += [(9000, "q" * 50 + "\nfirst row"), (9000, "first\n" + "q" * 50), (9000, "q" * 50)] + [(9100 + k, "q" * 50) for k in range(3)]  # 4 documents
    rows += [(9500, "w" * 50 + "\nrow"), (9500, "other\n" + "w" * 50)] + [(9600 + k, "w" * 50) for k in range(4)]  # 5 documents
    rows += [(None, None), (None, "w" * 50), (-5, ""), (-6, "É" * 40), (9999, "\n".join(["long"] * 50_000 + ["w" * 50]))]
    return rows


def test_equals_brute_force(spark):
    rows = planted()
    frame = spark.createDataFrame([(i, t, -1, "clash") for i, t in rows], "doc_id long, text string, n_lines int, digest string").repartition(5)
    got = drop_common_lines(frame, with_text=True).collect()
    assert sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got], key=repr) == brute(rows)
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)
    assert sum(r["n_dropped"] for r in got) > 200


def test_other_limits_and_empty(spark):
    rows = planted(2)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = drop_common_lines(frame, shortest=5, copies=2).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows, 5, 2)
    assert drop_common_lines(frame.limit(0)).count() == 0


def test_runs_are_compacted_by_levels_and_settled_digests_stay_out(spark):
    runs = LineRuns(spark, 4, copies=2)
    for batch in range(9, -1, -1):
        lines = [(f"every{k}", batch * 100 + d) for k in range(3) for d in range(2)] + [(f"own{batch}", batch * 100)]
        runs.add(spark.createDataFrame([(k.encode(), d) for k, d in lines], "digest binary, doc long"))
        if batch == 8:
            own = spark.table(runs.names[-1]).collect()
            assert [bytes(r["digest"]) for r in own] == [b"own8"]  # the others are in the first run, with a larger id
    assert [len(level) for level in runs.levels] == [2, 2]
    assert {r["digest"].decode(): r["top"] for r in runs.common().collect()} == {f"every{k}": 901 for k in range(3)}
    # a later batch with larger ids enters again, so that the largest holder stays right
    runs.add(spark.createDataFrame([(b"every0", 5000), (b"own3", 5000)], "digest binary, doc long"))
    assert {r["digest"].decode(): r["top"] for r in runs.common().collect()} == {"every0": 5000, "every1": 901, "every2": 901, "own3": 5000}
    runs.forget()


def test_the_anti_join_does_not_move_the_runs(spark):
    runs = LineRuns(spark, 4, copies=2)
    rows = spark.range(1000).select(F.col("id").cast("string").cast("binary").alias("digest"), (F.col("id") % 3).alias("doc"))
    runs.add(rows)
    left = runs.without_settled(runs.own_run(rows))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("REPARTITION") == 2 and "SortMergeJoin" in plan
    runs.forget()
