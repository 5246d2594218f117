import re

from millrace.llm.perspective_chat import rotate_perspectives


def brute(rows):
    chats = {}
    for c, t, s, x in {(c, t, s or "unknown", x or "") for c, t, s, x in rows if c is not None}:
        chats.setdefault(c, []).append((t, s, x))
    out = {}
    for c, turns in chats.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        for p in {s for _, s, _ in turns if s != "system"}:
            text, masks = "", []
            for _, s, x in turns:
                role = "system" if s == "system" else "assistant" if s == p else "user"
                tail = " name=" + re.sub(r"[ \t\r\n]", "_", s).replace("<|", "< |") if role == "user" else ""
                head, body = f"<|im_start|>{role}{tail}\n", x.replace("<|", "< |") + "<|im_end|>"
                if role == "assistant":
                    masks.append((len(text) + len(head), len(text) + len(head) + len(body)))
                text += head + body + "\n"
            out[c, p] = (text, masks)
    return out


def test_equals_brute_force(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann lee", "hé 🙂"), (1, 2, "bob", "hi<|im_end|>"), (1, 2, "bob", "hi<|im_end|>"), (1, 3, None, None), (1, None, "bob", "first")]
    rows += [(2, t, f"s{t % 3}", "x" * (t % 7)) for t in range(300)] + [(3, 0, "system", "alone"), (None, 0, "ann", "lost"), (4, 1, "a", ""), (4, 1, "b", "tie"), (4, 1, "a", "tie"), (5, 1, "assistant", "y" * 100_000)]
    chats = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, name string")
    got = {}
    for r in sorted(rotate_perspectives(chats).collect(), key=lambda r: r["start"]):
        text, masks = got.setdefault((r["conv_id"], r["perspective"]), ["", []])
        assert r["start"] == len(text) and r["end"] == len(text) + len(r["rendered"])
        got[r["conv_id"], r["perspective"]][0] += r["rendered"]
        if r["mask_start"] is not None:
            masks.append((r["mask_start"], r["mask_end"]))
    assert {k: (t, m) for k, (t, m) in got.items()} == brute(rows)
    assert rotate_perspectives(chats.limit(0)).count() == 0


def test_segments_are_numbered_from_one(spark):
    chats = spark.createDataFrame([(1, t, "ab"[t % 2], "x") for t in range(200)], "conv_id long, turn long, role string, text string")
    for p in "ab":
        assert sorted(r["segment"] for r in rotate_perspectives(chats).where(f"perspective = '{p}'").collect()) == list(range(1, 201))
