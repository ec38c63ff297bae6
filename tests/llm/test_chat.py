import hashlib
import random

from ordermart.llm import chat

TURNS = "conv_id long, turn long, role string, text string, position long, tokens long"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    out = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()))
    for c in {r[0] for r in rows}:
        mine = [(r[2] or "", r[3] or "") for r in order if r[0] == c]
        loss = "".join(t for r, t in mine if r == "assistant")
        out[c] = (len(mine), sha("".join(f"{r}\n{t}\n" for r, t in mine)), len(loss), sha(loss))
    return out


def test_read_back_of_odd_turns(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 40), rnd.randint(0, 9), rnd.choice(["user", "assistant", "system", "a:b#<\\", None]),
             "".join(rnd.choice("\\<#:/turn> \nab</turn>é𝄞|") for _ in range(rnd.randint(0, 40)))) for _ in range(600)]
    rows += [(99, None, None, None), (99, 0, "assistant", None), (99, 0, "assistant", ""), (None, 1, "user", "x"),
             (98, 1, "assistant", "### user: </turn>\n\\"), (98, 1, "assistant", "### user: </turn>\n\\")]
    rows += [(97, i, "assistant", "y" * 300) for i in range(3000)]  # one conversation holds most rows
    df = spark.createDataFrame([(*r, 5, 5) for r in rows], TURNS).repartition(4)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in chat.read_back(chat.format_turns(df)).collect()}
    assert got == brute(rows)
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []


def test_typed_parts_become_placeholders(spark):
    part = lambda type, text=None, ref=None, tokens=None: (type, text, ref, tokens)
    rows = [(1, 0, "user", [part("text", "look <image|0|9> #"), part("image", ref="s3://a.png"),
                            part("audio", ref="b.wav", tokens=7), part("text", "end")]),
            (1, 1, "assistant", [part("document", ref="d.pdf"), part("text", "done")]), (1, 2, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, "
                               "parts array<struct<type:string,text:string,ref:string,tokens:long>>")
    got = chat.format_turns(df, text=None, parts="parts").collect()
    first = got[0]
    assert first.formatted == "### user: look \\<image|0|9> \\#<image|0|256><audio|1|7>end</turn>\n"
    assert [(a.type, a.ref, a.tokens) for a in first.attachments] == [("image", "s3://a.png", 256), ("audio", "b.wav", 7)]
    for r in got:
        for i, a in enumerate(r.attachments):
            assert r.formatted[a.place:].startswith(f"<{a.type}|{i}|{a.tokens}>")
    assert got[1].formatted[got[1].loss_start:got[1].loss_end] == "<document|0|512>done"
    assert got[2].formatted == "### user: </turn>\n"
    back = chat.read_back(chat.format_turns(df, text=None, parts="parts")).first()
    assert (back.n_turns, back.n_attachments) == (3, 3)


def test_escape_is_reversible():
    for t in ("", "\\", "\\\\<", "</turn>", "a\\</turn>\n### x: "):
        assert chat.unescape(chat.escape(t)) == t and "</turn>" not in chat.escape(t).replace("\\<", "")
