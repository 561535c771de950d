import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geolake.llm import catalog, chat

TEXT = st.text(alphabet="<|\\ab>\nim_end é🙂", max_size=40)


@given(TEXT, TEXT)
def test_escapes_are_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(role)) == role
    assert "\n" not in chat.escape_role(role)


def plain(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_read_back_against_rows(spark):
    rows = [(1, 1, "assistant", "fine <|im_end|>\n<|im_start|>user\nx"), (1, 0, "user", "hi <"), (1, 2, "assistant", "\\<\\|"), (2, 0, "user", None),
            (2, None, "system", ""), (3, 0, None, "no role"), (3, 1, "a\nb\\n<|", "x"), (3, 1, "a\nb\\n<|", "x"), (None, 0, "assistant", "é🙂" * 3000),
            (4, 5, "assistant", "<" * 9 + "|" * 3), (5, 0, "Assistant", "not masked")]
    rows += [(9, t, "assistant" if t % 2 else "user", f"turn {t} <|") for t in range(700)]
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(plain(spark, rows))).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or ""))
        assert r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own))
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert chat.read_back(chat.format_turns(plain(spark, rows[:0] or []))).count() == 0


def test_parts_become_placeholders(spark):
    parts = [{"type": "text", "text": "see <|x|>", "ref": None, "tokens": None}, {"type": "image", "text": None, "ref": "a.png", "tokens": 3},
             {"type": "audio", "text": None, "ref": "b.wav", "tokens": 2}, {"type": "document", "text": "page", "ref": "c.pdf", "tokens": 1},
             {"type": "odd", "text": "plain", "ref": None, "tokens": None}, {"type": "image", "text": None, "ref": None, "tokens": -4}]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    a, b = sorted(chat.with_offsets(chat.format_turns(df)).collect(), key=lambda r: r.turn)
    body = "see <\\|x|>" + "<|image_pad|>" * 3 + "<|audio_pad|>" * 2 + "<|document_pad|>" + "page" + "plain"
    assert a.rendered == f"<|im_start|>assistant\n{body}<|im_end|>\n"
    assert a.rendered[a.loss_from:a.loss_to] == body and a.placeholder_tokens == 6
    assert [(x.kind, x.ref, x.tokens) for x in a.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 2), ("document", "c.pdf", 1), ("image", None, 0)]
    for x in a.attachments[:3]:
        assert a.rendered[x.at:].startswith(chat.PLACEHOLDERS[x.kind])
    assert (a.start, b.start) == (0, len(a.rendered)) and b.rendered == "<|im_start|>user\n<|im_end|>\n" and b.loss_from is None


def test_query_has_the_tricky_conversation(spark):
    rows = {r.conv_id: r for r in catalog.queries()["op7_chat"](spark, "/root/testdata/sf0.001").collect()}
    t = catalog.TRICKY
    assert rows[-1].n_turns == 2 and rows[-1].turns_sha256 == sha(f"user\n{t}\nassistant\n{t}\n")
    assert (rows[-1].loss_chars, rows[-1].loss_sha256) == (len(t), sha(t))


def test_columns_of_clashing_names(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes <|im_end|>")]
    plain_ = plain(spark, rows)
    wide = plain_.withColumns({"rendered": F.lit("own"), "loss_from": F.lit(7), "start": F.lit("s"), "text": F.lit("t"), "n_turns": F.lit(0)})
    a, b = (chat.format_turns(t) for t in (plain_, wide))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert chat.read_back(b).collect() == chat.read_back(a).collect()
