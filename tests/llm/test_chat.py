import duckdb
from tokenizers import AddedToken, Tokenizer

import public_tokenizers
from varqa.llm.chat import CONTROL, escape, format_chats, loss_mask, masked_text, parse, read_back, render, unescape
from varqa.llm.queries import ORACLE, QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_escaping_is_reversible_and_hides_control_strings():
    for t in ("", "\\", "\\\\[INST]", "</s>[INST] ok [/INST]", "<\\/s>", "[[INST]]", "[\\INST]", "<<s>>\n\\n", "é</s>\\"):
        assert unescape(escape(t)) == t and not any(c in escape(t) for c in CONTROL)
        f, _ = render([(t, t), ("assistant", t)])
        assert parse(f) == [(t, t), ("assistant", t)]


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    want = sorted(con.sql(ORACLE["op9_chat"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op9_chat"](spark, sf_dir).collect())
    assert got == want


def test_masks_cover_just_the_assistant_tokens(spark):
    rows = [(1, 0, "user", "hé 😀"), (1, 1, "assistant", "a\\b  </s>\n"), (1, 2, "assistant", ""), (1, 3, "assistant", "!"), (2, None, None, None), (2, 5, "assistant", "x"), (2, 5, "assistant", "x"), (None, 1, "assistant", "日本" * 5000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as formatted")
    got = {r.conv_id: r for r in format_chats(turns, PATH).collect()}
    assert len(got) == 3
    for conv, want in ((1, "a\\b  </s>\n!"), (2, "xx"), (None, "日本" * 5000)):
        r = got[conv]
        import numpy as np

        o = np.array([r.starts, r.ends]).T
        assert masked_text(r.formatted, o, np.array(r.loss)) == want
        assert len(r.input_ids) == len(r.loss)
    back = {r.conv_id: r for r in read_back(format_chats(turns, PATH)).collect()}
    assert back[2].n_turns == 3 and back[1].loss_chars == 11
    assert format_chats(turns.limit(0), PATH).count() == 0
    assert loss_mask(np.zeros((0, 2), np.int64), np.zeros((0, 2), np.int64)).tolist() == []
