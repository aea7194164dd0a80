"""Top-k search and chat formatting: SQL, brute force and round trips."""

import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caretide.llm import chat, topk
from tests.llm.conftest import SF_DIR
from tests.oracle_check import connect, differences

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [
    "op1_decontaminate", "op3_topk_search", "op4_substring_dedup", "op6_chat_format"])
def test_query_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dim string")
    return topk.integer_vectors(df.repartition(3))


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e13])
def test_top_k_equals_brute_force(spark, scale):
    rng = np.random.default_rng(4)
    rows = [(n, (rng.normal(size=6) * scale).round(2).tolist(), "x") for n in range(120)]
    rows += [(200 + n, [scale] * 6, "x") for n in range(30)]  # ties
    rows += [(300, None, "x"), (301, [1.0, None, 1.0], "x"), (302, [math.nan] * 6, "x"),
             (303, [math.inf] * 6, "x"), (None, [1.0] * 6, "x"), (350, [1.0, 2.0], "x"),
             (400, [0.5] * 6, "x"), (400, [0.5] * 6, "x")]
    ints = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows[:150] + rows[-1:]}
    if scale > 1e12:
        with pytest.raises(Exception, match="does not fit a long"):
            topk.top_k(vectors(spark, rows), vectors(spark, rows), 5).collect()
        return
    df = vectors(spark, rows)
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), 5, shape=(7, 3), tile_rows=2, fan=2)
    want = []
    for q in ints:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), c)
                            for c, v in ints.items() if c != q)
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:5])]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_top_k_of_few_and_none(spark):
    few = vectors(spark, [(0, [1.0], "x"), (50, [2.0], "x"), (7, [-1.0], "x")])
    got = topk.top_k(few, few.where("vec_id % 50 = 0"), 5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [
        (0, 1, 50), (0, 2, 7), (50, 1, 0), (50, 2, 7)]
    assert topk.top_k(few.where("false"), few.where("false"), 5).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>[]/\\|sINSTYtarend_ ", max_size=40))
def test_escape_is_reversible_and_hides_control_strings(content):
    hidden = chat.escape(content)
    assert chat.unescape(hidden) == content
    assert not any(c in hidden for c in chat.CONTROL)


def test_control_strings_survive():
    for content in (*chat.CONTROL, "<\\s>", "<\\\\/s>[\\INST]", "<<SYS>><</SYS>>", "<<s>"):
        assert chat.unescape(chat.escape(content)) == content
        assert not any(c in chat.escape(content) for c in chat.CONTROL)


def test_format_reads_back(spark):
    rows = [
        (1, 0, "system", None, "z"), (1, 2, "assistant", "</s>[INST] ok [/INST]", "z"),
        (1, 1, "user", "é" * 5000, "z"), (1, 3, "assistant", "", "z"), (1, 4, "assistant", "x", "z"),
        (2, None, None, "<|start|>", "z"), (2, 0, "assistant", "<s>", "z"),
        (2, 0, "assistant", "<s>", "z"), (None, 0, "user", "a", "z"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string")
    coded = chat.assemble(df.repartition(3), RANKS, PATTERN, 50_256)
    read = {r.conv_id: r for r in chat.read_back(coded, RANKS, 50_256).collect()}
    assert [(t.role, t.text) for t in read[1].turns] == [
        ("system", ""), ("user", "é" * 5000), ("assistant", "</s>[INST] ok [/INST]"),
        ("assistant", ""), ("assistant", "x")]
    assert read[1].trained_text == "</s>[INST] ok [/INST]x"
    assert [(t.role, t.text) for t in read[2].turns] == [
        ("", "<|start|>"), ("assistant", "<s>"), ("assistant", "<s>")]
    assert read[1].formatted.count("</s>") == 5 and read[None].trained_text == ""
    for row in coded.collect():
        assert len(row.ids) == len(row["mask"])
    digest = chat.digests(chat.read_back(coded, RANKS, 50_256)).where("conv_id = 2").first()
    text = "\n<|start|>\nassistant\n<s>\nassistant\n<s>\n"
    assert digest.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    none = chat.assemble(df.where("false"), RANKS, PATTERN, 50_256)
    assert chat.read_back(none, RANKS, 50_256).where(F.lit(True)).collect() == []
