"""Quality rules: measurements, policies and ablations against brute force and SQL."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caretide.llm import quality
from tests.llm.conftest import SF_DIR, frame, ordered
from tests.oracle_check import connect, differences


def brute(text, width=5):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[p:p + width]) for p in range(len(words) - width + 1)]
    hit = {q for p, w in enumerate(windows) if windows.count(w) > 1 for q in range(p, p + width)}
    m = {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
        "n_upper": len(re.findall("[A-Z]", text)), "n_marks": text.count("!") + text.count("?"),
    }
    failures = sum(1 << i for i, r in enumerate(quality.RULES) if eval(r.fails, {}, m))
    return (*m.values(), failures)


def kept(failures, policy, without=()):
    names = {r.name for i, r in enumerate(quality.RULES) if failures >> i & 1} - set(without)
    return not names & set(policy.reject) and len(names & set(policy.counted)) <= policy.allowed


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    junk = ["#a $b", "AAA! BB?", "same line\n", "x" * 40 + " ", "\r\n", "\x0b", "été ", "a|b "]
    made = ["".join(r.choice(junk) + r.choice(["", " ", "\n", "w "]) for _ in range(r.randrange(40)))
            for _ in range(60)]
    made += [" ".join(r.choice("ab") for _ in range(r.randrange(30))) for _ in range(60)]
    return made


def test_ledger_equals_brute_force(spark, rows, texts):
    every = [(i, t) for i, t in rows if len(t or "") < 3000] + [(900 + n, t) for n, t in enumerate(texts)]
    got = quality.ledger(frame(spark, every)).collect()
    assert ordered(got) == ordered((i, *brute(t)) for i, t in every)


def test_very_long_text(spark):
    words = [f"w{n}" for n in range(200_000)]
    text = " ".join([*words, *words[1000:1010]])
    got = quality.ledger(frame(spark, [(1, text)])).first()
    assert (got.n_words, got.n_repeat_words, got.failures) == (200_010, 20, 0)


def test_policies_and_ablations(spark, texts):
    book = quality.ledger(frame(spark, list(enumerate(texts)))).cache()
    bits = {r.doc_id: r.failures for r in book.collect()}
    for policy in quality.POLICIES:
        got = {r.doc_id for r in book.where(quality.passes(policy)).collect()}
        assert got == {i for i, b in bits.items() if kept(b, policy)}
    want = []
    for p in quality.POLICIES:
        whole = sum(kept(b, p) for b in bits.values())
        want.append((p.version, None, len(bits) - whole, whole, 0))
        for name in (*p.reject, *p.counted):
            failed = sum(b & quality.mask((name,)) != 0 for b in bits.values())
            left = sum(kept(b, p, [name]) for b in bits.values())
            want.append((p.version, name, failed, left, left - whole))
    assert ordered(quality.ablations(book).collect()) == ordered(want)
    parity = F.col("doc_id") % 2
    for r in quality.by_group(book, parity).collect():
        own = [b for i, b in bits.items() if i % 2 == r.group]
        whole, common = 0, -1
        for b in own:
            whole, common = whole | b, common & b
        assert (r.n, r.any, r["all"]) == (len(own), whole, common)
        assert r.n_symbols == sum(b >> 4 & 1 for b in own)


def test_documents_kept_come_out_unchanged(spark, docs, rows):
    got = quality.keep_good(docs)
    assert got.columns == docs.columns
    want = [(i, t) for i, t in rows if kept(brute(t)[-1], quality.STRICT)]
    assert ordered(got.select("doc_id", "text").collect()) == ordered(want)


def test_empty(none):
    book = quality.ledger(none)
    assert book.collect() == [] and quality.ablations(book).collect() == []
    assert quality.keep_good(none).collect() == []


def test_no_shuffle_and_no_python(spark, docs):
    plan = quality.ledger(docs)._jdf.queryExecution().executedPlan().toString()
    own = plan.split("InMemoryTableScan")[0]
    assert "Exchange" not in own and "Python" not in own and "Arrow" not in own


@pytest.mark.parametrize("name", ["op11_quality_rules", "quality_ablations"])
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []
