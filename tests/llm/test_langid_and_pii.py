"""Language ID by held-out accuracy; personal data against the plain patterns."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from caretide.llm import langid, pii
from tests.llm.conftest import ordered


def test_held_out_rule(spark):
    rows = spark.range(200).withColumn("h", langid.held_out("id")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_held_out_accuracy(documents):
    marked = documents.withColumn("held", langid.held_out())
    model = langid.fit(marked.where(~F.col("held")))
    got = langid.predict(marked.where("held"), model, "doc_id", "lang").collect()
    assert len(got) > 50
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert {"germanic", "romance"} == set(model["families"])


def test_odd_texts_and_empty_tables(documents, docs, none, rows):
    model = langid.fit(documents)
    got = {(r.doc_id, r.text): r for r in langid.predict(docs, model, "doc_id", "text").collect()}
    assert len(langid.predict(docs, model, "doc_id").collect()) == len(rows)
    for (doc_id, text), row in got.items():
        blank = not any(c.isalpha() for c in text or "")
        assert (row.lang_pred == "und" and row.score == 0) == blank
    assert langid.predict(none, model, "doc_id").collect() == []
    unlearned = langid.fit(none)
    assert {r.lang_pred for r in langid.predict(docs, unlearned, "doc_id").collect()} == {"und"}
    only = langid.fit(docs)  # one language
    assert {r.lang_pred for r in langid.predict(docs, only, "doc_id").collect()} == {"en", "und"}


def test_sample_is_bounded(documents):
    sizes = langid.sample(documents, 10).groupBy("lang").count().collect()
    assert sizes and all(r["count"] <= 10 for r in sizes)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(text))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
            if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
            if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    parts = ["+1 (302) 555-8032", "4364946870907603", " ", "1.2.3.4", "255.0", "999", ".", "-",
             "a@b.c", "x@", "@y.z", "12", "+", "(", "é", "4077601369710178", "0000.1.1.1"]
    for n in range(20_000):
        text = "".join(r.choice(parts if n % 2 else "0123456789..--@@ab +() é%_")
                       for _ in range(r.randrange(1, 12 if n % 2 else 60)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000, "a." * 100_000, "@" * 100_000, "+" * 100_000):
        assert pii.base_spans(text) == brute("") or set(text) == {"1"}


def test_documents(documents):
    accepted = pii.fit(documents)
    got = pii.annotate(documents, accepted).collect()
    for r in got:
        base = [(s.start, pii.KINDS.index(s.kind), s.stop) for s in r.base]
        spans = [(s.start, pii.KINDS.index(s.kind), s.stop) for s in r.spans]
        assert base == brute(r.text or "") and set(base) <= set(spans)
        assert spans == sorted(spans)


def test_added_spans_and_redaction(spark):
    rows = [(n, f"call {n % 9 + 200} 555-0{n:03d} or +1 (302) 555-8{n:03d} today") for n in range(80)]
    rows += [(500, None), (501, ""), (502, "mail me@x.org, 1.2.3.4"), (502, "mail me@x.org, 1.2.3.4")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.annotate(df, pii.fit(df))
    by_id = {r.doc_id: r for r in found.collect()}
    assert [s.kind for s in by_id[3].base] == ["phone"]
    assert len(by_id[3].spans) == 2  # the method adds the number without a plus
    clean = ordered(pii.redact(found).select("doc_id", "text").collect())
    assert (3, "call [PHONE] or [PHONE] today") in clean and (500, None) in clean
    assert clean.count((502, "mail [EMAIL], [IP]")) == 2
    digest = pii.digests(found).where("doc_id = 502").first()
    assert digest.spans == "email:5:13,ip:15:22" and digest.n_email == 1 and digest.n_phone == 0


def test_odd_texts(docs, none, rows):
    accepted = pii.fit(docs)
    assert accepted == frozenset()
    assert pii.digests(pii.annotate(docs, accepted)).count() == len(rows)
    assert pii.digests(pii.annotate(none, pii.fit(none))).collect() == []
    assert pii.redact(pii.annotate(none, accepted)).collect() == []


def test_kept_columns_that_clash_give_way(docs, rows):
    found = pii.annotate(docs, frozenset(), "base", "spans", "text", "lang")
    assert found.columns == ["doc_id", "text", "lang", "base", "spans"]
    assert pii.digests(found).count() == len(rows)


@pytest.mark.parametrize("share", [0.2, 0.7])
def test_estimate_recovers_the_share_of_true_spans(share):
    rng = np.random.default_rng(1)
    truth = rng.random(4_000) < share
    right = [0.95, 0.85, 0.8, 0.75, 0.9]
    cast = np.stack([np.where(rng.random(4_000) < p, truth, ~truth) * 2 - 1 for p in right], 1)
    patterns, inverse, counts = np.unique(cast, axis=0, return_inverse=True, return_counts=True)
    p = pii.estimate(patterns, counts.astype(float))[inverse.ravel()]
    assert abs(p.mean() - share) < 0.05 and ((p > 0.5) == truth).mean() > 0.95
