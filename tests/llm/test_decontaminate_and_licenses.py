"""Decontamination and license scans against brute force."""

import hashlib
import re

import pytest

from caretide.llm import decontaminate, licenses
from tests.llm.conftest import ordered


def split(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(rows, items, size):
    out = []
    for doc_id, text in rows:
        words, hit, named = split(text), set(), set()
        for item_id, item in items:
            wanted = split(item)
            if item_id is None or not wanted:
                continue
            n = min(size, len(wanted))
            windows = {tuple(wanted[i:i + n]) for i in range(len(wanted) - n + 1)}
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    named.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(named), digest, bool(hit)))
    return ordered(out)


@pytest.fixture(scope="module")
def items(rows):
    texts = [t for _, t in rows if t]
    whole = [(n, " ".join(split(t)[5:30])) for n, t in enumerate(texts[:40:4])]
    return [*whole, (90, None), (91, ""), (92, "foo bar"), (93, "FOO, bar!"), (100, "ab"),
            (None, "baz word"), (7, " ".join(split(texts[2])[3:20]))]


@pytest.mark.parametrize("size, bits", [(10, decontaminate.BITS), (10, 64), (4, 300)])
def test_decontaminate(spark, docs, rows, items, size, bits):
    """Filters so small that they let most words through change nothing."""
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find(docs, bench, size=size, bits=bits)
    assert ordered(decontaminate.report(found).collect()) == brute(rows, items, size)


def test_no_items_and_no_documents(spark, docs, none, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = decontaminate.report(decontaminate.find(docs, bench.where("false"))).collect()
    assert ordered(clean) == brute(rows, [], 10)
    assert decontaminate.report(decontaminate.find(none, bench)).collect() == []


def test_a_task_that_forgets_and_kept_columns_that_clash(spark, docs, rows, items, monkeypatch):
    monkeypatch.setattr(decontaminate, "REMEMBERED", 3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = docs.withColumn("mark_", docs.mark)
    found = decontaminate.find(kept, bench, "hits", "mark", "mark_", "text", "lang")
    assert found.columns == ["doc_id", "text", "mark", "mark_", "lang", "n_words", "hits"]
    assert ordered(decontaminate.report(found).collect()) == brute(rows, items, 10)
    clean = decontaminate.uncontaminated(kept, bench, "mark").select("doc_id", "text")
    gone = {r[0] for r in brute(rows, items, 10) if r[-1]}
    assert ordered(clean.collect()) == ordered(r for r in rows if r[0] not in gone)
    assert {(r.mark, r.lang) for r in found.collect()} == {("mark", "en")}


def test_documents_are_read_three_times_whatever_the_benchmark(spark, docs, rows):
    """Work on documents does not follow the number of windows."""
    for n in (1, 300):
        many = spark.createDataFrame(
            [(i, f"one{i} two three four five six seven eight nine ten eleven") for i in range(n)],
            "item_id long, text string")
        read = spark.sparkContext.accumulator(0)

        def run(batches, read=read):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        plain = docs.select("doc_id", "text")
        counted = plain.mapInArrow(run, plain.schema)
        assert not any(r.hits for r in decontaminate.find(counted, many).collect())
        assert read.value == 3 * len(rows)


def brute_licenses(rows, templates):
    out = []
    for doc_id, text in rows:
        words, best = decontaminate.words(text), {}
        for name, template in templates:
            wanted = decontaminate.words(template)
            size = min(licenses.SHINGLE, len(wanted))
            shingles = licenses.shingle_set(wanted, size) if wanted else set()
            for i in range(len(words) if shingles else 0):
                have = licenses.shingle_set(words[i:i + len(wanted)], size)
                share = len(have & shingles) / len(shingles)
                if share >= 0.8:
                    best[name] = max(best.get(name, 0), share)
        out.append((doc_id, tuple(sorted(best.items()))))
    return ordered(out)


@pytest.mark.parametrize("block", [1_000, 3])
def test_licenses(spark, block):
    header = licenses.NOTICES["GPL-3.0-header"]
    near = header.replace("License as published", "Licence as published")
    rows = [
        (1, "foo " * 50 + header + " bar" * 31), (2, near), (3, header[:120]), (4, None), (5, ""),
        (6, "RELEASED under the-MIT license"), (6, "RELEASED under the-MIT license"),
        (7, "x " * 9000 + licenses.NOTICES["CC-BY-NC-4.0"] + " x" * 9000), (None, "public domain"),
        (8, licenses.NOTICES["Apache-2.0-header"] + licenses.NOTICES["MIT-permission"]),
    ]
    templates = sorted(licenses.NOTICES.items()) + [
        ("PD", "Public domain"), ("MIT-too", licenses.NOTICES["MIT"]), ("none", ""), (None, "foo")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kinds = spark.createDataFrame(templates, "license_id string, text string")
    got = licenses.scan(df, kinds, block=block).collect()
    want = brute_licenses(rows, [t for t in templates if t[0]])
    found = ordered((r.doc_id, tuple((m.license_id, m.containment) for m in r.matches)) for r in got)
    assert [(i, [n for n, _ in m]) for i, m in found] == [(i, [n for n, _ in m]) for i, m in want]
    assert any(n == "GPL-3.0-header" and s < 1 for i, m in found for n, s in m if i == 2)


def test_licenses_on_odd_and_empty_tables(spark, docs, none, rows):
    kinds = licenses.notices(spark)
    scanned = licenses.scan(docs, kinds, "matches", "hits", "doc_id")
    assert scanned.columns == ["doc_id", "text", "hits", "matches"]
    assert scanned.count() == len(rows)
    assert licenses.scan(none, kinds).collect() == []
    assert all(r.matches == [] for r in licenses.scan(docs, kinds.where("false")).collect())
