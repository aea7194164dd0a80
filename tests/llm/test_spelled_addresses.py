"""Spelled-out e-mail addresses in any case and with any number of labels."""

import time

import pytest

from caretide.llm import pii


@pytest.mark.parametrize("text, spans", [
    ("jane [AT] mail [DOT] com", ["jane [AT] mail [DOT] com"]),
    ("to JANE AT MAIL DOT ORG now", ["JANE AT MAIL DOT ORG"]),
    ("a [at] b [dot] co [dot] uk", ["a [at] b [dot] co [dot] uk"]),
    ("a (at) b (dot) c1 (dot) co (dot) uk.", ["a (at) b (dot) c1 (dot) co (dot) uk"]),
    # what follows a known domain is not swallowed, and the next address is found
    ("bob at mail dot com dot then call", ["bob at mail dot com"]),
    ("bob at mail dot com dot jane at x dot org", ["bob at mail dot com", "jane at x dot org"]),
    ("bob at mail dot zzz", ["bob at mail dot zzz"]),
    ("no dot here", []),
])
def test_whole_address(text, spans):
    found = pii.loose_spans(text)
    assert [text[a:b] for a, _, b in found] == spans
    accepted = frozenset(pii.pattern(text, *s, False) for s in found)
    assert pii.all_spans(text, accepted) == ([], found)


def test_long_chains_take_linear_time():
    begun = time.monotonic()
    for part in (" dot b", " dot 1", " at b dot 1", "(dot)"):
        pii.loose_spans("a at b" + part * 20_000)
    assert time.monotonic() - begun < 20
