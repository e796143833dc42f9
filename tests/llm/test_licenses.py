import random

from rowflow.llm import licenses
from rowflow.llm.common import bare_words

AUTOMATON = licenses.SuffixAutomaton(bare_words(t.encode()) for _, t in licenses.TEMPLATES)
LABELS = [label for label, _ in licenses.TEMPLATES]


def scan(text):
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
    return dict(zip(names, licenses.scan(bare_words((text or "").encode()), AUTOMATON, LABELS), strict=True))


def test_matching_statistics_against_all_substrings():
    draw = random.Random(3)
    for _ in range(800):
        texts = [[bytes([97 + draw.randrange(3)]) for _ in range(draw.randint(0, 9))] for _ in range(draw.randint(1, 4))]
        words = [bytes([97 + draw.randrange(4)]) for _ in range(draw.randint(0, 15))]
        places = {}
        for k, t in enumerate(texts):
            for i in range(len(t)):
                for j in range(i, len(t)):
                    places.setdefault(tuple(t[i : j + 1]), set()).add((k, j))
        longest = [max(n for n in range(i + 2) if not n or tuple(words[i + 1 - n : i + 1]) in places) for i in range(len(words))]
        want = [(i, n) for i, n in enumerate(longest) if n and (i + 1 == len(words) or longest[i + 1] != n + 1)]
        automaton = licenses.SuffixAutomaton(texts)
        got = automaton.matches(words)
        assert [(i, n) for i, n, _ in got] == want
        assert all(set(automaton.states[s].ends) == places[tuple(words[i - n + 1 : i + 1])] for i, n, s in got)


def test_runs_of_every_template_against_all_substrings():
    draw = random.Random(4)
    for _ in range(800):
        texts = [[bytes([97 + draw.randrange(3)]) for _ in range(draw.randint(0, 9))] for _ in range(draw.randint(1, 5))]
        words = [bytes([97 + draw.randrange(4)]) for _ in range(draw.randint(0, 15))]
        least = draw.randint(1, 3)
        want = set()
        for k, t in enumerate(texts):
            runs = {tuple(t[i:j]) for i in range(len(t)) for j in range(i + 1, len(t) + 1)} | {()}
            longest = [max(n for n in range(i + 2) if tuple(words[i + 1 - n : i + 1]) in runs) for i in range(len(words))]
            want |= {(i, n, k) for i, n in enumerate(longest) if n >= least and (i + 1 == len(words) or longest[i + 1] != n + 1)}
        automaton = licenses.SuffixAutomaton(texts)
        got = automaton.template_matches(words, least)
        assert len(got) == len(want) and {(i, n, k) for i, n, _, k in got} == want
        for i, n, s, k in got:
            assert sorted(automaton.placed[s][k]) == [j for j in range(n - 1, len(texts[k])) if texts[k][j - n + 1 : j + 1] == words[i - n + 1 : i + 1]]


def test_templates_that_share_passages_are_found_by_themselves():
    got = scan("Licensed under the Apache License, Version 2.0 (the License); see LICENSE")
    assert got["score"] == 1.0 and {"label": "apache", "start": 0, "stop": 8, "coverage": 1.0} in got["spans"]
    texts = ["a b c d e f g h", "a b c d e", "d e f g h", "x a b c d y", "c d e f"]
    automaton = licenses.SuffixAutomaton(bare_words(t.encode()) for t in texts)
    for text, want in (("a b c d e f g h", "long,end,middle,start"), ("q a b c d e q", "start"), ("d e f g h", "end")):
        labels = licenses.scan(bare_words(text.encode()), automaton, ["long", "start", "end", "other", "middle"])[5]
        assert labels.split(",") == sorted(want.split(","))


def test_phrases():
    got = scan("MIT license? The mit License; GENERAL public License general license apache mit license")
    assert (got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == (4, 0, 11, "gpl,mit")
    assert scan("mit licenses, general public domain license")["base_labels"] == ""


def test_whole_altered_and_partial_templates():
    for label, text in licenses.TEMPLATES:
        got = scan(f"something before {text} and after")
        assert label in got["labels"].split(",") and got["score"] == 1.0
    mit = licenses.TEMPLATES[0][1]
    altered = scan("intro " + mit.replace("sublicense", "lend").replace("DAMAGES", "harm of any sort"))
    assert altered["labels"] == "mit" and 0.9 < altered["score"] < 1
    span = altered["spans"][0]
    assert span["start"] == 1 and span["stop"] == altered["n_words"]
    partial = scan(" ".join(mit.split()[:60]))
    assert partial["labels"] == "" and 0.2 < partial["score"] < 0.8
    assert scan("you can redistribute it and modify nothing")["labels"] == ""
    swapped = mit.split()
    assert scan(" ".join(swapped[100:] + swapped[:100]))["score"] < 0.8  # a chain goes forward only


def test_far_apart_halves_are_not_chained():
    words = licenses.TEMPLATES[0][1].split()
    assert scan(" ".join(words[:80] + ["x"] * 500 + words[80:]))["labels"] == ""


def test_documents(documents, odd, prose):
    texts = [t + (" Released under the MIT License." if k % 3 == 0 else "") for k, t in enumerate(prose(40, 80))]
    rows = odd + [(100 + k, t, "s") for k, t in enumerate(texts)] + [(300, "Released under the MIT License. " * 400, "s")]
    got = {r.doc_id: r for r in licenses.scan_licenses(documents(rows)).collect()}
    assert licenses.scan_licenses(documents(rows)).count() == len(rows)
    for i, t, _ in rows:
        want = scan(t)
        row = got[i].asDict(recursive=True)
        assert {k: row[k] for k in want} == want
    assert got[300].n_base == 400 and got[1].n_words == 0
    assert licenses.scan_licenses(documents([])).count() == 0
